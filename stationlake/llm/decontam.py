"""Benchmark decontamination by latent semantic retrieval.

Passages of documents and benchmark items are TF-IDF vectors over the benchmark's terms, projected
on the leading right singular vectors of a randomised SVD of all stretches. Passages near an item by cosine are
candidates; a longest common subsequence of words, and the words of the item's answer, decide. All
weights are ratios of counts, so a passage has the same cosine in a corpus of any size. A search by
shared words, which misses no passage, can be added (``exact``); tests measure recall against it.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stationlake.llm.common import annotated, slices, spans, starts_of_groups, written
from stationlake.llm.hashing import words

#: A passage is two neighbouring stretches of so many words; items are cut likewise.
STRETCH = 16
#: Singular vectors kept, and those computed beside them; rounds of the power iteration.
RANK, EXTRA, ROUNDS = 96, 16, 2
#: Without effect: the SVD is fitted on all stretches. Kept for callers that set it.
SAMPLED_DOCUMENTS = 2_000
#: Counts of terms and pairs of terms that a task holds before it sums them up.
HELD_PAIRS = 1 << 22
#: Rows of a basis that are gathered at once: they stay in a core's cache.
CACHED_ROWS = 2_000
#: Passages of items that are looked for in one pass over the documents.
ITEM_PASSAGES = 20_000
#: Terms in more than this part of all stretches carry no weight.
TOO_COMMON = 0.25
#: Greatest weight of a term, that of one stretch in a million.
HIGHEST = float(np.log(1e6))
#: Least cosine; lower by the square root of its share in a passage for an item shorter than that.
NEAR = 0.5
#: Part of an item's words shared in order: enough alone, or together with the answer's words.
SHARED, PARAPHRASED, ANSWERED = 0.75, 0.5, 0.75
#: Words of an item in fewer than this part of all stretches are all looked up, of the others as few as needed.
SELDOM = 0.03
#: Words looked up at once, each with every item it stands in.
LOOKED_UP = 1 << 20
#: Bytes of a table of the terms in each stretch.
TABLE_BYTES = 32 << 20
BATCH_BYTES = 2 << 20
_ANSWER = re.compile(r"\banswer\s*:|\?\s", re.IGNORECASE)
#: Signs between words count as blanks, so does the end of a line.
_PLAIN = bytes(32 if b == 10 or (b < 128 and chr(b) in "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~") else b for b in range(256))


def plain(text: str | None) -> bytes:
    return (text or "").lower().encode().translate(_PLAIN)


def shared_words(short: list[int], long: list[int]) -> int:
    """Length of the longest common subsequence, a bit of one number for each word of ``short``."""
    places: dict[int, int] = {}
    for k, word in enumerate(short):
        places[word] = places.get(word, 0) | 1 << k
    every = (1 << len(short)) - 1
    row = every
    for word in long:
        at = places.get(word)
        if at:
            hit = row & at
            row = (row + hit | row - hit) & every
    return len(short) - row.bit_count()


class Items:
    """Passages of the benchmark: their words, terms and answers."""

    def __init__(self, rows: list[tuple[int, str]]):
        self.texts = [text for _, text in rows]
        self.item, self.words, self.answers = [], [], []
        for item, text in rows:
            whole = words([plain(text)])[0]
            cut = [m.end() for m in _ANSWER.finditer(text or "")]
            answer = words([plain(text[cut[-1] :])])[0].tolist() if cut else []
            if answer and len(answer) == len(whole):
                answer = []
            for at in range(0, max(1, len(whole) - STRETCH), STRETCH) if len(whole) > 3 * STRETCH else [0]:
                part = whole[at : at + 2 * STRETCH] if len(whole) > 3 * STRETCH else whole
                if len(part):
                    self.item.append(item)
                    self.words.append(part)
                    self.answers.append(answer)
        self.terms = np.unique(np.concatenate(self.words)) if self.words else np.zeros(0, dtype=np.uint64)


def stretches(texts: list[bytes], terms: np.ndarray):
    """Words, text and first word of every stretch, and term and stretch of each word that is a term."""
    word, text, _ = words(texts)
    count = np.bincount(text, minlength=len(texts))
    place = np.arange(len(word)) - np.repeat(np.cumsum(count) - count, count)
    first = np.flatnonzero(place % STRETCH == 0)
    of = np.cumsum(place % STRETCH == 0) - 1
    at, known = _places(terms, word)
    return word, text[first], first, at[known], of[known]


def _places(terms: np.ndarray, word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The place of each word among the terms, and whether it is one.

    Terms are hashes, so their first bits spread them: a word is compared with the first term of its bits,
    and searched for only if it is another one and its bits have more than one term.
    """
    if not len(terms):
        return np.zeros(len(word), dtype=np.int64), np.zeros(len(word), dtype=bool)
    bits = min(20, len(terms).bit_length() + 4)
    shift = np.uint64(64 - bits)
    count = np.bincount((terms >> shift).astype(np.int64), minlength=1 << bits)
    begin = np.minimum(np.cumsum(count) - count, len(terms) - 1)
    crowded = count > 1
    slot = (word >> shift).view(np.int64)
    at = begin[slot]
    known = terms[at] == word
    open_ = np.flatnonzero(crowded[slot] & ~known)
    at[open_] = np.minimum(np.searchsorted(terms, word[open_]), len(terms) - 1)
    known[open_] = terms[at[open_]] == word[open_]
    return at, known


def _pairs(terms: int, term: np.ndarray, of: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A key of each two words of one stretch that are terms, and of each such word with itself: the upper
    triangle of the product of the transposed matrix of terms by itself, one entry a unit. And whether
    a word is the first of its term in its stretch."""
    # Two words of one term stand on both sides of the diagonal.
    found, width, first = [_key_of(terms, term, term)], 1, np.ones(len(term), dtype=bool)
    while width < STRETCH:
        near = of[width:] == of[:-width]
        if not near.any():
            break
        one, two = term[width:][near], term[:-width][near]
        key = _key_of(terms, np.minimum(one, two), np.maximum(one, two))
        same = one == two
        found += [key, key[same]]
        first[width + np.flatnonzero(near)[same]] = False
        width += 1
    return np.concatenate(found), first


def _key_of(terms: int, term, other):
    return term * (terms + 1) + other + 1


@dataclass(frozen=True)
class StretchCounts:
    """``rows`` (term, other, n), counted over all stretches of all documents: for ``other`` of at least
    ``term`` the entries of A'A, where A counts the terms of each stretch; for an ``other`` of -1 the
    stretches that hold the term, or all stretches (the term after the last)."""

    rows: DataFrame


def stretch_counts(docs: DataFrame, terms: np.ndarray) -> StretchCounts:
    """The counts of one scan of all texts; copies count as often as they stand."""
    n_terms = len(terms)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray]] = []
        for batch in slices(batches, BATCH_BYTES):
            _, text, _, term, of = stretches([plain(t) for t in batch.column(0).to_pylist()], terms)
            pairs, fresh = _pairs(n_terms, term, of)
            each = np.bincount(term[fresh], minlength=n_terms)
            seen = np.flatnonzero(each)
            held += [(_key_of(n_terms, seen, -1), each[seen]), np.unique(pairs, return_counts=True)]
            held.append((np.array([_key_of(n_terms, n_terms, -1)]), np.array([len(text)])))
            if sum(len(key) for key, _ in held) > HELD_PAIRS:
                held = [_summed(held)]
                if len(held[0][0]) > HELD_PAIRS // 2:
                    yield pa.RecordBatch.from_arrays([pa.array(x) for x in held.pop()], ["key", "n"])
        if held:
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in _summed(held)], ["key", "n"])

    counted = docs.select("text").mapInArrow(work, "key long, n long").groupBy("key").agg(F.sum("n").alias("n"))
    side = F.lit(n_terms + 1)
    other = F.col("key") % side
    rows = counted.select(((F.col("key") - other) / side).cast("long").alias("term"), (other - 1).alias("other"), "n")
    return StretchCounts(written(rows, "stretch-counts"))


def _summed(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    key, n = (np.concatenate(x) for x in zip(*parts))
    order = np.argsort(key, kind="stable")
    key, n = key[order], n[order]
    start = starts_of_groups([key])
    return (key[start], np.add.reduceat(n, start)) if len(start) else (key, n)


def weights(docs: DataFrame | StretchCounts, terms: np.ndarray) -> tuple[np.ndarray, float]:
    """Log inverse frequency of the terms among all stretches of all documents, and the weight of a word that
    is no term: that of the middle term, as its own count is not known. Neither follows the corpus size."""
    counted = docs if isinstance(docs, StretchCounts) else stretch_counts(docs, terms)
    count = np.zeros(len(terms) + 1)
    for row in counted.rows.where("other = -1").collect():  # one row a term of the benchmark
        count[row.term] = row.n
    rare = np.log((count[-1] + 1) / (count[:-1] + 1))
    rare[count[:-1] > TOO_COMMON * count[-1]] = 0
    # A term of no document weighs like one of a single stretch among those that a million have.
    rare = np.minimum(rare, HIGHEST)
    some = rare[rare > 0]
    return rare.astype(np.float32), float(np.median(some)) if len(some) else 0.0


def _projected(term, of, n, rare, basis) -> np.ndarray:
    """The sums of the weighted rows of ``basis`` over the terms of each of ``n`` stretches."""
    out = np.zeros((n, basis.shape[1]), dtype=np.float32)
    for lo in range(0, len(term), CACHED_ROWS):
        part, to = term[lo : lo + CACHED_ROWS], of[lo : lo + CACHED_ROWS]
        heavy = rare[part] > 0
        part, to = part[heavy], to[heavy]
        if len(part):
            start = starts_of_groups([to])
            out[to[start]] += np.add.reduceat(basis[part], start, axis=0)
    return out


def _passages(blocks: np.ndarray, text: np.ndarray) -> np.ndarray:
    """Each stretch with the next one of its text."""
    out = blocks.copy()
    out[:-1] += np.where((text[1:] == text[:-1])[:, None], blocks[1:], 0)
    return out


def singular_vectors(
    counted: StretchCounts, items: Items, rare: np.ndarray, rank: int = RANK, seed: int = 5
) -> np.ndarray:
    """Right singular vectors (a row a term) of the TF-IDF matrix of all stretches and all items.

    They are the eigenvectors of its product with itself, which has an entry for each two terms that
    some stretch holds. Each round, tasks multiply their entries with the current basis, and the driver
    adds up matrices of terms by rank.
    """
    n_terms = len(items.terms)
    width = min(n_terms, rank + EXTRA)
    basis = np.linalg.qr(np.random.default_rng(seed).standard_normal((n_terms, width)))[0].astype(np.float32)
    pairs = counted.rows.where("other >= 0")
    _, _, _, term, of = stretches([plain(text) for text in items.texts], items.terms)
    key, n = np.unique(_pairs(n_terms, term, of)[0], return_counts=True)
    own = key // (n_terms + 1), key % (n_terms + 1) - 1, n

    def product(basis: np.ndarray) -> np.ndarray:
        weighted = (basis * rare[:, None]).astype(np.float32)

        def add(z: np.ndarray, term: np.ndarray, other: np.ndarray, n: np.ndarray) -> None:
            for lo in range(0, len(term), CACHED_ROWS):
                i, j, c = (column[lo : lo + CACHED_ROWS] for column in (term, other, n))
                heavy = (rare[i] > 0) & (rare[j] > 0)
                i, j, c = i[heavy], j[heavy], c[heavy]
                off = i != j
                i, j, c = np.append(i, j[off]), np.append(j, i[off]), np.append(c, c[off])
                order = np.argsort(i, kind="stable")
                i, j, c = i[order], j[order], c[order]
                start = starts_of_groups([i])
                if len(start):
                    z[i[start]] += np.add.reduceat(weighted[j] * c[:, None].astype(np.float64), start, axis=0)

        def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            out = np.zeros(basis.shape)
            for batch in batches:
                add(out, *(column.to_numpy() for column in batch.columns))
            yield pa.RecordBatch.from_arrays([pa.array([out.tobytes()], pa.binary())], ["part"])

        total = np.zeros(basis.shape)
        add(total, *own)
        for row in pairs.coalesce(8).mapInArrow(work, "part binary").collect():
            total += np.frombuffer(row.part).reshape(total.shape)
        return total * rare[:, None]

    for _ in range(ROUNDS):
        basis = np.linalg.qr(product(basis))[0].astype(np.float32)
    values, vectors = np.linalg.eigh(basis.T @ product(basis))
    best = np.argsort(-values)[:rank]
    return (basis @ vectors[:, best]).astype(np.float32)


def find_leaks(
    docs: DataFrame, benchmark: DataFrame, text_col: str = "text", near: float = NEAR, exact: bool = False
) -> DataFrame:
    """``docs`` with contaminated and leaks (item_id, cosine, shared), one entry an item found.

    Words are lower-cased and split at white space and ASCII punctuation. Items of more than 48 words
    are cut into passages of 32 words, every 16 words. A passage of a document is a leak if around it 75 % of the words of an item's passage stand in
    order, or 50 % and, in order, 75 % of the words of the item's answer (what follows its last question
    mark or "answer:"; an item without one needs the 75 %). Passages are looked at whose cosine with the
    item's is ``near`` or more (less for items of under 32 words); with ``exact`` also all that have enough
    of its words around them, whatever their cosine, so that every leak is found. Null and empty texts and items match nothing; repeated rows
    and items are treated alike; no items, no leaks. Columns of ``docs`` named like the results are
    replaced.
    """
    rows = benchmark.select(F.col("item_id").cast("long"), F.col("text").cast("string")).where(F.length("text") > 0)
    rows = rows.groupBy("text").agg(F.min("item_id").alias("item_id"))
    fields = "contaminated boolean, leaks array<struct<item_id: bigint, cosine: double, shared: double>>"
    body = docs.select(F.col(text_col).cast("string").alias("text"))
    kind = pa.list_(pa.struct([("item_id", pa.int64()), ("cosine", pa.float64()), ("shared", pa.float64())]))

    def finder_of(part: list[tuple[int, str]]) -> _Finder | None:
        items = Items(part)
        if not len(items.terms):
            return None
        counted = stretch_counts(body, items.terms)
        rare, unknown = weights(counted, items.terms)
        return _Finder(items, rare, unknown, singular_vectors(counted, items, rare), near, exact)

    def leaks_in(finder: _Finder | None):
        def compute(column: pa.Array) -> list[pa.Array]:
            texts = [plain(text) for text in column.to_pylist()]
            leaks: list[dict[int, tuple[float, float]]] = [{} for _ in texts]
            if finder:
                finder.search(texts, leaks)
            listed = [[{"item_id": i, "cosine": c, "shared": s} for i, (c, s) in sorted(x.items())] for x in leaks]
            return [pa.array([bool(x) for x in leaks]), pa.array(listed, kind)]

        return compute

    blocks = _blocks(rows)
    part, ahead = next(blocks, []), next(blocks, None)
    if ahead is None:
        return annotated(docs, text_col, fields, leaks_in(finder_of(part)))

    # Each block in a pass of its own, that writes its leaks; nothing of a block is kept for the next.
    found = None
    while part:
        one = annotated(body, "text", fields, leaks_in(finder_of(part))).where("contaminated")
        one = written(one.select(_key("text").alias("key"), F.explode("leaks").alias("leak")), "leaks")
        found = one if found is None else found.unionByName(one)
        part, ahead = ahead, next(blocks, None)
    best = F.max(F.struct("leak.shared", "leak.cosine")).alias("best")
    found = found.groupBy("key", F.col("leak.item_id").alias("item_id")).agg(best)
    leak = F.struct("item_id", "best.cosine", "best.shared")
    found = found.groupBy("key").agg(F.array_sort(F.collect_list(leak)).alias("leaks"))
    names = [n for n in docs.columns if n not in (text_col, "contaminated", "leaks")] + [text_col]
    keyed = docs.select(*(F.col(f"`{n}`").alias(f"c{k}") for k, n in enumerate(names)), _key(text_col).alias("key"))
    none = F.array().cast("array<struct<item_id: bigint, cosine: double, shared: double>>")
    return keyed.join(found, "key", "left").select(
        *(F.col(f"c{k}").alias(n) for k, n in enumerate(names)),
        F.col("leaks").isNotNull().alias("contaminated"),
        F.coalesce("leaks", none).alias("leaks"),
    )


def _key(text_col: str) -> Column:
    return F.sha2(F.col(f"`{text_col}`").cast("string").cast("binary"), 256)


def _blocks(rows: DataFrame) -> Iterator[list[tuple[int, str]]]:
    """The items, so many at a time that one block is small."""
    after = None
    while True:
        ahead = rows if after is None else rows.where(
            F.struct("item_id", "text") > F.struct(F.lit(after[0]).cast("long").alias("item_id"), F.lit(after[1]).alias("text"))
        )
        part = [(r.item_id, r.text) for r in ahead.orderBy("item_id", "text").limit(ITEM_PASSAGES).collect()]
        if part:
            yield part
            after = part[-1]
        if len(part) < ITEM_PASSAGES:
            return


class _Finder:
    """Looks for the items of one block in texts."""

    def __init__(self, items: Items, rare: np.ndarray, unknown: float, vectors: np.ndarray, near: float, exact: bool):
        self.exact = exact
        self.item, self.terms, self.unknown = items.item, items.terms, unknown
        self.words = [w.tolist() for w in items.words]
        self.answers = items.answers
        self.rare = rare
        self.basis = (vectors * rare[:, None]).astype(np.float32)
        size = np.fromiter(map(len, items.words), dtype=np.int64, count=len(items.words))
        term = np.searchsorted(self.terms, np.concatenate(items.words))
        self.bars = (near * np.sqrt(np.minimum(1, size / (2 * STRETCH)))).astype(np.float32)
        self.queries = _unit(_projected(term, np.repeat(np.arange(len(size)), size), len(size), rare, self.basis))
        self._list_words(term, size)

    def _list_words(self, term: np.ndarray, size: np.ndarray) -> None:
        """For each term the items it is looked up for, and bits for its places in them.

        Half of an item's words must be around a leak, three quarters if it has no answer. So of any
        choice of its words, at least that many less those not chosen must be; the rarest ones, one more
        than may be missing, or all rare ones are chosen.
        """
        answers = [np.array(a, dtype=np.uint64) for a in self.answers]
        self.answer_size = np.fromiter(map(len, answers), dtype=np.int64, count=len(answers))
        self.answer_place = np.cumsum(self.answer_size) - self.answer_size
        self.answer_term = np.searchsorted(self.terms, np.concatenate([*answers, np.zeros(0, dtype=np.uint64)]))
        self.term, self.size, self.place = term, size, np.cumsum(size) - size
        item = np.repeat(np.arange(len(size)), size)
        rarity = self.rare[term]
        order = np.lexsort((term, -rarity, item))
        place = np.arange(len(term)) - np.repeat(self.place, size)
        needed = np.ceil(np.where(self.answer_size > 0, PARAPHRASED, SHARED) * size).astype(np.int64)
        chosen = (place <= (size - needed)[item]) | (rarity[order] > -np.log(SELDOM))
        self.hits = needed - size + np.bincount(item[chosen], minlength=len(size))
        # Stretches on either side of a passage that words around it can be in.
        self.aside = -(-np.maximum(4, size - STRETCH // 2) // STRETCH)
        term, item, bit = term[order][chosen], item[chosen], np.uint64(1) << place[chosen].astype(np.uint64)
        order = np.lexsort((item, term))
        term, item, bit = term[order], item[order], bit[order]
        start = starts_of_groups([term, item])
        self.listed, self.bits = item[start], np.bitwise_or.reduceat(bit, start)
        self.begin = np.searchsorted(term[start], np.arange(len(self.terms) + 1))

    def _sharing(self, term: np.ndarray, of: np.ndarray, text: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All passages and items of which so many words are in the stretches around that a leak is possible."""
        found = [(np.zeros(0, dtype=np.int64),) * 2]
        count = self.begin[term + 1] - self.begin[term]
        total = np.cumsum(np.bincount(of, weights=count, minlength=len(text)))
        margin = int(self.aside.max()) + 1
        lo = 0
        while lo < len(text):
            base = total[lo - 1] if lo else 0
            hi = max(lo + 64, int(np.searchsorted(total, base + LOOKED_UP)))
            own = slice(*np.searchsorted(of, [lo - margin, hi + margin]))
            p, q = self._sharing_part(of[own], self.begin[term[own]], count[own], text)
            inside = (p >= lo) & (p < hi)
            order = np.argsort(p[inside], kind="stable")
            found += self._having_half(p[inside][order], q[inside][order], term, of, text)
            lo = hi
        return tuple(np.concatenate(x) for x in zip(*found))

    def _having_half(self, p, q, term, of, text) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Those of the pairs, ordered by passage, with enough of all words of the item in the stretches around."""

        def present(p, q, term, place, size):
            """How many of the words are in the table in the stretches around each passage."""
            if not len(p):
                return np.zeros(0, dtype=np.int64)
            at = term[spans(place[q], size[q])]
            there = np.zeros(len(at), dtype=bool)
            for k in range(-margin + 1, margin + 1):
                s = p + k
                around = (k >= -self.aside[q]) & (k <= self.aside[q] + 1) & (s >= 0) & (s < len(text))
                around[around] = text[s[around]] == text[p[around]]
                there |= table[np.repeat(np.where(around, s - base, width) * len(self.terms), size[q]) + at]
            return np.add.reduceat(there, np.cumsum(size[q]) - size[q], dtype=np.int64)

        margin = int(self.aside.max()) + 1
        rows = max(64, TABLE_BYTES // max(1, len(self.terms)))
        lo = 0
        while lo < len(p):
            base = int(p[lo]) - margin
            hi = int(np.searchsorted(p, p[lo] + rows))
            width = int(p[hi - 1]) + margin + 1 - base
            known = slice(*np.searchsorted(of, [base, base + width]))
            table = np.zeros((width + 1) * len(self.terms), dtype=bool)  # the last row stays empty
            table[(of[known] - base) * len(self.terms) + term[known]] = True
            for at in range(lo, hi, 50_000):
                x, y = p[at : min(at + 50_000, hi)], q[at : min(at + 50_000, hi)]
                shared = present(x, y, self.term, self.place, self.size) / self.size[y]
                enough = shared >= SHARED
                open_ = np.flatnonzero((shared >= PARAPHRASED) & ~enough & (self.answer_size[y] > 0))
                answered = present(x[open_], y[open_], self.answer_term, self.answer_place, self.answer_size)
                enough[open_] = answered >= ANSWERED * self.answer_size[y[open_]]
                yield x[enough], y[enough]
            lo = hi

    def _sharing_part(self, of, begin, count, text) -> tuple[np.ndarray, np.ndarray]:
        entry = spans(begin, count)
        q, s, bits = self.listed[entry], np.repeat(of, count), self.bits[entry]
        order = np.argsort(q * len(text) + s, kind="stable")
        q, s, bits = q[order], s[order], bits[order]
        # Hits too far apart for one passage have nothing to do with each other.
        first = np.ones(len(q), dtype=bool)
        first[1:] = (q[1:] != q[:-1]) | (text[s[1:]] != text[s[:-1]]) | (np.diff(s) > 2 * self.aside[q[1:]] + 1)
        run = np.flatnonzero(first)
        if not len(run):
            return q, s
        enough = np.bitwise_count(np.bitwise_or.reduceat(bits, run)) >= self.hits[q[run]]
        kept = np.repeat(enough, np.diff(np.append(run, len(q))))
        q, s, bits = q[kept], s[kept], bits[kept]
        # Each hit counts for all passages that it is around.
        reach = self.aside[q]
        p = spans(s - 1 - reach, 2 * reach + 2)
        q, s, bits = (np.repeat(x, 2 * reach + 2) for x in (q, s, bits))
        same = (p >= 0) & (p < len(text))
        same[same] = text[p[same]] == text[s[same]]
        p, q, bits = p[same], q[same], bits[same]
        order = np.argsort(q * len(text) + p, kind="stable")
        p, q, bits = p[order], q[order], bits[order]
        start = starts_of_groups([q, p])
        if not len(start):
            return p, q
        enough = np.bitwise_count(np.bitwise_or.reduceat(bits, start)) >= self.hits[q[start]]
        return p[start][enough], q[start][enough]

    def search(self, texts: list[bytes], leaks: list[dict]) -> None:
        word, text, first, term, of = stretches(texts, self.terms)
        if not len(text):
            return
        passages = _unit(_passages(_projected(term, of, len(text), self.rare, self.basis), text))
        # The vector of a passage also has its words that are no terms; no item has a share in those.
        inside = np.bincount(of, weights=self.rare[term].astype(np.float64) ** 2, minlength=len(text))
        size = np.diff(np.append(first, len(word)))
        outside = (size - np.bincount(of, minlength=len(text))) * self.unknown**2
        inside, outside = (_passages(x[:, None], text)[:, 0] for x in (inside, outside))
        passages *= np.sqrt(inside / np.maximum(inside + outside, 1e-12))[:, None].astype(np.float32)
        sizes = np.bincount(text, weights=size, minlength=len(texts)).astype(np.int64)
        stop = np.cumsum(sizes)
        candidates = [np.zeros(0, dtype=np.int64)]
        if self.exact:
            p, q = self._sharing(term, of, text)
            candidates.append(p * len(self.words) + q)
        for lo in range(0, len(passages), 8_192):
            near = passages[lo : lo + 8_192] @ self.queries.T >= self.bars
            candidates.append(lo * len(self.words) + np.flatnonzero(near.ravel()))
        pairs = np.unique(np.concatenate(candidates))
        for lo in range(0, len(pairs), 8_192):
            p, q = np.divmod(pairs[lo : lo + 8_192], len(self.words))
            cosine = np.einsum("ij,ij->i", passages[p], self.queries[q])
            best = np.argsort(-cosine, kind="stable")
            self._decide(p[best], q[best], cosine[best], (word, text, first, sizes, stop), leaks)

    def _decide(self, p: np.ndarray, q: np.ndarray, cosine: np.ndarray, cut: tuple, leaks: list[dict]) -> None:
        word, text, first, sizes, stop = cut
        for p, q, near in zip(p.tolist(), q.tolist(), cosine.tolist()):
            row, own = int(text[p]), self.words[q]
            known = leaks[row].get(self.item[q])
            if known and known[1] >= 1:
                continue
            reach = max(4, len(own) - STRETCH // 2)
            begin = max(int(stop[row] - sizes[row]), int(first[p]) - reach)
            around = word[begin : min(int(stop[row]), int(first[p]) + 2 * STRETCH + reach)].tolist()
            present = set(around)
            there, answer = sum(map(present.__contains__, own)), self.answers[q]
            if there < PARAPHRASED * len(own):
                continue
            if there < SHARED * len(own) and sum(map(present.__contains__, answer)) < max(1, ANSWERED * len(answer)):
                continue
            shared = shared_words(own, around) / len(own)
            if shared < PARAPHRASED or shared < SHARED and not self._answered(q, around):
                continue
            if not known or known[1] < shared:
                leaks[row][self.item[q]] = (near, shared)

    def _answered(self, q: int, around: list[int]) -> bool:
        answer = self.answers[q]
        return bool(answer) and shared_words(answer, around) >= ANSWERED * len(answer)


def _unit(rows: np.ndarray) -> np.ndarray:
    norm = np.linalg.norm(rows, axis=1, keepdims=True)
    return np.divide(rows, norm, out=np.zeros_like(rows), where=norm > 0)

