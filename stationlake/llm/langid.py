"""Language of documents and of the spans inside them: script ranges, then Viterbi over word scores."""

from __future__ import annotations

import re
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from stationlake.llm.common import annotated, crc_mod, slices, spans

UNDETERMINED = "und"
WORD = re.compile(r"[^\W\d_]+")
#: First code point of ranges of scripts. Letters before a range belong to the one before.
SCRIPTS = (
    (0x0000, "latin"), (0x0370, "greek"), (0x0400, "cyrillic"), (0x0530, "armenian"), (0x0590, "hebrew"),
    (0x0600, "arabic"), (0x0780, "other"), (0x0900, "devanagari"), (0x0980, "bengali"), (0x0A00, "indic"),
    (0x0E00, "thai"), (0x0E80, "lao"), (0x0F00, "tibetan"), (0x1000, "burmese"), (0x10A0, "georgian"),
    (0x1100, "hangul"), (0x1200, "ethiopic"), (0x13A0, "other"), (0x1E00, "latin"), (0x1F00, "greek"),
    (0x2000, "other"), (0x3040, "kana"), (0x3100, "han"), (0xA000, "other"), (0xAC00, "hangul"),
    (0xD7B0, "other"), (0x20000, "han"), (0x30000, "other"),
)
_NAMES = sorted({name for _, name in SCRIPTS})
_STARTS = np.array([start for start, _ in SCRIPTS])
_SCRIPT_OF = np.array([_NAMES.index(name) for _, name in SCRIPTS])
#: Bounds of the fit: labelled documents a language, letter sequences in the model.
PER_LANGUAGE = 2_000
GRAMS = 50_000
LONGEST_GRAM = 4
#: A language writes in a script if it holds at least this part of its letters.
SCRIPT_SHARE = 0.01
WRONG_SCRIPT = -50.0
#: Words, and letters of words, whose scores a worker keeps; most words in a block of the Viterbi pass.
KEPT_WORDS = 300_000
KEPT_LETTERS = 4_000_000
BLOCK = 128
#: Text that is split into words at once; ways (padded words x languages squared) walked at once.
SLICE_TEXT = 1 << 20
WAYS = 1 << 23
#: Parts of a language that choose their sample apart before it is chosen from all.
SALTS = 64


def grams(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all letter sequences of 1 to 4 letters of each word, its two ends being letters too, and
    the number of the word each comes from."""
    joined = "\x02" + "\x02".join(words) + "\x02"
    letters = np.frombuffer(joined.encode("utf-32-le"), dtype="<u4").astype(np.uint64)
    end = letters == 2
    word = np.cumsum(end) - 1
    step = np.uint64(0x9E3779B97F4A7C15)
    codes, owners = [letters[~end] + step], [word[~end]]
    code, inside = letters, np.zeros(len(letters), dtype=bool)
    for n in range(2, LONGEST_GRAM + 1):
        if n > 2:  # no end of a word strictly inside
            inside = inside[:-1] | end[n - 2 : len(letters) - 1]
        else:
            inside = np.zeros(len(letters) - 1, dtype=bool)
        code = (code[:-1] * step) + letters[n - 1 :] + np.uint64(n)
        good = ~inside
        codes.append(code[good])
        owners.append(word[: len(code)][good])
    return np.concatenate(codes), np.concatenate(owners)


def scripts(words: list[str]) -> np.ndarray:
    """The script of each word's first letter."""
    first = np.fromiter((ord(w[0]) for w in words), dtype=np.int64, count=len(words))
    return _SCRIPT_OF[np.searchsorted(_STARTS, first, side="right") - 1]


@dataclass
class Model:
    """Scores of letter sequences by language, and the scripts each language is written in."""

    languages: list[str]
    codes: np.ndarray  # sorted
    scores: np.ndarray  # row for each code, column for each language
    written_in: np.ndarray  # row for each script, column for each language
    penalty: float = 6.0
    _index: dict[str, int] = field(default_factory=dict, repr=False)
    _kept: list[np.ndarray] = field(default_factory=list, repr=False)
    _table: np.ndarray | None = field(default=None, repr=False)
    _letters: int = field(default=0, repr=False)

    def word_scores(self, words: list[str]) -> np.ndarray:
        code, owner = grams(words)
        at = np.minimum(np.searchsorted(self.codes, code), len(self.codes) - 1)
        known = self.codes[at] == code
        total = np.zeros((len(words), len(self.languages)), dtype=np.float32)
        for k in range(len(self.languages)):
            total[:, k] = np.bincount(owner[known], weights=self.scores[at[known], k], minlength=len(words))
        allowed = self.written_in[scripts(words)]
        return np.where(allowed | ~allowed.any(axis=1, keepdims=True), total, WRONG_SCRIPT)

    def numbers(self, words: list[str]) -> list[int]:
        """Rows of the words in the table of scores, which grows with words not seen before."""
        try:
            return list(map(self._index.__getitem__, words))
        except KeyError:
            new = list(set(words).difference(self._index))
            for k in range(0, len(new), 20_000):
                self._kept.append(self.word_scores(new[k : k + 20_000]))
            self._letters += sum(map(len, new))
            self._index.update(zip(new, range(len(self._index), len(self._index) + len(new))))
            self._table = None
            return list(map(self._index.__getitem__, words))

    def table(self) -> np.ndarray:
        if self._table is None:
            self._kept = [np.concatenate(self._kept)] if self._kept else []
            self._table = self._kept[0] if self._kept else np.zeros((0, len(self.languages)), dtype=np.float32)
        return self._table

    def forget(self) -> None:
        if len(self._index) > KEPT_WORDS or self._letters > KEPT_LETTERS:
            self._index, self._kept, self._table, self._letters = {}, [], None, 0


def viterbi(scores: np.ndarray, lengths: np.ndarray, penalty: float, ways: int = WAYS) -> np.ndarray:
    """The best language of every word, for documents of ``lengths`` words one after the other.

    Documents of like lengths are walked together, as many as stay within ``ways``: their words, padded
    to the longest block among them, times the languages squared. Only a single long document exceeds it.
    """
    labels = np.zeros(len(scores), dtype=np.int64)
    base = np.cumsum(lengths) - lengths
    order = np.argsort(lengths, kind="stable")
    order = order[lengths[order] > 0]
    start = 0
    while start < len(order):
        # The last document of a part is its longest, so its block is what all are padded to.
        blocks = np.cumsum(-(-lengths[order[start:]] // BLOCK)) * np.minimum(lengths[order[start:]], BLOCK)
        end = start + max(1, int(np.searchsorted(blocks * scores.shape[1] ** 2, ways, side="right")))
        part = order[start:end]
        at = spans(base[part], lengths[part])
        labels[at] = _walked(scores[at], lengths[part], penalty, min(BLOCK, int(lengths[part[-1]])))
        start = end
    return labels


def _walked(scores: np.ndarray, lengths: np.ndarray, penalty: float, block_words: int) -> np.ndarray:
    """``viterbi`` of some documents at once.

    A path gains each word's score and loses ``penalty`` where the language changes. All documents
    are cut into blocks; for each language before a block, all blocks are walked side by side, then
    the blocks of a document are chained. The result is that of one pass over the whole document.
    """
    n, k = scores.shape
    count = -(-lengths // block_words)
    first = np.concatenate(([0], np.cumsum(count)))
    total = int(first[-1])
    if n == 0:
        return np.zeros(0, dtype=np.int64)
    word_at = np.concatenate(([0], np.cumsum(lengths)))[:-1]
    doc = np.repeat(np.arange(len(lengths)), lengths)
    place = np.arange(n) - word_at[doc]
    block, step = first[doc] + place // block_words, place % block_words
    padded = np.zeros((block_words, total, k), dtype=np.float32)  # after its end a block keeps its language
    padded[step, block] = scores

    path = np.tile(np.where(np.eye(k, dtype=bool), 0.0, -penalty).astype(np.float32), (total, 1, 1))
    path = path + padded[0][:, None, :]
    stays = np.ones((block_words, total, k, k), dtype=bool)
    comes = np.zeros((block_words, total, k), dtype=np.uint8)
    for t in range(1, block_words):
        comes[t] = path.argmax(axis=2)
        best = np.take_along_axis(path, comes[t][:, :, None].astype(np.int64), axis=2) - np.float32(penalty)
        np.greater_equal(path, best, out=stays[t])
        path = np.maximum(path, best) + padded[t][:, None, :]

    # Chain: the value of ending each block in each language, and the language before the block.
    before = np.zeros((total, k), dtype=np.uint8)
    value = np.zeros((len(lengths), k), dtype=np.float64)
    order = np.argsort(-count, kind="stable")
    for j in range(int(count.max())):
        active = order[: int(np.searchsorted(-count[order], -j, side="left"))]
        at = first[active] + j
        ways = value[active][:, :, None] + path[at]
        before[at] = ways.argmax(axis=1)
        value[active] = ways.max(axis=1)
    ends = np.zeros(total, dtype=np.int64)
    start = np.zeros(total, dtype=np.int64)
    state = value.argmax(axis=1)
    for j in range(int(count.max()) - 1, -1, -1):
        active = order[: int(np.searchsorted(-count[order], -j, side="left"))]
        at = first[active] + j
        ends[at] = state[active]
        start[at] = before[at, ends[at]]
        state[active] = start[at]

    labels = np.zeros((block_words, total), dtype=np.uint8)
    rows = np.arange(total)
    now = ends
    for t in range(block_words - 1, -1, -1):
        labels[t] = now
        now = np.where(stays[t, rows, start, now], now, comes[t, rows, start])
    return labels[step, block].astype(np.int64)


def fit(docs: DataFrame, per_language: int = PER_LANGUAGE, max_grams: int = GRAMS) -> Model | None:
    """A model from ``doc_id, text, lang``: at most ``per_language`` documents of each language, those of
    the smallest hash of their doc_id, whole; the ``max_grams`` commonest letter sequences. Rows
    without an id teach nothing. None if no labelled text has a letter."""
    known = docs.where(F.col("text").isNotNull() & F.col("lang").isNotNull())
    chosen = known.select("doc_id", "lang").where("doc_id IS NOT NULL").withColumn("code", F.xxhash64("doc_id"))
    for parts in (["lang", F.pmod("code", F.lit(SALTS))], ["lang"]):  # no task sees a whole language
        chance = F.row_number().over(Window.partitionBy(*parts).orderBy("code", "doc_id"))
        chosen = chosen.withColumn("chance", chance).where(F.col("chance") <= per_language)
    chosen = chosen.select("doc_id", "lang").distinct()
    sample = known.join(F.broadcast(chosen), ["doc_id", "lang"], "left_semi").select("lang", "text")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, SLICE_TEXT):
            words: dict[str, Counter] = defaultdict(Counter)
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                words[lang].update(WORD.findall(text.lower()))
            for lang, found in words.items():
                if not found:
                    continue
                each = np.fromiter(found.values(), dtype=np.int64, count=len(found))
                code, owner = grams(list(found))
                code, at = np.unique(code, return_inverse=True)
                n = np.bincount(at, weights=each[owner]).astype(np.int64)
                lengths = np.fromiter(map(len, found), dtype=np.int64, count=len(found))
                script = np.bincount(scripts(list(found)), weights=each * lengths, minlength=len(_NAMES)).astype(np.int64)
                code = np.concatenate((np.arange(len(script), dtype=np.int64), code.view(np.int64)))
                n = np.concatenate((script, n))
                kind = np.repeat([True, False], [len(script), len(code) - len(script)])
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(code)), pa.array(kind), pa.array(code), pa.array(n)],
                    ["lang", "script", "code", "n"],
                )

    counted = sample.mapInArrow(work, "lang string, script boolean, code long, n long")
    counted = counted.groupBy("lang", "script", "code").agg(F.sum("n").alias("n"))
    by_code = counted.groupBy("script", "code").agg(
        F.sum("n").alias("total"), F.collect_list(F.struct("lang", "n")).alias("by")  # one entry a language
    )
    rows = by_code.orderBy(F.desc("script"), F.desc("total"), "code").limit(max_grams + len(_NAMES)).collect()
    languages = sorted({x.lang for row in rows for x in row.by if x.n})
    if not languages:
        return None
    column = {lang: k for k, lang in enumerate(languages)}
    script = np.zeros((len(_NAMES), len(languages)))
    kept = [row for row in rows if not row.script]
    counts = np.zeros((len(kept), len(languages)))
    for row in rows:
        if row.script:
            for x in row.by:
                if x.lang in column:
                    script[row.code, column[x.lang]] = x.n
    for k, row in enumerate(kept):
        for x in row.by:
            counts[k, column[x.lang]] = x.n
    chance_of = (counts + 0.5) / (counts.sum(axis=0) + 0.5 * len(kept))
    scores = np.log(chance_of)
    scores = 0.5 * (scores - scores.mean(axis=1, keepdims=True))  # overlapping sequences: half weight
    codes = np.array([row.code for row in kept], dtype=np.int64).view(np.uint64)
    order = np.argsort(codes)
    share = script / np.maximum(script.sum(axis=0), 1)
    return Model(languages, codes[order], scores[order].astype(np.float32), share >= SCRIPT_SHARE)


def identify(docs: DataFrame, model: Model | None, text_col: str = "text", with_spans: bool = True) -> DataFrame:
    """``docs`` with lang_pred, score and, ``with_spans``, spans for every row.

    ``spans`` lists language, first word and number of words of the runs of equal language; words are
    runs of letters. ``lang_pred`` is the language with the most letters (ties: the first by name) and
    ``score`` its share of the letters. A text that is null or has no letter is ``und`` with score 0
    and no spans, as is every text if there is no model. Repeated rows and null ids are kept; columns
    of ``docs`` with the names of the results are replaced.
    """

    def compute(column: pa.Array) -> list[pa.Array]:
        names = model.languages if model else []
        found = [WORD.findall(text.lower()) if text else [] for text in column.to_pylist()]
        lengths = np.fromiter(map(len, found), dtype=np.int64, count=len(found))
        predicted = [UNDETERMINED] * len(found)
        score = np.zeros(len(found))
        runs: list[list[dict]] = [[] for _ in found] if with_spans else []
        if model and lengths.any():
            model.forget()
            number = np.fromiter((i for words in found for i in model.numbers(words)), dtype=np.int64)
            labels = viterbi(model.table()[number], lengths, model.penalty)
            letters = np.fromiter((len(w) for words in found for w in words), dtype=np.int64)
            doc = np.repeat(np.arange(len(found)), lengths)
            k = len(names)
            tally = np.bincount(doc * k + labels, weights=letters, minlength=len(found) * k).reshape(-1, k)
            some = lengths > 0
            score[some] = tally[some].max(axis=1) / tally[some].sum(axis=1)
            best = tally.argmax(axis=1)
            predicted = [names[b] if s else UNDETERMINED for b, s in zip(best, some)]
            if with_spans:
                turn = np.flatnonzero(np.concatenate(([True], (labels[1:] != labels[:-1]) | (doc[1:] != doc[:-1]))))
                base = np.cumsum(lengths) - lengths
                size = np.diff(np.append(turn, len(labels)))
                for d, lang, at, words in zip(doc[turn], labels[turn], turn - base[doc[turn]], size):
                    runs[d].append({"lang": names[lang], "first_word": int(at), "words": int(words)})
        made = [pa.array(predicted, pa.string()), pa.array(score)]
        return [*made, pa.array(runs, kind)] if with_spans else made

    kind = pa.list_(pa.struct([("lang", pa.string()), ("first_word", pa.int64()), ("words", pa.int64())]))
    fields = "lang_pred string, score double"
    if with_spans:
        fields += ", spans array<struct<lang: string, first_word: bigint, words: bigint>>"
    return annotated(docs, text_col, fields, compute, SLICE_TEXT)


def held_out(doc_id: Column) -> Column:
    """Documents never learned from: crc32 of the id as text leaves 1 on division by 3."""
    return crc_mod(doc_id, 3) == 1


def fit_documents(docs: DataFrame, **bounds) -> Model | None:
    """The model of the documents that are not held out."""
    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"), F.col("lang").cast("string"))
    return fit(rows.where(~held_out(F.col("doc_id"))), **bounds)
