import numpy as np
import pyarrow.parquet as pq
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from stationlake.llm import decontam
from stationlake.llm.common import annotated
from stationlake.llm.decontam import STRETCH, Items, _Finder, find_leaks, plain, shared_words
from stationlake.llm.hashing import words


def words_of(text):
    return plain(text).decode().split()


def common(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        last = 0
        for k, y in enumerate(b, 1):
            last, row[k] = row[k], last + 1 if x == y else max(row[k], row[k - 1])
    return row[-1]


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(0, 5), min_size=1, max_size=30), st.lists(st.integers(0, 5), max_size=40))
def test_longest_common_subsequence(a, b):
    assert shared_words(a, b) == common(a, b)


def test_given_documents_against_word_runs(spark, documents, sf_dir):
    table, rows = documents
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    items = {r.item_id: words_of(r.text) for r in benchmark.collect()}
    want = set()
    for doc, text in rows:
        joined = " " + " ".join(words_of(text)) + " "
        for item, found in items.items():
            runs = [" ".join(found[k : k + 5]) for k in range(max(1, len(found) - 4))]
            if sum(f" {run} " in joined for run in runs) >= 0.7 * len(runs):
                want.add((doc, item))
    assert want
    found = find_leaks(table.select("doc_id", "text"), benchmark).collect()
    assert {(r.doc_id, x.item_id) for r in found for x in r.leaks} == want
    assert all(r.contaminated == bool(r.leaks) for r in found)


def corpus(spark):
    random = np.random.default_rng(8)
    vocabulary = [f"term{k}" for k in range(3000)] + ["the", "of", "and"] * 300

    def prose(n):
        return list(random.choice(vocabulary, n))

    question, answer = prose(20), prose(6)
    item = " ".join(question) + "? " + " ".join(answer)
    half = [w if k % 5 < 3 else random.choice(vocabulary) for k, w in enumerate(question)]
    long = prose(200)
    rows = [
        (1, " ".join(prose(100) + question + answer + prose(50))),
        (2, " ".join(w.upper() for w in prose(30)) + "\n" + ",\n".join(question + answer)),
        (3, " ".join(prose(60) + half + answer + prose(60))),  # paraphrased, with the answer
        (4, " ".join(prose(60) + half + prose(60))),  # without it
        (5, " ".join(prose(400))),
        (6, None),
        (7, ""),
        (8, " ".join(prose(500) + long[40:110] + prose(500))),
        (None, item),
        (9, item),
        (9, item),
        (10, "term1 " * 40_000 + item),
    ]
    rows += [(k, " ".join(prose(150))) for k in range(20, 120)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "'z' as item_id", "0 as leaks")
    items = spark.createDataFrame([(1, item), (2, " ".join(long)), (3, None), (4, ""), (None, " ".join(prose(30)))], "item_id long, text string")
    return docs, items


def test_paraphrases_long_items_and_odd_rows(spark):
    docs, items = corpus(spark)
    found = find_leaks(docs, items)
    got = [(r.doc_id, [x.item_id for x in r.leaks]) for r in found.collect()]
    assert len(got) == docs.count() and found.columns.count("leaks") == 1
    by_id = dict(got)
    assert by_id[1] == by_id[2] == by_id[3] == by_id[None] == by_id[9] == by_id[10] == [1]
    assert by_id[8] == [2]
    assert all(not x for k, x in got if k in (4, 5, 6, 7) or (k or 0) >= 20)


def test_no_items_and_no_documents(spark):
    docs, items = corpus(spark)
    assert not any(r.contaminated for r in find_leaks(docs, items.limit(0)).collect())
    assert find_leaks(docs.limit(0), items).count() == 0


def accepted(items, texts):
    """Every (text, item) pair that the rule accepts around any passage, by looking at all of them."""
    found = set()
    for row, text in enumerate(texts):
        body = words([plain(text)])[0].tolist()
        for own, item, answer in zip(items.words, items.item, items.answers):
            own, reach = own.tolist(), max(4, len(own) - STRETCH // 2)
            for at in range(0, len(body), STRETCH):
                around = body[max(0, at - reach) : at + 2 * STRETCH + reach]
                shared = common(own, around) / len(own)
                if shared >= 0.75 or shared >= 0.5 and answer and common(answer, around) >= 0.75 * len(answer):
                    found.add((row, item))
                    break
    return found


def placed(documents, sf_dir, part):
    """Items and texts with an item at every offset, verbatim and with a fifth of its words replaced."""
    random = np.random.default_rng(4)
    rows = [(r["item_id"], r["text"]) for r in pq.read_table(f"{sf_dir}/benchmark.parquet").to_pylist() if r["text"]]
    rows = rows[part::8][:24]
    hosts = [x for x in (words_of(text) for _, text in documents[1]) if len(x) >= 80]
    texts = []
    for k, (_, text) in enumerate(rows):
        for at in range(STRETCH):
            host, own = hosts[int(random.integers(len(hosts)))], words_of(text)
            if (at + k) % 2:
                own = [w if random.random() >= 0.2 else str(random.choice(host)) for w in own]
            texts.append(" ".join(host[:at] + own + host[at : at + 60]))
    return rows, texts


@pytest.mark.parametrize("stretches_of_corpus", [1e4, 1e6, 3e8])
def test_the_exact_search_finds_every_accepted_pair_at_any_corpus_size(documents, sf_dir, stretches_of_corpus):
    rows, texts = placed(documents, sf_dir, 0)
    items = Items(rows)
    want = accepted(items, texts)
    assert len(want) >= 0.8 * len(texts)
    rng = np.random.default_rng(1)
    rare = rng.uniform(0, np.log(1e4), len(items.terms)).astype(np.float32)
    basis = np.linalg.qr(rng.standard_normal((len(items.terms), min(96, len(items.terms)))))[0]
    finder = _Finder(items, rare, float(np.log(stretches_of_corpus)), basis, 0.5, True)
    leaks = [{} for _ in texts]
    finder.search([plain(t) for t in texts], leaks)
    assert {(row, item) for row, found in enumerate(leaks) for item in found} == want


def test_blocks_of_items_are_searched_one_by_one(spark, monkeypatch):
    docs, items = corpus(spark)
    rows = lambda df: sorted((r.doc_id or 0, str(r.text), r.contaminated, [(x.item_id, x.shared) for x in r.leaks]) for r in df.collect())
    whole, sent = find_leaks(docs, items), []
    want = rows(whole)

    def noted(df, text_col, fields, compute):
        sent.append(sum(len(f.words) for f in held(compute)))
        return annotated(df, text_col, fields, compute)

    monkeypatch.setattr(decontam, "annotated", noted)
    monkeypatch.setattr(decontam, "ITEM_PASSAGES", 1)
    found = find_leaks(docs, items)
    assert found.columns == whole.columns and rows(found) == want
    assert len(sent) == 3 and max(sent) < sum(sent)


def held(function):
    """The finders that a function carries with it."""
    values = [c.cell_contents for c in function.__closure__ or ()]
    return [x for v in values for x in (v if isinstance(v, list) else [v]) if isinstance(x, _Finder)]


@pytest.mark.parametrize("copies", [0, 40, 400])
def test_the_exact_search_against_brute_force_at_several_sizes(spark, documents, sf_dir, monkeypatch, copies):
    """A tiny sample fits the basis, and much of the corpus is copies: every accepted pair is found still."""
    monkeypatch.setattr(decontam, "SAMPLED_DOCUMENTS", 3)
    rows, texts = placed(documents, sf_dir, 3)
    rows, texts = rows[:6], texts[: 6 * STRETCH]
    want = accepted(Items(rows), texts)
    more = [text for _, text in documents[1] if text][: 40 if copies else 0] * (copies // 40)
    docs = spark.createDataFrame(list(enumerate(texts + more)), "doc_id long, text string")
    items = spark.createDataFrame(rows, "item_id long, text string")
    found = find_leaks(docs, items, exact=True).where(f"doc_id < {len(texts)}").collect()
    assert len(want) >= 0.8 * len(texts)
    assert {(r.doc_id, x.item_id) for r in found for x in r.leaks} == want


def retrieved(spark, rows, texts, more, **options):
    docs = spark.createDataFrame(list(enumerate(texts + more)), "doc_id long, text string")
    items = spark.createDataFrame(rows, "item_id long, text string")
    found = find_leaks(docs, items, **options).where(f"doc_id < {len(texts)}").collect()
    return {(r.doc_id, x.item_id) for r in found for x in r.leaks}


@pytest.mark.parametrize("copies, size", [(0, "given"), (40, "given"), (800, "given"), (40, "large")])
def test_recall_of_the_cosine_at_several_sizes(spark, documents, sf_dir, monkeypatch, copies, size):
    """Retrieval by cosine alone against all passages looked at; terms weigh as in a corpus without end, too."""
    rows, texts = placed(documents, sf_dir, 2)
    rows, texts = rows[:12], texts[: 12 * STRETCH]
    want = accepted(Items(rows), texts)
    more = [text for _, text in documents[1] if text][:40] * (copies // 40)
    counted = decontam.weights

    def of_a_large_corpus(docs, terms):
        rare, _ = counted(docs, terms)
        rare = np.where(rare >= rare.max() - 1e-6, decontam.HIGHEST, rare).astype(np.float32)
        return rare, float(np.median(rare[rare > 0]))

    if size == "large":
        monkeypatch.setattr(decontam, "weights", of_a_large_corpus)
    found = retrieved(spark, rows, texts, more)
    assert found <= want and len(found) >= 0.95 * len(want)


def test_nothing_is_found_beside_the_cosine(spark, documents, sf_dir):
    """Without near passages there are no leaks, so retrieval is what finds them."""
    rows, texts = placed(documents, sf_dir, 1)
    rows, texts = rows[:4], texts[: 4 * STRETCH]
    assert retrieved(spark, rows, texts, [], near=2.0) == set()
    assert retrieved(spark, rows, texts, []) and retrieved(spark, rows, texts, [], near=2.0, exact=True)


def test_weights_do_not_follow_the_size_of_the_corpus(spark, documents):
    table, _ = documents
    terms = np.unique(words([plain(t) for _, t in documents[1][:5]])[0])
    once, unknown = decontam.weights(table, terms)
    many = table
    for _ in range(3):
        many = many.unionByName(many)
    again, other = decontam.weights(many, terms)
    assert np.abs(once - again).max() < 0.7 and abs(unknown - other) < 0.7


def test_singular_vectors_are_those_of_all_stretches(spark):
    """Many more documents than once were sampled, a few of them with words of their own."""
    random = np.random.default_rng(12)
    vocabulary = [f"word{k}" for k in range(20)]
    rows = [(k, " ".join(random.choice(vocabulary[: 20 if k % 1500 else 12], 20 + k % 9))) for k in range(6000)]
    rows += [(None, None), (7, ""), (8, "none of these is known"), (9, "word1 word1 word2")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    items = Items([(1, " ".join(vocabulary[:10])), (2, " ".join(vocabulary[10:] + vocabulary[10:12]))])
    matrix, at = [], {t: k for k, t in enumerate(items.terms.tolist())}
    for text in [text for _, text in rows]:
        found = words([plain(text)])[0].tolist()
        for lo in range(0, len(found), STRETCH):
            matrix.append(np.bincount([at[w] for w in found[lo : lo + STRETCH] if w in at], minlength=len(at)))
    matrix = np.array(matrix, dtype=float)
    counted = decontam.stretch_counts(docs, items.terms)
    full = np.zeros((len(at), len(at)))
    for row in counted.rows.where("other >= 0").collect():
        full[row.term, row.other] = full[row.other, row.term] = row.n
    assert np.array_equal(full, matrix.T @ matrix)
    rare, _ = decontam.weights(counted, items.terms)
    again, _ = decontam.weights(docs, items.terms)
    part = np.append((matrix > 0).sum(axis=0), len(matrix))
    assert np.array_equal(rare, again)
    free = part[:-1] <= decontam.TOO_COMMON * len(matrix)
    assert np.allclose(rare, np.where(free, np.log((len(matrix) + 1) / (part[:-1] + 1)), 0), atol=1e-5)
    rare = np.linspace(0.5, 3, len(at)).astype(np.float32)
    own = np.array([np.bincount([at[w] for w in item.tolist()], minlength=len(at)) for item in items.words], dtype=float)
    vectors = decontam.singular_vectors(counted, items, rare)
    weighed = np.vstack([matrix, own]) * rare
    values, want = np.linalg.eigh(weighed.T @ weighed)
    assert np.abs(np.abs((want[:, ::-1] * vectors).sum(axis=0)) - 1).max() < 1e-2


def test_counts_are_summed_in_parts(spark, monkeypatch):
    random = np.random.default_rng(13)
    texts = [" ".join(random.choice([f"word{k}" for k in range(60)], 90)) for _ in range(50)]
    terms = np.unique(words([plain(t) for t in texts])[0])[:50]
    docs = spark.createDataFrame([(t,) for t in texts], "text string")
    rows = lambda: sorted(map(tuple, decontam.stretch_counts(docs, terms).rows.collect()))
    whole = rows()
    monkeypatch.setattr(decontam, "HELD_PAIRS", 300)
    monkeypatch.setattr(decontam, "BATCH_BYTES", 1000)
    assert rows() == whole


@pytest.mark.parametrize("crowd", [0, 300])
def test_words_are_found_among_the_terms(crowd):
    random = np.random.default_rng(14)
    terms = np.unique(np.append(random.integers(0, 2**64, 500, dtype=np.uint64), (7 << 56) + np.arange(crowd, dtype=np.uint64) * 3))
    edge = np.array([0, 2**64 - 1, 7 << 56, (7 << 56) + 1], dtype=np.uint64)
    word = np.concatenate((random.permutation(np.repeat(terms, 3)), random.integers(0, 2**64, 2000, dtype=np.uint64), edge))
    for known in (terms, terms[:1], terms[:0]):
        at, found = decontam._places(known, word)
        assert np.array_equal(found, np.isin(word, known))
        assert np.array_equal(known[at[found]], word[found])


def test_a_term_counts_once_a_stretch(spark):
    """Counted from the pairs of words of a stretch, without another sort."""
    terms = np.unique(words([b"a b c"])[0])
    docs = spark.createDataFrame([("a a b a x a",), ("c " * 40 + "a",), (None,)], "text string")
    rows = decontam.stretch_counts(docs, terms).rows.where("other = -1").collect()
    counts = {r.term: r.n for r in rows}
    place = {w: int(np.searchsorted(terms, words([w.encode()])[0][0])) for w in "abc"}
    assert counts == {place["a"]: 2, place["b"]: 1, place["c"]: 3, 3: 4}
    each = decontam._pairs(3, np.array([0, 1, 0, 2, 0, 0]), np.array([0, 0, 0, 0, 0, 1]))[1]
    assert each.tolist() == [True, True, False, True, False, True]
