import tracemalloc

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from stationlake.llm import langid
from stationlake.llm.langid import UNDETERMINED, fit_documents, grams, identify, viterbi


def plain_path(scores, penalty):
    """The best value and labels of one document by the textbook recurrence."""
    value, back = scores[0].astype(np.float64), []
    for row in scores[1:]:
        change = value[:, None] - penalty * (1 - np.eye(len(value)))
        back.append(change.argmax(axis=0))
        value = change.max(axis=0) + row
    return value.max()


def value_of(scores, labels, penalty):
    return scores[np.arange(len(labels)), labels].sum() - penalty * (labels[1:] != labels[:-1]).sum()


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 400), min_size=1, max_size=5), st.integers(0, 10**6), st.integers(1, 4))
def test_blocks_give_the_best_path(lengths, seed, k):
    random = np.random.default_rng(seed)
    lengths = np.array(lengths)
    scores = random.integers(-8, 8, (lengths.sum(), k)).astype(np.float32)
    labels = viterbi(scores, lengths, 3.0)
    at = 0
    for n in lengths:
        if n:
            part = scores[at : at + n]
            assert value_of(part, labels[at : at + n], 3.0) == pytest.approx(plain_path(part, 3.0))
        at += n


def test_grams_stay_inside_words():
    code, owner = grams(["ab", "c"])
    assert sorted(owner.tolist()) == [0] * 8 + [1] * 4  # a b ^a ab b$ ^ab ab$ ^ab$, c ^c c$ ^c$


def test_held_out_accuracy(spark, documents):
    table, _ = documents
    found = identify(table.select("doc_id", "text", "lang"), fit_documents(table))
    rows = found.where(langid.held_out(found.doc_id)).collect()
    assert len(rows) > 40 and sum(r.lang == r.lang_pred for r in rows) >= 0.97 * len(rows)
    assert all(0 <= r.score <= 1 for r in rows)


def mixed_rows(spark):
    english = "the quick brown fox jumps over the lazy dog and then runs through the wood with all the others "
    german = "der schnelle braune fuchs springt über den faulen hund und läuft dann durch den wald mit allen "
    russian = "быстрая коричневая лиса прыгает через ленивую собаку и бежит через лес вместе со всеми "
    rows = [(k, text * 3, lang) for k, (text, lang) in enumerate([(english, "en"), (german, "de"), (russian, "ru")] * 8)]
    odd = [
        (100, None, "en"),
        (101, "", "en"),
        (102, "123 !!! \n", "de"),
        (103, english * 2 + german * 3, None),
        (None, russian, "ru"),
        (104, "你好世界", None),
        (104, "你好世界", None),
        (105, (english + "\n") * 3000, "en"),
    ]
    return spark.createDataFrame(rows + odd, "doc_id long, text string, lang string").selectExpr("*", "1.5 as score")


def test_spans_odd_rows_and_scripts(spark):
    table = mixed_rows(spark)
    found = identify(table, fit_documents(table))
    assert len(found.columns) == len(set(found.columns))
    rows = found.collect()
    by_id = {r.doc_id: r for r in rows}
    assert len(rows) == 32
    for k in (100, 101, 102):
        assert (by_id[k].lang_pred, by_id[k].score, by_id[k].spans) == (UNDETERMINED, 0.0, [])
    assert [s.lang for s in by_id[103].spans] == ["en", "de"] and by_id[103].lang_pred == "de"
    assert by_id[103].spans[1].first_word == by_id[103].spans[0].words == 38
    assert by_id[None].lang_pred == "ru" and by_id[105].lang_pred == "en"
    assert by_id[104].lang_pred in ("de", "en", "ru")  # a script no language is written in


def test_without_labels(spark):
    empty = spark.createDataFrame([], "doc_id long, text string, lang string")
    assert fit_documents(empty) is None and identify(empty, None).count() == 0
    unlabelled = spark.createDataFrame([(1, "words", None)], "doc_id long, text string, lang string")
    assert fit_documents(unlabelled) is None
    assert identify(unlabelled, None).first().lang_pred == UNDETERMINED


@pytest.mark.parametrize("texts, words, languages", [(2_000, 5, 50), (10_000, 5, 12), (40, 4_000, 30)])
def test_memory_of_the_paths_is_bounded(texts, words, languages):
    scores = np.random.default_rng(1).random((texts * words, languages)).astype(np.float32)
    tracemalloc.start()
    labels = viterbi(scores, np.full(texts, words), 1.0)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 120e6 and len(labels) == texts * words
    for k in (0, texts - 1):
        part = slice(k * words, (k + 1) * words)
        assert value_of(scores[part], labels[part], 1.0) == pytest.approx(plain_path(scores[part], 1.0), rel=1e-5)


def test_the_sample_of_a_language_is_chosen_in_parts(spark):
    rows = [(k, "some words " + "".join("abcdefghij"[int(c)] for c in str(k)), "en" if k % 10 else "de") for k in range(3000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    whole, few = langid.fit(docs), langid.fit(docs, per_language=50)
    assert whole.languages == few.languages == ["de", "en"]
    assert len(few.codes) < len(whole.codes)


def test_spans_only_when_asked_for(spark, documents):
    table, _ = documents
    model = fit_documents(table)
    rows = table.select("doc_id", "text")
    short, full = identify(rows, model, with_spans=False), identify(rows, model)
    assert "spans" not in short.columns and "spans" in full.columns
    assert sorted(short.select("doc_id", "lang_pred", "score").collect()) == sorted(full.select("doc_id", "lang_pred", "score").collect())
