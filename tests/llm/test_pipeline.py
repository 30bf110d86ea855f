import os

import pytest

import corpus_pipeline
from llm_helpers import brute_lines, bytes_moved, lines_left
from test_simhash import expected as simhash_expected

from stationlake.llm.decontam import plain


@pytest.fixture(scope="module")
def stages(spark, sf_dir):
    """What each stage returns, and what it was given."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").cache()
    out = [docs]
    for _, stage in corpus_pipeline.STAGES:
        out.append(stage(spark, out[-1], sf_dir).cache())
    return out


def pairs(df):
    return [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]


def test_all_but_the_last_return_the_columns_of_documents(stages):
    assert all(df.columns == stages[0].columns for df in stages[:-1])
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language", "lines", "near_duplicates", "decontamination", "sequences"]


def test_language_keeps_texts_with_letters(stages):
    want = sorted((i, t) for i, t in pairs(stages[0]) if t and any(c.isalpha() for c in t))
    assert sorted(pairs(stages[1])) == want


def test_lines(stages):
    rows = pairs(stages[1])
    assert sorted(pairs(stages[2])) == sorted(lines_left(rows, brute_lines(rows)))
    assert all(r.n_chars == len(r.text) for r in stages[2].collect())


def test_one_document_of_each_group_stays(stages):
    want = {c for _, _, c in simhash_expected(pairs(stages[2]))}
    assert sorted(i for i, _ in pairs(stages[3])) == sorted(want)


def test_leaks_go_and_clean_documents_stay(spark, stages, sf_dir):
    items = [plain(r.text).decode().split() for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    left = {i for i, _ in pairs(stages[4])}
    for doc, text in pairs(stages[3]):
        joined = " " + " ".join(plain(text).decode().split()) + " "
        share = max(
            sum(f" {' '.join(w[k : k + 5])} " in joined for k in range(max(1, len(w) - 4))) / max(1, len(w) - 4) for w in items
        )
        assert (doc in left) == (share < 0.7)


def test_every_document_left_is_packed(stages):
    assert sorted({r.doc_id for r in stages[5].collect()}) == sorted(i for i, _ in pairs(stages[4]))


def test_odd_documents(spark, tmp_path):
    rows = [
        (1, None, "en", "s", None),
        (2, "", "en", None, 0),
        (3, "one two three", None, "s", 13),
        (3, "one two three", None, "s", 13),
        (None, "four five six seven", "en", "s", 19),
        (5, "x y z\n" * 2000, "en", "s", 12_000),
    ]
    folder = os.path.join(tmp_path, "odd")
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    spark.createDataFrame(rows, schema).selectExpr("*", "1 as fp", "2 as leaks", "'q' as score").write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([(1, "a b c d")], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    got = corpus_pipeline.run(spark, folder).collect()
    # The second row 3 loses its line to the first; of 5 one line stays; wordless texts are one group.
    assert {r.doc_id for r in got} == {3, None, 5}
    spark.createDataFrame([], schema).write.parquet(f"{tmp_path}/none/documents.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{tmp_path}/none/benchmark.parquet")
    assert corpus_pipeline.run(spark, f"{tmp_path}/none").count() == 0


def test_texts_that_stay_whole_are_not_moved(spark):
    """Five copies, and five texts with a line of another one, among long ones that have nothing in common."""
    long = [" ".join(f"w{k}x{n}" for n in range(100)) for k in range(100)]
    rows = [(k, text, "en", "s", len(text)) for k, text in enumerate(long)]
    rows += [(1000 + k, long[k], "en", "s", len(long[k])) for k in range(5)]
    rows += [(2000 + k, f"{long[k]}\nown words of {k} " + "z" * k, "en", "s", 9) for k in range(5, 10)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    size = sum(len(r[1]) for r in rows)
    texts = [(r[0], r[1]) for r in rows]
    wanted = {
        corpus_pipeline.lines: sorted(lines_left(texts, brute_lines(texts))),
        corpus_pipeline.near_duplicates: sorted((i, t) for i, t in texts if i in {c for _, _, c in simhash_expected(texts)}),
    }
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for stage, want in wanted.items():
            left = stage(spark, docs, "")
            assert sorted((r.doc_id, r.text) for r in left.collect()) == want
            assert 0 < bytes_moved(left) < size / 4
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
