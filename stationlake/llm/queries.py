"""The operators as registered queries: each over its whole table, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def _query(function):
    QUERIES[function.__name__] = function
    return function


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@_query
def op1_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    from stationlake.llm.simhash import simhash_groups

    return simhash_groups(_table(spark, sf_dir, "documents"), shingle=4, distance=4)


@_query
def op6_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    from stationlake.llm.sharding import shard_documents

    placed = shard_documents(_table(spark, sf_dir, "documents"), shards=8)
    return placed.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


@_query
def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from stationlake.llm.packing import pack_documents

    return pack_documents(_table(spark, sf_dir, "documents"), limit=2048, vocabulary="word_bpe_49k.json")


@_query
def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    from stationlake.llm.toxicity import score_documents

    return score_documents(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


@_query
def op5_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    from stationlake.llm import langid

    docs = _table(spark, sf_dir, "documents")
    found = langid.identify(docs.select("doc_id", "text"), langid.fit_documents(docs), with_spans=False)
    return found.select("doc_id", langid.held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")


@_query
def op2_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    from stationlake.llm.ann import nearest

    found = nearest(_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, k=5)
    return found.select("query_id", "rank", "vec_id", "score")


@_query
def op4_suffix_array(spark: SparkSession, sf_dir: str) -> DataFrame:
    from stationlake.llm.passages import remove_repeats

    return remove_repeats(_table(spark, sf_dir, "documents"), length=100, content=False)


@_query
def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines with words, similar different lines of those (links), and the lines that go."""
    from stationlake.llm.linededup import line_report

    return line_report(_table(spark, sf_dir, "documents"), threshold=0.8)


@_query
def op8_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs of words of each text, the words that go, and the documents that hold the ones kept in their place."""
    from stationlake.llm.paragraphs import passage_report

    docs = _table(spark, sf_dir, "documents")
    return passage_report(docs, least=50, run=20, shingle=5, threshold=0.8, every_window=True)


@_query
def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    from stationlake.llm.decontam import find_leaks

    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    found = find_leaks(docs, _table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "contaminated", F.col("leaks.item_id").alias("item_ids"), F.array_max("leaks.shared").alias("shared"))


@_query
def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    from stationlake.llm.whitening import whiten

    return whiten(_table(spark, sf_dir, "embeddings"), components=4)


@_query
def op12_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from stationlake.llm.mixing import mix_documents

    mixed = mix_documents(_table(spark, sf_dir, "documents"), weights=(5, 2, 1), ceiling=3, seed=42)
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


# The level of the shares is the greatest of those that fill up some sources, the fullest first.
SQL["op12_mixing"] = r"""
WITH docs AS (
    SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size,
           sha256('42:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS key
    FROM documents
), weighed AS (
    SELECT source, CAST(sum(size) AS BIGINT) AS words, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS rank
    FROM docs GROUP BY source
), cycled AS (
    SELECT *, CASE rank % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS weight FROM weighed
), filling AS (
    SELECT *, sum(words) OVER () - coalesce(sum(3 * words) OVER before, 0) AS words_left,
           sum(weight) OVER () - coalesce(sum(weight) OVER before, 0) AS weight_left
    FROM cycled
    WINDOW before AS (ORDER BY words / weight, rank ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), levels AS (
    SELECT max(CAST(words_left AS DOUBLE) / CAST(weight_left AS DOUBLE)) AS level FROM filling
), sources AS (
    SELECT source, words, rank, greatest(1, least(256, words // 1000)) AS block,
           CASE WHEN 3 * words < level * weight THEN CAST(3 * words AS DOUBLE) ELSE level * weight END AS target
    FROM cycled, levels
), streams AS (
    SELECT d.doc_id, d.size, s.words, s.rank, s.block, s.target, s.target / greatest(s.words, 1) AS rate,
           CAST(sum(d.size) OVER (PARTITION BY s.rank ORDER BY d.key, d.doc_id, d.size ROWS UNBOUNDED PRECEDING) AS BIGINT) AS hi,
           row_number() OVER () AS row
    FROM docs d JOIN sources s ON d.source IS NOT DISTINCT FROM s.source
), ends AS (
    SELECT *, hi - size AS place, 'lo' AS side FROM streams UNION ALL SELECT *, hi AS place, 'hi' AS side FROM streams
), blocks AS (
    SELECT *, greatest(place - 1, 0) // block AS i, greatest(place - 1, 0) // block // 64 AS shard FROM ends
), shards AS (
    SELECT *, shard * 64 * block AS first, least(words, (shard + 1) * 64 * block) AS stop FROM blocks
), won AS (
    SELECT *, CAST(floor(rate * (first / block) + 0.5) AS BIGINT) AS earlier,
           CAST(floor(rate * (stop / block) + 0.5) AS BIGINT) - CAST(floor(rate * (first / block) + 0.5) AS BIGINT) AS quota,
           greatest(1, CAST(ceil((stop - first) / block) AS BIGINT)) AS n
    FROM shards
), started AS (
    SELECT *, CAST('0x' || sha256('42:' || rank || ':' || shard)[1:8] AS BIGINT) % n AS u, i - shard * 64 AS k FROM won
), cut AS (
    SELECT row, side, CASE WHEN place = 0 THEN 0 ELSE
               (earlier + (k + u) * quota // n - u * quota // n) * block
               + (place - i * block) * ((k + u + 1) * quota // n - (k + u) * quota // n) END AS until
    FROM started
)
SELECT s.doc_id, CAST(s.size AS BIGINT) AS size, s.words AS source_size, s.target,
       CAST(b.until - a.until AS BIGINT) AS taken
FROM streams s JOIN cut a ON a.row = s.row AND a.side = 'lo' JOIN cut b ON b.row = s.row AND b.side = 'hi'
"""


@_query
def op13_infill(spark: SparkSession, sf_dir: str) -> DataFrame:
    from stationlake.llm.infill import fill_in_middle, restored

    found = restored(fill_in_middle(_table(spark, sf_dir, "documents"), seed=42, rate=50, spm=80))
    digests = (F.sha2(F.col(name).cast("binary"), 256) for name in ("output", "text"))
    names = ("output_sha256", "restored_sha256")
    return found.select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars", *(d.alias(n) for d, n in zip(digests, names))
    )


SQL["op13_infill"] = r"""
WITH cut AS (
    SELECT doc_id, coalesce(text, '') AS body,
           regexp_extract_all(coalesce(text, ''), '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+') AS tokens,
           sha256('42:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS hex
    FROM documents
), drawn AS (
    SELECT doc_id, body, tokens, len(tokens) AS n,
           CAST('0x' || hex[1:8] AS BIGINT) % (len(tokens) + 1) AS one,
           CAST('0x' || hex[9:16] AS BIGINT) % (len(tokens) + 1) AS two,
           CASE WHEN body = '' OR regexp_matches(body, '<[PSM]>') OR CAST('0x' || hex[17:24] AS BIGINT) % 100 >= 50
                THEN 'plain' WHEN CAST('0x' || hex[25:32] AS BIGINT) % 100 < 80 THEN 'spm' ELSE 'psm' END AS form
    FROM cut
), parted AS (
    SELECT doc_id, body, n, form,
           array_to_string(tokens[1:least(one, two)], '') AS prefix,
           array_to_string(tokens[least(one, two) + 1:greatest(one, two)], '') AS middle,
           array_to_string(tokens[greatest(one, two) + 1:], '') AS suffix
    FROM drawn
)
SELECT doc_id, n, form,
       CASE WHEN form <> 'plain' THEN length(prefix) END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN length(middle) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN body
                        WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
                        ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
       sha256(body) AS restored_sha256
FROM parted
"""


@_query
def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)
