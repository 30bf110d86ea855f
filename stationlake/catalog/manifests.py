"""Registered queries: change detection, fingerprints, refresh scope."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stationlake.catalog.registry import registered, table
from stationlake.functions import fingerprint
from stationlake.sources import landing
from stationlake.sources.files import year_in_path

# The year of a document's folder is the number of its characters' last digit after 2015.
_PATH_SQL = """'raw/year=' || CAST(2015 + n_chars % 10 AS VARCHAR) || '/doc-'
           || CAST(doc_id AS VARCHAR) || '.csv'"""


def _listed_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = F.concat(
        F.lit("raw/year="),
        (2015 + F.col("n_chars") % 10).cast("string"),
        F.lit("/doc-"),
        F.col("doc_id").cast("string"),
        F.lit(".csv"),
    )
    return table(spark, sf_dir, "documents").select(
        path.alias("path"),
        year_in_path(path).alias("source_year"),
        F.col("n_chars").alias("length"),
        "lang",
        "text",
    )


@registered(
    "sync_plan",
    f"""WITH listing AS (
    SELECT {_PATH_SQL} AS path, CAST(2015 + n_chars % 10 AS INTEGER) AS source_year,
           n_chars AS length, lang FROM documents),
copies AS (
    SELECT path, CASE lang WHEN 'fr' THEN length + 1 ELSE length END AS copy_length
    FROM listing WHERE lang <> 'de')
SELECT path, source_year, length, source_year >= 2023 AS recent,
       COALESCE(length = copy_length, FALSE) AS same_size,
       CASE WHEN source_year < 2023 AND length = copy_length THEN 'skip' ELSE 'fetch' END AS action
FROM listing LEFT JOIN copies USING (path)""",
)
def sync_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """German documents have no copy yet, and the copies of the French ones have another size."""
    listing = _listed_documents(spark, sf_dir)
    stale = F.when(F.col("lang") == "fr", F.col("length") + 1).otherwise(F.col("length"))
    copies = listing.where(F.col("lang") != "de").select("path", stale.alias("length"))
    return landing.sync_plan(
        listing.select("path", "source_year", "length"), copies, as_of_year=2024
    )


@registered(
    "manifest_checksum",
    f"""WITH delivered AS (
    SELECT {_PATH_SQL} AS path, CAST(2015 + n_chars % 10 AS INTEGER) AS source_year, lang, text,
           sha256(text) AS sha256 FROM documents),
landed AS (
    SELECT path, sha256(CASE lang WHEN 'fr' THEN text || '.' ELSE text END) AS landed_sha256
    FROM delivered WHERE lang <> 'de')
SELECT path, source_year, sha256,
       landed_sha256,
       CASE WHEN source_year < 2023 AND landed_sha256 IS NOT NULL THEN 'frozen'
            WHEN sha256 = landed_sha256 THEN 'unchanged' ELSE 'uploaded' END AS status
FROM delivered LEFT JOIN landed USING (path)""",
)
def manifest_checksum(spark: SparkSession, sf_dir: str) -> DataFrame:
    """German documents are new and the French ones were landed with other content."""
    listing = _listed_documents(spark, sf_dir)
    delivered = listing.select(
        "path", "source_year", F.sha2(F.col("text").cast("binary"), 256).alias("sha256")
    )
    ending = F.when(F.col("lang") == "fr", ".").otherwise("")
    old_text = F.concat("text", ending)
    landed = listing.where(F.col("lang") != "de").select(
        "path", F.sha2(old_text.cast("binary"), 256).alias("sha256")
    )
    return landing.landing_plan(delivered, landed, latest_year=2024)


@registered(
    "row_fingerprint",
    f"""WITH digests AS (
    SELECT event_type,
           sha256('{{"k":' || json_extract_string(props, '$.k') || ',"type":"' || event_type || '"}}')
               AS digest
    FROM events)
SELECT event_type, COUNT(*) AS total_rows, COUNT(DISTINCT digest) AS distinct_digests,
       concat_ws('-', {", ".join(f"SUM(('0x' || substr(digest, {16 * k + 1}, 16))::UBIGINT)" for k in range(4))}) AS fingerprint
FROM digests GROUP BY event_type""",
)
def row_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Canonical JSON of each event with the volatile time removed and the keys sorted."""
    document = F.concat(
        F.lit('{"type": "'),
        F.col("event_type"),
        F.lit('", "generationtime_ms": '),
        F.second("ts").cast("string"),
        F.lit(", "),
        F.substr(F.trim("props"), F.lit(2)),
    )
    canonical = fingerprint.canonical_json(document, ["generationtime_ms"])
    digests = table(spark, sf_dir, "events").select(
        "event_type", F.sha2(canonical, 256).alias("digest")
    )
    return digests.groupBy("event_type").agg(
        F.count(F.lit(1)).alias("total_rows"),
        F.count_distinct("digest").alias("distinct_digests"),
        fingerprint.dataset_fingerprint(F.col("digest")).alias("fingerprint"),
    )


_START, _AS_OF, _LAG = dt.date(1996, 3, 1), dt.date(2001, 7, 31), 5


@registered(
    "refresh_scope",
    """WITH years AS (
    SELECT CAST(EXTRACT(YEAR FROM o_orderdate) AS INTEGER) AS source_year, COUNT(*) AS total_rows
    FROM orders GROUP BY 1),
bounds AS (
    SELECT source_year, total_rows,
           GREATEST(DATE '1996-03-01', make_date(source_year, 1, 1)) AS first_day,
           LEAST(DATE '2001-07-26', make_date(source_year, 12, 31)) AS last_day
    FROM years)
SELECT b.source_year, total_rows, first_day, last_day, b.source_year >= 2000 AS recent,
       CASE b.source_year WHEN 2001 THEN 0 WHEN 1999 THEN 1 END AS position,
       (SELECT COUNT(*) FROM orders o
        WHERE CAST(o.o_orderdate AS DATE) BETWEEN b.first_day AND b.last_day) AS rows_in_scope
FROM bounds b WHERE last_day >= first_day""",
)
def refresh_scope(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The years found in orders with their bounds, the moving head, and an explicit request."""
    order_day = F.col("o_orderdate").cast("date")
    per_day = (
        table(spark, sf_dir, "orders")
        .groupBy(order_day.alias("day"))
        .agg(F.count(F.lit(1)).alias("n"))
    )
    years = per_day.select(F.year("day").alias("source_year")).distinct()
    bounds = landing.year_bounds(years, _START, _AS_OF, _LAG)
    request = landing.years_frame(
        spark, landing.requested_years(["2001", 1999, 2001], _START.year, _AS_OF.year)
    )
    counted = (
        per_day.withColumn("source_year", F.year("day"))
        .join(bounds, "source_year")
        .groupBy("source_year", "first_day", "last_day")
        .agg(
            F.sum("n").alias("total_rows"),
            F.coalesce(
                F.sum(F.when(F.col("day").between(F.col("first_day"), F.col("last_day")), F.col("n"))),
                F.lit(0),
            ).alias("rows_in_scope"),
        )
    )
    recent = F.col("source_year").isin(*landing.refresh_years(_AS_OF, 2))
    return counted.join(request, "source_year", "left").withColumn("recent", recent)
