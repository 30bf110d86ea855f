"""Registered queries: cells, dates, reshaping, inspection."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stationlake.catalog.registry import registered, table
from stationlake.functions import cells, clock
from stationlake.operators import keys, profile
from stationlake.operators.cleaning import clean_readings, stamp
from stationlake.operators.reshape import unpivot_measures

_BALANCE_TEXT = """CASE c_mktsegment WHEN 'BUILDING' THEN 'bad-value' WHEN 'MACHINERY' THEN ''
                 ELSE CAST(c_acctbal AS VARCHAR) END"""


def _balances(spark: SparkSession, sf_dir: str) -> DataFrame:
    segment = F.col("c_mktsegment")
    text = (
        F.when(segment == "BUILDING", F.lit("bad-value"))
        .when(segment == "MACHINERY", F.lit(""))
        .otherwise(F.col("c_acctbal").cast("string"))
    )
    return table(spark, sf_dir, "customer").select("c_custkey", text.alias("cell"))


@registered(
    "clean_negative_null",
    f"""SELECT c_custkey, if(number >= 0, number, NULL) AS value
FROM (SELECT c_custkey, TRY_CAST({_BALANCE_TEXT} AS DOUBLE) AS number FROM customer)""",
)
def clean_negative_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean_readings(_balances(spark, sf_dir))


@registered(
    "clean_null_tokens",
    """WITH flags AS (
    SELECT l_shipdate,
           CASE l_returnflag WHEN 'N' THEN 'N/A' WHEN 'A' THEN 'NA' ELSE l_returnflag END AS flag,
           CASE l_linestatus WHEN 'O' THEN ' ' ELSE l_linestatus END AS status,
           CASE WHEN l_tax = 0 THEN '' ELSE CAST(l_tax AS VARCHAR) END AS tax
    FROM lineitem),
cleaned AS (
    SELECT l_shipdate,
           CASE WHEN flag NOT IN ('', ' ', 'NA', 'N/A') THEN flag END AS flag,
           CASE WHEN status NOT IN ('', ' ', 'NA', 'N/A') THEN status END AS status,
           CASE WHEN tax NOT IN ('', ' ', 'NA', 'N/A') THEN tax END AS tax
    FROM flags)
SELECT CAST(l_shipdate AS DATE) AS ship_date, flag, COUNT(*) AS total_rows,
       COUNT(status) AS statuses, COUNT(tax) AS taxes
FROM cleaned GROUP BY 1, 2""",
)
def clean_null_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    flag, status, tax = F.col("l_returnflag"), F.col("l_linestatus"), F.col("l_tax")
    raw = table(spark, sf_dir, "lineitem").select(
        F.col("l_shipdate").cast("date").alias("ship_date"),
        F.when(flag == "N", "N/A").when(flag == "A", "NA").otherwise(flag).alias("flag"),
        F.when(status == "O", " ").otherwise(status).alias("status"),
        F.when(tax == 0, "").otherwise(tax.cast("string")).alias("tax"),
    )
    cleaned = raw.select(
        "ship_date",
        *[cells.blank_tokens_to_null(F.col(c)).alias(c) for c in ("flag", "status", "tax")],
    )
    return cleaned.groupBy("ship_date", "flag").agg(
        F.count(F.lit(1)).alias("total_rows"),
        F.count("status").alias("statuses"),
        F.count("tax").alias("taxes"),
    )


@registered(
    "filter_nonblank",
    """SELECT o_orderkey, cell FROM (
    SELECT o_orderkey, CASE o_orderpriority WHEN '4-NOT SPECIFIED' THEN '  ' WHEN '5-LOW' THEN NULL
                       ELSE o_orderpriority END AS cell
    FROM orders)
WHERE cell IS NOT NULL AND TRIM(cell) <> ''""",
)
def filter_nonblank(spark: SparkSession, sf_dir: str) -> DataFrame:
    priority = F.col("o_orderpriority")
    cell = F.when(priority == "4-NOT SPECIFIED", F.lit("  ")).when(
        priority != "5-LOW", priority
    )
    rows = table(spark, sf_dir, "orders").select("o_orderkey", cell.alias("cell"))
    return rows.where(cells.is_nonblank(F.col("cell")))


_DATE_TEXT_SQL = """CASE o_orderpriority
        WHEN '1-URGENT' THEN strftime(o_orderdate, '%Y-%m-%d')
        WHEN '2-HIGH' THEN strftime(o_orderdate, '%-d/%-m/%Y')
        WHEN '3-MEDIUM' THEN strftime(o_orderdate, '%d-%m-%Y')
        WHEN '4-NOT SPECIFIED' THEN ' ' || strftime(o_orderdate, '%Y-%m-%d %H:%M:%S')
        ELSE 'not a date' END"""

_PARSED_DATE_SQL = """CAST(try_strptime(trim(date_text),
                ['%Y-%m-%d', '%d/%m/%Y', '%d-%m-%Y', '%Y-%m-%d %H:%M:%S']) AS DATE)"""


def _dated_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    priority, date = F.col("o_orderpriority"), F.col("o_orderdate")
    text = (
        F.when(priority == "1-URGENT", F.date_format(date, "yyyy-MM-dd"))
        .when(priority == "2-HIGH", F.date_format(date, "d/M/yyyy"))
        .when(priority == "3-MEDIUM", F.date_format(date, "dd-MM-yyyy"))
        .when(
            priority == "4-NOT SPECIFIED",
            F.concat(F.lit(" "), F.date_format(date, "yyyy-MM-dd HH:mm:ss")),
        )
        .otherwise("not a date")
    )
    hour = (F.col("o_custkey") % 25).cast("int")
    clock_text = F.concat(
        F.format_string("%02d:00", hour),
        F.when(F.col("o_orderstatus") == "F", ":00").otherwise(""),
    )
    return table(spark, sf_dir, "orders").select(
        "o_orderkey", text.alias("date_text"), clock_text.alias("time_text")
    )


@registered(
    "parse_date_formats",
    f"""SELECT o_orderkey, {_PARSED_DATE_SQL} AS parsed
FROM (SELECT o_orderkey, {_DATE_TEXT_SQL} AS date_text FROM orders)""",
)
def parse_date_formats(spark: SparkSession, sf_dir: str) -> DataFrame:
    parsed = clock.parse_date(F.col("date_text"))
    return _dated_orders(spark, sf_dir).select("o_orderkey", parsed.alias("parsed"))


@registered(
    "ts_midnight_rollover",
    f"""WITH texts AS (
    SELECT o_orderkey, {_DATE_TEXT_SQL} AS date_text,
           lpad(CAST(o_custkey % 25 AS VARCHAR), 2, '0') || ':00'
           || CASE o_orderstatus WHEN 'F' THEN ':00' ELSE '' END AS time_text
    FROM orders),
parsed AS (SELECT o_orderkey, time_text, {_PARSED_DATE_SQL} AS day FROM texts)
SELECT o_orderkey, CAST(day AS TIMESTAMP) + to_hours(CAST(left(time_text, 2) AS BIGINT)) AS recorded_at
FROM parsed WHERE day IS NOT NULL""",
)
def ts_midnight_rollover(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders without a readable date have no timestamp and drop out."""
    stamped = stamp(_dated_orders(spark, sf_dir), "date_text", "time_text")
    return stamped.select("o_orderkey", "recorded_at")


_LINE_MEASURES = {
    "l_quantity": "quantity",
    "l_extendedprice": "price",
    "l_discount": "discount",
    "l_tax": "tax",
}


@registered(
    "unpivot_long",
    "WITH long AS ("
    + " UNION ALL ".join(
        f"SELECT l_shipdate, '{code}' AS measure, "
        f"CASE WHEN l_returnflag <> 'N' THEN {raw} END AS value FROM lineitem"
        for raw, code in _LINE_MEASURES.items()
    )
    + """)
SELECT CAST(l_shipdate AS DATE) AS ship_date, measure, COUNT(*) AS total_rows,
       COUNT(value) AS valid_readings, MIN(value) AS min_value, MAX(value) AS max_value,
       ROUND(SUM(value), 4) AS total
FROM long GROUP BY 1, 2""",
)
def unpivot_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem")
    kept = [
        F.when(F.col("l_returnflag") != "N", F.col(raw)).alias(raw) for raw in _LINE_MEASURES
    ]
    wide = lines.select(F.col("l_shipdate").cast("date").alias("ship_date"), *kept)
    long = unpivot_measures(wide, ["ship_date"], _LINE_MEASURES, name_column="measure")
    return long.groupBy("ship_date", "measure").agg(
        F.count(F.lit(1)).alias("total_rows"),
        F.count("value").alias("valid_readings"),
        F.min("value").alias("min_value"),
        F.max("value").alias("max_value"),
        F.round(F.sum("value"), 4).alias("total"),
    )


@registered(
    "duplicate_keys",
    """SELECT l_orderkey, l_linenumber, COUNT(*) AS row_count
FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING COUNT(*) > 1""",
)
def duplicate_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return keys.duplicate_keys(table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])


@registered(
    "raw_profile",
    """WITH per_key AS (
    SELECT CAST(EXTRACT(YEAR FROM l_shipdate) AS INTEGER) AS source_year, l_orderkey, l_linenumber,
           COUNT(*) AS n, SUM(CASE WHEN l_quantity = 24 THEN 1 ELSE 0 END) AS n_flagged
    FROM lineitem GROUP BY 1, 2, 3)
SELECT source_year, CAST(SUM(n) AS BIGINT) AS total_rows, COUNT(*) AS distinct_keys,
       SUM(CASE WHEN n > 1 THEN 1 ELSE 0 END)::BIGINT AS duplicated_keys,
       CAST(SUM(n_flagged) AS BIGINT) AS flagged_rows, 'l_time' AS missing_columns
FROM per_key GROUP BY source_year""",
)
def raw_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem")
    expected = ["l_orderkey", "l_linenumber", "l_time"]
    absent = ",".join(c for c in expected if c not in lines.columns)
    return profile.key_profile(
        lines.withColumn("source_year", F.year("l_shipdate")),
        ["l_orderkey", "l_linenumber"],
        F.col("l_quantity") == 24,
        by=["source_year"],
    ).withColumn("missing_columns", F.lit(absent))


def _text_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_linestatus"),
        F.when(F.col("l_returnflag") == "N", "bad-value")
        .otherwise(F.col("l_quantity").cast("string"))
        .alias("quantity"),
        F.when(F.col("l_linestatus") == "F", -F.col("l_discount"))
        .otherwise(F.col("l_discount"))
        .cast("string")
        .alias("discount"),
        F.col("l_orderkey").cast("string").alias("orderkey"),
        F.col("l_shipdate").cast("date").cast("string").alias("shipdate"),
        F.when(F.col("l_tax") > 0, F.col("l_tax").cast("string")).alias("tax"),
    )


_TEXT_LINES_SQL = """text_lines AS (
    SELECT l_linestatus,
           CASE l_returnflag WHEN 'N' THEN 'bad-value' ELSE CAST(l_quantity AS VARCHAR) END AS quantity,
           CAST(CASE l_linestatus WHEN 'F' THEN -l_discount ELSE l_discount END AS VARCHAR) AS discount,
           CAST(l_orderkey AS VARCHAR) AS orderkey,
           CAST(CAST(l_shipdate AS DATE) AS VARCHAR) AS shipdate,
           CASE WHEN l_tax > 0 THEN CAST(l_tax AS VARCHAR) END AS tax
    FROM lineitem)"""


def _each_column(columns: list[str]) -> str:
    return " UNION ALL ".join(
        f"SELECT l_linestatus, '{c}' AS column_name, {c} AS cell FROM text_lines" for c in columns
    )


@registered(
    "column_profile",
    f"""WITH {_TEXT_LINES_SQL}, cells AS ({_each_column(["quantity", "discount", "tax"])})
SELECT l_linestatus, column_name, COUNT(*) AS total_rows, COUNT(*) FILTER (good) AS valid_readings,
       COUNT(*) FILTER (NOT good) AS missing_readings, COUNT(*) FILTER (good AND number < 0) AS negative_readings,
       MIN(number) AS min_value, MAX(number) AS max_value
FROM (SELECT *, TRY_CAST(cell AS DOUBLE) AS number, number IS NOT NULL AS good FROM cells)
GROUP BY l_linestatus, column_name""",
)
def column_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.numeric_profile(
        _text_lines(spark, sf_dir), ["quantity", "discount", "tax", "absent"], by=["l_linestatus"]
    )


@registered(
    "infer_types",
    f"""WITH {_TEXT_LINES_SQL},
cells AS ({_each_column(["quantity", "discount", "orderkey", "shipdate", "tax"])}),
counted AS (
    SELECT column_name, COUNT(cell) AS filled_cells,
           COUNT(CASE WHEN regexp_full_match(cell, '[+-]?[0-9]+') THEN 1 END) AS bigint_cells,
           COUNT(TRY_CAST(cell AS DOUBLE)) AS double_cells,
           COUNT(CASE WHEN regexp_full_match(cell, '[0-9]{{4}}-[0-9]{{1,2}}-[0-9]{{1,2}}')
                      THEN TRY_CAST(cell AS DATE) END) AS date_cells
    FROM cells GROUP BY column_name)
SELECT *, CASE WHEN filled_cells = 0 THEN 'VARCHAR' WHEN bigint_cells = filled_cells THEN 'BIGINT'
               WHEN double_cells = filled_cells THEN 'DOUBLE'
               WHEN date_cells = filled_cells THEN 'DATE' ELSE 'VARCHAR' END AS suggested_type
FROM counted""",
)
def infer_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.inferred_types(
        _text_lines(spark, sf_dir), ["quantity", "discount", "orderkey", "shipdate", "tax"]
    )
