"""Writers: partitioned Parquet, sorted files, and CSV export."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

from stationlake.session import delete_folder, list_names


def sorted_files(df: DataFrame, order: Sequence[str]) -> DataFrame:
    """Range-partition and sort by ``order``: files that follow each other in it.

    End ``order`` with a unique key. Range bounds can then split any frequent leading value.
    """
    return df.repartitionByRange(*order).sortWithinPartitions(*order)


def balanced_files(df: DataFrame, partition_by: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Rows of one folder brought together and sorted by ``order`` within each file.

    One shuffle and no sampling pass. Adaptive execution splits the shuffle partition of a large
    folder and merges those of small ones, so a hot month becomes many files, not one long task.
    """
    return df.hint("rebalance", *partition_by).sortWithinPartitions(*partition_by, *order)


def replace_partitions(
    df: DataFrame,
    path: str,
    partition_by: Sequence[str],
    order: Sequence[str] = (),
    counts: dict[str, Column] | None = None,
    whole_table: bool = False,
    scope: Callable[[dict[str, str]], bool] | None = None,
    lookups: Sequence[str] = (),
) -> dict[str, object]:
    """Write Parquet and replace only the partitions that occur in ``df``, or the ``whole_table``.

    ``scope`` says of the values of a partition's folder whether ``df`` stands for it too: a partition
    in scope that got no rows is removed after the write. If the driver is lost in between, the next
    run of the same scope removes it. ``counts`` are aggregates taken from the rows on their way out,
    so nothing is read back. With ``order`` the files are written by ``balanced_files``. ``lookups`` are
    columns that readers ask for single values of: they get Bloom filters, beside the statistics of
    pages and row groups that Parquet keeps of every column.
    """
    if order:
        df = balanced_files(df, partition_by, order)
    # In the writing stage each partition is counted once, even if a task is run again.
    observed = Observation()
    folder = F.concat_ws("/", *[F.concat(F.lit(f"{c}="), F.col(c).cast("string")) for c in partition_by])
    metrics = [c.alias(n) for n, c in (counts or {}).items()]
    df = df.observe(observed, F.collect_set(folder).alias("__folders"), *metrics)
    (
        df.write.mode("overwrite")
        .options(**bloom_filters(lookups))
        .option("partitionOverwriteMode", "static" if whole_table else "dynamic")
        .partitionBy(*partition_by)
        .parquet(path)
    )
    found = dict(observed.get)
    filled = set(found.pop("__folders") or ())
    if scope and not whole_table:
        for name in partition_folders(df.sparkSession, path, len(partition_by)):
            if name not in filled and scope(dict(part.split("=", 1) for part in name.split("/"))):
                delete_folder(df.sparkSession, f"{path}/{name}")
    return found


def bloom_filters(columns: Sequence[str]) -> dict[str, str]:
    """Write options: a Bloom filter for each column, as large as its distinct values ask for. A column
    chunk of few values has none: it is kept as a dictionary, which answers the same question."""
    enabled = {f"parquet.bloom.filter.enabled#{c}": "true" for c in columns}
    return enabled | ({"parquet.bloom.filter.adaptive.enabled": "true"} if columns else {})


def file_ranges(df: DataFrame, order: Sequence[str]) -> DataFrame:
    """One row per Parquet file that ``df`` reads: file, rows, lowest, highest (structs of ``order``) and
    ``follows``: whether its rows come after those of the file before it."""
    key = F.struct(*order)
    ranges = df.groupBy(F.col("_metadata.file_path").alias("file")).agg(
        F.count(F.lit(1)).alias("rows"), F.min(key).alias("lowest"), F.max(key).alias("highest")
    )
    before = F.lag("highest").over(Window.orderBy("lowest", "highest"))  # one row a file
    return ranges.withColumn("follows", F.coalesce(before < F.col("lowest"), F.lit(True)))


def partition_folders(spark: SparkSession, path: str, depth: int) -> list[str]:
    """The partition folders below ``path``, as ``a=1/b=2``."""
    names = [n for n in list_names(spark, path) if "=" in n]
    if depth == 1:
        return names
    return [f"{n}/{rest}" for n in names for rest in partition_folders(spark, f"{path}/{n}", depth - 1)]


def export_csv(df: DataFrame, path: str, null_marker: str = "\\N") -> None:
    """CSV without header for bulk loaders: NULL is ``\\N`` and an empty text is ``""``."""
    (
        df.write.mode("overwrite")
        .option("nullValue", null_marker)
        .option("emptyValue", '""')
        .option("escape", '"')
        .option("timestampFormat", "yyyy-MM-dd HH:mm:ssXXX")
        .csv(path)
    )


def as_table(df: DataFrame, columns: dict[str, str]) -> DataFrame:
    """Exactly the declared columns in order, cast to the declared types; a value that does not fit
    raises (ANSI cast)."""
    return df.select(*[F.col(name).cast(kind).alias(name) for name, kind in columns.items()])
