"""Session settings and the folder shared by all executors."""

from __future__ import annotations

import tempfile
import threading
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

SCRATCH_SETTING = "spark.checkpoint.dir"


def local_session(cores: int = 8, app: str = "stationlake", memory: str = "8g") -> SparkSession:
    """A session for tests and the bench. On a cluster the session comes from the caller."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", memory)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", str(cores))
        .config("spark.sql.adaptive.enabled", "true")
        # Local tables are small: aim at partitions that keep all cores busy when writing.
        .config("spark.sql.adaptive.advisoryPartitionSizeInBytes", "1m")
        # Call-site capture costs more than planning when a plan has hundreds of columns.
        .config("spark.sql.dataFrameQueryContext.enabled", "false")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


#: Application -> scratch folder of a local session without the setting.
_LOCAL_SCRATCH: dict[str, str] = {}


def scratch_dir(spark: SparkSession, purpose: str) -> str:
    """A new, unused folder path under the shared folder named by ``spark.checkpoint.dir``.

    Only a local session may fall back to a folder of this machine: executors of a cluster would
    not see it, and a lost executor would take its files along.
    """
    root = spark.conf.get(SCRATCH_SETTING, None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError(f"set {SCRATCH_SETTING} to a folder every executor can reach")
        application = spark.sparkContext.applicationId
        if application not in _LOCAL_SCRATCH:
            _LOCAL_SCRATCH[application] = tempfile.mkdtemp(prefix="stationlake-")
        root = _LOCAL_SCRATCH[application]
    return f"{root.rstrip('/')}/stationlake/{purpose}-{uuid.uuid4().hex}"


def stored(df: DataFrame, purpose: str) -> DataFrame:
    """``df`` as a table in the shared folder: computed once, and readable after an executor is lost."""
    path = scratch_dir(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


#: Most tasks that list the folders below a path. Spark starts one a folder, up to 10,000.
_LISTING_SETTING = "spark.sql.sources.parallelPartitionDiscovery.parallelism"
_listing = threading.Lock()


@contextmanager
def few_listing_tasks(spark: SparkSession) -> Iterator[None]:
    """What is loaded inside is listed by a few tasks a core, each with many folders; the setting of the
    session is put back. Threads of one session list one after the other."""
    with _listing:
        before = spark.conf.get(_LISTING_SETTING)
        spark.conf.set(_LISTING_SETTING, str(min(int(before), 4 * spark.sparkContext.defaultParallelism)))
        try:
            yield
        finally:
            spark.conf.set(_LISTING_SETTING, before)


def _located(spark: SparkSession, path: str):
    location = spark._jvm.org.apache.hadoop.fs.Path(path)
    return location.getFileSystem(spark._jsc.hadoopConfiguration()), location


def path_exists(spark: SparkSession, path: str) -> bool:
    """True when a file or folder is there, on whatever file system the path names."""
    files, location = _located(spark, path)
    return files.exists(location)


def list_names(spark: SparkSession, path: str) -> list[str]:
    """Names of what lies directly in a folder, sorted; none if it does not exist."""
    files, location = _located(spark, path)
    if not files.exists(location):
        return []
    return sorted(status.getPath().getName() for status in files.listStatus(location))


def delete_folder(spark: SparkSession, path: str) -> None:
    """Delete a file, or a folder with all in it."""
    files, location = _located(spark, path)
    files.delete(location, True)
