"""Tables bucketed alike, so that they join on their key without a shuffle."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame

from stationlake.session import scratch_dir

#: Buckets of a table of unknown size. A table is bucketed once for many joins: choose some hundred MB each.
BUCKETS = 64


def bucketed(df: DataFrame, keys: Sequence[str], buckets: int = BUCKETS, path: str | None = None, name: str | None = None) -> DataFrame:
    """``df`` as a table of the session's catalog, its files bucketed and sorted by ``keys``.

    Tables with the same number of buckets on the same keys join where they lie: neither side is
    shuffled. The files are written to ``path`` (the shared folder, if none is given). A key with very
    many rows makes one large bucket; add a further column to ``keys`` of both sides in that case.
    """
    name = name or f"bucketed_{uuid.uuid4().hex}"
    writer = df.repartition(buckets, *keys).write.bucketBy(buckets, *keys).sortBy(*keys)
    writer.option("path", path or scratch_dir(df.sparkSession, "bucketed")).mode("overwrite").saveAsTable(name)
    return df.sparkSession.table(name)
