"""Stable digests of documents, rows and whole data sets."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def canonical_json(document: Column, volatile: Sequence[str] = ()) -> Column:
    """JSON object text with sorted keys, no spaces, and the ``volatile`` top-level keys removed."""
    entries = F.from_json(document, "map<string,variant>")
    if volatile:
        entries = F.map_filter(entries, lambda k, _: ~k.isin(*volatile))
    keys = F.array_sort(F.map_keys(entries))
    return F.to_json(F.map_from_arrays(keys, F.transform(keys, lambda k: entries[k])))


def row_digest(columns: Sequence[str]) -> Column:
    """SHA-256 of the named columns in sorted order; NULL and absent are told apart from ''."""
    cells = F.struct(*[F.col(f"`{c}`") for c in sorted(columns)])
    return F.sha2(F.to_json(cells, {"ignoreNullFields": "false"}), 256)


def dataset_fingerprint(digest: Column) -> Column:
    """Aggregate over hex digests that does not depend on row order.

    The four 64-bit parts of each digest are summed separately, as decimals, so partial sums combine on
    the map side, and repeated rows count as often as they occur. The sums are joined by dashes.
    """
    parts = [
        F.sum(F.conv(F.substring(digest, 16 * k + 1, 16), 16, 10).cast("decimal(38,0)")) for k in range(4)
    ]
    return F.concat_ws("-", *[part.cast("string") for part in parts])
