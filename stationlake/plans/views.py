"""The tables of a lake as views, for questions asked in SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from stationlake.plans import run
from stationlake.session import path_exists

#: Layer -> its tables; a view is called ``layer_table``.
LAYERS = {
    "bronze": ("readings", "weather"),
    "silver": ("readings", "weather"),
    "gold": tuple(run.TABLES),
    "serving": tuple(run.TABLES),
}


def register_views(spark: SparkSession, lake: run.Lake) -> list[str]:
    """Make a view of every table that exists, and return their names.

    A view is the plan of its table: filters and columns of a question reach the Parquet scan.
    ``bronze_readings`` holds the well-formed rows, ``bronze_malformed`` the lines set aside.
    """
    made = []
    for layer, names in LAYERS.items():
        for name in names:
            if path_exists(spark, lake.path(layer, name)):
                _table(spark, lake, layer, name).createOrReplaceTempView(f"{layer}_{name}")
                made.append(f"{layer}_{name}")
    if "bronze_readings" in made:
        run.malformed_lines(spark, lake).createOrReplaceTempView("bronze_malformed")
        made.append("bronze_malformed")
    return made


def _table(spark: SparkSession, lake: run.Lake, layer: str, name: str) -> DataFrame:
    if (layer, name) == ("bronze", "readings"):
        return run.bronze_readings(spark, lake)
    if layer == "serving":
        return run.served(spark, lake, name)
    return spark.read.parquet(lake.path(layer, name))
