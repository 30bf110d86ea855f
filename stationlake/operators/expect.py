"""Expectations on a table. All expectations of one suite are measured by one aggregate."""

from __future__ import annotations

import functools
from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stationlake.errors import QualityGateFailed


Measured = Callable[[str], Column]


@dataclass(frozen=True)
class Expectation:
    """``measures`` are aggregates over the table. ``judge`` gets access to their results by name and
    returns (observed, passed)."""

    name: str
    measures: dict[str, Column]
    judge: Callable[[Measured], tuple[Column, Column]]


@dataclass
class Suite:
    name: str
    table: DataFrame
    expectations: list[Expectation] = field(default_factory=list)

    def add(self, *expectations: Expectation) -> Suite:
        self.expectations.extend(expectations)
        return self

    def results(self) -> DataFrame:
        """One row per expectation: suite, expectation, observed, passed.

        Spark computes an aggregate that several expectations need only once.
        """
        measures = [
            column.alias(f"{position}_{name}")
            for position, check in enumerate(self.expectations)
            for name, column in check.measures.items()
        ]
        verdicts = []
        for position, check in enumerate(self.expectations):
            observed, passed = check.judge(lambda name, at=position: F.col(f"{at}_{name}"))
            verdicts.append(
                F.struct(
                    F.lit(self.name).alias("suite"),
                    F.lit(check.name).alias("expectation"),
                    observed.cast("double").alias("observed"),
                    F.coalesce(passed, F.lit(False)).alias("passed"),
                )
            )
        return self.table.agg(*measures).select(F.inline(F.array(*verdicts)))


def _inside(value: Column, low: float | None, high: float | None) -> Column:
    inside = F.lit(True)
    if low is not None:
        inside = inside & (value >= F.lit(low))
    if high is not None:
        inside = inside & (value <= F.lit(high))
    return inside


def _share_of(name: str, good: Column, judged: Column, mostly: float) -> Expectation:
    """At least ``mostly`` of the judged rows are good. No judged rows: nothing contradicts it."""
    return Expectation(
        name,
        {"good": F.count_if(judged & good), "judged": F.count_if(judged)},
        lambda m: (
            m("judged") - m("good"),
            m("good") >= F.lit(float(mostly)) * m("judged"),
        ),
    )


def not_null(column: str) -> Expectation:
    name = f"not_null({column})"
    return _share_of(name, F.col(column).isNotNull(), F.lit(True), 1.0)


def between(
    column: str, low: float | None = None, high: float | None = None, mostly: float = 1.0
) -> Expectation:
    """Non-NULL values lie within the bounds, which are inclusive; either may be open."""
    value = F.col(column)
    return _share_of(f"between({column})", _inside(value, low, high), value.isNotNull(), mostly)


def in_set(column: str, allowed: Sequence[str], mostly: float = 1.0) -> Expectation:
    value = F.col(column)
    return _share_of(f"in_set({column})", value.isin(*allowed), value.isNotNull(), mostly)


def pair_at_least(
    column: str, other: str, mostly: float = 1.0, skip_null: str = "both"
) -> Expectation:
    """``column`` >= ``other``. Rows are passed over when ``both`` sides are NULL (the default), when
    ``either`` is, or ``never``; a row that is judged with a NULL in it does not hold."""
    a, b = F.col(column), F.col(other)
    judged = {
        "both": a.isNotNull() | b.isNotNull(),
        "either": a.isNotNull() & b.isNotNull(),
        "never": F.lit(True),
    }
    if skip_null not in judged:
        raise ValueError(f"skip_null is one of {', '.join(judged)}")
    holds = F.coalesce(a >= b, F.lit(False))
    return _share_of(f"pair_at_least({column},{other})", holds, judged[skip_null], mostly)


def row_count_of_grid(keys: Sequence[str], floor: float = 0.95) -> Expectation:
    """Row count lies between ``floor`` of the full key grid, rounded down, and the grid itself.

    The grid is the product of the distinct counts of ``keys``, taken from the same table.
    """

    def judge(m: Measured) -> tuple[Column, Column]:
        grid = functools.reduce(lambda a, b: a * b, [m(f"distinct_{k}") for k in keys])
        least = F.floor(grid.cast("double") * F.lit(floor))
        return m("rows"), (m("rows") >= least) & (m("rows") <= grid)

    distinct = {f"distinct_{k}": F.count_distinct(F.col(k)) for k in keys}
    return Expectation(
        f"row_count_of_grid({','.join(keys)})", {"rows": F.count(F.lit(1)), **distinct}, judge
    )


def row_count_of_source(source_rows: int, floor: float = 0.99) -> Expectation:
    """Row count lies between ``floor`` of the source table's rows, rounded down, and all of them."""
    return Expectation(
        "row_count_of_source",
        {"rows": F.count(F.lit(1))},
        lambda m: (m("rows"), m("rows").between(int(source_rows * floor), source_rows)),
    )


def match_percentage(witness: str, low: float = 99.0, high: float = 100.0) -> Expectation:
    """Percentage of rows with ``witness`` filled, two decimals, lies within the bounds. An empty
    table has no percentage, which does not fail the check."""

    def judge(m: Measured) -> tuple[Column, Column]:
        pct = F.round(F.try_divide(m("matched") * F.lit(100.0), m("rows")), 2)
        return pct, pct.isNull() | pct.between(low, high)

    measures = {"rows": F.count(F.lit(1)), "matched": F.count(F.col(witness))}
    return Expectation(f"match_percentage({witness})", measures, judge)


def report(suites: Sequence[Suite]) -> DataFrame:
    """Results of all suites as one frame."""
    return functools.reduce(DataFrame.unionByName, [s.results() for s in suites])


def gate(suites: Sequence[Suite]) -> list:
    """Measure every suite, then raise ``QualityGateFailed`` if any expectation does not hold."""
    rows = report(suites).collect()  # one row per expectation
    failed = [f"{r.suite}.{r.expectation} (observed {r.observed})" for r in rows if not r.passed]
    if failed:
        raise QualityGateFailed("; ".join(failed))
    return rows
