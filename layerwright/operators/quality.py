"""Data tests. Each returns the rows that break a rule; an empty result passes."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from layerwright.operators.joins import missing


def not_null(model: DataFrame, column: str) -> DataFrame:
    return model.where(F.col(column).isNull())


def unique(model: DataFrame, *columns: str) -> DataFrame:
    """Keys that occur more than once, with their number of rows."""
    keyed = model.dropna(subset=list(columns))
    counted = keyed.groupBy(*columns).agg(F.count(F.lit(1)).alias("n_records"))
    return counted.where(F.col("n_records") > 1)


def completeness(model: DataFrame, column: str, origin: DataFrame, origin_column: str,
                 model_filter: Column | None = None, origin_filter: Column | None = None,
                 parity: bool = False) -> DataFrame:
    """Origin keys (one row per origin row) that are not found in the model.

    With ``parity`` a model filter acts on the joined rows, where an absent match fails it as well:
    the test then never reports anything. Otherwise the filter selects the model rows to look in.
    """
    keys = origin if origin_filter is None else origin.where(origin_filter)
    keys = keys.where(F.col(origin_column).isNotNull()).select(origin_column)
    if model_filter is not None and parity:
        return keys.where(F.lit(False))
    found = model if model_filter is None else model.where(model_filter)
    return missing(keys, found.select(F.col(column).alias(origin_column)), [origin_column])


def referential(child: DataFrame, column: str, parent: DataFrame, parent_column: str,
                child_filter: Column | None = None, parent_filter: Column | None = None) -> DataFrame:
    """Whole child rows whose reference is not among the parents; a missing reference counts."""
    rows = child if child_filter is None else child.where(child_filter)
    keys = parent if parent_filter is None else parent.where(parent_filter)
    return missing(rows, keys.select(F.col(parent_column).alias(column)), [column])


Test = Callable[[], DataFrame]


@dataclass(frozen=True, eq=False)
class NotNull:
    """The test that a column is filled; a report makes all of one model's in one pass."""

    model: DataFrame
    column: str

    def __call__(self) -> DataFrame:
        return not_null(self.model, self.column)


def _filled(tests: Mapping[str, NotNull]) -> DataFrame:
    """Failures of the tests of one model, counted side by side."""
    model = next(iter(tests.values())).model
    counts = model.agg(*[F.count(F.when(F.col(t.column).isNull(), 1)).alias(name.replace(".", "_")) for name, t in tests.items()])
    each = [F.struct(F.lit(name).alias("test"), F.col(name.replace(".", "_")).alias("failures")) for name in tests]
    return counts.select(F.explode(F.array(*each)).alias("one")).select("one.*")


def report(tests: Mapping[str, Test]) -> DataFrame:
    """One row per test with its number of failures, as one plan: a pass for all not-null tests of a model, one for each other."""
    rows, filled = None, {}
    for name, run in tests.items():
        if isinstance(run, NotNull):
            filled.setdefault(id(run.model), {})[name] = run
            continue
        one = run().agg(F.count(F.lit(1)).alias("failures")).select(F.lit(name).alias("test"), "failures")
        rows = one if rows is None else rows.unionAll(one)
    for group in filled.values():
        rows = _filled(group) if rows is None else rows.unionAll(_filled(group))
    if rows is None:
        raise ValueError("no tests given")
    return rows


class TestsFailed(RuntimeError):
    """Raised when a model may not be published."""

    __test__ = False


def require_passed(results: DataFrame, allow: Sequence[str] = ()) -> None:
    """Raise unless every test, but for the allowed ones, found nothing."""
    failed = results.where((F.col("failures") > 0) & ~F.col("test").isin(*allow, "")).collect()
    if failed:
        raise TestsFailed(", ".join(f"{r['test']}: {r['failures']}" for r in failed))
