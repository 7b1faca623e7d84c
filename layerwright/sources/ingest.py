"""Ingestion runs: every table of a spec, and the visits feed, into bronze."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date

from pyspark.sql import DataFrame, SparkSession

from layerwright.sources.readers import extract, visit_pages
from layerwright.sources.specs import FULL_REFRESH, Extraction, ExtractionSpec
from layerwright.sources.writers import Changed, full_refresh, replace_days, upsert

VISITS_TABLE = "raw.matomo_detailed_visits"


class IngestionFailed(Exception):
    """Some tables of a spec failed. ``done`` has what the others did, ``failed`` what went wrong, both by table."""

    def __init__(self, done: dict[str, Changed], failed: dict[str, Exception]) -> None:
        super().__init__("; ".join(f"{name}: {problem!r}" for name, problem in failed.items()))
        self.done, self.failed = done, failed


def ingest_table(table: DataFrame, spec: Extraction, run_date: date, key: str = "id") -> Changed:
    """One extraction into its bronze table; false when there was nothing to write."""
    batch = extract(table, spec, run_date)
    target = f"{spec.destination_schema}.{spec.table}"
    if spec.ingestion_type == FULL_REFRESH:
        return full_refresh(batch, target)
    return upsert(batch, target, key)


def ingest_spec(spec: ExtractionSpec, read: Callable[[Extraction], DataFrame], run_date: date,
                key: str = "id") -> dict[str, Changed]:
    """All tables of a spec, with the rows that each deleted and wrote.

    They do not depend on each other: one that fails does not stop the rest, but once all are through the run fails
    with :class:`IngestionFailed`, so that nothing is built on a table that was not refreshed. ``read`` opens a source table, for example
    with ``jdbc_table``.
    """
    done: dict[str, Changed] = {}
    failed: dict[str, Exception] = {}
    for extraction in spec.extractions:
        try:
            done[extraction.table] = ingest_table(read(extraction), extraction, run_date, key)
        except Exception as problem:
            failed[extraction.table] = problem
    if failed:
        raise IngestionFailed(done, failed)
    return done


def ingest_visits(spark: SparkSession, pages: str, table: str = VISITS_TABLE) -> Changed:
    """Landed pages of the visits feed into bronze; days that come again replace what is there."""
    return replace_days(visit_pages(spark, pages), table, "serverDate")
