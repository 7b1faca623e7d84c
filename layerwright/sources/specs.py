"""Extraction specs: which tables to take, how, and without which columns."""

from __future__ import annotations

import json
import re
from dataclasses import dataclass, field
from datetime import date, timedelta
from pathlib import Path

FULL_REFRESH = "full_refresh"
INCREMENTAL = "incremental"


@dataclass(frozen=True)
class Extraction:
    """One table of a spec."""

    table: str
    ingestion_type: str
    extraction_schema: str = "public"
    destination_schema: str = "raw"
    incremental_filter: str | None = None
    exclude_columns: tuple[str, ...] = ()

    def __post_init__(self) -> None:
        if self.ingestion_type not in (FULL_REFRESH, INCREMENTAL):
            raise ValueError(f"{self.table}: unknown ingestion type {self.ingestion_type}")
        if self.ingestion_type == INCREMENTAL and not self.incremental_filter:
            raise ValueError(f"{self.table}: an incremental extraction needs a filter")

    def predicate(self, run_date: date) -> str | None:
        """The filter with the run date filled in."""
        if self.ingestion_type == FULL_REFRESH:
            return None
        return fill_run_date(self.incremental_filter, run_date)


@dataclass(frozen=True)
class ExtractionSpec:
    """A source with its tables."""

    name: str
    extractions: tuple[Extraction, ...]
    origin_db_connection: str = ""
    destination_db_connection: str = ""
    catchup: bool = False
    start_date: date | None = None
    by_table: dict[str, Extraction] = field(init=False, repr=False, compare=False, default_factory=dict)

    def __post_init__(self) -> None:
        self.by_table.update({e.table: e for e in self.extractions})


_RUN_DATE = re.compile(r"\{\{\s*(?:ds|macros\.ds_add\(\s*ds\s*,\s*(-?\d+)\s*\))\s*\}\}")


def fill_run_date(template: str, run_date: date) -> str:
    """Replace ``{{ ds }}`` and ``{{ macros.ds_add(ds, n) }}`` by dates."""
    filled = _RUN_DATE.sub(lambda m: (run_date + timedelta(days=int(m.group(1) or 0))).isoformat(), template)
    if "{{" in filled:
        raise ValueError(f"unknown template in filter: {filled}")
    return filled


def parse_spec(config: dict) -> ExtractionSpec:
    tables = tuple(
        Extraction(
            table=name,
            ingestion_type=info["ingestion_type"],
            extraction_schema=info.get("extraction_schema", "public"),
            destination_schema=info.get("destination_schema", "raw"),
            incremental_filter=info.get("incremental_filter"),
            exclude_columns=tuple(info.get("exclude_columns", ())),
        )
        for name, info in config["extractions"].items()
    )
    start = config.get("start_date")
    return ExtractionSpec(
        name=config["name"],
        extractions=tables,
        origin_db_connection=config.get("origin_db_connection", ""),
        destination_db_connection=config.get("destination_db_connection", ""),
        catchup=bool(config.get("catchup", False)),
        start_date=date.fromisoformat(start) if start else None,
    )


def load_specs(folder: str | Path) -> list[ExtractionSpec]:
    """All JSON specs of a folder, by file name."""
    return [parse_spec(json.loads(p.read_text(encoding="utf-8"))) for p in sorted(Path(folder).glob("*.json"))]
