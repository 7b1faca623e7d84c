"""Compare registered queries with their SQL: ``python tests/check.py [sf] [name part ...]``."""

from __future__ import annotations

import sys
import tempfile
import time
import traceback
from pathlib import Path

ROOT = Path(__file__).resolve().parent.parent
sys.path[:0] = [str(ROOT), str(ROOT / "tests")]

import oracle  # noqa: E402
from layerwright.acceptance import catalog  # noqa: E402
from layerwright.session import build_session  # noqa: E402


def main() -> int:
    with tempfile.TemporaryDirectory(prefix="check-") as work:
        return compare(work)


def compare(work: str) -> int:
    sf = sys.argv[1] if len(sys.argv) > 1 else "0.01"
    parts = sys.argv[2:]
    sf_dir = f"/root/testdata/sf{sf}"
    spark = build_session("check", "local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.driver.memory": "12g",
                             "spark.ui.showConsoleProgress": "false", "spark.checkpoint.dir": f"{work}/shared",
                             "spark.sql.warehouse.dir": f"{work}/warehouse"})
    spark.sparkContext.setLogLevel("ERROR")
    con = oracle.connect(sf_dir)
    failed = 0
    for name, query in catalog.QUERIES.items():
        if parts and not any(p in name for p in parts):
            continue
        start = time.time()
        built = ran = -1.0
        try:
            df = query(spark, sf_dir)
            built = time.time() - start
            df.write.format("noop").mode("overwrite").save()
            ran = time.time() - start
            if name in catalog.SQL:
                bad = oracle.differences(df, con, catalog.SQL[name])
                rows = con.execute(f"SELECT count(*) FROM ({catalog.SQL[name]})").fetchone()[0]
            else:
                bad, rows = [], df.count()
        except Exception:
            con = oracle.connect(sf_dir)  # an internal error of the database makes it unusable
            bad, rows = [traceback.format_exc(limit=-2)[-600:]], -1
        failed += bool(bad)
        kind = "" if name in catalog.SQL else " (no SQL)"
        print(f"{'FAIL' if bad else 'ok  '} {name} {rows} rows build {built:.1f}s, run {ran:.1f}s, all {time.time() - start:.1f}s{kind}", flush=True)
        for line in bad:
            print("     ", line)
    return failed


if __name__ == "__main__":
    sys.exit(main())
