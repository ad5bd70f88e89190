"""Run queries on Spark and their SQL counterparts on DuckDB and compare the values.

    python tools/check.py [sf_dir] [name prefix ...]
"""

from __future__ import annotations

import sys
import tempfile
import time
import traceback
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

import duckdb  # noqa: E402
import pandas as pd  # noqa: E402
from pyspark.sql import SparkSession  # noqa: E402

SCRATCH = tempfile.TemporaryDirectory(prefix="landfall-check-", ignore_cleanup_errors=True)  # goes when the process ends
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def session(cores: str = "8", partitions: str = "8") -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .config("spark.sql.shuffle.partitions", partitions)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .config("spark.checkpoint.dir", SCRATCH.name)
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def connect(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def canonical(pdf: pd.DataFrame) -> list[tuple]:
    def cell(v):
        if v is None or (not hasattr(v, "__len__") and pd.isna(v)):
            return "∅"
        if isinstance(v, float):
            return f"{v:.9g}"
        if isinstance(v, pd.Timestamp):
            return v.isoformat()
        return str(v)

    pdf = pdf[sorted(pdf.columns)]
    return sorted(tuple(cell(v) for v in row) for row in pdf.astype(object).itertuples(index=False, name=None))


def compare(got: pd.DataFrame, want: pd.DataFrame) -> str | None:
    if sorted(got.columns) != sorted(want.columns):
        return f"columns {sorted(got.columns)} expected {sorted(want.columns)}"
    # pandas shows a whole-number column with nulls as floats, unless its type allows for nulls
    nullable = {c: "Int64" for c in got.columns if str(want[c].dtype).startswith("Int") and got[c].dtype.kind == "f"}
    got = got.astype(nullable)
    a, b = canonical(got), canonical(want)
    if a != b:
        ours, theirs = set(a), set(b)
        extra, lacking = [r for r in a if r not in theirs][:2], [r for r in b if r not in ours][:2]
        return f"rows {len(a)} expected {len(b)}; only spark {extra}; only sql {lacking}"
    kinds = {
        c: (str(got[c].dtype), str(want[c].dtype))
        for c in got.columns
        if got[c].dtype.kind != want[c].dtype.kind and "O" not in (got[c].dtype.kind, want[c].dtype.kind)
    }
    return f"types {kinds}" if kinds else None


def main():
    args = sys.argv[1:]
    sf_dir = args.pop(0) if args and args[0].startswith("/") else "/root/testdata/sf0.01"
    from workload import ORACLES, QUERIES

    spark, con, bad = session(), connect(sf_dir), 0
    names = [n for n in QUERIES if not args or any(n.startswith(a) for a in args)]
    for name in names:
        start = time.time()
        try:
            got = QUERIES[name](spark, sf_dir).toPandas()
            took = time.time() - start
            problem = compare(got, con.execute(ORACLES[name]).df()) if name in ORACLES else None
        except Exception as exc:  # report and go on with the next query
            took, problem, got = time.time() - start, f"{type(exc).__name__}: {str(exc)[:700]}", []
            if "-v" in sys.argv:
                traceback.print_exc()
        bad += problem is not None
        note = "" if name in ORACLES else " (rows only)"
        print(f"{'FAIL' if problem else 'ok  '} {name:34s} {len(got):7d} rows {took:6.2f}s{note} {problem or ''}", flush=True)
    print(f"{len(names)} queries, {bad} failed")
    sys.exit(bool(bad))


if __name__ == "__main__":
    main()
