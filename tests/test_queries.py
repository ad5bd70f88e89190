"""Every registered query against DuckDB, and rules that hold for all of them."""

import re
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT / "tools"))

from check import compare, connect  # noqa: E402

from __spark_entry__ import entry, oracle_sql, queries  # noqa: E402

from workload import QUERIES  # noqa: E402

SF = "/root/testdata/sf0.001"
# Ids of the operator inventory: letter and highest number.
INVENTORY = {"a": 16, "b": 12, "c": 11, "s": 17, "d": 7, "e": 7, "f": 11, "g": 3, "h": 5, "i": 2, "j": 8, "k": 3, "l": 17, "m": 4}


@pytest.fixture(scope="module")
def duck():
    return connect(SF)


@pytest.mark.parametrize("name", sorted(QUERIES))  # the text operators have tests of their own
def test_matches_duckdb(spark, duck, name):
    got = queries()[name](spark, SF).toPandas()
    assert name in oracle_sql()
    assert compare(got, duck.execute(oracle_sql()[name]).df()) is None


def test_every_operator_has_a_query():
    ids = {n.split("_")[0] for n in queries()}
    wanted = {f"{letter}{i}" for letter, top in INVENTORY.items() for i in range(1, top + 1)}
    assert wanted <= ids, sorted(wanted - ids)


def test_entry(spark):
    assert entry(spark).count() == 1


@pytest.mark.parametrize("name", ["d4_records_children", "e1_enrich_latest", "e4_combine_one_row", "l8_recon_metrics_long", "k1_quality_parent_child"])
def test_no_cartesian_product(spark, name):
    plan = queries()[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan


def test_no_python_row_functions_and_no_local_checkpoints():
    banned = re.compile(r"localCheckpoint|\budf\(|pandas_udf|\.rdd\b|\.toPandas\(")
    for path in (ROOT / "landfall").rglob("*.py"):
        assert not banned.search(path.read_text()), path
