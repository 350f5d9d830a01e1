"""What the plans must not do, whatever the size of the tables."""

from __future__ import annotations

import ast
import re
from pathlib import Path

import pytest

import __spark_entry__ as spine

ROOT = "/root/testdata/sf0.001"
QUERIES = spine.queries()
PLAIN = sorted(
    k for k in QUERIES if not re.match(r"(mod|tun|ens_stack|met_runs|nst_|stream|study|snk|src|clv_gamma_gamma_fit)", k)
)


def plan(spark, key):
    return QUERIES[key](spark, ROOT)._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def no_broadcast(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield spark
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


@pytest.mark.parametrize("key", PLAIN)
def test_no_pairing_of_all_rows(no_broadcast, key):
    text = plan(no_broadcast, key)
    assert "CartesianProduct" not in text and "NestedLoop" not in text


@pytest.mark.parametrize(
    "key, wanted",
    [
        ("agg_group", {"l_quantity", "l_extendedprice", "l_returnflag", "l_linestatus"}),
        ("agg_count", {"o_custkey"}),
        ("prj_rename", {"c_custkey", "c_name", "c_mktsegment"}),
        ("clv_cbs", {"o_custkey", "o_orderdate", "o_totalprice"}),
    ],
)
def test_scans_read_only_the_columns_used(spark, key, wanted):
    schemas = re.findall(r"ReadSchema: struct<([^>]*)>", plan(spark, key))
    assert schemas and all({c.split(":")[0] for c in s.split(",")} <= wanted for s in schemas)


@pytest.mark.parametrize(
    "key, column", [("jon_semi", "o_orderdate"), ("clv_cbs", "o_orderdate"), ("flt_compare", "l_quantity")]
)
def test_filters_reach_the_scan(spark, key, column):
    pushed = re.findall(r"PushedFilters: \[([^\]]*)\]", plan(spark, key))
    assert any(re.search(rf"(Than|Or|And).*{column}", p) for p in pushed)


def test_top_n_is_trimmed_before_the_shuffle(spark):
    text = plan(spark, "win_slice_min")
    assert re.search(r"WindowGroupLimit.*Partial", text)


def test_no_unused_imports():
    base = Path(__file__).resolve().parents[1] / "tidalframe"
    for path in base.rglob("*.py"):
        tree = ast.parse(path.read_text())
        names = {}
        for node in ast.walk(tree):
            if isinstance(node, (ast.Import, ast.ImportFrom)):
                for a in node.names:
                    names[(a.asname or a.name).split(".")[0]] = node.lineno
        used = {n.id for n in ast.walk(tree) if isinstance(n, ast.Name)}
        unused = set(names) - used - {"annotations"}
        assert not unused, f"{path}: {unused}"
