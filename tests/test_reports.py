"""Every report against its check, and every survey row against a report."""

import re
from concurrent.futures import ThreadPoolExecutor

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from harness import compare
from oracles import SQL
from viewtally.plans.registry import load

NAMES = sorted(load())
# per-row Python, and joins that compare every row with every row
FORBIDDEN = ("EvalPython", "MapInPandas", "FlatMapGroups", "CartesianProduct", "BroadcastNestedLoopJoin")
# rows with no query of their own: databases, files and state are unit-tested
UNIT_TESTED = {"SRC8", "SNK3", "SNK6", "SNK7", "SNK8", "SNK9"}
ROW_COUNTS = {
    "SRC": 13, "SNK": 9, "F": 16, "J": 18, "A": 18, "W": 7, "S": 6, "U": 52, "FN": 16, "ST": 2, "M": 26, "C": 23, "P": 26,
    "V": 12, "L": 14, "G": 23, "N": 33, "B": 21, "R": 27, "E": 24, "Q": 15, "X": 4, "D": 15, "I": 13,
}


@pytest.fixture(scope="module")
def outcomes(spark, con, sf_dir):
    """All comparisons, several at a time; a test waits for its own."""
    queries_, checks = queries(), oracle_sql()
    with ThreadPoolExecutor(8) as pool:

        def outcome(name):
            df = queries_[name](spark, sf_dir)
            diff = compare(df, con.cursor(), checks[name])
            plan = df._jdf.queryExecution().executedPlan().toString()
            return diff + [f"{node} in the plan" for node in FORBIDDEN if node in plan]

        yield {n: pool.submit(outcome, n) for n in NAMES}


@pytest.mark.parametrize("name", NAMES)
def test_report_equals_check(name, outcomes):
    diff = outcomes[name].result()
    assert not diff, "\n".join(diff)


def test_every_check_has_a_report():
    assert set(NAMES) <= set(queries())
    assert set(SQL) == set(NAMES)
    assert set(SQL) <= set(oracle_sql()) <= set(queries())


def test_every_row_has_a_report():
    covered = {row for r in load().values() for row in r.rows} | UNIT_TESTED
    wanted = {f"{kind}{i}" for kind, n in ROW_COUNTS.items() for i in range(1, n + 1)}
    assert sorted(wanted - covered) == []


def test_entry_is_lazy_and_has_columns(spark):
    df = entry(spark)
    assert df.columns == ["main_category", "second_category", "pv", "uv"]
    assert df.count() > 0


def test_no_forbidden_names():
    assert not [n for n in NAMES if re.match(r"op\d+_|pipeline", n)]
