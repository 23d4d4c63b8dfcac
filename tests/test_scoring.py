"""Ladder and matrix scores by changes, against building and checking every version."""
from __future__ import annotations

import random
from functools import reduce

import pytest
from pyspark.sql import functions as F

from assayframe.catalog.base import table
from assayframe.catalog.repair import COLUMNS, PLAN, RULES
from assayframe.operators import inject
from assayframe.operators.checks import run_checks
from assayframe.operators.inject import Defect, Scenario
from assayframe.operators.rowid import with_row_id
from assayframe.plans import ladder, matrix
from assayframe.rules import Rules
from assayframe.sources.files import with_nulls


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def odd_rows(spark, n, seed):
    rng = random.Random(seed)
    pick = {
        "source": ["TERMINAL", "PARTNER", "", "X", None], "id": ["1", "2", "NA", "", " ", None, "1-DEDUP-001", "7", "a"],
        "entity_key": ["", "TERMINAL:1", "K", None, "NA"], "name": ["n", " ", ""], "country": ["NL", "zz", ""],
        "last_trx_date": ["2025-01-01", "bad", "", None], "mcc": ["5411", ""],
    }
    rows = [(i, *(rng.choice(pick.get(c, ["", "x"])) for c in COLUMNS)) for i in range(n)]
    return spark.createDataFrame(rows, "row_id long, " + ", ".join(f"{c} string" for c in COLUMNS))


def result_rows(df, by):
    columns = [by, "seq", "check_name", "column_name", "status", "metric_value", "failed_rows", "message", "row_count"]
    return sorted(tuple(r) for r in df.select(*columns).collect())


@pytest.mark.parametrize("n,seed", [(0, 1), (1, 2), (90, 3)])
def test_ladder_equals_checking_every_step(spark, n, seed):
    df = odd_rows(spark, n, seed)
    frames = ladder.ladder_frames(df, PLAN)
    wanted = [result_rows(run_checks(with_nulls(f), RULES).withColumn("step", F.lit(s)), "step") for s, f in frames.items()]
    assert result_rows(ladder.step_results(df, PLAN, RULES), "step") == sorted(reduce(list.__add__, wanted))


def test_ladder_of_a_table_without_keys(spark):
    df = odd_rows(spark, 20, 4).drop("id", "entity_key", "source")
    rules = Rules(non_null_columns=("name",), unique_columns=("country",))
    last = result_rows(run_checks(with_nulls(list(ladder.ladder_frames(df, PLAN).values())[-1]), rules).withColumn(
        "step", F.lit(ladder.STEPS[-1])), "step")
    assert [r for r in result_rows(ladder.step_results(df, PLAN, rules), "step") if r[0] == ladder.STEPS[-1]] == last


SCENARIOS = [
    Scenario("plain"),
    Scenario("far", defects=(Defect("mcc", 40, 10_000), Defect("mcc", 45, 50, ("", "5411"), 1))),
    Scenario("copied", copies=3, repeat_head=50, defects=(Defect("source", 10, 100), Defect("name", 0, 4), Defect("name", 2, 3, ("y",)))),
    Scenario("head", repeat_head=500),
    Scenario("many", copies=2),
    Scenario("keys", copies=2, repeat_head=5, defects=(Defect("id", 3, 30, ("1", "NA")),)),
]


@pytest.mark.parametrize("n,seed", [(1, 5), (33, 6), (120, 7)])
def test_matrix_equals_checking_every_scenario(spark, n, seed):
    df = odd_rows(spark, n, seed)
    rules = Rules(required_columns=("id", "absent"), non_null_columns=("id", "entity_key", "name", "source"),
                  unique_columns=("id", "entity_key", "country"), allowed_values={"id": ("1", "1-B01", "2-B02"), "source": ("X",)},
                  null_thresholds={"mcc": 0.4, "entity_key": 0.1})
    built = run_checks(with_nulls(inject.build_scenarios(df, SCENARIOS, n)), rules, by=["scenario"])
    assert result_rows(matrix.scenario_results(df, SCENARIOS, n, rules), "scenario") == result_rows(built, "scenario")


def test_no_row_is_built_once_per_step_or_scenario(spark):
    df = odd_rows(spark, 30, 8)
    for text in (plan(ladder.step_results(df, PLAN, RULES)), plan(matrix.scenario_results(df, inject.STANDARD_SCENARIOS, 30, RULES))):
        # values and counts are unfolded, whole rows only where a scenario touches them
        assert text.count("inline(filter") >= 1 and "inline(array(struct(00" not in text
    shuffled = plan(matrix.scenario_results(df, inject.STANDARD_SCENARIOS, 30, RULES))
    assert shuffled.count("hashpartitioning(column_index") == 1


def test_numbers_without_a_copy_of_the_table(spark, sf):
    df = table(spark, sf, "lineitem")
    free = with_row_id(df, plain_scan=True)
    assert "rowid-" not in plan(free) and "positions-" not in plan(free)
    assert sorted(r[0] for r in free.select("row_id").collect()) == list(range(df.count()))
    ordered = with_row_id(df, ["l_shipdate"], plain_scan=True)
    written = [line for line in plan(ordered).splitlines() if "rowid-" in line]
    assert written and not any("l_comment" in line or "l_orderkey" in line for line in written)
    rows = ordered.select("row_id", "l_shipdate").orderBy("row_id").collect()
    assert [r.row_id for r in rows] == list(range(len(rows))) and [r.l_shipdate for r in rows] == sorted(r.l_shipdate for r in rows)
