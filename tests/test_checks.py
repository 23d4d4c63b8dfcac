"""Each check at its corners, and random tables against plain Python."""
from __future__ import annotations

import datetime as dt
import math

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from assayframe.operators import checks
from assayframe.operators.report import build_report, build_summary
from assayframe.rules import Rules


def one(df):
    rows = df.collect()
    assert len(rows) == 1
    return rows[0]


def column(spark, values, kind="string"):
    return spark.createDataFrame([(v,) for v in values], f"c {kind}")


@pytest.mark.parametrize("kind, values, bad", [
    ("string", ["1", "3.14", "7", "3.0", "1e3", " 7 ", "+5", "inf", ".5", "5."], 0),
    ("string", ["0", "-1", "nan", "", "3,5", "abc", "1d", "1f", "1_000", "0x10", "-inf", "1e400", None], 13),
    ("double", [1.0, 0.0, -2.0, float("nan"), None, float("inf")], 4),
    ("bigint", [1, 0, -1, None], 3),
    ("boolean", [True, False, None], 2),
])
def test_positive(spark, kind, values, bad):
    row = one(checks.check_positive(column(spark, values, kind), ["c"]))
    assert (row.failed_rows, row.status) == (bad, "FAIL" if bad else "PASS")


@pytest.mark.parametrize("kind, values, bad", [
    ("string", ["2024-01-01", "2024-02-29", None, "2024-2-9", "1677-09-22", "2262-04-11"], 0),
    ("string", ["2025-02-29", "2025-13-01", "31/12/2024", "not-a-date", "0000-00-00", "",
                " 2024-01-01", "20240101", "1600-01-01", "2262-04-12", "24-01-01", "2024-01-01T00:00:00"], 12),
    ("date", [dt.date(2024, 1, 1), None], 0),
    ("int", [20240101, None], 1),
])
def test_dates(spark, kind, values, bad):
    assert one(checks.check_dates(column(spark, values, kind), ["c"])).failed_rows == bad


def test_domain_is_exact(spark):
    df = column(spark, ["NL", "nl", " NL", "NL ", "", None, "BE"])
    row = one(checks.check_allowed(df, {"c": ["NL", "BE"]}))
    assert (row.failed_rows, row.severity, row.threshold) == (4, "warning", "NL, BE")
    assert row.message == "Column 'c' contains 4 values outside: NL, BE."


def test_empty_domain_rejects_every_value(spark):
    assert one(checks.check_allowed(column(spark, ["a", None]), {"c": []})).failed_rows == 1


def test_quotes_and_backslashes_in_domains(spark):
    df = column(spark, ["it's", "a\\b", "x"])
    assert one(checks.check_allowed(df, {"c": ["it's", "a\\b"]})).failed_rows == 1


@pytest.mark.parametrize("nulls, rows, limit, status", [
    (5, 10, 0.5, "PASS"), (10, 10, 1.0, "PASS"), (0, 10, 0.0, "PASS"),
    (6, 10, 0.5, "FAIL"), (1, 10, 0.0, "FAIL"),
])
def test_null_ratio(spark, nulls, rows, limit, status):
    df = column(spark, [None] * nulls + ["x"] * (rows - nulls))
    row = one(checks.check_null_ratio(df, {"c": limit}))
    assert (row.status, row.failed_rows, row.metric_value) == (status, nulls, nulls / rows)


def test_null_ratio_wording(spark):
    df = column(spark, [None] * 616 + ["x"] * (12100 - 616))
    row = one(checks.check_null_ratio(df, {"c": 0.01}))
    assert row.metric_value == 0.0509
    assert row.message == "Column 'c' exceeds the null threshold: 5.09% > 1.00%."
    assert row.threshold == "0.01"


def test_empty_text_is_not_null_but_nan_is(spark):
    assert one(checks.check_non_null(column(spark, ["", None]), ["c"])).failed_rows == 1
    assert one(checks.check_non_null(column(spark, [float("nan"), 1.0, None], "double"), ["c"])).failed_rows == 2


@pytest.mark.parametrize("kind, values, repeats", [
    ("string", ["RA-1", "ra-1", "é", "é"], 0),
    ("string", ["a", "b", "a"], 1),
    ("string", ["a", "a", "b"], 1),
    ("string", [None, None, None], 2),
    ("string", ["x" * 100, "x" * 100, "x" * 99], 1),
    ("string", ["=a", "a", "#a"], 0),
    ("double", [0.0, -0.0, float("nan"), None], 2),
    ("bigint", [1, 1, 1, 2], 2),
    ("date", [dt.date(2024, 1, 1), dt.date(2024, 1, 1)], 1),
    ("boolean", [True, False, True], 1),
    ("array<int>", [[1], [1], [2]], 1),
    ("decimal(10,2)", [1, 1], 1),
])
def test_unique(spark, kind, values, repeats):
    if kind.startswith("decimal"):
        from decimal import Decimal
        values = [Decimal(v) for v in values]
    assert one(checks.check_unique(column(spark, values, kind), ["c"])).failed_rows == repeats


def test_long_text_equal_to_a_digest_is_another_value(spark):
    import hashlib
    long = "y" * 50
    digest = "#" + hashlib.sha256(long.encode()).hexdigest()
    assert one(checks.check_unique(column(spark, [long, digest]), ["c"])).failed_rows == 0


def test_required_columns_are_case_sensitive_and_listed_in_order(spark):
    df = spark.createDataFrame([(1,)], "Id int")
    row = one(checks.check_required(df, ["id", "b", "Id", "a"]))
    assert (row.metric_value, row.failed_rows, row.column_name) == (3.0, 0, "dataset")
    assert row.message == "Missing required columns: id, b, a."


def test_absent_columns_are_skipped(spark):
    rules = Rules(("a",), ("a",), ("a",), ("a",), ("a",), {"a": ("x",)}, {"a": 0.1})
    rows = checks.run_checks(column(spark, ["x"]), rules).collect()
    assert [r.check_name for r in rows] == [checks.REQUIRED]


def test_empty_table(spark):
    rules = Rules((), ("c",), ("c",), ("c",), ("c",), {"c": ("x",)}, {"c": 1.0})
    rows = {r.check_name: r for r in checks.run_checks(column(spark, []), rules).collect()}
    assert rows[checks.NULL_RATIO].status == "FAIL"
    assert rows[checks.NULL_RATIO].metric_value is None
    assert all(r.status == "PASS" for name, r in rows.items() if name != checks.NULL_RATIO)


def test_odd_column_names(spark):
    df = spark.createDataFrame([("x", None), ("x", "y")], "`a.b` string, `c``d` string")
    rules = Rules(non_null_columns=("a.b", "c`d"), unique_columns=("a.b",), null_thresholds={"c`d": 0.2})
    rows = checks.run_checks(df, rules).orderBy("seq").collect()
    assert [r.failed_rows for r in rows] == [0, 0, 1, 1, 1]


def test_execution_order_and_report_order(spark):
    df = spark.createDataFrame([("1", "x"), ("1", None)], "id string, kind string")
    rules = Rules(("id",), ("kind", "id"), ("id",), ("id",), (), {"kind": ("y",)}, {"kind": 0.1})
    results = checks.run_checks(df, rules)
    order = [(r.check_name, r.column_name) for r in results.orderBy("seq").collect()]
    assert order == [
        (checks.REQUIRED, "dataset"), (checks.NON_NULL, "kind"), (checks.NON_NULL, "id"),
        (checks.UNIQUE, "id"), (checks.POSITIVE, "id"), (checks.ALLOWED, "kind"),
        (checks.NULL_RATIO, "kind")]
    shown = [(r.status, r.severity, r.column_name, r.check_name) for r in build_report(results).collect()]
    assert shown == sorted(shown)
    failed = build_summary(results).first().failed_checks
    assert [f.check_name for f in failed] == [
        checks.NON_NULL, checks.UNIQUE, checks.ALLOWED, checks.NULL_RATIO]


def test_nothing_of_the_table_reaches_the_summary(spark):
    df = spark.createDataFrame([("TRACER-1", "TRACER-2"), ("TRACER-1", None)], "id string, kind string")
    rules = Rules(("id",), ("kind",), ("id",), ("id",), ("id",), {"kind": ("y",)}, {"kind": 0.0})
    assert "TRACER" not in str(build_summary(checks.run_checks(df, rules), "x").collect())


# Random tables: many small ones share one Spark run as groups.

CELL = st.one_of(st.none(), st.sampled_from(
    ["", "A", "a", "1", "0", "-2", "1e3", "nan", "3,5", "2024-02-29", "2025-02-29", "NL"]))
NUMBER = st.sampled_from([None, math.nan, -1.0, -0.0, 0.0, 0.5, 1.0, 2.0])
TABLES = st.lists(st.lists(st.tuples(CELL, CELL, NUMBER), min_size=1, max_size=25), min_size=10, max_size=25)


def is_number(v):
    try:
        return v is not None and "," not in v and not math.isnan(float(v))
    except ValueError:
        return False


def is_date(v):
    try:
        dt.datetime.strptime(v, "%Y-%m-%d")
        return True
    except ValueError:
        return False


def expected(rows):
    a, b, x = zip(*rows)
    x = [None if v is not None and math.isnan(v) else v for v in x]
    n = len(rows)
    nulls = sum(v is None for v in b)
    return {
        (checks.NON_NULL, "a"): sum(v is None for v in a),
        (checks.NON_NULL, "x"): sum(v is None for v in x),
        (checks.UNIQUE, "a"): n - len(set(a)),
        (checks.UNIQUE, "x"): n - len({None if v is None else v + 0.0 for v in x}),
        (checks.POSITIVE, "a"): sum(not (is_number(v) and float(v) > 0) for v in a),
        (checks.POSITIVE, "x"): sum(v is None or v <= 0 for v in x),
        (checks.VALID_DATE, "b"): sum(v is not None and not is_date(v) for v in b),
        (checks.ALLOWED, "b"): sum(v is not None and v not in ("NL", "A") for v in b),
        (checks.NULL_RATIO, "b"): nulls,
    }, nulls / n


@settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))
@given(tables=TABLES, limit=st.floats(0, 1))
def test_random_tables(spark, tables, limit):
    rows = [(g, *row) for g, table in enumerate(tables) for row in table]
    df = spark.createDataFrame(rows, "g int, a string, b string, x double")
    rules = Rules(("a", "b"), ("a", "x"), ("a", "x"), ("a", "x"), ("b",), {"b": ("NL", "A")}, {"b": limit})
    results = checks.run_checks(df, rules, by=["g"])
    found: dict = {}
    for r in results.collect():
        found.setdefault(r.g, {})[(r.check_name, r.column_name)] = r
    assert sorted(found) == list(range(len(tables)))
    for g, table in enumerate(tables):
        counts, ratio = expected(table)
        for key, bad in counts.items():
            row = found[g][key]
            assert row.failed_rows == bad, (g, key)
            assert 0 <= row.failed_rows <= len(table) == row.row_count
            if key[0] == checks.NULL_RATIO:
                assert 0 <= row.metric_value <= 1
                assert (row.status == "PASS") == (ratio <= limit)
            else:
                assert (row.status == "PASS") == (bad == 0)
    for s in build_summary(results, by=["g"]).collect():
        every = all(r.status == "PASS" for r in found[s.g].values())
        assert (s.quality_score == 100.0) == every
        assert s.checks_total == s.checks_passed + s.checks_failed == len(found[s.g])


def test_row_order_does_not_matter(spark):
    rows = [("a", 1), ("b", None), ("a", 3), (None, 4), (None, 5)]
    rules = Rules((), ("a", "b"), ("a",), ("b",))
    seen = {
        tuple(map(tuple, build_report(checks.run_checks(
            spark.createDataFrame(order, "a string, b int"), rules)).collect()))
        for order in (rows, rows[::-1], rows[2:] + rows[:2])
    }
    assert len(seen) == 1
