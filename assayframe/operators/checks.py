"""The seven quality checks, compiled to one aggregate pass and one key pass.

``run_checks`` reads the table twice at most:

* every row-level check is a conditional count, so all of them share one scan and
  one partially aggregated row per task;
* uniqueness needs a shuffle on the values.  All key columns share one scan and one
  shuffle; counts are combined before the shuffle, so a value that fills a third
  of the table arrives as one row per task, and long texts travel as digests.

The result is lazy.  With ``by`` the same two passes serve any number of groups
(scenarios, repair steps, files).
"""
from __future__ import annotations

import json
from collections.abc import Callable, Sequence
from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from assayframe.columns import list_sql, missing, name_sql, present, type_of
from assayframe.functions import parse
from assayframe.rules import Rules

# Check names, severities and the wording of their messages.
REQUIRED = "required_columns_present"
NON_NULL = "non_null"
UNIQUE = "unique_key"
POSITIVE = "positive_numeric"
VALID_DATE = "valid_date"
ALLOWED = "allowed_values"
NULL_RATIO = "null_threshold"
SEVERITY = {
    REQUIRED: "critical",
    NON_NULL: "critical",
    UNIQUE: "critical",
    POSITIVE: "critical",
    VALID_DATE: "critical",
    ALLOWED: "warning",
    NULL_RATIO: "warning",
}
PASS_MESSAGE = {
    REQUIRED: "All required columns are present.",
    NON_NULL: "Column '{c}' has no null values.",
    UNIQUE: "Column '{c}' is unique.",
    POSITIVE: "Column '{c}' contains only positive numbers.",
    VALID_DATE: "Column '{c}' contains only valid dates.",
    ALLOWED: "Column '{c}' stays within the allowed values.",
    NULL_RATIO: "Column '{c}' is within the configured null threshold.",
}
FAIL_MESSAGE = {
    REQUIRED: "Missing required columns: {names}.",
    NON_NULL: "Column '{c}' contains {n} null values.",
    UNIQUE: "Column '{c}' contains {n} duplicate rows.",
    POSITIVE: "Column '{c}' contains {n} values that are non-numeric or <= 0.",
    VALID_DATE: "Column '{c}' contains {n} invalid date values.",
    ALLOWED: "Column '{c}' contains {n} values outside: {names}.",
    NULL_RATIO: "Column '{c}' exceeds the null threshold: {ratio} > {limit}.",
}

RESULT_COLUMNS = [
    "check_name", "column_name", "status", "severity",
    "metric_value", "threshold", "failed_rows", "message",
]

_INTEGRAL = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)


class Check(NamedTuple):
    """One planned check: what is counted, and what the verdict will say."""

    name: str
    column: str
    threshold: str
    bad: str | None             # SQL condition counted per row
    limit: float | None = None  # the tolerated ratio of a null-ratio check
    absent: int | None = None   # missing columns of the required-columns check
    names: str = ""             # column or value list quoted in the message

    def describe(self) -> dict:
        """The constant part of the verdict; ``before`` and ``after`` enclose the number."""
        limit = "" if self.limit is None else f"{self.limit:.2%}"
        wording = FAIL_MESSAGE[self.name].format(
            c=self.column, names=self.names, n="\x00", ratio="\x00", limit=limit)
        before, number, after = wording.partition("\x00")
        return {
            "check_name": self.name,
            "column_name": self.column,
            "severity": SEVERITY[self.name],
            "threshold": self.threshold,
            "tolerated": self.limit,
            "absent": self.absent,
            "passed": PASS_MESSAGE[self.name].format(c=self.column),
            "before": before,
            "numbered": bool(number),
            "after": after,
        }


_DESCRIPTION = (
    "array<struct<check_name string, column_name string, severity string, threshold string, "
    "tolerated double, absent double, passed string, before string, numbered boolean, after string>>"
)


def bad_value(df: DataFrame, check: str, column: str, allowed: Sequence[str] = ()) -> str:
    """The SQL condition that holds on the rows breaking a row-level check."""
    kind, c = type_of(df, column), name_sql(column)
    is_missing = parse.missing_sql(c, kind)
    if check in (NON_NULL, NULL_RATIO):
        return is_missing
    if check == POSITIVE:
        return f"NOT {parse.positive_sql(c, kind)}"
    if check == VALID_DATE:
        return f"NOT {is_missing} AND NOT {parse.valid_date_sql(c, kind)}"
    if check == ALLOWED:
        outside = f"CAST({c} AS STRING) NOT IN ({list_sql(allowed)})" if allowed else "true"
        return f"NOT {is_missing} AND {outside}"
    raise ValueError(f"{check} is not a row-level check")


def plan_checks(df: DataFrame, rules: Rules) -> list[Check]:
    """All checks of a rule set in execution order.

    Checks on absent columns are left out; only the required-columns check sees those.
    """
    absent = missing(df, rules.required_columns)
    plan = [Check(REQUIRED, "dataset", "0", "false", absent=len(absent), names=", ".join(absent))]

    def simple(name, columns):
        return [Check(name, c, "0", bad_value(df, name, c)) for c in present(df, columns)]

    plan += simple(NON_NULL, rules.non_null_columns)
    plan += [Check(UNIQUE, c, "0", None) for c in present(df, rules.unique_columns)]
    plan += simple(POSITIVE, rules.positive_numeric_columns)
    plan += simple(VALID_DATE, rules.date_columns)
    for c in present(df, rules.allowed_values):
        allowed = rules.allowed_values[c]
        listed = ", ".join(allowed)
        plan.append(Check(ALLOWED, c, listed, bad_value(df, ALLOWED, c, allowed), names=listed))
    for c in present(df, rules.null_thresholds):
        limit = float(rules.null_thresholds[c])
        plan.append(Check(NULL_RATIO, c, str(limit), bad_value(df, NULL_RATIO, c), limit=limit))
    return plan


def group_value(df: DataFrame, column: str) -> tuple[str, str]:
    """A value as SQL for (integer, text) such that equal pairs mean equal values.

    Integers and dates stay eight bytes wide.  Text over 40 bytes is replaced by a
    SHA-256 digest behind a marker no short value carries, so the shuffle moves a
    fixed number of bytes per value however long the texts are.
    """
    kind, c = type_of(df, column), name_sql(column)
    no_int, no_text = "CAST(NULL AS BIGINT)", "CAST(NULL AS STRING)"
    if isinstance(kind, _INTEGRAL):
        return f"CAST({c} AS BIGINT)", no_text
    if isinstance(kind, T.BooleanType):
        return f"CAST(CAST({c} AS INT) AS BIGINT)", no_text
    if isinstance(kind, T.DateType):
        return f"CAST(unix_date({c}) AS BIGINT)", no_text
    if isinstance(kind, T.TimestampType):
        return f"unix_micros({c})", no_text
    if parse.is_floating(kind):
        # Adding zero folds -0.0 into 0.0; NaN counts as missing.
        return no_int, f"CASE WHEN NOT isnan({c}) THEN CAST({c} + 0.0D AS STRING) END"
    if isinstance(kind, (T.ArrayType, T.StructType, T.MapType)):
        text = f"to_json({c})"
    elif isinstance(kind, T.BinaryType):
        text = f"hex({c})"
    else:
        text = f"CAST({c} AS STRING)"
    return no_int, (
        f"CASE WHEN octet_length({text}) <= 40 THEN concat('=', {text}) "
        f"ELSE concat('#', sha2(CAST({text} AS BINARY), 256)) END"
    )


def value_sizes(df: DataFrame, columns: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """Rows per distinct value of each column: ``by…, column_index, …, size``.

    One scan and one shuffle for all columns.  Missing values equal each other.
    """
    values = ", ".join(
        f"struct({i} AS column_index, {number} AS int_value, {text} AS text_value)"
        for i, (number, text) in enumerate(group_value(df, c) for c in columns)
    )
    groups = [name_sql(g) for g in by]
    return (
        df.selectExpr(*groups, f"inline(array({values}))")
        .groupBy(*groups, "column_index", "int_value", "text_value")
        .agg(F.count(F.lit(1)).alias("size"))
    )


def check_counts(checked: DataFrame, groups: list[str], seqs: Sequence[int]) -> DataFrame:
    """One row per check from the aggregated columns ``n`` and ``bad<seq>``."""
    rows = ", ".join(
        f"struct({seq} AS seq, coalesce(n, 0L) AS row_count, coalesce(bad{seq}, 0L) AS failed_rows)"
        for seq in seqs)
    return checked.selectExpr(*groups, f"inline(array({rows}))")


def verdicts(counts: DataFrame, groups: list[str], plan: list[Check]) -> DataFrame:
    """Results from rows (group, seq, row_count, failed_rows)."""
    described = F.from_json(F.lit(json.dumps([c.describe() for c in plan])), _DESCRIPTION)
    ratio = "CAST(failed_rows AS DOUBLE) / nullif(row_count, 0L)"
    # An empty table has no ratio: NULL, which fails.
    judged = counts.withColumn("d", F.get(described, F.col("seq"))).selectExpr(
        *groups, "seq", "row_count", "failed_rows", "d",
        f"{ratio} AS ratio",
        f"""coalesce(CASE WHEN d.absent IS NOT NULL THEN d.absent = 0
            WHEN d.tolerated IS NOT NULL THEN {ratio} <= d.tolerated
            ELSE failed_rows = 0 END, false) AS ok""",
    )
    percent = "coalesce(format_string('%.2f', bround(ratio * 100, 2)), 'nan') || '%'"
    number = f"CASE WHEN d.tolerated IS NULL THEN CAST(failed_rows AS STRING) ELSE {percent} END"
    return judged.selectExpr(
        *groups,
        "seq",
        "d.check_name AS check_name",
        "d.column_name AS column_name",
        "if(ok, 'PASS', 'FAIL') AS status",
        "d.severity AS severity",
        """CASE WHEN d.tolerated IS NOT NULL THEN bround(ratio, 4)
            ELSE coalesce(d.absent, CAST(failed_rows AS DOUBLE)) END AS metric_value""",
        "d.threshold AS threshold",
        "failed_rows",
        f"if(ok, d.passed, concat(d.before, if(d.numbered, {number}, ''), d.after)) AS message",
        "row_count",
    )


def _split(plan: list[Check]) -> tuple[dict[int, str], dict[int, str]]:
    """Row-level checks as conditions, and key columns, by their numbers."""
    rowwise = {seq: check.bad for seq, check in enumerate(plan) if check.bad is not None}
    keyed = {seq: check.column for seq, check in enumerate(plan) if check.bad is None}
    return rowwise, keyed


def _row_totals(rowwise: dict[int, str]) -> list[Column]:
    return [F.expr("count(1)").alias("n"),
            *[F.expr(f"count_if({bad})").alias(f"bad{seq}") for seq, bad in rowwise.items()]]


def _key_counts(df: DataFrame, keyed: dict[int, str], by: Sequence[str] = ()) -> DataFrame:
    """Surplus rows of each key column, from one scan and one shuffle of key values."""
    groups = [name_sql(g) for g in by]
    repeats = value_sizes(df, list(keyed.values()), by).groupBy(*groups).agg(
        F.expr("sum(if(column_index = 0, size, 0)) AS n"),
        *[F.expr(f"sum(if(column_index = {i}, size - 1, 0)) AS bad{seq}") for i, seq in enumerate(keyed)],
    )
    return check_counts(repeats, groups, list(keyed))


def run_checks(df: DataFrame, rules: Rules, by: Sequence[str] = ()) -> DataFrame:
    """One row per check (and group), numbered in execution order by ``seq``."""
    plan = plan_checks(df, rules)
    groups = [name_sql(g) for g in by]
    rowwise, keyed = _split(plan)
    counts = [check_counts(df.groupBy(*groups).agg(*_row_totals(rowwise)), groups, list(rowwise))]
    if keyed:
        counts.append(_key_counts(df, keyed, by))
    return verdicts(reduce(DataFrame.unionByName, counts), groups, plan)


def check_while_writing(
    df: DataFrame, rules: Rules, write: Callable[[DataFrame], None], stored: Callable[[], DataFrame],
) -> DataFrame:
    """The results of ``run_checks``, counted while ``write`` writes the rows.

    All row-level checks are observed on the one pass that writes; ``stored`` reads back what
    was written, of which uniqueness scans the key columns alone.  ``write`` must run one job
    over the frame it is given.
    """
    plan = plan_checks(df, rules)
    rowwise, keyed = _split(plan)
    seen = Observation()
    write(df.observe(seen, *_row_totals(rowwise)))
    found = seen.get
    literals = [F.lit(found[name]).cast("bigint").alias(name) for name in ("n", *(f"bad{seq}" for seq in rowwise))]
    counts = [check_counts(df.sparkSession.range(1).select(*literals), [], list(rowwise))]
    if keyed:
        counts.append(_key_counts(stored(), keyed))
    return verdicts(reduce(DataFrame.unionByName, counts), [], plan)


def _single(df: DataFrame, by: Sequence[str], **rule) -> DataFrame:
    return run_checks(df, Rules(**rule), by).filter(F.col("seq") > 0)


def check_required(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return run_checks(df, Rules(required_columns=tuple(columns)))


def check_non_null(df: DataFrame, columns: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    return _single(df, by, non_null_columns=tuple(columns))


def check_unique(df: DataFrame, columns: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    return _single(df, by, unique_columns=tuple(columns))


def check_positive(df: DataFrame, columns: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    return _single(df, by, positive_numeric_columns=tuple(columns))


def check_dates(df: DataFrame, columns: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    return _single(df, by, date_columns=tuple(columns))


def check_allowed(df: DataFrame, allowed: dict, by: Sequence[str] = ()) -> DataFrame:
    return _single(df, by, allowed_values={c: tuple(v) for c, v in allowed.items()})


def check_null_ratio(df: DataFrame, limits: dict, by: Sequence[str] = ()) -> DataFrame:
    return _single(df, by, null_thresholds=dict(limits))
