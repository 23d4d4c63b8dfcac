"""SQL text for check reports: one aggregate query per check, no shared passes."""
from __future__ import annotations

from collections.abc import Sequence

from assayframe.operators.checks import (
    ALLOWED, FAIL_MESSAGE, NON_NULL, NULL_RATIO, PASS_MESSAGE, POSITIVE, REQUIRED, SEVERITY,
    UNIQUE, VALID_DATE,
)
from assayframe.rules import Rules


def quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def valid_number(c: str) -> str:
    return (
        f"(regexp_matches(CAST({c} AS VARCHAR), '^\\s*[+-]?([0-9]+\\.?[0-9]*|\\.[0-9]+)([eE][+-]?[0-9]+)?\\s*$')"
        f" AND TRY_CAST(TRIM(CAST({c} AS VARCHAR)) AS DOUBLE) > 0)"
    )


def valid_date(c: str) -> str:
    return (
        f"(regexp_matches(CAST({c} AS VARCHAR), '^[0-9]{{4}}-[0-9]{{1,2}}-[0-9]{{1,2}}$')"
        f" AND try_strptime(CAST({c} AS VARCHAR), '%Y-%m-%d') IS NOT NULL)"
    )


def results_sql(
    relation: str, rules: Rules, columns: Sequence[str],
    dates: Sequence[str] = (), by: str | None = None,
) -> str:
    """Check results over ``relation`` as a query; ``dates`` are typed date columns."""
    parts: list[str] = []
    group = f"{by}, " if by else ""
    tail = f" GROUP BY {by}" if by else ""

    def add(name, column, bad, threshold="0", limit="NULL", names="", pass_if=None, metric=None, source=None):
        ok = PASS_MESSAGE[name].format(c=column)
        no = FAIL_MESSAGE[name].format(c=column, names=names, n="\x00n", ratio="\x00r", limit="\x00l")
        no = quoted(no).replace("\x00n", "' || CAST(bad AS VARCHAR) || '")
        no = no.replace("\x00r", "' || printf('%.2f', bad * 100.0 / n) || '%")
        no = no.replace("\x00l", f"' || printf('%.2f', {limit} * 100.0) || '%")
        passes = pass_if or "bad = 0"
        value = metric or "CAST(bad AS DOUBLE)"
        inner = source or f"SELECT {group}CAST(COUNT(*) AS BIGINT) AS n, CAST({bad} AS BIGINT) AS bad FROM {relation}{tail}"
        parts.append(
            f"SELECT {group}{len(parts)} AS seq, {quoted(name)} AS check_name, {quoted(column)} AS column_name, "
            f"CASE WHEN {passes} THEN 'PASS' ELSE 'FAIL' END AS status, {quoted(SEVERITY[name])} AS severity, "
            f"{value} AS metric_value, {quoted(threshold)} AS threshold, bad AS failed_rows, "
            f"CASE WHEN {passes} THEN {quoted(ok)} ELSE {no} END AS message, n AS row_count FROM ({inner})"
        )

    def count(condition):
        return f"COUNT(CASE WHEN {condition} THEN 1 END)"

    have = set(columns)
    absent = [c for c in rules.required_columns if c not in have]
    add(REQUIRED, "dataset", "0", names=", ".join(absent),
        pass_if="TRUE" if not absent else "FALSE", metric=f"CAST({len(absent)} AS DOUBLE)")
    for c in rules.non_null_columns:
        if c in have:
            add(NON_NULL, c, count(f"{c} IS NULL"))
    for c in rules.unique_columns:
        if c in have:
            inside = f"SELECT {group}{c}, COUNT(*) AS k FROM {relation} GROUP BY {group}{c}"
            add(UNIQUE, c, "", source=(
                f"SELECT {group}CAST(SUM(k) AS BIGINT) AS n, CAST(SUM(k - 1) AS BIGINT) AS bad FROM ({inside}){tail}"))
    for c in rules.positive_numeric_columns:
        if c in have:
            add(POSITIVE, c, count(f"NOT COALESCE({valid_number(c)}, FALSE)"))
    for c in rules.date_columns:
        if c in have:
            bad = "FALSE" if c in dates else f"{c} IS NOT NULL AND NOT {valid_date(c)}"
            add(VALID_DATE, c, count(bad))
    for c, values in rules.allowed_values.items():
        if c in have:
            inside = ", ".join(map(quoted, values))
            add(ALLOWED, c, count(f"{c} IS NOT NULL AND CAST({c} AS VARCHAR) NOT IN ({inside})"),
                threshold=", ".join(values), names=", ".join(values))
    for c, limit in rules.null_thresholds.items():
        if c in have:
            add(NULL_RATIO, c, count(f"{c} IS NULL"), threshold=str(limit), limit=str(limit),
                pass_if=f"CAST(bad AS DOUBLE) / n <= {limit}",
                metric="round_even(CAST(bad AS DOUBLE) / n, 4)")
    return " UNION ALL ".join(parts)


REPORT = "check_name, column_name, status, severity, metric_value, threshold, failed_rows, message"


def report_sql(relation: str, rules: Rules, columns: Sequence[str], dates: Sequence[str] = ()) -> str:
    return f"SELECT {REPORT} FROM ({results_sql(relation, rules, columns, dates)})"


def scores_sql(results: str, by: str) -> str:
    return f"""
        SELECT {by}, MAX(row_count) AS row_count, COUNT(*) AS checks_total,
          COUNT(CASE WHEN status = 'PASS' THEN 1 END) AS checks_passed,
          COUNT(CASE WHEN status <> 'PASS' THEN 1 END) AS checks_failed,
          round_even(COUNT(CASE WHEN status = 'PASS' THEN 1 END) * 100.0 / COUNT(*), 2) AS quality_score
        FROM ({results}) GROUP BY {by}
    """


def cycled_sql(position: str, values: Sequence[str], offset: int) -> str:
    listed = ", ".join(map(quoted, values))
    return f"list_value({listed})[(({position}) + {offset}) % {len(values)} + 1]"
