"""Scores of many scenarios, from the rows as they are and the rows that scenarios touch."""
from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from assayframe.columns import name_sql, replaced, text_sql, type_of
from assayframe.functions.parse import null_tokens_sql
from assayframe.operators.checks import Check, bad_value, plan_checks, run_checks, value_sizes, verdicts
from assayframe.operators.inject import Scenario, build_scenarios, copied_sql, defect_cases
from assayframe.operators.report import scores
from assayframe.operators.rowid import ROW_ID
from assayframe.rules import Rules
from assayframe.sources.files import with_nulls
from assayframe.sources.sinks import write_csv, write_json


def manifest(scenarios: DataFrame) -> DataFrame:
    """Rows and columns of each scenario."""
    columns = len([c for c in scenarios.columns if c not in ("scenario", ROW_ID)])
    return scenarios.groupBy("scenario").agg(F.count(F.lit(1)).alias("rows")).select(
        F.col("scenario").alias("name"), "rows", F.lit(columns).cast("bigint").alias("columns")
    ).orderBy("name")


def score_matrix(scenarios: DataFrame, rules: Rules) -> DataFrame:
    """One scored row per scenario, worst first."""
    results = run_checks(with_nulls(scenarios), rules, by=["scenario"])
    return scores(results, by=["scenario"]).orderBy("quality_score", "scenario")


def _columns_of_copies(df: DataFrame) -> list[str]:
    """The columns that copying rows rewrites."""
    return [c for c in ("id", "entity_key") if c in df.columns]


def _hull(scenario: Scenario) -> tuple[int, int]:
    """The first and last position that a scenario's defects or repeated rows touch."""
    spans = [(d.start, d.stop) for d in scenario.defects]
    spans += [(0, scenario.repeat_head - 1)] if scenario.repeat_head else []
    return min((a for a, _ in spans), default=0), max((b for _, b in spans), default=-1)


def _base_counts(df: DataFrame, scenarios: Sequence[Scenario], checks: list[Check], rules: Rules) -> DataFrame:
    """(scenario, seq, row_count, failed_rows) of undamaged scenarios, from one aggregate.

    A copy counts like its row, but for ids and keys, which are counted copy by copy.
    """
    own = _columns_of_copies(df)
    most = max((s.copies for s in scenarios), default=0)
    copies = [f"{_copy_sql(df, c, str(k))} AS {name_sql(f'_copy_{k}_{c}')}" for k in range(1, most + 1) for c in own]
    wide = with_nulls(df.selectExpr("*", *copies))
    counters: dict[str, str] = {}

    def counter(check: Check, column: str) -> str:
        bad = bad_value(wide, check.name, column, rules.allowed_values.get(check.column, ()))
        return counters.setdefault(bad, f"bad{len(counters)}")

    failed, sizes = [], []
    for s in scenarios:
        sizes.append(f"n * {max(s.copies, 1)} + least(n * {max(s.copies, 1)}, {s.repeat_head}L)")
        for check in checks:
            if check.bad is None or check.column not in df.columns:
                failed.append("0L")
            elif s.copies and check.column in own:
                failed.append(" + ".join(counter(check, f"_copy_{k}_{check.column}") for k in range(1, s.copies + 1)))
            else:
                failed.append(f"{counter(check, check.column)} * {max(s.copies, 1)}")
    totals = wide.agg(F.expr("count(1) AS n"), *[F.expr(f"count_if({bad}) AS {name}") for bad, name in counters.items()])
    placed = totals.selectExpr(f"array({', '.join(sizes)}) AS sizes", f"posexplode(array({', '.join(failed)})) AS (place, failed_rows)")
    names = f"array({', '.join(text_sql(s.name) for s in scenarios)})"
    at = f"CAST(place DIV {len(checks)} AS INT) + 1"
    return placed.selectExpr(f"element_at({names}, {at}) AS scenario", f"place % {len(checks)} AS seq",
                             f"element_at(sizes, {at}) AS row_count", "failed_rows")


def _copy_sql(df: DataFrame, column: str, copy: str) -> str:
    """The id or key of a copy; the copy's number may be a column."""
    made = copied_sql("id", copy)
    if column == "id":
        return made
    return f"concat(source, ':', {made})" if {"source", "id"} <= set(df.columns) else name_sql(column)


def _touched_counts(df: DataFrame, scenarios: Sequence[Scenario], rows: int, checks: list[Check], rules: Rules,
                    row_id: str) -> DataFrame | None:
    """What defects and repeated rows add to those counts, from the rows they touch alone."""
    settings = []
    for s in scenarios:
        low, high = _hull(s)
        for k in range(1, max(s.copies, 1) + 1):
            shift = (k - 1) * rows
            if low <= high and low - shift < rows and high >= shift:
                settings.append(f"struct({text_sql(s.name)} AS scenario, {k if s.copies else 0} AS _copy, {shift}L AS _shift, "
                                f"{low - shift}L AS _low, {high - shift}L AS _high, {s.repeat_head} AS _head)")
    if not settings:
        return None
    row = name_sql(row_id)
    made = df.selectExpr("*", f"inline(filter(array({', '.join(settings)}), s -> {row} BETWEEN s._low AND s._high))")
    made = replaced(made, {row_id: f"{row} + _shift", **{
        c: f"if(_copy > 0, {_copy_sql(df, c, '_copy')}, {name_sql(c)})"
        for c in _columns_of_copies(df)}})
    cases = defect_cases(scenarios, row, "scenario")
    after = {c: f"_after_{c}" for c in cases if c in df.columns}
    made = with_nulls(made.selectExpr("*", *[
        f"CASE {' '.join(cases[c])} ELSE {name_sql(c)} END AS {name_sql(a)}" for c, a in after.items()]))
    changes = []
    for seq, check in enumerate(checks):
        if check.bad is not None and check.column in df.columns:
            allowed = rules.allowed_values.get(check.column, ())
            old = bad_value(made, check.name, check.column, allowed)
            new = bad_value(made, check.name, after[check.column], allowed) if check.column in after else old
            changes.append((seq, f"sum(int({new}) - int({old}) + if({row} < _head, int({new}), 0))"))
    counted = made.groupBy("scenario").agg(*[F.expr(f"{sql} AS c{seq}") for seq, sql in changes])
    entries = ", ".join(f"struct({seq} AS seq, 0L AS row_count, c{seq} AS failed_rows)" for seq, _ in changes)
    return counted.selectExpr("scenario", f"inline(array({entries}))")


def _repeat_counts(df: DataFrame, scenarios: Sequence[Scenario], rows: int, checks: list[Check]) -> DataFrame | None:
    """Repeated values of the key columns, from one shuffle of the values as they are.

    Copies of an id or key are as distinct among themselves as the rows, since a copy's
    suffix tells its id and number; other columns have the same values in every copy, and
    repeated rows have no value of their own.  So rows less distinct values is all it takes.
    """
    keyed = {seq: c.column for seq, c in enumerate(checks) if c.bad is None}
    if not keyed:
        return None
    own = _columns_of_copies(df)
    columns = list(keyed.values())
    plain = with_nulls(df.select(*map(name_sql, columns)))
    # ids and keys as one copy makes them: with a suffix no blank is missing
    raw = {c: f"_copy_{c}" for c in columns if c in own}
    wide = df.selectExpr(*[f"{_nulled(plain, c)} AS {name_sql(c)}" for c in columns], *[
        f"{_copy_sql(df, c, '0')} AS {name_sql(r)}" for c, r in raw.items()])
    named = [*columns, *raw.values()]
    sizes = value_sizes(wide, named)
    counts = sizes.agg(*[F.expr(f"coalesce(sum(if(column_index = {i}, 1L, 0L)), 0L) AS d{i}") for i in range(len(named))],
                       *[F.expr(f"coalesce(max(column_index = {i} AND int_value IS NULL AND text_value IS NULL), false) AS e{i}")
                         for i in range(len(named))])
    entries = []
    for s in scenarios:
        for i, (seq, c) in enumerate(keyed.items()):
            distinct = f"d{i}"
            if s.copies and c in raw:
                j = named.index(raw[c])  # a missing id or key stays missing in every copy
                distinct = f"(d{j} - int(e{j})) * {s.copies} + int(e{j})"
            total = max(s.copies, 1) * rows
            entries.append(f"struct({text_sql(s.name)} AS scenario, {seq} AS seq, 0L AS row_count, "
                           f"{total + min(total, s.repeat_head)}L - ({distinct}) AS failed_rows)")
    return counts.selectExpr(f"inline(array({', '.join(entries)}))")


def _nulled(nulled: DataFrame, column: str) -> str:
    """The expression by which blanks of a text column become null."""
    return null_tokens_sql(name_sql(column)) if type_of(nulled, column).simpleString() == "string" else name_sql(column)


def scenario_results(df: DataFrame, scenarios: Sequence[Scenario], rows: int, rules: Rules,
                     row_id: str = ROW_ID) -> DataFrame:
    """Check results of every scenario over an ordered table of ``rows`` rows.

    No scenario is built.  One aggregate counts the rows as they are, which copies multiply;
    defects touch known ranges of rows, so only those rows are looked at again; values of
    key columns are shuffled once.  Scenarios whose defects touch a key column are built.
    """
    checks = plan_checks(with_nulls(df), rules)
    unique = {c.column for c in checks if c.bad is None}
    built = [s for s in scenarios if any(d.column in unique | set(_columns_of_copies(df)) for d in s.defects)]
    counted = [s for s in scenarios if s not in built]
    results = []
    if counted:
        parts = [_base_counts(df, counted, checks, rules), _touched_counts(df, counted, rows, checks, rules, row_id),
                 _repeat_counts(df, counted, rows, checks)]
        counts = reduce(DataFrame.unionByName, [p for p in parts if p is not None]).groupBy("scenario", "seq").agg(
            F.sum("row_count").alias("row_count"), F.sum("failed_rows").alias("failed_rows"))
        results.append(verdicts(counts, ["scenario"], checks))
    if built:
        results.append(run_checks(with_nulls(build_scenarios(df, built, rows, row_id)), rules, by=["scenario"]))
    return reduce(DataFrame.unionByName, results)


def score_scenarios(df: DataFrame, scenarios: Sequence[Scenario], rows: int, rules: Rules) -> DataFrame:
    """One scored row per scenario, worst first."""
    return scores(scenario_results(df, scenarios, rows, rules), by=["scenario"]).orderBy("quality_score", "scenario")


def write_matrix(matrix: DataFrame, root: str) -> None:
    """The score matrix as CSV and JSON."""
    write_csv(matrix, f"{root.rstrip('/')}/matrix_summary.csv", single_file=True)
    write_json(matrix, f"{root.rstrip('/')}/matrix_summary.json", single_file=True)
