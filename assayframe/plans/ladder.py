"""Cumulative repairs scored after each step."""
from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from assayframe.columns import name_sql, present, text_sql
from assayframe.operators.checks import Check, bad_value, group_value, plan_checks, verdicts
from assayframe.operators.frequency import step_change
from assayframe.operators.repair import (
    RepairPlan, deduplicate_keys, fill_missing, normalise_domains, rebuilt_keys, repair_dates_and_optional,
    repeated_keys,
)
from assayframe.operators.report import build_summary
from assayframe.rules import Rules
from assayframe.sources.files import with_nulls
from assayframe.sources.sinks import write_csv, write_json

# The names of the steps, in order.
STEPS = (
    "00_dirty_input",
    "01_missing_fields_fixed",
    "02_domain_values_fixed",
    "03_dates_thresholds_fixed",
    "04_deduplicated_final",
)
REPAIRS = (fill_missing, normalise_domains, repair_dates_and_optional, deduplicate_keys)


def ladder_frames(df: DataFrame, plan: RepairPlan) -> dict[str, DataFrame]:
    """The table after each step.  Each step continues from the one before."""
    frames = [df]
    for repair in REPAIRS:
        frames.append(repair(frames[-1], plan))
    return dict(zip(STEPS, frames))


def _rewritten(df: DataFrame, plan: RepairPlan) -> list[list[str]]:
    """The columns that each row-level step rewrites; the last one only rebuilds keys."""
    key = [plan.key] if plan.keyed(df) else []
    return [
        [*present(df, (plan.id, plan.name, *plan.domains)), *key],
        present(df, plan.domains),
        present(df, (*plan.dates, *plan.optional)),
        key,
    ]


def _side_by_side(df: DataFrame, plan: RepairPlan) -> tuple[DataFrame, dict[str, list[str]]]:
    """All row-level steps of a row as columns, and the column of each step by original name.

    A step adds columns only for what it rewrites.
    """
    versions = {c: [c] * len(STEPS) for c in df.columns}
    wide = df
    row_level = (fill_missing, normalise_domains, repair_dates_and_optional, rebuilt_keys)
    for step, (repair, columns) in enumerate(zip(row_level, _rewritten(df, plan)), 1):
        before = {c: f"_before_{step}_{c}" for c in columns}
        for c in columns:
            versions[c] = [before[c] if i < step and v == c else v for i, v in enumerate(versions[c])]
        wide = repair(wide.selectExpr("*", *[f"{name_sql(c)} AS {name_sql(b)}" for c, b in before.items()]), plan)
    return wide, versions


def _row_level_counts(wide: DataFrame, versions: dict[str, list[str]], checks: list[Check], rules: Rules) -> DataFrame:
    """(step, seq, row_count, failed_rows) from one aggregate: each distinct column is counted once."""
    counters: dict[str, str] = {}
    failed = []
    for step in range(len(STEPS)):
        for check in checks:
            count = "0L"
            if check.column in versions and check.bad is not None:
                bad = bad_value(wide, check.name, versions[check.column][step], rules.allowed_values.get(check.column, ()))
                count = counters.setdefault(bad, f"bad{len(counters)}")
            failed.append(count)
    totals = wide.agg(F.expr("count(1) AS n"), *[F.expr(f"count_if({bad}) AS {alias}") for bad, alias in counters.items()])
    return _unfolded(totals, failed, "n", range(len(checks)))


def _unfolded(totals: DataFrame, failed: list[str], row_count: str, seqs: Iterable[int]) -> DataFrame:
    """(step, seq, row_count, failed_rows) from one row of counts, given step by step and check by check."""
    seqs = list(seqs)
    steps = f"array({', '.join(map(text_sql, STEPS))})"
    placed = totals.selectExpr(f"{row_count} AS row_count", f"posexplode(array({', '.join(failed)})) AS (place, failed_rows)")
    return placed.selectExpr(
        f"element_at({steps}, CAST(place DIV {len(seqs)} AS INT) + 1) AS step",
        f"element_at(array({', '.join(map(str, seqs))}), place % {len(seqs)} + 1) AS seq", "row_count", "failed_rows")


def _changed_counts(changed: DataFrame, pairs: dict[str, str], checks: list[Check], rules: Rules) -> DataFrame | None:
    """What renumbered ids and keys add to the row-level counts of the last step."""
    rows, counters = [], []
    for seq, check in enumerate(checks):
        if check.column in pairs and check.bad is not None:
            new, old = (bad_value(changed, check.name, f"{age}_{pairs[check.column]}", rules.allowed_values.get(check.column, ()))
                        for age in ("new", "old"))
            counters.append(F.expr(f"coalesce(sum(int({new}) - int({old})), 0L) AS change{seq}"))
            rows.append(f"struct({text_sql(STEPS[-1])} AS step, {seq} AS seq, 0L AS row_count, change{seq} AS failed_rows)")
    return changed.agg(*counters).selectExpr(f"inline(array({', '.join(rows)}))") if rows else None


def _key_values(wide: DataFrame, versions: dict[str, list[str]], columns: list[str]) -> DataFrame:
    """Values of the key columns with the number of rows (0 or 1) that hold them at each step.

    A row sends each of its distinct values once, so a value that no step changes is one row.
    """
    values, entries = [], []
    for i, c in enumerate(columns):
        ages = list(dict.fromkeys(versions[c]))
        for j, v in enumerate(ages):
            number, text = group_value(wide, v)
            values.append(f"struct({number} AS int_value, {text} AS text_value) AS _k{i}_{j}")
            seen = "".join(f" AND NOT (_k{i}_{m} <=> _k{i}_{j})" for m in range(j))
            held = [f"int(_k{i}_{j} <=> _k{i}_{ages.index(versions[c][s])}) AS s{s}" for s in range(len(STEPS))]
            entries.append(f"if(true{seen}, struct({i} AS column_index, _k{i}_{j}.int_value AS int_value, "
                           f"_k{i}_{j}.text_value AS text_value, {', '.join(held)}), NULL)")
    return wide.selectExpr(*values).selectExpr(f"inline(filter(array({', '.join(entries)}), x -> x IS NOT NULL))")


def _changed_values(changed: DataFrame, pairs: dict[str, str], columns: list[str]) -> DataFrame | None:
    """Renumbered values: one row less of the old one and one more of the new one at the last step."""
    entries = []
    none = ", ".join(f"0 AS s{s}" for s in range(len(STEPS) - 1))
    for i, c in enumerate(columns):
        if c in pairs:
            for age, change in (("old", -1), ("new", 1)):
                number, text = group_value(changed, f"{age}_{pairs[c]}")
                entries.append(f"struct({i} AS column_index, {number} AS int_value, {text} AS text_value, "
                               f"{none}, {change} AS s{len(STEPS) - 1})")
    return changed.selectExpr(f"inline(array({', '.join(entries)}))") if entries else None


def step_results(df: DataFrame, plan: RepairPlan, rules: Rules) -> DataFrame:
    """Check results of all steps; blanks count as missing.

    No row is emitted once per step.  The row-level counts of all steps come from one
    aggregate that counts a column again only where a step rewrites it; values of key columns
    are shuffled once, with their rows at each step beside them.  The last step is the one
    before, with keys rebuilt, plus the changes of the few rows whose keys repeat.
    """
    checks = plan_checks(with_nulls(df), rules)
    wide, versions = _side_by_side(df, plan)
    wide = with_nulls(wide)
    pairs = {c: name for name, c in (("id", plan.id), ("key", plan.key)) if c in df.columns}
    row_level = reduce(lambda frame, repair: repair(frame, plan), REPAIRS[:-1], df)
    changed = with_nulls(repeated_keys(row_level, plan)) if pairs else None
    parts = [_row_level_counts(wide, versions, checks, rules)]
    keyed = {seq: c.column for seq, c in enumerate(checks) if c.bad is None}
    more = _changed_counts(changed, pairs, checks, rules) if pairs else None
    parts += [more] if more is not None else []
    if keyed:
        columns = list(keyed.values())
        values = _key_values(wide, versions, columns)
        moved = _changed_values(changed, pairs, columns) if pairs else None
        steps = [f"s{s}" for s in range(len(STEPS))]
        sizes = (values if moved is None else values.unionByName(moved)).groupBy(
            "column_index", "int_value", "text_value").agg(*[F.sum(s).alias(s) for s in steps])
        repeats = sizes.agg(*[
            F.expr(f"coalesce(sum(if(column_index = {i} AND {s} > 0, {s} - 1, 0)), 0L) AS r{i}_{s}")
            for i in range(len(columns)) for s in steps])
        parts.append(_unfolded(repeats, [f"r{i}_{s}" for s in steps for i in range(len(columns))], "0L", keyed))
    counts = reduce(DataFrame.unionByName, parts).groupBy("step", "seq").agg(
        F.sum("row_count").alias("row_count"), F.sum("failed_rows").alias("failed_rows"))
    return verdicts(counts, ["step"], checks)


def ladder_summary(df: DataFrame, plan: RepairPlan, rules: Rules) -> DataFrame:
    """Score, failed checks and change per step."""
    summary = build_summary(step_results(df, plan, rules), by=["step"])
    named_checks = F.transform(
        "failed_checks",
        lambda c: F.concat_ws(":", c["check_name"], c["column_name"]),
    )
    rows = summary.select(
        "step", "row_count", "checks_total", "checks_passed", "checks_failed",
        "quality_score", named_checks.alias("failed_checks"),
    )
    changed = step_change(rows, "step", {
        "quality_score": "score_delta", "checks_failed": "failed_delta"}, few=True)
    return changed.withColumn("failed_delta", F.col("failed_delta").cast("bigint")).orderBy("step")


def write_ladder(frames: dict[str, DataFrame], summary: DataFrame, root: str) -> None:
    """Each step as CSV; the summary as CSV and JSON."""
    for step, frame in frames.items():
        write_csv(frame, f"{root.rstrip('/')}/steps/{step}.csv")
    flat = summary.withColumn("failed_checks", F.array_join("failed_checks", "; "))
    write_csv(flat, f"{root.rstrip('/')}/ladder_summary.csv", single_file=True)
    write_json(summary, f"{root.rstrip('/')}/ladder_summary.json", single_file=True)
