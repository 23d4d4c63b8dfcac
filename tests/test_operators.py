"""Row ids, occurrences, lookups, repairs and injections against plain Python."""
from __future__ import annotations

import dataclasses
import random

import pytest
from pyspark.sql import functions as F

from assayframe.functions import keys, parse, text
from assayframe.operators import inject, lookups, repair
from assayframe.operators.frequency import distinct_beside_count, latest_per_key, step_change
from assayframe.operators.repair import RepairPlan
from assayframe.operators.rowid import head, mark_repeats, occurrence, with_row_id
from assayframe.plans import coverage, ladder


def test_row_ids_are_dense_and_ordered(spark):
    rng = random.Random(1)
    rows = [(rng.randrange(20), rng.randrange(3), i) for i in range(2000)]
    df = spark.createDataFrame(rows, "a int, b int, i int").repartition(5, "i")
    found = with_row_id(df, ["a", "b", "i"], partitions=7).collect()
    assert sorted(r.row_id for r in found) == list(range(2000))
    assert [(r.a, r.b, r.i) for r in sorted(found, key=lambda r: r.row_id)] == sorted(rows)


def test_one_order_value_is_split_over_tasks(spark):
    df = spark.range(0, 4000, numPartitions=4).select(F.lit(1).alias("same"), "id")
    numbered = with_row_id(df, ["same"], partitions=8)
    assert numbered.select(F.spark_partition_id()).distinct().count() > 1
    found = numbered.collect()
    assert sorted(r.row_id for r in found) == list(range(4000))
    # Ties keep the order in which they were read.
    assert all(r.row_id == r.id for r in found)


def test_row_ids_without_order_and_of_an_empty_table(spark):
    df = spark.range(0, 100, numPartitions=3)
    assert [r.row_id for r in with_row_id(df).orderBy("id").collect()] == list(range(100))
    assert with_row_id(df.filter("id < 0"), ["id"]).count() == 0
    assert head(with_row_id(df, ["id"]), 10).count() == 10


@pytest.mark.parametrize("block", [1, 7, 100, 1_000_000])
def test_occurrences_over_blocks(spark, block):
    rng = random.Random(block)
    rows = [(i, rng.choice(["hot"] * 5 + ["a", "b", None])) for i in range(500)]
    df = spark.createDataFrame(rows, "row_id bigint, k string")
    seen: dict = {}
    expected = {}
    for i, k in rows:
        expected[i] = seen.get(k, 0)
        seen[k] = expected[i] + 1
    found = {r.row_id: r.occurrence for r in occurrence(df, ["k"], block_rows=block).collect()}
    assert found == expected
    repeats = {r.row_id for r in mark_repeats(df, ["k"]).collect() if r.is_repeat}
    assert repeats == {i for i, n in expected.items() if n}


@pytest.mark.parametrize("raw, key", [
    ("2001190603", "P_M0002001190603"), ("835720", "P_M0000000835720"),
    ("SRC4;1234", "P_M0000000041234"), ("abc-5", "P_M0000000000005"),
    ("12345678901234567", "P_M12345678901234567"), ("none", None), ("", None), (None, None),
])
def test_registry_key(spark, raw, key):
    df = spark.createDataFrame([(raw,)], "id string")
    assert df.select(keys.registry_key(F.col("id"))).first()[0] == key


def test_cut_key(spark):
    df = spark.createDataFrame([("12345678901234567",), ("x",), (None,)], "id string")
    cut = [r[0] for r in df.select(keys.registry_key(F.col("id"), truncate=True)).collect()]
    assert cut == ["P_M1234567890123", "P_M0000000000000", None]


def test_hash_bucket(spark):
    import hashlib

    values = ["P_M0002001190603", "", "é", "x" * 1000]
    df = spark.createDataFrame([(v,) for v in values], "v string")
    found = [r[0] for r in df.select(keys.hash_bucket(F.col("v"))).collect()]
    assert found == [int.from_bytes(hashlib.sha1(v.encode()).digest()[:8], "big") % 1000 for v in values]
    assert found[0] == 795


def test_sample_rates(spark):
    df = spark.range(20000).select(
        F.concat(F.lit("K"), "id").alias("k"),
        F.when(F.col("id") % 2 == 0, "One").otherwise("two").alias("source"))
    picked = keys.in_hash_sample(F.col("k"), F.col("source"), {"ONE": 0.714}, 0.353)
    rates = {r.source: r.rate for r in df.groupBy("source").agg(
        F.avg(picked.cast("int")).alias("rate")).collect()}
    assert abs(rates["One"] - 0.714) < 0.02 and abs(rates["two"] - 0.353) < 0.02


def test_double_encoding(spark):
    clean = ["Coöperatieve", "plain", "漢字", "", None, "naïve café", "€5", "Ã"]
    damaged = [v.encode().decode("latin-1") if v is not None else None for v in clean]
    df = spark.createDataFrame(list(zip(clean, damaged)), "clean string, damaged string").repartition(2)
    for row in df.select("clean", parse.repair_double_encoding(F.col("damaged")).alias("mended"),
                         parse.repair_double_encoding(F.col("clean")).alias("kept")).collect():
        assert row.mended == row.clean
        assert row.kept == row.clean


def test_blank_and_maps(spark):
    df = spark.createDataFrame([(" ",), ("\t\n",), (" ",), ("",), (None,), ("x",), (" x ",)], "v string")
    assert [r[0] for r in df.select(parse.is_blank("v")).collect()] == [True] * 5 + [False] * 2
    mapped = df.select(text.map_value(F.col("v"), {"x": 1, "": 2}, 0)).collect()
    assert [r[0] for r in mapped] == [0, 0, 0, 2, 0, 1, 0]


def hot_tables(spark):
    """A third of the rows on one key, a third without key."""
    left = spark.range(3000).select("id", F.expr(
        "CASE id % 3 WHEN 0 THEN 'hot' WHEN 1 THEN NULL ELSE concat('k', id % 50) END").alias("key"))
    right = spark.createDataFrame(
        [("hot", 1), ("hot", 2), ("k1", 3), ("unused", 4), (None, 5)], "key string, v int")
    return left, right


def test_hot_keys_are_found_and_change_no_result(spark):
    left, right = hot_tables(spark)
    hot = lookups.find_hot_keys(left, "key", share=0.1)
    assert hot == ["hot"]
    for how in ("left", "inner", "left_anti", "left_semi"):
        plain = sorted(map(str, left.join(right, "key", how).collect()))
        for keys_given in ([], hot):
            mine = lookups.lookup_join(left, right, "key", how, keys_given)
            assert sorted(map(str, mine.select(left.join(right, "key", how).columns).collect())) == plain


def test_several_lookups_shuffle_the_left_rows_once(spark):
    left, right = hot_tables(spark)
    other = right.select("key", F.lit(7).alias("other"))
    plain = left.join(right, "key", "left").join(other, "key", "left")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        for hot in ([], ["hot"]):
            joined = lookups.lookup_joins(left, [right, other], "key", "left", hot)
            text = joined._jdf.queryExecution().executedPlan().toString()
            assert text.count("Exchange hashpartitioning") == 3
            assert sorted(map(str, joined.select(plain.columns).collect())) == sorted(
                map(str, plain.collect()))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.enabled")


def test_rows_without_key_are_spread(spark):
    left, right = hot_tables(spark)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        joined = lookups.lookup_join(left, right, "key", "left", ["hot"])
        parts = {(r.key, r.p) for r in joined.select("key", F.spark_partition_id().alias("p")).collect()}
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.enabled")
    assert len({p for k, p in parts if k is None}) == 8
    assert len({p for k, p in parts if k == "hot"}) == 8


def test_flag_multiplies_no_row(spark):
    left, right = hot_tables(spark)
    flagged = lookups.with_flag(left, right, "key", "found")
    assert flagged.count() == 3000
    assert {(r.key, r.found) for r in flagged.filter("id < 10").collect()} == {
        ("hot", "Y"), (None, "N"), ("k2", "N"), ("k5", "N"), ("k8", "N")}


def test_latest_per_key_puts_missing_versions_last(spark):
    df = spark.createDataFrame(
        [("a", None, 1), ("a", 5, 2), ("a", 5, 3), ("b", None, 4), ("b", None, 9)], "k string, v int, x int")
    assert sorted(map(tuple, latest_per_key(df, ["k"], "v").collect())) == [("a", 5, 3), ("b", None, 9)]


def test_distinct_count_approximate_is_close(spark):
    df = spark.range(10000).select((F.col("id") % 3).alias("g"), (F.col("id") % 500).alias("v"))
    exact = {r.g: r.distinct_count for r in distinct_beside_count(df, "g", "v").collect()}
    near = {r.g: r.distinct_count for r in distinct_beside_count(df, "g", "v", approximate=True).collect()}
    assert set(exact.values()) == {500}
    assert all(abs(near[g] - n) < 50 for g, n in exact.items())


PLAN = RepairPlan.standard(["One", "Two"], "Two")


def dirty(spark, rows):
    return spark.createDataFrame(
        [(i, *row) for i, row in enumerate(rows)],
        "row_id bigint, source string, entity_key string, id string, name string, country string, last_trx_date string, mcc string")


def test_repair_steps(spark):
    df = dirty(spark, [
        ("", "", "", " ", "XX", "bad", ""),
        ("One", "K1", "7", "n", "NL", "2024-2-9", "1"),
        ("foreign", "K1", "7", "n", "", "", "1"),
        ("One", "K3", "7-DEDUP-001", "n", "BE", "2024-02-30", " "),
    ])
    steps = ladder.ladder_frames(df, PLAN)
    got = {s: [tuple(r)[1:] for r in f.orderBy("row_id").collect()] for s, f in steps.items()}
    assert got[ladder.STEPS[1]][0] == (
        "Two", "Two:UNKNOWN_ID_000000", "UNKNOWN_ID_000000", "UNKNOWN_MERCHANT_000000", "XX", "bad", "")
    assert got[ladder.STEPS[1]][2][4] == "NL"
    assert [r[0] for r in got[ladder.STEPS[2]]] == ["Two", "One", "Two", "One"]
    assert [r[5] for r in got[ladder.STEPS[3]]] == ["2026-05-01", "2024-2-9", "2026-05-01", "2026-05-01"]
    assert [r[6] for r in got[ladder.STEPS[3]]] == ["5999", "1", "1", "5999"]
    assert [r[2] for r in got[ladder.STEPS[4]]] == [
        "UNKNOWN_ID_000000", "7", "7-DEDUP-001", "7-DEDUP-001"]
    assert [r[1] for r in got[ladder.STEPS[4]]] == [
        "Two:UNKNOWN_ID_000000", "One:7", "Two:7-DEDUP-001", "One:7-DEDUP-001"]


@pytest.mark.parametrize("block", [3, 10, 1_000_000])
def test_repeated_keys_over_blocks(spark, block):
    """Ids and keys of a table with a hot id, against a plain loop."""
    rng = random.Random(block)
    rows = [(i, rng.choice(["One", "Two"]), "K", rng.choice(["hot"] * 6 + ["a", "a-DEDUP-001", "b", ""]))
            for i in range(200)]
    df = spark.createDataFrame(rows, "row_id bigint, source string, entity_key string, id string")
    plan = dataclasses.replace(PLAN, block_rows=block)

    def numbered(values):
        seen: dict = {}
        out = []
        for v in values:
            n = seen[v] = seen.get(v, -1) + 1
            out.append(f"{v}-DEDUP-{n:03d}" if n else v)
        return out

    ids = numbered([r[3] for r in rows])
    found = numbered([f"{r[1]}:{i}" for r, i in zip(rows, ids)])
    got = repair.deduplicate_keys(df, plan).orderBy("row_id").collect()
    assert [r.id for r in got] == ids
    assert [r.entity_key for r in got] == found


def test_repairs_ignore_absent_columns(spark):
    df = spark.createDataFrame([(0, "x")], "row_id bigint, other string")
    for frame in ladder.ladder_frames(df, PLAN).values():
        assert [tuple(r) for r in frame.collect()] == [(0, "x")]


def entity_rows(spark, n):
    return spark.range(n).select(
        F.col("id").alias("row_id"), F.lit("One").alias("source"),
        F.format_string("200%03d", "id").alias("id"), F.lit("K").alias("entity_key"),
        F.lit("Merchant").alias("name"), F.lit("NL").alias("country"),
        F.lit("2025-01-01").alias("last_trx_date"), F.lit("2025-01-01").alias("vintage_date"),
        F.lit("5411").alias("mcc"), F.lit("BV").alias("legal_form"), F.lit("1").alias("active_contracts"))


def brute_scenario(rows, s):
    """The scenario on Python dicts, row after row."""
    rows = [dict(r) for r in rows]
    if s.copies:
        rows = [{**r, "id": f"{r['id']}-B{k:02d}", "entity_key": f"{r['source']}:{r['id']}-B{k:02d}"}
                for k in range(1, s.copies + 1) for r in rows]
    for d in s.defects:
        for place, r in enumerate(rows[d.start: d.stop + 1]):
            if d.column in r:
                r[d.column] = d.values[(place + d.offset) % len(d.values)]
    return rows + [dict(r) for r in rows[: s.repeat_head]]


@pytest.mark.parametrize("n", [30, 220])
def test_scenarios(spark, n):
    df = entity_rows(spark, n)
    source_rows = [r.asDict() for r in df.orderBy("row_id").collect()]
    made = inject.build_scenarios(df, inject.STANDARD_SCENARIOS, n)
    got: dict = {}
    for r in made.collect():
        d = r.asDict()
        got.setdefault(d.pop("scenario"), []).append(d)
    for s in inject.STANDARD_SCENARIOS:
        expected = brute_scenario(source_rows, s)
        rows = sorted(got[s.name], key=lambda r: r["row_id"])
        assert [r.pop("row_id") for r in rows] == list(range(len(expected)))
        for r in expected:
            r.pop("row_id")
        assert rows == expected, s.name
    one = inject.build_scenario(df, inject.MIXED_EXTREME, n)
    assert one.count() == len(got["mixed_extreme"])


def test_valid_baseline_passes_its_own_domains(spark):
    made = inject.valid_baseline(entity_rows(spark, 30), ("One", "Two"), 1).orderBy("row_id").collect()
    assert [r.source for r in made[:3]] == ["Two", "One", "Two"]
    assert made[4].last_trx_date == "2025-01-23" and made[4].active_contracts == "5"
    assert all(r.entity_key == f"{r.source}:{r.id}" for r in made)


def test_rows_of_several_files_are_numbered_file_by_file(spark, tmp_path):
    for name, rows in (("a", 5), ("b", 50), ("c", 500)):
        spark.range(rows).selectExpr(f"'{name}' AS file", "id", "1 AS same").coalesce(1).write.parquet(
            str(tmp_path / "in" / f"part={name}"))
    df = spark.read.parquet(str(tmp_path / "in")).select("file", "id", "same")
    for order, plain in (([], False), (["same"], True), (["same"], False)):
        rows = with_row_id(df, order, plain_scan=plain).orderBy("row_id").collect()
        assert [r.row_id for r in rows] == list(range(555))
        assert [(r.file, r.id) for r in rows] == [(f, i) for f, n in (("a", 5), ("b", 50), ("c", 500)) for i in range(n)]


def test_coverage_of_a_small_base(spark):
    base = spark.createDataFrame([
        ("One", "2001190603", "a", "Active"), ("One", "835720", "b", "Inactive"), ("Two", None, "c", "Active"),
        ("Two", "no digits", "d", "Active"), (None, "835720", "e", "Active"), (None, "1", "f", "Active")],
        "source string, id string, name string, merchant_activity_status string")
    known = spark.createDataFrame([("P_M0000000835720",), ("P_M0000000835720",)], "join_key string")
    flagged = coverage.flagged(base, known)
    assert flagged.columns == [*base.columns, "in_registry_flag"]
    assert {r.name for r in flagged.filter("in_registry_flag = 'Y'").collect()} == {"b", "e"}
    assert {r.name for r in coverage.unmatched(base, known).collect()} == {"a", "c", "d", "f"}
    # The plain form pads ids without digits, which the registry may hold.
    zeros = spark.createDataFrame([("P_M0000000000000",)], "join_key string")
    assert {r.name for r in coverage.unmatched(base, zeros, truncate=True).collect()} == {"a", "b", "c", "e", "f"}
    summary = {(r.source, r.in_registry_flag): (r.merchants, r.active_merchants, r.pct_of_source)
               for r in coverage.match_summary(flagged).collect()}
    assert summary == {
        (None, "N"): (1, 1, 50.0), (None, "Y"): (1, 1, 50.0),
        ("One", "N"): (1, 1, 50.0), ("One", "Y"): (1, 0, 50.0), ("Two", "N"): (1, 2, 100.0)}


def test_empty_inputs_are_errors(spark):
    base = spark.createDataFrame([], "source string, id string, merchant_activity_status string")
    lookup = spark.createDataFrame([], "join_key string, registry_risk_score string")
    with pytest.raises(RuntimeError, match="entity base is empty"):
        coverage.run_coverage(base, lookup, "2026-01-01 00:00:00")
    one = spark.createDataFrame([("a", "1", "Active")], base.schema)
    with pytest.raises(RuntimeError, match="registry lookup is empty"):
        coverage.run_coverage(one, lookup, "2026-01-01 00:00:00")


@pytest.mark.parametrize("how", ["left", "left_anti"])
def test_rows_without_any_key_are_spread_without_hot_keys(spark, how):
    left = spark.range(4000).selectExpr("CASE WHEN id < 0 THEN CAST(id AS STRING) END AS k", "id AS v")
    right = spark.createDataFrame([("a", 1)], "k string, w int")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = lookups.lookup_join(left, right, "k", how)
        assert joined.count() == 4000
        plan = joined._jdf.queryExecution().executedPlan().toString()
        assert "hashpartitioning(k" in plan and "_salt" in plan.split("hashpartitioning(k")[1][:40]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_changes_over_many_ranges_are_those_of_one_window(spark):
    rng = random.Random(5)
    rows = [(rng.choice([None, *range(900)]), rng.choice([None, 1.25, 7.5, 100.0]), i) for i in range(2000)]
    df = spark.createDataFrame(rows, "at int, score double, n int").repartition(6, "n")
    wanted = {"score": "score_delta", "n": "n_delta"}
    ranged, single = (step_change(df, "at", wanted, **how) for how in ({"partitions": 13}, {"few": True}))
    found = sorted(map(tuple, ranged.collect()), key=lambda r: r[2])
    assert found == sorted(map(tuple, single.collect()), key=lambda r: r[2])
    plan = ranged._jdf.queryExecution().optimizedPlan().toString()
    assert "windowspecdefinition(_range" in plan and "windowspecdefinition(at" not in plan
    stored = ranged.select(F.spark_partition_id()).distinct().count()
    assert stored > 1
    assert step_change(df.filter("n < 0"), "at", wanted).count() == 0
    one = step_change(df.filter("n = 7"), "at", wanted).collect()
    assert [(r.score_delta, r.n_delta) for r in one] == [(0.0, 0)]


def test_order_values_that_repeat_stay_in_one_range(spark):
    df = spark.createDataFrame([(1, 10.0), (5, 30.0), (5, 20.0), (9, 50.0)], "at int, v double")
    found = step_change(df, "at", {"v": "d"}, partitions=4).collect()
    assert sorted((r.at, r.v, r.d) for r in found) == [
        (1, 10.0, 0.0), (5, 20.0, 10.0), (5, 30.0, 10.0), (9, 50.0, 20.0)]
