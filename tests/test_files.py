from __future__ import annotations

import random

import pytest

from assayframe.operators.report import build_summary
from assayframe.operators.checks import run_checks
from assayframe.plans import history
from assayframe.plans.validate import store_and_validate, validate_frame, validate_source
from assayframe.rules import Config, DatasetSettings, Rules
from assayframe.sources import files, sinks
from assayframe.streaming.revalidate import batch_history, revalidate


def csv(tmp_path, data, name="data.csv"):
    path = tmp_path / name
    path.write_bytes(data if isinstance(data, bytes) else data.encode())
    return str(path)


def test_byte_order_mark_and_line_ends(spark, tmp_path):
    df = files.load_dataset(spark, csv(tmp_path, b"\xef\xbb\xbfid,name\r\n1,Acme\r\n2,Beta\r\n"))
    assert df.columns == ["id", "name"]
    assert [tuple(r) for r in df.orderBy("id").collect()] == [("1", "Acme"), ("2", "Beta")]


def test_line_breaks_inside_quotes_when_asked_for(spark, tmp_path):
    path = csv(tmp_path, b'id,name\r\n1,"a\nb"\r\n2,c\r\n')
    df = files.load_dataset(spark, path, multi_line=True)
    assert [tuple(r) for r in df.orderBy("id").collect()] == [("1", "a\nb"), ("2", "c")]


def test_quotes(spark, tmp_path):
    df = files.load_dataset(spark, csv(tmp_path, 'id,name\n1,"Acme, Inc."\n2,"Beta ""Gamma"" Co"\n'))
    assert [r.name for r in df.orderBy("id").collect()] == ["Acme, Inc.", 'Beta "Gamma" Co']


def test_lone_quotes_inside_cells_are_data(spark, tmp_path):
    path = csv(tmp_path, 'id,size\n1,5" pipe\n2,"x, ""y"" z"\n3,""""\n4,a"b"c"\n')
    assert [r["size"] for r in files.load_dataset(spark, path).orderBy("id").collect()] == [
        '5" pipe', 'x, "y" z', '"', 'a"b"c"']


def test_header_only(spark, tmp_path):
    df = files.load_dataset(spark, csv(tmp_path, "id,name\n"))
    assert (df.columns, df.count()) == (["id", "name"], 0)


def test_missing_value_tokens(spark, tmp_path):
    path = csv(tmp_path, "id,name\n1,\n2,NULL\n3,N/A\n4,nan\n5,none\n6, \n")
    assert files.load_dataset(spark, path).filter("name IS NULL").count() == 4
    text = [r.name for r in files.load_text(spark, path).orderBy("id").collect()]
    assert text == ["", "NULL", "N/A", "nan", "none", " "]


def test_declared_types(spark, tmp_path):
    path = csv(tmp_path, "band,seen,share\n0001,3,1.5\n0002,,x\n0003,7.0,1e2\n0004,7.5,\n")
    df = files.load_dataset(spark, path, {"band": "str", "seen": "Int64", "share": "float64", "no_such": "str"})
    assert [tuple(r) for r in df.orderBy("band").collect()] == [
        ("0001", 3, 1.5), ("0002", None, None), ("0003", 7, 100.0), ("0004", None, None)]
    assert dict(df.dtypes) == {"band": "string", "seen": "bigint", "share": "double"}


def test_wide_rows(spark, tmp_path):
    names = [f"col_{i}" for i in range(120)]
    df = files.load_dataset(spark, csv(tmp_path, ",".join(names) + "\n" + ",".join(map(str, range(120))) + "\n"))
    assert (len(df.columns), df.count()) == (120, 1)


def test_unreadable_input(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        files.load_dataset(spark, str(tmp_path / "absent.csv"))
    with pytest.raises(ValueError, match="unsupported file format"):
        files.load_dataset(spark, csv(tmp_path, "x", "data.parquet"))
    with pytest.raises(files.UnreadableInput):
        files.load_dataset(spark, csv(tmp_path, b"", "empty.csv"))
    with pytest.raises(files.UnreadableInput):
        files.load_dataset(spark, csv(tmp_path, 'a,b\n1,"never closed', "open.csv"))
    with pytest.raises(Exception, match="(?i)malformed"):
        files.load_dataset(spark, csv(tmp_path, "a,b,c\n1,2\n", "short.csv")).collect()


def test_broken_rows_fail_whatever_is_checked(spark, tmp_path):
    path = csv(tmp_path, "a,b,c\n1,2,3\n1,2\n")
    with pytest.raises(Exception, match="(?i)malformed"):
        run_checks(files.load_dataset(spark, path), Rules(non_null_columns=("a",))).collect()


def test_truncated_input_gives_no_report(spark, tmp_path):
    path = csv(tmp_path, 'a,b\nx,"unterminated')
    with pytest.raises(ValueError):
        validate_source(spark, Config(checks=Rules(required_columns=("a",))), path=path)


def test_unknown_table(spark):
    with pytest.raises(ValueError, match="Unknown table"):
        files.load_table(spark, "no_such_table")


INVOICES = """invoice_id,customer_id,customer_segment,invoice_date,amount,currency
INV-1,C-1,SMB,2026-03-20,100,EUR
INV-2,,Enterprise,2026-03-21,250,USD
INV-3,C-3,,2026-13-01,80,GBP
INV-4,C-4,SMB,2026-03-23,-20,EUR
INV-1,C-1,SMB,2026-03-20,100,CHF
INV-6,C-6,SMB,2026-03-25,0,EUR
"""
INVOICE_RULES = Rules(
    required_columns=("invoice_id", "customer_id", "invoice_date", "amount", "currency"),
    non_null_columns=("customer_id", "invoice_date", "amount"),
    unique_columns=("invoice_id",),
    positive_numeric_columns=("amount",),
    date_columns=("invoice_date",),
    allowed_values={"currency": ("EUR", "USD")},
    null_thresholds={"customer_segment": 0.5},
)


def test_invoices_end_to_end(spark, tmp_path):
    config = Config(DatasetSettings(input_path=csv(tmp_path, INVOICES)), INVOICE_RULES)
    root = str(tmp_path / "runs")
    run = validate_source(spark, config, output=root, run_id="first", run_ts="2026-04-01 08:00:00")
    failed = {(r.check_name, r.column_name): r.failed_rows
              for r in run.report.collect() if r.status == "FAIL"}
    assert failed == {
        ("non_null", "customer_id"): 1, ("unique_key", "invoice_id"): 1,
        ("positive_numeric", "amount"): 2, ("valid_date", "invoice_date"): 1,
        ("allowed_values", "currency"): 2}
    summary = run.summary.first()
    assert (summary.row_count, summary.checks_total, summary.quality_score) == (6, 9, 44.44)
    assert [tuple(r) for r in history.run_report(spark, root, "first").collect()] == [
        tuple(r) for r in run.report.collect()]
    assert history.run_report(spark, root, "absent").count() == 0
    published = history.published_runs(spark, root).collect()
    assert [(r.run_id, r.quality_score) for r in published] == [("first", 44.44)]


def test_no_input_named(spark):
    with pytest.raises(ValueError, match="no input"):
        validate_source(spark, Config())


def test_history_skips_broken_and_partial_summaries(spark, tmp_path):
    good = '{"generated_at_utc": "%s", "row_count": 5, "checks_total": 3, "checks_passed": 2, "checks_failed": 1, "quality_score": 66.67, "failed_checks": []}'
    for name, text in {
        "a/old + one": good % "2026-01-01T00:00:00+00:00",
        "b": good % "2026-02-01T10:30:00+00:00",
        "c": good % "whenever",
        "broken": "{not json",
        "partial": '{"row_count": 5}',
        "list": "[]",
    }.items():
        folder = tmp_path / "reports" / name
        folder.mkdir(parents=True)
        (folder / "summary.json").write_text(text)
    (tmp_path / "reports" / "other.json").write_text(good % "2026-03-01T00:00:00+00:00")
    runs = history.find_runs(spark, str(tmp_path / "reports"))
    assert [r.run_id for r in runs.collect()] == ["b", "a/old + one", "c"]
    labels = [r.label for r in history.inventory(runs, "Europe/Amsterdam").collect()]
    assert labels == ["b | 01 Feb 2026 11:30", "a/old + one | 01 Jan 2026 01:00", "c | unknown time"]


def test_replace_keeps_schema_and_does_not_duplicate(spark):
    from pyspark.sql import functions as F

    schema = spark.createDataFrame([], "id bigint, name string, extra date").schema
    sinks.create_tables(spark, {"people_kept": schema})
    sinks.create_tables(spark, {"people_kept": schema})
    try:
        df = spark.range(5).select("id", F.lit("x").alias("name"))
        assert sinks.replace_rows(df, "people_kept") == 5
        assert sinks.replace_rows(df, "people_kept") == 5
        assert spark.table("people_kept").count() == 5
        assert spark.table("people_kept").schema.simpleString() == "struct<id:bigint,name:string,extra:date>"
        sinks.overwrite_table(df.select("id"), "people_kept")
        assert spark.table("people_kept").columns == ["id"]
    finally:
        sinks.drop_tables(spark, {"people_kept": schema})
    sinks.drop_tables(spark, {"people_kept": schema})


def test_two_runs_do_not_touch_each_other(spark, tmp_path):
    from concurrent.futures import ThreadPoolExecutor

    df = spark.createDataFrame([("a",), (None,)], "c string")
    root = str(tmp_path / "runs")

    def publish(i):
        results = run_checks(df, Rules(non_null_columns=("c",) * (i % 2)))
        return sinks.publish_run(results, build_summary(results, f"source-{i}"), root, f"run-{i}")

    with ThreadPoolExecutor(4) as pool:
        list(pool.map(publish, range(4)))
    runs = {r.run_id: (r.input_file, r.checks_total) for r in history.published_runs(spark, root).collect()}
    assert runs == {f"run-{i}": (f"source-{i}", 1 + i % 2) for i in range(4)}


def test_a_run_published_again_is_never_mixed(spark, tmp_path):
    root = str(tmp_path / "runs")
    assert history.find_runs(spark, root).count() == 0
    assert history.run_report(spark, root, "run").count() == 0
    for i, rules in enumerate((Rules(non_null_columns=("c",)), Rules(non_null_columns=("c",), unique_columns=("c",)))):
        df = spark.createDataFrame([("a",)] * (i + 1), "c string")
        results = run_checks(df, rules)
        sinks.publish_run(results, build_summary(results, f"source-{i}", f"2026-01-0{i + 1} 00:00:00"), root, "run")
    found = history.find_runs(spark, root).collect()
    assert [(r.run_id, r.input_file, r.checks_total, r.row_count) for r in found] == [("run", "source-1", 3, 2)]
    kept = history.published_runs(spark, root).collect()
    assert [(r.run_id, r.input_file, r.checks_total) for r in kept] == [("run", "source-1", 3)]
    assert history.run_report(spark, root, "run").count() == 3


def test_written_text_is_read_as_written(spark, tmp_path):
    rng = random.Random(3)
    cells = ["", " ", "NULL", '"', '""', ",", "a,b", "\\", '\\"', " x ", "#x", "'", "é漢", "a\tb"]
    cells += ["".join(rng.choice('ab,"\\ \';#é') for _ in range(rng.randrange(8))) for _ in range(300)]
    rows = [(str(i), a, b) for i, (a, b) in enumerate(zip(cells, cells[::-1]))]
    df = spark.createDataFrame(rows, "id string, `a b` string, `c,d` string")
    for turn in range(2):
        path = str(tmp_path / f"turn-{turn}.csv")
        sinks.write_csv(df, path)
        df = files.load_text(spark, path)
        assert df.columns == ["id", "a b", "c,d"]
        assert sorted(map(tuple, df.collect())) == sorted(rows)


def test_files_are_labelled_by_name(spark, tmp_path):
    for name in ("first case.csv", "second+case.csv"):
        csv(tmp_path, "id,name\n1,x\n2,\n", name)
    (tmp_path / "notes.txt").write_text("not a table")
    df = files.load_scenarios(spark, str(tmp_path))
    rows = run_checks(df, Rules(non_null_columns=("name",)), by=["scenario"]).filter("seq = 1").collect()
    assert {(r.scenario, r.failed_rows) for r in rows} == {("first case", 1), ("second+case", 1)}


def test_stream_of_csv_files(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    schema = spark.createDataFrame([], "id string, name string").schema
    where = [str(folder), schema, Rules(non_null_columns=("name",)), str(tmp_path / "history"), str(tmp_path / "state")]

    def arrive(name, text):
        (folder / name).write_text(text)
        revalidate(spark, *where, file_format="csv", header="true").awaitTermination()
        return [(r.row_count, r.checks_failed) for r in batch_history(spark, where[3]).collect()]

    assert arrive("one.csv", "id,name\n1,x\n2,y\n") == [(2, 0)]
    # Only what arrived since is validated.
    assert arrive("two.csv", "id,name\n3,\n") == [(2, 0), (1, 1)]


def test_files_with_another_column_order_are_refused(spark, tmp_path):
    (tmp_path / "a.csv").write_text("id,name,country\n1,Alpha,NL\n")
    (tmp_path / "b.csv").write_text("country,id,name\nFR,3,Gamma\n")
    with pytest.raises(Exception):
        files.read_text_table(spark, str(tmp_path), folder=True).collect()


def test_scenarios_are_read_by_their_own_headers(spark, tmp_path):
    csv(tmp_path, "id,name\n1,Acme\n", "a.csv")
    csv(tmp_path, "name,id\nBeta,2\n,3\n", "b {x}, [y].csv")
    csv(tmp_path, "id,extra\n4,more\n", "c.csv")
    csv(tmp_path, "", "empty.csv")
    folder = tmp_path / "d.csv"
    folder.mkdir()
    csv(folder, "id,name\n5,Delta\n", "part-0.csv")
    csv(folder, "id,name\n6,Echo\n", "part-1.csv")
    df = files.load_scenarios(spark, str(tmp_path))
    assert sorted(df.columns) == ["extra", "id", "name", "scenario"]
    rows = sorted(df.select("scenario", "id", "name", "extra").collect())
    assert [tuple(r) for r in rows] == [
        ("a", "1", "Acme", None), ("b {x}, [y]", "2", "Beta", None), ("b {x}, [y]", "3", None, None),
        ("c", "4", None, "more"), ("d", "5", "Delta", None), ("d", "6", "Echo", None)]
    scans = df._jdf.queryExecution().executedPlan().toString().count("FileScan csv")
    assert scans == 3  # one a header, not one a file


def test_a_part_with_another_header_is_an_error(spark, tmp_path):
    folder = tmp_path / "d.csv"
    folder.mkdir()
    csv(folder, "id,name\n5,Delta\n", "part-0.csv")
    csv(folder, "name,id\nEcho,6\n", "part-1.csv")
    with pytest.raises(Exception, match="header"):
        files.load_scenarios(spark, str(tmp_path)).collect()


def test_scenarios_without_any_header(spark, tmp_path):
    csv(tmp_path, "", "empty.csv")
    with pytest.raises(files.UnreadableInput):
        files.load_scenarios(spark, str(tmp_path))


def test_rows_are_checked_while_they_are_stored(spark):
    schema = spark.createDataFrame([], "id bigint, name string, amount double, extra date").schema
    rows = [(1, "a", 1.0), (2, None, -3.0), (2, "c", None), (None, "d", 5.0)]
    rules = Rules(
        required_columns=("id", "absent"), non_null_columns=("name", "extra"), unique_columns=("id",),
        positive_numeric_columns=("amount",), allowed_values={"name": ("a", "c")}, null_thresholds={"id": 0.2})
    sinks.create_tables(spark, {"checked_rows": schema})
    try:
        df = spark.createDataFrame(rows, "id int, name string, amount double")
        for _ in range(2):  # a second load replaces the rows of the first
            run = store_and_validate(df, "checked_rows", rules)
        plain = validate_frame(spark.table("checked_rows"), rules)
        assert run.report.collect() == plain.report.collect()
        assert spark.table("checked_rows").count() == 4
        empty = store_and_validate(df.filter("id < 0"), "checked_rows", rules)
        assert empty.report.collect() == validate_frame(spark.table("checked_rows"), rules).report.collect()
        assert spark.table("checked_rows").count() == 0
    finally:
        sinks.drop_tables(spark, {"checked_rows": schema})
