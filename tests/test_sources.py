"""Readers, sinks, scratch tables and the binding."""

import datetime as dt
import uuid
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from rollcall.plans import flows
from rollcall.schema import FILES, REQUIRED, TABLES
from rollcall.sources import readers, scratch, sinks
from rollcall.sources.star import bind

SMALL = "/root/testdata/sf0.001"


def write(folder, name, text):
    (folder / f"{FILES[name]}.csv").write_text(text)


def test_read_csv_by_name_with_bad_values(spark, tmp_path):
    write(
        tmp_path,
        "compensation",
        "salary,employee_id,effective_date,level,bonus,stock,extra\n100.5,1,2020-01-01,L1,,3,x\nn/a,2.0,2020-13-01,L2,5,0,y\n",
    )
    df = readers.read_table(spark, "compensation", str(tmp_path))
    assert df.columns == TABLES["compensation"].names
    first, second = sorted(df.collect(), key=lambda r: r["employee_id"])
    assert (float(first["salary"]), first["bonus"], float(first["stock"])) == (100.5, None, 3.0)
    assert (second["salary"], second["effective_date"], second["employee_id"]) == (None, None, 2)
    assert first["comp_id"] != second["comp_id"]


def test_boolean_words(spark, tmp_path):
    write(tmp_path, "exits", "employee_id,exit_date,exit_reason,voluntary\n1,2020-01-01,a,True\n2,2020-01-01,b,No\n3,,c,maybe\n")
    got = {r["employee_id"]: r["voluntary"] for r in readers.read_table(spark, "exits", str(tmp_path)).collect()}
    assert got == {1: True, 2: False, 3: None}


def test_load_raw_names_what_is_missing(spark, tmp_path):
    write(tmp_path, "exits", "employee_id\n1\n")
    with pytest.raises(readers.MissingDatasets) as caught:
        readers.load_raw(spark, str(tmp_path))
    assert caught.value.names == [n for n in REQUIRED if n != "exits"]


def test_scratch_tables_keep_rows_and_types(spark):
    df = spark.range(100).selectExpr("id", "CAST(id AS decimal(12,2)) AS m", "IF(id % 7 = 0, NULL, id) AS n")
    kept = scratch.written(df)
    assert kept.schema.simpleString() == df.schema.simpleString()
    assert kept.exceptAll(df).count() == 0


def test_scratch_folder_comes_from_the_session(spark):
    folder = Path(spark.conf.get(scratch.SETTING))
    before = len(list((folder / "rollcall").glob("probe-*")))
    scratch.written(spark.range(3), "probe")
    assert scratch.scratch_folder(spark) == str(folder)
    assert len(list((folder / "rollcall").glob("probe-*"))) == before + 1


class _Cluster:
    """A session that runs on a cluster and names no shared folder."""

    class conf:
        get = staticmethod(lambda key, default=None: default)

    class sparkContext:
        master = "yarn"

        @staticmethod
        def getConf():
            return {}


def test_a_cluster_must_name_its_shared_folder():
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        scratch.scratch_folder(_Cluster)


def test_release_deletes_what_was_written(spark, monkeypatch):
    monkeypatch.setattr(scratch, "_tables", {})
    scratch.written(spark.range(3), "short")
    folder = Path(scratch.scratch_folder(spark)) / "rollcall"
    assert len(list(folder.glob("short-*"))) == 1
    assert scratch.release(spark) == 1
    assert not list(folder.glob("short-*")) and scratch.release(spark) == 0


def test_coerced_values_are_counted(spark):
    rows = [("1", "2020-01-01", "x", "True"), ("a", "soon", "y", ""), (None, "2020-02-30", None, "perhaps")]
    df = spark.createDataFrame(rows, "employee_id string, exit_date string, exit_reason string, voluntary string")
    got = {r["column_name"]: r["coerced"] for r in readers.coerced(df, "exits").collect()}
    assert got == {"employee_id": 1, "exit_date": 2, "voluntary": 1}


def test_sinks_round_trip(spark, tmp_path):
    df = spark.createDataFrame([(1, "x")], "a int, b string")
    for kind in ("csv", "parquet"):
        path = sinks.save_dataframe(df, str(tmp_path / kind), kind)
        back = spark.read.option("header", True).format(kind).load(path)
        assert [str(v) for v in back.first()] == ["1", "x"]
    report = spark.createDataFrame([("s", "c", True, 0, "fine")], "section string, check string, passed boolean, violations bigint, detail string")
    back = spark.read.json(sinks.save_report(report, str(tmp_path / "r"), dt.datetime(2020, 1, 1)))
    assert back.first()["generated_at"] == "2020-01-01T00:00:00" and "violations" not in back.columns


@pytest.mark.parametrize("kind", ["parquet", "csv", "json"])
def test_a_failed_overwrite_keeps_the_old_table(spark, tmp_path, kind):
    """A task fails midway; what was there stays, and nothing else is left."""
    path = str(tmp_path / "table")
    good = spark.createDataFrame([(i, f"line {i}\nnext") for i in range(20)], "a int, b string").repartition(4)
    sinks.save_dataframe(good, path, kind)
    bad = good.withColumn("b", F.when(F.col("a") == 13, F.raise_error(F.lit("midway"))).otherwise(F.col("b")))
    with pytest.raises(Exception, match="midway"):
        sinks.save_dataframe(bad, path, kind)
    back = spark.read.options(header=True, multiLine=kind == "csv").schema("a int, b string").format(kind).load(path)
    assert sorted((r.a, r.b) for r in back.collect()) == [(i, f"line {i}\nnext") for i in range(20)]
    assert [p.name for p in tmp_path.iterdir() if not p.name.startswith(".")] == ["table"]
    sinks.save_dataframe(good.where("a < 5"), path, kind)
    assert spark.read.options(header=True, multiLine=kind == "csv").schema("a int, b string").format(kind).load(path).count() == 5


def test_a_short_write_keeps_the_old_table(spark, tmp_path, monkeypatch):
    path = sinks.save_dataframe(spark.range(10), str(tmp_path / "table"))
    monkeypatch.setattr(sinks, "_rows_below", lambda *_: 3)
    with pytest.raises(RuntimeError, match="4 rows were written, 3 are there"):
        sinks.save_dataframe(spark.range(4), path)
    assert spark.read.parquet(path).count() == 10 and len(list(tmp_path.iterdir())) == 1


@pytest.mark.parametrize("placed", [True, False])
def test_failed_catalogue_tables_keep_their_rows(spark, tmp_path, placed):
    place = str(tmp_path / "tables") if placed else None
    prefix = f"t{uuid.uuid4().hex[:8]}_"
    (name,) = sinks.save_tables({"x": spark.range(7)}, prefix=prefix, location=place)
    bad = spark.range(9).select(F.when(F.col("id") == 5, F.raise_error(F.lit("midway")).cast("bigint")).otherwise(F.col("id")).alias("id"))
    with pytest.raises(Exception, match="midway"):
        sinks.save_tables({"x": bad}, prefix=prefix, location=place)
    assert spark.table(name).count() == 7
    sinks.save_tables({"x": spark.range(3)}, prefix=prefix, location=place)
    assert spark.table(name).count() == 3
    assert [t.name for t in spark.catalog.listTables() if t.name.startswith(prefix)] == [name]
    spark.sql(f"DROP TABLE {name}")


def test_binding_facts(spark):
    t = bind(spark, SMALL)
    assert {r["status"]: r["count"] for r in t.employees.groupBy("status").count().collect()} == {"Active": 118, "Exited": 32}
    assert t.employees.filter("manager_id IS NULL").count() == 3
    assert t.exits.count() == 32 and t.employees.columns == TABLES["employees"].names
    wide = t.managers.filter("length(manager_id) < 7").count()
    assert wide == 0


def test_validation_flow_over_csv(spark, tmp_path):
    t = bind(spark, SMALL)
    for name in REQUIRED:
        sinks.save_dataframe(getattr(t, name), f"{tmp_path}/{FILES[name]}.csv", "csv")
    report = str(tmp_path / "report")
    assert flows.run_validation(spark, str(tmp_path), t.as_of, report) is False
    failed = {r["check"] for r in spark.read.json(report).filter("NOT passed").collect()}
    expected = {
        "No Null Values",
        "Salary Band Compliance",
        "No Duplicate Assignment Rows",
        "Project Date Order (end ≥ start)",
        "Completion Date (No Future)",
    }
    assert failed == expected


def test_retention_flow_writes_every_table(spark, tmp_path):
    t = bind(spark, SMALL)
    results = flows.run_retention_analysis(t.employees, t.exits, t.as_of, str(tmp_path))
    for name in results:
        assert spark.read.option("header", True).csv(f"{tmp_path}/{name}").count() >= 0
    assert results["retention_summary"].count() == 8
    card = flows.run_manager_analysis(t.tables(), str(tmp_path / "card"))
    assert card.count() == 10
