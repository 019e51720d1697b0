"""Readers, and the options of the warehouse read."""

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import types as T

from cohortloom.session import discard, saved, scratch_path, shared_dir
from cohortloom.sources import readers, sinks


def test_warehouse_options():
    options = readers.warehouse_options("jdbc:x", "terms", "u", "p", split=("id", "1", "100", 8))
    assert options["fetchsize"] == "40000" and options["numPartitions"] == "8" and options["dbtable"] == "terms"
    assert "partitionColumn" not in readers.warehouse_options("jdbc:x", "terms", "u", "p")


def test_snapshot_read_prunes_partitions(spark, tmp_path):
    df = spark.createDataFrame([("1", "20180701"), ("2", "20170702")], "emplid string, snapshot_date string")
    path = str(tmp_path / "snap")
    sinks.table_persist(df, path, ["snapshot_date"])
    day = readers.snapshot_read(spark, path, "20180701")
    assert [r.emplid for r in day.collect()] == ["1"]
    plan = day._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(snapshot_date" in plan


def test_delimited_read_renames_and_blanks(spark, tmp_path):
    (tmp_path / "a.txt").write_text("A\tB\nx\t1.5\n \t2\n")
    schema = T.StructType.fromDDL("a string, b double")
    rows = readers.delimited_read(spark, str(tmp_path / "a.txt"), schema, ["name", "gpa"]).collect()
    assert [(r.name, r.gpa) for r in rows] == [("x", 1.5), (None, 2.0)]


def test_json_array_read(spark, tmp_path):
    (tmp_path / "d1.json").write_text('{\n "data": [\n  {"id": "1", "name": "N"},\n  {"id": "2", "type": "T"}\n ]\n}')
    (tmp_path / "d2.json").write_text('{\n "data": []\n}')
    rows = readers.json_array_read(spark, str(tmp_path)).orderBy("id").collect()
    assert [(r.id, r.name, r.type, r.pronouns) for r in rows] == [("1", "N", None, None), ("2", None, "T", None)]


def test_scratch_lies_in_the_shared_folder(spark):
    assert scratch_path(spark, "x").startswith(shared_dir(spark).rstrip("/"))
    assert scratch_path(spark, "x") != scratch_path(spark, "x")


def test_fields_are_cut_to_their_place(spark):
    from pyspark.sql import functions as F

    line = sinks.fixed_width({"a": F.lit("abcdef"), "b": F.lit(None)}, {"a": 2, "b": 5}, 7)
    assert spark.range(1).select(line.alias("l")).first().l == " abc   "


def test_discard_deletes_scratch_only(spark):
    path = scratch_path(spark, "rows")
    assert saved(spark.range(5), path).count() == 5
    discard(spark, path)
    with pytest.raises(AnalysisException):
        spark.read.parquet(path)
    with pytest.raises(ValueError):
        discard(spark, "/somewhere/else")
