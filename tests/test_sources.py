"""Sources and sinks: directory round trips, partitioned output, report guard."""

import os

import pytest
from pyspark.sql import functions as F

from riskframe.sources import files, reports
from riskframe.sources.tables import load_table

from .conftest import SF_SMALL


def test_parquet_partitioned_roundtrip(spark, tmp_dir):
    o = load_table(spark, SF_SMALL, "orders")
    path = files.write_table(o, os.path.join(tmp_dir, "o"), partition_by=["o_orderstatus"])
    back = files.read_table(spark, path)
    assert back.count() == o.count()
    # partition pruning: the filter on the partition column becomes a PartitionFilter
    plan = back.where(F.col("o_orderstatus") == "F")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(o_orderstatus" in plan


def test_csv_roundtrip_with_schema(spark, tmp_dir):
    li = load_table(spark, SF_SMALL, "lineitem")
    path = files.write_table(li, os.path.join(tmp_dir, "li"), fmt="csv")
    back = files.read_table(spark, path, "csv", li.schema)
    assert back.schema == li.schema
    assert back.exceptAll(li).count() == 0 and li.exceptAll(back).count() == 0


def test_report_is_one_file_of_any_size(spark, tmp_dir):
    p = reports.write_report(spark.range(0, 1_200_000, 1, 6), os.path.join(tmp_dir, "ok"))
    assert len([f for f in os.listdir(p) if f.endswith(".csv")]) == 1
    assert reports.read_report(spark, p, "id bigint").count() == 1_200_000


def test_csv_columns_are_bound_by_name(spark, tmp_dir):
    path = os.path.join(tmp_dir, "byname.csv")
    with open(path, "w") as f:
        f.write("ID,Source, Severity ,Start_Time,Extra,Start_Lat\n")
        f.write("a,S2,3,2020-01-05 10:00:00,x,39.5\nb,S2,oops,2020-01-05 11:00:00,y,40.5\nc,S3,,bad,z,41\n")
    schema = "Start_Lat double, Severity int, Start_Time timestamp, Missing string, ID string"
    t = files.read_csv(spark, path, schema, rejected="bad")
    assert t.columns == ["Start_Lat", "Severity", "Start_Time", "ID", "bad"]
    rows = {r["ID"]: r for r in t.collect()}
    assert (rows["a"]["Severity"], rows["a"]["Start_Lat"], rows["a"]["Start_Time"].hour) == (3, 39.5, 10)
    assert [rows[k]["bad"] for k in "abc"] == [False, True, True]
    assert rows["b"]["Severity"] is None and rows["c"]["Start_Time"] is None and rows["c"]["Start_Lat"] == 41.0
