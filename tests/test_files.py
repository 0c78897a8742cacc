from __future__ import annotations

import os

import pytest
from conftest import plan
from pyspark.sql import functions as F

from clicklake.sources import files, schemas

EVENTS = "/root/testdata/sf0.001/events.parquet"


def test_layouts_by_year():
    assert schemas.log_layout(1999) == schemas.log_layout(2014) == {"user_id": 36, "email": 38, "ts": 1}
    assert schemas.log_layout(2017) == {"user_id": 32, "email": 34, "ts": 1}
    assert schemas.log_layout(2018) == {"user_id": 27, "email": 28, "ts": 2}
    with pytest.raises(ValueError, match="2019"):
        schemas.log_layout(2019)


@pytest.mark.parametrize(
    ("schema", "columns"),
    [("PAGE_POSTS", 14), ("SOURCE_EVENTS", 7), ("RAW_POSTS", 18), ("REGISTRATIONS", 11), ("FRAUD_PAGE_VIEWS", 15),
     ("PAGE_TIMING", 7), ("MAIL_READERS", 4), ("USER_AGENTS", 1), ("GEO_RECORD", 8)],
)
def test_schemas_parse(spark, schema, columns):
    assert len(spark.createDataFrame([], getattr(schemas, schema)).columns) == columns


def test_export_is_sorted_across_files_and_splits_a_hot_user(spark, tmp_path):
    hot = F.when(F.col("id") % 3 == 0, F.lit(5)).otherwise(F.col("id") % 11)
    df = spark.range(30_000).select(hot.alias("user"), F.hash("id").alias("ts"))
    path = str(tmp_path / "sorted")
    files.write_parquet(files.sorted_export(df, ["user"], ["ts"], partitions=8), path)
    read = spark.read.parquet(path).withColumn("file", F.input_file_name())
    parts = [p.user_ts for p in read.groupBy("file").agg(
        F.struct(F.min(F.struct("user", "ts")).alias("a"), F.max(F.struct("user", "ts")).alias("b")).alias("user_ts")
    ).orderBy("file").collect()]
    assert len(parts) == 8
    assert all(tuple(x.b) <= tuple(y.a) for x, y in zip(parts, parts[1:]))
    assert read.where("user = 5").select("file").distinct().count() >= 3
    one = spark.read.parquet(sorted(p.file for p in read.select("file").distinct().collect())[0])
    listed = [tuple(r) for r in one.collect()]
    assert listed == sorted(listed)


def test_single_file_on_request(spark, tmp_path):
    df = spark.range(100).repartition(4)
    files.write_csv(df, str(tmp_path / "one"), single_file=True)
    files.write_csv(df, str(tmp_path / "many"))
    assert len(list((tmp_path / "one").glob("*.csv"))) == 1
    assert len(list((tmp_path / "many").glob("*.csv"))) == 4


def test_table_reads_one_partition(spark, tmp_path):
    events = spark.read.parquet(EVENTS).withColumn("hour", F.date_format("ts", "HH"))
    files.write_table(events, "hourly_pruned", ["hour"], str(tmp_path / "table"))
    df = spark.sql("SELECT count(1) AS n FROM hourly_pruned WHERE hour = '08'")
    assert df.first().n == events.where("hour = '08'").count()
    assert "PartitionFilters: [isnotnull(hour" in plan(df)


def test_leafs_keep_partition_columns(spark, tmp_path):
    path = str(tmp_path / "leafs")
    files.write_parquet(spark.range(10).selectExpr("id", "id % 5 as p"), path, partition_by=["p"])
    read = files.read_partition_leafs(spark, path, ["p=1", "p=3"])
    assert sorted((r.id, r.p) for r in read.collect()) == [(1, 1), (3, 3), (6, 1), (8, 3)]


def test_filters_and_columns_reach_the_scan(spark):
    df = files.read_parquet(spark, EVENTS).where("user_id = 3").select("event_id")
    text = plan(df)
    assert "PushedFilters: [IsNotNull(user_id), EqualTo(user_id,3)]" in text
    assert "ReadSchema: struct<event_id:bigint,user_id:bigint>" in text


def test_metrics_are_appended(spark, tmp_path):
    target = str(tmp_path / "metrics")
    for _ in range(2):
        files.append_metrics(spark.range(3), target)
    assert spark.read.parquet(target).count() == 6


def test_shared_folder_comes_from_the_session(spark):
    root = spark.conf.get("spark.checkpoint.dir")
    first, second = files.shared_dir(spark), files.shared_dir(spark)
    assert first != second and first.startswith(f"{root}/clicklake-")


def test_shared_folder_without_a_setting():
    assert files.shared_root("hdfs://a/b/", "file:/w", is_local=True, one_machine=False) == "hdfs://a/b"
    assert files.shared_root(None, "hdfs://a/w/", is_local=False, one_machine=False) == "hdfs://a/w/scratch"
    assert files.shared_root(None, "file:/w", is_local=True, one_machine=True) == "file:/w/scratch"
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        files.shared_root(None, "file:/w", is_local=True, one_machine=False)


def test_scratch_tables_go_when_dropped(spark):
    scratch = files.Scratch(spark)
    one, other = scratch.settled(spark.range(5)), scratch.settled(spark.range(7))
    folder = one.inputFiles()[0].removeprefix("file://").rsplit("/", 1)[0]
    assert os.path.isdir(folder)
    scratch.drop(one)
    assert not os.path.exists(folder) and other.count() == 7
    scratch.drop(spark.range(1))


def test_times_of_every_usual_form_are_read(spark, tmp_path):
    forms = ["2031-03-04 05:06:07", "2031-03-04T05:06:07", "2031-03-04T05:06:07.125Z", "2031-03-04 05:06:07+00:00"]
    (tmp_path / "t.csv").write_text("ts\n" + "\n".join(forms) + "\n")
    (tmp_path / "j").mkdir()
    (tmp_path / "j" / "t.json").write_text("\n".join('{"ts": "%s"}' % f for f in forms) + "\n")
    want = ["2031-03-04 05:06:07"] * 4
    shown = F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("t")
    assert [r.t for r in files.read_csv(spark, str(tmp_path / "t.csv"), "ts timestamp").select(shown).collect()] == want
    assert [r.t for r in files.read_json_tree(spark, str(tmp_path / "j"), "ts timestamp").select(shown).collect()] == want
    given = files.read_csv(spark, str(tmp_path / "t.csv"), "ts timestamp", timestampFormat="yyyy-MM-dd HH:mm:ss")
    assert given.where("ts IS NOT NULL").count() == 1


def test_settled_rows_are_read_from_their_table(spark):
    df = files.settled(spark.range(5))
    assert df.count() == 5 and "FileScan parquet" in plan(df)
