"""Readers and writers."""

import json

import pytest
from pyspark.sql import functions as F

from fareflow import schemas, sinks, sources, workspace
from fareflow.plans import gold, history, testbed
from fareflow.sources import message_log
from fareflow.sources.message_log import offsets_option


def test_delimited_text_with_and_without_schema(spark, tmp_path):
    (tmp_path / "a.csv").write_text(",airline,price\n0,IndiGo,5\n1,,\n")
    inferred = sources.read_delimited(spark, str(tmp_path / "a.csv"))
    assert inferred.columns == ["_c0", "airline", "price"]
    assert dict(inferred.dtypes)["price"] == "int"
    declared = schemas.struct(n=schemas.LONG, airline=schemas.STRING, price=schemas.DOUBLE)
    assert [tuple(r) for r in sources.read_delimited(spark, str(tmp_path / "a.csv"), declared).collect()] == [
        (0, "IndiGo", 5.0), (1, None, None),
    ]


def test_missing_table_is_empty_and_other_errors_stay(spark, tmp_path):
    assert sources.read_or_empty(spark, str(tmp_path / "no"), schemas.CANONICAL).count() == 0
    assert sources.read_or_empty(spark, str(tmp_path / "no"), schemas.CANONICAL).schema == schemas.CANONICAL
    with pytest.raises(Exception, match="no_such_format"):
        sources.read_or_empty(spark, str(tmp_path), schemas.CANONICAL, "no_such_format")


def test_overwrite_changes_the_schema_and_append_adds(spark, tmp_path):
    path = str(tmp_path / "t")
    sinks.overwrite_table(spark.range(3), path)
    sinks.append_table(spark.range(2), path)
    assert sources.read_table(spark, path).count() == 5
    sinks.overwrite_table(spark.range(1).withColumn("b", F.lit("x")), path)
    assert sources.read_table(spark, path).columns == ["id", "b"]


def test_a_table_can_replace_itself(spark, tmp_path):
    path = str(tmp_path / "t")
    sinks.overwrite_table(spark.range(4), path)
    sinks.replace_own_input(sources.read_table(spark, path).filter("id > 1"), path)
    assert sources.read_table(spark, path).count() == 2


def test_empty_input_writes_nothing(spark, tmp_path):
    path = str(tmp_path / "t")
    assert not sinks.write_unless_empty(spark.range(0), path)
    assert not (tmp_path / "t").exists()
    assert sinks.write_unless_empty(spark.range(1), path)
    assert not gold.refresh_gold(spark.createDataFrame([], "event_timestamp timestamp"), path)


def test_check_table_compares_names_and_types(spark):
    expected = schemas.struct(id=schemas.LONG)
    assert tuple(sinks.check_table(spark.range(3), expected).first()) == (3, 1, True)
    wrong = schemas.struct(id=schemas.STRING)
    assert tuple(sinks.check_table(spark.range(3), wrong).first()) == (3, 1, False)


def test_parts_are_united_by_name(spark, tmp_path):
    for n in range(2):
        sinks.overwrite_table(spark.range(n, n + 2), f"{tmp_path}/{n}")
    assert sources.read_parts(spark, [f"{tmp_path}/0", f"{tmp_path}/1"]).count() == 4
    other = spark.createDataFrame([("x", 9)], "b string, id long")
    united = sources.union_parts([spark.range(1), other])
    assert [tuple(r) for r in united.orderBy("id").collect()] == [(0, None), (9, "x")]


def test_query_over_named_frames(spark):
    out = sources.query_over("SELECT count(*) AS n FROM {a} JOIN {b} USING (id)", a=spark.range(5), b=spark.range(3))
    assert out.first()["n"] == 3


def test_rows_from_memory_have_the_declared_types(spark):
    quote = ("IndiGo", "a", "b", "06:00", "08:00", "Economy", 120.0, 0, 3)
    assert sources.rows_to_frame(spark, [quote], schemas.QUOTE).schema == schemas.QUOTE


def test_offsets_merge_and_resume(spark, tmp_path):
    log = spark.createDataFrame(
        [("t", 0, 3, b"x"), ("t", 0, 4, b"x"), ("t", 1, 9, b"x")], "topic string, partition int, offset long, value binary"
    )
    saved = spark.createDataFrame([("t", 0, 4), ("t", 2, 7)], schemas.OFFSETS)
    unread = sources.read_from_offsets(log, saved)
    assert sorted((r.partition, r.offset) for r in unread.collect()) == [(0, 4), (1, 9)]
    merged = sources.merge_offsets(saved, sources.next_offsets(unread))
    assert {(r.partition, r.next_offset) for r in merged.collect()} == {(0, 5), (1, 10), (2, 7)}
    assert json.loads(offsets_option(merged)) == {"t": {"0": 5, "1": 10, "2": 7}}
    assert offsets_option(None) == offsets_option(merged.filter("false")) == "earliest"
    sinks.overwrite_table(log, f"{tmp_path}/log")
    assert sources.read_log(spark, merged, "parquet", path=f"{tmp_path}/log").count() == 0
    assert sources.read_log(spark, None, "parquet", path=f"{tmp_path}/log").count() == 3


def test_spread_leaves_a_wide_scan_alone(spark):
    wide = spark.range(0, 100, 1, 64)
    assert sources.spread(wide) is wide
    assert sources.spread(spark.range(0, 100, 1, 1), "id").rdd.getNumPartitions() == 8


def test_one_file_is_spread_and_a_part_of_a_stream_has_rows_for_each_core(spark, tmp_path):
    """A file of one row group is planned as several tasks, of which one reads all rows."""
    cores = spark.sparkContext.defaultParallelism
    spark.range(0, 200_000, 1, 1).selectExpr("id", "sha2(string(id), 256) AS t").write.parquet(f"{tmp_path}/one")
    one = spark.read.parquet(f"{tmp_path}/one")
    assert one.rdd.getNumPartitions() > 1
    assert len(sources.spread(one, "id").groupBy(F.spark_partition_id()).count().collect()) == cores
    seen = []

    def run(rows):
        def work(batch, batch_id):
            seen.append(len(batch.groupBy(F.spark_partition_id()).count().collect()))

        sinks.run_to_end(sinks.each_batch(rows, work, f"{tmp_path}/checkpoint"))

    testbed.in_parts(one, [F.col("id") < 1000, F.col("id") >= 1000], run)
    assert seen == [cores, cores]


def test_settled_tables_go_to_the_shared_folder(spark):
    folder = workspace.shared_folder(spark)
    assert workspace.new_folder(spark, "x").startswith(folder)
    assert workspace.shared_folder(spark) == folder
    settled = workspace.settle(spark.range(5), "numbers")
    assert settled.count() == 5
    assert all(f"{folder}/fareflow/numbers-" in f for f in settled.inputFiles())


def test_history_gold_is_written(spark, tmp_path):
    rows = spark.createDataFrame([], schemas.CANONICAL)
    names = ("flight_fare_analytics", "route_fare_analytics", "ml_training_data")
    history.write_history_gold(rows, {n: f"{tmp_path}/{n}" for n in names})
    assert sources.read_table(spark, f"{tmp_path}/ml_training_data").columns[0] == "airline"


def test_parts_of_differing_columns_are_united(spark, tmp_path):
    sinks.overwrite_table(spark.range(2), f"{tmp_path}/early")
    sinks.overwrite_table(spark.range(2, 4).selectExpr("id", "id * 2 AS x"), f"{tmp_path}/late")
    for order in (["early", "late"], ["late", "early"]):
        rows = sources.read_parts(spark, [f"{tmp_path}/{p}" for p in order])
        assert sorted((r["id"], r["x"]) for r in rows.collect() if r["x"] is not None) == [(2, 4), (3, 6)]
        assert rows.count() == 4


def test_overwrite_leaves_the_old_table_when_it_fails(spark, tmp_path):
    path = f"{tmp_path}/table"
    sinks.overwrite_table(spark.range(3), path)
    with pytest.raises(Exception, match="boom"):
        sinks.overwrite_table(spark.range(5).selectExpr("raise_error('boom') AS id"), path)
    assert spark.read.parquet(path).count() == 3
    sinks.overwrite_table(spark.read.parquet(path).filter("id > 0"), path)
    assert spark.read.parquet(path).count() == 2
    assert [p.name for p in tmp_path.iterdir()] == ["table"]


def test_scratch_folders_are_removed(spark):
    with workspace.scratch(spark):
        path = workspace.new_folder(spark, "x")
        spark.range(1).write.parquet(path)
        assert workspace.exists(spark, path)
    assert not workspace.exists(spark, path)


def test_new_partitions_of_a_topic_get_offsets(spark):
    saved = spark.createDataFrame([("t", 0, 7)], "topic string, partition int, next_offset long")
    present = spark.createDataFrame([("t", 0), ("t", 1)], "topic string, partition int")
    assert sorted(map(tuple, message_log.with_new_partitions(saved, present).collect())) == [("t", 0, 7), ("t", 1, 0)]
