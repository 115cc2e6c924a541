"""Tables that batches keep up to date: replays, removals, rejects; selection and sketches."""

import random
from datetime import date
from statistics import median

import pytest
from pyspark.sql import functions as F

from fareflow import schemas, streaming
from fareflow.operators import summaries, windows
from fareflow.plans import gold, live, testbed
from fareflow.sinks import append_stream, append_table, run_to_end
from fareflow.sinks.generations import generations, read_table_of_generations, upsert, write_generation

SF_DIR = "/root/testdata/sf0.001"


def sorted_rows(df):
    return sorted(map(str, df.collect()))


def test_upsert_replaces_keys_and_bears_a_replay(spark, tmp_path):
    folder = str(tmp_path / "t")

    def batch(*rows):
        return spark.createDataFrame(rows, "part date, k string, v int")

    a, b = date(2026, 1, 1), date(2026, 2, 1)
    schema = batch((a, "x", 1)).schema
    upsert(batch((a, "x", 1), (a, "y", 1), (b, "z", 1)), 0, folder, ["k"])
    for _ in range(2):
        upsert(batch((a, "x", 2), (a, "w", 2)), 1, folder, ["k"])
        rows = read_table_of_generations(spark, folder, schema)
        assert sorted(map(tuple, rows.collect())) == [(a, "w", 2), (a, "x", 2), (a, "y", 1), (b, "z", 1)]
    assert generations(spark, folder, "2026-01-01") == [0, 1] and generations(spark, folder, "2026-02-01") == [0]
    upsert(batch((a, "x", 3)), 2, folder, ["k"])
    assert generations(spark, folder, "2026-01-01") == [1, 2]
    write_generation(batch((a, "x", 3)).limit(0), folder, ["2026-01-01"], 3)
    assert [tuple(r) for r in read_table_of_generations(spark, folder, schema).collect()] == [(b, "z", 1)]


@pytest.fixture
def unique(spark):
    rows = live.clean_live(testbed.live_payload(spark, SF_DIR))
    return rows.dropDuplicates(["event_id"]).cache()


def test_open_windows_after_each_batch(spark, unique, tmp_path):
    batches = []

    def run(rows):
        streaming.run_open_windows(rows, str(tmp_path))
        batches.append(rows)

    testbed.in_turns(unique, "event_timestamp", run)
    schema = windows.sliding_summary(unique).schema
    want = sorted_rows(windows.sliding_summary(unique))
    columns = windows.sliding_summary(unique).columns
    assert sorted_rows(streaming.read_windows(spark, str(tmp_path), schema).select(columns)) == want
    testbed.forget_last_batch(spark, f"{tmp_path}/checkpoint", ends_empty=True)
    run(batches[-1])
    assert sorted_rows(streaming.read_windows(spark, str(tmp_path), schema).select(columns)) == want


def test_a_part_that_loses_all_its_rows(spark, unique, tmp_path):
    rows = unique.withColumn("withdrawn", F.lit(False))
    gold.refresh_parts(rows, 0, str(tmp_path), gold.Withdrawals)
    gold.refresh_parts(rows.withColumn("withdrawn", F.col("event_id").cast("long") % 2 == 0).filter("withdrawn"), 1, str(tmp_path), gold.Withdrawals)
    left = unique.filter(F.col("event_id").cast("long") % 2 == 1)
    direct = gold.gold_tables(gold.finest_partials(left))
    for name, table in direct.items():
        assert sorted_rows(gold.read_gold(spark, str(tmp_path), name).select(table.columns)) == sorted_rows(table)
    for _ in range(2):  # a replay takes nothing out twice
        gold.refresh_parts(left.withColumn("withdrawn", F.lit(True)), 2, str(tmp_path), gold.Withdrawals)
    for name in direct:
        assert not list((tmp_path / name).glob("part=*"))


def test_quarantine_counts_what_it_stores(spark, tmp_path):
    payload = testbed.live_payload(spark, SF_DIR)
    append_table(payload, f"{tmp_path}/in")
    stream = spark.readStream.schema(schemas.PAYLOAD).parquet(f"{tmp_path}/in")
    for _ in range(2):
        streaming.run_quarantine(stream, f"{tmp_path}/out")
        testbed.forget_last_batch(spark, f"{tmp_path}/out/checkpoint")
    rows = spark.read.parquet(f"{tmp_path}/out/rows")
    counters = {r.counter: r.value for r in spark.read.parquet(f"{tmp_path}/out/counters").collect()}
    assert counters["rows"] == rows.count() == payload.count()
    assert counters["kept"] == rows.filter("verdict = 'kept'").count() == live.clean_live(payload).count()
    assert all(rows.filter(F.array_contains("failed_rules", n)).count() == counters[n] for n in ("price_present", "carrier_in_scope"))


@pytest.mark.parametrize("kind", ["few", "wide", "crowded", "equal"])
def test_median_by_selection(spark, monkeypatch, kind):
    monkeypatch.setattr(summaries, "BUCKETS", 4)
    monkeypatch.setattr(summaries, "FEW_VALUES", 3)
    rnd = random.Random(kind)
    draw = {"few": lambda: rnd.randint(1, 5), "wide": lambda: rnd.uniform(-1e6, 1e6), "crowded": lambda: 2.0 ** rnd.randint(-40, 60), "equal": lambda: 7}[kind]
    rows = [(rnd.choice(["a", "b", None]), float(draw())) for _ in range(400)] + [("c", 1.0), ("d", None), ("e", 2.0), ("e", 4.0), ("a", float("nan"))]
    got = {r.k: r.median_price for r in summaries.median_price(spark.createDataFrame(rows, "k string, price double"), ["k"]).collect()}
    values = {}
    for k, v in rows:
        values.setdefault(k, []).extend([v] if v is not None and v == v else [])
    assert got == {k: median(v) if v else None for k, v in values.items()}


def test_sketches_merge(spark):
    rows = spark.range(20_000).select((F.col("id") % 3).alias("k"), (F.col("id") % 7000).alias("v"))
    parts = [summaries.distinct_sketches(rows.filter(F.col("v") % 2 == n), {"v": F.col("v")}, ["k"]) for n in (0, 1)]
    merged = summaries.merge_sketches(parts[0].unionByName(parts[1]), ["v"])
    assert abs(summaries.sketch_estimates(merged, ["v"]).first()["estimate"] - 7000) < 210


def test_retained_keys_are_evicted_across_restarts(spark, tmp_path):
    """Keys of a restarted job are in the state for as long as stated, and gone after that."""
    kept = []
    for n, (key, day) in enumerate([("a", 1), ("a", 3), ("b", 12), ("c", 30), ("a", 31)]):
        row = spark.createDataFrame([(key, f"2026-01-{day:02} 10:00:00")], "event_id string, t string")
        append_table(row.select("event_id", F.col("t").cast("timestamp").alias("event_timestamp")), f"{tmp_path}/in")
        source = spark.readStream.schema("event_id string, event_timestamp timestamp").parquet(f"{tmp_path}/in")
        unique = streaming.drop_repeats(source, ["event_id"], delay="10 days")
        with streaming.state_on_disk(spark):
            done = run_to_end(append_stream(unique, f"{tmp_path}/out", f"{tmp_path}/state"))
        kept.append((spark.read.parquet(f"{tmp_path}/out").count(), done.lastProgress["stateOperators"][0]["numRowsTotal"]))
    # a lives to day 11, so its repeat goes; b to day 22; c's time puts the mark at day 20: a is gone, and comes anew
    assert kept == [(1, 1), (1, 1), (2, 2), (3, 2), (4, 3)]


def test_log_steps_read_every_offset_once(spark, tmp_path):
    rows = [("t", p, o * (p + 1), bytes([o % 250])) for p in range(3) for o in range(100)]
    append_table(spark.createDataFrame(rows, "topic string, partition int, offset long, value binary"), f"{tmp_path}/log")
    log, sizes = spark.read.parquet(f"{tmp_path}/log"), []
    while streaming.follow_log(log, str(tmp_path), 60):
        sizes.append(spark.read.parquet(f"{tmp_path}/rows").count())
        if len(sizes) == 2:
            append_table(spark.createDataFrame([("t", 7, 5, b"x")], "topic string, partition int, offset long, value binary"), f"{tmp_path}/log")
            log = spark.read.parquet(f"{tmp_path}/log")
    read = spark.read.parquet(f"{tmp_path}/rows")
    assert sizes[0] == 60 + 30 + 20 and read.count() == read.distinct().count() == 301
