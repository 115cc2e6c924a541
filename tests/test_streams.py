"""Streams over several files: equal to batch, late rows dropped, restart without repeats."""

import pytest
from pyspark.sql import functions as F

from fareflow import schemas, streaming
from fareflow.operators import dedup, summaries, windows
from fareflow.plans import gold, live, testbed
from fareflow.sinks import append_stream, append_table, run_to_end
from fareflow.sources import decode_payload, stream_log, stream_table

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture
def events(spark, tmp_path):
    """Writes part n of the events, in event order, as its own file of a growing table."""
    table = testbed.table(spark, SF_DIR, "events")
    size = -(-table.count() // 3)

    def add(part: int) -> str:
        chosen = table.filter(F.floor(F.col("event_id") / size) == part)
        testbed.live_rows(chosen).coalesce(1).write.mode("append").parquet(f"{tmp_path}/rows")
        testbed.live_log(chosen).coalesce(1).write.mode("append").parquet(f"{tmp_path}/log")
        return str(tmp_path)

    return add


def rows_stream(spark, folder, **options):
    return stream_table(spark, f"{folder}/rows", schemas.PAYLOAD, **options)


def same_rows(left, right):
    assert sorted(map(str, left.select(right.columns).collect())) == sorted(map(str, right.collect()))


def test_ingest_resumes_and_repeats_nothing(spark, events, tmp_path):
    for part in range(3):
        folder = events(part)
        streaming.ingest_log(stream_log(spark, "parquet", path=f"{folder}/log"), f"{tmp_path}/out")
    streaming.ingest_log(stream_log(spark, "parquet", path=f"{folder}/log"), f"{tmp_path}/out")
    batch = decode_payload(spark.read.parquet(f"{folder}/log"))
    same_rows(spark.read.parquet(f"{tmp_path}/out/rows").drop("batch_id"), batch)


def test_clean_stream_equals_batch(spark, events, tmp_path):
    for part in range(2):
        folder = events(part)
        streaming.run_clean(rows_stream(spark, folder), f"{tmp_path}/out")
    same_rows(spark.read.parquet(f"{tmp_path}/out/rows"), live.clean_live(spark.read.parquet(f"{folder}/rows")))


@pytest.mark.parametrize("mode", ["bounded", "global"])
def test_dedup_across_batches(spark, events, tmp_path, mode):
    for part in range(3):
        folder = events(part)
        clean = live.clean_live(rows_stream(spark, folder))
        unique = streaming.drop_repeats(clean, ["event_id"], mode=mode)
        run_to_end(append_stream(unique, f"{tmp_path}/out", f"{tmp_path}/state"))
    out = spark.read.parquet(f"{tmp_path}/out")
    batch = live.clean_live(spark.read.parquet(f"{folder}/rows"))
    # Copies sit five minutes apart in the same file, so no key has expired between them.
    assert out.count() == out.select("event_id").distinct().count()
    if mode == "global":
        assert out.count() <= batch.select("event_id").distinct().count()


def test_bounded_dedup_forgets_an_old_key(spark, tmp_path):
    def step(n, time, kept):
        row = spark.createDataFrame([("k", time)], "event_id string, t string")
        append_table(row.select("event_id", F.col("t").cast("timestamp").alias("event_timestamp")).coalesce(1), f"{tmp_path}/in")
        source = spark.readStream.schema("event_id string, event_timestamp timestamp").parquet(f"{tmp_path}/in")
        for mode, expected in kept.items():
            unique = streaming.drop_repeats(source, ["event_id"], mode=mode)
            run_to_end(append_stream(unique, f"{tmp_path}/{mode}", f"{tmp_path}/{mode}-state"))
            assert spark.read.parquet(f"{tmp_path}/{mode}").count() == expected

    step(0, "2026-01-01 10:00:00", {"bounded": 1, "global": 1})
    step(1, "2026-01-01 10:30:00", {"bounded": 1, "global": 1})
    step(2, "2026-01-01 16:00:00", {"bounded": 1, "global": 1})
    step(3, "2026-01-01 17:30:00", {"bounded": 2, "global": 1})
    with pytest.raises(ValueError):
        streaming.drop_repeats(spark.range(1), mode="none")


def test_late_rows_are_dropped_and_counted(spark, tmp_path):
    schema = "event_id string, event_timestamp timestamp, route string, class string, price double"

    def run(event, time, price):
        row = spark.createDataFrame([(event, time, price)], "event_id string, t string, price double")
        shaped = row.selectExpr("event_id", "timestamp(t) AS event_timestamp", "'r' AS route", "'c' AS class", "price")
        append_table(shaped.coalesce(1), f"{tmp_path}/in")
        source = spark.readStream.schema(schema).parquet(f"{tmp_path}/in")
        return streaming.count_late_rows(spark, lambda: streaming.run_windows(source, f"{tmp_path}/out"))

    assert run("a", "2026-01-01 10:05:00", 1.0) == 0
    run("b", "2026-01-01 15:05:00", 2.0)
    assert run("c", "2026-01-01 10:06:00", 3.0) == 1
    closed = spark.read.parquet(f"{tmp_path}/out/rows")
    assert {(r.min_price, r.price_observations) for r in closed.collect()} == {(1.0, 1)}
    assert closed.count() == 3


def test_late_rows_are_counted_over_more_batches_than_a_query_reports(spark, tmp_path, monkeypatch):
    kept = spark.conf.get("spark.sql.streaming.numRecentProgressUpdates")
    spark.conf.set("spark.sql.streaming.numRecentProgressUpdates", "3")
    try:
        times = ["2026-01-02 10:00:00", "2026-01-02 10:00:01", *["2026-01-01 10:00:00"] * 8]
        for n, time in enumerate(times):
            row = spark.createDataFrame([(str(n), time)], "event_id string, t string")
            append_table(row.selectExpr("event_id", "timestamp(t) AS event_timestamp").coalesce(1), f"{tmp_path}/in")
        source = spark.readStream.schema("event_id string, event_timestamp timestamp")
        source = source.option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/in")
        unique = streaming.drop_repeats(source, ["event_id"])
        writer = append_stream(unique, f"{tmp_path}/out", f"{tmp_path}/state")
        assert streaming.count_late_rows(spark, lambda: run_to_end(writer)) == 8
    finally:
        spark.conf.set("spark.sql.streaming.numRecentProgressUpdates", kept)


def unique_rows(spark, folder):
    return dedup.first_per_key(live.clean_live(spark.read.parquet(f"{folder}/rows")), ["event_id"], ["event_timestamp"])


def test_closed_windows_equal_batch_windows(spark, events, tmp_path):
    for part in range(3):
        folder = events(part)
    clean = live.clean_live(rows_stream(spark, folder))
    streaming.run_windows(clean, f"{tmp_path}/out")
    batch = unique_rows(spark, folder)
    latest = live.clean_live(spark.read.parquet(f"{folder}/rows")).agg(F.max("event_timestamp")).first()[0]
    closed = windows.sliding_summary(batch).filter(F.col("window_end") <= F.lit(latest) - F.expr("interval 1 hour"))
    same_rows(spark.read.parquet(f"{tmp_path}/out/rows"), closed)


def test_gold_refresh_keeps_up(spark, events, tmp_path):
    out = f"{tmp_path}/gold"
    for part in range(3):
        folder = events(part)
        # Parts go by event number, not by time: keys are kept for ever, so no row is late.
        streaming.refresh_gold_stream(live.clean_live(rows_stream(spark, folder)), out, mode="global")
        batch = unique_rows(spark, folder)
        same_rows(gold.read_gold(spark, out, "route_price_analytics"), gold.route_prices_sql(batch))
    # Nothing new: the empty run writes nothing and the tables stay.
    streaming.refresh_gold_stream(live.clean_live(rows_stream(spark, folder)), out, mode="global")
    direct = summaries.fare_summary(batch, gold.CARRIER_KEYS, averages=())
    same_rows(gold.read_gold(spark, out, "airline_price_analytics"), direct)
    same_rows(gold.read_gold(spark, out, "price_window_analytics"), windows.sliding_summary(batch))


def test_replayed_batch_changes_nothing(spark, events, tmp_path):
    clean = live.clean_live(spark.read.parquet(f"{events(0)}/rows"))
    more = live.clean_live(spark.read.parquet(f"{events(1)}/rows")).exceptAll(clean)
    whole = clean.unionAll(more)
    out = f"{tmp_path}/gold"
    for batch_id, batch in ((0, clean), (0, clean), (1, more), (1, more), (1, more)):
        gold.refresh_parts(batch, batch_id, out)
    same_rows(gold.read_gold(spark, out, "airline_price_analytics"), summaries.fare_summary(whole, gold.CARRIER_KEYS, averages=()))
    same_rows(gold.read_gold(spark, out, "price_window_analytics"), windows.sliding_summary(whole))


def test_only_touched_months_are_written_again(spark, tmp_path):
    def batch(*times):
        rows = [(f"e{t}", t, "r", t[:10], "x", "X", "c", 1.0) for t in times]
        schema = "event_id string, t string, route string, d string, airline string, airline_code string, class string, price double"
        df = spark.createDataFrame(rows, schema)
        return df.selectExpr("*", "timestamp(t) AS event_timestamp", "date(d) AS travel_date")

    out, first = f"{tmp_path}/gold", batch("2026-01-31 23:55:00", "2026-02-10 10:00:00", "2026-03-01 00:05:00")
    second, third = batch("2026-02-01 00:01:00"), batch("2026-02-20 10:00:00")
    gold.refresh_parts(first, 0, out)
    march = sorted(p.name for p in (tmp_path / "gold/price_window_analytics/part=2026-03-01").glob("*.parquet"))
    gold.refresh_parts(second, 1, out)
    gold.refresh_parts(third, 2, out)
    assert sorted(p.name for p in (tmp_path / "gold/price_window_analytics/part=2026-03-01").glob("*.parquet")) == march
    whole = first.unionAll(second).unionAll(third)
    same_rows(gold.read_gold(spark, out, "price_window_analytics"), windows.sliding_summary(whole))
    same_rows(gold.read_gold(spark, out, "route_price_analytics"), gold.route_prices_sql(whole))
    assert sorted(p.name for p in (tmp_path / "gold/partials/time/part=2026-02-01").glob("upto=*")) == ["upto=1", "upto=2"]
