"""Every operator as a named query over the given tables: ``(spark, sf_dir) -> DataFrame``."""

from collections.abc import Callable
from functools import cache

from pyspark.ml import PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from fareflow import functions as X, pricing, streaming
from fareflow.constants import HISTORY_STOPS, LIVE_STOPS, OFFER_KEYS
from fareflow.operators import (
    compare,
    dedup,
    itinerary,
    lookup,
    nearest,
    profile,
    ranking,
    standardize,
    summaries,
    validity,
    windows,
)
from fareflow.plans import gold, history, live, testbed
from fareflow.schemas import CANONICAL, SEARCH_RESPONSE
from fareflow.sinks import (
    append_stream,
    append_table,
    check_table,
    overwrite_table,
    replace_own_input,
    run_to_end,
    write_unless_empty,
)
from fareflow.sources import (
    active_snapshot,
    decode_payload,
    encode_payload,
    merge_offsets,
    next_offsets,
    read_delimited,
    read_from_offsets,
    read_or_empty,
    read_parts,
    read_table,
    spread,
    stream_log,
    stream_table,
    union_parts,
)
from fareflow.workspace import new_folder, remove, settle

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(run: Query) -> Query:
    QUERIES[run.__name__] = run
    return run


def plain_times(df: DataFrame) -> DataFrame:
    """Timestamps without a zone, so that any engine shows the same ones."""
    zoned = [f.name for f in df.schema if isinstance(f.dataType, T.TimestampType)]
    return df.withColumns({c: F.col(c).cast("timestamp_ntz") for c in zoned})


# Inputs


def canonical(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = standardize.add_lineage(testbed.history_raw(spark, sf_dir), source_dataset="history")
    return standardize.canonical_history(raw)


def clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    return live.clean_live(testbed.live_payload(spark, sf_dir))


def unique_live(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup.first_per_key(clean(spark, sf_dir), ["event_id"], ["event_timestamp"])


def text_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return testbed.history_raw(spark, sf_dir).select(
        "airline", "flight", "source_city", "stops", "class", "duration", "days_left", "price"
    )


def baseline_prices(spark: SparkSession, sf_dir: str, rows: DataFrame | None = None) -> DataFrame:
    """Baseline of the unique live rows, or of ``rows`` among them."""
    rows = unique_live(spark, sf_dir) if rows is None else rows
    line = spread(testbed.table(spark, sf_dir, "lineitem"), "l_orderkey", "l_partkey")
    past = standardize.baseline_rows(testbed.shape_history(line), keep=testbed.ROW_ORDER[:-1])
    quotes = settle(testbed.quotes_of(rows), "quotes")
    return nearest.nearest_median(quotes, past, testbed.ROW_ORDER)


# History


@query
def canonical_history(spark, sf_dir):
    checked = standardize.check_schema(canonical(spark, sf_dir), CANONICAL)
    return checked.drop("ingestion_timestamp")


@query
def flight_fare_summary(spark, sf_dir):
    return summaries.fare_summary(canonical(spark, sf_dir), history.FLIGHT_KEYS)


@query
def route_fare_summary(spark, sf_dir):
    return summaries.fare_summary(canonical(spark, sf_dir), history.ROUTE_KEYS)


@query
def route_fare_rollup(spark, sf_dir):
    return history.history_summaries(canonical(spark, sf_dir))["route_fare_analytics"]


@query
def ml_training_rows(spark, sf_dir):
    return standardize.training_rows(canonical(spark, sf_dir))


@query
def baseline_training_rows(spark, sf_dir):
    return standardize.baseline_rows(testbed.history_raw(spark, sf_dir))


@query
def fare_by_airline(spark, sf_dir):
    means = summaries.mean_by(canonical(spark, sf_dir), ["airline"], "price", "avg_price")
    return ranking.sort_nulls_last(means, "avg_price", "airline", descending=True)


@query
def fare_by_route_top15(spark, sf_dir):
    route = X.route_key(F.col("source_city"), F.col("destination_city"), " → ")
    routed = canonical(spark, sf_dir).withColumn("route", route)
    means = summaries.mean_by(routed, ["route"], "price", "avg_price")
    return ranking.top_rows(means, 15, "avg_price", "route")


@query
def fare_global_stats(spark, sf_dir):
    return summaries.global_stats(canonical(spark, sf_dir))


@query
def pipeline_counts(spark, sf_dir):
    # Standardising keeps every row, so the canonical rows count for the raw ones too.
    rows = canonical(spark, sf_dir)
    ends = ["source_city", "destination_city"]
    counts = summaries.counts_in_one_scan(
        rows,
        groups={"route_rows": history.ROUTE_KEYS, "flight_rows": history.FLIGHT_KEYS},
        filters={"bronze_rows": F.lit(True), "training_rows": F.col("price") > 0},
        values={"unique_airlines": F.col("airline"), "unique_routes": X.route_key(*map(F.col, ends))},
    )
    return counts.replace("rows", "silver_rows", ["metric"])


@query
def table_check(spark, sf_dir):
    return check_table(canonical(spark, sf_dir), CANONICAL)


# Quality


@query
def null_profile(spark, sf_dir):
    return profile.null_counts(text_columns(spark, sf_dir))


@query
def numeric_profile(spark, sf_dir):
    return profile.numeric_stats(text_columns(spark, sf_dir))


@query
def blank_strings(spark, sf_dir):
    spaced = testbed.measured_texts(spark, sf_dir).select(
        "price_text", F.translate("clock_text", "0123456789:-no", "").alias("clock_rest")
    )
    return profile.blank_counts(spaced)


@query
def distinct_profile(spark, sf_dir):
    return profile.distinct_per_column(profile.value_counts(text_columns(spark, sf_dir)))


@query
def top_values(spark, sf_dir):
    return profile.top_values(profile.value_counts(text_columns(spark, sf_dir)))


@query
def distinct_values(spark, sf_dir):
    return profile.distinct_values(profile.value_counts(text_columns(spark, sf_dir)))


@query
def duplicate_rows(spark, sf_dir):
    return profile.duplicate_rows(text_columns(spark, sf_dir))


@query
def duplicate_labels(spark, sf_dir):
    return profile.duplicate_rows(text_columns(spark, sf_dir).select("airline", "flight", "stops"))


@query
def case_variants(spark, sf_dir):
    return profile.spelling_variants(profile.value_counts(text_columns(spark, sf_dir)))


@query
def whitespace_issues(spark, sf_dir):
    return profile.outer_space_values(profile.value_counts(text_columns(spark, sf_dir)))


@query
def sample_rows(spark, sf_dir):
    keyed = testbed.history_raw(spark, sf_dir).select(*testbed.ROW_ORDER, "airline", "stops")
    return profile.sample_rows(keyed, *testbed.ROW_ORDER)


@query
def quality_summary(spark, sf_dir):
    return profile.quality_summary(text_columns(spark, sf_dir))


@query
def dataset_profile(spark, sf_dir):
    table = text_columns(spark, sf_dir)
    counts = settle(profile.value_counts(table), "values")
    return profile.dataset_profile(table, counts, sample_rows(spark, sf_dir))


# Live, batch form


@query
def live_payload(spark, sf_dir):
    events = spread(testbed.table(spark, sf_dir, "events"), "event_id")
    return decode_payload(testbed.live_log(events))


@query
def payload_encode(spark, sf_dir):
    events = testbed.table(spark, sf_dir, "events")
    value = encode_payload(["event_id", "user_id", "event_type", "value"])
    return events.select("event_id", value.alias("value"))


@query
def live_clean(spark, sf_dir):
    return plain_times(clean(spark, sf_dir))


@query
def live_rejects_by_rule(spark, sf_dir):
    shaped = live.shape_live(testbed.live_payload(spark, sf_dir))
    return validity.failures_by_rule(shaped, validity.live_rules())


@query
def live_flagged_rows(spark, sf_dir):
    shaped = live.shape_live(testbed.live_payload(spark, sf_dir))
    flagged = validity.flag_invalid(shaped, validity.live_rules())
    return flagged.groupBy(F.array_join("failed_rules", ",").alias("failed_rules")).agg(
        F.count(F.lit(1)).alias("rows")
    )


@query
def live_dedup(spark, sf_dir):
    return plain_times(unique_live(spark, sf_dir))


@query
def live_dedup_any(spark, sf_dir):
    # The survivor is arbitrary, so only columns that all copies share are shown.
    return dedup.any_per_key(clean(spark, sf_dir), ["event_id"]).select("event_id", "route", "price")


@query
def route_price_summary(spark, sf_dir):
    return gold.route_prices_sql(unique_live(spark, sf_dir))


@query
def airline_price_summary(spark, sf_dir):
    return summaries.fare_summary(unique_live(spark, sf_dir), gold.CARRIER_KEYS, averages=())


@query
def price_windows_sliding(spark, sf_dir):
    return plain_times(windows.sliding_summary(unique_live(spark, sf_dir)))


@query
def gold_windows_rollup(spark, sf_dir):
    partials = gold.finest_partials(unique_live(spark, sf_dir))
    return plain_times(gold.gold_tables(partials)["price_window_analytics"])


@query
def route_price_current(spark, sf_dir):
    return summaries.current_fares(unique_live(spark, sf_dir))


@query
def route_avg_of_avg(spark, sf_dir):
    routes = gold.route_prices_sql(unique_live(spark, sf_dir))
    return mean_of_means(routes, "route")


@query
def airline_avg_of_avg(spark, sf_dir):
    carriers = airline_price_summary(spark, sf_dir)
    return mean_of_means(carriers, "airline")


def mean_of_means(table: DataFrame, key: str) -> DataFrame:
    """Unweighted mean of the stored averages, which have two decimals."""
    exact = table.withColumn("avg_price", F.col("avg_price").cast("decimal(18,2)"))
    means = summaries.mean_by(exact, [key], "avg_price", "avg_price")
    return means.withColumn("avg_price", F.col("avg_price").cast("double"))


@query
def latest_event_time(spark, sf_dir):
    return plain_times(summaries.latest_time(unique_live(spark, sf_dir)))


@query
def latest_events(spark, sf_dir):
    rows = ranking.latest_rows(unique_live(spark, sf_dir), 50, "event_timestamp", "event_id")
    return plain_times(rows.select("event_timestamp", "event_id", "route", "airline", "price"))


@query
def price_series(spark, sf_dir):
    rows = unique_live(spark, sf_dir)
    return plain_times(ranking.price_series(rows, "event_timestamp", "price", "event_id"))


@query
def live_counts(spark, sf_dir):
    metrics = {"routes": F.col("route"), "airlines": F.col("airline")}
    rows = unique_live(spark, sf_dir)
    return summaries.layer_counts({"rows": rows}).unionByName(
        summaries.distinct_counts(rows, metrics)
    )


@query
def median_by_route(spark, sf_dir):
    return summaries.median_price(unique_live(spark, sf_dir), ["route"])


@query
def distinct_by_month(spark, sf_dir):
    # Sketches of two halves of the rows, stored per month of travel and united, beside exact counts.
    rows = settle(unique_live(spark, sf_dir).select("event_id", "travel_date", "route", "airline"), "unique")
    metrics = {"routes": F.col("route"), "airlines": F.col("airline"), "events": F.col("event_id")}
    month = F.trunc("travel_date", "month").alias("month")
    folder = new_folder(spark, "sketches")
    for half in (0, 1):
        part = rows.filter(F.pmod(F.xxhash64("event_id"), F.lit(2)) == half)
        append_table(summaries.distinct_sketches(part, metrics, [month]), folder)
    sketches = read_table(spark, folder)
    monthly = summaries.merge_sketches(sketches, list(metrics), ["month"])
    total = summaries.merge_sketches(sketches, list(metrics)).withColumn("month", F.lit(None).cast("date"))
    estimated = summaries.sketch_estimates(monthly.unionByName(total), list(metrics), ["month"])
    exact = rows.groupBy(month).agg(*[F.count_distinct(c).alias(m) for m, c in metrics.items()])
    whole = rows.agg(*[F.count_distinct(c).alias(m) for m, c in metrics.items()]).withColumn("month", F.lit(None).cast("date"))
    exact = exact.unionByName(whole).unpivot(["month"], list(metrics), "metric", "distinct_values")
    exact = exact.withColumnsRenamed({"month": "of_month", "metric": "of_metric"})
    both = estimated.join(exact, F.col("month").eqNullSafe(F.col("of_month")) & (F.col("metric") == F.col("of_metric")))
    near = F.abs(F.col("estimate") - F.col("distinct_values")) <= 0.03 * F.col("distinct_values")
    return both.select("month", "metric", "distinct_values", near.alias("within_3_percent"))


# Message log


@query
def log_offsets(spark, sf_dir):
    log = testbed.live_log(testbed.table(spark, sf_dir, "events"))
    # Saved offsets of a consumer halfway, with as many partitions that got no new rows.
    old = F.explode(F.array(F.col("partition"), F.col("partition") + 3)).alias("partition")
    saved = half_offsets(log).select("topic", old, "next_offset")
    return merge_offsets(saved, next_offsets(log))


@query
def log_read_from_offsets(spark, sf_dir):
    log = testbed.live_log(testbed.table(spark, sf_dir, "events"))
    # Shifted by one, so that the first partition has no saved offset and starts at 0.
    saved = half_offsets(log).withColumn("partition", F.col("partition") + 1)
    unread = read_from_offsets(log, settle(saved, "offsets"))
    return unread.select("topic", "partition", "offset")


def half_offsets(log: DataFrame) -> DataFrame:
    """Offsets of a consumer that stopped halfway through each partition."""
    half = F.floor(F.col("next_offset") / 2).alias("next_offset")
    return next_offsets(log).select("topic", "partition", half)


@query
def active_paths(spark, sf_dir):
    return active_snapshot(testbed.order_actions(spark, sf_dir))


@query
def parts_union(spark, sf_dir):
    customers = testbed.table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("key"), F.col("c_name").alias("name"), "c_mktsegment"
    )
    suppliers = testbed.table(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").alias("key"), F.col("s_name").alias("name")
    )
    return union_parts([customers, suppliers])


@query
def parts_scan(spark, sf_dir):
    # The same file twice: a bag union keeps both copies.
    nations = f"{sf_dir}/nation.parquet"
    twice = read_parts(spark, [nations, nations])
    line = testbed.table(spark, sf_dir, "supplier")
    named = line.join(twice, line.s_nationkey == twice.n_nationkey)
    return named.groupBy("n_name").agg(F.count(F.lit(1)).alias("rows"))


@query
def parts_scan_mixed(spark, sf_dir):
    # Two files of one table, of which the second has a column more.
    folder = new_folder(spark, "parts")
    suppliers = testbed.table(spark, sf_dir, "supplier").select("s_suppkey", "s_name", "s_nationkey")
    early = suppliers.filter(F.col("s_suppkey") % 2 == 0).select("s_suppkey", "s_name")
    append_table(early, f"{folder}/early")
    append_table(suppliers.filter(F.col("s_suppkey") % 2 == 1), f"{folder}/late")
    return read_parts(spark, [f"{folder}/early", f"{folder}/late"])


# Itineraries and texts


@query
def itinerary_flatten(spark, sf_dir):
    return itinerary.flatten_options(testbed.options(spark, sf_dir))


@query
def itinerary_from_legs(spark, sf_dir):
    order = ["l_linenumber", "l_partkey", "l_suppkey"]
    return itinerary.flatten_legs(testbed.leg_rows(spark, sf_dir), ["l_orderkey"], order)


@query
def search_response_flatten(spark, sf_dir):
    text = testbed.responses_text(spark, sf_dir)
    decoded = text.withColumn("response", F.from_json("value", SEARCH_RESPONSE))
    return itinerary.flatten_responses(decoded.select("o_orderkey", "response.*"), "o_orderkey")


@query
def duration_text(spark, sf_dir):
    minutes = X.duration_text_minutes(F.col("duration_text")).alias("minutes")
    return testbed.measured_texts(spark, sf_dir).select("event_id", minutes)


@query
def price_text(spark, sf_dir):
    price = X.price_text(F.col("price_text")).alias("price")
    return testbed.measured_texts(spark, sf_dir).select("event_id", price)


@query
def clock_text(spark, sf_dir):
    clock = X.clock_text(F.col("clock_text")).alias("clock")
    return testbed.measured_texts(spark, sf_dir).select("event_id", clock)


@query
def coerced_texts(spark, sf_dir):
    texts = testbed.measured_texts(spark, sf_dir).withColumn("number", F.col("duration_text"))
    coerced = standardize.coerce(texts, number="double")
    moment = X.event_time(F.col("clock_text"), "yyyy-MM-dd HH:mm").alias("moment")
    return plain_times(coerced.select("event_id", "number", moment))


@query
def days_until_travel(spark, sf_dir):
    days = X.days_until(F.to_date("ts"), F.date_add(F.to_date("ts"), F.col("user_id").cast("int") - 20))
    return testbed.table(spark, sf_dir, "events").select("event_id", days.alias("days_left"))


@query
def event_identity(spark, sf_dir):
    keys = ["event_id", "user_id", "event_type", "props"]
    return testbed.table(spark, sf_dir, "events").select(
        "event_id", X.business_id(keys).alias("identity")
    )


@query
def stops_three_ways(spark, sf_dir):
    stops = F.col("stops")
    return testbed.history_raw(spark, sf_dir).groupBy(
        stops.alias("label"),
        standardize.stops_count(stops, HISTORY_STOPS, None).alias("null_rule"),
        standardize.stops_count(stops, LIVE_STOPS, -1).alias("minus_one_rule"),
        standardize.stops_count(stops, HISTORY_STOPS, 2, fold=False).alias("two_rule"),
    ).agg(F.count(F.lit(1)).alias("rows"))


# Lookups and requests


@query
def observed_routes(spark, sf_dir):
    rows = testbed.history_raw(spark, sf_dir)
    return lookup.observed_routes(rows, "source_city", "destination_city")


@query
def city_pairs(spark, sf_dir):
    return lookup.city_pairs(testbed.history_raw(spark, sf_dir), "source_city", "destination_city")


@query
def airport_lookup(spark, sf_dir):
    airports = testbed.airports(spark)
    rows = testbed.history_raw(spark, sf_dir).groupBy("source_city", "destination_city").agg(
        F.count(F.lit(1)).alias("rows"), F.sum("price").alias("total_price")
    )
    start = airports.withColumnRenamed("code", "source_code")
    end = airports.withColumnRenamed("code", "destination_code")
    # One code per city, so the few grouped rows are looked up, not the table.
    coded = lookup.attach(rows, start, {"source_city": "city"}, strict=True)
    coded = lookup.attach(coded, end, {"destination_city": "city"}, strict=True)
    return coded.select("source_code", "destination_code", "rows", "total_price")


@query
def route_requests(spark, sf_dir):
    routes = observed_routes(spark, sf_dir)
    airports = testbed.airports(spark)
    start = airports.withColumnRenamed("code", "source_code")
    end = airports.withColumnRenamed("code", "destination_code")
    coded = lookup.attach(routes, start, {"source_city": "city"}, strict=True)
    coded = lookup.attach(coded, end, {"destination_city": "city"}, strict=True)
    return lookup.search_requests(coded)


@query
def request_outcomes(spark, sf_dir):
    status = F.when(F.col("o_orderstatus") == "F", "failed").otherwise("successful")
    sent = F.when(F.col("o_orderstatus") == "F", 0).otherwise(F.size("option.flights"))
    return summaries.outcome_counts(testbed.options(spark, sf_dir, "o_orderstatus"), status, sent)


# Baseline and comparison


@query
def price_baseline_nearest(spark, sf_dir):
    return baseline_prices(spark, sf_dir).select("event_id", "tier", "baseline_price")


@query
def live_vs_predicted(spark, sf_dir):
    priced = baseline_prices(spark, sf_dir).withColumnRenamed("baseline_price", "predicted_price")
    return compare.comparison_table(compare.compare_prices(priced), "event_id")


@query
def cheapest_quote(spark, sf_dir):
    priced = baseline_prices(spark, sf_dir).withColumnRenamed("baseline_price", "predicted_price")
    compared = compare.compare_prices(priced)
    cheapest = ranking.cheapest_row(compared, "live_price", "event_id")
    return cheapest.select("event_id", "live_price", "predicted_price", "difference", "signal")


# Streams


@query
def stream_ingest(spark, sf_dir):
    folder = new_folder(spark, "ingest")
    streaming.ingest_log(testbed.live_log(testbed.events_stream(spark, sf_dir)), folder)
    return spark.read.parquet(f"{folder}/rows").drop("batch_id")


@query
def stream_clean(spark, sf_dir):
    folder = new_folder(spark, "clean")
    streaming.run_clean(payload_stream(spark, sf_dir), folder)
    return plain_times(spark.read.parquet(f"{folder}/rows"))


@query
def stream_dedup_offers(spark, sf_dir):
    return run_dedup(spark, sf_dir, "offers", None, "bounded").select(*OFFER_KEYS)


@query
def stream_dedup_events(spark, sf_dir):
    rows = run_dedup(spark, sf_dir, "events", ["event_id"], "bounded")
    return rows.select("event_id", "route", "price")


@query
def stream_dedup_global(spark, sf_dir):
    rows = run_dedup(spark, sf_dir, "global", ["event_id"], "global")
    return rows.select("event_id", "route", "price")


@query
def stream_dedup_retained(spark, sf_dir):
    # Keys live for 40 days after their event, on disk; three batches with copies of events among them.
    folder = new_folder(spark, "retained")

    def run(rows):
        unique = streaming.drop_repeats(live.clean_live(rows), ["event_id"], delay="40 days")
        run_to_end(append_stream(unique, f"{folder}/rows", f"{folder}/checkpoint"))

    with streaming.state_on_disk(spark):
        payload_in_turns(spark, sf_dir, run)
    return spark.read.parquet(f"{folder}/rows").select("event_id", "route", "price")


def payload_in_turns(spark: SparkSession, sf_dir: str, run: Callable[[DataFrame], object]) -> None:
    """Three runs of a job over a growing table of the events, in time order."""
    testbed.in_turns(testbed.table(spark, sf_dir, "events"), "ts", lambda rows: run(testbed.live_rows(rows)))


@query
def stream_windows_closed(spark, sf_dir):
    folder = new_folder(spark, "windows")
    payload_in_turns(spark, sf_dir, lambda rows: streaming.run_windows(live.clean_live(rows), folder))
    return plain_times(spark.read.parquet(f"{folder}/rows"))


@query
def stream_open_windows(spark, sf_dir):
    # Three batches, then the last one once more: all windows, open ones too, are there once.
    folder = new_folder(spark, "open-windows")
    unique = unique_live(spark, sf_dir)
    streams = []

    def run(rows):
        streams[:] = [rows]
        streaming.run_open_windows(rows, folder)

    testbed.in_turns(unique, "event_timestamp", run)
    testbed.forget_last_batch(spark, f"{folder}/checkpoint", ends_empty=True)
    run(streams[0])
    return plain_times(streaming.read_windows(spark, folder, windows.sliding_summary(unique).schema))


@query
def stream_quarantine(spark, sf_dir):
    # Rule totals from the rejected rows, and the counters, after three batches and a replayed one.
    folder = new_folder(spark, "quarantine")
    streams = []

    def run(rows):
        streams[:] = [rows]
        streaming.run_quarantine(rows, folder)

    payload_in_turns(spark, sf_dir, run)
    testbed.forget_last_batch(spark, f"{folder}/checkpoint")
    run(streams[0])
    rows = spark.read.parquet(f"{folder}/rows")
    failed = rows.filter("verdict = 'rejected'").select(F.explode("failed_rules").alias("name"))
    kept = rows.select(F.concat("verdict", F.lit(" rows")).alias("name"))
    stored = failed.unionByName(kept).groupBy("name").agg(F.count(F.lit(1)).alias("stored_rows"))
    seen = spark.read.parquet(f"{folder}/counters").withColumn(
        "name", F.when(F.col("counter") == "kept", "kept rows").otherwise(F.col("counter"))
    )
    counted = seen.groupBy("name").agg(F.sum("value").alias("counted_rows"))
    return counted.join(stored, "name", "full").filter("coalesce(counted_rows, 1) > 0")


def streamed_gold(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A summary table after three micro-batches."""
    folder = new_folder(spark, "gold")
    payload_in_turns(spark, sf_dir, lambda rows: streaming.refresh_gold_stream(live.clean_live(rows), folder))
    return gold.read_gold(spark, folder, name)


def withdrawn_gold(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A summary table after three micro-batches and a fourth one that takes every seventh event out."""
    folder = new_folder(spark, "withdrawn")
    rows = settle(unique_live(spark, sf_dir), "unique")
    first, last = rows.agg(F.min("event_timestamp"), F.max("event_timestamp")).first()
    added = rows.withColumns({"withdrawn": F.lit(False), "sent_at": F.col("event_timestamp")})
    every_seventh = rows.filter(F.col("event_id").cast("long") % 7 == 0)
    out = every_seventh.withColumns({"withdrawn": F.lit(True), "sent_at": F.lit(last + (last - first) / 3)})

    def run(stream):
        keys = ["event_id", "withdrawn"]
        streaming.refresh_gold_stream(stream, folder, keys, "global", gold.Withdrawals)

    testbed.in_turns(added.unionByName(out), "sent_at", run, parts=4)
    return gold.read_gold(spark, folder, name)


@query
def stream_gold_withdrawn(spark, sf_dir):
    return withdrawn_gold(spark, sf_dir, "airline_price_analytics")


@query
def stream_windows_withdrawn(spark, sf_dir):
    return plain_times(withdrawn_gold(spark, sf_dir, "price_window_analytics"))


@query
def stream_gold_refresh(spark, sf_dir):
    return streamed_gold(spark, sf_dir, "airline_price_analytics")


@query
def stream_gold_routes(spark, sf_dir):
    return streamed_gold(spark, sf_dir, "route_price_analytics")


@query
def stream_gold_windows(spark, sf_dir):
    return plain_times(streamed_gold(spark, sf_dir, "price_window_analytics"))


@query
def stream_late_rows(spark, sf_dir):
    # A clean stream whose last batch is older than the watermark. A batch is held against the
    # watermark that the batch before it began with, hence the one in between.
    folder = new_folder(spark, "late")
    rows = settle(clean(spark, sf_dir), "clean")
    first, last = rows.agg(F.min("event_timestamp"), F.max("event_timestamp")).first()
    moment = F.col("event_timestamp")
    middle, late = (F.lit(first + (last - first) * share) for share in (0.5, 0.75))
    counts = []

    def run(source):
        unique = streaming.drop_repeats(source, ["event_id"])
        counts.append(streaming.count_late_rows(
            spark, lambda: run_to_end(append_stream(unique, f"{folder}/rows", f"{folder}/checkpoint"))
        ))

    with streaming.only_batches_of_rows(spark):
        testbed.in_parts(rows, [(moment >= middle) & (moment < late), moment >= late, moment < middle], run, "late")
    late = sum(counts)
    kept = spark.read.parquet(f"{folder}/rows")
    return kept.agg(F.count(F.lit(1)).alias("kept_rows")).withColumn("late_rows", F.lit(late).cast("bigint"))


@query
def stream_clean_resumed(spark, sf_dir):
    # Three runs over a table that grows between them; each takes only what is new.
    folder = new_folder(spark, "resumed")
    rows = testbed.live_payload(spark, sf_dir)
    for part in (0, 1):
        append_table(rows.filter(F.pmod(F.xxhash64("event_id"), F.lit(2)) == part), f"{folder}/in")
        streaming.run_clean(stream_table(spark, f"{folder}/in", rows.schema), f"{folder}/out")
    streaming.run_clean(stream_table(spark, f"{folder}/in", rows.schema), f"{folder}/out")
    return plain_times(spark.read.parquet(f"{folder}/out/rows"))


def payload_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    return testbed.live_rows(testbed.events_stream(spark, sf_dir))


def run_dedup(spark: SparkSession, sf_dir: str, label: str, keys, mode: str) -> DataFrame:
    folder = new_folder(spark, f"dedup-{label}")
    rows = live.clean_live(payload_stream(spark, sf_dir))
    unique = streaming.drop_repeats(rows, keys or OFFER_KEYS, mode=mode)
    run_to_end(append_stream(unique, f"{folder}/rows", f"{folder}/checkpoint"))
    return spark.read.parquet(f"{folder}/rows")


# Models


@query
def model_metrics(spark, sf_dir):
    # A rule stands in for a model, so that another engine can compute the same metrics.
    rows = standardize.training_rows(canonical(spark, sf_dir))
    rule = F.when(F.col("cabin_class") == "Business", 80000).otherwise(50000) + F.col("days_left")
    metrics = pricing.regression_metrics(rows.withColumn("prediction", rule.cast("bigint")))
    return metrics.select("rows", *[F.round(c, 6).alias(c) for c in ("rmse", "mae", "r2")])


@query
def label_index(spark, sf_dir):
    return pricing.label_index(standardize.training_rows(canonical(spark, sf_dir)))


@query
def split_counts(spark, sf_dir):
    train, test = pricing.split_rows(standardize.training_rows(canonical(spark, sf_dir)))
    return summaries.layer_counts({"train": train, "test": test})


@query
def linear_one_feature(spark, sf_dir):
    rows = standardize.training_rows(canonical(spark, sf_dir)).dropna(subset=["price", "days_left"])
    vectors = VectorAssembler(inputCols=["days_left"], outputCol="features").transform(rows)
    fitted = pricing.price_regressors()["LinearRegression"].fit(vectors.select("features", "price"))
    line = [(round(float(fitted.coefficients[0]), 4), round(float(fitted.intercept), 4))]
    return spark.createDataFrame(line, "slope double, intercept double")


@query
def tree_split_scores(spark, sf_dir):
    # A forest of one tree with one split, stored and loaded again: what each side is scored with.
    rows = standardize.training_rows(canonical(spark, sf_dir)).dropna(subset=["price", "days_left"])
    vectors = VectorAssembler(inputCols=["days_left"], outputCol="features").transform(rows)
    fitted = pricing.one_split_tree().fit(vectors.select("features", "price"))
    folder = new_folder(spark, "tree")
    pricing.save_model(PipelineModel([fitted]), folder)
    scored = pricing.score(pricing.load_model(folder), vectors, digits=4)
    return scored.groupBy("prediction").agg(
        F.min("days_left").alias("from_days"), F.max("days_left").alias("to_days"), F.count(F.lit(1)).alias("rows")
    )


@cache
def stored_best(application: str, sf_dir: str) -> tuple[str, list[tuple]]:
    """Folder of the best model and the leaderboard, trained once per application and data."""
    spark = SparkSession.active()
    rows = standardize.training_rows(canonical(spark, sf_dir))
    models, board = pricing.fit_models(rows)
    folder = new_folder(spark, "model")
    pricing.save_model(pricing.best_model(models, board)[1], folder)
    return folder, [tuple(r) for r in board.collect()]


@query
def model_leaderboard(spark, sf_dir):
    board = stored_best(spark.sparkContext.applicationId, sf_dir)[1]
    return spark.createDataFrame(board, "rank int, model string, rmse double, mae double, r2 double")


@query
def model_scores(spark, sf_dir):
    model = pricing.load_model(stored_best(spark.sparkContext.applicationId, sf_dir)[0])
    rows = unique_live(spark, sf_dir)
    quotes = rows.select(
        "event_id",
        standardize.carrier_name(F.col("airline")).alias("airline"),
        "source_city",
        "destination_city",
        X.day_part(F.col("departure_time")).alias("departure_time"),
        X.day_part(F.col("arrival_time")).alias("arrival_time"),
        F.col("class").alias("cabin_class"),
        F.col("duration").cast("double").alias("duration_minutes"),
        F.col("stops_count").alias("stops"),
        "days_left",
        F.col("price").alias("live_price"),
    )
    scored = settle(pricing.score(model, quotes), "scored")
    # The baseline is worked out only for quotes that the model has no price for.
    missing = scored.filter(X.nan_to_null(F.col("prediction")).isNull()).select("event_id")
    if missing.isEmpty():
        priced = scored.withColumn("baseline_price", F.lit(None).cast("double"))
    else:
        left = baseline_prices(spark, sf_dir, rows.join(missing, "event_id", "left_semi"))
        priced = scored.join(left.select("event_id", "baseline_price"), "event_id", "left")
    return compare.compare_prices(compare.choose_prediction(priced)).select(
        "event_id", "live_price", "predicted_price", "prediction_mode", "difference", "signal"
    )


# Stored tables


@query
def delimited_round_trip(spark, sf_dir):
    folder = new_folder(spark, "delimited")
    suppliers = testbed.table(spark, sf_dir, "supplier").select("s_suppkey", "s_name", "s_nationkey")
    append_table(suppliers, folder, "csv", header="true")
    return read_delimited(spark, folder, suppliers.schema)


@query
def overwrite_then_append(spark, sf_dir):
    # Written whole, replaced by half of itself, and the other half appended with another name.
    folder = new_folder(spark, "table")
    suppliers = testbed.table(spark, sf_dir, "supplier").select("s_suppkey", "s_name")
    even = F.col("s_suppkey") % 2 == 0
    overwrite_table(suppliers, folder)
    replace_own_input(read_table(spark, folder).filter(even), folder)
    append_table(suppliers.filter(~even).withColumn("s_name", F.upper("s_name")), folder)
    return read_table(spark, folder)


@query
def guarded_writes(spark, sf_dir):
    # One table without rows and one with; only the second is written, the first reads as empty.
    folder = new_folder(spark, "guarded")
    suppliers = testbed.table(spark, sf_dir, "supplier").select("s_suppkey")
    written = {
        "none": write_unless_empty(suppliers.filter("s_suppkey < 0"), f"{folder}/none"),
        "all": write_unless_empty(suppliers, f"{folder}/all"),
    }
    counts = [
        read_or_empty(spark, f"{folder}/{name}", suppliers.schema).agg(F.count(F.lit(1)).alias("rows")).select(
            F.lit(name).alias("table"), F.lit(done).alias("written"), "rows"
        )
        for name, done in written.items()
    ]
    return union_parts(counts)


@query
def log_in_steps(spark, sf_dir):
    # Bounded steps, the second one cut short before its offsets were stored: every offset is read once.
    folder = new_folder(spark, "steps")
    append_table(testbed.events_log(spark, sf_dir), f"{folder}/log")
    log = read_table(spark, f"{folder}/log")
    span = log.agg(F.max("offset") - F.min("offset")).first()[0]
    steps = 0
    while streaming.follow_log(log, f"{folder}/out", span // 3 + 1):
        steps += 1
        if steps == 2:
            remove(spark, f"{folder}/out/offsets/step=1")
    rows = spark.read.parquet(f"{folder}/out/rows")
    return rows.groupBy("topic", "partition", "offset").agg(F.count(F.lit(1)).alias("times"))


@query
def log_tail(spark, sf_dir):
    # The message log stored as a table and tailed as a stream.
    folder = new_folder(spark, "log")
    append_table(testbed.events_log(spark, sf_dir), f"{folder}/log")
    tail = stream_log(spark, "parquet", path=f"{folder}/log").select("topic", "partition", "offset")
    run_to_end(append_stream(tail, f"{folder}/rows", f"{folder}/checkpoint"))
    return read_table(spark, f"{folder}/rows")


@query
def airport_rows(spark, sf_dir):
    # Dimension rows from memory, met by the first present of several column names.
    rows = testbed.history_raw(spark, sf_dir).withColumn("_c0", F.lit(0)).withColumnRenamed("source_city", "City")
    city = standardize.first_present(rows, ["city", "CITY", "City"])
    named = lookup.attach(rows.drop("_c0"), testbed.airports(spark).withColumnRenamed("city", "served"), {city: "served"})
    return named.groupBy("code").agg(F.count(F.lit(1)).alias("rows"))


@query
def column_presence(spark, sf_dir):
    tables = {"raw": testbed.history_raw(spark, sf_dir), "canonical": canonical(spark, sf_dir)}
    presence = profile.compare_columns(tables)
    return presence.groupBy("dataset").agg(F.count_if("present").alias("columns"))
