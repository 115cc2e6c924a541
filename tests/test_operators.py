"""Operators on small hand-made tables."""

import random
from statistics import median

import numpy as np
import pytest
from pyspark.sql import functions as F, types as T

from fareflow import schemas
from fareflow.operators import (
    compare, dedup, itinerary, lookup, nearest, profile, ranking, standardize, summaries, validity,
    windows,
)
from fareflow.plans import gold, history, live
from fareflow.sources import active_snapshot, decode_payload


def rows_of(df, *order):
    return [tuple(r) for r in (df.orderBy(*order) if order else df).collect()]


# Standardisation and rules


def test_conform_orders_casts_and_fills(spark):
    df = spark.createDataFrame([("7", "x", 1)], "price string, airline string, extra int")
    out = standardize.conform(df, schemas.struct(airline=T.StringType(), price=T.IntegerType(), day=T.DateType()))
    assert rows_of(out) == [("x", 7, None)]
    assert [f.dataType.simpleString() for f in out.schema] == ["string", "int", "date"]


def test_check_schema_names_the_difference(spark):
    df = spark.createDataFrame([], "a int, b string")
    want = schemas.struct(a=T.IntegerType(), b=T.StringType())
    assert standardize.check_schema(df, want) is df
    with pytest.raises(ValueError, match="expected"):
        standardize.check_schema(df.select("b", "a"), want)


def test_canonical_history_edges(spark):
    raw = spark.createDataFrame(
        [
            (0, " GO_FIRST ", " X-1 ", "Delhi", "Morning", "zero", "Night", "Mumbai ", "Economy", 2.17, 3, 0),
            (1, "SpiceJet", "X-2", "Delhi", "Morning", "many", "Night", "Mumbai", "Business", None, 3, 900),
        ],
        schemas.RAW_HISTORY,
    )
    out = standardize.canonical_history(standardize.add_lineage(raw, source_dataset="x"))
    assert standardize.check_schema(out, schemas.CANONICAL)
    first, second = out.orderBy("flight_code").collect()
    assert (first.airline, first.flight_code, first.destination_city) == ("Go First", "X-1", "Mumbai")
    assert (first.duration_minutes, first.stops, first.price, first.departure_date) == (130, 0, None, None)
    assert (second.duration_minutes, second.stops, second.price, second.source) == (None, None, 900, "historical")


def payload(spark, **changes):
    row = {
        "event_id": "1", "observed_at": "2026-01-01T10:00:00.5", "source_city": " Delhi", "destination_city": "Goa ",
        "travel_date": "2026-01-05", "airline": "IndiGo", "airline_code": " 6e ", "departure_time": "10:00",
        "arrival_time": "12:00", "stops": " ONE ", "duration": 120, "class": "Economy ", "price": 10.0,
        "currency": "inr", "days_left": 4,
    }
    row |= {"observed_at": "2026-01-01T10:00:00.500000"} | changes
    return spark.createDataFrame([tuple(row[f.name] for f in schemas.PAYLOAD)], schemas.PAYLOAD)


def test_clean_live_standardises(spark):
    row = live.clean_live(payload(spark)).first()
    assert (row.route, row.airline_code, row.stops, row.stops_count) == ("DELHI-GOA", "6E", "one", 1)
    assert (row["class"], row.currency, str(row.travel_date)) == ("Economy", "INR", "2026-01-05")


@pytest.mark.parametrize(
    "change, kept",
    [
        ({"event_id": None}, False),
        ({"price": 0.0}, False),
        ({"price": None}, False),
        ({"duration": 0}, False),
        ({"days_left": -1}, False),
        ({"days_left": 0}, True),
        ({"travel_date": "2026-13-45"}, False),
        ({"observed_at": "2026-01-01T10:00:00"}, True),
        ({"observed_at": "yesterday"}, False),
        ({"airline_code": None, "airline": "air india "}, True),
        ({"airline_code": None, "airline": "THAI"}, False),
        ({"airline_code": "multi", "airline": "THAI"}, False),
        ({"airline_code": " ix ", "airline": "other"}, True),
    ],
)
def test_live_rules(spark, change, kept):
    frame = payload(spark, **change)
    assert live.clean_live(frame).count() == int(kept)
    flagged = validity.flag_invalid(live.shape_live(frame), validity.live_rules())
    assert (flagged.first()["failed_rules"] == []) == kept
    failed = validity.failures_by_rule(live.shape_live(frame), validity.live_rules())
    assert (failed.filter("failed_rows > 0").count() == 0) == kept


def test_decode_keeps_bad_messages_as_nulls(spark):
    values = ['{"event_id":"1","price":2.5}', "{broken", '{"event_id":"2","price":"n/a"}', None]
    log = spark.createDataFrame([(v,) for v in values], "value string")
    out = decode_payload(log).select("event_id", "price")
    assert sorted(rows_of(out), key=str) == sorted([("1", 2.5), (None, None), ("2", None), (None, None)], key=str)


# Duplicates, lookups, snapshots


def test_first_per_key_is_deterministic(spark):
    df = spark.createDataFrame([("a", 2, "x"), ("a", 1, "z"), ("a", 1, "y"), ("b", 5, None)], "k string, t int, v string")
    assert rows_of(dedup.first_per_key(df, ["k"], ["t"]), "k") == [("a", 1, "y"), ("b", 5, None)]
    assert dedup.any_per_key(df, ["k"]).count() == 2


def test_attach_is_strict_on_request(spark):
    df = spark.createDataFrame([("Delhi",), ("Oslo",)], "source_city string")
    dim = spark.createDataFrame([("Delhi", "DEL")], "city string, code string")
    loose = lookup.attach(df, dim, {"source_city": "city"})
    assert rows_of(loose, "source_city") == [("Delhi", "DEL"), ("Oslo", None)]
    with pytest.raises(Exception, match="no match for Oslo"):
        lookup.attach(df, dim, {"source_city": "city"}, strict=True).collect()


def test_attach_leaves_the_join_to_spark(spark):
    dim = spark.range(10).selectExpr("id AS k", "id AS v")
    joined = lookup.attach(spark.range(3).selectExpr("id AS key"), dim, {"key": "k"})
    assert "ResolvedHint" not in joined._jdf.queryExecution().analyzed().toString()
    assert joined.count() == 3


def test_city_pairs_take_both_ends_from_the_rows(spark):
    df = spark.createDataFrame([("a",), ("b",), ("b",), ("c",), (None,)], "s string")
    pairs = rows_of(lookup.city_pairs(df, "s", "d"), "s", "d")
    assert pairs == [(x, y) for x in "abc" for y in "abc" if x != y]


def test_nan_is_a_missing_number(spark):
    df = spark.createDataFrame([("k", 1.0), ("k", float("nan")), ("k", 3.0), ("k", None)], "k string, price double")
    assert rows_of(profile.numeric_stats(df)) == [("price", 1.0, 3.0, 2.0)]
    assert rows_of(summaries.fare_summary(df, ["k"], averages=["price"])) == [("k", 4, 2.0, 1.0, 3.0, 2.0)]
    merged = summaries.finish_partials(summaries.fare_partials(df, ["k"]), ["k"])
    assert rows_of(merged) == [("k", 4, 2.0, 1.0, 3.0)]
    assert rows_of(summaries.mean_by(df, ["k"], "price", "m")) == [("k", 2.0)]
    assert rows_of(summaries.current_fares(df, "k")) == [("k", 2.0, 1.0, 3.0, 2)]
    assert rows_of(summaries.global_stats(df)) == [(2.0, 1.0, 3.0)]
    assert rows_of(summaries.median_price(df, ["k"])) == [("k", 2.0)]


def test_median_of_even_odd_and_no_prices(spark):
    prices = {"odd": [5.0, 1.0, 5.0], "even": [4.0, 1.0, 2.0, 9.0], "one": [7.0], "none": [None], "same": [2.0] * 6}
    df = spark.createDataFrame([(k, v) for k, values in prices.items() for v in values], "k string, price double")
    got = dict(rows_of(summaries.median_price(df, ["k"])))
    assert got == {"odd": 5.0, "even": 3.0, "one": 7.0, "none": None, "same": 2.0}


def test_counts_in_one_scan(spark):
    df = spark.createDataFrame([("a", 1), ("a", 2), ("b", None), (None, None)], "k string, v int")
    counts = summaries.counts_in_one_scan(df, {"pairs": ["k", "v"], "keys": ["k"]}, {"known": F.col("v") > 1}, {"k": F.col("k")})
    assert dict(rows_of(counts)) == {"rows": 4, "known": 1, "pairs": 4, "keys": 3, "k": 2}
    assert dict(rows_of(summaries.counts_in_one_scan(df.limit(0), {}, {}, {"k": F.col("k")}))) == {"rows": 0, "k": 0}


def test_duplicates_tell_null_positions_apart(spark):
    df = spark.createDataFrame([(None, "a"), ("a", None), ("a", None), ("", "a"), (None, None)], "x string, y string")
    assert rows_of(profile.duplicate_rows(df)) == [(5, 1)]
    assert rows_of(profile.quality_summary(df)) == [(5, 2, 1, 2, 0)]


def test_all_distinct_values_are_listed(spark):
    df = spark.createDataFrame([(f"{n:04d}",) for n in range(300)], "v string")
    counts = profile.value_counts(df)
    assert rows_of(profile.distinct_values(counts)) == [("v", f"{n:04d}") for n in range(300)]
    assert rows_of(profile.distinct_values(counts, 3)) == [("v", f"{n:04d}") for n in range(3)]


def test_active_snapshot_takes_the_last_action(spark):
    log = spark.createDataFrame(
        [(1, 0, "p", "add"), (2, 0, "p", "remove"), (1, 1, "q", "add"), (2, 1, "r", "remove"), (2, 2, "r", "add")],
        "version long, seq int, path string, action string",
    )
    assert rows_of(active_snapshot(log), "path") == [("q", "add", 1, 1), ("r", "add", 2, 2)]


# Summaries


def test_fare_summary_counts_rows_and_skips_null_prices(spark):
    df = spark.createDataFrame([("a", 10, 1), ("a", None, 2), ("b", 3, None)], "k string, price int, stops int")
    out = summaries.fare_summary(df, ["k"], averages=["stops"])
    assert rows_of(out, "k") == [("a", 2, 10.0, 10, 10, 1.5), ("b", 1, 3.0, 3, 3, None)]


def test_merged_partials_equal_the_direct_summary(spark):
    rnd = random.Random(1)
    data = [(rnd.choice("abc"), rnd.choice("xy"), rnd.choice([None, rnd.randint(1, 99)]), rnd.randint(0, 3)) for _ in range(300)]
    df = spark.createDataFrame(data, "k string, j string, price int, stops int")
    halves = [df.filter("stops < 2"), df.filter("stops >= 2")]
    parts = [summaries.fare_partials(h, ["k", "j"], averages=["stops"]) for h in halves]
    merged = summaries.merge_partials(parts[0].unionByName(parts[1]), ["k"])
    out = summaries.finish_partials(merged, ["k"], averages=["stops"])
    direct = summaries.fare_summary(df, ["k"], averages=["stops"])
    assert rows_of(out.select(direct.columns), "k") == rows_of(direct, "k")


def test_windows_on_the_boundary_and_between(spark):
    df = spark.createDataFrame(
        [("2026-01-01 10:00:00", 5.0), ("2026-01-01 10:05:00", 7.0), (None, 1.0)], "t string, price double"
    ).withColumn("event_timestamp", F.col("t").cast("timestamp")).withColumns({"route": F.lit("r"), "class": F.lit("c")})
    out = windows.sliding_summary(df).selectExpr(
        "date_format(window_start, 'HH:mm')", "date_format(window_end, 'HH:mm')", "price_observations", "avg_price"
    )
    assert sorted(rows_of(out)) == [("09:40", "10:10", 2, 6.0), ("09:50", "10:20", 2, 6.0), ("10:00", "10:30", 2, 6.0)]


def test_bucketed_windows_equal_spark_windows(spark):
    rnd = random.Random(2)
    base = spark.createDataFrame([(rnd.randint(0, 20000), float(rnd.randint(1, 99))) for _ in range(200)], "s int, price double")
    df = base.selectExpr("timestamp_seconds(1700000000 + s) AS event_timestamp", "price", "'r' AS route", "'c' AS class")
    span = F.window("event_timestamp", "30 minutes", "10 minutes")
    direct = df.groupBy(span).agg(F.min("price"), F.max("price"), F.round(F.avg("price"), 2), F.count("*"))
    expected = direct.selectExpr("window.start", "window.end", "*").drop("window")
    ours = windows.sliding_summary(df).select("window_start", "window_end", "min_price", "max_price", "avg_price", "price_observations")
    assert rows_of(ours, "window_start") == rows_of(expected, "start")
    uneven = windows.sliding_summary(df, size=25 * 60, slide=10 * 60)
    copies = df.groupBy(F.window("event_timestamp", "25 minutes", "10 minutes")).count()
    assert uneven.count() == copies.count()


def test_top_per_group_and_latest(spark):
    df = spark.createDataFrame([("a", 1), ("a", 3), ("a", 2), ("b", None)], "g string, v int")
    top = ranking.top_per_group(df, 2, ["g"], [F.desc("v")])
    assert rows_of(top, "g", "rank") == [("a", 3, 1), ("a", 2, 2), ("b", None, 1)]
    assert rows_of(ranking.latest_rows(df, 2, "v", "g")) == [("a", 3), ("a", 2)]
    assert rows_of(ranking.cheapest_row(df, "v", "g")) == [("a", 1)]


# Profiles


def test_profile_of_an_empty_and_all_null_table(spark):
    empty = spark.createDataFrame([], "a string, n int")
    assert rows_of(profile.null_counts(empty), "column") == [("a", 0, 0.0), ("n", 0, 0.0)]
    assert rows_of(profile.numeric_stats(empty)) == [("n", None, None, None)]
    assert rows_of(profile.duplicate_rows(empty)) == [(0, 0)]
    nulls = spark.createDataFrame([(None, None), (None, None)], "a string, n int")
    assert rows_of(profile.null_counts(nulls), "column") == [("a", 2, 100.0), ("n", 2, 100.0)]
    assert rows_of(profile.duplicate_rows(nulls)) == [(2, 1)]
    assert rows_of(profile.quality_summary(nulls)) == [(2, 2, 1, 2, 0)]


def test_string_quality(spark):
    texts = ["\t", "  ", "", "IndiGo", "indigo", " INDIGO ", None, "IndiGo"]
    df = spark.createDataFrame([(t,) for t in texts], "v string")
    assert rows_of(profile.blank_counts(df)) == [("v", 1, 2)]
    counts = profile.value_counts(df)
    variants = profile.spelling_variants(counts).filter("spelling_key = 'indigo'")
    assert {r.value for r in variants.collect()} == {"IndiGo", "indigo", " INDIGO "}
    spaced = {(r.value, r.leading, r.trailing) for r in profile.outer_space_values(counts).collect()}
    assert spaced == {("\t", True, True), ("  ", True, True), (" INDIGO ", True, True)}
    top = profile.top_values(counts, 2)
    assert rows_of(top.select("value", "rows"), "rank") == [("IndiGo", 2), (None, 1)]
    assert rows_of(profile.distinct_per_column(counts)) == [("v", 6)]


def test_column_kinds_first_rule_wins(spark):
    df = spark.createDataFrame([], "Price string, duration_h double, t timestamp, d date, n int, s string, b boolean")
    kinds = [r.kind for r in profile.column_kinds(df).collect()]
    assert kinds == ["Target Variable", "Duration Feature", "Timestamp", "Date", "Numeric", "Categorical", "Other"]
    present = profile.compare_columns({"x": df.select("n"), "y": df.select("n", "s")})
    assert rows_of(present, "column", "dataset") == [("n", "x", True), ("n", "y", True), ("s", "x", False), ("s", "y", True)]


# Itineraries


def test_flatten_options_by_number_of_legs(spark):
    def leg(h, minutes):
        return ([h, 5], [h + 1], minutes)

    options = [(["A", "B"], "C1", 9.0, [leg(6, 30)] * n) for n in range(4)] + [([], "C2", 9.0, [([], None, None)])]
    df = spark.createDataFrame([(o,) for o in options], T.StructType([T.StructField("option", schemas.OPTION)]))
    df = df.selectExpr(
        "option", "'Delhi' AS source_city", "'Goa' AS destination_city", "'2026-01-05' AS travel_date",
        "'Economy' AS class", "timestamp'2026-01-01 10:00:00' AS observed_at",
    )
    out = itinerary.flatten_options(df).select("stops", "duration", "airline", "departure_time", "arrival_time", "days_left")
    assert sorted(rows_of(out), key=str) == sorted(
        [
            ("zero", 30, "A", "06:05", "07:00", 4), ("one", 60, "A", "06:05", "07:00", 4),
            ("two_or_more", 90, "A", "06:05", "07:00", 4), ("zero", 0, None, "00:00", "00:00", 4),
        ],
        key=str,
    )


def test_flatten_responses_reads_numbers_and_texts(spark):
    text = """{"best_flights":[
      {"price":"₹4,010","total_duration":"2 hr 10 min","flights":[{"airline":"A","duration":50,
        "departure_airport":{"time":"2026-08-21 06:30"},"arrival_airport":{"time":"noon"}}]},
      {"price":-5,"extracted_price":12.5,"total_duration":130,"flights":[{"duration":"45 min"},{"duration":30}]},
      {"price":"-5","total_duration":"?","flights":[{"duration":"45 min"}]},
      {"price":3,"flights":[]}],
     "other_flights":[{"total_duration":0,"flights":[{"duration":"45 min"},{"duration":30},{}]}]}"""
    df = spark.createDataFrame([(text,), ("{}",)], "v string")
    decoded = df.select(F.from_json("v", schemas.SEARCH_RESPONSE).alias("r")).select("r.*")
    out = itinerary.flatten_responses(decoded).drop("currency")
    assert sorted(rows_of(out), key=str) == sorted(
        [
            ("A", "06:30", "noon", 130, 0, 4010.0), ("Unknown", "00:00", "00:00", 130, 1, 12.5),
            ("Unknown", "00:00", "00:00", 0, 0, 5.0), ("Unknown", "00:00", "00:00", 75, 2, None),
        ],
        key=str,
    )


# Comparison


def test_compare_prices(spark):
    df = spark.createDataFrame(
        [("a", 2000.0, 1000.0), ("b", 1.0, 0.0), ("c", None, 1.0), ("d", 1.0, None)], "q string, live_price double, predicted_price double"
    )
    out = compare.compare_prices(df).select("q", "difference", "difference_percent", "signal")
    assert rows_of(out, "q") == [("a", 1000.0, 100.0, "stable"), ("b", 1.0, None, "stable")]


def test_choose_prediction_says_which(spark):
    df = spark.createDataFrame([(1, 5.0, 6.0), (2, None, 6.0), (3, None, None)], "q int, prediction double, baseline_price double")
    assert rows_of(compare.choose_prediction(df), "q") == [(1, 5.0, "model"), (2, 6.0, "baseline"), (3, None, None)]


def test_a_prediction_that_is_no_number_gives_way_to_the_baseline(spark):
    nan = float("nan")
    df = spark.createDataFrame([(1, nan, 100.0, 90.0), (2, nan, nan, 90.0)], "q int, prediction double, baseline_price double, live_price double")
    chosen = compare.choose_prediction(df)
    assert rows_of(chosen.select("q", "predicted_price", "prediction_mode"), "q") == [(1, 100.0, "baseline"), (2, None, None)]
    assert rows_of(compare.compare_prices(chosen).select("q", "difference")) == [(1, -10.0)]


# Price baseline


def brute_force(quotes, past, k):
    def tier_rows(q):
        tests = [
            lambda h: h[:5] == q[1:6], lambda h: h[:3] == q[1:4] and h[4] == q[5], lambda h: h[:3] == q[1:4],
            lambda h: h[:2] == q[1:3], lambda h: h[2] == q[3], lambda h: True,
        ]
        for n, test in enumerate(tests, start=1):
            rows = [h for h in past if test(h)]
            if rows:
                return n, rows
        return None, []

    out = {}
    for q in quotes:
        tier, rows = tier_rows(q)
        near = sorted(rows, key=lambda h: (abs(h[5] - q[6]) + abs(h[6] - q[7]) / 60, h[7]))[:k]
        out[q[0]] = (tier, float(median(h[8] for h in near)) if near else None)
    return out


@pytest.mark.parametrize("k, seed, spread", [(3, 1, 50), (20, 2, 50), (200, 3, 3), (7, 4, 2000)])
def test_nearest_median_equals_brute_force(spark, k, seed, spread):
    rnd = random.Random(seed)
    cities, classes, carriers = ["a", "b", "c"], ["e", "f"], ["x", "y"]
    past = []
    for n in range(900):
        # A third of all rows sits at one point of one key.
        hot = n % 3 == 0
        past.append((
            "a" if hot else rnd.choice(cities), "b" if hot else rnd.choice(cities), "e" if hot else rnd.choice(classes),
            "x" if hot else rnd.choice(carriers), 0 if hot else rnd.randint(0, 2),
            7.0 if hot else float(rnd.randint(1, spread)), 130.0 if hot else rnd.randint(3, spread * 30) * 1.5,
            n, float(rnd.randint(1, 10**6)),
        ))
    quotes = [
        (n, rnd.choice(cities + ["z"]), rnd.choice(cities + ["z"]), rnd.choice(classes + ["q"]), rnd.choice(carriers + ["w"]),
         rnd.choice([0, 1, 2, -1]), rnd.choice([7, rnd.randint(0, 60), 400]), rnd.choice([130.0, float(rnd.randint(0, 2000)), 90000.0]))
        for n in range(120)
    ]
    quotes.append((120, None, "b", "e", "x", 0, 7, 130.0))
    keys = "source_city string, destination_city string, cabin_class string, airline string, stops int, days_left"
    history_df = spark.createDataFrame(rnd.sample(past, len(past)), f"{keys} double, duration_minutes double, n int, price double")
    quotes_df = spark.createDataFrame(quotes, f"q int, {keys} int, duration_minutes double")
    out = nearest.nearest_median(quotes_df, history_df, ["n"], k=k)
    actual = {r.q: (r.tier, r.baseline_price) for r in out.collect()}
    assert actual == brute_force(quotes, past, k)
    assert {t for t, _ in actual.values()} == {1, 2, 3, 4, 5, 6}


def test_a_far_row_does_not_make_quotes_meet_all_rows(spark, monkeypatch):
    rnd = random.Random(6)
    past = [("a", "b", "e", "x", 0, float(rnd.randint(1, 49)), float(rnd.randint(60, 3000)), n, float(n)) for n in range(20_000)]
    quotes = [(n, "a", "b", "e", "x", 0, rnd.randint(1, 49), float(rnd.randint(60, 3000))) for n in range(200)]
    keys = "source_city string, destination_city string, cabin_class string, airline string, stops int, days_left"
    quotes_df = spark.createDataFrame(quotes, f"q int, {keys} int, duration_minutes double")
    pairs, plain = [], nearest.medians

    def counted(members, groups, rows, *rest):
        pairs.append(members.join(nearest.rows_to_search(groups, rows), "group_no").count())
        return plain(members, groups, rows, *rest)

    monkeypatch.setattr(nearest, "medians", counted)
    for far in ([], [("a", "b", "e", "x", 0, 1e6, 100.0, 20_000, 1.0)]):
        rows = spark.createDataFrame(past + far, f"{keys} double, duration_minutes double, n int, price double")
        out = {r.q: (r.tier, r.baseline_price) for r in nearest.nearest_median(quotes_df, rows, ["n"]).collect()}
        some = quotes[:15]
        assert {q[0]: out[q[0]] for q in some} == brute_force(some, past + far, 200)
    assert pairs[0] < 200 * 20_000 / 10
    assert pairs[1] < 1.1 * pairs[0]


def test_summed_areas_count_any_square():
    rnd = np.random.default_rng(1)
    u, v = rnd.normal(size=(2, 3000)) * [[50], [400]]
    u[:3] = 1e6
    quotes = {"u": rnd.normal(size=40) * 60, "v": rnd.normal(size=40) * 500}
    for axis, at in (("u", u), ("v", v)):
        low, high = np.quantile(at, [0.02, 0.98])
        quotes |= {f"{axis}_{c}": np.full(40, x) for c, x in (
            ("low", low - (high - low) / 4), ("width", (high - low) * 1.5 / nearest.GRID), ("min", at.min()), ("max", at.max())
        )}
    cells = [np.clip((at - quotes[f"{x}_low"][0]) // quotes[f"{x}_width"][0], 0, nearest.GRID - 1).astype(int) for x, at in (("u", u), ("v", v))]
    table = nearest.summed_areas(*cells, np.ones(3000, dtype=np.int64))
    assert table[-1, -1] == 3000
    for k in (1, 50, 3000, 9999):
        reach = nearest.reach_of(quotes, table, k)
        for i in range(40):
            away = np.sort(np.maximum(abs(u - quotes["u"][i]), abs(v - quotes["v"][i])))
            assert reach[i] >= away[min(k, 3000) - 1] - 1e-6
            if k == 50:  # no more than two cells beyond
                assert reach[i] <= away[49] + 2 * max(quotes["u_width"][0], quotes["v_width"][0])


@pytest.mark.parametrize("rows, quotes", [(50, 4096), (10**6, 2)])
def test_groups_that_are_split_or_joined(spark, monkeypatch, rows, quotes):
    monkeypatch.setattr(nearest, "GROUP_ROWS", rows)
    monkeypatch.setattr(nearest, "GROUP_QUOTES", quotes)
    monkeypatch.setattr(nearest, "TABLE_QUOTES", 5)
    rnd = random.Random(8)
    past = [("a", "b", "e", "x", 0, float(rnd.randint(1, 20)), float(rnd.randint(60, 300)), n, float(rnd.randint(1, 99))) for n in range(600)]
    asked = [(n, "a", "b", "e", "x", 0, rnd.randint(1, 20), float(rnd.randint(60, 300))) for n in range(30)]
    keys = "source_city string, destination_city string, cabin_class string, airline string, stops int, days_left"
    quotes_df = spark.createDataFrame(asked, f"q int, {keys} int, duration_minutes double")
    rows_df = spark.createDataFrame(past, f"{keys} double, duration_minutes double, n int, price double")
    out = nearest.nearest_median(quotes_df, rows_df, ["n"], k=25).collect()
    assert {r.q: (r.tier, r.baseline_price) for r in out} == brute_force(asked, past, 25)


def test_nearest_median_without_history_or_point(spark):
    keys = "source_city string, destination_city string, cabin_class string, airline string, stops int, days_left"
    past = spark.createDataFrame([], f"{keys} double, duration_minutes double, n int, price double")
    quotes = spark.createDataFrame([("a", "b", "e", "x", 0, None, 5.0)], f"{keys} int, duration_minutes double")
    assert nearest.nearest_median(quotes, past, ["n"]).first()["baseline_price"] is None


# Plans


def test_gold_from_partials_equals_direct(spark):
    rows = [payload(spark, event_id=str(n), price=float(n + 1), airline=a) for n, a in enumerate(["IndiGo", "Air India", "IndiGo"])]
    clean = live.clean_live(rows[0].unionByName(rows[1]).unionByName(rows[2]))
    tables = gold.gold_tables(gold.finest_partials(clean))
    direct = gold.route_prices_sql(clean)
    assert rows_of(tables["route_price_analytics"].select(direct.columns)) == rows_of(direct)
    assert tables["airline_price_analytics"].count() == 2
    assert tables["price_window_analytics"].count() == 3


def test_history_rollup_equals_direct(spark):
    df = spark.createDataFrame(
        [("A", "x", "y", "e", 60, 1, 5, 100), ("B", "x", "y", "e", 61, 2, None, 101), ("B", "x", "y", "f", None, 2, 3, None)],
        "airline string, source_city string, destination_city string, cabin_class string, duration_minutes int, days_left int, stops int, price int",
    )
    rolled = history.history_summaries(df)["route_fare_analytics"]
    direct = summaries.fare_summary(df, history.ROUTE_KEYS)
    assert rows_of(rolled.select(direct.columns), "cabin_class") == rows_of(direct, "cabin_class")
