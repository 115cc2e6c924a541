"""Column expressions on edge values."""

import datetime as dt

import pytest
from pyspark.sql import functions as F, types as T

from fareflow import functions as X
from fareflow.constants import CARRIER_NAMES, HISTORY_STOPS, LIVE_STOPS
from fareflow.operators.standardize import carrier_name, stops_count


def values(spark, column, inputs, kind="string"):
    rows = spark.createDataFrame([(n, v) for n, v in enumerate(inputs)], f"n int, v {kind}")
    return [r[0] for r in rows.orderBy("n").select(column(F.col("v"))).collect()]


def test_carrier_names_fold_and_keep_the_rest(spark):
    names = [" GO_FIRST ", "unknown air ", "vistara", "Air_India", None]
    assert values(spark, carrier_name, names) == [
        "Go First", "unknown air", "Air India", "Air India", None,
    ]


@pytest.mark.parametrize(
    "labels, unmatched, fold, expected",
    [
        (HISTORY_STOPS, None, True, [0, None, 2, None, 0]),
        (LIVE_STOPS, -1, True, [0, 2, -1, -1, 0]),
        (HISTORY_STOPS, 2, False, [0, 2, 2, 2, 2]),
    ],
)
def test_stops_rules_differ_on_unmatched(spark, labels, unmatched, fold, expected):
    inputs = ["zero", "two", "two_or_more", None, " ZERO "]
    assert values(spark, lambda c: stops_count(c, labels, unmatched, fold), inputs) == expected


def test_recode_takes_a_mapping_of_any_size(spark):
    mapping = {str(n): n for n in range(1000)}
    assert values(spark, lambda c: X.recode(c, mapping, F.lit(-1)), ["0", " 999", "x"]) == [0, 999, -1]
    assert values(spark, lambda c: X.recode(c, {}, c), ["a"]) == ["a"]


def test_rounded_minutes_are_half_up(spark):
    assert values(spark, X.rounded_minutes, [2.17, 0.025, None], "double") == [130, 2, None]


def test_exact_minutes_of_bad_text_are_null(spark):
    assert values(spark, X.exact_minutes, ["1.5", "x", None]) == [90.0, None, None]


def test_duration_text(spark):
    texts = ["2 hr 10 min", "45 min", "h", "90", None, "1.5h", "2H", "45 min 2 h"]
    assert values(spark, X.duration_text_minutes, texts) == [130, 45, 0, 0, 0, 900, 120, 27120]


def test_price_text_loses_its_sign(spark):
    texts = ["₹4,010", "1.2.3", "-5", "", None, "0", "."]
    assert values(spark, X.price_text, texts) == [4010.0, None, 5.0, None, None, None, None]


def test_price_number_keeps_its_sign(spark):
    assert values(spark, X.price_number, [-5.0, 0.0, 7.0, None], "double") == [None, None, 7.0, None]


def test_usable_price_of_a_variant_depends_on_the_value(spark):
    def price(c):
        return X.usable_price(F.try_parse_json(c), T.VariantType())

    assert values(spark, price, ['"-5"', "-5", "12.5", '"₹1,200"', "null", None]) == [
        5.0, None, 12.5, 1200.0, None, None,
    ]


def test_clock_text(spark):
    texts = ["2026-08-21 06:30", "noon", None, " 7:05 to 8:15 ", "\tlate "]
    assert values(spark, X.clock_text, texts) == ["06:30", "noon", "00:00", "8:15", "late"]


def test_clock_label_pads_and_fills(spark):
    parts = [[6, 5], [None, 7], [9], [], None]
    expected = ["06:05", "00:07", "09:00", "00:00", "00:00"]
    assert values(spark, X.clock_label, parts, "array<int>") == expected


def test_day_part_shares_the_history_labels(spark):
    clocks = ["05:00", "08:00", "12:59", "19:00", "23:59", "00:10", "noon"]
    assert values(spark, X.day_part, clocks) == [
        "Early_Morning", "Morning", "Afternoon", "Evening", "Night", "Late_Night", None,
    ]


def test_dates_and_times_that_cannot_be_read_are_null(spark):
    assert values(spark, X.travel_date, ["2026-08-21", "2026-13-45", "x", None]) == [
        dt.date(2026, 8, 21), None, None, None,
    ]
    times = ["2026-08-21T06:30:00.123456", "2026-08-21T06:30:00", "2026-08-21", None]
    assert values(spark, lambda c: F.date_format(X.event_time(c), "HH:mm:ss.SSSSSS"), times) == [
        "06:30:00.123456", "06:30:00.000000", None, None,
    ]


def test_route_key_skips_a_missing_end(spark):
    assert values(spark, lambda c: X.route_key(c, F.lit("b"), upper=True), ["a", None]) == ["A-B", "B"]


def test_free_text_key_replaces_before_it_strips(spark):
    assert values(spark, X.free_text_key, ["_Air_India ", "\tA", None]) == ["air india", "a", None]


def test_white_space_set_is_the_one_python_strips(spark):
    spaces = [chr(c) for c in range(0x3001) if chr(c).isspace()]
    assert set(X.text.WHITE_SPACE) == set(spaces)
    assert values(spark, X.strip_all_space, [f"{s}x{s}" for s in spaces]) == ["x"] * len(spaces)


def test_price_signal_and_percent(spark):
    differences = [1000.0, 1000.5, -1000.0, -1001.0, None]
    assert values(spark, X.price_signal, differences, "double") == [
        "stable", "higher", "stable", "below", None,
    ]
    assert values(spark, lambda c: X.difference_percent(F.lit(10.0), c), [0.0, 8.0], "double") == [
        None, 25.0,
    ]


def test_days_until_clamps(spark):
    day = F.lit("2026-01-10").cast("date")
    moves = [3, -3]
    assert values(spark, lambda c: X.days_until(F.date_add(day, c), day), moves, "int") == [3, 0]
    assert values(spark, lambda c: X.days_until(F.date_add(day, c), day, clamp=False), moves, "int") == [3, -3]


def test_business_id_is_the_same_on_replay(spark):
    rows = spark.createDataFrame([("a", None), ("a", None), (None, "a")], "x string, y string")
    ids = [r[0] for r in rows.select(X.business_id(["x", "y"])).collect()]
    assert ids[0] == ids[1] != ids[2]


def test_carrier_table_is_complete():
    assert len(CARRIER_NAMES) == 6
