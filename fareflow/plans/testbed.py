"""The given tables as fare-shaped inputs. Row-local, so these add no shuffle.

Dirty rows are made from the row's own keys, so a second engine can make the same ones.
"""

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from fareflow.constants import AIRPORT_CODES, CITIES
from fareflow.functions import free_text_key
from fareflow.schemas import STRING, struct
from fareflow.sinks.tables import append_table
from fareflow.sources.tables import read_table, spread
from fareflow.workspace import children, new_folder, remove

RAW_CARRIERS = ("Vistara", "Air_India", "Indigo", "GO_FIRST", "AirAsia", "SpiceJet")
DAY_PARTS = ("Early_Morning", "Morning", "Afternoon", "Evening", "Night", "Late_Night")
ROW_ORDER = ("order_no", "line_no", "part_no", "supplier_no", "price")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return read_table(spark, f"{sf_dir}/{name}.parquet")


def pick(values: tuple[str, ...], index: Column) -> Column:
    return F.get(F.array(*[F.lit(v) for v in values]), index.cast("int"))


def every(number: Column, n: int) -> Column:
    return number % n == 0


def history_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items as raw history rows, with columns that give the table's row order."""
    return shape_history(table(spark, sf_dir, "lineitem"))


def shape_history(line: DataFrame) -> DataFrame:
    order, part, number = F.col("l_orderkey"), F.col("l_partkey"), F.col("l_linenumber")
    carrier = pick(RAW_CARRIERS, F.col("l_suppkey") % 6)
    start, end = part % 6, (part % 6 + 1 + order % 5) % 6
    business = F.when(F.col("l_linestatus") == "O", 30000).otherwise(0)
    fare = F.floor("l_extendedprice").cast("int") + business
    stops = (
        F.when(every(order, 17), " Zero ")
        .when(every(order, 19), "two")
        .when(F.col("l_returnflag") == "A", "zero")
        .when(F.col("l_returnflag") == "N", "one")
        .otherwise("two_or_more")
    )
    return line.select(
        F.when(every(order, 11), F.concat(F.lit("  "), F.upper(carrier), F.lit(" ")))
        .when(every(order, 13), "Akasa_Air")
        .otherwise(carrier)
        .alias("airline"),
        F.concat(F.lit("FL-"), (part % 90 + 10).cast("string")).alias("flight"),
        pick(CITIES, start).alias("source_city"),
        pick(CITIES, end).alias("destination_city"),
        pick(DAY_PARTS, number % 6).alias("departure_time"),
        pick(DAY_PARTS, (number + order) % 6).alias("arrival_time"),
        stops.alias("stops"),
        F.concat(
            F.when(F.col("l_linestatus") == "F", "Economy").otherwise("Business"),
            F.when(every(order, 23), " ").otherwise(""),
        ).alias("class"),
        F.when(~every(order, 29), F.col("l_quantity") + number * 0.17).alias("duration"),
        (part % 49 + 1).cast("int").alias("days_left"),
        F.when(every(order, 31), 0)
        .when(every(order, 37), -5)
        .when(~every(order, 41), fare)
        .alias("price"),
        order.alias("order_no"),
        number.alias("line_no"),
        part.alias("part_no"),
        F.col("l_suppkey").alias("supplier_no"),
    )


def sent_events(events: DataFrame) -> DataFrame:
    """Events as sent: every tenth one again, as if observed five minutes later."""
    copies = F.when(every(F.col("event_id"), 10), F.array(F.lit(0), F.lit(1)))
    return events.withColumn(
        "copy", F.explode(F.coalesce(copies, F.array(F.lit(0))))
    ).withColumn("k", F.get_json_object("props", "$.k").cast("int"))


def payload_fields() -> dict[str, Column]:
    """The payload columns of a sent event."""
    event, user, k = F.col("event_id"), F.col("user_id"), F.col("k")
    kind = F.col("event_type")
    moment = F.col("ts").cast("timestamp") + F.make_dt_interval(mins=F.col("copy") * 5)
    day = F.date_add(F.to_date("ts"), k % 51 - 1)
    express = (kind == "signup") & every(user, 3)
    return {
        "event_id": event.cast("string"),
        "observed_at": F.when(
            every(event, 43), F.date_format(moment, "yyyy-MM-dd'T'HH:mm:ss")
        ).otherwise(F.date_format(moment, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")),
        "source_city": F.when(user % 50 == 8, "Goa").otherwise(pick(CITIES, user % 6)),
        "destination_city": F.when(user % 30 == 7, "Goa").otherwise(
            pick(CITIES, (user % 6 + 1 + F.floor(user / 6) % 5) % 6)
        ),
        "travel_date": F.when(every(event, 107), "2026-13-45").otherwise(
            F.date_format(day, "yyyy-MM-dd")
        ),
        "airline": F.when(every(event, 59), None)
        .when(kind == "click", "IndiGo")
        .when(kind == "view", "Air India ")
        .when(kind == "purchase", " SpiceJet")
        .when(express, "Air India Express")
        .when(kind == "signup", "Akasa Air")
        .otherwise("THAI"),
        "airline_code": F.when(kind == "click", "6E")
        .when(kind == "view", " ai ")
        .when(kind == "purchase", "xx")
        .when(express, "IX")
        .when(kind == "error", "multi"),
        "departure_time": F.date_format("ts", "HH:mm"),
        "arrival_time": F.date_format(F.col("ts") + F.make_dt_interval(mins=k * 25), "HH:mm"),
        "stops": pick(("zero", " ONE ", "two_or_more", "two", "nonstop"), user % 5),
        "duration": k * 25,
        "class": F.when(user % 25 == 8, "First")
        .when(every(user, 2), "Economy")
        .otherwise(" Business"),
        "price": F.when(every(event, 47), 0.0).when(
            ~every(event, 53), F.floor(F.col("value") * 100).cast("double")
        ),
        "currency": F.lit(" inr "),
        "days_left": k % 51 - 1,
    }


def live_log(events: DataFrame) -> DataFrame:
    """Events as a message log of JSON payloads, some of them broken."""
    event = F.col("event_id")
    text = F.to_json(F.struct(*[c.alias(n) for n, c in payload_fields().items()]))
    value = (
        F.when(every(event, 101), "{broken")
        .when(every(event, 103), F.regexp_replace(text, '"price":[0-9.E]+', '"price":"n/a"'))
        .otherwise(text)
    )
    return sent_events(events).select(
        F.lit("fares").alias("topic"),
        (event % 3).cast("int").alias("partition"),
        (event * 2 + F.col("copy")).alias("offset"),
        value.cast("binary").alias("value"),
    )


def live_rows(events: DataFrame) -> DataFrame:
    """The rows that decoding ``live_log`` gives, as the stored table holds them.

    ``inline`` makes the texts once, as in a stored table; filters would make them again.
    """
    event, fields = F.col("event_id"), payload_fields()
    fields["price"] = F.when(~every(event, 103), fields["price"])
    readable = {n: F.when(~every(event, 101), c) for n, c in fields.items()}
    row = F.struct(*[c.alias(n) for n, c in readable.items()])
    return sent_events(events).select(F.inline(F.array(row)))


def events_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events as a message log that all tasks make and write."""
    return live_log(spread(table(spark, sf_dir, "events"), "event_id"))


def live_payload(spark: SparkSession, sf_dir: str) -> DataFrame:
    return live_rows(spread(table(spark, sf_dir, "events"), "event_id"))


def airports(spark: SparkSession) -> DataFrame:
    """The airport dimension, six rows."""
    return spark.createDataFrame(list(AIRPORT_CODES.items()), struct(city=STRING, code=STRING))


def events_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events table tailed as a stream; the pattern fits a file and a folder of files."""
    schema = table(spark, sf_dir, "events").schema
    return spark.readStream.schema(schema).parquet(f"{sf_dir}/event[s].parquet")


def in_turns(
    rows: DataFrame, time: str, run: Callable[[DataFrame], object], parts: int = 3, label: str = "turns"
) -> None:
    """Run a stream job once for each of ``parts`` equal spans of time, in order.

    All tasks write a span; the job, which resumes from its checkpoint, takes it as one micro-batch.
    """
    first, last = rows.agg(F.min(time), F.max(time)).first()
    spans = []
    for n in range(parts):
        low, high = first + (last - first) / parts * n, first + (last - first) / parts * (n + 1)
        chosen = F.col(time) >= F.lit(low) if n else F.lit(True)
        spans.append(chosen & (F.col(time) < F.lit(high)) if n < parts - 1 else chosen)
    in_parts(rows, spans, run, label)


def in_parts(rows: DataFrame, parts: list[Column], run: Callable[[DataFrame], object], label: str = "parts") -> None:
    """Run a stream job once for the rows of each condition, in order, over a table that grows by them.

    A part has a file for each core, so that the micro-batch is read by all of them.
    """
    spark = rows.sparkSession
    folder = new_folder(spark, label)
    cores = spark.sparkContext.defaultParallelism
    for part in parts:
        append_table(rows.filter(part).repartition(cores, *rows.columns), folder)
        run(spark.readStream.schema(rows.schema).parquet(folder))


def forget_last_batch(spark: SparkSession, checkpoint: str, ends_empty: bool = False) -> None:
    """Make the next run replay the last batch, as after a crash before its commit.

    A job with a watermark ends with a batch without rows (``ends_empty``), which is forgotten first.
    """
    last = max(int(n) for n in children(spark, f"{checkpoint}/commits") if n.isdigit())
    gone = [("commits", last)]
    if ends_empty:
        gone += [("offsets", last), ("commits", last - 1)]
    for kind, n in gone:
        remove(spark, f"{checkpoint}/{kind}/{n}")
        remove(spark, f"{checkpoint}/{kind}/.{n}.crc")


def quotes_of(clean: DataFrame) -> DataFrame:
    """Clean live rows as quotes to price, key texts in the form of the baseline rows."""
    texts = {"cabin_class": "class", "airline": "airline"}
    texts |= {c: c for c in ("source_city", "destination_city")}
    return clean.select(
        "event_id",
        *[free_text_key(F.col(c)).alias(name) for name, c in texts.items()],
        "departure_time",
        "arrival_time",
        F.col("duration").cast("double").alias("duration_minutes"),
        F.col("stops_count").alias("stops"),
        "days_left",
        F.col("price").alias("live_price"),
    )


def options(spark: SparkSession, sf_dir: str, *extra: str) -> DataFrame:
    """Orders as itinerary options of none to three legs, with ``extra`` columns of the orders."""
    order, customer = F.col("o_orderkey"), F.col("o_custkey")
    count = (order % 4).cast("int")

    def leg(n: Column) -> Column:
        hour = F.when(~every(order, 10), ((order + n) % 24).cast("int"))
        out = F.array(hour, ((customer + n * 7) % 60).cast("int"))
        landed = ((order + n * 2) % 24).cast("int")
        back = F.when(every(customer, 8), F.array(landed)).otherwise(
            F.array(landed, ((customer + n * 11) % 60).cast("int"))
        )
        return F.struct(
            out.alias("departure"),
            back.alias("arrival"),
            ((customer + n * 13) % 200 + 30).cast("int").alias("duration"),
        )

    legs = F.transform(F.sequence(F.lit(1), F.greatest(count, F.lit(1))), leg)
    carrier = F.array(pick(RAW_CARRIERS, customer % 6))
    option = F.struct(
        F.when(every(customer, 9), F.slice(carrier, 1, 0)).otherwise(carrier).alias("airlines"),
        F.concat(F.lit("C"), (customer % 10).cast("string")).alias("type"),
        F.floor("o_totalprice").cast("double").alias("price"),
        F.slice(legs, F.lit(1), count).alias("flights"),
    )
    return table(spark, sf_dir, "orders").select(
        "o_orderkey",
        pick(CITIES, customer % 6).alias("source_city"),
        pick(CITIES, (customer + 1) % 6).alias("destination_city"),
        F.date_format(F.date_add("o_orderdate", (order % 60).cast("int")), "yyyy-MM-dd").alias(
            "travel_date"
        ),
        F.when(every(order, 2), "Economy").otherwise("Business").alias("class"),
        F.col("o_orderdate").cast("timestamp").alias("observed_at"),
        option.alias("option"),
        *extra,
    )


def responses_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as search responses in JSON, with numbers, texts and gaps mixed."""
    order, customer = F.col("o_orderkey"), F.col("o_custkey")
    fare = F.floor("o_totalprice").cast("bigint")
    kind = order % 5
    price = (
        F.when(kind == 0, F.format_string('"price":%d,', fare))
        .when(kind == 1, F.format_string('"price":"₹%d",', fare))
        .when(kind == 2, F.format_string('"price":-5,"extracted_price":"%d.5",', fare))
        .when(kind == 3, F.format_string('"price":"none","total_price":%d,', fare))
        .otherwise(F.lit(""))
    )
    total = (
        F.when(order % 3 == 0, F.format_string('"total_duration":%d,', customer % 300))
        .when(order % 3 == 1, F.format_string('"total_duration":"%d hr %d min",', kind, customer % 60))
        .otherwise(F.lit(""))
    )
    clock = F.format_string("2026-08-21 %d:%02d", order % 24, customer % 60)
    first = F.format_string(
        '{"airline":"A%d","duration":%d,"departure_airport":{"time":"%s"},'
        '"arrival_airport":{"time":"%s"}}',
        customer % 7, customer % 90, clock, clock,
    )
    second = F.format_string('{"duration":"%d min","arrival_airport":{"time":" noon "}}', customer % 45)
    best = F.concat(F.lit("{"), price, total, F.lit('"flights":['), first, F.lit("]}"))
    other = F.concat(
        F.lit("{"), price, total, F.lit('"flights":['), second, F.lit(","), second, F.lit("]}")
    )
    empty = F.lit('{"price":1,"flights":[]}')
    text = F.concat(
        F.lit('{"best_flights":['), best, F.lit(","), empty, F.lit('],"other_flights":['), other, F.lit("]}")
    )
    orders = spread(table(spark, sf_dir, "orders"), "o_orderkey")
    return orders.select("o_orderkey", text.alias("value"))


def leg_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items as legs stored one per row; the order key is the option."""
    supplier, part, number = F.col("l_suppkey"), F.col("l_partkey"), F.col("l_linenumber")
    return table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
        pick(RAW_CARRIERS, supplier % 6).alias("airline"),
        F.format_string("%02d:%02d", part % 24, supplier % 60).alias("departure"),
        F.format_string("%02d:%02d", (part + number) % 24, (supplier + 7) % 60).alias("arrival"),
        (F.col("l_quantity").cast("int") * 10).alias("duration"),
    )


def measured_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Event numbers written as duration, price and clock texts, some unreadable."""
    event, user = F.col("event_id"), F.col("user_id")
    cents = F.floor(F.col("value") * 100).cast("bigint")

    def text(pattern: str, *parts: Column) -> Column:
        return F.format_string(pattern, *parts)

    form = event % 6
    return table(spark, sf_dir, "events").select(
        "event_id",
        F.when(form == 0, text("%d hr %d min", user, user % 60))
        .when(form == 1, text("%d min", user))
        .when(form == 2, F.lit("h"))
        .when(form == 3, text("%d", user))
        .when(form == 4, text("%d.5H", user))
        .alias("duration_text"),
        F.when(form == 0, text("₹%d", cents))
        .when(form == 1, text("1.2.%d", cents))
        .when(form == 2, text("-%d", cents))
        .when(form == 3, F.lit(""))
        .when(form == 4, text("Rs %d.25/-", cents))
        .alias("price_text"),
        F.when(form == 0, text("2026-08-21 %02d:%02d", user % 24, user % 60))
        .when(form == 1, F.lit(" noon "))
        .when(form == 2, text("%d:%02d to %d:%02d", user % 24, user % 60, user % 12, user % 60))
        .when(form == 3, F.lit(""))
        .alias("clock_text"),
    )


def order_actions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as an add/remove log over customers."""
    return table(spark, sf_dir, "orders").select(
        F.concat(F.lit("part-"), F.col("o_custkey").cast("string")).alias("path"),
        F.when(F.col("o_orderstatus") == "F", "remove").otherwise("add").alias("action"),
        F.col("o_orderkey").alias("version"),
        F.lit(0).alias("seq"),
    )
