"""Declared schemas. All fields are nullable."""

from pyspark.sql import types as T

STRING, INT, LONG, DOUBLE = T.StringType(), T.IntegerType(), T.LongType(), T.DoubleType()
DATE, TIMESTAMP, BINARY = T.DateType(), T.TimestampType(), T.BinaryType()


def struct(**fields: T.DataType) -> T.StructType:
    """A StructType from ``name=type`` pairs, in the order given."""
    return T.StructType([T.StructField(name, kind, True) for name, kind in fields.items()])


# The canonical history table, ordered.
CANONICAL = struct(
    airline=STRING,
    flight_code=STRING,
    source_city=STRING,
    destination_city=STRING,
    departure_date=DATE,
    departure_time=STRING,
    arrival_date=DATE,
    arrival_time=STRING,
    duration_minutes=INT,
    stops=INT,
    days_left=INT,
    cabin_class=STRING,
    price=INT,
    source=STRING,
    ingestion_timestamp=TIMESTAMP,
)

# The JSON message payload, ordered.
PAYLOAD = T.StructType(
    [
        T.StructField("event_id", STRING),
        T.StructField("observed_at", STRING),
        T.StructField("source_city", STRING),
        T.StructField("destination_city", STRING),
        T.StructField("travel_date", STRING),
        T.StructField("airline", STRING),
        T.StructField("airline_code", STRING),
        T.StructField("departure_time", STRING),
        T.StructField("arrival_time", STRING),
        T.StructField("stops", STRING),
        T.StructField("duration", INT),
        T.StructField("class", STRING),
        T.StructField("price", DOUBLE),
        T.StructField("currency", STRING),
        T.StructField("days_left", INT),
    ]
)

ENVELOPE = struct(topic=STRING, partition=INT, offset=LONG, value=BINARY)

OFFSETS = struct(topic=STRING, partition=INT, next_offset=LONG)

RAW_HISTORY = T.StructType(
    [
        T.StructField("_c0", INT),
        T.StructField("airline", STRING),
        T.StructField("flight", STRING),
        T.StructField("source_city", STRING),
        T.StructField("departure_time", STRING),
        T.StructField("stops", STRING),
        T.StructField("arrival_time", STRING),
        T.StructField("destination_city", STRING),
        T.StructField("class", STRING),
        T.StructField("duration", DOUBLE),
        T.StructField("days_left", INT),
        T.StructField("price", INT),
    ]
)

LEG = struct(departure=T.ArrayType(INT), arrival=T.ArrayType(INT), duration=INT)
OPTION = struct(airlines=T.ArrayType(STRING), type=STRING, price=DOUBLE, flights=T.ArrayType(LEG))

# Price and duration arrive as number or text, so the search response keeps them as VARIANT.
RESPONSE_LEG = struct(
    airline=STRING,
    duration=T.VariantType(),
    departure_airport=struct(time=STRING),
    arrival_airport=struct(time=STRING),
)
RESPONSE_OPTION = struct(
    price=T.VariantType(),
    extracted_price=T.VariantType(),
    total_price=T.VariantType(),
    total_duration=T.VariantType(),
    flights=T.ArrayType(RESPONSE_LEG),
)
SEARCH_RESPONSE = struct(
    best_flights=T.ArrayType(RESPONSE_OPTION), other_flights=T.ArrayType(RESPONSE_OPTION)
)

QUOTE = struct(
    airline=STRING,
    source_city=STRING,
    destination_city=STRING,
    departure_time=STRING,
    arrival_time=STRING,
    cabin_class=STRING,
    duration_minutes=DOUBLE,
    stops=INT,
    days_left=INT,
)
