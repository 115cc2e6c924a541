"""One SQL text per query, written independently of the Spark code from the same rules."""

ORACLE_SQL: dict[str, str] = {}


def cents(value: str) -> str:
    """Half-up rounding to two places."""
    return f"CAST(round(CAST({value} AS DECIMAL(24,6)), 2) AS DOUBLE)"


def with_(*parts: str, select: str) -> str:
    return "WITH " + ",\n".join(parts) + "\n" + select


CITY = "['Delhi','Mumbai','Bangalore','Chennai','Hyderabad','Kolkata']"
CARRIER = "['Vistara','Air_India','Indigo','GO_FIRST','AirAsia','SpiceJet']"
PART = "['Early_Morning','Morning','Afternoon','Evening','Night','Late_Night']"

RAW = f"""raw AS (
  SELECT CASE WHEN l_orderkey % 11 = 0 THEN '  ' || upper({CARRIER}[l_suppkey % 6 + 1]) || ' '
              WHEN l_orderkey % 13 = 0 THEN 'Akasa_Air'
              ELSE {CARRIER}[l_suppkey % 6 + 1] END AS airline,
         'FL-' || CAST(l_partkey % 90 + 10 AS VARCHAR) AS flight,
         {CITY}[l_partkey % 6 + 1] AS source_city,
         {CITY}[(l_partkey % 6 + 1 + l_orderkey % 5) % 6 + 1] AS destination_city,
         {PART}[l_linenumber % 6 + 1] AS departure_time,
         {PART}[(l_linenumber + l_orderkey) % 6 + 1] AS arrival_time,
         CASE WHEN l_orderkey % 17 = 0 THEN ' Zero ' WHEN l_orderkey % 19 = 0 THEN 'two'
              WHEN l_returnflag = 'A' THEN 'zero' WHEN l_returnflag = 'N' THEN 'one'
              ELSE 'two_or_more' END AS stops,
         CASE WHEN l_linestatus = 'F' THEN 'Economy' ELSE 'Business' END
           || CASE WHEN l_orderkey % 23 = 0 THEN ' ' ELSE '' END AS class,
         CASE WHEN l_orderkey % 29 <> 0
              THEN l_quantity + l_linenumber * CAST(0.17 AS DOUBLE) END AS duration,
         CAST(l_partkey % 49 + 1 AS INTEGER) AS days_left,
         CASE WHEN l_orderkey % 31 = 0 THEN 0 WHEN l_orderkey % 37 = 0 THEN -5
              WHEN l_orderkey % 41 <> 0
              THEN CAST(floor(l_extendedprice) AS INTEGER)
                   + CASE WHEN l_linestatus = 'O' THEN 30000 ELSE 0 END END AS price,
         l_orderkey, l_linenumber, l_partkey, l_suppkey
  FROM lineitem)"""

SILVER = """silver AS (
  SELECT CASE lower(trim(airline)) WHEN 'vistara' THEN 'Air India' WHEN 'air_india' THEN 'Air India'
              WHEN 'indigo' THEN 'IndiGo' WHEN 'go_first' THEN 'Go First'
              WHEN 'airasia' THEN 'Air India Express' WHEN 'spicejet' THEN 'SpiceJet'
              ELSE trim(airline) END AS airline,
         trim(flight) AS flight_code, trim(source_city) AS source_city,
         trim(destination_city) AS destination_city, CAST(NULL AS DATE) AS departure_date,
         trim(departure_time) AS departure_time, CAST(NULL AS DATE) AS arrival_date,
         trim(arrival_time) AS arrival_time,
         CAST(round(duration * 60) AS INTEGER) AS duration_minutes,
         CAST(CASE lower(trim(stops)) WHEN 'zero' THEN 0 WHEN 'one' THEN 1
              WHEN 'two_or_more' THEN 2 END AS INTEGER) AS stops,
         days_left, trim(class) AS cabin_class,
         CASE WHEN price > 0 THEN price END AS price, 'historical' AS source
  FROM raw)"""

SENT = """sent AS (
  SELECT e.*, c.copy, e.ts + to_minutes(c.copy * 5) AS moment,
         CAST(json_extract_string(e.props, '$.k') AS INTEGER) AS k
  FROM events e JOIN (VALUES (0), (1)) c(copy) ON c.copy = 0 OR e.event_id % 10 = 0)"""

FIELDS = {
    "event_id": "CAST(event_id AS VARCHAR)",
    "observed_at": "CASE WHEN event_id % 43 = 0 THEN strftime(moment, '%Y-%m-%dT%H:%M:%S') "
    "ELSE strftime(moment, '%Y-%m-%dT%H:%M:%S.%f') END",
    "source_city": f"CASE WHEN user_id % 50 = 8 THEN 'Goa' ELSE {CITY}[user_id % 6 + 1] END",
    "destination_city": "CASE WHEN user_id % 30 = 7 THEN 'Goa' "
    f"ELSE {CITY}[(user_id % 6 + 1 + (user_id // 6) % 5) % 6 + 1] END",
    "travel_date": "CASE WHEN event_id % 107 = 0 THEN '2026-13-45' "
    "ELSE strftime(CAST(ts AS DATE) + CAST(k % 51 - 1 AS INTEGER), '%Y-%m-%d') END",
    "airline": "CASE WHEN event_id % 59 = 0 THEN NULL WHEN event_type = 'click' THEN 'IndiGo' "
    "WHEN event_type = 'view' THEN 'Air India ' WHEN event_type = 'purchase' THEN ' SpiceJet' "
    "WHEN event_type = 'signup' AND user_id % 3 = 0 THEN 'Air India Express' "
    "WHEN event_type = 'signup' THEN 'Akasa Air' ELSE 'THAI' END",
    "airline_code": "CASE WHEN event_type = 'click' THEN '6E' WHEN event_type = 'view' THEN ' ai ' "
    "WHEN event_type = 'purchase' THEN 'xx' "
    "WHEN event_type = 'signup' AND user_id % 3 = 0 THEN 'IX' "
    "WHEN event_type = 'error' THEN 'multi' END",
    "departure_time": "strftime(ts, '%H:%M')",
    "arrival_time": "strftime(ts + to_minutes(k * 25), '%H:%M')",
    "stops": "['zero', ' ONE ', 'two_or_more', 'two', 'nonstop'][user_id % 5 + 1]",
    "duration": "CAST(k * 25 AS INTEGER)",
    "class": "CASE WHEN user_id % 25 = 8 THEN 'First' WHEN user_id % 2 = 0 THEN 'Economy' "
    "ELSE ' Business' END",
    "price": "CASE WHEN event_id % 103 = 0 THEN NULL WHEN event_id % 47 = 0 THEN CAST(0 AS DOUBLE) "
    "WHEN event_id % 53 <> 0 THEN floor(value * 100) END",
    "currency": "' inr '",
    "days_left": "CAST(k % 51 - 1 AS INTEGER)",
}

PAYLOAD = (
    "payload AS (SELECT "
    + ",\n  ".join(
        f"CASE WHEN event_id % 101 <> 0 THEN {sql} END AS {name}" for name, sql in FIELDS.items()
    )
    + "\n FROM sent)"
)

SHAPED = """shaped AS (
  SELECT event_id, observed_at, trim(source_city) AS source_city,
         trim(destination_city) AS destination_city, try_cast(travel_date AS DATE) AS travel_date,
         trim(airline) AS airline, upper(trim(airline_code)) AS airline_code, departure_time,
         arrival_time, lower(trim(stops)) AS stops, duration, trim(class) AS class, price,
         upper(trim(currency)) AS currency, days_left,
         try_cast(observed_at AS TIMESTAMP) AS event_timestamp,
         concat_ws('-', upper(trim(source_city)), upper(trim(destination_city))) AS route,
         CAST(CASE lower(trim(stops)) WHEN 'nonstop' THEN 0 WHEN 'zero' THEN 0 WHEN 'one' THEN 1
              WHEN 'two' THEN 2 ELSE -1 END AS INTEGER) AS stops_count
  FROM payload)"""

RULES = {
    "event_id_present": "event_id IS NOT NULL",
    "observed_at_present": "observed_at IS NOT NULL",
    "source_city_present": "source_city IS NOT NULL",
    "destination_city_present": "destination_city IS NOT NULL",
    "airline_present": "airline IS NOT NULL",
    "price_present": "price IS NOT NULL",
    "price_positive": "price > 0",
    "duration_positive": "duration > 0",
    "days_left_not_negative": "days_left >= 0",
    "carrier_in_scope": "airline_code IN ('AI','IX','6E','SG','QP') OR upper(airline) IN "
    "('AIR INDIA','AIR INDIA EXPRESS','INDIGO','SPICEJET','AKASA AIR')",
    "travel_date_valid": "travel_date IS NOT NULL",
    "event_time_valid": "event_timestamp IS NOT NULL",
}

CLEAN = "clean AS (SELECT * FROM shaped WHERE " + " AND ".join(f"({r})" for r in RULES.values()) + ")"

UNIQ = """uniq AS (
  SELECT * FROM clean
  QUALIFY row_number() OVER (PARTITION BY event_id ORDER BY event_timestamp, observed_at) = 1)"""

LIVE = (SENT, PAYLOAD, SHAPED, CLEAN)


def history(name: str, select: str, *more: str) -> None:
    ORACLE_SQL[name] = with_(RAW, SILVER, *more, select=select)


def from_live(name: str, select: str, *more: str) -> None:
    ORACLE_SQL[name] = with_(*LIVE, UNIQ, *more, select=select)


# History

FARE = f"""count(*) AS flight_count, {cents('avg(price)')} AS avg_price, min(price) AS min_price,
  max(price) AS max_price, {cents('avg(duration_minutes)')} AS avg_duration_minutes,
  {cents('avg(days_left)')} AS avg_days_left, {cents('avg(stops)')} AS avg_stops"""

history("canonical_history", "SELECT * FROM silver")
history(
    "flight_fare_summary",
    f"SELECT airline, source_city, destination_city, cabin_class, {FARE} FROM silver GROUP BY ALL",
)
for key in ("route_fare_summary", "route_fare_rollup"):
    history(
        key, f"SELECT source_city, destination_city, cabin_class, {FARE} FROM silver GROUP BY ALL"
    )
history(
    "ml_training_rows",
    """SELECT airline, flight_code, source_city, destination_city, departure_time, arrival_time,
       duration_minutes, stops, days_left, cabin_class, price FROM silver WHERE price > 0""",
)

PAST = """past AS (
  SELECT lower(trim(replace(airline, '_', ' '))) AS airline,
         lower(trim(replace(source_city, '_', ' '))) AS source_city,
         lower(trim(replace(destination_city, '_', ' '))) AS destination_city,
         lower(trim(replace(class, '_', ' '))) AS cabin_class,
         CAST(CASE stops WHEN 'zero' THEN 0 WHEN 'one' THEN 1 ELSE 2 END AS INTEGER) AS stops,
         duration * 60 AS duration_minutes, CAST(days_left AS DOUBLE) AS days_left,
         CAST(price AS DOUBLE) AS price, l_orderkey, l_linenumber, l_partkey, l_suppkey
  FROM raw WHERE duration IS NOT NULL AND price IS NOT NULL)"""
ORACLE_SQL["baseline_training_rows"] = with_(
    RAW,
    PAST,
    select="SELECT * EXCLUDE (l_orderkey, l_linenumber, l_partkey, l_suppkey) FROM past",
)
history("fare_by_airline", "SELECT airline, avg(price) AS avg_price FROM silver GROUP BY ALL")
history(
    "fare_by_route_top15",
    """SELECT source_city || ' → ' || destination_city AS route, avg(price) AS avg_price
       FROM silver GROUP BY ALL ORDER BY avg_price DESC, route LIMIT 15""",
)
history(
    "fare_global_stats",
    "SELECT avg(price) AS avg_price, min(price) AS min_price, max(price) AS max_price FROM silver",
)
history(
    "pipeline_counts",
    """SELECT 'bronze_rows' AS metric, (SELECT count(*) FROM raw) AS value
       UNION ALL SELECT 'silver_rows', (SELECT count(*) FROM silver)
       UNION ALL SELECT 'route_rows', (SELECT count(*) FROM
         (SELECT DISTINCT source_city, destination_city, cabin_class FROM silver))
       UNION ALL SELECT 'flight_rows', (SELECT count(*) FROM
         (SELECT DISTINCT airline, source_city, destination_city, cabin_class FROM silver))
       UNION ALL SELECT 'training_rows', (SELECT count(*) FROM silver WHERE price > 0)
       UNION ALL SELECT 'unique_airlines', (SELECT count(DISTINCT airline) FROM silver)
       UNION ALL SELECT 'unique_routes',
         (SELECT count(DISTINCT source_city || '-' || destination_city) FROM silver)""",
)
history(
    "table_check",
    "SELECT count(*) AS rows, CAST(15 AS INTEGER) AS columns, true AS matches_expected FROM silver",
)

# Quality

TEXTS = ("airline", "flight", "source_city", "stops", "class")
TYPES = {**dict.fromkeys(TEXTS, "string"), "duration": "double", "days_left": "int", "price": "int"}


def each(columns, row: str, table: str = "raw") -> str:
    """UNION ALL of one SELECT per column; ``{c}`` is the column."""
    return " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", {row.format(c=c)} FROM {table}" for c in columns
    )


COUNTS = (
    "vals AS (" + each(TEXTS, "{c} AS value") + "),\n"
    'counts AS (SELECT "column", value, count(*) AS rows FROM vals GROUP BY ALL)'
)
NULLS = (
    "count(*) FILTER ({c} IS NULL) AS null_count, "
    + cents("count(*) FILTER ({c} IS NULL) / count(*) * 100")
    + " AS null_percent"
)
STATS = (
    "CAST(min({c}) AS DOUBLE) AS min_value, CAST(max({c}) AS DOUBLE) AS max_value, "
    + cents("avg({c})")
    + " AS avg_value"
)
BLANKS = (
    "count(*) FILTER ({c} = '') AS empty_strings, "
    "count(*) FILTER (trim({c}) = '') AS blank_strings"
)
TOP = """SELECT "column", value, rows, CAST(row_number() OVER (PARTITION BY "column"
  ORDER BY rows DESC, value NULLS FIRST) AS INTEGER) AS rank FROM counts QUALIFY rank <= 5"""

ORACLE_SQL["null_profile"] = with_(RAW, select=each((*TEXTS, "duration", "days_left", "price"), NULLS))
ORACLE_SQL["numeric_profile"] = with_(RAW, select=each(("duration", "days_left", "price"), STATS))
ORACLE_SQL["distinct_profile"] = with_(
    RAW, COUNTS, select='SELECT "column", count(value) AS distinct_values FROM counts GROUP BY ALL'
)
ORACLE_SQL["top_values"] = with_(RAW, COUNTS, select=TOP)
ORACLE_SQL["distinct_values"] = with_(
    RAW, COUNTS, select='SELECT "column", value FROM counts WHERE value IS NOT NULL'
)
WHOLE = "airline, flight, source_city, stops, class, duration, days_left, price"
for key, columns in (("duplicate_rows", WHOLE), ("duplicate_labels", "airline, flight, stops")):
    ORACLE_SQL[key] = with_(
        RAW,
        select=f"""SELECT CAST(sum(n) AS BIGINT) AS rows, CAST(sum(n - 1) AS BIGINT) AS duplicate_rows
          FROM (SELECT count(*) AS n FROM raw GROUP BY {columns})""",
    )
VARIANTS = """SELECT "column", lower(trim(value)) AS spelling_key, value, rows FROM counts
  WHERE value IS NOT NULL QUALIFY count(*) OVER (PARTITION BY "column", lower(trim(value))) > 1"""
SPACES = """SELECT "column", value, value <> ltrim(value) AS leading,
  value <> rtrim(value) AS trailing FROM counts WHERE value <> trim(value)"""
ORACLE_SQL["case_variants"] = with_(RAW, COUNTS, select=VARIANTS)
ORACLE_SQL["whitespace_issues"] = with_(RAW, COUNTS, select=SPACES)
QUALITY = f"""SELECT (SELECT count(*) FROM raw) AS rows, CAST(8 AS INTEGER) AS columns,
      (SELECT count(*) FROM raw) - (SELECT count(*) FROM (SELECT DISTINCT {WHOLE} FROM raw))
        AS duplicate_rows,
      (SELECT count(*) FROM ({each((*TEXTS, "duration", "days_left", "price"), NULLS)})
        WHERE null_count > 0) AS columns_with_missing_values,
      (SELECT count(*) FROM (SELECT "column" FROM counts GROUP BY ALL
        HAVING count(value) > 100)) AS high_cardinality_columns"""
ORACLE_SQL["quality_summary"] = with_(RAW, COUNTS, select=QUALITY)


def as_metrics(source: str, *names: str) -> str:
    return " UNION ALL ".join(
        f"SELECT \"column\", '{n}' AS metric, CAST({n} AS VARCHAR) AS value FROM ({source})"
        for n in names
    )


KINDS = " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", '{t}' AS type, "
    + (
        "'Target Variable'" if c == "price"
        else "'Duration Feature'" if c == "duration"
        else "'Categorical'" if t == "string" else "'Numeric'"
    )
    + " AS kind"
    for c, t in TYPES.items()
)
SAMPLE_COLUMNS = ("order_no", "line_no", "part_no", "supplier_no", "price", "airline", "stops")
SAMPLE = """SELECT l_orderkey AS order_no, l_linenumber AS line_no, l_partkey AS part_no,
      l_suppkey AS supplier_no, price, airline, stops FROM raw
      ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey, price NULLS FIRST LIMIT 5"""
ORACLE_SQL["sample_rows"] = with_(RAW, select=SAMPLE)
ORACLE_SQL["dataset_profile"] = with_(
    RAW,
    COUNTS,
    select=" UNION ALL ".join(
        [
            as_metrics(each(TYPES, NULLS), "null_count", "null_percent"),
            as_metrics(each(("duration", "days_left", "price"), STATS), "min_value", "max_value", "avg_value"),
            as_metrics(each(TEXTS, BLANKS), "empty_strings", "blank_strings"),
            as_metrics(
                'SELECT "column", count(value) AS distinct_values FROM counts GROUP BY ALL',
                "distinct_values",
            ),
            "SELECT \"column\", 'top_value_' || CAST(rank AS VARCHAR), "
            "coalesce(value, 'NULL') || ' x' || CAST(rows AS VARCHAR) FROM (" + TOP + ")",
            as_metrics(KINDS, "type", "kind"),
            as_metrics(
                "SELECT '*' AS \"column\", * FROM (" + QUALITY + ")",
                "rows",
                "columns",
                "duplicate_rows",
                "columns_with_missing_values",
                "high_cardinality_columns",
            ),
            "SELECT \"column\", 'distinct_value', value FROM counts WHERE value IS NOT NULL",
            "SELECT \"column\", 'spelling_variant', spelling_key || ': ' || value || ' x' || CAST(rows AS VARCHAR) "
            "FROM (" + VARIANTS + ")",
            "SELECT \"column\", 'outer_space', concat_ws('+', CASE WHEN \"leading\" THEN 'leading' END, "
            "CASE WHEN \"trailing\" THEN 'trailing' END) || ': ' || value FROM (" + SPACES + ")",
            "SELECT '*', 'sample_row', concat_ws('|', "
            + ", ".join(f"coalesce(CAST({c} AS VARCHAR), 'NULL')" for c in SAMPLE_COLUMNS)
            + ") FROM (" + SAMPLE + ")",
        ]
    ),
)

# Live

ORACLE_SQL["live_payload"] = with_(SENT, PAYLOAD, select="SELECT * FROM payload")
ORACLE_SQL["stream_ingest"] = ORACLE_SQL["live_payload"]
ORACLE_SQL["payload_encode"] = """SELECT event_id, CAST(json_object('event_id', event_id,
  'user_id', user_id, 'event_type', event_type, 'value', value) AS VARCHAR) AS value FROM events"""
ORACLE_SQL["live_clean"] = with_(*LIVE, select="SELECT * FROM clean")
ORACLE_SQL["stream_clean"] = ORACLE_SQL["live_clean"]
ORACLE_SQL["live_rejects_by_rule"] = with_(
    SENT,
    PAYLOAD,
    SHAPED,
    select=" UNION ALL ".join(
        f"SELECT '{n}' AS rule, count(*) FILTER (NOT coalesce({r}, false)) AS failed_rows FROM shaped"
        for n, r in RULES.items()
    ),
)
ORACLE_SQL["live_flagged_rows"] = with_(
    SENT,
    PAYLOAD,
    SHAPED,
    select="SELECT concat_ws(',', "
    + ", ".join(f"CASE WHEN NOT coalesce({r}, false) THEN '{n}' END" for n, r in RULES.items())
    + ") AS failed_rules, count(*) AS rows FROM shaped GROUP BY ALL",
)
from_live("live_dedup", "SELECT * FROM uniq")
for key in ("live_dedup_any", "stream_dedup_events", "stream_dedup_global", "stream_dedup_retained"):
    from_live(key, "SELECT event_id, route, price FROM uniq")
ORACLE_SQL["stream_dedup_offers"] = with_(
    *LIVE,
    select="""SELECT DISTINCT source_city, destination_city, travel_date, airline, departure_time,
      arrival_time, class, price FROM clean""",
)

PRICES = f"min(price) AS min_price, max(price) AS max_price, {cents('avg(price)')} AS avg_price"
ROUTES = f"""SELECT route, travel_date, class, {PRICES}, count(*) AS flight_count
  FROM uniq GROUP BY ALL"""
CARRIERS = f"""SELECT route, travel_date, airline, airline_code, class, {PRICES},
  count(*) AS flight_count FROM uniq GROUP BY ALL"""


def sliding(source: str) -> str:
    return f"""SELECT window_start, window_start + INTERVAL 30 MINUTE AS window_end, route, class,
      {PRICES}, count(*) AS price_observations
      FROM (SELECT time_bucket(INTERVAL '10 minutes', event_timestamp) - to_minutes(s.m)
              AS window_start, * FROM {source}, (VALUES (0), (10), (20)) s(m))
      GROUP BY window_start, route, class"""


from_live("route_price_summary", ROUTES)
from_live("airline_price_summary", CARRIERS)
from_live("price_windows_sliding", sliding("uniq"))
from_live("gold_windows_rollup", sliding("uniq"))
from_live(
    "route_price_current",
    f"""SELECT route, {cents('avg(price)')} AS avg_price, {cents('min(price)')} AS min_price,
        {cents('max(price)')} AS max_price, count(price) AS observations FROM uniq GROUP BY ALL""",
)


def mean_of(key: str, table: str) -> str:
    mean = "CAST(sum(CAST(avg_price AS DECIMAL(18,2))) AS DOUBLE) / count(*)"
    return f"""SELECT {key}, CAST(CAST({mean} AS DECIMAL(22,6)) AS DOUBLE) AS avg_price
      FROM ({table}) GROUP BY ALL"""


from_live("route_avg_of_avg", mean_of("route", ROUTES))
from_live("airline_avg_of_avg", mean_of("airline", CARRIERS))
from_live(
    "latest_event_time",
    """SELECT max(event_timestamp) AS latest, strftime(max(event_timestamp), '%H:%M:%S') AS clock
       FROM uniq""",
)
from_live(
    "latest_events",
    """SELECT event_timestamp, event_id, route, airline, price FROM uniq
       ORDER BY event_timestamp DESC, event_id LIMIT 50""",
)
from_live("price_series", "SELECT event_timestamp, price, event_id FROM uniq")
from_live(
    "live_counts",
    """SELECT 'rows' AS metric, count(*) AS value FROM uniq
       UNION ALL SELECT 'routes', count(DISTINCT route) FROM uniq
       UNION ALL SELECT 'airlines', count(DISTINCT airline) FROM uniq""",
)
from_live("median_by_route", "SELECT route, median(price) AS median_price FROM uniq GROUP BY ALL")
ORACLE_SQL["stream_windows_closed"] = with_(
    *LIVE,
    UNIQ,
    select=f"""SELECT * FROM ({sliding('uniq')})
      WHERE window_end <= (SELECT max(event_timestamp) FROM clean) - INTERVAL 1 HOUR""",
)
from_live("stream_gold_refresh", CARRIERS)
from_live("stream_gold_routes", ROUTES)
from_live("stream_gold_windows", sliding("uniq"))
from_live("stream_open_windows", sliding("uniq"))
REMAINING = "(SELECT * FROM uniq WHERE CAST(event_id AS BIGINT) % 7 <> 0)"
from_live("stream_gold_withdrawn", CARRIERS.replace("FROM uniq", f"FROM {REMAINING}"))
from_live("stream_windows_withdrawn", sliding(REMAINING))
ALL_RULES = " AND ".join(f"coalesce({r}, false)" for r in RULES.values())
ORACLE_SQL["stream_quarantine"] = with_(
    SENT,
    PAYLOAD,
    SHAPED,
    select=f"""SELECT 'rows' AS name, count(*) AS counted_rows, CAST(NULL AS BIGINT) AS stored_rows FROM shaped
      UNION ALL SELECT 'kept rows', count(*) FILTER ({ALL_RULES}), count(*) FILTER ({ALL_RULES}) FROM shaped
      UNION ALL SELECT 'rejected rows', NULL, count(*) FILTER (NOT ({ALL_RULES})) FROM shaped
      UNION ALL SELECT * FROM ("""
    + " UNION ALL ".join(
        f"SELECT '{n}' AS name, count(*) AS n, count(*) AS m FROM shaped WHERE NOT coalesce({r}, false)"
        for n, r in RULES.items()
    )
    + ") WHERE n > 0",
)
MONTH = "CAST(date_trunc('month', travel_date) AS DATE)"
from_live(
    "distinct_by_month",
    " UNION ALL ".join(
        f"SELECT {month} AS month, '{metric}' AS metric, count(DISTINCT {column}) AS distinct_values, "
        f"true AS within_3_percent FROM uniq GROUP BY 1"
        for month in (MONTH, "CAST(NULL AS DATE)")
        for metric, column in (("routes", "route"), ("airlines", "airline"), ("events", "event_id"))
    ),
)
ORACLE_SQL["stream_clean_resumed"] = ORACLE_SQL["live_clean"]
ORACLE_SQL["stream_late_rows"] = with_(
    *LIVE,
    """ends AS (SELECT min(event_timestamp) AS first, max(event_timestamp) AS last FROM clean),
mark AS (SELECT max(event_timestamp) - INTERVAL 1 HOUR AS mark FROM clean, ends
  WHERE event_timestamp < first + (last - first) * 3 / 4),
late AS (SELECT event_id, event_timestamp < first + (last - first) / 2
    AND event_timestamp <= mark AS is_late FROM clean, ends, mark)""",
    select="""SELECT count(DISTINCT event_id) FILTER (NOT is_late) AS kept_rows,
      count(*) FILTER (is_late) AS late_rows FROM late""",
)

# Message log

LOG = """log AS (SELECT 'fares' AS topic, CAST(event_id % 3 AS INTEGER) AS partition,
  event_id * 2 + copy AS "offset" FROM sent),
half AS (SELECT topic, partition, (max("offset") + 1) // 2 AS next_offset FROM log GROUP BY ALL)"""
ORACLE_SQL["log_offsets"] = with_(
    SENT,
    LOG,
    select="""SELECT topic, partition, max("offset") + 1 AS next_offset FROM log GROUP BY ALL
      UNION ALL SELECT topic, CAST(partition + 3 AS INTEGER), next_offset FROM half""",
)
ORACLE_SQL["log_read_from_offsets"] = with_(
    SENT,
    LOG,
    select="""SELECT log.topic, log.partition, "offset" FROM log
      LEFT JOIN half ON half.topic = log.topic AND half.partition + 1 = log.partition
      WHERE "offset" >= coalesce(next_offset, 0)""",
)
ORACLE_SQL["active_paths"] = """SELECT 'part-' || CAST(o_custkey AS VARCHAR) AS path,
    'add' AS action, max(o_orderkey) AS version, CAST(0 AS INTEGER) AS seq
  FROM orders GROUP BY o_custkey HAVING arg_max(o_orderstatus, o_orderkey) <> 'F'"""
ORACLE_SQL["parts_union"] = """SELECT c_custkey AS key, c_name AS name, c_mktsegment FROM customer
  UNION ALL SELECT s_suppkey, s_name, NULL FROM supplier"""
ORACLE_SQL["parts_scan"] = """SELECT n_name, 2 * count(*) AS rows FROM supplier
  JOIN nation ON s_nationkey = n_nationkey GROUP BY ALL"""

ORACLE_SQL["parts_scan_mixed"] = """SELECT s_suppkey, s_name,
    CASE WHEN s_suppkey % 2 = 1 THEN s_nationkey END AS s_nationkey FROM supplier"""

# Itineraries and texts

ORACLE_SQL["itinerary_flatten"] = f"""
WITH o AS (SELECT *, o_orderkey AS ok, o_custkey AS c, o_orderkey % 4 AS n FROM orders),
f AS (SELECT strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S.%f') AS observed_at,
  {CITY}[c % 6 + 1] AS source_city, {CITY}[(c + 1) % 6 + 1] AS destination_city,
  strftime(CAST(o_orderdate AS DATE) + CAST(ok % 60 AS INTEGER), '%Y-%m-%d') AS travel_date,
  CASE WHEN c % 9 <> 0 THEN {CARRIER}[c % 6 + 1] END AS airline,
  'C' || CAST(c % 10 AS VARCHAR) AS airline_code,
  printf('%02d:%02d', CASE WHEN ok % 10 = 0 THEN 0 ELSE (ok + 1) % 24 END, (c + 7) % 60)
    AS departure_time,
  printf('%02d:%02d', (ok + 2 * n) % 24, CASE WHEN c % 8 = 0 THEN 0 ELSE (c + 11 * n) % 60 END)
    AS arrival_time,
  CASE n WHEN 1 THEN 'zero' WHEN 2 THEN 'one' ELSE 'two_or_more' END AS stops,
  CAST((c + 13) % 200 + 30 + CASE WHEN n > 1 THEN (c + 26) % 200 + 30 ELSE 0 END
    + CASE WHEN n > 2 THEN (c + 39) % 200 + 30 ELSE 0 END AS INTEGER) AS duration,
  CASE WHEN ok % 2 = 0 THEN 'Economy' ELSE 'Business' END AS class,
  floor(o_totalprice) AS price, 'INR' AS currency, CAST(ok % 60 AS INTEGER) AS days_left
  FROM o WHERE n > 0)
SELECT sha256(concat_ws('|', observed_at, source_city, destination_city, travel_date,
  coalesce(airline, '\\N'), airline_code, departure_time, arrival_time, stops, duration, class,
  price, currency, days_left)) AS event_id, * FROM f"""

ORACLE_SQL["itinerary_from_legs"] = f"""
WITH legs AS (SELECT l_orderkey, l_linenumber AS n, l_partkey AS p, l_suppkey AS s,
    {CARRIER}[l_suppkey % 6 + 1] AS airline, CAST(l_quantity AS INTEGER) * 10 AS minutes,
    row_number() OVER w AS up, row_number() OVER (PARTITION BY l_orderkey
      ORDER BY l_linenumber DESC, l_partkey DESC, l_suppkey DESC) AS down
  FROM lineitem
  WINDOW w AS (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey))
SELECT l_orderkey, max(airline) FILTER (up = 1) AS airline,
  max(printf('%02d:%02d', p % 24, s % 60)) FILTER (up = 1) AS departure_time,
  max(printf('%02d:%02d', (p + n) % 24, (s + 7) % 60)) FILTER (down = 1) AS arrival_time,
  CASE count(*) WHEN 1 THEN 'zero' WHEN 2 THEN 'one' ELSE 'two_or_more' END AS stops,
  CAST(sum(minutes) AS BIGINT) AS duration
FROM legs GROUP BY l_orderkey"""

ORACLE_SQL["search_response_flatten"] = """
WITH o AS (SELECT o_orderkey, o_custkey AS c, floor(o_totalprice) AS fare,
    o_orderkey % 5 AS kind, o_orderkey % 3 AS form FROM orders),
p AS (SELECT *, CASE kind WHEN 0 THEN fare WHEN 1 THEN fare WHEN 2 THEN fare + 0.5
    WHEN 3 THEN fare END AS live_price,
  CASE form WHEN 0 THEN nullif(c % 300, 0) WHEN 1 THEN kind * 60 + c % 60 END AS total FROM o)
SELECT o_orderkey, 'A' || CAST(c % 7 AS VARCHAR) AS airline,
  printf('%d:%02d', o_orderkey % 24, c % 60) AS departure_time,
  printf('%d:%02d', o_orderkey % 24, c % 60) AS arrival_time,
  CAST(coalesce(total, c % 90) AS BIGINT) AS duration_minutes, CAST(0 AS INTEGER) AS stops,
  CAST(live_price AS DOUBLE) AS live_price, 'INR' AS currency FROM p
UNION ALL
SELECT o_orderkey, 'Unknown', '00:00', 'noon', CAST(coalesce(total, 2 * (c % 45)) AS BIGINT), 1,
  CAST(live_price AS DOUBLE), 'INR' FROM p"""

ORACLE_SQL["duration_text"] = """SELECT event_id, CAST(CASE event_id % 6
  WHEN 0 THEN user_id * 60 + user_id % 60 WHEN 1 THEN user_id
  WHEN 4 THEN (user_id * 10 + 5) * 60 ELSE 0 END AS BIGINT) AS minutes FROM events"""
ORACLE_SQL["price_text"] = """SELECT event_id, CAST(nullif(CASE event_id % 6
  WHEN 0 THEN floor(value * 100) WHEN 2 THEN floor(value * 100)
  WHEN 4 THEN floor(value * 100) + 0.25 END, 0) AS DOUBLE) AS price FROM events"""
ORACLE_SQL["clock_text"] = """SELECT event_id, CASE event_id % 6
  WHEN 0 THEN printf('%02d:%02d', user_id % 24, user_id % 60) WHEN 1 THEN 'noon'
  WHEN 2 THEN printf('%d:%02d', user_id % 12, user_id % 60) WHEN 3 THEN '' ELSE '00:00' END AS clock
  FROM events"""
ORACLE_SQL["coerced_texts"] = """SELECT event_id,
  CASE WHEN event_id % 6 = 3 THEN CAST(user_id AS DOUBLE) END AS number,
  CASE WHEN event_id % 6 = 0 THEN TIMESTAMP '2026-08-21' + to_minutes(CAST(
    user_id % 24 * 60 + user_id % 60 AS BIGINT)) END AS moment FROM events"""
ORACLE_SQL["days_until_travel"] = (
    "SELECT event_id, CAST(greatest(20 - user_id, 0) AS INTEGER) AS days_left FROM events"
)
ORACLE_SQL["event_identity"] = (
    "SELECT event_id, sha256(concat_ws('|', event_id, user_id, event_type, props)) AS identity FROM events"
)
ORACLE_SQL["blank_strings"] = """
WITH t AS (SELECT CASE event_id % 6 WHEN 0 THEN 'x' WHEN 1 THEN 'x' WHEN 2 THEN 'x' WHEN 3 THEN ''
    WHEN 4 THEN 'x' END AS price_text,
  CASE event_id % 6 WHEN 0 THEN ' ' WHEN 1 THEN '  ' WHEN 2 THEN ' t ' WHEN 3 THEN '' END AS clock_rest
  FROM events)
""" + each(("price_text", "clock_rest"), BLANKS, "t")
ORACLE_SQL["stops_three_ways"] = with_(
    RAW,
    select="""SELECT stops AS label,
      CAST(CASE lower(trim(stops)) WHEN 'zero' THEN 0 WHEN 'one' THEN 1 WHEN 'two_or_more' THEN 2 END
        AS INTEGER) AS null_rule,
      CAST(CASE lower(trim(stops)) WHEN 'zero' THEN 0 WHEN 'one' THEN 1 WHEN 'two' THEN 2 ELSE -1 END
        AS INTEGER) AS minus_one_rule,
      CAST(CASE stops WHEN 'zero' THEN 0 WHEN 'one' THEN 1 ELSE 2 END AS INTEGER) AS two_rule,
      count(*) AS rows FROM raw GROUP BY ALL""",
)

# Lookups and requests

AIRPORT = """airport AS (SELECT * FROM (VALUES ('Delhi','DEL'), ('Mumbai','BOM'), ('Bangalore','BLR'),
  ('Chennai','MAA'), ('Hyderabad','HYD'), ('Kolkata','CCU')) a(city, code))"""
PAIRS = "SELECT DISTINCT source_city, destination_city FROM raw WHERE source_city <> destination_city"
ORACLE_SQL["observed_routes"] = with_(RAW, select=PAIRS)
ORACLE_SQL["city_pairs"] = with_(
    RAW,
    AIRPORT,
    select="""SELECT DISTINCT r.source_city, c.source_city AS destination_city
      FROM raw r JOIN (SELECT DISTINCT source_city FROM raw) c ON c.source_city <> r.source_city""",
)
ORACLE_SQL["airport_lookup"] = with_(
    RAW,
    AIRPORT,
    select="""SELECT s.code AS source_code, d.code AS destination_code, count(*) AS rows,
      CAST(sum(price) AS BIGINT) AS total_price FROM raw JOIN airport s ON s.city = source_city
      JOIN airport d ON d.city = destination_city GROUP BY ALL""",
)
ORACLE_SQL["route_requests"] = with_(
    RAW,
    AIRPORT,
    select=f"""SELECT source_city, destination_city, s.code AS source_code,
      d.code AS destination_code, class, seat FROM ({PAIRS}) r
      JOIN airport s ON s.city = source_city JOIN airport d ON d.city = destination_city,
      (VALUES ('Economy', 'economy'), ('Business', 'business')) v(class, seat)""",
)
ORACLE_SQL["request_outcomes"] = """
SELECT CASE WHEN o_orderstatus = 'F' THEN 'failed' ELSE 'successful' END AS status,
  count(*) AS requests,
  CAST(sum(CASE WHEN o_orderstatus = 'F' THEN 0 ELSE o_orderkey % 4 END) AS BIGINT) AS events_sent
FROM orders GROUP BY ALL"""

# Baseline: every quote meets every row of its tier

QUOTES = """quotes AS (
  SELECT event_id, lower(trim(replace(class, '_', ' '))) AS cabin_class,
    lower(trim(replace(airline, '_', ' '))) AS airline,
    lower(trim(replace(source_city, '_', ' '))) AS source_city,
    lower(trim(replace(destination_city, '_', ' '))) AS destination_city,
    departure_time, arrival_time, CAST(duration AS DOUBLE) AS duration_minutes,
    stops_count AS stops, days_left, price AS live_price FROM uniq),
points AS (SELECT DISTINCT source_city, destination_city, cabin_class, airline, stops, days_left,
    duration_minutes FROM quotes)"""
TIERS = (
    ("source_city", "destination_city", "cabin_class", "airline", "stops"),
    ("source_city", "destination_city", "cabin_class", "stops"),
    ("source_city", "destination_city", "cabin_class"),
    ("source_city", "destination_city"),
    ("cabin_class",),
    (),
)


def same(keys: tuple[str, ...]) -> str:
    return " AND ".join(f"h.{k} = p.{k}" for k in keys) or "true"


TIERED = (
    "tiered AS (SELECT p.*, CASE "
    + " ".join(
        f"WHEN EXISTS (SELECT 1 FROM past h WHERE {same(keys)}) THEN {n}"
        for n, keys in enumerate(TIERS, start=1)
    )
    + " END AS tier FROM points p)"
)
NEAREST = (
    "near AS ("
    + " UNION ALL ".join(
        f"""SELECT p.*, h.price, row_number() OVER (PARTITION BY p.source_city, p.destination_city,
          p.cabin_class, p.airline, p.stops, p.days_left, p.duration_minutes
          ORDER BY abs(h.days_left - p.days_left)
            + abs(h.duration_minutes - p.duration_minutes) / 60,
            h.l_orderkey, h.l_linenumber, h.l_partkey, h.l_suppkey, h.price) AS place
        FROM tiered p JOIN past h ON {same(keys)} WHERE p.tier = {n} QUALIFY place <= 200"""
        for n, keys in enumerate(TIERS, start=1)
    )
    + "),\nanswers AS (SELECT source_city, destination_city, cabin_class, airline, stops, days_left,"
    " duration_minutes, CAST(min(tier) AS INTEGER) AS tier, median(price) AS baseline_price"
    " FROM near GROUP BY ALL),\npriced AS (SELECT * FROM quotes LEFT JOIN answers USING (source_city,"
    " destination_city, cabin_class, airline, stops, days_left, duration_minutes))"
)
BASELINE = (RAW, PAST, *LIVE, UNIQ, QUOTES, TIERED, NEAREST)
DIFFERENCE = "live_price - baseline_price"
SIGNAL = f"""CASE WHEN {DIFFERENCE} > 1000 THEN 'higher' WHEN {DIFFERENCE} < -1000 THEN 'below'
  ELSE 'stable' END AS signal"""
ORACLE_SQL["price_baseline_nearest"] = with_(
    *BASELINE, select="SELECT event_id, tier, baseline_price FROM priced"
)
ORACLE_SQL["live_vs_predicted"] = with_(
    *BASELINE,
    select=f"""SELECT event_id, airline, departure_time, arrival_time, duration_minutes, stops,
      {cents('live_price')} AS live_price, {cents('baseline_price')} AS predicted_price,
      {cents(DIFFERENCE)} AS difference,
      {cents(f'({DIFFERENCE}) / nullif(baseline_price, 0) * 100')} AS difference_percent, {SIGNAL}
      FROM priced WHERE live_price IS NOT NULL AND baseline_price IS NOT NULL""",
)
ORACLE_SQL["cheapest_quote"] = with_(
    *BASELINE,
    select=f"""SELECT event_id, live_price, baseline_price AS predicted_price,
      {DIFFERENCE} AS difference, {SIGNAL} FROM priced WHERE baseline_price IS NOT NULL
      ORDER BY live_price, event_id LIMIT 1""",
)

# Models

history(
    "model_metrics",
    """SELECT count(*) AS rows, round(sqrt(CAST(sum(e * e) AS DOUBLE) / count(*)), 6) AS rmse,
       round(CAST(sum(abs(e)) AS DOUBLE) / count(*), 6) AS mae,
       round(1 - CAST(sum(e * e) AS DOUBLE) / (var_pop(price) * count(*)), 6) AS r2
       FROM (SELECT price, CASE WHEN cabin_class = 'Business' THEN 80000 ELSE 50000 END + days_left
         - price AS e FROM silver WHERE price > 0)""".replace(
        "sum(e * e)", "sum(CAST(e AS HUGEINT) * e)"
    ),
)

CATEGORICAL = ("airline", "source_city", "destination_city", "departure_time", "arrival_time", "cabin_class")
KNOWN = " AND ".join(f"{c} IS NOT NULL" for c in CATEGORICAL)
history(
    "label_index",
    " UNION ALL ".join(
        f"""SELECT '{c}' AS feature, {c} AS label,
          CAST(row_number() OVER (ORDER BY count(*) DESC, {c}) - 1 AS INTEGER) AS number
          FROM silver WHERE price > 0 AND {KNOWN} GROUP BY {c}"""
        for c in CATEGORICAL
    ),
)
TRAINING = (
    "airline", "flight_code", "source_city", "destination_city", "departure_time", "arrival_time",
    "duration_minutes", "stops", "days_left", "cabin_class", "price",
)
PLACE = (
    "CAST('0x' || substr(sha256(concat_ws('|', "
    + ", ".join(f"coalesce(CAST({c} AS VARCHAR), '\\N')" for c in TRAINING)
    + ")), 1, 8) AS BIGINT) % 100"
)
history(
    "split_counts",
    f"""SELECT 'train' AS metric, count(*) FILTER ({PLACE} < 80) AS value FROM silver WHERE price > 0
        UNION ALL SELECT 'test', count(*) FILTER ({PLACE} >= 80) FROM silver WHERE price > 0""",
)
history(
    "linear_one_feature",
    """SELECT round(regr_slope(price, days_left), 4) AS slope,
       round(regr_intercept(price, days_left), 4) AS intercept FROM silver WHERE price > 0""",
)

# The split of the one days threshold that leaves least variance, and the mean price on either side.
ORACLE_SQL["tree_split_scores"] = with_(
    RAW,
    SILVER,
    """known AS (SELECT days_left, CAST(price AS DOUBLE) AS price FROM silver WHERE price > 0 AND days_left IS NOT NULL),
sides AS (
  SELECT t.days_left AS upto, sum(price) FILTER (k.days_left <= t.days_left) AS low_sum,
         count(*) FILTER (k.days_left <= t.days_left) AS low_n, sum(price) AS all_sum, count(*) AS all_n
  FROM known k, (SELECT DISTINCT days_left FROM known) t GROUP BY 1),
best AS (
  SELECT upto FROM sides WHERE low_n < all_n
  ORDER BY low_sum * low_sum / low_n + (all_sum - low_sum) * (all_sum - low_sum) / (all_n - low_n) DESC, upto LIMIT 1)""",
    select="""SELECT round(avg(price), 4) AS prediction, min(days_left) AS from_days, max(days_left) AS to_days,
      count(*) AS rows FROM known, best GROUP BY days_left <= upto""",
)

# Stored tables

ORACLE_SQL["delimited_round_trip"] = "SELECT s_suppkey, s_name, s_nationkey FROM supplier"
ORACLE_SQL["overwrite_then_append"] = """SELECT s_suppkey,
  CASE WHEN s_suppkey % 2 = 0 THEN s_name ELSE upper(s_name) END AS s_name FROM supplier"""
ORACLE_SQL["guarded_writes"] = """SELECT 'none' AS "table", false AS written, CAST(0 AS BIGINT) AS rows
  UNION ALL SELECT 'all', true, count(*) FROM supplier"""
ORACLE_SQL["log_in_steps"] = with_(
    SENT, LOG, select='SELECT topic, partition, "offset", count(*) AS times FROM log GROUP BY ALL'
)
ORACLE_SQL["log_tail"] = with_(SENT, LOG, select='SELECT topic, partition, "offset" FROM log')
ORACLE_SQL["airport_rows"] = with_(
    RAW,
    AIRPORT,
    select="SELECT code, count(*) AS rows FROM raw JOIN airport ON city = source_city GROUP BY code",
)
ORACLE_SQL["column_presence"] = """SELECT 'raw' AS dataset, CAST(15 AS BIGINT) AS columns
  FROM (SELECT count(*) FROM lineitem) UNION ALL SELECT 'canonical', 15 FROM (SELECT count(*) FROM lineitem)"""
