"""Fixed values of the fare domain. Each is only a default for an operator argument."""

# Cities served, in the order of the airport map.
CITIES = ("Delhi", "Mumbai", "Bangalore", "Chennai", "Hyderabad", "Kolkata")

# Airport code of each city.
AIRPORT_CODES = {
    "Delhi": "DEL",
    "Mumbai": "BOM",
    "Bangalore": "BLR",
    "Chennai": "MAA",
    "Hyderabad": "HYD",
    "Kolkata": "CCU",
}

# Cabin label -> seat name used in a search request.
SEAT_NAMES = {"Economy": "economy", "Business": "business"}

# Raw carrier spelling (trimmed, lower case) -> canonical name.
CARRIER_NAMES = {
    "vistara": "Air India",
    "air_india": "Air India",
    "indigo": "IndiGo",
    "go_first": "Go First",
    "airasia": "Air India Express",
    "spicejet": "SpiceJet",
}

# Stops label -> count, one table per data source.
HISTORY_STOPS = {"zero": 0, "one": 1, "two_or_more": 2}
LIVE_STOPS = {"nonstop": 0, "zero": 0, "one": 1, "two": 2}

# Carriers in scope of the live tables, by code and by upper-case name.
SCOPE_CODES = ("AI", "IX", "6E", "SG", "QP")
SCOPE_NAMES = ("AIR INDIA", "AIR INDIA EXPRESS", "INDIGO", "SPICEJET", "AKASA AIR")

# Event-time window, watermark and price-signal settings.
WINDOW_SIZE_SECONDS = 30 * 60
WINDOW_SLIDE_SECONDS = 10 * 60
WATERMARK = "1 hour"
SIGNAL_THRESHOLD = 1000
NEAREST_ROWS = 200
EVENT_TIME_PATTERN = "yyyy-MM-dd'T'HH:mm:ss[.SSSSSS]"
DATE_PATTERN = "yyyy-MM-dd"

# The business columns that make two live rows the same offer.
OFFER_KEYS = (
    "source_city",
    "destination_city",
    "travel_date",
    "airline",
    "departure_time",
    "arrival_time",
    "class",
    "price",
)

# Key columns of the price baseline, from the narrowest tier to the widest.
BASELINE_TIERS = (
    ("source_city", "destination_city", "cabin_class", "airline", "stops"),
    ("source_city", "destination_city", "cabin_class", "stops"),
    ("source_city", "destination_city", "cabin_class"),
    ("source_city", "destination_city"),
    ("cabin_class",),
    (),
)

# Model features.
CATEGORICAL_FEATURES = (
    "airline",
    "source_city",
    "destination_city",
    "departure_time",
    "arrival_time",
    "cabin_class",
)
NUMERIC_FEATURES = ("duration_minutes", "stops", "days_left")
