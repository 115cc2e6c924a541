"""Find secrets with DataFrame functions alone: three patterns and a randomness test battery.

The battery looks at tokens of letters and digits, and at the parts of runs that paths, addresses and
names with signs are made of, so a key at the end of a path is tested too. The smallest alphabet that holds a
token's characters is its encoding; under the hypothesis that the characters were drawn evenly
from it, a chi-squared test looks at their counts, a runs test at changes between the lower and
the upper half of the alphabet, and a serial-correlation test at neighbours. The smallest of the
three, times three, is the token's p-value. Within each length band a false-discovery rule over
all tokens of the corpus (Benjamini-Hochberg, on binned p-values) says which tokens are plainly not
random; the others are spans of kind ``random``.

Rows: a null or empty text has no span; very long texts are scanned whole; repeated rows are handled one by one; a null ``doc_id``
stays null; empty input gives empty output; columns besides ``doc_id`` and ``text`` are ignored.
Offsets are code points, ends exclusive.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fareflow.llm.texts import bound
from fareflow.workspace import settle

ASSIGN = r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{14,}"
HEX = r"[0-9a-f]{16,}"
#: Runs that are looked at, and the stretches in them.
TOKEN = r"[A-Za-z0-9+/_-]{16,}"
PLAIN_RUN = r"[A-Za-z0-9]{16,}"
SIGNED_RUNS = (r"[A-Za-z0-9+/]{24,}", r"[A-Za-z0-9_-]{24,}")
#: Least length of a token with signs: paths and joined words are as short.
SIGNED = 24
#: Matches of a text whose offsets are added up together.
RUN = 256
KINDS = ("assign", "access", "hex", "random")
ASSIGN_LENGTH = 12
#: Length bands of the false-discovery rule: a band ends below the next start.
BANDS = (16, 20, 24, 32, 40, 48, 64, 96, 160)
RATE = 0.05
#: p-values are kept as tenths of a power of ten, up to this many.
BINS = 300
DIGITS, LOWER, UPPER = "0123456789", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: Encodings from small to large alphabets; the first that fits is taken.
ENCODINGS = (
    (r"^[0-9a-f]+$", DIGITS + LOWER[:6]),
    (r"^[0-9A-F]+$", DIGITS + UPPER[:6]),
    (r"^[A-Z2-7]+$", UPPER + DIGITS[2:8]),
    (r"^[0-9a-z]+$", DIGITS + LOWER),
    (r"^[0-9A-Z]+$", DIGITS + UPPER),
    (r"^[0-9A-Za-z]+$", DIGITS + UPPER + LOWER),
    (r"^[0-9A-Za-z+/]+$", DIGITS + UPPER + LOWER + "+/"),
    (r"^[0-9A-Za-z_-]+$", DIGITS + UPPER + LOWER + "_-"),
)


EMPTY = "array<struct<start:int,end:int,value:string>>"
TESTED = "array<struct<start:int,end:int,band:int,bin:int>>"


def matches(text: Column, pattern: str, group: int = 0) -> Column:
    """Leftmost non-overlapping matches as an array of (start, end, value); ``value`` is the group.

    The pieces between the matches give the offsets: they are added up in blocks of ``RUN`` matches and
    then over the blocks, so that work does not grow with the square of the matches. Only texts that match are taken apart.
    """
    lit = F.lit(pattern)
    steps = F.zip_with(
        F.split(text, pattern, -1),
        F.zip_with(
            F.regexp_extract_all(text, lit, F.lit(0)),
            F.regexp_extract_all(text, lit, F.lit(group)),
            lambda whole, value: F.struct(F.length(whole).alias("n"), value.alias("value")),
        ),
        lambda piece, found: F.struct(F.length(piece).alias("gap"), found.alias("found")),
    )
    none = F.array().cast(EMPTY)

    def add(state: Column, step: Column) -> Column:
        start = state["at"] + step["gap"]
        end = start + step["found"]["n"]
        entry = F.struct(start.alias("start"), end.alias("end"), step["found"]["value"].alias("value"))
        return F.struct(end.alias("at"), F.concat(state["spans"], F.array(entry)).alias("spans"))

    def in_block(block: Column) -> Column:
        return F.aggregate(block, F.struct(F.lit(0).alias("at"), none.alias("spans")), add)

    def blocks_of(steps: Column) -> Column:
        starts = F.sequence(F.lit(1), F.greatest(F.size(steps), F.lit(1)), F.lit(RUN))
        return F.transform(starts, lambda k: in_block(F.slice(steps, k, F.lit(RUN))))

    def offsets(blocks: Column) -> Column:
        return F.aggregate(
            blocks, F.array(F.lit(0)), lambda a, block: F.concat(a, F.array(F.element_at(a, -1) + block["at"]))
        )

    def moved(blocks: Column) -> Column:
        shifted = F.zip_with(
            blocks, F.slice(offsets(blocks), F.lit(1), F.size(blocks)),
            lambda block, by: F.transform(block["spans"], lambda m: F.struct(
                (m["start"] + by).alias("start"), (m["end"] + by).alias("end"), m["value"].alias("value")
            )),
        )
        return F.flatten(shifted)

    found = F.filter(steps, lambda s: s["found"].isNotNull())
    return F.when(F.rlike(text, lit), bound(bound(found, blocks_of), moved)).otherwise(none)


def normal_tail(z: Column) -> Column:
    """Upper tail of the standard normal for z >= 0, by a rational approximation of erfc."""
    x = z / F.sqrt(F.lit(2.0))
    t = 1 / (1 + 0.3275911 * x)
    poly = t * (0.254829592 + t * (-0.284496736 + t * (1.421413741 + t * (-1.453152027 + t * 1.061405429))))
    return F.least(F.lit(0.5), 0.5 * poly * F.exp(-x * x))


def battery(token: Column) -> Column:
    """The p-value of the hypothesis that ``token`` is random in its encoding; null if it has none."""
    alphabet = F.lit(None).cast("string")
    for pattern, letters in reversed(ENCODINGS):
        alphabet = F.when(F.rlike(token, F.lit(pattern)), F.lit(letters)).otherwise(alphabet)
    n, size = F.length(token).cast("double"), F.length(alphabet).cast("double")
    counts = F.transform(
        F.split(alphabet, ""), lambda c: F.length(token) - F.length(F.replace(token, c, F.lit("")))
    )
    squares = F.aggregate(counts, F.lit(0.0), lambda s, c: s + c.cast("double") * c)
    chi, free = size / n * squares - n, size - 1
    spread = 2 / (9 * free)
    uneven = (F.pow(chi / free, 1.0 / 3) - (1 - spread)) / F.sqrt(spread)
    p_even = F.when(uneven > 0, normal_tail(uneven)).otherwise(0.5)

    places = F.transform(F.split(token, ""), lambda c: F.instr(alphabet, c).cast("double"))
    zero = F.struct(
        F.lit(-1.0).alias("last"), F.lit(0.0).alias("runs"), F.lit(0.0).alias("high"), F.lit(0.0).alias("s"),
        F.lit(0.0).alias("ss"), F.lit(0.0).alias("lag"),
    )

    def step(a: Column, x: Column) -> Column:
        first = a["last"] < 0
        high, was = x > size / 2, a["last"] > size / 2
        return F.struct(
            x.alias("last"),
            (a["runs"] + F.when(first | (high != was), 1.0).otherwise(0.0)).alias("runs"),
            (a["high"] + high.cast("double")).alias("high"),
            (a["s"] + x).alias("s"),
            (a["ss"] + x * x).alias("ss"),
            (a["lag"] + F.when(first, 0.0).otherwise(a["last"] * x)).alias("lag"),
        )

    def verdict(a: Column) -> Column:
        high, low = a["high"], n - a["high"]
        both = 2 * high * low
        variance = both * (both - n) / (n * n * (n - 1))
        runs = F.abs(a["runs"] - both / n - 1) / F.sqrt(variance)
        p_runs = F.when(variance > 0, 2 * normal_tail(runs)).otherwise(0.0)
        mean = a["s"] / n
        spread_of = a["ss"] - n * mean * mean
        serial = F.abs((a["lag"] - (n - 1) * mean * mean) / spread_of + 1 / n) * F.sqrt(n)
        p_serial = F.when(spread_of > 0, 2 * normal_tail(serial)).otherwise(0.0)
        return F.least(F.lit(1.0), 3 * F.least(p_even, p_runs, p_serial))

    return F.when(alphabet.isNotNull(), F.aggregate(places, zero, step, verdict))


def p_bin(p: Column) -> Column:
    """Bin 0 holds the largest p-values; bin k has p in (10^(-(k+1)/10), 10^(-k/10)]."""
    return F.least(F.lit(BINS), F.floor(-10 * F.log10(F.greatest(p, F.lit(1e-40))) + 1e-9)).cast("int")


def band(length: Column) -> Column:
    return sum((length >= start).cast("int") for start in BANDS) - 1


def of_kind(spans: Column, kind: str) -> Column:
    number = F.lit(KINDS.index(kind))
    return F.transform(spans, lambda m: F.struct(m["start"].alias("start"), number.alias("kind"), m["end"].alias("end")))


def base_spans(text: Column) -> Column:
    """Array of (start, kind number, end) of the three patterns."""
    found = {
        "assign": F.filter(matches(text, ASSIGN, 1), lambda m: F.length(m["value"]) >= ASSIGN_LENGTH),
        "access": matches(text, ACCESS),
        "hex": matches(text, HEX),
    }
    return F.concat(*[of_kind(spans, kind) for kind, spans in found.items()])


def mixed(value: Column) -> Column:
    """Whether a token has letters and digits."""
    return F.rlike(value, F.lit("[0-9]")) & F.rlike(value, F.lit("[A-Za-z]"))


def tested(found: Column, begin: Column) -> Column:
    """Matches as (start, end, band, bin), moved by ``begin``."""
    return F.transform(found, lambda m: F.struct(
        (m["start"] + begin).alias("start"), (m["end"] + begin).alias("end"),
        band(F.length(m["value"])).alias("band"), p_bin(battery(m["value"])).alias("bin"),
    ))


def tested_tokens(text: Column) -> Column:
    """Array of (whole, parts) of the runs of letters, digits and the signs of encodings.

    ``whole`` is the run as (start, end, band, bin) and null if no encoding has all of its characters or it is too
    short for one with signs; ``parts`` are the pieces to look at if the whole is not reported: stretches of letters
    and digits, and, of a run that no encoding fits, those in either alphabet with signs.
    """
    def run(m: Column) -> Column:
        value, begin = m["value"], m["start"]
        plain = F.rlike(value, F.lit("^[A-Za-z0-9]+$"))
        both = F.rlike(value, F.lit("[+/]")) & F.rlike(value, F.lit("[_-]"))
        none = F.array().cast(EMPTY)
        whole = F.when((plain | (~both & (F.length(value) >= SIGNED))) & mixed(value), F.array(F.struct(
            F.lit(0).alias("start"), F.length(value).alias("end"), value.alias("value")
        ))).otherwise(none)
        signed = [F.filter(matches(value, p), lambda x: F.rlike(x["value"], F.lit("[^A-Za-z0-9]"))) for p in SIGNED_RUNS]
        parts = F.when(plain, none).otherwise(F.concat(matches(value, PLAIN_RUN), F.when(both, F.concat(*signed)).otherwise(none)))
        parts = F.filter(parts, lambda x: mixed(x["value"]))
        return F.struct(F.get(tested(whole, begin), F.lit(0)).alias("whole"), tested(parts, begin).alias("parts"))

    looked = F.transform(matches(text, TOKEN), run)
    return F.filter(looked, lambda r: r["whole"].isNotNull() | (F.size(r["parts"]) > 0))


def random_tokens(runs: Column, limits: dict[int, int]) -> Column:
    """Those of the tested tokens that are not plainly regular; a part inside another one is left out."""
    edges = F.array(*[F.lit(limits[b]) for b in range(len(BANDS))])

    def passes(m: Column) -> Column:
        return m["bin"] < F.element_at(edges, m["band"] + 1)

    def widest(parts: Column) -> Column:
        def inside(a: Column, b: Column) -> Column:
            return (b["start"] <= a["start"]) & (a["end"] <= b["end"]) & (b["end"] - b["start"] > a["end"] - a["start"])

        return F.filter(parts, lambda a: ~F.exists(parts, lambda b: inside(a, b)))

    def of_run(run: Column) -> Column:
        kept = bound(F.filter(run["parts"], passes), widest)
        return F.when(run["whole"].isNotNull() & passes(run["whole"]), F.array(run["whole"])).otherwise(kept)

    return F.flatten(F.transform(runs, of_run))


def scan(docs: DataFrame) -> DataFrame:
    """doc_id, base (array of start, kind, end) and tokens (array of whole and parts)."""
    text = F.coalesce(F.col("text"), F.lit(""))
    return docs.select("doc_id", base_spans(text).alias("base"), tested_tokens(text).alias("tokens"))


def plain_from_bin(scanned: DataFrame, rate: float = RATE) -> dict[int, int]:
    """Per length band the bin from which on tokens are plainly not random.

    Step-up rule over the counts of (band, bin), at most ``len(BANDS) * (BINS + 1)`` rows.
    """
    each = F.concat(F.when(F.col("t.whole").isNotNull(), F.array("t.whole")).otherwise(F.array().cast(TESTED)), F.col("t.parts"))
    tokens = scanned.select(F.explode("tokens").alias("t")).select(F.explode(each).alias("t"))
    counts = tokens.groupBy("t.band", "t.bin").count().collect()
    limits = {}
    for b in range(len(BANDS)):
        bins = {r["bin"]: r["count"] for r in counts if r["band"] == b}
        total, so_far = sum(bins.values()), 0
        limits[b] = BINS + 1
        for k in sorted(bins, reverse=True):
            so_far += bins[k]
            if 10 ** (-k / 10) <= rate * so_far / total:
                limits[b] = k
    return limits


def find_secrets(docs: DataFrame, rate: float = RATE) -> DataFrame:
    """doc_id and spans: array of (start, kind number, end), sorted by start, then kind."""
    scanned = settle(scan(docs), "secrets")
    limits = plain_from_bin(scanned, rate)
    kept = random_tokens(F.col("tokens"), limits)
    return scanned.select("doc_id", F.array_sort(F.concat("base", of_kind(kept, "random"))).alias("spans"))


def written(spans: Column) -> Column:
    """kind:start:end, comma-joined."""
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", F.element_at(names, s["kind"] + 1), s["start"], s["end"])), ","
    )


def digest(found: DataFrame) -> DataFrame:
    """Counts per kind, the digest of the base spans and all spans as text."""
    def count(kind: int) -> Column:
        """How many spans have the kind of this number."""
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")

    base = F.filter("spans", lambda s: s["kind"] < KINDS.index("random"))
    return found.select(
        "doc_id", *[count(i).alias(f"n_{k}") for i, k in enumerate(KINDS)],
        F.sha2(written(base), 256).alias("base_sha256"), written(F.col("spans")).alias("spans"),
    )


def without_secrets(docs: DataFrame, rate: float = RATE) -> DataFrame:
    """The rows of ``docs`` whose text has no span, columns unchanged.

    The counts of the tokens are gathered first; with them every row is decided by its own text,
    so no text is shuffled.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    tokens = settle(docs.select(tested_tokens(text).alias("tokens")).filter(F.size("tokens") > 0), "tokens")
    random = random_tokens(tested_tokens(text), plain_from_bin(tokens, rate))
    return docs.filter((F.size(base_spans(text)) == 0) & (F.size(random) == 0))
