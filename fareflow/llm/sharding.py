"""Deal rows to shards by a uniform shuffle with exact shard sizes: a hypergeometric communication matrix.

1. Every input partition puts its rows into a random order of its own; only their number per
   partition is needed for what follows.
2. A uniform shuffle sends a multivariate hypergeometric number of rows from each partition to each
   shard. These counts are drawn exactly: a tree over the partitions, ``FAN`` children a node, hands
   down how many rows of each shard a subtree holds, and within a node children and shards are
   drawn one after the other by inversion from the mode. The first rows of a partition's
   order go to shard 0, the next to shard 1, and so on.
3. Rows are exchanged, and each shard is put into random order again: rows fall into cells by
   the top bits of a random key, counts of the cells give their offsets, and ranks are taken
   within cells. So no task holds a shard.

Shard sizes differ by one row at most. All of it is column expressions, sorts, aggregates and
joins; the random bits are hashes of a seed and the row's place, and places are written before
they are used, so a lost executor changes nothing.

Rows: every row is dealt, whatever it holds; null and empty texts count as any other, very long
texts are only measured, and repeated rows are dealt each on its own. Empty input gives empty
output, and shards without rows are possible when there are fewer rows than shards. Columns of the input may
have any names: they travel in one struct and come back as they were, but for columns called
``shard`` and ``slot``, which are replaced.
"""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fareflow.llm.texts import bound
from fareflow.workspace import settle

SHARDS = 16
SEED = 20_240_229
#: Children of a node in the tree over partitions.
FAN = 64
#: Rows that a cell of a shard has on average; it may have a few per cent more.
CELL_ROWS = 1 << 16
#: Standard deviations that a count may lie from the mode, and a least distance. What is beyond
#: has a probability below 1e-22.
REACH, LEAST_REACH = 10, 40


def uniform(*of: Column) -> Column:
    """A number in [0, 1) with 53 random bits."""
    return F.shiftrightunsigned(F.xxhash64(*of), 11).cast("double") / F.lit(float(1 << 53))


def hypergeometric(u: Column, total: Column, marked: Column, drawn: Column) -> Column:
    """How many of ``drawn`` rows of ``total`` are among the ``marked`` ones: inversion from the mode.

    The weights of the counts follow from each other by their ratios, starting with 1 at the mode;
    one pass adds them up, a second one stops where the sum reaches ``u`` times that total.
    """
    given = F.struct(*[x.cast("double").alias(c) for x, c in ((total, "n"), (marked, "k"), (drawn, "d"))], u.alias("u"))

    def limits(v: Column) -> Column:
        n, k, d = v["n"], v["k"], v["d"]
        return F.struct(
            n.alias("n"), k.alias("k"), d.alias("d"), v["u"].alias("u"),
            F.greatest(F.lit(0.0), d + k - n).alias("low"), F.least(d, k).alias("high"),
            F.floor((d + 1) * (k + 1) / (n + 2)).cast("double").alias("mode"),
            F.sqrt(F.greatest(d * (k / n) * (1 - k / n) * ((n - d) / F.greatest(n - 1, F.lit(1.0))), F.lit(0.0))).alias("spread"),
        )

    def walked(v: Column) -> Column:
        n, k, d, low, high, mode = (v[c] for c in ("n", "k", "d", "low", "high", "mode"))
        far = F.least(F.ceil(REACH * v["spread"]) + LEAST_REACH, F.greatest(high - mode, mode - low)).cast("long")
        steps = F.sequence(F.lit(1).cast("long"), far)

        def next_weights(state: Column, step: Column) -> Column:
            x, y = mode + step, mode - step
            up = state["above"] * (k - x + 1) * (d - x + 1) / (x * (n - k - d + x))
            down = state["below"] * (y + 1) * (n - k - d + y + 1) / ((k - y) * (d - y))
            return F.struct(
                F.when(x <= high, up).otherwise(0.0).alias("above"), F.when(y >= low, down).otherwise(0.0).alias("below")
            )

        def add(state: Column, step: Column) -> Column:
            return bound(next_weights(state, step), lambda w: F.struct(
                w["above"].alias("above"), w["below"].alias("below"), (state["sum"] + w["above"] + w["below"]).alias("sum")
            ))

        def walk(state: Column, step: Column) -> Column:
            left = state["left"]
            return F.when(left < 0, state).otherwise(bound(next_weights(state, step), lambda w: F.struct(
                w["above"].alias("above"), w["below"].alias("below"), (left - w["above"] - w["below"]).alias("left"),
                F.when(left - w["above"] < 0, mode + step).otherwise(mode - step).alias("at"),
            )))

        one = F.lit(1.0)
        sums = F.aggregate(steps, F.struct(one.alias("above"), one.alias("below"), one.alias("sum")), add, lambda s: s["sum"])
        start = F.struct(one.alias("above"), one.alias("below"), (v["u"] * sums - one).alias("left"), mode.alias("at"))
        found = F.aggregate(steps, start, walk, lambda s: s["at"])
        # one count is possible, or the mode has all the weight
        return F.when(low >= high, low).when(far < 1, mode).otherwise(found)

    return bound(bound(given, limits), walked).cast("long")


def split(seed: int, level: int, children: Column, caps: Column, shards: int) -> Column:
    """What each child of a node holds of each shard: array<struct<part, counts>>.

    ``children`` are struct<part, n>, ``caps`` the rows of each shard in the node. The children
    share the rows of each shard as draws without return do.
    """

    def counts_of(child: Column, left: Column) -> Column:
        def one_shard(state: Column, shard: Column) -> Column:
            cap = F.element_at(left, (shard + 1).cast("int"))
            u = uniform(F.lit(seed), F.lit(level), child["part"], shard)
            drawn = F.when(state["rows"] == 0, F.lit(0).cast("long")).otherwise(
                hypergeometric(u, state["total"], cap, state["rows"])
            )
            return bound(drawn, lambda count: F.struct(
                (state["total"] - cap).alias("total"), (state["rows"] - count).alias("rows"),
                F.concat(state["counts"], F.array(count)).alias("counts"),
            ))

        everything = F.aggregate(left, F.lit(0).cast("long"), lambda a, x: a + x)
        start = F.struct(everything.alias("total"), child["n"].alias("rows"), F.array().cast("array<bigint>").alias("counts"))
        return F.aggregate(F.sequence(F.lit(0), F.lit(shards - 1)), start, one_shard, lambda s: s["counts"])

    def one_child(state: Column, child: Column) -> Column:
        return bound(counts_of(child, state["caps"]), lambda counts: F.struct(
            F.zip_with(state["caps"], counts, lambda a, b: a - b).alias("caps"),
            F.concat(state["done"], F.array(F.struct(child["part"].alias("part"), counts.alias("counts")))).alias("done"),
        ))

    none = F.array().cast("array<struct<part: bigint, counts: array<bigint>>>")
    return F.aggregate(children, F.struct(caps.alias("caps"), none.alias("done")), one_child, lambda s: s["done"])


def communication_matrix(sizes: DataFrame, shards: int = SHARDS, seed: int = SEED) -> DataFrame:
    """part and counts (array<bigint>: rows to each shard), from one row of (part, n) per partition.

    Row sums are the partitions' sizes and column sums the shards', which differ by one at most.
    """
    levels = [settle(sizes.select(F.col("part").cast("long").alias("part"), F.col("n").cast("long").alias("n")), "parts")]
    top = levels[0].agg(F.max("part")).first()[0]
    while top is not None and top > 0:
        top //= FAN
        levels.append(settle(levels[-1].groupBy(F.floor(F.col("part") / FAN).alias("part")).agg(F.sum("n").alias("n")), "parts"))
    share = lambda s: F.floor(F.col("n") / shards) + F.when(F.col("n") % shards > s, 1).otherwise(0)
    nodes = levels[-1].select("part", F.array(*map(share, range(shards))).alias("counts"))
    for level in range(len(levels) - 2, -1, -1):
        children = levels[level].groupBy(F.floor(F.col("part") / FAN).alias("part")).agg(
            F.sort_array(F.collect_list(F.struct("part", "n"))).alias("children")
        )
        done = split(seed, level, F.col("children"), F.col("counts"), shards)
        nodes = settle(nodes.join(children, "part").select(F.inline(done)), "matrix")
    return nodes


def placed(rows: DataFrame, seed: int = SEED) -> DataFrame:
    """Every row as a struct ``row`` with its partition ``part``, its rank ``at`` in the partition's
    random order, and a random key for the order in its shard; written, so that all stay as they are.
    """
    fields = F.struct(*[rows[c] for c in rows.columns]) if rows.columns else F.struct(F.lit(None).alias("_"))
    numbered = rows.select(fields.alias("row"), F.monotonically_increasing_id().alias("place"))
    keyed = numbered.withColumn("order", F.xxhash64(F.lit(seed), F.col("place"), F.lit("local")))
    permuted = keyed.sortWithinPartitions("order", "place").withColumn("rank", F.monotonically_increasing_id())
    return settle(
        permuted.select(
            "row",
            F.shiftrightunsigned("rank", 33).alias("part"),
            F.col("rank").bitwiseAND((1 << 33) - 1).alias("at"),
            F.xxhash64(F.lit(seed), F.col("place"), F.lit("shard")).alias("key"),
            "place",
        ),
        "placed",
    )


def deal(rows: DataFrame, shards: int = SHARDS, seed: int = SEED) -> DataFrame:
    """The rows with ``shard`` and ``slot``: 0 to n - 1 within each shard, in uniformly random order."""
    rows = rows.drop("shard", "slot")
    put = placed(rows, seed)
    sizes = settle(put.groupBy("part").agg(F.count("*").alias("n")), "sizes")
    ends = F.transform(
        F.sequence(F.lit(1), F.lit(shards)),
        lambda s: F.aggregate(F.slice("counts", F.lit(1), s), F.lit(0).cast("long"), lambda a, x: a + x),
    )
    matrix = settle(communication_matrix(sizes, shards, seed).select("part", ends.alias("ends")), "ends")
    shard = F.size(F.filter("ends", lambda e: e <= F.col("at"))).cast("int")
    total = sizes.agg(F.sum("n")).first()[0] or 0
    cells = max(1, -(-total // (shards * CELL_ROWS)))
    # the upper 32 bits choose the cell, so cells are in the order of the keys
    cell = F.floor(F.shiftrightunsigned(F.col("key"), 32) * F.lit(cells) / F.lit(1 << 32)).cast("int")
    sent = put.join(matrix, "part").select("row", "place", "key", shard.alias("shard"), cell.alias("cell"))
    counts = sent.groupBy("shard", "cell").agg(F.count("*").alias("n"))
    before = Window.partitionBy("shard").orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
    offsets = settle(counts.select("shard", "cell", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset")), "offsets")
    within = Window.partitionBy("shard", "cell").orderBy("key", "place")
    ranked = sent.withColumn("rank", F.row_number().over(within)).join(offsets, ["shard", "cell"])
    return ranked.select("row.*", "shard", (F.col("offset") + F.col("rank") - 1).alias("slot"))


def write_shards(docs: DataFrame, path: str, shards: int = SHARDS, seed: int = SEED) -> None:
    """The documents as Parquet, a folder per shard."""
    deal(docs, shards, seed).write.mode("overwrite").partitionBy("shard").parquet(path)


def measured(docs: DataFrame) -> DataFrame:
    """doc_id, size (UTF-8 bytes of the text and 1 more) and text_crc32; a null text has no bytes."""
    text = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    return docs.select("doc_id", (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(text).alias("text_crc32"))


def digest(docs: DataFrame, shards: int = SHARDS, seed: int = SEED) -> DataFrame:
    """The measured documents dealt by the law ``rows``: shard sizes are at most one row apart."""
    return deal(measured(docs), shards, seed).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )
