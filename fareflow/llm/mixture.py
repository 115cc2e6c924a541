"""Mix sources to target weights: repetition rates per source, one seeded Bernoulli draw per document.

Rows: a null text has size 0; null sources form one source, ranked last; a null ``doc_id`` draws
by its text; rows that repeat an id draw alike. Empty input gives empty output, and a corpus
without words takes nothing. Columns beyond ``doc_id``, ``text`` and ``source`` are not looked at.
"""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fareflow.workspace import settle

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (5, 2, 1)
MAX_RATE = 3
SEED = "mixture-1"


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def draw(seed: str) -> Column:
    """A number in [0, 1) that depends on the seed and the document alone: 52 bits of an MD5."""
    key = F.coalesce(F.col("doc_id").cast("string"), F.concat(F.lit("text:"), F.col("text")), F.lit("null"))
    bits = F.conv(F.substring(F.md5(F.concat(F.lit(f"{seed}:"), key)), 1, 13), 16, 10)
    return bits.cast("double") / F.lit(float(1 << 52))


def ranked(sources: DataFrame) -> DataFrame:
    """Number the sources from 0 by code point, null last, without sorting all of them in one task.

    Ranges of sources are numbered one by one; the few counts of the ranges give their offsets.
    """
    dealt = sources.repartitionByRange(F.col("source").isNull(), F.col("source"))
    dealt = settle(dealt.withColumn("part", F.spark_partition_id()), "sources")
    first_of_part = dealt.groupBy("part").agg(F.count("*").alias("n"), F.min(F.struct(F.col("source").isNull(), "source")).alias("low"))
    offsets = first_of_part.select(
        "part", (F.sum("n").over(Window.orderBy("low").rowsBetween(Window.unboundedPreceding, 0)) - F.col("n")).alias("offset")
    )
    within = F.row_number().over(Window.partitionBy("part").orderBy(F.col("source").isNull(), "source"))
    return dealt.withColumn("row", within).join(offsets, "part").select(
        "source", "source_size", (F.col("row") - 1 + F.col("offset")).alias("rank")
    )


def source_targets(
    sizes: DataFrame, weights: Sequence[int] = WEIGHTS, max_rate: int = MAX_RATE
) -> DataFrame:
    """Per source: its size, its target and the repetition rate, from rows of (source, size).

    Weights are dealt to the sources in order, repeating. A target is at most ``max_rate`` times
    its source; what that frees is shared anew by weight among the others until none is above.
    Each round is one aggregate over the sources and gives the words per weight unit (the level).
    """
    per_source = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    dealt = F.element_at(F.array(*map(F.lit, weights)), (F.col("rank") % len(weights) + 1).cast("int"))
    weighed = settle(ranked(per_source).withColumn("weight", dealt), "weights")
    most = max_rate * F.col("source_size")

    def totals(level: float | None) -> tuple[int, int]:
        above = F.lit(False) if level is None else most < F.lit(level) * F.col("weight")
        row = weighed.agg(
            F.sum(F.when(above, most).otherwise(0)), F.sum(F.when(above, 0).otherwise(F.col("weight")))
        ).first()
        return int(row[0] or 0), int(row[1] or 0)

    everything = int(weighed.agg(F.sum("source_size")).first()[0] or 0)
    kept, open_weight = totals(None)
    level = everything / open_weight if open_weight else 0.0
    while True:
        capped, rest = totals(level)
        if (capped, rest) == (kept, open_weight) or not rest:
            break
        kept, open_weight = capped, rest
        level = (everything - kept) / open_weight
    target = F.least(most.cast("double"), F.lit(level) * F.col("weight"))
    rate = F.when(F.col("source_size") > 0, target / F.col("source_size")).otherwise(0.0)
    return weighed.select("source", "source_size", target.alias("target"), rate.alias("rate"))


def copies_per_document(
    docs: DataFrame, weights: Sequence[int] = WEIGHTS, max_rate: int = MAX_RATE, seed: str = SEED
) -> DataFrame:
    """One row per document: doc_id, source, size, source_size, target, copies.

    Sizes are counted once and written; both the totals and the join read the small table. The
    source totals have map-side partials, and a hot source's rows stay where they are while the
    table of sources is small enough to broadcast; beyond that the join on the source is one that
    adaptive execution splits by skew.
    """
    rows = settle(
        docs.select("doc_id", "source", word_count(F.col("text")).alias("size"), draw(seed).alias("draw")), "sizes"
    )
    targets = settle(source_targets(rows, weights, max_rate), "targets")
    whole = F.floor("rate")
    extra = (F.col("draw") < F.col("rate") - whole).cast("long")
    joined = rows.join(targets.withColumnRenamed("source", "target_source"), F.col("source").eqNullSafe(F.col("target_source")))
    return joined.select("doc_id", "source", "size", "source_size", "target", (whole + extra).alias("copies"))


def mix(
    docs: DataFrame, weights: Sequence[int] = WEIGHTS, max_rate: int = MAX_RATE, seed: str = SEED
) -> DataFrame:
    """The mixture itself: every row of ``docs`` as often as its source's rate and its draw say.

    The columns of ``docs`` come back unchanged.
    """
    rows = settle(
        docs.select("source", word_count(F.col("text")).alias("size")).groupBy("source").agg(F.sum("size").alias("size")),
        "sizes",
    )
    targets = settle(source_targets(rows, weights, max_rate), "targets")
    rates = targets.select(F.col("source").alias("of"), "rate")
    fields = F.struct(*[docs[c] for c in docs.columns]).alias("row")
    drawn = docs.select(fields, docs["source"].alias("from"), draw(seed).alias("draw")).join(
        rates, F.col("from").eqNullSafe(F.col("of"))
    )
    copies = (F.floor("rate") + (F.col("draw") < F.col("rate") - F.floor("rate")).cast("long")).cast("int")
    repeated = drawn.select("row", copies.alias("copies")).filter("copies > 0")
    return repeated.select("row", F.explode(F.array_repeat(F.lit(1), F.col("copies")))).select("row.*")
