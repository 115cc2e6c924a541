"""Shards: exact sizes, gapless slots, nothing lost, counts drawn as a uniform shuffle does."""

import zlib
from collections import Counter
from math import comb

import numpy as np
import odd
from pyspark.sql import functions as F

from fareflow.llm import sharding


def test_draws_follow_the_hypergeometric_law(spark):
    n, k, d, times = 30, 12, 9, 40_000
    draw = sharding.hypergeometric(sharding.uniform(F.lit(1), F.col("id")), F.lit(n), F.lit(k), F.lit(d))
    got = {r["x"]: r["count"] for r in spark.range(times).select(draw.alias("x")).groupBy("x").count().collect()}
    chance = {x: comb(k, x) * comb(n - k, d - x) / comb(n, d) for x in range(d + 1)}
    assert set(got) <= set(chance)
    chi = sum((got.get(x, 0) - times * p) ** 2 / (times * p) for x, p in chance.items() if times * p > 5)
    assert chi < 30


def test_draws_at_their_limits_and_in_large_numbers(spark):
    cases = [(5, 5, 3), (5, 0, 3), (7, 3, 7), (1, 1, 1), (10, 9, 9), (2, 1, 1), (10**10, 10**9, 10**6)]
    rows = spark.createDataFrame(cases, "n long, k long, d long").withColumn("i", F.explode(F.sequence(F.lit(1), F.lit(400))))
    drawn = rows.select("n", "k", "d", sharding.hypergeometric(sharding.uniform(F.col("i"), F.col("n")), F.col("n"), F.col("k"), F.col("d")).alias("x"))
    for r in drawn.collect():
        assert max(0, r.d + r.k - r.n) <= r.x <= min(r.d, r.k)
    large = np.array([r.x for r in drawn.collect() if r.n == 10**10])
    spread = (10**6 * 0.1 * 0.9) ** 0.5
    assert abs(large.mean() - 10**5) < 5 * spread / 20
    assert 0.8 < large.std() / spread < 1.2


def test_matrix_has_both_margins_on_several_levels(spark, monkeypatch):
    monkeypatch.setattr(sharding, "FAN", 4)
    sizes = {p: (p * p) % 37 for p in range(23)}
    given = spark.createDataFrame(list(sizes.items()), "part long, n long")
    matrix = {r.part: r.counts for r in sharding.communication_matrix(given, 5, 7).collect()}
    assert {p: sum(c) for p, c in matrix.items()} == sizes
    columns = [sum(c[s] for c in matrix.values()) for s in range(5)]
    assert sum(columns) == sum(sizes.values()) and max(columns) - min(columns) <= 1


def test_every_row_has_a_slot_of_its_own(spark, monkeypatch):
    monkeypatch.setattr(sharding, "CELL_ROWS", 8)
    rows = spark.range(1000).select((F.col("id") % 10).alias("row"), F.lit("x").alias("key"), F.col("id").alias("part"), F.lit(3).alias("shard"))
    dealt = sharding.deal(rows.repartition(7), 16, 5)
    assert dealt.columns == ["row", "key", "part", "shard", "slot"]
    got = dealt.collect()
    assert sorted(r.part for r in got) == list(range(1000))
    slots = {}
    for r in got:
        slots.setdefault(r.shard, []).append(r.slot)
    assert sorted(map(len, slots.values())) == [62] * 8 + [63] * 8
    assert all(sorted(v) == list(range(len(v))) for v in slots.values())
    # order and shard do not follow the input
    assert abs(np.corrcoef([r.part for r in got], [r.shard * 63 + r.slot for r in got])[0, 1]) < 0.15


def test_shards_mix_all_partitions(spark):
    rows = spark.range(0, 3200, 1, 8)
    counts = Counter((r.id // 400, r.shard) for r in sharding.deal(rows, 4, 11).collect())
    # 100 expected in each of the 32 cells
    assert len(counts) == 32
    assert sum((c - 100) ** 2 / 100 for c in counts.values()) < 50


def test_digest_of_odd_documents(spark):
    docs = odd.odd_documents(spark)
    got = sharding.digest(docs).collect()
    want = sorted((str(i), len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t, *_ in odd.ODD)
    assert sorted((str(r.doc_id), r.size, r.text_crc32) for r in got) == want
    assert all(r.law == "rows" and r.grown_shard is None and r.slot == 0 for r in got)
    assert sorted(r.shard for r in got) == list(range(len(odd.ODD)))
    again = sharding.digest(docs).collect()
    assert sorted(map(str, again)) == sorted(map(str, got))
    assert sharding.digest(odd.no_documents(spark)).count() == 0


def test_shards_are_written_whole(spark, tmp_path):
    docs = odd.odd_documents(spark)
    sharding.write_shards(docs, str(tmp_path / "out"), 3)
    back = spark.read.parquet(str(tmp_path / "out"))
    assert sorted(str(r.text) for r in back.select("text").collect()) == sorted(str(r[1]) for r in odd.ODD)
    assert sorted(r["count"] for r in back.groupBy("shard").count().collect()) == [3, 4, 4]
