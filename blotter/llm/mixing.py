"""Mixing sources to target weights by Sainte-Lague apportionment.

Sizes are words. Sources, in code-point order with null last, weigh 3, 1, 2,
repeating, and share ``share`` times all words; a target stops at ``most``
times its source's size and the excess goes to the others by weight until none
is above (``source_targets``).

A source's documents are dealt by a seeded hash of id and text into shards, and in
each shard laid end to end in seeded order and cut into equal blocks of
``block_words`` words. The blocks that the mix holds are apportioned to the
shards by highest quotients ``votes / (2 * seats + 1)``, first to sources by
target, then within a source by shard size, which gives whole quotas. In each
shard a seeded permutation orders the blocks; with a quota of q and n blocks,
every block is taken q // n times and the first q % n in that order once more.
A document's ``taken`` is the overlap of its words with the taken blocks, so
it never exceeds ``most`` times its size.

Only (source, shard) totals reach the driver: at most ``MAX_SHARDS`` plus one
row per source. Document rows meet in a window per shard; shards hold about
``SHARD_WORDS`` words, so a source with a third of all rows is spread over a
third of the shards.

Edge cases: null and empty texts have size 0 and take nothing; a null source
is a source; rows with a null or a repeated id are dealt by their texts; rows of
equal id and text share a shard, which changes no total; an empty table gives an empty result;
a corpus without words gives targets 0.
"""

from __future__ import annotations

import heapq
from math import floor

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from blotter.llm.frames import stored

WEIGHTS = (3, 1, 2)
SHARE, MOST = 1.5, 2.0
BLOCK_WORDS = 32
SHARD_WORDS = 400_000
MAX_SHARDS = 16_384
#: A prime above 2**31: coprime to every block count below it.
STEP = 2_147_483_659


def word_count(text: Column) -> Column:
    """Words of ``[^\\x20\\x09-\\x0D]+``; null: 0."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def source_targets(sizes: list[int], share: float = SHARE, most: float = MOST) -> list[float]:
    """Targets of sources given in order."""
    weights = [WEIGHTS[i % len(WEIGHTS)] for i in range(len(sizes))]
    targets = [0.0] * len(sizes)
    left, open_ = share * sum(sizes), list(range(len(sizes)))
    while open_:
        total = sum(weights[i] for i in open_)
        above = [i for i in open_ if left * weights[i] / total > most * sizes[i]]
        if not above:
            for i in open_:
                targets[i] = left * weights[i] / total
            break
        for i in above:
            targets[i] = most * sizes[i]
        left -= sum(targets[i] for i in above)
        open_ = [i for i in open_ if i not in set(above)]
    return targets


def sainte_lague(votes: list[float], seats: int, caps: list[int]) -> list[int]:
    """Seats by highest quotients ``v / (2s + 1)``, none above its cap. Starts
    from the rounded shares, which the quotient rule agrees with at its own
    house size, and adds or takes back one seat at a time from there."""
    total = sum(votes)
    seats = min(seats, sum(c for v, c in zip(votes, caps, strict=True) if v > 0))
    if total <= 0 or seats <= 0:
        return [0] * len(votes)
    got = [min(floor(v * seats / total + 0.5), c) for v, c in zip(votes, caps, strict=True)]
    given = sum(got)
    if given > seats:
        heap = [(v / (2 * g - 1), -i) for i, (v, g) in enumerate(zip(votes, got, strict=True)) if g]
        heapq.heapify(heap)
        while given > seats:
            i = -heapq.heappop(heap)[1]
            got[i] -= 1
            given -= 1
            if got[i]:
                heapq.heappush(heap, (votes[i] / (2 * got[i] - 1), -i))
    elif given < seats:
        heap = [(-v / (2 * g + 1), i) for i, (v, g, c) in enumerate(zip(votes, got, caps, strict=True)) if v > 0 and g < c]
        heapq.heapify(heap)
        while given < seats and heap:
            i = heapq.heappop(heap)[1]
            got[i] += 1
            given += 1
            if got[i] < caps[i]:
                heapq.heappush(heap, (-votes[i] / (2 * got[i] + 1), i))
    return got


def _quotas(rows: list, block: int) -> tuple[list[dict], list[dict]]:
    """(sources, shards): targets by source, block quotas by shard."""
    names = sorted({r["source"] for r in rows}, key=lambda s: (s is None, s or ""))
    by = {s: sorted((r for r in rows if r["source"] == s), key=lambda r: r["shard"]) for s in names}
    sizes = [sum(r["words"] for r in by[s]) for s in names]
    targets = source_targets(sizes)
    blocks = {s: [-(-r["words"] // block) for r in by[s]] for s in names}
    seats = sainte_lague(targets, round(sum(targets) / block), [int(MOST) * sum(blocks[s]) for s in names])
    shards = []
    for s, quota in zip(names, seats, strict=True):
        own = sainte_lague([float(r["words"]) for r in by[s]], quota, [int(MOST) * b for b in blocks[s]])
        shards += [{"source": s, "shard": r["shard"], "blocks": b, "quota": q} for r, b, q in zip(by[s], blocks[s], own, strict=True)]
    return [{"source": s, "source_size": n, "target": t} for s, n, t in zip(names, sizes, targets, strict=True)], shards


def mix_sources(spark: SparkSession, docs: DataFrame, seed: int = 31, block_words: int = BLOCK_WORDS) -> DataFrame:
    """(doc_id, size, source_size, target, taken) per document."""
    narrow = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"), word_count(F.col("text")).alias("size"), F.xxhash64("text").alias("salt")
    )
    sized = stored(narrow, "mix-sizes")  # texts are read once; four values a document from here on
    sources = [r.asDict() for r in sized.groupBy("source").agg(F.sum("size").alias("source_words")).collect()]
    total = sum(r["source_words"] for r in sources)
    n_shards = int(min(MAX_SHARDS, max(1, -(-total // SHARD_WORDS))))
    # A source's shards are a run of the seeded hash's range whose length
    # follows the source's share, at least one.
    spread = [(r["source"], max(1, round(n_shards * r["source_words"] / total)) if total else 1) for r in sources]
    spread_df = spark.createDataFrame(spread, "s string, n_shards long")
    # one row per source, which the driver has just counted
    dealt = sized.join(F.broadcast(spread_df), F.col("source").eqNullSafe(F.col("s")), "left").select(
        "doc_id", "source", "size", "salt", F.pmod(F.xxhash64(F.lit(seed), "doc_id", "salt"), F.coalesce("n_shards", F.lit(1))).alias("shard")
    )
    totals = dealt.groupBy("source", "shard").agg(F.sum("size").alias("words")).collect()
    by_source, by_shard = _quotas([r.asDict() for r in totals], block_words)
    goal_df = spark.createDataFrame(by_source, "source string, source_size long, target double").withColumnRenamed("source", "s1")
    shard_df = spark.createDataFrame(by_shard, "source string, shard long, blocks long, quota long").select(
        F.col("source").alias("s2"), F.col("shard").alias("k2"), "blocks", "quota"
    )
    order = Window.partitionBy("source", "shard").orderBy(F.xxhash64(F.lit(seed + 1), "doc_id", "salt"), F.col("doc_id").asc_nulls_last(), "size", "salt")
    placed = dealt.withColumn("end", F.sum("size").over(order.rowsBetween(Window.unboundedPreceding, 0))).withColumn("start", F.col("end") - F.col("size"))
    known = placed.join(F.broadcast(shard_df), F.col("source").eqNullSafe(F.col("s2")) & (F.col("shard") == F.col("k2")), "left").join(
        F.broadcast(goal_df), F.col("source").eqNullSafe(F.col("s1")), "left"
    )
    block = F.lit(block_words)
    # The seeded order of a shard's n blocks: i -> (STEP * i + shift) mod n, a
    # permutation as STEP is prime and larger than n.
    n = F.greatest("blocks", F.lit(1))
    shift = F.pmod(F.xxhash64(F.lit(seed + 2), "source", "shard"), n)

    def overlap(i: Column) -> Column:
        words = F.least(F.col("end"), (i + 1) * block) - F.greatest(F.col("start"), i * block)
        rank = F.pmod(i * F.lit(STEP) + shift, n)
        times = F.floor(F.col("quota") / n) + F.when(rank < F.col("quota") % n, 1).otherwise(0)
        return words * times

    spans = F.sequence(F.floor(F.col("start") / block), F.floor((F.col("end") - 1) / block))
    taken = F.aggregate(spans, F.lit(0).cast("long"), lambda acc, i: acc + overlap(i).cast("long"))
    return known.select(
        "doc_id", "size", "source_size", "target", F.when(F.col("size") > 0, taken).otherwise(F.lit(0).cast("long")).alias("taken")
    )
