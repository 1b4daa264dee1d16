"""SimHash near-duplicates: a self-join of a binary trie of fingerprints.

1. One pass over all texts gives every document's 64-bit fingerprint: a bit is
   set where more than half of the XXH64 hashes of its 3-word shingles have it.
   Equal fingerprints become one.
2. The trie over the distinct fingerprints is cut into subtrees of at most
   ``LEAF`` members: a node with more is split by its next four bits.
3. Node pairs are traversed together from (root, root): the children of one
   meet the children of the other, the bits in which their paths differ add up,
   and a pair beyond the budget is dropped with everything below it. Down to
   the subtrees this is a chain of joins over small node tables; within a pair
   of subtrees, all of whose members fit one row, it goes on bit by bit.
4. Pairs of single fingerprints within the budget are the links; their
   components are found in Spark.

A node's task sees at most two subtrees, whatever its region of the trie holds,
so neither a hot prefix nor a crowd of near copies meets in one group.

Edge cases: null, empty and blank texts have fingerprint zero and are linked
like any other; a null id takes part but never names a component (a component
without ids is null); repeated rows stay separate; an empty table gives an empty
result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterable
from itertools import accumulate

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from blotter.llm.blocking import components
from blotter.llm.frames import doc_texts, stored

WORDS = 3
SEED = 42
BITS = 64
BUDGET = 2
#: Bits by which a node is split, members of a subtree that is not split any
#: more, and levels of nodes that are counted in one job.
STEP, LEAF, LEVELS = 4, 1024, 4
#: Node pairs of one bit level that are held at once, and pairs of subtrees
#: that are traversed together.
HELD, TOGETHER = 1 << 19, 64
HASHES = 1 << 16


def fingerprint(text: bytes, words: int = WORDS) -> int:
    """SimHash of the shingles of ``text`` (UTF-8); 0 without words."""
    found = text.lower().split()
    if not found:
        return 0
    joined = b" ".join(found)
    ends = list(accumulate(map(len, found), lambda a, b: a + 1 + b))
    starts = [0, *(e + 1 for e in ends)]
    digest = xxhash.xxh64_intdigest
    spans = zip(starts, ends[words - 1 :], strict=False) if len(found) >= words else [(0, len(joined))]
    hashes = np.fromiter((digest(joined[a:b], SEED) for a, b in spans), np.uint64)
    count = np.zeros(BITS, np.int64)
    for i in range(0, len(hashes), HASHES):
        octets = hashes[i : i + HASHES].view(np.uint8).reshape(-1, 8)
        count += np.unpackbits(octets, axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * count > len(hashes), bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, words: int = WORDS) -> DataFrame:
    """(doc_id, print): the fingerprint of every row as a signed long."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(1).cast(pa.binary() if pa.types.is_string(batch.column(1).type) else pa.large_binary())
            made = np.fromiter((fingerprint(x.as_py() or b"", words) for x in texts), np.uint64, batch.num_rows)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(made.view(np.int64))], names=["doc_id", "print"])

    return doc_texts(docs).mapInArrow(run, "doc_id long, print long")


def _nodes(depths: list[int]):
    """The nodes (depth, path) of ``depths`` that lie above a fingerprint."""
    return F.explode(F.array(*[F.struct(F.lit(d).alias("depth"), F.shiftrightunsigned("print", BITS - d).alias("path")) for d in depths])).alias("node")


def trie(prints: DataFrame, leaf: int = LEAF) -> tuple[DataFrame, DataFrame, int]:
    """(nodes (depth, path, inner), subtrees (depth, path, prints), deepest
    node) of the distinct fingerprints ``prints``. The root is no row of
    ``nodes``; it is split always."""
    rest, depth, nodes, leaves = prints, 0, None, None
    while True:
        depths = list(range(depth + STEP, min(depth + STEP * LEVELS, BITS) + 1, STEP))
        paths = rest.select("print", _nodes(depths)).select("print", "node.*")
        counted = stored(paths.groupBy("depth", "path").agg((F.count("*") > leaf).alias("inner")), "trie-nodes")
        above = counted.where("inner").select((F.col("depth") + STEP).alias("depth"), F.col("path").alias("above"))
        lower = counted.where(F.col("depth") > depths[0]).withColumn("above", F.shiftrightunsigned("path", STEP))
        # a node is there if the one above it was split
        made = counted.where(F.col("depth") == depths[0]).unionByName(lower.join(above, ["depth", "above"]).drop("above"))
        own = paths.join(made.where("not inner").drop("inner"), ["depth", "path"])
        packed = own.groupBy("depth", "path").agg(F.sort_array(F.collect_list("print")).alias("prints"))
        nodes = made if nodes is None else nodes.unionByName(made)
        leaves = packed if leaves is None else leaves.unionByName(packed)
        depth = depths[-1]
        crowded = counted.where((F.col("depth") == depth) & F.col("inner")).select("path")
        if depth == BITS or crowded.isEmpty():
            break
        rest = stored(rest.withColumn("path", F.shiftrightunsigned("print", BITS - depth)).join(crowded, "path", "left_semi").select("print"), "trie-crowded")
    nodes = stored(nodes, "trie-kept")
    return nodes, stored(leaves, "trie-leaves"), nodes.agg(F.max("depth")).first()[0] or 0


def node_pairs(nodes: DataFrame, deepest: int, budget: int = BUDGET) -> DataFrame:
    """(da, pa, db, pb, differ): the pairs of subtrees that the traversal
    reaches. ``differ`` counts the bits of their common depth that differ."""
    kinds = nodes.withColumn("above", F.shiftrightunsigned("path", STEP))

    def side(s: str, rows: DataFrame) -> DataFrame:
        return rows.select(F.col("depth").alias(f"d{s}"), F.col("path").alias(f"p{s}"), F.col("inner").alias(f"i{s}"), F.col("above").alias(f"u{s}"))

    def differ(wide: str = "0"):
        return F.expr(f"cast(bit_count(pa ^ pb) as int) + {wide}")

    # the children of the root; every one has a path of STEP bits
    top = kinds.where(F.col("depth") == STEP)
    met = side("a", top).join(side("b", top), F.col("ua") == F.col("ub")).where("pa <= pb").withColumn("differ", differ())
    met = met.where(F.col("differ") <= budget).drop("ua", "ub")
    done = met.where("not ia and not ib")
    for depth in range(2 * STEP, deepest + 1, STEP):
        below = kinds.where(F.col("depth") == depth)
        open_ = stored(met.where("ia or ib"), "trie-pairs")
        keep_a, keep_b = open_.where("not ia"), open_.where("not ib")
        both = open_.where("ia and ib").select(F.col("pa").alias("ua"), F.col("pb").alias("ub"), "differ")
        both = both.withColumnRenamed("differ", "so_far").join(side("a", below), "ua").join(side("b", below), "ub")
        # of a node with itself, each pair of children once
        both = both.where("ua <> ub or pa <= pb").withColumn("differ", F.expr(f"so_far + cast(bit_count((pa ^ pb) & {(1 << STEP) - 1}) as int)"))
        right = keep_a.drop("db", "ib").withColumnRenamed("pb", "ub").join(side("b", below), "ub")
        left = keep_b.drop("da", "ia").withColumnRenamed("pa", "ua").join(side("a", below), "ua")
        names = ["da", "pa", "ia", "db", "pb", "ib", "differ"]
        met = both.where(F.col("differ") <= budget).select(names).unionByName(right.select(names)).unionByName(left.select(names))
        done = done.unionByName(met.where("not ia and not ib"))
    return done.select("da", "pa", "db", "pb", "differ")


def traverse(members: np.ndarray, level: int, ranges: np.ndarray, differ: np.ndarray, same: np.ndarray, budget: int) -> Iterable[tuple[np.ndarray, np.ndarray]]:
    """Positions (a, b) of the linked members of pairs of trie nodes. A node is
    a range of ``members`` whose first ``level`` bits agree; ``ranges`` has
    (from, to, from, to) of each pair, ``differ`` its differing bits so far,
    ``same`` whether it is a node with itself."""
    work = [(level, ranges, differ, same)]
    while work:
        level, ranges, differ, same = work.pop()
        single = (ranges[:, 1] - ranges[:, 0] == 1) & (ranges[:, 3] - ranges[:, 2] == 1)
        if single.any():
            a, b = ranges[single, 0], ranges[single, 2]
            near = (np.bitwise_count(members[a] ^ members[b]) <= budget) & ~same[single]
            yield a[near], b[near]
            ranges, differ, same = ranges[~single], differ[~single], same[~single]
        if not len(ranges) or level == BITS:
            continue
        if len(ranges) > HELD:
            half = len(ranges) // 2
            work.append((level, ranges[half:], differ[half:], same[half:]))
            work.append((level, ranges[:half], differ[:half], same[:half]))
            continue
        # in a sorted range whose first bits agree, those with the next bit 0 come first
        bit = (members >> np.uint64(BITS - 1 - level)) & np.uint64(1)
        ones = np.concatenate([[0], np.cumsum(bit, dtype=np.int64)])
        a0, a1, b0, b1 = ranges.T
        am, bm = a1 - (ones[a1] - ones[a0]), b1 - (ones[b1] - ones[b0])
        kinds = []
        for fa, ta, fb, tb, extra, itself in ((a0, am, b0, bm, 0, True), (am, a1, bm, b1, 0, True), (a0, am, bm, b1, 1, False), (am, a1, b0, bm, 1, False)):
            more = differ + extra
            keep = (fa < ta) & (fb < tb) & (more <= budget)
            if extra and fa is am:  # of a node with itself, the other order
                keep &= ~same
            kinds.append((np.stack([fa, ta, fb, tb], 1)[keep], more[keep], same[keep] & itself))
        work.append((level + 1, *(np.concatenate(x) for x in zip(*kinds, strict=True))))


def linked_prints(pairs: DataFrame, leaves: DataFrame, budget: int = BUDGET) -> DataFrame:
    """(a, b): the fingerprints of ``pairs`` of subtrees within the budget."""
    left = leaves.select(F.col("depth").alias("da"), F.col("path").alias("pa"), F.col("prints").alias("xs"))
    right = leaves.select(F.col("depth").alias("db"), F.col("path").alias("pb"), F.col("prints").alias("ys"))
    full = pairs.join(left, ["da", "pa"]).join(right, ["db", "pb"])
    level = F.least("da", "db").alias("level")
    itself = ((F.col("da") == F.col("db")) & (F.col("pa") == F.col("pb"))).alias("same")
    full = full.where(~itself | (F.size("xs") > 1)).select(level, "differ", itself, "xs", "ys")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, TOGETHER):
                part = batch.slice(start, TOGETHER)
                levels, differ, same = (np.asarray(part.column(i)) for i in range(3))
                sides = [part.column(i) for i in (3, 4)]
                ends = [x.offsets.to_numpy().astype(np.int64) for x in sides]
                held = [x.values.to_numpy()[e[0] : e[-1]] for x, e in zip(sides, ends, strict=True)]
                # Spark sorts longs as signed; a subtree's members agree in their first bits, so that order is the trie's
                members = np.concatenate(held).view(np.uint64)
                xs, ys = ends[0] - ends[0][0], ends[1] - ends[1][0] + len(held[0])
                ranges = np.stack([xs[:-1], xs[1:], ys[:-1], ys[1:]], 1)
                ranges[same, 2:] = ranges[same, :2]
                for level in np.unique(levels).tolist():
                    at = levels == level
                    for a, b in traverse(members, level, ranges[at], differ[at].astype(np.int64), same[at], budget):
                        if len(a):
                            yield pa.RecordBatch.from_arrays([pa.array(members[a].view(np.int64)), pa.array(members[b].view(np.int64))], names=["a", "b"])

    return full.mapInArrow(run, "a long, b long")


def simhash_components(docs: DataFrame, budget: int = BUDGET, leaf: int = LEAF, words: int = WORDS) -> DataFrame:
    """(doc_id, fingerprint, component_id) per document."""
    rows = stored(fingerprints(docs, words), "simhash")
    prints = stored(rows.groupBy("print").agg(F.min("doc_id").alias("least")), "simhash-prints")
    nodes, leaves, deepest = trie(prints.select("print"), leaf)
    links = stored(linked_prints(node_pairs(nodes, deepest, budget), leaves, budget), "simhash-links")
    roots = components(links)
    named = prints.join(roots.withColumnRenamed("c", "print"), "print", "left").withColumn("root", F.coalesce("root", "print"))
    smallest = named.groupBy("root").agg(F.min("least").alias("component_id"))
    of_print = named.select("print", "root").join(smallest, "root").select("print", "component_id")
    shown = F.lpad(F.lower(F.hex("print")), BITS // 4, "0").alias("fingerprint")
    return rows.join(of_print, "print").select("doc_id", shown, "component_id")
