"""Exact Jaccard self-join of documents' 5-word shingle sets by vertical
partitioning.

The global order of n-grams goes from rare to frequent. An n-gram's rank is
how many standard deviations its cell stands above the mean in a counter table
of fixed size, filled from every document; n-grams of equal rank follow by
hash. Any order that all documents share is valid; this one keeps passages
that many documents hold out of the prefixes.

1. One pass over all texts gives each set's size, fingerprint and parity
   bitmap, and the counters. Equal sets become one class.
2. Two sets with Jaccard >= t share an n-gram among the first
   ``n - ceil(t * n) + 1`` of the larger (probe prefix) and the first
   ``n - ceil(2 t / (1 + t) * n) + 1`` of the smaller (index prefix): prefixes
   meet by n-gram (``blocking``), which gives candidate pairs of classes. Where
   they meet first, neither may have fewer n-grams left than the overlap needs.
3. A pair's parity bitmaps bound its symmetric difference from below; pairs
   beyond what the threshold allows drop out.
4. The global order is cut into fragments. The sets of the remaining classes
   are cut the same way, overlaps are counted per pair and fragment, and
   summed per pair; the sum decides exactly.

Components of the links are found in Spark; classes are expanded only into
their own documents.

Edge cases: null or empty texts have no n-gram and are linked with nothing;
with fewer than five words the whole sequence is the one n-gram; a null id
takes part but never names a component (a component without ids is null);
rows of equal ids are separate rows with the same set or not; an empty table
gives an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator
from fractions import Fraction

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from blotter.llm.blocking import linked_components, shared_buckets
from blotter.llm.decontamination import _possible, bloom_filter
from blotter.llm.frames import doc_texts, stored
from blotter.llm.textbatch import mix, split_words, text_slices

WORDS = 5
THRESHOLD = Fraction(80, 100)
CELLS = 1 << 22
PIECE = 1 << 16
RANKS = 32
CELL_SHIFT = np.uint64(42)
FRAGMENTS = 4


def shingle_sets(column: pa.Array) -> Iterator[tuple[int, np.ndarray]]:
    """(row, sorted distinct shingle hashes) of every text with a word."""
    for a, _, data, offsets in text_slices(column):
        words = split_words(data, offsets, lower=True)
        hashes, bounds = words.windows(WORDS)
        sizes = np.diff(words.first)
        for d in np.flatnonzero(sizes).tolist():
            if sizes[d] >= WORDS:
                yield a + d, np.unique(hashes[bounds[d] : bounds[d + 1]])
            else:
                whole = words.hashes[words.first[d] : words.first[d + 1]]
                acc = np.uint64(len(whole))
                with np.errstate(over="ignore"):
                    for w in whole:
                        acc = acc * np.uint64(0xC2B2AE3D27D4EB4F) + w
                yield a + d, mix(np.array([acc], np.uint64))


def fingerprint(s: np.ndarray) -> int:
    """64-bit value of a set of hashes and its size, free of their order."""
    with np.errstate(over="ignore"):
        total = np.add.reduce(mix(s ^ np.uint64(0x5851F42D4C957F2D))) + np.uint64(len(s))
    return int(mix(np.array([total], np.uint64)).view(np.int64)[0])


def parity_bits(n: int) -> int:
    """Width of the bitmap of a set of n: a power of two from 64 up to about n."""
    return 1 << max(6, min(20, (max(n, 1) - 1).bit_length()))


def parity_bitmap(s: np.ndarray) -> bytes:
    """Bit i is the parity of the number of members that fall on i."""
    bits = parity_bits(len(s))
    count = np.bincount((s >> np.uint64(20)).astype(np.int64) & (bits - 1), minlength=bits)
    return np.packbits((count & 1).astype(np.uint8), bitorder="little").tobytes()


def least_difference(a: bytes, b: bytes) -> int:
    """Lower bound of the symmetric difference of two sets, from bitmaps: the
    wider one is folded to the width of the other first."""
    x, y = np.frombuffer(a, np.uint64), np.frombuffer(b, np.uint64)
    n = min(len(x), len(y))
    x = np.bitwise_xor.reduce(x.reshape(-1, n), 0)
    y = np.bitwise_xor.reduce(y.reshape(-1, n), 0)
    return int(np.bitwise_count(x ^ y).sum())


def _measure(docs: DataFrame) -> DataFrame:
    """Rows of kind 0, a document's (doc_id, n, c, bitmap), and of kind 1, a
    task's counters in pieces (n is the piece, bitmap its compressed int32
    counts)."""
    names = ["kind", "doc_id", "n", "c", "bitmap"]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        cells = np.zeros(CELLS, np.int64)
        for batch in batches:
            n, c, bits = [0] * batch.num_rows, [0] * batch.num_rows, [b""] * batch.num_rows
            held: list[np.ndarray] = []
            pending = 0
            for row, s in shingle_sets(batch.column(1)):
                n[row], c[row], bits[row] = len(s), fingerprint(s), parity_bitmap(s)
                held.append(s)
                pending += len(s)
                if pending > 1 << 20:
                    cells += np.bincount((np.concatenate(held) >> CELL_SHIFT).astype(np.int64), minlength=CELLS)
                    held, pending = [], 0
            if held:
                cells += np.bincount((np.concatenate(held) >> CELL_SHIFT).astype(np.int64), minlength=CELLS)
            kind = pa.array(np.zeros(batch.num_rows, np.int32))
            yield pa.RecordBatch.from_arrays([kind, batch.column(0), pa.array(n, pa.int64()), pa.array(c, pa.int64()), pa.array(bits, pa.binary())], names=names)
        if cells.any():
            pieces = CELLS // PIECE
            data = [pa.compress(cells[i * PIECE : (i + 1) * PIECE].astype(np.int32).tobytes(), "zstd", asbytes=True) for i in range(pieces)]
            arrays = [pa.array(np.ones(pieces, np.int32)), pa.nulls(pieces, pa.int64()), pa.array(range(pieces), pa.int64()), pa.nulls(pieces, pa.int64()), pa.array(data, pa.binary())]
            yield pa.RecordBatch.from_arrays(arrays, names=names)

    return doc_texts(docs).mapInArrow(run, "kind int, doc_id long, n long, c long, bitmap binary")


def cell_ranks(measured: DataFrame) -> np.ndarray:
    """The rank of every counter cell, 0 for up to one standard deviation
    above the mean. Counters are added up piece by piece as they stream by;
    the driver gets two numbers and one byte per cell."""

    def add(batches: Iterable[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for piece, data in zip(batch.column("n").to_pylist(), batch.column("bitmap"), strict=True):
                counts = np.frombuffer(pa.decompress(data.as_buffer(), 4 * PIECE, "zstd"), np.int32).astype(np.int64)
                sums[piece] = sums[piece] + counts if piece in sums else counts
        if sums:
            order = sorted(sums)
            totals = [int(sums[p].sum()) for p in order]
            yield pa.RecordBatch.from_arrays([pa.array(order, pa.int64()), pa.array(totals, pa.int64()), pa.array([sums[p].tobytes() for p in order], pa.binary())], names=["piece", "total", "counts"])

    dealt = measured.where("kind = 1").select("n", "bitmap").repartition("n")
    summed = stored(dealt.mapInArrow(add, "piece long, total long, counts binary"), "ngram-cells")
    mean = (summed.agg(F.sum("total")).first()[0] or 0) / CELLS
    step = max(1.0, math.sqrt(mean))

    @F.pandas_udf("binary")
    def ranks(counts: pd.Series) -> pd.Series:
        return pd.Series([np.clip((np.frombuffer(x, np.int64) - mean) // step, 0, RANKS - 1).astype(np.uint8).tobytes() for x in counts])

    out = np.zeros(CELLS, np.uint8)
    for r in summed.select("piece", ranks("counts").alias("ranks")).collect():
        out[r["piece"] * PIECE : (r["piece"] + 1) * PIECE] = np.frombuffer(r["ranks"], np.uint8)
    return out


def _in_order(s: np.ndarray, ranks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A sorted set in the global order, and the ranks of its members there."""
    rank = ranks[(s >> CELL_SHIFT).astype(np.int64)]
    order = np.argsort(rank, kind="stable")
    return s[order], rank[order]


def prefix_rows(docs: DataFrame, ranks: np.ndarray, threshold: Fraction) -> DataFrame:
    """(key, c, n, rest, short): the probe prefix of each class, once per task;
    ``rest`` counts the n-grams from this one on, ``short`` marks the index
    prefix."""
    names = ["key", "c", "n", "rest", "short"]
    num, den = threshold.numerator, threshold.denominator

    def run(batches: Iterable[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in batches:
            keys, cs, ns, index = [], [], [], []
            rows = 0
            for _, s in shingle_sets(batch.column(1)):
                c = fingerprint(s)
                if c in seen:
                    continue
                seen.add(c)
                n = len(s)
                length = n - -(-num * n // den) + 1
                keys.append(_in_order(s, ranks)[0][:length])
                cs.append(c)
                ns.append(n)
                index.append(n - -(-2 * num * n // (num + den)) + 1)
                rows += length
                if rows >= 200_000:
                    yield _rows(keys, cs, ns, index)
                    keys, cs, ns, index, rows = [], [], [], [], 0
            if keys:
                yield _rows(keys, cs, ns, index)

    def _rows(keys: list[np.ndarray], cs: list[int], ns: list[int], index: list[int]) -> pa.RecordBatch:
        counts = np.array([len(k) for k in keys])
        at = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
        n = np.repeat(np.array(ns, np.int32), counts)
        columns = [np.concatenate(keys).view(np.int64), np.repeat(np.array(cs, np.int64), counts), n, (n - at).astype(np.int32), at < np.repeat(index, counts)]
        return pa.RecordBatch.from_arrays([pa.array(x) for x in columns], names=names)

    return doc_texts(docs).mapInArrow(run, "key long, c long, n int, rest int, short boolean")


def fragment_rows(docs: DataFrame, wanted: np.ndarray, ranks: np.ndarray) -> DataFrame:
    """(c, fragment, grams): the sets of the documents whose ids pass the
    Bloom filter ``wanted``, cut at fixed places of the global order."""
    bits = len(wanted) * 8
    # rank 0 is cut by hash into all fragments but the last, which has the rest
    rare_parts = FRAGMENTS - 1
    cuts = np.array([(i << 64) // rare_parts for i in range(1, rare_parts)], np.uint64)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0).fill_null(-1).to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)
            some = _possible(mix(ids), wanted, bits)
            texts = batch.column(1).take(pa.array(some))
            cs, parts, grams, rows = [], [], [], 0
            for _, s in shingle_sets(texts):
                c = fingerprint(s)
                ordered, rank = _in_order(s, ranks)
                rare = int(np.searchsorted(rank, 1))
                ends = [0, *np.searchsorted(ordered[:rare], cuts).tolist(), rare, len(ordered)]
                for f in range(FRAGMENTS):
                    if ends[f + 1] > ends[f]:
                        cs.append(c), parts.append(f), grams.append(ordered[ends[f] : ends[f + 1]].view(np.int64))
                        rows += ends[f + 1] - ends[f]
                if rows > 500_000:
                    yield _out(cs, parts, grams)
                    cs, parts, grams, rows = [], [], [], 0
            if cs:
                yield _out(cs, parts, grams)

    def _out(cs: list, parts: list, grams: list[np.ndarray]) -> pa.RecordBatch:
        offsets = np.concatenate([[0], np.cumsum([len(g) for g in grams])]).astype(np.int32)
        lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(grams)))
        return pa.RecordBatch.from_arrays([pa.array(cs, pa.int64()), pa.array(parts, pa.int32()), lists], names=["c", "fragment", "grams"])

    return doc_texts(docs).mapInArrow(run, "c long, fragment int, grams array<long>")


def ngram_components(docs: DataFrame, threshold: Fraction = THRESHOLD) -> DataFrame:
    """(doc_id, n_shingles, component_id) per document."""
    measured = stored(_measure(docs), "ngram-sets", partition_by="kind")
    ranks = cell_ranks(measured)
    members = measured.where("kind = 0").select("doc_id", "n", "c")
    classes = measured.where("kind = 0 and n > 0").groupBy("c").agg(F.min("doc_id").alias("doc_id"), F.min("n").alias("n"), F.min("bitmap").alias("bitmap"))
    classes = stored(classes, "ngram-classes")
    active = shared_buckets(prefix_rows(docs, ranks, threshold))
    # |x - y| <= (nx + ny) * (1 - t) / (1 + t) and overlap >= (nx + ny) * t / (1 + t)
    num, den = threshold.numerator, threshold.denominator

    @F.pandas_udf("long")
    def bound(x: pd.Series, y: pd.Series) -> pd.Series:
        return pd.Series([least_difference(i, j) for i, j in zip(x, y, strict=True)], dtype="int64")

    def verify(pairs: DataFrame) -> DataFrame:
        left = classes.select(F.col("c").alias("a"), F.col("n").alias("na"), F.col("bitmap").alias("bits_a"), F.col("doc_id").alias("doc_a"))
        right = classes.select(F.col("c").alias("b"), F.col("n").alias("nb"), F.col("bitmap").alias("bits_b"), F.col("doc_id").alias("doc_b"))
        sized = pairs.join(left, "a").join(right, "b")
        near = sized.where(bound("bits_a", "bits_b") * (num + den) <= (F.col("na") + F.col("nb")) * (den - num))
        near = stored(near.select("a", "b", "na", "nb", "doc_a", "doc_b"), "ngram-near")
        if near.isEmpty():
            return near.select("a", "b")
        ids = near.select(F.explode(F.array("doc_a", "doc_b")).alias("id")).distinct()

        @F.pandas_udf("long")
        def spread(ids: pd.Series) -> pd.Series:
            return pd.Series(mix(ids.fillna(-1).to_numpy(np.int64).view(np.uint64)).view(np.int64))

        wanted = bloom_filter(ids.select(spread(F.coalesce("id", F.lit(-1))).alias("hash")))
        parts = stored(fragment_rows(docs, wanted, ranks), "ngram-fragments").dropDuplicates(["c", "fragment"])
        own = near.join(parts.select(F.col("c").alias("a"), "fragment", F.col("grams").alias("grams_a")), "a")
        met = own.join(parts.select(F.col("c").alias("b"), "fragment", F.col("grams").alias("grams_b")), ["b", "fragment"])
        partial = met.select("a", "b", "na", "nb", F.size(F.array_intersect("grams_a", "grams_b")).alias("overlap"))
        summed = partial.groupBy("a", "b", "na", "nb").agg(F.sum("overlap").alias("overlap"))
        return summed.where(F.col("overlap") * den >= (F.col("na") + F.col("nb") - F.col("overlap")) * num).select("a", "b")

    _, roots = linked_components(active, float(threshold), verify)
    named = members.where("n > 0").join(roots, "c", "left").select("doc_id", "n", F.coalesce("root", "c").alias("root"))
    named = stored(named, "ngram-roots")
    smallest = named.groupBy("root").agg(F.min("doc_id").alias("component_id"))
    linked = named.join(smallest, "root").select("doc_id", F.col("n").alias("n_shingles"), "component_id")
    return linked.unionByName(members.where("n = 0").select("doc_id", F.col("n").alias("n_shingles"), F.col("doc_id").alias("component_id")))


def keep_one_per_component(docs: DataFrame, threshold: Fraction = THRESHOLD) -> DataFrame:
    """``docs``, all columns, with one document of each component: that of
    the smallest id, nulls last, then of the smallest text hash. Id and text
    together are the document: rows that repeat both stay or go together, and
    a text is never dropped for another one of its id."""
    # every (id, text) gets a number of its own, so that the join tells apart
    # the texts of one id and the rows without one
    keyed = docs.select(F.col("doc_id").cast("long").alias("id"), F.xxhash64(F.col("text").cast("string")).alias("h"), F.col("text").cast("string").alias("text"))
    number = F.xxhash64("id", "h")
    found = ngram_components(keyed.select(number.alias("doc_id"), "text"), threshold).where("n_shingles > 0")
    names = keyed.select(number.alias("doc_id"), "id", "h").distinct()
    linked = stored(found.select("doc_id", "component_id").distinct().join(names, "doc_id"), "ngram-linked")
    order = F.struct(F.col("id").isNull(), "id", "h")
    # only components of two texts or more travel on
    stays = linked.groupBy("component_id").agg(F.min(order).alias("first"), F.max(order).alias("top")).where("first <> top")
    gone = linked.join(stays, "component_id").where(order != F.col("first")).select(F.struct("id", "h").alias("gone"))
    own = F.struct(*(docs[c] for c in docs.columns)).alias("own")
    mark = F.struct(docs["doc_id"].cast("long").alias("id"), F.xxhash64(docs["text"].cast("string")).alias("h")).alias("mark")
    left = docs.select(own, mark).join(stored(gone, "ngram-drop"), F.col("mark").eqNullSafe(F.col("gone")), "left_anti")
    return left.select(*(F.col("own").getField(c).alias(c) for c in docs.columns))
