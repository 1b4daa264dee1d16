"""Substring dedup: MinHash banding of paragraphs inside texts.

Copied passages often sit in the middle of a line, so line ends do not bound
them. A paragraph here is a run of ``PARAGRAPH`` words from an anchor: a word
where the hash of three words is the smallest within ``REACH`` words on both
sides, or a text's first word. Where the next one is further than a paragraph,
further anchors follow at its width, and a text's last ``MIN_WORDS`` words are a
paragraph if no other ends there, so every word of a text that is long enough
lies in one. Anchors depend on the words around them only, so the same passage
has the same paragraphs wherever it stands, and one of over 50 words holds one
or more whole paragraphs.

Paragraphs with equal sets of 5-word shingles are one class. Each class has a
MinHash signature, cut into bands whose number and width follow from the
wanted recall at the threshold (``tune_bands``). The bands meet as packed arrays in
buckets, which are ranges of keys; only those whose key another class has become
rows. Classes that collide in a
band are verified by exact Jaccard (``blocking`` tests them against hubs, so a
band that thousands share is never expanded into all pairs). Classes of a large
bucket that hubs leave apart meet again by the shingles of their prefixes, rare ones
first: thousands of paragraphs around one common line share a band, but no rare
shingle. Paragraphs whose
classes are connected by verified links form a cluster; all but the first
(smallest doc_id, then position) are removed.

Edge cases: null and short texts (under ``MIN_WORDS`` words) have no
paragraph; rows with a null id have no place in the order and are not reported;
rows of equal id and text are one document; ties break by position; an empty
table gives an empty result; long texts are cut whole.
"""

from __future__ import annotations

import math
import re
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from blotter.llm.blocking import linked_components, prefix_keys
from blotter.llm.decontamination import _possible, bloom_filter
from blotter.llm.frames import doc_texts, stored
from blotter.llm.textbatch import Words, mix, packed, release_memory, split_words, text_slices, unpacked

SHINGLE = 5
PARAGRAPH = 25
MIN_WORDS = 16
REACH = 5
THRESHOLD = 0.8
KEY_BITS = 44  # of a band's key; two keys that fall together cost a test, no link
BLOCK_CLASSES = 100_000
BUCKET_ROWS = 1_000_000
MAX_BUCKETS = 1 << 18
CELL_BITS = 20  # of the counters that order shingles
PIECE = 1 << 14  # counter cells that travel in one row


def tune_bands(threshold: float, recall: float, collide_at: float = 0.1, most: float = 0.1) -> tuple[int, int]:
    """(bands, rows): the fewest bands that reach ``recall`` at the threshold
    while pairs of similarity ``collide_at`` collide with at most ``most``."""
    options = []
    for rows in range(1, 9):
        bands = int(np.ceil(np.log(1 - recall) / np.log(1 - threshold**rows)))
        if 1 - (1 - collide_at**rows) ** bands <= most:
            options.append((bands, rows))
    return min(options)


def anchors(words: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(document, first word, end word) of every paragraph, as positions in
    ``words.hashes``."""
    h, doc = words.hashes, words.documents()
    if not len(h):
        return (np.zeros(0, np.int64),) * 3
    value = h.copy()
    for k in (1, 2):
        same = doc[k:] == doc[:-k]
        value[:-k] = value[:-k] * np.uint64(0x9FB21C651E98DF25) + np.where(same, h[k:], np.uint64(k))
    value = mix(value)
    lowest = np.ones(len(h), bool)
    for k in range(1, REACH + 1):
        apart = doc[k:] != doc[:-k]
        lowest[:-k] &= apart | (value[:-k] <= value[k:])
        lowest[k:] &= apart | (value[k:] < value[:-k])
    # a text's first word; if an anchor follows so closely that the two
    # paragraphs would be near copies, the first is short, or the only one
    starts, ends = words.first[:-1], words.first[1:]
    close = np.zeros(len(h), bool)
    for k in range(1, REACH + 1):
        close[:-k] |= lowest[k:] & (doc[k:] == doc[:-k])
    offset = np.arange(len(h)) - starts[doc]
    lowest &= (offset > REACH) | ((ends - starts)[doc] > PARAGRAPH)
    lowest[starts[starts < ends]] = True
    short = close & (offset == 0) & ((ends - starts)[doc] > PARAGRAPH)
    at = np.flatnonzero(lowest)
    # no gap between anchors is wider than a paragraph, none narrower than REACH
    upto = np.minimum(np.append(at[1:], len(h)), ends[doc[at]])
    gap = upto - at
    parts = (gap - 1) // PARAGRAPH + 1
    step = np.arange(parts.sum()) - np.repeat(np.cumsum(parts) - parts, parts)
    at = np.repeat(at, parts)
    at = np.where(step > 0, np.minimum(at + step * PARAGRAPH, np.repeat(upto, parts) - REACH - 1), at)
    end = np.minimum(at + np.where(short[at], MIN_WORDS, PARAGRAPH), ends[doc[at]])
    keep = end - at >= MIN_WORDS
    at, end = at[keep], end[keep]
    covered = starts.copy()
    np.maximum.at(covered, doc[at], end)
    last = ends[(covered < ends) & (ends - starts >= MIN_WORDS)]
    at, end = np.concatenate([at, last - MIN_WORDS]), np.concatenate([end, last])
    order = np.argsort(at, kind="stable")
    at, end = at[order], end[order]
    return doc[at], at, end


def paragraphs(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Per slice: (row, first word, end word, class, shingles, valid) of the
    paragraphs; shingles are sorted in rows, valid marks distinct ones."""
    for a, _, data, offsets in text_slices(column):
        words = split_words(data, offsets, lower=True)
        doc, at, end = anchors(words)
        if not len(at):
            continue
        h = words.hashes
        m = len(h) - SHINGLE + 1
        shingle = h[:m].copy()
        for k in range(1, SHINGLE):
            shingle *= np.uint64(0xD6E8FEB86659FD93)
            shingle += h[k : k + m]
        shingle = mix(shingle)
        wide = PARAGRAPH - SHINGLE + 1
        spots = at[:, None] + np.arange(wide)
        inside = spots < (end - SHINGLE + 1)[:, None]
        rows = np.where(inside, shingle[np.minimum(spots, m - 1)], np.uint64(0xFFFFFFFFFFFFFFFF))
        rows.sort(axis=1)
        valid = np.ones(rows.shape, bool)
        valid[:, 1:] = rows[:, 1:] != rows[:, :-1]
        valid &= rows != np.uint64(0xFFFFFFFFFFFFFFFF)
        n = valid.sum(1).astype(np.uint64)
        c = mix(np.where(valid, mix(rows ^ np.uint64(0x5851F42D4C957F2D)), np.uint64(0)).sum(1, dtype=np.uint64) + n)
        first = words.first[doc]
        yield a + doc, at - first, end - first, c.view(np.int64), rows, valid


def occurrences(docs: DataFrame) -> DataFrame:
    """(c, doc_id, first_word, end_word) of every paragraph."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        for batch in batches:
            for row, first, end, c, _, _ in paragraphs(batch.column(1)):
                ids = batch.column(0).take(pa.array(row))
                yield pa.RecordBatch.from_arrays([pa.array(c), ids, pa.array(first.astype(np.int32)), pa.array(end.astype(np.int32))], names=["c", "doc_id", "first_word", "end_word"])

    return doc_texts(docs).where("doc_id is not null").mapInArrow(run, "c long, doc_id long, first_word int, end_word int")


def band_blocks(docs: DataFrame, bands: int, rows: int, seed: int, buckets: int) -> DataFrame:
    """One row per bucket and block of texts: the bands of each class, once per
    block, by rising key of KEY_BITS bits (as differences), with the class's
    number of shingles and their 32-bit parity bitmap. Buckets are ranges of keys;
    arrays are ``packed``."""
    salts = np.random.default_rng(seed).integers(1, 2**63, bands * rows, dtype=np.uint64)

    def bands_of(c: np.ndarray, grams: np.ndarray, valid: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        top = np.uint64(0xFFFFFFFFFFFFFFFF)
        c, one = np.unique(c, return_index=True)
        grams, valid = grams[one], valid[one]
        bit = np.where(valid, np.uint32(1) << (grams >> np.uint64(59)).astype(np.uint32), np.uint32(0))
        keys = np.empty((len(c), bands), np.uint64)
        for b in range(bands):
            key = np.full(len(c), b + 1, np.uint64)
            for r in range(rows):
                key = mix(key) + np.where(valid, mix(grams ^ salts[b * rows + r]), top).min(1)
            keys[:, b] = mix(key) >> np.uint64(64 - KEY_BITS)
        return c, valid.sum(1).astype(np.uint8), np.bitwise_xor.reduce(bit, axis=1).view(np.int32), keys

    def block(parts: list[tuple[np.ndarray, ...]]) -> pa.RecordBatch:
        c, n, sig, keys = (np.concatenate(x) for x in zip(*parts, strict=True))
        c, one = np.unique(c, return_index=True)
        n, sig, key = n[one], sig[one], keys[one].ravel()
        order = np.argsort(key)
        key, at = key[order], order // bands
        bucket = (key * np.uint64(buckets)) >> np.uint64(KEY_BITS)
        starts = np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1]]))
        made: list[list] = [[], [], [], [], []]
        for s, e in zip(starts, np.append(starts[1:], len(key)), strict=True):
            some = at[s:e]
            for x, v in zip(made, (int(bucket[s]), packed(np.diff(key[s:e], prepend=np.uint64(0))), packed(c[some]), packed(n[some]), packed(sig[some])), strict=True):
                x.append(v)
        return pa.RecordBatch.from_arrays([pa.array(made[0], pa.int32()), *(pa.array(x, pa.binary()) for x in made[1:])], names=["bucket", "key", "c", "n", "sig"])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        parts, held = [], 0
        for batch in batches:
            for _, _, _, c, grams, valid in paragraphs(batch.column(1)):
                parts.append(bands_of(c, grams, valid))
                held += len(parts[-1][0])
                if held >= BLOCK_CLASSES:
                    yield block(parts)
                    parts, held = [], 0
                    release_memory()
        if parts:
            yield block(parts)
        del parts
        release_memory()

    return doc_texts(docs).where("doc_id is not null").mapInArrow(run, "bucket int, key binary, c binary, n binary, sig binary")


def shared_bands(blocks: DataFrame) -> DataFrame:
    """(key, c, n, sig, size, h_c, ..., g_c, ...) of the keys that two or more
    classes share, as ``blocking.shared_buckets`` gives them: the band rows meet
    packed, and those whose key no other class has never leave their bucket."""
    schema = "key long, c long, n int, sig int, size long, h_c long, h_n int, h_sig int, g_c long, g_n int, g_sig int"

    def run(table: pa.Table) -> pa.Table:
        made = shared(table)
        release_memory()
        return made

    def shared(table: pa.Table) -> pa.Table:
        def column(name: str, kind: type) -> list[np.ndarray]:
            return [unpacked(x.as_buffer(), kind) for x in table.column(name)]

        key = np.concatenate([np.cumsum(x) for x in column("key", np.uint64)])
        c = np.concatenate(column("c", np.int64))
        order = np.lexsort((c, key))
        key, c = key[order], c[order]
        new = np.concatenate([[True], key[1:] != key[:-1]])
        one = np.flatnonzero(new | np.concatenate([[True], c[1:] != c[:-1]]))  # a class is once in a key
        new = new[one]
        size = np.diff(np.append(np.flatnonzero(new), len(one)))
        size = np.repeat(size, size)
        kept = one[size > 1]
        begins, size = new[size > 1], size[size > 1]
        key, c, order = key[kept], c[kept], order[kept]
        n, sig = np.concatenate(column("n", np.uint8))[order].astype(np.int32), np.concatenate(column("sig", np.int32))[order]
        group = np.cumsum(begins) - 1
        columns = {"key": key.view(np.int64), "c": c, "n": n, "sig": sig, "size": size.astype(np.int64)}
        for h, drawn in (("h", mix(key ^ mix(c.view(np.uint64)))), ("g", mix(~key ^ mix(c.view(np.uint64))))):
            hub = np.lexsort((drawn, group))[begins][group]
            columns |= {f"{h}_c": c[hub], f"{h}_n": n[hub], f"{h}_sig": sig[hub]}
        return pa.table(columns)

    return stored(blocks.groupBy("bucket").applyInArrow(run, schema), "buckets")


def class_sets(docs: DataFrame, wanted: np.ndarray) -> DataFrame:
    """(c, grams) of the classes that pass the Bloom filter ``wanted``."""
    bits = len(wanted) * 8

    def run(batches: Iterable[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        for batch in batches:
            for _, _, _, c, grams, valid in paragraphs(batch.column(1)):
                c, one = np.unique(c, return_index=True)
                some = _possible(mix(c.view(np.uint64)), wanted, bits)
                if len(some):
                    kept, ok = grams[one[some]], valid[one[some]]
                    offsets = np.concatenate([[0], np.cumsum(ok.sum(1))]).astype(np.int32)
                    lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(kept[ok].view(np.int64)))
                    yield pa.RecordBatch.from_arrays([pa.array(c[some]), lists], names=["c", "grams"])
            del batch
            release_memory()

    return doc_texts(docs).where("doc_id is not null").mapInArrow(run, "c long, grams array<long>")


def cell_counts(sets: DataFrame) -> DataFrame:
    """(piece, counts): how many shingles of ``sets`` fall on each counter cell, in
    pieces of ``PIECE`` cells. A task counts all its sets first, so it makes a row
    per piece that has any, however many shingles it reads."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        cells = np.zeros(1 << CELL_BITS, np.int64)
        for batch in batches:
            gram = batch.column(0).flatten().to_numpy(zero_copy_only=False).view(np.uint64)
            np.add.at(cells, gram >> np.uint64(64 - CELL_BITS), 1)
        pieces = cells.reshape(-1, PIECE)
        some = np.flatnonzero(pieces.any(1))
        yield pa.RecordBatch.from_arrays([pa.array(some.astype(np.int32)), pa.array([packed(x) for x in pieces[some]], pa.binary())], names=["piece", "counts"])

    return sets.select("grams").mapInArrow(run, "piece int, counts binary")


def shingle_ranks(sets: DataFrame) -> np.ndarray:
    """The rank of every counter cell, by the logarithm of how many shingles of
    ``sets`` fall on it. The pieces of the tasks are added up as they stream by; the
    driver gets a number per piece and a byte per cell."""

    def add(batches: Iterable[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for piece, data in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                sums[piece] = sums.get(piece, 0) + unpacked(data.as_buffer(), np.int64)
        made = [np.minimum(np.round(np.log2(np.maximum(x, 1)) * 3), 127).astype(np.uint8).tobytes() for x in sums.values()]
        yield pa.RecordBatch.from_arrays([pa.array(list(sums), pa.int32()), pa.array(made, pa.binary())], names=["piece", "ranks"])

    seen = cell_counts(sets).repartition("piece").mapInArrow(add, "piece int, ranks binary").toArrow()
    out = np.zeros(1 << CELL_BITS, np.uint8)
    for piece, ranks in zip(seen["piece"].to_pylist(), seen["ranks"], strict=True):
        out[piece * PIECE : (piece + 1) * PIECE] = np.frombuffer(ranks.as_buffer(), np.uint8)
    return out


def prefix_rows(rows: DataFrame, sets: DataFrame, threshold: float) -> DataFrame:
    """(key, c, n, sig, rest, short): for every row (key, c, n, sig) of a bucket,
    one for each shingle in the prefix of its set in ``sets``, rare ones first; the
    key is of the bucket and the shingle."""
    ranks = shingle_ranks(sets.join(rows.select("c").distinct(), "c", "left_semi"))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(1)
            gram, counts = lists.flatten().to_numpy(zero_copy_only=False).view(np.uint64), lists.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
            order = np.lexsort((gram, ranks[gram >> np.uint64(64 - CELL_BITS)], np.repeat(np.arange(len(counts)), counts)))
            own, rest, short = prefix_keys(counts, threshold)
            first = np.cumsum(counts) - counts
            gram = gram[order][first[own] + counts[own] - rest]
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(own)), pa.array(gram.view(np.int64)), pa.array(rest.astype(np.int32)), pa.array(short)], names=["c", "gram", "rest", "short"])

    prefixes = sets.mapInArrow(run, "c long, gram long, rest int, short boolean")
    return rows.join(prefixes, "c").select(F.xxhash64("key", "gram").alias("key"), "c", "n", "sig", "rest", "short")


def _mixed(ids: DataFrame) -> DataFrame:
    """(hash): the finaliser of each id, as the filters look it up."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        for batch in batches:
            h = mix(batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64))
            yield pa.RecordBatch.from_arrays([pa.array(h.view(np.int64))], names=["hash"])

    return ids.mapInArrow(run, "hash long")


def repeated_paragraphs(docs: DataFrame, threshold: float = THRESHOLD, recall: float = 0.995, seed: int = 41) -> DataFrame:
    """(doc_id, first_word, end_word, original_doc_id, original_word, removed)
    of every paragraph in a cluster of two or more places; the original is the
    cluster's first. Texts without repeated paragraphs have no row."""
    bands, rows = tune_bands(threshold, recall)
    placed = stored(occurrences(docs), "paragraphs")
    buckets = max(4, min(MAX_BUCKETS, math.ceil(placed.count() * bands / BUCKET_ROWS)))
    active = shared_bands(band_blocks(docs, bands, rows, seed, buckets))

    def sets_of(members: DataFrame) -> DataFrame:
        wanted = bloom_filter(_mixed(members.distinct()), 1 << 27)
        return stored(class_sets(docs, wanted).dropDuplicates(["c"]), "paragraph-sets")

    def linked(pairs: DataFrame, sets: DataFrame) -> DataFrame:
        both = pairs.join(sets.toDF("a", "ga"), "a").join(sets.toDF("b", "gb"), "b")
        sized = both.select("a", "b", F.size(F.array_intersect("ga", "gb")).alias("same"), (F.size("ga") + F.size("gb")).alias("total"))
        return sized.where(F.col("same") >= (F.col("total") - F.col("same")) * threshold - 1e-9).select("a", "b")

    def ends(pairs: DataFrame) -> DataFrame:
        return pairs.select(F.explode(F.array("a", "b")).alias("c"))

    def verify(pairs: DataFrame) -> DataFrame:
        return pairs if pairs.isEmpty() else linked(pairs, sets_of(ends(pairs)))

    def finer(pairs: DataFrame, rows: DataFrame) -> tuple[DataFrame, Callable[[DataFrame], DataFrame]]:
        sets = sets_of(ends(pairs).unionByName(rows.select("c")))
        return prefix_rows(rows, sets, threshold), lambda some: linked(some, sets)

    _, roots = linked_components(active, threshold, verify, finer)
    copies = placed.groupBy("c").agg(F.count("*").alias("k")).where("k > 1").select("c")
    joint = roots.unionByName(copies.select("c", F.col("c").alias("root"))).groupBy("c").agg(F.min("root").alias("root"))
    clustered = stored(placed.join(joint, "c").select("root", "doc_id", "first_word", "end_word").distinct(), "clusters")
    place = F.struct("doc_id", "first_word")
    firsts = clustered.groupBy("root").agg(F.min(place).alias("o"), F.max(place).alias("z")).where("o <> z").select("root", "o")
    return clustered.join(firsts, "root").select(
        "doc_id",
        "first_word",
        "end_word",
        F.col("o.doc_id").alias("original_doc_id"),
        F.col("o.first_word").alias("original_word"),
        (place != F.col("o")).alias("removed"),
    )


def remove_paragraphs(docs: DataFrame, found: DataFrame) -> DataFrame:
    """``docs``, all columns, with the removed paragraphs of ``found`` cut out
    of ``text``; what is left keeps its own blanks."""
    word = re.compile(r"[^\x20\x09-\x0D]+")

    @F.pandas_udf("string")
    def cut(text: pd.Series, spans: pd.Series) -> pd.Series:
        out = []
        for t, s in zip(text, spans, strict=True):
            if t is None or s is None:
                out.append(t)
                continue
            at = [m.span() for m in word.finditer(t)]
            parts, upto = [], 0
            for first, end in sorted((x["first_word"], x["end_word"]) for x in s):
                begin = at[first][0] if first < len(at) else len(t)
                if begin > upto:
                    parts.append(t[upto:begin])
                upto = max(upto, at[min(end, len(at)) - 1][1])
            out.append("".join([*parts, t[upto:]]))
        return pd.Series(out)

    spans = found.where("removed").groupBy(F.col("doc_id").alias("cut_id")).agg(F.collect_set(F.struct("first_word", "end_word")).alias("cuts"))
    own = F.struct(*(docs[c] for c in docs.columns)).alias("own")
    rows = docs.select(own, docs["doc_id"].alias("own_id")).join(spans, F.col("own_id") == F.col("cut_id"), "left")
    text = cut(F.col("own.text"), F.col("cuts"))
    return rows.select(*(text.alias("text") if c == "text" else F.col("own").getField(c).alias(c) for c in docs.columns))
