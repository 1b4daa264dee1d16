"""Benchmark decontamination by spaced-seed hashing.

A fixed mask reads some positions of a run of words and ignores the others,
so a substituted word at an ignored position does not change the hash. The
two masks below were chosen so that every stretch of ``STRETCH`` words with up
to ``SUBSTITUTIONS`` substitutions is hit by at least one of them: no such
overlap is missed. Words are lower-cased (A-Z).

Every window of every item is hashed under both masks; so is every window of
every training text, in one pass. A Bloom filter of the item hashes, of fixed
size whatever the benchmark's, drops nearly all training windows in that pass;
those that remain are joined to the item hashes, and each hit names an item
and an alignment (text position minus item position). Around each the words
are compared: a document is contaminated by an item if some aligned stretch
of ``STRETCH`` item words has at most ``SUBSTITUTIONS`` different ones. Items
of 5 to ``STRETCH`` - 1 words must occur whole and unchanged (found by their
first five words); shorter ones are no evidence and are not searched.

Edge cases: null and empty texts are clean, null items are ignored; equal
items are each reported; rows of equal id and text are one document, rows with
a null id one for each text; an empty benchmark finds nothing; long texts are
searched whole.
"""

from __future__ import annotations

from collections.abc import Iterable

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from blotter.llm.frames import doc_texts, stored
from blotter.llm.textbatch import Words, mix, split_words, text_slices

STRETCH, SUBSTITUTIONS = 13, 2
MASKS = ("11101011", "110100111")
SHORT_MASK = "11111"
BLOOM_BITS = 1 << 24
_PROBES = (0, 20, 40)


def masked_hashes(words: Words, mask: str, salt: int) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, positions in ``words.hashes``) of the mask's windows that lie
    within one document."""
    h, first = words.hashes, words.first
    n = len(mask)
    m = len(h) - n + 1
    if m <= 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    out = np.full(m, salt + 1, np.uint64)
    for k, c in enumerate(mask):
        if c == "1":
            out *= np.uint64(0xD6E8FEB86659FD93)
            out += h[k : k + m]
    keep = np.ones(m, bool)
    for k in range(1, n):
        last = first[1:] - k
        last = last[(last >= first[:-1]) & (last < m)]
        keep[last] = False
    at = np.flatnonzero(keep)
    return mix(out[at]), at


def item_hashes(benchmark: DataFrame) -> DataFrame:
    """(hash, item_key, item_pos) of every item's windows; items by the pair
    (item_id, text), so that repeated ids do no harm."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        for batch in batches:
            for a, _, data, offsets in text_slices(batch.column(1)):
                words = split_words(data, offsets, lower=True)
                sizes = np.diff(words.first)
                for salt, mask in enumerate((*MASKS, SHORT_MASK)):
                    h, at = masked_hashes(words, mask, salt)
                    doc = np.searchsorted(words.first, at, "right") - 1
                    pos = at - words.first[doc]
                    wanted = (sizes[doc] < STRETCH) & (pos == 0) if mask == SHORT_MASK else sizes[doc] >= STRETCH
                    keys = batch.column(0).to_numpy(zero_copy_only=False)[a + doc[wanted]]
                    yield pa.RecordBatch.from_arrays([pa.array(h[wanted].view(np.int64)), pa.array(keys, pa.int64()), pa.array(pos[wanted])], names=["hash", "item_key", "item_pos"])

    return benchmark.select("item_key", "item_text").mapInArrow(run, "hash long, item_key long, item_pos long")


def bloom_filter(hashes: DataFrame, bits: int = BLOOM_BITS) -> np.ndarray:
    """Bit array of ``bits`` bits, three per hash: what reaches the driver is
    bits / 8 bytes at most."""
    spots = F.array(*(F.shiftrightunsigned("hash", s).bitwiseAND(F.lit(bits - 1)) + 1 for s in _PROBES))
    pieces = (
        hashes.select(F.explode(spots).alias("spot"))
        .groupBy(F.bitmap_bucket_number("spot").alias("piece"))
        .agg(F.bitmap_construct_agg(F.bitmap_bit_position("spot")).alias("bitmap"))
        .collect()
    )
    out = np.zeros(bits // 8, np.uint8)
    for r in pieces:
        at = (r["piece"] - 1) * 4096
        out[at : at + 4096] = np.frombuffer(r["bitmap"], np.uint8)[: len(out) - at]
    return out


def _possible(h: np.ndarray, bloom: np.ndarray, bits: int) -> np.ndarray:
    left = np.arange(len(h))
    for s in _PROBES:
        spot = (h[left] >> np.uint64(s)) & np.uint64(bits - 1)
        left = left[(bloom[spot >> np.uint64(3)] >> (spot & np.uint64(7)).astype(np.uint8)) & 1 == 1]
    return left


def filtered_texts(docs: DataFrame, bloom: np.ndarray) -> DataFrame:
    """(doc_id, text, hits) of the documents with a window that may be an
    item's: one pass over all texts, no shuffle."""
    bits = len(bloom) * 8

    def run(batches: Iterable[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        hit_type = pa.list_(pa.struct([("hash", pa.int64()), ("pos", pa.int64())]))
        for batch in batches:
            for a, b, data, offsets in text_slices(batch.column(1)):
                words = split_words(data, offsets, lower=True)
                found: dict[int, list[dict]] = {}
                for salt, mask in enumerate((*MASKS, SHORT_MASK)):
                    h, at = masked_hashes(words, mask, salt)
                    some = _possible(h, bloom, bits)
                    doc = np.searchsorted(words.first, at[some], "right") - 1
                    for d, x, p in zip(doc.tolist(), h[some].view(np.int64).tolist(), (at[some] - words.first[doc]).tolist(), strict=True):
                        found.setdefault(d, []).append({"hash": x, "pos": p})
                if found:
                    rows = pa.array(sorted(found), pa.int64())
                    part = batch.slice(a, b - a).take(rows)
                    hits = pa.array([found[d] for d in sorted(found)], hit_type)
                    yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), hits], names=["doc_id", "text", "hits"])

    return doc_texts(docs).mapInArrow(run, "doc_id long, text string, hits array<struct<hash: long, pos: long>>")


def equal_words(text: bytes, item: bytes, shift: int) -> int:
    """Most equal words of an aligned stretch, 0 where it does not reach the
    rule. Item word i stands against text word i + shift."""
    words, own = text.lower().split(), item.lower().split()
    same = [0 <= i + shift < len(words) and words[i + shift] == w for i, w in enumerate(own)]
    size = min(STRETCH, len(own))
    least = size - (SUBSTITUTIONS if len(own) >= STRETCH else 0)
    best = max((sum(same[i : i + size]) for i in range(len(own) - size + 1)), default=0)
    return sum(same) if best >= least else 0


@F.pandas_udf(LongType())
def _equal_words(text: pd.Series, item: pd.Series, shift: pd.Series) -> pd.Series:
    return pd.Series([equal_words(t.encode(), i.encode(), int(s)) for t, i, s in zip(text, item, shift, strict=True)], dtype="int64")


def find_contamination(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """(doc_id, text_hash, item_id, places, equal_words): one row for each
    contaminated document and item that it contains, with the number of
    alignments and the most equal words of one. Clean documents have none."""
    items = (
        benchmark.where("text is not null")
        .select(F.col("item_id").alias("item_id"), F.col("text").cast("string").alias("item_text"))
        .withColumn("item_key", F.xxhash64("item_id", "item_text"))
        .dropDuplicates(["item_key"])
    )
    hashes = stored(item_hashes(items), "seed-items")
    texts = stored(filtered_texts(docs, bloom_filter(hashes)).withColumn("text_hash", F.xxhash64("text")), "seed-texts")
    hits = texts.select("doc_id", "text_hash", F.explode("hits").alias("hit")).select("doc_id", "text_hash", "hit.hash", "hit.pos")
    aligned = hits.join(hashes, "hash").select(
        F.col("doc_id").alias("id"), F.col("text_hash").alias("th"), "item_key", (F.col("pos") - F.col("item_pos")).alias("shift")
    )
    places = aligned.distinct().join(items, "item_key")
    whole = texts.select("doc_id", "text_hash", "text").dropDuplicates(["doc_id", "text_hash"])
    checked = places.join(whole, F.col("id").eqNullSafe(F.col("doc_id")) & (F.col("th") == F.col("text_hash")))
    scored = checked.select("doc_id", "text_hash", "item_id", _equal_words("text", "item_text", "shift").alias("equal"))
    return scored.where("equal > 0").groupBy("doc_id", "text_hash", "item_id").agg(F.count("*").alias("places"), F.max("equal").alias("equal_words"))


def decontaminate(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``docs``, all columns, without the contaminated documents."""
    bad = stored(find_contamination(docs, benchmark).select(F.col("doc_id").alias("bad_id"), F.col("text_hash").alias("bad_hash")).distinct(), "seed-bad")
    same = docs["doc_id"].eqNullSafe(bad["bad_id"]) & (F.xxhash64(docs["text"]) == bad["bad_hash"])
    return docs.join(bad, same, "left_anti")
