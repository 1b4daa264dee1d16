"""Katz backoff language model over words: training, tables and scoring.

Tokens are lower-cased words (A-Z only) and one end token per text; the first
token's history is a start mark. With counts c over the training texts,

    P(w | h) = d2(c(h,w)) * c(h,w) / (c(h) + 1)  if c(h,w) > 0
             = a(h) * P(w)                       if h was seen
             = P(w)                              otherwise,
    P(w)     = d1(c(w)) * c(w) / N               if c(w) > 0
             = what the seen words leave         otherwise,

d1 and d2 are Katz's Good-Turing discounts of counts up to 5, and a(h) is the
mass that h's seen followers leave, divided by what those words leave at the
lower order: every distribution sums to one exactly. Discounting leaves nothing
to a history whose followers are all counted more than 5 times, so every history
reserves one more count for unseen words: c(h) + 1 divides.

Tables, in the shared folder: ``unigrams`` (w, c), ``bigrams`` by bucket of
the history, ``histories`` (h, c, alpha). Words are 64-bit hashes.

How it scales: every task sorts its tokens by (history, word) and sends one
block per bucket: distinct pairs with counts, and the documents they occur in.
A bucket's task sums the pairs' counts and scores those documents at once, so
texts are read twice, token rows never exist in the JVM and the model is never
broadcast. What a token adds by its top word alone is summed before the shuffle,
so that a bucket's part of a document is one number, small counts and a few rare
words; blocks and parts travel compressed. Two bounded lists are: the ``TOP_WORDS`` most frequent words, which
lets blocks name them by number (all others travel as hashes and meet the
unigram table in a join), and the at most 4 * buckets hot histories, whose
pairs are dealt by word instead of by history, so a word that makes up a third
of all tokens is spread over all buckets.

Edge cases: null and empty texts are one end token; a null id is in fold 0,
so it trains; repeated rows count as often as they occur; without training
texts every word is unknown, P of it is 1 and all scores are 0, and the base
is log10(1 / 1) = 0; an empty table gives an empty result.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from blotter.llm.frames import doc_texts, stored
from blotter.llm.textbatch import mix, packed, release_memory, split_words, text_slices, unpacked

FOLDS, HELD_OUT_FOLD = 7, 2
KEEP = 5  # counts up to this are discounted
TOP_WORDS = 1 << 19
BLOCK_TOKENS = 250_000
BLOCK_DOCS = 12_000  # with a slice more, numbers of documents need 15 bits
SLICE = 1 << 20
BUCKET_TOKENS = 1_000_000
MAX_BUCKETS = 16_384
END, START = 1, 2  # reserved in place of hashes
RARE = 0xFFFFFFFF
HELD = 1 << 15  # marks a held-out document in a block's token list
MANY = 0xFF  # a pair's count that does not fit a byte


def held_out_ids(ids: pa.Array) -> np.ndarray:
    return np.array([i is not None and zlib.crc32(str(i).encode()) % FOLDS == HELD_OUT_FOLD for i in ids.to_pylist()], bool)


def good_turing(counts_of_counts: dict[int, int]) -> np.ndarray:
    """Discounts d[0..KEEP + 1] (d[r] of a count r; the last for all above).
    Katz's formula where the counts of counts allow it, else r / (r + 0.5)."""
    n = [counts_of_counts.get(r, 0) for r in range(KEEP + 2)]
    d = np.ones(KEEP + 2)
    cut = (KEEP + 1) * n[KEEP + 1] / n[1] if n[1] else 1.0
    for r in range(1, KEEP + 1):
        value = ((r + 1) * n[r + 1] / (r * n[r]) - cut) / (1 - cut) if n[r] and cut < 1 else -1.0
        d[r] = value if 0 < value < 1 else r / (r + 0.5)
    return d


class Unigrams:
    """P(w) from counts: discounts, total and the mass of unseen words."""

    def __init__(self, counts_of_counts: dict[int, int], tokens: int, types: int):
        self.tokens, self.types = tokens, types
        self.d = good_turing(counts_of_counts)
        small = sum((1 - self.d[r]) * r * counts_of_counts.get(r, 0) for r in range(1, KEEP + 1))
        self.base = tokens + 1 if tokens and small <= 0 else max(tokens, 1)
        self.unseen = (self.base - tokens + small) / self.base if tokens else 1.0

    def p(self, c: np.ndarray) -> np.ndarray:
        return np.where(c > 0, self.d[np.minimum(c, KEEP + 1)] * c / self.base, self.unseen)


def _blocks(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[int, pa.Array, np.ndarray, np.ndarray, np.ndarray]]:
    """(block id, ids, targets, document of each target, first target of each
    document) for runs of documents of about BLOCK_TOKENS tokens."""
    context = TaskContext.get()
    serial = (context.partitionId() if context else 0) << 32
    for batch in batches:
        parts: list[tuple[int, int, np.ndarray, np.ndarray]] = []
        held = 0
        for a, b, data, offsets in text_slices(batch.column(1), SLICE):
            words = split_words(data, offsets, lower=True)
            h = np.where(words.hashes <= START, words.hashes + np.uint64(3), words.hashes)
            parts.append((a, b, h, np.diff(words.first)))
            held += len(h) + b - a
            docs = b - parts[0][0]
            if held < BLOCK_TOKENS and docs < BLOCK_DOCS and b < batch.num_rows:
                continue
            at = parts[0][0]
            sizes = np.concatenate([p[3] for p in parts]) + 1
            doc = np.repeat(np.arange(len(sizes), dtype=np.uint16), sizes)
            first = np.concatenate([[0], np.cumsum(sizes)])
            target = np.full(first[-1], END, np.uint64)
            inner = np.ones(first[-1], bool)
            inner[first[1:] - 1] = False
            target[inner] = np.concatenate([p[2] for p in parts])
            parts, held = [], 0
            del words, h, inner
            yield serial, batch.column(0).slice(at, docs), target, doc, first
            serial += 1


def unigram_counts(docs: DataFrame) -> DataFrame:
    """(w, c) over the training texts; counted per block before the shuffle."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        for _, ids, target, doc, _ in _blocks(batches):
            w, c = np.unique(target[~held_out_ids(ids)[doc]], return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(w.view(np.int64)), pa.array(c)], names=["w", "c"])

    return doc_texts(docs).mapInArrow(run, "w long, c long").groupBy("w").agg(F.sum("c").alias("c"))


def _level(c):
    """Counts up to 64 as they are, larger ones in 1/16 octaves: a bounded
    number of levels, whatever the corpus."""
    return F.when(c <= 64, c).otherwise(F.floor(F.log2(c.cast("double")) * 16) + 1000).cast("long")


class Model:
    """What scoring and the tables share, all of bounded size: the unigram
    constants, the top words with their counts, the hot histories and the
    number of buckets."""

    def __init__(self, unigrams: DataFrame):
        levels = unigrams.groupBy(_level(F.col("c")).alias("level")).agg(F.count("*").alias("words"), F.sum("c").alias("tokens"), F.min("c").alias("least")).collect()
        levels = sorted(levels, key=lambda r: -r["level"])
        small = {r["level"]: r["words"] for r in levels if r["level"] <= 64}
        self.uni = Unigrams(small, sum(r["tokens"] for r in levels), sum(r["words"] for r in levels))
        self.buckets = max(4, min(MAX_BUCKETS, math.ceil(self.uni.tokens / BUCKET_TOKENS)))
        taken, least = 0, None
        for r in levels:
            if taken + r["words"] > TOP_WORDS:
                break
            taken, least = taken + r["words"], r["least"]
        top = unigrams.where(F.col("c") >= least).toPandas() if least is not None else pd.DataFrame({"w": [], "c": []})
        w = top["w"].to_numpy(np.int64).view(np.uint64)
        order = np.argsort(w)
        self.top_w, self.top_c = w[order], top["c"].to_numpy(np.int64)[order]
        # at most 4 * buckets words can be this frequent
        hot = unigrams.where((F.col("c") * (4 * self.buckets) > self.uni.tokens) & (F.col("w") != END)).toPandas()
        hot_w = hot["w"].to_numpy(np.int64).view(np.uint64)
        order = np.argsort(hot_w)
        self.hot, self.hot_c = hot_w[order], hot["c"].to_numpy(np.int64)[order]
        end = unigrams.where(F.col("w") == END).first()
        self.end_count = end["c"] if end else 0

    def number(self, w: np.ndarray) -> np.ndarray:
        """Numbers of top words, RARE for the others."""
        if not len(self.top_w):
            return np.full(len(w), RARE, np.uint32)
        at = np.minimum(np.searchsorted(self.top_w, w), len(self.top_w) - 1)
        return np.where(self.top_w[at] == w, at, RARE).astype(np.uint32)


_BLOCK = "bucket int, block long, h binary, rare_h binary, fan binary, w binary, rare_w binary, n binary, n_many binary, docs binary, n_docs int"
_BLOCK_NAMES = [f.split()[0] for f in _BLOCK.split(", ")]


def pair_blocks(docs: DataFrame, model: Model) -> DataFrame:
    """One row per block and bucket: histories by rising hash (h: differences of
    their numbers, rare_h by hash) with their numbers of followers (fan), followers (w by number, rare_w by hash), tokens of each
    pair (n in a byte, MANY: in n_many) and the documents of the tokens (numbers
    within the block, HELD added to held-out ones). Rows of bucket -1 - b name a
    block's documents: ids in h, tokens in n, fold in docs, and of their top words
    the base score in fan and the number in w. Arrays are ``packed``."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        for block in _blocks(batches):
            yield one_block(*block)
            del block
            release_memory()

    def one_block(block: int, ids: pa.Array, target: np.ndarray, doc: np.ndarray, first: np.ndarray) -> pa.RecordBatch:
        out_fold = held_out_ids(ids)
        words, number = np.unique(np.append(target, np.uint64(START)), return_inverse=True)
        wid = number[:-1].astype(np.uint64)
        hid = np.empty_like(wid)
        hid[1:] = wid[:-1]
        hid[first[:-1]] = number[-1]
        w_number = model.number(words)
        top = (w_number != RARE) & (words > START)
        log_count = np.zeros(len(words))
        log_count[top] = np.log10(model.top_c[w_number[top]] + 1.0)
        top_base = np.bincount(doc, log_count[number[:-1]], len(out_fold))
        top_words = np.bincount(doc[top[number[:-1]]], minlength=len(out_fold)).astype(np.uint32)
        del number
        is_hot = np.isin(words, model.hot) | (words == START)
        home = (mix(words) % np.uint64(model.buckets)).astype(np.uint64)
        by_word = mix(words[hid] ^ mix(words[wid])) % np.uint64(model.buckets)
        bucket = np.where(is_hot[hid], by_word, home[hid])
        code = (bucket << np.uint64(50)) | (hid << np.uint64(25)) | wid
        order = np.argsort(code, kind="stable")
        code, tokens_of = code[order], (doc + out_fold[doc] * np.uint16(HELD))[order]
        del hid, wid, by_word, bucket, order
        starts = np.flatnonzero(np.concatenate([[True], code[1:] != code[:-1]]))
        n = np.diff(np.append(starts, len(code))).astype(np.uint32)
        pair = code[starts]
        pair_bucket = (pair >> np.uint64(50)).astype(np.int64)
        pair_h = ((pair >> np.uint64(25)) & np.uint64((1 << 25) - 1)).astype(np.int64)
        pair_w = (pair & np.uint64((1 << 25) - 1)).astype(np.int64)
        present = np.flatnonzero(np.concatenate([[True], pair_bucket[1:] != pair_bucket[:-1]]))
        rows: dict[str, list] = {k: [] for k in _BLOCK_NAMES}
        for s, e in zip(present, np.append(present[1:], len(pair)), strict=True):
            ph, pw = pair_h[s:e], pair_w[s:e]
            heads = np.flatnonzero(np.concatenate([[True], ph[1:] != ph[:-1]]))
            coded, heads_coded = w_number[pw], w_number[ph[heads]]
            named = heads_coded != RARE
            upto = starts[e] if e < len(starts) else len(code)
            values = (
                int(pair_bucket[s]), block, np.diff(heads_coded[named], prepend=np.uint32(0)), words[ph[heads[~named]]], np.diff(np.append(heads, len(ph))).astype(np.uint32),
                coded, words[pw[coded == RARE]], np.minimum(n[s:e], MANY).astype(np.uint8), n[s:e][n[s:e] >= MANY], tokens_of[starts[s] : upto], len(out_fold),
            )
            for k, v in zip(_BLOCK_NAMES, values, strict=True):
                rows[k].append(packed(v) if isinstance(v, np.ndarray) else v)
        numbers = ids.fill_null(np.iinfo(np.int64).min).to_numpy(zero_copy_only=False).astype(np.int64)
        about = (-1 - block % model.buckets, block, numbers, b"", top_base, top_words, b"", np.diff(first).astype(np.uint32), b"", out_fold.astype(np.uint8), len(out_fold))
        for k, v in zip(_BLOCK_NAMES, about, strict=True):
            rows[k].append(packed(v) if isinstance(v, np.ndarray) else v)
        types = {"bucket": pa.int32(), "block": pa.int64(), "n_docs": pa.int32()}
        return pa.RecordBatch.from_arrays([pa.array(rows[k], types.get(k, pa.binary())) for k in _BLOCK_NAMES], names=_BLOCK_NAMES)

    return doc_texts(docs).mapInArrow(run, _BLOCK)


#: What a bucket's task gives, told apart by kind (the folder it is stored in).
DOCUMENT, PARTIAL, HISTORY, RARE_PAIR, UNSEEN_HISTORY, UNSEEN_WORD, TALLY, BIGRAMS = range(8)
_OUT = "kind int, a long, b long, i int, n1 long, n2 long, n3 long, n4 long, n5 long, big long, value double, base double, data binary"
_OUT_SCHEMA = pa.schema(
    [("kind", pa.int32()), ("a", pa.int64()), ("b", pa.int64()), ("i", pa.int32())]
    + [(f"n{r}", pa.int64()) for r in range(1, 6)]
    + [("big", pa.int64()), ("value", pa.float64()), ("base", pa.float64()), ("data", pa.binary())]
)


def _out(kind: int, size: int, **columns: np.ndarray) -> pa.RecordBatch:
    arrays = [pa.array(np.full(size, kind, np.int32))]
    for f in list(_OUT_SCHEMA)[1:]:
        v = columns.get(f.name)
        arrays.append(pa.nulls(size, f.type) if v is None else pa.array(v, f.type))
    return pa.RecordBatch.from_arrays(arrays, schema=_OUT_SCHEMA)


def _partial(block: int, n_docs: int, docs: np.ndarray, add: np.ndarray, level: np.ndarray, base: np.ndarray, rare: np.ndarray) -> pa.RecordBatch:
    """What a bucket's tokens of a block add to its documents: for those with
    tokens (``some``, as differences) the sum of ``add`` and the numbers of each
    level, and for those with rare histories the base scores and the numbers of
    known ones."""
    some = np.flatnonzero(np.bincount(docs, minlength=n_docs))
    levels = np.stack([np.bincount(docs[level == q], minlength=n_docs)[some] for q in range(1, KEEP + 1)])
    levels = levels.astype(np.uint8 if levels.max() < 256 else np.uint32)
    arrays = [np.bincount(docs, add, n_docs)[some], levels, np.diff(some, prepend=0).astype(np.uint16)]
    if rare.any():
        docs, base = docs[rare], base[rare]
        own = np.unique(docs)
        arrays += [np.bincount(docs, base, n_docs)[own], np.bincount(docs, base > 0, n_docs)[own].astype(np.uint32), own.astype(np.uint16)]
    frames = [packed(x) for x in arrays]
    sizes = {f"n{k}": [len(f)] for k, f in enumerate(frames[:-1], 1)}
    return _out(PARTIAL, 1, a=[levels.itemsize], b=[block], i=[n_docs], data=[b"".join(frames)], **sizes)


def _bucket_task(model: Model):
    """The function that sums and scores one bucket."""

    def about(rows: list[dict]) -> list[pa.RecordBatch]:
        made = []
        for r in rows:
            r |= {k: pa.py_buffer(r[k]) for k in ("h", "fan", "w", "n", "docs")}
            ids = unpacked(r["h"], np.int64)
            null = ids == np.iinfo(np.int64).min
            made.append(
                _out(
                    DOCUMENT, len(ids), a=pa.array(ids, mask=null), b=np.full(len(ids), r["block"]), i=np.arange(len(ids), dtype=np.int32),
                    n1=unpacked(r["n"], np.uint32).astype(np.int64), n2=unpacked(r["docs"], np.uint8).astype(np.int64),
                    n3=unpacked(r["w"], np.uint32).astype(np.int64), base=unpacked(r["fan"], np.float64),
                )
            )
        return made

    def run(table: pa.Table) -> pa.Table:
        made = one_bucket(table)
        release_memory()
        return made

    def one_bucket(table: pa.Table) -> pa.Table:
        bucket = table.column("bucket")[0].as_py()
        if bucket < 0:
            return pa.Table.from_batches(about(table.to_pylist()), _OUT_SCHEMA)
        uni = model.uni

        def column(name: str, kind: type) -> list[np.ndarray]:
            return [unpacked(x.as_buffer(), kind) for x in table.column(name)]

        # names rise by hash, and so do a block's histories
        heads = [np.sort(np.concatenate([model.top_w[np.cumsum(x, dtype=np.int64)], rare])) for x, rare in zip(column("h", np.uint32), column("rare_h", np.uint64), strict=True)]
        h = np.concatenate([np.repeat(x, fan) for x, fan in zip(heads, column("fan", np.uint32), strict=True)])
        del heads
        numbers = column("w", np.uint32)
        sizes = [len(x) for x in numbers]
        number = np.concatenate(numbers)
        w = np.empty(len(number), np.uint64)
        top = number != RARE
        w[top] = model.top_w[number[top]]
        w[~top] = np.concatenate(column("rare_w", np.uint64))
        # distinct pairs of the bucket and their training counts
        key = mix(h * np.uint64(0x9FB21C651E98DF25) + w)
        order = np.argsort(key)
        key = key[order]
        begins = np.concatenate([[True], key[1:] != key[:-1]])
        del key
        one = order[begins]
        pi = np.empty(len(order), np.int32)
        pi[order] = np.cumsum(begins, dtype=np.int32) - 1
        del order, begins
        pw, pn = w[one], number[one]
        hs, ph = np.unique(h[one], return_inverse=True)
        ph = ph.astype(np.int32)
        del h, w, number, one, top
        n = np.concatenate(column("n", np.uint8)).astype(np.uint32)
        n[n == MANY] = np.concatenate(column("n_many", np.uint32))
        tokens_of = column("docs", np.uint16)
        begin = np.cumsum(sizes) - sizes
        in_training = [np.add.reduceat(d < HELD, np.cumsum(n[b : b + k], dtype=np.int64) - n[b : b + k], dtype=np.uint32) for d, b, k in zip(tokens_of, begin, sizes, strict=True)]
        c2 = np.bincount(pi, np.concatenate(in_training), len(pw)).astype(np.int64)
        del in_training
        seen = c2 > 0
        level = np.minimum(c2, KEEP + 1).astype(np.int8)
        split = np.isin(hs, model.hot) | (hs == START)
        ch = np.bincount(ph, c2, len(hs)).astype(np.int64)
        spread = split & (hs != START)
        ch[spread] = model.hot_c[np.searchsorted(model.hot, hs[spread])]
        ch[hs == START] = model.end_count  # a training text has one start and one end
        fans = np.stack([np.bincount(ph[level == r], minlength=len(hs)) for r in range(1, KEEP + 1)], 1)
        big = np.bincount(ph, np.where(c2 > KEEP, c2, 0), len(hs)).astype(np.int64)
        top = pn != RARE
        p_top = np.zeros(len(pw))
        p_top[top] = uni.p(model.top_c[pn[top]])
        psum = np.bincount(ph, np.where(seen & top, p_top, 0.0), len(hs))
        divide = ch + 1
        made = [_out(TALLY, 1, **{f"n{r}": [int((level == r).sum())] for r in range(1, KEEP + 1)}, big=[int((c2 == KEEP + 1).sum())])]
        known = (ch > 0) & (np.bincount(ph, seen, len(hs)) > 0)
        k = np.flatnonzero(known)
        made.append(_out(HISTORY, len(k), a=hs[k].view(np.int64), b=divide[k], **{f"n{r}": fans[k, r - 1] for r in range(1, KEEP + 1)}, big=big[k], value=psum[k]))
        k = np.flatnonzero(seen & ~top)
        made.append(_out(RARE_PAIR, len(k), a=pw[k].view(np.int64), b=hs[ph[k]].view(np.int64)))
        k = np.flatnonzero(seen)
        k = k[np.lexsort((pn[k], ph[k]))]
        fan = np.bincount(ph[k], minlength=len(hs)).astype(np.uint32)
        data = [packed(x) for x in (hs, fan, pn[k], pw[k[pn[k] == RARE]], c2[k].astype(np.uint32))]
        made.append(_out(BIGRAMS, len(data), a=np.full(len(data), bucket), i=np.arange(len(data), dtype=np.int32), data=data))
        # what each token of the pair adds to its document, discounts aside;
        # -log10(divide) of starts and top words is in the document's own row
        log_divide = np.log10(divide.astype(float))
        h_rare = (hs != START) & (model.number(hs) == RARE)
        add = np.where(
            seen,
            np.where(c2 > KEEP, np.log10(np.maximum(c2, 1)), 0.0) - np.where(h_rare, log_divide, 0.0)[ph],
            np.where(top, np.log10(np.maximum(p_top, 1e-300)), 0.0) + np.where(h_rare, 0.0, log_divide)[ph],
        )
        back_off = known | (split & (ch > 0))
        for block, n_docs, docs, b, size in zip(table.column("block").to_pylist(), table.column("n_docs").to_pylist(), tokens_of, begin, sizes, strict=True):
            p = np.repeat(pi[b : b + size], n[b : b + size])
            docs = docs & np.uint16(HELD - 1)
            made.append(_partial(block, n_docs, docs, add[p], level[p], log_divide[ph[p]], h_rare[ph[p]]))
            miss = np.flatnonzero(~seen[p])
            if len(miss):
                mp, md = p[miss], docs[miss].astype(np.int32)
                hk, rw = back_off[ph[mp]], ~top[mp]
                made.append(_out(UNSEEN_HISTORY, int(hk.sum()), a=hs[ph[mp[hk]]].view(np.int64), b=np.full(int(hk.sum()), block), i=md[hk]))
                made.append(_out(UNSEEN_WORD, int(rw.sum()), a=pw[mp[rw]].view(np.int64), b=np.full(int(rw.sum()), block), i=md[rw]))
        return pa.Table.from_batches(made, _OUT_SCHEMA)

    return run


class Tables:
    """The trained model as tables in the shared folder."""

    def __init__(self, unigrams: DataFrame, model: Model, parts: DataFrame):
        self.unigrams, self.model, self.parts = unigrams, model, parts
        tally = parts.where(F.col("kind") == TALLY).agg(*(F.sum(f"n{r}").alias(f"n{r}") for r in range(1, KEEP + 1)), F.sum("big").alias("n6")).first()
        self.d2 = good_turing({r: tally[f"n{r}"] or 0 for r in range(1, KEEP + 2)})
        self.histories = stored(self._histories(), "katz-histories")

    def word_p(self, c):
        """P(w) of a count column (null: unseen) as an expression."""
        uni = self.model.uni
        discount = F.element_at(F.array(*(F.lit(float(x)) for x in uni.d)), F.least(c, F.lit(KEEP + 1)).cast("int") + 1)
        return F.when(c > 0, discount * c / F.lit(float(uni.base))).otherwise(F.lit(float(uni.unseen)))

    def _histories(self) -> DataFrame:
        """(h, divide, alpha): the mass that discounting leaves over the mass
        that the seen followers leave at the lower order."""
        rare = self.parts.where(F.col("kind") == RARE_PAIR).select(F.col("a").alias("w"), F.col("b").alias("h"))
        rare_sum = rare.join(self.unigrams, "w").groupBy("h").agg(F.sum(self.word_p(F.col("c"))).alias("rare"))
        own = self.parts.where(F.col("kind") == HISTORY)
        sums = own.groupBy(F.col("a").alias("h")).agg(
            F.max("b").alias("divide"), F.sum("big").alias("big"), F.sum("value").alias("p"), *(F.sum(f"n{r}").alias(f"n{r}") for r in range(1, KEEP + 1))
        )
        used = F.col("big").cast("double")
        for r in range(1, KEEP + 1):
            used = used + F.lit(float(self.d2[r]) * r) * F.col(f"n{r}")
        left = 1 - used / F.col("divide")
        below = 1 - F.col("p") - F.coalesce("rare", F.lit(0.0))
        return sums.join(rare_sum, "h", "left").select("h", "divide", (left / below).alias("alpha"))

    def bigrams(self) -> DataFrame:
        """(bucket, h, w, c) of the training pairs."""
        packed = self.parts.where(F.col("kind") == BIGRAMS).groupBy(F.col("a").alias("bucket")).pivot("i", list(range(5))).agg(F.first("data"))
        top_w = self.model.top_w

        def run(batches: Iterable[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
            for batch in batches:
                for r in batch.to_pylist():
                    hs, fan, number, rare, c = (unpacked(pa.py_buffer(r[str(k)]), t) for k, t in enumerate((np.int64, np.uint32, np.uint32, np.uint64, np.uint32)))
                    w = np.empty(len(number), np.uint64)
                    w[number != RARE] = top_w[number[number != RARE]]
                    w[number == RARE] = rare
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(w), r["bucket"])), pa.array(np.repeat(hs, fan)), pa.array(w.view(np.int64)), pa.array(c.astype(np.int64))], names=["bucket", "h", "w", "c"]
                    )

        return packed.mapInArrow(run, "bucket long, h long, w long, c long")


def train(docs: DataFrame) -> Tables:
    """Count, discount and store the model; the same pass leaves the parts of
    every document's score (``score``)."""
    unigrams = stored(unigram_counts(docs), "katz-unigrams")
    model = Model(unigrams)
    blocks = pair_blocks(docs, model)
    parts = stored(blocks.groupBy("bucket").applyInArrow(_bucket_task(model), _OUT), "katz-parts", partition_by="kind")
    return Tables(unigrams, model, parts)


def _document_sums(parts: DataFrame, d2: np.ndarray) -> DataFrame:
    """(b, i, sum, base_sum, known): partial scores added up per document; the
    last two of its rare words only."""
    weights = np.array([math.log10(d2[r] * r) for r in range(1, KEEP + 1)])

    def run(table: pa.Table) -> pa.Table:
        rows = table.to_pylist()
        sums = np.zeros((3, max(r["i"] for r in rows)))
        for r in rows:
            data = pa.py_buffer(r["data"])
            ends = np.cumsum([r[f"n{k}"] or 0 for k in range(1, 6)]).tolist()
            bounds = [0, *ends[: 5 if r["n3"] else 2], data.size]
            frames = [data[x:y] for x, y in zip(bounds, bounds[1:], strict=False)]
            at = np.cumsum(unpacked(frames[2], np.uint16), dtype=np.int64)
            levels = unpacked(frames[1], np.uint8 if r["a"] == 1 else np.uint32).reshape(KEEP, len(at))
            sums[0, at] += unpacked(frames[0], np.float64) + weights @ levels
            if r["n3"]:
                own = unpacked(frames[5], np.uint16)
                sums[1, own] += unpacked(frames[3], np.float64)
                sums[2, own] += unpacked(frames[4], np.uint32)
        n = sums.shape[1]
        return pa.table({"b": pa.array(np.full(n, rows[0]["b"])), "i": pa.array(np.arange(n, dtype=np.int32)), "sum": sums[0], "base_sum": sums[1], "known": sums[2].astype(np.int64)})

    partial = parts.where(F.col("kind") == PARTIAL).select("a", "b", "i", "n1", "n2", "n3", "n4", "n5", "data")
    return partial.groupBy("b").applyInArrow(run, "b long, i int, sum double, base_sum double, known long")


def score(tables: Tables) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score)
    of every document that ``train`` read."""
    parts, uni = tables.parts, tables.model.uni
    steps = parts.where(F.col("kind") == UNSEEN_HISTORY).select(F.col("a").alias("h"), "b", "i")
    backed = steps.join(tables.histories, "h").select("b", "i", F.log10("alpha").alias("more"))
    words = parts.where(F.col("kind") == UNSEEN_WORD).select(F.col("a").alias("w"), "b", "i")
    lower = words.join(tables.unigrams, "w", "left").select("b", "i", F.log10(tables.word_p(F.col("c"))).alias("more"))
    more = backed.unionByName(lower).groupBy("b", "i").agg(F.sum("more").alias("more"))
    named = parts.where(F.col("kind") == DOCUMENT).select(F.col("a").alias("doc_id"), "b", "i", F.col("n1").alias("n_tokens"), (F.col("n2") > 0).alias("held_out"), F.col("n3").alias("top_words"), F.col("base").alias("top_base"))
    joined = named.join(_document_sums(parts, tables.d2), ["b", "i"], "left").join(more, ["b", "i"], "left")
    end = tables.model.end_count
    per_token = math.log10(uni.tokens + uni.types + 1)
    base = F.col("top_base") + F.coalesce("base_sum", F.lit(0.0)) + math.log10(end + 1) - F.col("n_tokens") * per_token
    return joined.select(
        "doc_id", "held_out", "n_tokens", (F.col("top_words") + F.coalesce("known", F.lit(0)) + int(end > 0)).cast("long").alias("n_known"),
        F.lit(uni.tokens).cast("long").alias("train_tokens"), base.alias("base_score"),
        (F.coalesce("sum", F.lit(0.0)) - F.col("top_base") - math.log10(end + 1) + F.coalesce("more", F.lit(0.0))).alias("score"),
    )


def katz_scores(spark: SparkSession, docs: DataFrame) -> DataFrame:
    return score(train(docs))
