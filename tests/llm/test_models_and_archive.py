"""Katz model, source mix, WARC archive and the pipeline."""

import base64
import collections
import gzip
import hashlib
import heapq
import math
import tracemalloc
import zlib
from fractions import Fraction

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

import corpus_pipeline
from blotter.llm import katz
from blotter.llm.frames import read_table
from blotter.llm.mixing import mix_sources, sainte_lague, source_targets
from blotter.llm.warc import archive_pages, original_records, parse_records, write_archive
from tests.conftest import SF_SMALL

PAGES = "page_id long, url string, html string"

# ------------------------------------------------------------------- Katz


def _katz_by_definition(texts):
    """Scores of {id: text} by dictionaries."""
    tokens = {i: [*(t or "").encode().lower().split(), "<end>"] for i, t in texts.items()}
    train = [i for i in tokens if zlib.crc32(str(i).encode()) % 7 != 2]
    c1, c2 = collections.Counter(), collections.Counter()
    for i in train:
        c1.update(tokens[i])
        c2.update(zip(["<start>", *tokens[i]], tokens[i], strict=False))
    n = sum(c1.values())
    follow = collections.defaultdict(dict)
    for (h, w), c in c2.items():
        follow[h][w] = c
    d1, d2 = (katz.good_turing(collections.Counter(c.values())) for c in (c1, c2))
    small = sum((1 - d1[c]) * c for c in c1.values() if c <= katz.KEEP)
    base = n + 1 if n and small <= 0 else max(n, 1)
    p1 = {w: d1[min(c, 6)] * c / base for w, c in c1.items()}
    unseen = 1 - sum(p1.values()) if n else 1.0
    divide = {h: sum(f.values()) + 1 for h, f in follow.items()}
    alpha = {h: (1 - sum(d2[min(c, 6)] * c for c in f.values()) / divide[h]) / (1 - sum(p1[w] for w in f)) for h, f in follow.items()}

    def p(h, w):
        if w in follow.get(h, {}):
            c = follow[h][w]
            return d2[min(c, 6)] * c / divide[h]
        return alpha.get(h, 1.0) * p1.get(w, unseen)

    for h in list(follow)[:25]:  # their distributions sum to one
        assert sum(p(h, w) for w in c1) + alpha[h] * unseen == pytest.approx(1.0, abs=1e-9)
    out = {}
    for i, t in tokens.items():
        score = sum(math.log10(p(h, w)) for h, w in zip(["<start>", *t], t, strict=False))
        low = sum(math.log10((c1[w] + 1) / (n + len(c1) + 1)) for w in t)
        out[i] = (len(t), sum(c1[w] > 0 for w in t), n, low, score)
    return out


def _check(docs, texts):
    got = {r["doc_id"]: r for r in katz.score(katz.train(docs)).collect()}
    want = _katz_by_definition(texts)
    assert set(got) == set(want)
    for i, (n_tokens, n_known, total, low, score) in want.items():
        r = got[i]
        assert (r["n_tokens"], r["n_known"], r["train_tokens"]) == (n_tokens, n_known, total)
        assert r["base_score"] == pytest.approx(low, rel=1e-9) and r["score"] == pytest.approx(score, rel=1e-9)
        assert r["held_out"] == (zlib.crc32(str(i).encode()) % 7 == 2)


def test_scores_equal_the_definition_on_the_tables(spark):
    docs = read_table(spark, SF_SMALL, "documents")
    _check(docs, {r["doc_id"]: r["text"] for r in docs.collect()})


def test_words_outside_the_top_list_score_the_same(spark, monkeypatch):
    """Nearly every word travels as a hash and meets the tables in joins."""
    monkeypatch.setattr(katz, "TOP_WORDS", 3)
    monkeypatch.setattr(katz, "BLOCK_TOKENS", 500)
    docs = read_table(spark, SF_SMALL, "documents").where("doc_id < 60")
    _check(docs, {r["doc_id"]: r["text"] for r in docs.collect()})


def test_small_corpora_and_uniform_counts(make_docs):
    for texts in ([None, "", "a", "a a a a a a a a a a a a a a"], ["x y"] * 9, [" ".join(["w"] * 30)] * 8):
        _check(make_docs(texts), dict(enumerate(texts)))


def test_pairs_counted_beyond_a_byte_and_held_out_documents_keep_their_counts(make_docs):
    texts = [" ".join(["a b"] * 300), "a b " * 254 + "c", "b a " * 256]
    for ids in ([0, 1, 2], [next(i for i in range(100) if zlib.crc32(str(i).encode()) % 7 == 2), 200, 300]):
        _check(make_docs(texts, ids=ids), dict(zip(ids, texts, strict=True)))


def test_blocks_and_buckets_take_bounded_memory():
    """Peak of the arrays that a worker holds while it makes the blocks of a
    batch, and the bytes it sends per token."""
    rng = np.random.default_rng(5)
    words = np.array([f"w{i}" for i in rng.zipf(1.3, 1_200_000) % 200_000])
    texts = [" ".join(w) for w in words.reshape(4000, 300)]
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(texts))), pa.array(texts)], names=["doc_id", "text"])
    model = object.__new__(katz.Model)
    model.buckets, model.top_w, model.top_c = 8, np.zeros(0, np.uint64), np.zeros(0, np.int64)
    model.hot = np.zeros(0, np.uint64)
    made = []

    class Docs:
        def select(self, *_):
            return self

        def mapInArrow(self, run, _):
            made.append(run)

    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(katz, "doc_texts", lambda docs: docs)
        katz.pair_blocks(Docs(), model)
    list(made[0](iter([batch.slice(0, 100)])))  # the process's tables
    tracemalloc.start()
    sent = sum(block.nbytes for block in made[0](iter([batch])))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 60e6 and sent / (len(words) + len(texts)) < 7.5


def test_blocks_and_parts_take_little_disk(spark):
    """Bytes per token of the shuffled blocks, and of the parts of documents and
    pairs that the buckets store."""
    docs = read_table(spark, SF_SMALL, "documents")
    tables = katz.train(docs)
    sent = katz.pair_blocks(docs, tables.model).select(*(F.octet_length(c).alias(c) for c in ("h", "fan", "w", "n", "docs"))).agg(*(F.sum(c) for c in ("h", "fan", "w", "n", "docs"))).first()
    stored = {r["kind"]: r["size"] for r in tables.parts.groupBy("kind").agg(F.sum(F.octet_length("data")).alias("size")).collect()}
    tokens = katz.score(tables).agg(F.sum("n_tokens")).first()[0]
    assert sum(sent) < 4 * tokens and stored[katz.PARTIAL] < 0.25 * tokens
    pairs = tables.bigrams()
    assert stored[katz.BIGRAMS] < 8 * pairs.count()
    assert pairs.agg(F.sum("c")).first()[0] == tables.model.uni.tokens


def test_discounts():
    d = katz.good_turing({1: 1000, 2: 400, 3: 220, 4: 140, 5: 100, 6: 75})
    assert all(0 < x < 1 for x in d[1:6]) and d[6] == 1
    n = {1: 1000, 2: 400, 3: 220, 4: 140, 5: 100, 6: 75}
    # the discounted mass of counts up to five is that of the singletons
    assert sum((1 - d[r]) * r * n[r] for r in range(1, 6)) == pytest.approx(n[1])
    assert katz.good_turing({})[1] == pytest.approx(2 / 3)


def test_katz_tables_and_edge_cases(spark, odd_docs, no_docs):
    tables = katz.train(odd_docs)
    assert katz.score(tables).count() == odd_docs.count()
    assert tables.bigrams().agg({"c": "sum"}).first()[0] == tables.model.uni.tokens
    assert tables.histories.where("alpha <= 0").count() == 0
    assert katz.katz_scores(spark, no_docs).count() == 0
    only_held_out = next(i for i in range(100) if zlib.crc32(str(i).encode()) % 7 == 2)
    r = katz.katz_scores(spark, spark.createDataFrame([(only_held_out, "a b")], "doc_id long, text string")).first()
    assert (r["n_tokens"], r["n_known"], r["train_tokens"], r["base_score"], r["score"]) == (3, 0, 0, 0.0, 0.0)


# -------------------------------------------------------------------- mix


def _by_single_seats(votes, seats, caps):
    got = [0] * len(votes)
    heap = [(Fraction(-v) / 1, i) for i, v in enumerate(votes) if v > 0 and caps[i] > 0]
    heapq.heapify(heap)
    while seats and heap:
        _, i = heapq.heappop(heap)
        got[i] += 1
        seats -= 1
        if got[i] < caps[i]:
            heapq.heappush(heap, (Fraction(-votes[i]) / (2 * got[i] + 1), i))
    return got


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, 60), min_size=1, max_size=8), st.integers(0, 60), st.integers(1, 40))
def test_seats_equal_one_by_one_apportionment(votes, seats, cap):
    caps = [cap] * len(votes)
    got, want = sainte_lague([float(v) for v in votes], seats, caps), _by_single_seats(votes, seats, caps)
    assert sum(got) == sum(want)
    quotient = lambda a: sorted(v / (2 * k + 1) for v, s in zip(votes, a, strict=True) for k in range(s))
    assert quotient(got) == pytest.approx(quotient(want))  # equal but for ties


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(0, 500), min_size=1, max_size=9))
def test_targets_fill_up_by_weight(sizes):
    got = source_targets(sizes)
    assert sum(got) == pytest.approx(1.5 * sum(sizes))
    assert all(t <= 2 * s + 1e-9 for t, s in zip(got, sizes, strict=True))
    levels = {round(t / (3, 1, 2)[i % 3], 6) for i, (t, s) in enumerate(zip(got, sizes, strict=True)) if t < 2 * s - 1e-6}
    assert len(levels) <= 1  # sources below their limit share by weight


def test_mix_on_the_tables(spark):
    docs = read_table(spark, SF_SMALL, "documents")
    rows = mix_sources(spark, docs).collect()
    source = {r["doc_id"]: r["source"] for r in docs.collect()}
    size = {r["doc_id"]: len((r["text"] or "").encode().split()) for r in docs.collect()}
    by = collections.defaultdict(list)
    for r in rows:
        assert r["size"] == size[r["doc_id"]] and 0 <= r["taken"] <= 2 * r["size"]
        by[source[r["doc_id"]]].append(r)
    names = sorted(by, key=lambda s: (s is None, s))
    want = source_targets([sum(r["size"] for r in by[s]) for s in names])
    for s, t in zip(names, want, strict=True):
        assert all(r["target"] == pytest.approx(t) and r["source_size"] == sum(x["size"] for x in by[s]) for r in by[s])
        assert sum(r["taken"] for r in by[s]) == pytest.approx(t, rel=0.05, abs=64)
    again = {r["doc_id"]: r["taken"] for r in mix_sources(spark, docs.repartition(5)).collect()}
    assert again == {r["doc_id"]: r["taken"] for r in rows}


def test_mix_edge_cases(spark, odd_docs, no_docs):
    rows = mix_sources(spark, odd_docs).collect()
    assert len(rows) == odd_docs.count()
    assert all(r["taken"] <= 2 * r["size"] and r["target"] is not None for r in rows)
    assert mix_sources(spark, no_docs).count() == 0
    assert {(r["size"], r["target"], r["taken"]) for r in mix_sources(spark, odd_docs.where("text is null or doc_id = 1")).collect()} == {(0, 0.0, 0)}


# ------------------------------------------------------------------- WARC

TRICKY = [
    "<p>one</p>", "<p>two</p>", "<p>one</p>", "", None, "a\r\n\r\nWARC/1.1\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n", "\r\n\r\n", "é" * 5000, "<p>one</p>", "x\n" * 300_000,
]


def test_archive_round_trip_keeps_every_byte(spark):
    rows = [(i, f"http://h/{i}", t) for i, t in enumerate(TRICKY)] + [(90, "u\r\nInjected: 1", "<p>two</p>"), (91, None, "only"), (8, "again", "<p>one</p>")]
    pages = spark.createDataFrame(rows, PAGES)
    got = archive_pages(spark, pages).collect()
    assert len(got) == len(rows)
    bodies = collections.defaultdict(list)
    for i, _, t in rows:
        bodies[(t or "").encode()].append(i)
    want = sorted(
        (i, len(b), base64.b32encode(hashlib.sha1(b).digest()).decode(), "response" if i == max(bodies[b]) else "revisit", None if i == max(bodies[b]) else max(bodies[b]))
        for i, _, t in rows
        for b in [(t or "").encode()]
    )
    assert sorted(tuple(r[c] for c in ("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")) for r in got) == want


def test_payloads_are_stored_once_and_records_rebuilt(spark):
    pages = spark.createDataFrame([(i, f"u{i}", t) for i, t in enumerate(TRICKY)], PAGES)
    store, headers = write_archive(pages)
    assert store.count() == len({t or "" for t in TRICKY}) and headers.count() == len(TRICKY)
    records = [r["record"].encode() for r in original_records(store, headers).collect()]
    seen = collections.Counter()
    for record in records:
        for step in (1, 7, 1 << 20):
            found = list(parse_records(gzip.compress(record + b"\r\n\r\n"), step)) if step > 1 or len(record) < 2000 else []
            for fields, block in found:
                assert len(block) == int(fields["Content-Length"])
                if fields["WARC-Type"] == "response":
                    assert fields["WARC-Payload-Digest"] == "sha1:" + base64.b32encode(hashlib.sha1(block).digest()).decode()
                    seen[block] += 1
    assert set(seen) == {(t or "").encode() for t in TRICKY}


def test_archive_thresholds_and_edge_cases(spark):
    pages = spark.createDataFrame([(1, "u", "ab"), (2, "u", "ab"), (None, None, "ab"), (None, "u", "alone"), (3, "u", "long enough"), (4, "u", "long enough")], PAGES)
    _, headers = write_archive(pages.withColumn("digest", pages.html).withColumn("keeper", pages.url), min_revisit_bytes=5)
    kinds = sorted((str(r["page_id"]), r["record_type"], r["refers_to"]) for r in headers.collect())
    assert kinds == [("1", "response", None), ("2", "response", None), ("3", "revisit", 4), ("4", "response", None), ("None", "response", None), ("None", "response", None)]
    got = sorted((str(r["page_id"]), r["record_type"], r["payload_bytes"]) for r in archive_pages(spark, pages).collect())
    assert got == [("1", "revisit", 2), ("2", "response", 2), ("3", "revisit", 11), ("4", "response", 11), ("None", "response", 5), ("None", "revisit", 2)]
    assert archive_pages(spark, pages.limit(0)).count() == 0


# --------------------------------------------------------------- pipeline


def test_pipeline_stages_take_effect(spark):
    docs = read_table(spark, SF_SMALL, "documents")
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["quality_classifier", "line_dedup", "ngram_jaccard_join", "benchmark_decontamination", "source_mix"]
    sizes = []
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SF_SMALL).persist()
        assert out.columns == docs.columns
        sizes.append((docs.count(), out.count(), docs.selectExpr("sum(length(text))").first()[0], out.selectExpr("sum(length(text))").first()[0]))
        docs = out
    assert sizes[0][1] < sizes[0][0]  # rejected by the classifier
    assert sizes[1][1] == sizes[1][0] and sizes[1][3] < sizes[1][2]  # lines cut, rows kept
    assert sizes[2][1] < sizes[2][0] and sizes[3][1] < sizes[3][0]
    by_stages = sorted(map(tuple, corpus_pipeline.STAGES[-1][1](spark, docs, SF_SMALL).collect()))
    assert sorted(map(tuple, corpus_pipeline.run(spark, SF_SMALL).collect())) == by_stages
    spark.catalog.clearCache()


def test_pipeline_takes_odd_and_no_rows(spark, odd_docs, no_docs):
    for docs in (odd_docs, no_docs):
        for _, stage in corpus_pipeline.STAGES[:-1]:
            out = stage(spark, docs, SF_SMALL)
            assert out.columns == docs.columns
            docs = out
        corpus_pipeline.STAGES[-1][1](spark, docs, SF_SMALL).collect()
