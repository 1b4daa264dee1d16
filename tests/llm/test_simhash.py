"""SimHash trie join: fingerprints by definition, links against brute force."""

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from blotter.llm.blocking import components
from blotter.llm.simhash_trie import BUDGET, fingerprint, linked_prints, node_pairs, simhash_components, traverse, trie
from tests.conftest import SF_SMALL


def brute_links(prints, budget=BUDGET):
    u = np.unique(np.array(prints, np.uint64))
    out = set()
    for i in range(len(u)):
        for j in np.flatnonzero(np.bitwise_count(u[i + 1 :] ^ u[i]) <= budget) + i + 1:
            out.add((int(u[i]), int(u[j])))
    return out


def crowd(seed, far, centres, near, flips):
    """Random prints, and groups that differ from a centre in up to ``flips`` bits."""
    rng = np.random.default_rng(seed)
    out = rng.integers(0, 2**64, far, dtype=np.uint64)
    for c in rng.integers(0, 2**64, centres, dtype=np.uint64):
        bits = rng.integers(0, 64, (near, flips)).astype(np.uint64)
        out = np.concatenate([out, np.bitwise_xor.reduce(np.concatenate([np.uint64(1) << bits, np.full((near, 1), c)], 1), 1)])
    return np.unique(out)


@pytest.mark.parametrize("leaf", [1, 16, 1024])
def test_links_equal_brute_force(spark, leaf):
    prints = np.concatenate([crowd(leaf, 1500, 4, 250, 3), np.array([0, 1, 3, 7, 2**64 - 1, 2**63, 2**63 + 1], np.uint64)])
    df = spark.createDataFrame(pa.table({"print": pa.array(np.unique(prints).view(np.int64))}).to_pandas())
    nodes, leaves, deepest = trie(df, leaf)
    assert leaves.agg(F.sum(F.size("prints"))).first()[0] == len(np.unique(prints))
    assert leaves.agg(F.max(F.size("prints"))).first()[0] <= leaf
    rows = linked_prints(node_pairs(nodes, deepest), leaves).collect()
    got = [tuple(sorted((r.a % 2**64, r.b % 2**64))) for r in rows]
    assert len(got) == len(set(got))  # every pair is met once
    assert set(got) == brute_links(prints)


def test_traversal_in_small_pieces(monkeypatch):
    from blotter.llm import simhash_trie

    monkeypatch.setattr(simhash_trie, "HELD", 50)
    members = crowd(9, 300, 3, 100, 2)
    whole = np.array([[0, len(members), 0, len(members)]])
    got = set()
    for a, b in traverse(members, 0, whole, np.zeros(1, np.int64), np.ones(1, bool), BUDGET):
        got |= {tuple(sorted((int(x), int(y)))) for x, y in zip(members[a], members[b], strict=True)}
    assert got == brute_links(members)


def test_fingerprint_by_definition(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").where("length(text) < 3000").select("doc_id", "text").limit(12).collect()
    texts = [r.text for r in docs] + ["Ab c", "A\tB\x0bC d", "é É x y", "a b c d", "\x1cone two three"]
    for text in texts:
        words = [w for w in "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text).translate({i: " " for i in range(9, 14)}).split(" ") if w]
        shingles = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or [" ".join(words)]
        hashes = [r[0] for r in spark.createDataFrame([(s,) for s in shingles], "s string").select(F.xxhash64("s")).collect()]
        expected = sum(1 << i for i in range(64) if 2 * sum((h >> i) & 1 for h in hashes) > len(hashes))
        assert fingerprint(text.encode()) == expected
    assert fingerprint(b"") == fingerprint(b" \n\t") == 0


def test_components_equal_brute_force(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    got = simhash_components(docs, leaf=8).toPandas()
    texts = docs.select("doc_id", "text").collect()
    prints = {r.doc_id: fingerprint((r.text or "").encode()) for r in texts}
    assert {r.doc_id: r.fingerprint for r in got.itertuples()} == {k: f"{v:016x}" for k, v in prints.items()}
    group = {k: k for k in prints}

    def root(x):
        while group[x] != x:
            x = group[x]
        return x

    ids = sorted(prints)
    for i, a in enumerate(ids):
        for b in ids[i + 1 :]:
            if (prints[a] ^ prints[b]).bit_count() <= 2:
                x, y = sorted((root(a), root(b)))
                group[y] = x
    assert {r.doc_id: r.component_id for r in got.itertuples()} == {k: root(k) for k in prints}


def test_odd_documents(odd_docs, no_docs):
    got = simhash_components(odd_docs.withColumn("print", F.lit("x")).withColumn("fingerprint", F.lit("y"))).collect()
    assert len(got) == 11
    zero = {r.doc_id for r in got if r.fingerprint == "0" * 16}
    assert {0, 1, 2, 7} <= zero and {r.component_id for r in got if r.doc_id in zero} == {0}
    assert [r.component_id for r in got if r.doc_id == 90] == [90, 90]
    assert [r.component_id for r in got if r.doc_id is None] == [None]
    assert simhash_components(no_docs).collect() == []


def test_no_links_no_components(spark):
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []
