"""Line dedup, paragraph dedup and the n-gram join against brute force."""

import collections
import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from blotter.llm import blocking
from blotter.llm.blocking import components, linked_components, shared_buckets
from blotter.llm.frames import read_table
from blotter.llm.line_dedup import dedup_line_runs, dedup_lines
from blotter.llm.ngram_join import keep_one_per_component, least_difference, ngram_components, parity_bitmap, shingle_sets
from blotter.llm.substring_dedup import band_blocks, paragraphs, prefix_rows, remove_paragraphs, repeated_paragraphs, shared_bands, tune_bands
from blotter.llm.textbatch import unpacked
from corpus_pipeline import line_dedup
from tests.conftest import SF_MID, SF_SMALL


def _components(pairs, members):
    parent = {m: m for m in members}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in pairs:
        a, b = root(a), root(b)
        parent[max(a, b)] = min(a, b)
    return {m: root(m) for m in members}


@pytest.mark.parametrize("shape", ["chain", "star", "random"])
def test_components_equal_union_find(spark, shape):
    rng = random.Random(1)
    ids = rng.sample(range(-(10**12), 10**12), 60)
    pairs = {"chain": list(zip(ids, ids[1:], strict=False))[::2] + [(ids[2], ids[9])], "star": [(ids[0], x) for x in ids[1:40]], "random": [tuple(rng.sample(ids, 2)) for _ in range(45)]}[shape]
    got = {r["c"]: r["root"] for r in components(spark.createDataFrame(pairs, "a long, b long")).collect()}
    want = _components(pairs, {x for p in pairs for x in p})
    assert got == want


def test_components_of_a_long_path_and_of_nothing(spark):
    path = [(i, i + 1) for i in range(300)]
    got = components(spark.createDataFrame(path, "a long, b long")).collect()
    assert {r["root"] for r in got} == {0} and len(got) == 301
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def _linked_by_rounds(spark, buckets, links):
    rows = spark.createDataFrame([(k, c, 10) for k, cs in buckets.items() for c in cs], "key long, c long, n int")
    known = spark.createDataFrame([(min(p), max(p)) for p in links], "a long, b long")
    _, roots = linked_components(shared_buckets(rows), 0.8, lambda pairs: pairs.join(known, ["a", "b"]))
    return {r["c"]: r["root"] for r in roots.collect()}


def test_sets_drawn_in_one_bucket_stay_open_in_their_others(spark):
    # 100 to 119 are strays of bucket 2, drawn at once, and in the main
    # component of bucket 1, whose strays 40 to 99 take several rounds
    family, other, single = [*range(40), *range(100, 120)], list(range(-60, 0)), list(range(40, 100))
    links = [(0, x) for x in family[1:]] + [(-60, x) for x in other[1:]] + [(100 + x % 20, x) for x in single]
    got = _linked_by_rounds(spark, {1: family + single, 2: other + family[40:]}, links)
    assert got == _components(links, {x for p in links for x in p})


@pytest.mark.parametrize("size", [2, 3, 4, 300])
def test_every_pair_of_a_bucket_is_met(spark, size):
    # each bucket has one link, between members that need not be its hubs
    rng = random.Random(size)
    buckets = {k: range(1000 * k, 1000 * k + size) for k in range(6000 // size if size < 300 else 6)}
    links = [tuple(sorted(rng.sample(list(b), 2))) for b in buckets.values()]
    got = _linked_by_rounds(spark, buckets, links)
    assert got == {c: a for a, b in links for c in (a, b)}


def test_texts_around_one_passage_equal_brute_force(spark, make_docs):
    # own words of 0 to 8 around 40 common ones: similarities on both sides of 0.8
    rng = random.Random(21)
    passage = [f"p{i}" for i in range(40)]
    texts = []
    for i in range(1000):
        own = [f"w{i % 700}x{j}" for j in range(rng.randint(0, 14))]
        at = rng.randint(0, len(own))
        texts.append(" ".join([*own[:at], *passage[rng.choice([0, 0, 0, 5]) :], *own[at:]]))
    sets = [{tuple(w[k : k + 5]) for k in range(len(w) - 4)} for w in (t.split() for t in texts)]
    pairs = []
    for i, a in enumerate(sets):
        for j in range(i + 1, len(sets)):
            both = len(a & sets[j])
            if 100 * both >= 80 * (len(a) + len(sets[j]) - both):
                pairs.append((i, j))
    got = {r["doc_id"]: r["component_id"] for r in ngram_components(make_docs(texts)).collect()}
    assert got == _components(pairs, range(len(texts)))


def test_overlapping_buckets_of_hundreds_of_families_equal_union_find(spark):
    rng = random.Random(5)
    buckets = {k: rng.sample(range(420), 220) for k in range(3)}
    pairs = sorted({(min(p), max(p)) for cs in buckets.values() for p in (rng.sample(cs, 2) for _ in range(90))})
    got = _linked_by_rounds(spark, buckets, pairs)
    assert got == _components(pairs, {x for p in pairs for x in p})


# ---------------------------------------------------------------- line dedup


def _line(rng, n=8):
    return " ".join(rng.choices([f"v{k}" for k in range(500)], k=n))


def test_line_dedup_removes_shared_blocks_wherever_they_stand(spark, make_docs):
    rng = random.Random(2)
    block = [_line(rng) for _ in range(30)]
    texts = []
    for _ in range(12):
        before, after = [_line(rng) for _ in range(rng.randint(0, 6))], [_line(rng) for _ in range(rng.randint(0, 6))]
        texts.append("\n".join(before + block + after))
    clean = ["\n".join(_line(rng) for _ in range(10)) for _ in range(5)]
    rows = dedup_lines(make_docs(texts + clean), count_as="removed").orderBy("doc_id").collect()
    assert rows[0]["text"] == texts[0] and rows[0]["removed"] == 0
    for r, t in list(zip(rows, texts, strict=False))[1:]:
        kept = [x for x in r["text"].split("\n") if x in block]
        assert r["removed"] >= 28 and len(kept) <= 2  # at most the first and the last line of the block
        assert [x for x in t.split("\n") if x not in block] == [x for x in r["text"].split("\n") if x and x not in block]  # emptied: ""
    assert [r["text"] for r in rows[12:]] == clean


def test_line_dedup_edge_cases(odd_docs, no_docs, make_docs):
    out = dedup_lines(odd_docs)
    assert out.columns == odd_docs.columns
    key = lambda rows: sorted((str(r["doc_id"]), str(r["text"])) for r in rows)
    assert key(out.collect()) == key(odd_docs.collect())
    assert dedup_lines(no_docs).count() == 0
    text = "\n".join(f"line number {i} of a text" for i in range(20))
    rows = dedup_lines(make_docs([text, text, text, None], ids=[3, 3, None, None]), count_as="removed").collect()
    # the text without an id comes first, and the twins of id 3 lose the same lines
    by_id = collections.defaultdict(list)
    for r in rows:
        by_id[r["doc_id"]].append(r)
    assert [r["text"] for r in by_id[3]] == [by_id[3][0]["text"]] * 2 and by_id[3][0]["removed"] > 0
    assert {r["removed"] for r in by_id[None]} == {0}


def _runs_seen_before(docs):
    """Lines, by document, in a two-line run of 40 characters that an earlier
    document holds."""
    seen, out = set(), {}
    for doc_id, text in sorted(docs):
        lines = (text or "").split("\n")
        runs = ["\n".join(p) for p in zip(lines, lines[1:], strict=False)]
        out[doc_id] = [lines[j] for j in sorted({j for i, r in enumerate(runs) if len(r) >= 40 and r in seen for j in (i, i + 1)})]
        seen.update(runs)
    return out


def test_line_dedup_recall_on_the_documents(spark):
    docs = read_table(spark, SF_MID, "documents").select("doc_id", "text")
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    want = _runs_seen_before(texts.items())
    for window, least in ((1, 1.0), (2, 0.9)):
        after = {r["doc_id"]: r for r in dedup_lines(docs, window=window, count_as="removed").collect()}
        missed = 0
        for i, lines in want.items():
            left = collections.Counter((after[i]["text"] or "").split("\n"))
            before = collections.Counter((texts[i] or "").split("\n"))
            missed += sum(n - min(n, before[x] - left[x]) for x, n in collections.Counter(lines).items())
        assert missed <= (1 - least) * sum(map(len, want.values()))
        # a line leaves only where the same line stands somewhere earlier
        held = collections.Counter(x for r in after.values() for x in (r["text"] or "").split("\n"))
        assert all(held[x] for t in texts.values() for x in (t or "").split("\n") if x.strip())


def test_equal_hashes_of_different_chunks_do_not_meet(spark, make_docs, monkeypatch):
    from blotter.llm import line_dedup as module

    monkeypatch.setattr(module.F, "xxhash64", lambda *c: F.length(c[0] if not isinstance(c[0], str) else F.col(c[0])).cast("long"))
    texts = [f"{a * 30}\n{b * 30}" for a in "abc" for b in "xyz"]
    got = [r["text"] for r in module.dedup_lines(make_docs([*texts, texts[0]])).orderBy("doc_id").collect()]
    assert got == [*texts, ""]


def test_pipeline_removes_short_repeated_passages_whole(odd_docs, no_docs, make_docs):
    rng = random.Random(12)
    passages = [[_line(rng, rng.choice([2, 8])) for _ in range(2 + k % 5)] for k in range(25)]
    passages = [p if len("\n".join(p)) >= 40 else [*p, _line(rng, 9)] for p in passages]
    texts, clean = [], []
    for k in range(75):
        before, after = ([_line(rng) for _ in range(rng.randint(1, 4))] for _ in range(2))
        texts.append("\n".join([*before, *passages[k % 25], *after]))
        clean.append("\n".join(before + after))
    left = [r["text"] for r in line_dedup(None, make_docs(texts), "").orderBy("doc_id").collect()]
    assert left[:25] == texts[:25] and left[25:] == clean[25:]
    out = dedup_line_runs(odd_docs)
    key = lambda rows: sorted((str(r["doc_id"]), str(r["text"])) for r in rows)
    assert out.columns == odd_docs.columns and key(out.collect()) == key(odd_docs.collect())
    assert dedup_line_runs(no_docs).count() == 0


# ----------------------------------------------------------- paragraph dedup


def test_bands_reach_the_recall_they_are_tuned_for():
    for recall in (0.9, 0.95, 0.99):
        bands, rows = tune_bands(0.8, recall)
        assert 1 - (1 - 0.8**rows) ** bands >= recall
        assert 1 - (1 - 0.1**rows) ** bands <= 0.1


def test_paragraphs_do_not_depend_on_what_surrounds_them():
    rng = random.Random(3)
    passage = _line(rng, 60)
    seen = []
    for n in (0, 3, 17, 40):
        text = " ".join([_line(rng, n)] * (n > 0) + [passage, _line(rng, 30)])
        seen.append({int(c) for _, _, _, cs, _, _ in paragraphs(pa.array([text])) for c in cs})
    assert set.intersection(*seen)


def test_every_word_of_a_text_lies_in_a_paragraph():
    rng = random.Random(13)
    texts = [_line(rng, n) for n in [16, 17, 25, 26, 40, 41, 42, *rng.choices(range(16, 3000), k=60)]] + ["same " * 200]
    seen = [np.zeros(len(t.split()), bool) for t in texts]
    for rows, firsts, ends, _, _, _ in paragraphs(pa.array(texts)):
        for row, first, end in zip(rows, firsts, ends, strict=True):
            seen[row][first:end] = True
    assert all(x.all() for x in seen)
    bands, rows = tune_bands(0.8, 0.999)
    assert 1 - (1 - 0.8**rows) ** bands >= 0.999


def test_passages_of_over_fifty_words_are_caught_inside_lines(make_docs):
    rng = random.Random(4)
    passages = [_line(rng, rng.randint(52, 70)) for _ in range(40)]
    texts, planted = [], set()
    for k in range(160):
        parts = [_line(rng, rng.randint(5, 120)), _line(rng, rng.randint(5, 120))]
        if k < 120:
            parts.insert(1, passages[k // 3])
            planted.add(k)
        texts.append(" ".join(parts))
    docs = make_docs(texts)
    found = repeated_paragraphs(docs).collect()
    hit = {r["doc_id"] for r in found}
    assert hit <= planted and len(hit) >= 0.95 * len(planted)
    assert all((r["doc_id"], r["first_word"]) == (r["original_doc_id"], r["original_word"]) for r in found if not r["removed"])
    left = {r["doc_id"]: r["text"] for r in remove_paragraphs(docs, repeated_paragraphs(docs)).collect()}
    for k in range(160):
        if k >= 120:
            assert left[k] == texts[k]
    cut = [k for k in planted if k % 3 and len(left[k].split()) < len(texts[k].split())]
    assert len(cut) >= 0.9 * 80


def test_paragraph_clusters_hold_verified_pairs_only(spark):
    docs = read_table(spark, SF_SMALL, "documents")
    found = repeated_paragraphs(docs).collect()
    words = {r["doc_id"]: (r["text"] or "").lower().encode().split() for r in docs.collect()}
    groups = collections.defaultdict(list)
    for r in found:
        run = words[r["doc_id"]][r["first_word"] : r["end_word"]]
        groups[(r["original_doc_id"], r["original_word"])].append({tuple(run[i : i + 5]) for i in range(len(run) - 4)})
    for sets in groups.values():
        linked = _components(
            [(i, j) for i in range(len(sets)) for j in range(i) if len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j])], range(len(sets))
        )
        assert len(sets) > 1 and set(linked.values()) == {0}


def test_paragraph_edge_cases(odd_docs, no_docs, make_docs):
    repeated_paragraphs(odd_docs).collect()
    assert repeated_paragraphs(no_docs).count() == 0
    text = " ".join(f"u{i}" for i in range(80))
    assert repeated_paragraphs(make_docs([text, text, None], ids=[1, 1, None])).count() == 0  # one document, twice
    assert {r["original_doc_id"] for r in repeated_paragraphs(make_docs([text, text], ids=[9, 4])).collect()} == {4}


# --------------------------------------------------------------- n-gram join


def _sets(texts):
    out = []
    for t in texts:
        w = (t or "").encode().lower().split()
        out.append(frozenset(tuple(w[i : i + 5]) for i in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)] if w else []))
    return out


def _expected(ids, texts):
    sets = _sets(texts)
    pairs = [
        (ids[i], ids[j])
        for i in range(len(sets))
        for j in range(i)
        if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j])
    ]
    roots = _components(pairs, ids)
    return {i: (len(s), roots[i]) for i, s in zip(ids, sets, strict=True)}


def test_shingle_sets_and_parity_bound():
    rng = random.Random(6)
    texts = [_line(rng, n) for n in (0, 1, 4, 5, 6, 40, 300)] + [None, "A a A a A a A a"]
    got = {row: s for row, s in shingle_sets(pa.array(texts))}
    assert {i: len(s) for i, s in enumerate(_sets(texts)) if s} == {i: len(s) for i, s in got.items()}
    a = np.unique(np.random.default_rng(1).integers(0, 2**63, 900, dtype=np.uint64))
    for keep in (900, 850, 500):
        b = np.concatenate([a[:keep], np.random.default_rng(2).integers(0, 2**63, 30, dtype=np.uint64)])
        true = len(np.setxor1d(a, b))
        assert least_difference(parity_bitmap(a), parity_bitmap(np.unique(b))) <= true


def test_join_equals_brute_force_around_the_threshold(make_docs):
    rng = random.Random(7)
    texts = []
    for _ in range(25):
        base = rng.choices([f"t{k}" for k in range(3000)], k=rng.randint(1, 120))
        for _ in range(rng.randint(1, 6)):
            copy = list(base)
            for _ in range(rng.choice([0, 0, 1, 1, 2, 3, 6])):
                copy[rng.randrange(len(copy))] = f"n{rng.randrange(10**6)}"
            texts.append(" ".join(copy).upper() if rng.random() < 0.3 else " ".join(copy))
    common = _line(rng, 40)
    texts += [_line(rng, rng.randint(20, 60)) + " " + common for _ in range(40)] + [None, "", "one", "one", "two words"]
    ids = rng.sample(range(10_000), len(texts))
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in ngram_components(make_docs(texts, ids)).collect()}
    assert got == _expected(ids, texts)


def test_join_of_a_large_group_of_near_copies_with_outliers(make_docs):
    rng = random.Random(8)
    base = rng.choices([f"t{k}" for k in range(3000)], k=100)
    texts = []
    for k in range(150):
        copy = list(base)
        for _ in range(1 if k < 110 else rng.choice([3, 4, 5, 8])):
            copy[rng.randrange(100)] = f"n{k}x{rng.randrange(99)}"
        texts.append(" ".join(copy))
    ids = list(range(500, 650))
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in ngram_components(make_docs(texts, ids)).collect()}
    assert got == _expected(ids, texts)


def test_join_edge_cases(odd_docs, no_docs, make_docs):
    rows = ngram_components(odd_docs).collect()
    assert len(rows) == odd_docs.count()
    by_id = {r["doc_id"]: r for r in rows}
    assert by_id[0]["n_shingles"] == 0 and by_id[0]["component_id"] == 0 and by_id[2]["component_id"] == 2
    assert by_id[90]["component_id"] == 90 and by_id[None]["component_id"] is None
    assert ngram_components(no_docs).count() == 0
    text = "a b c d e f g h"
    kept = keep_one_per_component(make_docs([text, text, text, text], ids=[5, 3, 3, None])).collect()
    assert [r["doc_id"] for r in kept] == [3, 3]
    other = "q r s t u v w x y"
    docs = make_docs([text, other, text, text, other, "", None], ids=[1, 1, 2, None, None, None, None]).withColumn("dropped", F.lit(1))
    kept = keep_one_per_component(docs).collect()
    # of one id's texts each stands for itself; copies without an id go too; empty texts stay
    assert sorted((str(r["doc_id"]), str(r["text"])) for r in kept) == [("1", text), ("1", other), ("None", ""), ("None", "None")]
    assert kept[0]["dropped"] == 1
    alone = keep_one_per_component(make_docs([text, text + " i j", other], ids=[None, None, None])).collect()
    assert len(alone) == 3  # 4 of 6 shingles
    assert len(keep_one_per_component(make_docs([text, text.upper(), other], ids=[None, None, None])).collect()) == 2
    assert keep_one_per_component(odd_docs).columns == odd_docs.columns


def test_band_rows_meet_in_few_bytes_and_every_shared_key_is_kept(spark, monkeypatch):
    monkeypatch.setattr("blotter.llm.substring_dedup.BLOCK_CLASSES", 500)
    docs = read_table(spark, SF_SMALL, "documents")
    blocks = band_blocks(docs, 6, 2, 41, 5).cache()
    sent = blocks.select(F.expr("sum(octet_length(key) + octet_length(c) + octet_length(n) + octet_length(sig))")).first()[0]
    held = collections.defaultdict(dict)
    for r in blocks.collect():
        key = np.cumsum(unpacked(pa.py_buffer(r["key"]), np.uint64))
        assert (key[1:] >= key[:-1]).all() and (key * 5 >> np.uint64(44) == r["bucket"]).all()
        n, sig = unpacked(pa.py_buffer(r["n"]), np.uint8), unpacked(pa.py_buffer(r["sig"]), np.int32)
        for k, c, about in zip(key.tolist(), unpacked(pa.py_buffer(r["c"]), np.int64).tolist(), zip(n.tolist(), sig.tolist(), strict=True), strict=True):
            held[k][c] = about
    classes = {c: int(ok.sum()) for row in docs.where("doc_id is not null").collect() for p in paragraphs(pa.array([row["text"]])) for c, ok in zip(p[3].tolist(), p[5], strict=True)}
    assert {c for x in held.values() for c in x} == set(classes) and sum(map(len, held.values())) == 6 * len(classes)
    want = {(k, c, *x[c], len(x)) for k, x in held.items() if len(x) > 1 for c in x}
    got = shared_bands(blocks).collect()
    blocks.unpersist()
    assert want and {(r["key"], r["c"], r["n"], r["sig"], r["size"]) for r in got} == want and len(got) == len(want)
    assert all(x[0] == classes[c] for k in held.values() for c, x in k.items())
    for r in got:
        for h in "hg":
            assert held[r["key"]][r[f"{h}_c"]] == (r[f"{h}_n"], r[f"{h}_sig"])
    assert len({(r["key"], r["h_c"], r["g_c"]) for r in got}) == len({r["key"] for r in got})
    assert sent < 18 * 6 * len(classes)  # a row of key, class, size and bitmap takes 24


def test_paragraphs_around_one_common_line_are_not_tested_pair_by_pair(make_docs, monkeypatch):
    # 17 of 21 shingles in common do not link; a few have a near copy
    rng = random.Random(8)
    line = [f"common{i}" for i in range(21)]
    texts = [" ".join([*line, *(f"own{i}x{j}" for j in range(4))]) for i in range(900)]
    texts += [t + "y" for t in rng.sample(texts, 40)]
    tested = []

    def counted(df, purpose, *more, stored=blocking.stored):
        out = stored(df, purpose, *more)
        if purpose == "pairs":
            tested.append(out.count())
        return out

    monkeypatch.setattr(blocking, "stored", counted)
    found = repeated_paragraphs(make_docs(texts)).collect()
    sets, places = {}, collections.defaultdict(set)
    for rows, firsts, _, cs, grams, valid in paragraphs(pa.array(texts)):
        for row, first, c, g, ok in zip(rows.tolist(), firsts.tolist(), cs.tolist(), grams, valid, strict=True):
            sets[c] = set(g[ok].tolist())
            places[c].add((row, first))
    near = [(a, b) for a in sets for b in sets if a < b and 10 * len(sets[a] & sets[b]) >= 8 * len(sets[a] | sets[b])]
    groups = collections.defaultdict(set)
    for c, root in _components(near, sets).items():
        groups[root] |= places[c]
    want = {(place, min(g)) for g in groups.values() if len(g) > 1 for place in g}
    assert {((r["doc_id"], r["first_word"]), (r["original_doc_id"], r["original_word"])) for r in found} == want
    assert len(near) >= 40 and sum(tested) < 12 * len(sets)


def test_sets_that_link_meet_in_a_prefix(spark):
    rng = random.Random(9)
    base = [rng.sample(range(1, 2**62), 21) for _ in range(12)]
    sets = {}
    for c in range(400):
        own = rng.sample(base[c % 12], rng.randint(17, 21))
        sets[c] = sorted({*own, *(rng.randrange(1, 2**62) for _ in range(rng.randint(0, 2)))})
    rows = [(c % 2, c, len(s), 0) for c, s in sets.items()]
    kept = spark.createDataFrame(list(sets.items()), "c long, grams array<long>")
    held = collections.defaultdict(list)
    for r in prefix_rows(spark.createDataFrame(rows, "key long, c long, n int, sig int"), kept, 0.8).collect():
        held[r["key"]].append(r)
    met = {(x["c"], y["c"]) for rs in held.values() for x in rs for y in rs if x["short"] or y["short"] if min(x["rest"], y["rest"]) * 9 >= 4 * (x["n"] + y["n"])}
    linked = {(a, b) for a in sets for b in sets if a != b and a % 2 == b % 2 and 10 * len({*sets[a]} & {*sets[b]}) >= 8 * len({*sets[a]} | {*sets[b]})}
    assert len(linked) > 200 and linked <= met


def test_bitmaps_that_differ_in_their_sign_count_as_one_bit(spark):
    rows = spark.createDataFrame([(1, 5, 21, 7), (1, 6, 21, 7 - 2**31)], "key long, c long, n int, sig int")
    about = ["c", "n", "sig"]
    pairs = rows.toDF("key", "x_c", "x_n", "x_sig").join(rows.toDF("key", "y_c", "y_n", "y_sig"), "key")
    assert pairs.where(blocking.may_link("x_", "y_", about, 0.8)).count() == 2


def test_shingles_are_counted_before_they_become_rows(spark):
    from blotter.llm.substring_dedup import CELL_BITS, PIECE, cell_counts, shingle_ranks

    rng = random.Random(10)
    common = [rng.randrange(-(2**63), 2**63) for _ in range(30)]
    sets = [(c, [*rng.sample(common, 9), *(rng.randrange(-(2**63), 2**63) for _ in range(rng.randint(0, 12)))]) for c in range(6000)]
    for n in (300, 6000):
        kept = spark.createDataFrame(sets[:n], "c long, grams array<long>").coalesce(3)
        want = collections.Counter((g % 2**64) >> (64 - CELL_BITS) for _, gs in sets[:n] for g in gs)
        rows = cell_counts(kept).collect()
        # twenty times the sets make no more rows: one for a task and piece
        assert len(rows) <= 3 * (1 << CELL_BITS) // PIECE < 9 * n
        got = collections.Counter()
        for r in rows:
            for at, k in enumerate(unpacked(pa.py_buffer(r["counts"]), np.int64).tolist()):
                got[r["piece"] * PIECE + at] += k
        assert +got == want
        ranks = shingle_ranks(kept)
        assert len(ranks) == 1 << CELL_BITS
        assert {cell: int(ranks[cell]) for cell in want} == {cell: round(np.log2(k) * 3) for cell, k in want.items()}
    assert not shingle_ranks(kept.limit(0)).any()
