"""Secret scan and benchmark decontamination against brute force."""

import hashlib
import itertools
import math
import random
import re
import string
from collections import Counter

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from blotter.llm.decontamination import MASKS, STRETCH, SUBSTITUTIONS, decontaminate, equal_words, find_contamination
from blotter.llm.frames import read_table
from blotter.llm.secret_scan import KINDS, entropy_spans, least_entropy, scan_secrets, scan_text, window_entropies
from tests.conftest import SF_MID, SF_SMALL

_ASSIGN = re.compile(r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.A)


def _base(text):
    found = [(m.start(), 0, m.end()) for m in _ASSIGN.finditer(text) if len(m.group(2)) >= 6]
    found += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m.group()) >= 20]
    found += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m.group()) >= 24]
    return [f"{KINDS[k]}:{s}:{e}" for s, k, e in sorted(found)]


PIECES = ["token", "API_KEY", "PassWord", "secret=", " = ", ":", '"', "'", "é", "abcdef", "=x", "AKIA", "ABCDEFGH12345678", "0123456789abcdef01234567", " ", "ſecret", "\n"]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from(PIECES), max_size=12).map("".join))
def test_base_spans_equal_the_patterns(text):
    n_assign, n_access, n_hex, digest, spans, _ = scan_text(text)
    want = _base(text)
    assert digest == hashlib.sha256(",".join(want).encode()).hexdigest()
    assert [x for x in spans.split(",") if x and not x.startswith("entropy")] == want
    assert (n_assign, n_access, n_hex) == tuple(sum(x.startswith(k + ":") for x in want) for k in KINDS[:3])


@settings(max_examples=60, deadline=None)
@given(st.binary(min_size=20, max_size=60))
def test_incremental_entropy_equals_its_definition(run):
    want = []
    for i in range(len(run) - 19):
        c = Counter(run[i : i + 20])
        want.append(-sum(n / 20 * math.log2(n / 20) for n in c.values()))
    assert window_entropies(run) == pytest.approx(want, abs=1e-9)


def test_entropy_finds_keys_and_the_allow_list_suppresses():
    key = "q7Zp2Lx9Vt4Kd8Rb1Nf6Wm3Yc5Hg0Js"
    assert entropy_spans(f"see {key} here".encode()) == [(4, 4 + len(key))]
    for harmless in ("entscheidungsverfahrenheit", "123456789012345678901234", "3f2b8c1e-5d4a-4b6f-9e8d-7c6b5a493827", "module-name_of-some-thing2", "q7Zp2Lx9example8Rb1Nf6Wm3Yc5Hg0Js"):
        assert entropy_spans(harmless.encode()) == []
    text = f"é {key} é"
    assert scan_text(text)[4] == f"entropy:2:{2 + len(key)}"


def test_a_sample_part_suppresses_only_the_windows_that_touch_it():
    key = "aB3xK9qLm2Zt7Rw5Yc8Vd1Nf"
    assert entropy_spans(f"/sample/{key}".encode()) == [(7, 8 + len(key))]  # from the slash on
    assert entropy_spans(f"{key}/example/0{key}".encode()) == [(0, len(key) + 1), (len(key) + 8, 2 * len(key) + 10)]


@pytest.mark.parametrize(("letters", "share"), [("0123456789abcdef", 0.02), (string.ascii_lowercase + string.digits, 0.02), (string.ascii_letters + string.digits + "+/", 0.02)])
def test_few_random_windows_are_missed(letters, share):
    rng = random.Random(8)
    runs = ["".join(rng.choices(letters, k=20)) for _ in range(4000)]
    missed = sum(max(window_entropies(r.encode())) < least_entropy(len(letters)) for r in runs)
    assert missed <= share * len(runs)


def test_scan_edge_cases(odd_docs, no_docs):
    rows = scan_secrets(odd_docs).collect()
    assert len(rows) == odd_docs.count()
    assert all(r["base_sha256"] == hashlib.sha256(b"").hexdigest() and r["spans"] == "" for r in rows)
    assert scan_secrets(no_docs).count() == 0


def test_masks_miss_no_stretch_with_allowed_substitutions():
    for wrong in itertools.combinations(range(STRETCH), SUBSTITUTIONS):
        assert any(
            all(m != "1" or o + i not in wrong for i, m in enumerate(mask)) for mask in MASKS for o in range(STRETCH - len(mask) + 1)
        ), wrong


def _brute(docs, items):
    found = set()
    for d, text in docs:
        words = (text or "").lower().split()
        for i, item in items:
            n = len((item or "").split())
            if n >= 5 and any(equal_words((text or "").encode(), item.encode(), s) for s in range(-n, len(words) + 1)):
                found.add((d, i))
    return found


def test_contamination_equals_brute_force_on_planted_texts(spark, make_docs):
    import random

    rng = random.Random(5)
    vocabulary = [f"w{k}" for k in range(60)]
    items = [(k, " ".join(rng.choices(vocabulary, k=n))) for k, n in enumerate([5, 8, 12, 13, 14, 20, 30, 40])] + [(50, "w1 w2"), (51, None), (52, "")]
    texts = []
    for _ in range(150):
        words = rng.choices(vocabulary, k=rng.randint(0, 60))
        _, item = rng.choice(items[:8])
        own = item.split()
        for at in rng.sample(range(len(own)), k=min(len(own), rng.choice([0, 0, 1, 2, 3, 5]))):
            own[at] = "other"
        cut = rng.randint(0, len(words))
        texts.append(" ".join(words[:cut] + [x.upper() for x in own] + words[cut:]))
    docs = make_docs(texts)
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    got = {(r["doc_id"], r["item_id"]) for r in find_contamination(docs, benchmark).collect()}
    want = _brute(enumerate(texts), items)
    assert got == want and len(want) > 50
    kept = {r["doc_id"] for r in decontaminate(docs, benchmark).collect()}
    assert kept == set(range(150)) - {d for d, _ in want}


def test_contamination_equals_brute_force_on_the_tables(spark):
    docs, benchmark = read_table(spark, SF_SMALL, "documents"), read_table(spark, SF_SMALL, "benchmark")
    got = {(r["doc_id"], r["item_id"]) for r in find_contamination(docs, benchmark).collect()}
    assert got == _brute([(r["doc_id"], r["text"]) for r in docs.collect()], [(r["item_id"], r["text"]) for r in benchmark.collect()])


def test_decontamination_edge_cases(spark, odd_docs, no_docs, make_docs):
    benchmark = read_table(spark, SF_MID, "benchmark")
    empty = benchmark.limit(0)
    assert find_contamination(odd_docs, benchmark).count() == 0
    assert decontaminate(odd_docs, empty).count() == odd_docs.count()
    assert decontaminate(odd_docs, benchmark).columns == odd_docs.columns
    assert decontaminate(no_docs, benchmark).count() == 0
    item = benchmark.where("text is not null").first()["text"]
    docs = make_docs([item, item, item, "clean text"], ids=[None, 7, 7, None])
    assert [r["text"] for r in decontaminate(docs, benchmark).collect()] == ["clean text"]
