"""The vectorised word splitter against bytes.split, and the rule statistics."""

import collections

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from blotter.llm.textbatch import split_words, text_slices
from blotter.llm.textstats import repeated_words, statistics
from tests.llm.conftest import ODD_TEXTS

TEXT = st.text(st.sampled_from("abAB \t\n\x0b\x0c\r é#."), max_size=40)


@settings(max_examples=100, deadline=None)
@given(st.lists(st.one_of(st.none(), TEXT), max_size=8))
def test_words_and_windows_equal_plain_splitting(texts):
    column = pa.array(texts, pa.string())
    for a, b, data, offsets in text_slices(column):
        words = split_words(data, offsets, lower=True)
        want = [(t or "").encode().lower().split() for t in texts[a:b]]
        assert [len(w) for w in want] == np.diff(words.first).tolist()
        flat = [w for ws in want for w in ws]
        number = {}
        ours = {}
        for w, h in zip(flat, words.hashes.tolist(), strict=True):
            assert ours.setdefault(w, h) == h and number.setdefault(h, w) == w
        hashes, bounds = words.windows(3)
        grams = [[tuple(ws[i : i + 3]) for i in range(len(ws) - 2)] for ws in want]
        assert [len(g) for g in grams] == np.diff(bounds).tolist()
        assert len(set(hashes.tolist())) == len({g for gs in grams for g in gs})


def _statistics(text):
    text = text or ""
    words = text.encode().split()
    points = sum(len(w.decode()) for w in words)
    lines = [x for x in text.split("\n") if x.encode().split()]
    dup = sum(x in lines[:i] for i, x in enumerate(lines))
    windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    count = collections.Counter(windows)
    covered = {j for i, w in enumerate(windows) if count[w] > 1 for j in range(i, i + 5)}
    return len(words), points, sum(c in "#*$%&|<>" for c in text), dup, len(covered)


@settings(max_examples=150, deadline=None)
@given(st.one_of(st.none(), st.text(st.sampled_from("ab \n é#"), max_size=60)))
def test_rule_statistics_equal_their_definition(text):
    assert statistics(text)[0] == _statistics(text)


def test_rule_statistics_of_odd_texts():
    for text in ODD_TEXTS[:5] + ODD_TEXTS[6:]:
        assert statistics(text)[0] == _statistics(text)
    assert repeated_words(ODD_TEXTS[5].encode().split()) == 50_000
