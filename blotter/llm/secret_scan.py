"""Secret scan: fixed patterns plus sliding-window Shannon entropy.

Base spans come from three patterns (assignments to secret-like names, access
key ids, long hex runs). The method adds candidate strings: maximal runs of
key characters. A window slides over each; its character counts are updated
by one character in and one out, and with them the sum of c*log2(c), so each
step costs O(1). Windows whose entropy reaches the threshold of the run's
character class are merged to a span; all but one in a hundred windows of evenly
drawn characters of the class reach it. An allow-list suppresses runs that are
known not to be secrets, and in other runs the windows that touch a part that
marks samples; base spans are never suppressed, and an entropy span inside a base
span adds nothing and is left out.

Spans are code-point offsets, end exclusive, written ``kind:start:end``.

Edge cases: null and empty texts have no spans (the digest of no spans is the
SHA-256 of the empty string); null ids and repeated rows keep their own rows;
texts of any length are scanned whole; an empty table gives an empty result.
"""

from __future__ import annotations

import functools
import hashlib
import math
import re
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from blotter.llm.frames import map_texts

# The contract's patterns and least lengths, in its order.
ASSIGN = re.compile(rb"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([a-z0-9+/_.=-]+)""")
ACCESS = re.compile(rb"AKIA[A-Z0-9]+")
HEX = re.compile(rb"[0-9a-f]{24,}")
ASSIGN_MIN, ACCESS_MIN = 6, 20
KINDS = ("assign", "access", "hex", "entropy")

RUN = re.compile(rb"[A-Za-z0-9+/_=-]{20,}")
WINDOW = 20
#: Share of random windows whose entropy is under their class's threshold.
MISS = 0.01
#: Character classes of runs, narrowest first, with their number of characters.
CLASSES = (
    (re.compile(rb"[0-9a-fA-F]+"), 16),
    (re.compile(rb"[a-z0-9]+|[A-Z0-9]+"), 36),
    (re.compile(rb"[A-Za-z0-9+/_=-]+"), 64),
)
#: Runs that are not secrets: plain words and numbers, UUIDs, dashed or
#: underscored names, rulers.
ALLOW = (
    re.compile(rb"[A-Za-z+/_=-]+"),
    re.compile(rb"[0-9+/_=-]+"),
    re.compile(rb"[0-9a-fA-F]{8}(-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}"),
    re.compile(rb"[A-Za-z]+[0-9]{0,4}([-_/][A-Za-z]+[0-9]{0,4})*"),
)
#: Parts that mark the windows they touch as a sample.
ALLOW_PART = re.compile(rb"(?i)example|sample|placeholder|lorem|your_|xxxx|abcdefgh|12345678")

FIELDS = [
    pa.field("n_assign", pa.int64()),
    pa.field("n_access", pa.int64()),
    pa.field("n_hex", pa.int64()),
    pa.field("base_sha256", pa.string()),
    pa.field("spans", pa.string()),
    pa.field("n_entropy", pa.int64()),
]
SCHEMA = "n_assign long, n_access long, n_hex long, base_sha256 string, spans string, n_entropy long"


@functools.cache
def least_entropy(letters: int, width: int = WINDOW, draws: int = 20_000) -> float:
    """The ``MISS`` quantile of the entropy, in bits, of windows of ``width``
    characters drawn evenly from ``letters``, by a seeded simulation."""
    windows = np.random.default_rng(letters).integers(0, letters, (draws, width))
    counts = np.bincount((np.arange(draws)[:, None] * letters + windows).ravel(), minlength=draws * letters).reshape(draws, letters)
    share = np.where(counts, counts, width) / width
    return float(np.quantile(-(share * np.log2(share)).sum(1), MISS)) - 1e-9


def window_entropies(run: bytes, width: int = WINDOW) -> list[float]:
    """Shannon entropy of every window of ``width`` bytes, from counts that
    change by one byte in and one out."""
    weight = [0.0] + [c * math.log2(c) for c in range(1, width + 1)]
    counts = Counter(run[:width])
    total = sum(weight[c] for c in counts.values())
    base, out = math.log2(width), []
    for i in range(len(run) - width + 1):
        out.append(base - total / width)
        if i + width < len(run):
            for byte, by in ((run[i], -1), (run[i + width], 1)):
                c = counts[byte]
                total += weight[c + by] - weight[c]
                counts[byte] = c + by
    return out


def entropy_spans(data: bytes) -> list[tuple[int, int]]:
    """Byte spans of high entropy in candidate runs; allow-listed runs and the
    windows that touch an allow-listed part are out."""
    spans: list[tuple[int, int]] = []
    for m in RUN.finditer(data):
        run = m.group()
        if any(a.fullmatch(run) for a in ALLOW):
            continue
        least = least_entropy(next(letters for cls, letters in CLASSES if cls.fullmatch(run)))
        barred = bytearray(len(run))
        for part in ALLOW_PART.finditer(run):
            first = max(0, part.start() - WINDOW + 1)
            barred[first : part.end()] = b"\x01" * (part.end() - first)
        for i, bits in enumerate(window_entropies(run)):
            if bits >= least and not barred[i]:
                start, end = m.start() + i, m.start() + i + WINDOW
                if spans and start <= spans[-1][1]:
                    spans[-1] = (spans[-1][0], end)
                else:
                    spans.append((start, end))
    return spans


def find_spans(data: bytes) -> list[tuple[int, int, int]]:
    """(start, kind number, end) in bytes, by start and kind."""
    low = data.lower()  # ASCII letters only; positions stay
    found = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(low) if m.end(2) - m.start(2) >= ASSIGN_MIN]
    if b"AKIA" in data:
        found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(data) if m.end() - m.start() >= ACCESS_MIN]
    found += [(m.start(), 2, m.end()) for m in HEX.finditer(data)]
    base = sorted(found)
    for s, e in entropy_spans(data):
        if not any(b[0] <= s and e <= b[2] for b in base):
            found.append((s, 3, e))
    return sorted(found)


def scan_text(text: str | None) -> tuple:
    text = text or ""
    data = text.encode("utf-8", "replace")
    found = find_spans(data)
    place = {}
    if found and len(data) != len(text):
        at = points = 0
        for o in sorted({o for s, _, e in found for o in (s, e)}):
            points += len(data[at:o].decode("utf-8", "replace"))
            place[o], at = points, o
    named = [(k, f"{KINDS[k]}:{place.get(s, s)}:{place.get(e, e)}") for s, k, e in found]
    kinds = Counter(k for k, _ in named)
    base = ",".join(x for k, x in named if k < 3)
    return kinds[0], kinds[1], kinds[2], hashlib.sha256(base.encode()).hexdigest(), ",".join(x for _, x in named), kinds[3]


def scan_secrets(docs: DataFrame) -> DataFrame:
    """(doc_id, n_assign, n_access, n_hex, base_sha256, spans, n_entropy) per
    document; one pass, no shuffle."""
    return map_texts(docs, scan_text, FIELDS, SCHEMA)
