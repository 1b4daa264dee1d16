"""Rule statistics of one text, shared by the quality operators."""

from __future__ import annotations

import numpy as np

SYMBOLS = b"#*$%&|<>"
UPPER = bytes(range(65, 91))
DIGITS = bytes(range(48, 58))
#: Order of the values in ``statistics(...)[1]``.
FEATURES = (
    "log_words",
    "word_chars_mean",
    "symbol_share",
    "upper_share",
    "digit_share",
    "dup_line_share",
    "repeat_share",
    "distinct_share",
    "echo_share",
    "mark_share",
    "log_line_words",
    "unended_share",
)


def repeated_words(words: list[bytes]) -> int:
    """Words inside 5-word windows that occur twice or more in ``words``."""
    windows = list(zip(words, words[1:], words[2:], words[3:], words[4:], strict=False))
    if len(set(windows)) == len(windows):
        return 0
    seen: set = set()
    again: set = set()
    for w in windows:
        (again if w in seen else seen).add(w)
    covered, upto = 0, 0
    for i, w in enumerate(windows):
        if w in again:
            covered += i + 5 - max(upto, i)
            upto = i + 5
    return covered


def statistics(text: str | None) -> tuple[tuple[int, int, int, int, int], list[float]]:
    """((n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words),
    FEATURES values). Null counts as empty; shares of nothing are 0."""
    text = text or ""
    data = text.encode("utf-8", "replace")
    words = data.split()
    joined = b"".join(words)
    n, size = len(words), max(1, len(joined))
    word_chars = len(text) - (len(data) - len(joined))
    n_symbols = len(data) - len(data.translate(None, SYMBOLS))
    lines = [x for x in data.split(b"\n") if x.strip()]
    n_dup = len(lines) - len(set(lines))
    n_repeat = repeated_words(words)
    per_word = 1 / max(1, n)
    upper = size - len(joined.translate(None, UPPER)) if joined else 0
    digits = size - len(joined.translate(None, DIGITS)) if joined else 0
    plain = len(joined.translate(None, b".,!?;:'\"-()/+@=[]_~^\\`{}" + SYMBOLS)) if joined else 0
    marks = size - plain if joined else 0
    echo = sum(a == b for a, b in zip(words, words[1:], strict=False))
    ended = sum(x.rstrip()[-1:] in b".!?\"'" for x in lines)
    features = [
        float(np.log1p(n)),
        word_chars * per_word,
        n_symbols / size,
        upper / size,
        digits / size,
        n_dup / max(1, len(lines)),
        n_repeat * per_word,
        len(set(words)) / max(1.0, n**0.8),
        echo * per_word,
        marks / size,
        float(np.log1p(n / max(1, len(lines)))),
        1 - ended / max(1, len(lines)),
    ]
    return (n, word_chars, n_symbols, n_dup, n_repeat), features
