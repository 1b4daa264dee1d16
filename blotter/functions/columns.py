"""Column expressions shared across the library.

All of them compile to JVM expressions (no UDF), so a projection built from
them is a single whole-stage-codegen span next to the Parquet scan.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the text form of incident timestamps in the source CSV
# (12-hour clock with AM/PM marker).
TIMESTAMP_TEXT_FORMAT = "MM/dd/yyyy hh:mm:ss a"

_TWO_POW_32 = float(2**32)


def _as_col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def hash_uniform(key: Column | str, salt: str) -> Column:
    """Uniform double in [0, 1) drawn from ``key`` and ``salt``.

    The first 32 bits of ``md5(key || ':' || salt)`` divided by 2^32. It
    depends only on the row's key, never on partitioning, task order or a
    seed stream, so a re-run after an executor loss, a ``repartition(n)`` or
    another engine gives the same value. The integer is below 2^32, so the
    division is exact in double precision; DuckDB computes the same number
    with ``('0x' || substr(md5(..), 1, 8))::BIGINT / 4294967296.0``.
    """
    text = F.concat(_as_col(key).cast("string"), F.lit(":" + salt))
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("bigint") / F.lit(_TWO_POW_32)


def hour_of_text(text: Column | str, fmt: str = TIMESTAMP_TEXT_FORMAT) -> Column:
    """Hour (0-23) of a text timestamp; NULL for empty or unparsable text.

    ``try_to_timestamp`` keeps the NULL-on-bad-input behaviour under ANSI
    mode, where ``to_timestamp`` would fail the task. The text is read in the
    session time zone and the hour is taken in the same zone, so the result
    does not depend on the zone except for wall-clock times that do not exist
    in it (DST gaps); jobs pin UTC.
    """
    return F.hour(F.try_to_timestamp(_as_col(text), F.lit(fmt))).cast("int")


def bool_from_text(c: Column | str) -> Column:
    """Boolean from text in any case (true/false, t/f, yes/no, 1/0); NULL for
    anything else, such as 'Unknown', instead of an ANSI cast error."""
    return F.trim(_as_col(c)).try_cast("boolean")


def label_of(flag: Column | str) -> Column:
    """0/1 integer label from a boolean flag; NULL stays NULL."""
    return _as_col(flag).cast("int")


def clamp(c: Column, lo: float, hi: float) -> Column:
    """``c`` limited to the closed range [lo, hi]."""
    return F.least(F.lit(hi), F.greatest(F.lit(lo), c))


def text_bar(value: Column | str, marks_per_unit: int = 50, mark: str = "#") -> Column:
    """Text bar of ``round(value * marks_per_unit)`` marks (one mark per 2% at
    the default 50). ``bround`` rounds halves to even, like Python's
    ``round``."""
    n = F.bround(_as_col(value) * F.lit(float(marks_per_unit)), 0).cast("int")
    return F.repeat(F.lit(mark), F.greatest(n, F.lit(0)))
