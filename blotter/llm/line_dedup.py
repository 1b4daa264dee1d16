"""Line dedup over content-defined chunks of lines, in DataFrame functions.

A text is cut into lines; each line has a hash, and a rolling hash runs over the
hashes of every line and the next. A pair of lines is a boundary where its
rolling hash is the least of some ``window`` adjacent pairs, or where the pair
has ``max_chars`` characters; the ends of a text are boundaries too. From each
boundary a chunk goes on, and another one goes back, for the fewest lines that
make two and ``min_chars`` characters. Boundaries follow the lines of a window
alone, so inserted or removed lines shift nothing beyond it: with a window of
two, a repeated run of three lines or more holds the same boundaries wherever it
stands and chunks cover all but, at times, its first or last line; with a window
of one every pair is a boundary, and no repeated run is missed.

Chunks whose 64-bit hash occurs more than once are compared byte for byte with
the first occurrence (smallest id, then text hash and position). Every line of a
later equal chunk is removed; a line's own first place stays.

Hashes are counted by a partial aggregate, so a chunk that a third of all
documents share is one row per task. Only places travel until then; the bytes
are cut again from the texts that hold a repeated hash. Bitmaps of fixed size
(4 MB) tell those texts from most others, which then take part in no shuffle; a
bit that a text shares with another one costs a shuffle of it and nothing else.
The comparison and the rebuild are equi-joins that AQE can split.

Edge cases: a null text stays null; an empty text or one without repeated
chunks stays as it is; a document may become empty but its row stays; rows of
equal id and text are one document (a repeated row never removes its twin's
lines); rows with a null id count as documents of their own text; an empty
table gives an empty result; all other columns pass through.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from blotter.llm.frames import stored

WINDOW = 2
MIN_CHARS, MAX_CHARS = 40, 100
#: Rolling hashes are residues of this prime.
PRIME = 4_294_967_291
#: Bits for texts by their hash: 1,024 bitmaps of 4 KB.
TEXT_BITS = 1 << 25


def boundary_pairs(lines: Column, lengths: Column, window: int, max_chars: int) -> Column:
    """Per pair of adjacent lines, whether it is a boundary. Arrays go through
    ``zip_with``, so that each is made once and not once per element."""
    pairs = F.size(lines) - 1
    hashes = F.transform(lines, lambda x: F.conv(F.substring(F.md5(x), 1, 8), 16, 10).cast("long"))
    rolling = F.zip_with(F.slice(hashes, 1, pairs), F.slice(hashes, 2, pairs), lambda a, b: (31 * a + b) % PRIME)
    chosen = F.zip_with(F.slice(lengths, 1, pairs), F.slice(lengths, 2, pairs), lambda a, b: a + b + 1 >= max_chars)
    for first in range(1 - window, 1):  # the windows that hold a pair
        least = rolling
        for k in range(first, first + window):
            least = F.zip_with(least, _shifted(rolling, pairs, k), lambda a, b: F.least(a, b)) if k else least
        chosen = F.zip_with(chosen, F.zip_with(rolling, least, lambda r, m: r <= m), lambda a, b: a | b)
    return chosen


def _shifted(values: Column, size: Column, k: int) -> Column:
    """Element i + k at place i; beyond the ends, the prime."""
    pad = F.array_repeat(F.lit(PRIME).cast("long"), F.least(F.lit(abs(k)), size))
    left = F.greatest(size - abs(k), F.lit(0))
    return F.concat(F.slice(values, 1 + k, left), pad) if k > 0 else F.concat(pad, F.slice(values, 1, left))


def _line_runs(lines: Column, lengths: Column, min_chars: int) -> tuple[Column, Column]:
    """Per line, (first, last) of the shortest run of two lines or more and of
    ``min_chars`` characters from it on, and of the one up to it. As line
    breaks count, none has more than ``min_chars`` + 1 lines."""
    last_line = F.size(lines) - 1

    def reach(i: Column, step: int) -> Column:
        stop = F.least(i + min_chars, last_line) if step > 0 else F.greatest(i - min_chars, F.lit(0))
        begin = F.struct(F.get(lengths, i).alias("chars"), F.lit(None).cast("int").alias("at"))

        def add(run: Column, k: Column) -> Column:
            chars = run["chars"] + 1 + F.get(lengths, k)
            return F.when(run["at"].isNotNull(), run).otherwise(F.struct(chars.alias("chars"), F.when(chars >= min_chars, k).alias("at")))

        pair = F.get(lengths, i) + 1 + F.get(lengths, i + step) >= min_chars
        search = F.aggregate(F.sequence(i + step, stop, F.lit(step)), begin, add, lambda run: run["at"])
        return F.when(i == (last_line if step > 0 else 0), F.lit(None).cast("int")).when(pair, i + step).otherwise(search)

    every = F.sequence(F.lit(0), last_line)
    onward = F.transform(every, lambda i: F.struct(i.alias("first"), reach(i, 1).alias("last")))
    upto = F.transform(every, lambda i: F.struct(reach(i, -1).alias("first"), i.alias("last")))
    return onward, upto


def chunk_runs(lines: Column, lengths: Column, window: int, min_chars: int, max_chars: int) -> Column:
    """Distinct (first, last) lines of the chunks of a text of two lines or more."""
    bounds = boundary_pairs(lines, lengths, window, max_chars)
    onward, upto = _line_runs(lines, lengths, min_chars)
    edge = F.array(F.lit(False))
    at = lambda runs, marks: F.zip_with(runs, marks, lambda r, b: F.when(b & r["first"].isNotNull() & r["last"].isNotNull(), r))
    both = F.concat(at(onward, F.concat(bounds, edge)), at(upto, F.concat(edge, bounds)))
    return F.array_distinct(F.filter(both, F.isnotnull))


def _body(r: Column) -> Column:
    # elements by position: a slice would copy the whole array for each run
    return F.array_join(F.transform(F.sequence(r["first"], r["last"]), lambda k: F.get("lines", k)), "\n")


def text_bitmaps(places: DataFrame) -> DataFrame:
    """(bucket, bitmap): one bit per residue of a text hash, at most 4 MB."""
    spot = F.pmod("text_hash", F.lit(TEXT_BITS))
    return places.groupBy(F.shiftright(spot, 15).alias("bucket")).agg(F.bitmap_construct_agg(spot.bitwiseAND(F.lit(32767))).alias("bitmap"))


def flagged(rows: DataFrame, text_hash: str, bitmaps: DataFrame) -> DataFrame:
    """``rows`` and ``flag``: false only for texts that have no place."""
    spot = F.pmod(F.col(text_hash), F.lit(TEXT_BITS))
    bit = spot.bitwiseAND(F.lit(32767))
    byte = F.conv(F.hex(F.substring("bitmap", F.shiftright(bit, 3) + 1, F.lit(1))), 16, 10).cast("long")
    met = rows.join(F.broadcast(bitmaps), F.shiftright(spot, 15) == F.col("bucket"), "left")
    is_set = F.coalesce(F.getbit(byte, F.pmod(bit, F.lit(8)).cast("int")) == 1, F.lit(False))
    return met.withColumn("flag", is_set).drop("bucket", "bitmap")


def repeated_lines(docs: DataFrame, window: int = WINDOW, min_chars: int = MIN_CHARS, max_chars: int = MAX_CHARS) -> tuple[DataFrame, DataFrame]:
    """(id, text_hash, pos) of the lines in a chunk that occurs earlier, and
    bitmaps that hold the texts of all repeated hashes."""
    texts = docs.where(F.contains("text", F.lit("\n"))).select(F.col("doc_id").alias("id"), F.xxhash64("text").alias("text_hash"), "text")
    split = texts.select("id", "text_hash", F.split("text", "\n", -1).alias("lines"))
    measured = split.withColumn("lengths", F.transform("lines", F.length))
    runs = measured.withColumn("runs", chunk_runs(F.col("lines"), F.col("lengths"), window, min_chars, max_chars))
    keyed = F.transform("runs", lambda r: F.struct(F.xxhash64(_body(r)).alias("key"), r["first"].alias("pos"), r["last"].alias("last")))
    wide = stored(runs.select("id", "text_hash", F.inline(keyed)), "line-hashes")  # numbers only; read twice
    place = F.struct("id", "text_hash", "pos")
    repeated = wide.groupBy("key").agg(F.min(place).alias("begin"), F.max(place).alias("top")).where(~F.col("begin").eqNullSafe(F.col("top")))
    met = wide.join(repeated.select("key", "begin"), "key")
    run = F.struct("key", F.col("pos").alias("first"), "last", place.eqNullSafe(F.col("begin")).alias("is_first"))
    places = stored(met.groupBy("id", "text_hash").agg(F.collect_set(run).alias("runs")), "line-places")
    bitmaps = stored(text_bitmaps(places), "line-bitmaps")
    # the bytes of the chunks found, cut again from their texts
    some = flagged(texts, "text_hash", bitmaps).where("flag")
    held = places.withColumnsRenamed({"id": "i", "text_hash": "h"}).join(some, F.col("i").eqNullSafe(F.col("id")) & (F.col("h") == F.col("text_hash")))
    again = held.select("id", "text_hash", "runs", F.split("text", "\n", -1).alias("lines"))
    bodies = F.transform("runs", lambda r: F.struct(r["key"].alias("key"), r["first"].alias("pos"), r["last"].alias("last"), r["is_first"].alias("is_first"), _body(r).alias("body")))
    found = stored(again.select("id", "text_hash", F.inline(bodies)), "line-chunks")
    original = found.where("is_first").groupBy("key").agg(F.min("body").alias("original"))
    later = found.where("not is_first").join(original, "key").where("body = original")
    return later.select("id", "text_hash", F.explode(F.sequence("pos", "last")).alias("pos")), bitmaps


def dedup_lines(docs: DataFrame, window: int = WINDOW, min_chars: int = MIN_CHARS, max_chars: int = MAX_CHARS, count_as: str | None = None) -> DataFrame:
    """``docs`` with the lines of repeated chunks cut out of ``text``; with
    ``count_as``, the number of lines removed in a further column."""
    cuts, bitmaps = repeated_lines(docs.select("doc_id", "text"), window, min_chars, max_chars)
    removed = cuts.groupBy("id", "text_hash").agg(F.collect_set("pos").alias("cut"))
    own = F.struct(*(docs[c] for c in docs.columns)).alias("own")
    rows = docs.select(own, docs["doc_id"].alias("doc_key"), F.xxhash64(docs["text"]).alias("own_hash"))
    rows = flagged(rows, "own_hash", bitmaps)
    joined = rows.where("flag").join(removed, F.col("doc_key").eqNullSafe(F.col("id")) & (F.col("own_hash") == F.col("text_hash")), "left")
    text = F.col("own.text")
    split = joined.withColumn("lines", F.when(F.col("cut").isNotNull(), F.split(text, "\n", -1)))
    kept = F.transform(F.array_except(F.sequence(F.lit(0), F.size("lines") - 1), "cut"), lambda k: F.get("lines", k))
    cut_text = F.when(F.col("cut").isNull(), text).otherwise(F.array_join(kept, "\n"))

    def columns(new_text: Column, count: Column) -> list[Column]:
        out = [new_text.alias("text") if c == "text" else F.col("own").getField(c).alias(c) for c in docs.columns]
        return [*out, count.cast("long").alias(count_as)] if count_as else out

    touched = split.select(*columns(cut_text, F.coalesce(F.size("cut"), F.lit(0))))
    return touched.unionAll(rows.where("not flag").select(*columns(text, F.lit(0))))


def dedup_line_runs(docs: DataFrame, min_chars: int = MIN_CHARS) -> DataFrame:
    """``dedup_lines`` with a window of one: every repeated run of two lines
    and ``min_chars`` characters is cut whole."""
    return dedup_lines(docs, window=1, min_chars=min_chars)
