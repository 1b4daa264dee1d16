"""Candidate pairs from buckets without enumerating large buckets, and
connected components.

A bucket is a key that several sets share (a prefix n-gram, a band of a
signature). Pairs that may be linked share a bucket, but a bucket of a large
group of copies must not be expanded into all of its pairs. As only the
components of the links matter, pairs within one component need no test. A few
passes find the links:

1. every member of a bucket against two hubs: one drawn for each bucket anew, so
   that in a group that shares many buckets each member meets many others; and,
   where positions are known, the member with the least share of its set before
   the key. Of near copies that is the one with the fewest members of its own,
   which is the likeliest to be linked with any other;
2. where positions are not known, buckets whose members still are in different
   components are dealt into parts of at most about ``PART`` members, and the
   pairs of a part that may be linked and whose components differ are tested.
   Buckets of that size are then done;
3. in all others, all remaining pairs whose components differ. A hot bucket is
   dealt over several tasks.

In a bucket whose members have little more in common than the key (thousands of
sets around one passage), 3 still grows with the square of its size. A caller that
can name the members of the sets gives ``finer``, which deals the rows of large
buckets into finer ones, where rows that may be linked still meet: by the members
of a prefix (``prefix_keys``). They take the place of 3 and of the parts in 2, and
have hubs of their own.

What may be linked is decided within the joins, from sizes and, where rows carry
them, positions and bitmaps (``may_link``). No pair that shares a bucket, may be
linked and is in different components is left untested, so no link is lost.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from blotter.llm.frames import stored

#: Members of a bucket's part in the second pass, and of a task's share of a hot
#: bucket in the third.
PART, SHARE = 256, 4096

#: What a bucket's row may carry besides key, c and n: ``sig``, a 32-bit parity
#: bitmap of the set (bit i: the parity of the members that fall on i); and for
#: keys that are members of the sets in one common order, ``rest``, the members
#: from the key on, and ``short``, whether the key is in the set's index prefix.
CARRIED = ("c", "n", "sig", "rest", "short")


def may_link(x: str, y: str, columns: list[str], threshold: float) -> Column:
    """Whether the sets of two rows of a bucket, whose ``columns`` are prefixed
    ``x`` and ``y``, may have a Jaccard similarity of ``threshold``.

    - Sizes: the smaller one is at least ``threshold`` times the larger one.
    - ``sig``: the symmetric difference is at least the number of bits that
      differ.
    - ``rest``: at their first common member, the overlap is at most what either
      set has from there on.
    - ``short``: the first common member is in the index prefix of the smaller set
      (of both, if their sizes are equal).
    """
    a, b = (lambda name: F.col(x + name)), (lambda name: F.col(y + name))
    both = a("n") + b("n")
    out = (F.least(a("n"), b("n")) >= F.greatest(a("n"), b("n")) * threshold - 1e-9) & (a("c") != b("c"))
    if "sig" in columns:
        # bit_count widens a negative integer, whose sign would count 33 times
        differ = a("sig").bitwiseXOR(b("sig")).cast("long").bitwiseAND(F.lit(0xFFFFFFFF))
        out = out & (F.bit_count(differ) <= both * ((1 - threshold) / (1 + threshold)) + 1e-9)
    if "rest" in columns:
        out = out & (F.least(a("rest"), b("rest")) >= both * (threshold / (1 + threshold)) - 1e-9)
    if "short" in columns:
        out = out & (a("short") | (a("n") > b("n"))) & (b("short") | (b("n") > a("n")))
    return out


def _carried(rows: DataFrame) -> list[str]:
    return [x for x in CARRIED if x in rows.columns]


def _prefixed(rows: DataFrame, prefix: str, *keep: str) -> list[Column]:
    return [*[F.col(k) for k in keep], *[F.col(x).alias(prefix + x) for x in _carried(rows)]]


def shared_buckets(rows: DataFrame) -> DataFrame:
    """The rows of ``rows`` (key and ``CARRIED``) whose key two or more different
    sets share, with the bucket's ``size`` and its hubs (h_c, h_n, ..., g_c,
    ...), chosen among the rows that are ``short``, or all: h has the least hash
    of key and set, g the least share of its set before the key, or else the least
    of another hash."""
    about = _carried(rows)
    dealt = rows.repartition("key").dropDuplicates(["key", "c"])
    able = F.col("short") if "short" in about else F.lit(True)
    before = (F.col("n") - F.col("rest")) / F.col("n") if "rest" in about else F.xxhash64(F.lit(1), "key", "c")
    orders = {"h": F.xxhash64(F.lit(0), "key", "c"), "g": before}
    hub = [F.min(F.when(able, F.struct(at.alias("at"), *about))).alias(h) for h, at in orders.items()]
    buckets = dealt.groupBy("key").agg(*hub, F.count(F.lit(1)).alias("size")).where("size > 1 and h is not null")
    named = [F.col(f"{h}.{x}").alias(f"{h}_{x}") for h in "hg" for x in about]
    return stored(dealt.join(buckets.select("key", "size", *named), "key"), "buckets")


def prefix_keys(counts: np.ndarray, threshold: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(set, rest, short) of every member in the prefixes of sets of ``counts``
    members that stand in one common order: of two sets with a Jaccard similarity of
    ``threshold``, the first common member is in both prefixes."""
    length = counts - np.ceil(counts * threshold - 1e-9).astype(np.int64) + 1
    index = counts - np.ceil(counts * (2 * threshold / (1 + threshold)) - 1e-9).astype(np.int64) + 1
    own = np.repeat(np.arange(len(counts)), length)
    at = np.arange(len(own)) - np.repeat(np.cumsum(length) - length, length)
    return own, counts[own] - at, at < index[own]


def _distinct(pairs: DataFrame, x: str, y: str) -> DataFrame:
    return pairs.select(F.least(x + "c", y + "c").alias("a"), F.greatest(x + "c", y + "c").alias("b")).distinct()


def hub_pairs(active: DataFrame, threshold: float) -> DataFrame:
    """Every row against its bucket's hubs."""
    about = _carried(active)
    hubs = [active.select(*_prefixed(active, "x_"), *[F.col(f"{h}_{c}").alias(f"y_{c}") for c in about]) for h in "hg"]
    return _distinct(hubs[0].unionByName(hubs[1]).where(may_link("x_", "y_", about, threshold)), "x_", "y_")


def _open(active: DataFrame, roots: DataFrame, least: int) -> DataFrame:
    """Rows, with their ``root``, of the buckets of ``least`` members or more that
    hold more than one component."""
    rows = active.where(F.col("size") >= least).select("key", "size", *_carried(active))
    named = rows.join(roots, "c", "left").withColumn("root", F.coalesce("root", "c"))
    mixed = named.groupBy("key").agg(F.min("root").alias("low"), F.max("root").alias("high")).where("low <> high")
    return stored(named.join(mixed.select("key"), "key", "left_semi"), "buckets-open")


def _met(left: DataFrame, right: DataFrame, keys: list[str], about: list[str], threshold: float) -> DataFrame:
    """Pairs of rows with equal ``keys`` that may be linked and whose components
    differ."""
    x, y = left.select(*_prefixed(left, "x_", *keys), F.col("root").alias("x_root")), right.select(*_prefixed(right, "y_", *keys), F.col("root").alias("y_root"))
    return _distinct(x.join(y, keys).where((F.col("x_root") != F.col("y_root")) & may_link("x_", "y_", about, threshold)), "x_", "y_")


def part_pairs(rows: DataFrame, threshold: float) -> DataFrame:
    """Pairs within parts of the buckets."""
    parts = rows.withColumn("part", F.pmod(F.xxhash64("key", "c"), F.ceil(F.col("size") / PART)))
    return _met(parts, parts, ["key", "part"], _carried(rows), threshold)


def whole_pairs(rows: DataFrame, threshold: float) -> DataFrame:
    """All pairs of the buckets, each bucket dealt over as many tasks as it has
    shares of ``SHARE`` members: a member is in one share and meets all shares."""
    shares = F.ceil(F.col("size") / SHARE)
    one = rows.withColumn("share", F.pmod(F.xxhash64("c"), shares))
    every = rows.withColumn("share", F.explode(F.sequence(F.lit(0).cast("long"), shares - 1)))
    if "short" in rows.columns:
        one = one.where("short")  # of a pair that may be linked, one is
    return _met(one, every, ["key", "share"], _carried(rows), threshold)


def _apart(pairs: DataFrame, roots: DataFrame) -> DataFrame:
    """The pairs whose components differ."""
    a, b = roots.toDF("a", "a_root"), roots.toDF("b", "b_root")
    named = pairs.join(a, "a", "left").join(b, "b", "left")
    return named.where(F.coalesce("a_root", "a") != F.coalesce("b_root", "b")).select("a", "b")


def linked_components(
    active: DataFrame,
    threshold: float,
    verify: Callable[[DataFrame], DataFrame],
    finer: Callable[[DataFrame, DataFrame], tuple[DataFrame, Callable[[DataFrame], DataFrame]]] | None = None,
) -> tuple[DataFrame, DataFrame]:
    """(links (a, b), components (c, root)) of the sets in ``active``.
    ``verify`` keeps the linked ones of the pairs (a, b) it is given. ``finer``
    gets the pairs of the smaller buckets and the open rows (key, ``CARRIED``) of
    those of over ``PART`` members; it returns the rows of finer buckets with
    positions, in which any two rows of a key that may be linked meet, and what
    takes the place of ``verify`` for these pairs and all sets of these rows. The
    links connect every component; of large groups they are not all links."""
    links = stored(verify(stored(hub_pairs(active, threshold), "pairs")), "links")
    roots = components(links)
    if finer is not None:
        rows = _open(active, roots, 3)
        pairs = stored(part_pairs(rows.where(F.col("size") <= PART), threshold), "pairs")
        dealt, verify = finer(pairs, rows.where(F.col("size") > PART).select("key", *_carried(rows)))
        active = shared_buckets(dealt)
        pairs = stored(pairs.unionByName(_apart(hub_pairs(active, threshold), roots)).distinct(), "pairs")
        found = stored(verify(pairs), "links")
        links = links.unionByName(found)
        roots = components(found.unionByName(roots.where("c <> root").toDF("a", "b")))
    passes = ((3, whole_pairs),) if "rest" in active.columns else ((3, part_pairs), (PART + 1, whole_pairs))
    for least, pairs_of in passes:
        rows = _open(active, roots, least)
        pairs = stored(pairs_of(rows, threshold), "pairs")
        if pairs.isEmpty():
            continue
        found = stored(verify(pairs), "links")
        links = links.unionByName(found)
        roots = components(found.unionByName(roots.where("c <> root").toDF("a", "b")))
    return links, roots


def components(links: DataFrame) -> DataFrame:
    """(c, root): the smallest member reachable, for every member of a link.
    Alternating large-star and small-star steps until nothing changes; every
    step is an aggregate and an equi-join, stored in the shared folder."""
    edges = links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        # large star: neighbours above u move to u's smallest neighbour
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")
        # small star: u and its smaller neighbours move to the smallest of them
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        moved = large.join(low, "u")
        small = moved.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(low.select("u", F.col("m").alias("v"))).where("u <> v").distinct()
        edges = stored(small, "edges")
        # stars are done: each member has one edge up, and no centre has any
        ends = edges.select(F.explode(F.array(F.struct(F.col("u").alias("x"), F.lit(1).alias("up")), F.struct(F.col("v").alias("x"), F.lit(0).alias("up")))).alias("e"))
        ups = ends.groupBy("e.x").agg(F.sum("e.up").alias("ups"), F.min("e.up").alias("centre"))
        if ups.where((F.col("ups") > 1) | ((F.col("ups") > 0) & (F.col("centre") == 0))).isEmpty():
            break
    roots = edges.select(F.col("u").alias("c"), F.col("v").alias("root"))
    return stored(roots.unionByName(roots.select(F.col("root").alias("c"), "root").distinct()), "roots")
