"""Hard negatives by a vertical scan of columnar vectors (BOND).

Rows are packed into blocks of ``BLOCK``, one array per dimension, with each
dimension's least and greatest value. An anchor reads a block's dimensions in
the descending order of its own magnitudes there. After every few of them, the
least and greatest that the remaining dimensions can add bound each candidate's
inner product; a bitmap keeps the candidates that may still matter, until exact
scores are left.

1. Positives: of the rows of the anchor's label, those whose upper bound
   reaches the k-th lower bound of the block stay.
2. Negatives: each positive's score gives a window of scores. Of the rows of
   other labels, those stay that may lie in a window and reach the k-th lower
   bound of the rows that are sure to.

In both steps a block's few results meet those of the other blocks in a top-k
per anchor (and positive). The anchors, a stated query set, are dealt in blocks
to every block of rows; a task holds the rows of one cell and streams the
anchors past them. Labels are only compared, so no label is a group.

Edge cases: rows with a null label, a null vector or a null or non-finite
component take no part; components that a shorter vector lacks are 0; a
component beyond 2**26 after scaling counts as 2**26 (so that scores are exact
longs); a row with a null id is no anchor, and comes after others of its score;
rows of one id are separate rows, and each is an anchor of its own; an anchor
without other rows of its label has no result, and a window without rows
neither; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from blotter.llm.frames import stored
from blotter.llm.vectors import finite_vectors, matrix, width_of

POSITIVES, NEGATIVES = 5, 10
#: Per cent of the positive's score between which a negative's lies.
LOW, HIGH = 30, 90
SCALE = 256
LIMIT = float(1 << 26)
BLOCK = 4096
#: Dimensions after which the bounds are looked at again: this many, then twice
#: as many, and so on.
FIRST_READ = 4

ROWS = "kind int, cell long, uid long, vec_id long, label long, data binary, ids binary, labels binary"


def packed(rows: DataFrame, width: int, anchor_every: int) -> DataFrame:
    """Kind 0: a block of rows (vec ids, labels, components one dimension after
    the other, as doubles that hold integers; ids with a leading null bitmap).
    Kind 1: an anchor. ``uid`` numbers rows: the first one's for a block."""

    def out(kind: int, uid: int, ids: pa.Array, labels: np.ndarray, scaled: np.ndarray, anchors: np.ndarray) -> Iterator[pa.RecordBatch]:
        schema = ["kind", "cell", "uid", "vec_id", "label", "data", "ids", "labels"]
        n = len(anchors)
        null = np.asarray(ids.is_null())
        flat = ids.fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
        columns = [
            pa.array([0] + [1] * n, pa.int32()),
            pa.array([uid] * (n + 1), pa.int64()),
            pa.array([uid, *(uid + anchors).tolist()], pa.int64()),
            pa.array([None, *flat[anchors].tolist()], pa.int64()),
            pa.array([None, *labels[anchors].tolist()], pa.int64()),
            pa.array([np.ascontiguousarray(scaled.T).tobytes(), *(scaled[i].tobytes() for i in anchors)], pa.binary()),
            pa.array([null.tobytes() + flat.tobytes(), *[None] * n], pa.binary()),
            pa.array([labels.tobytes(), *[None] * n], pa.binary()),
        ]
        yield pa.RecordBatch.from_arrays(columns, names=schema)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        uid = TaskContext.get().partitionId() << 40
        for batch in batches:
            for start in range(0, batch.num_rows, BLOCK):
                part = batch.slice(start, BLOCK)
                scaled = np.clip(np.floor(SCALE * matrix(part.column(2), width)), -LIMIT, LIMIT)
                ids, labels = part.column(0), part.column(1).to_numpy().astype(np.int64)
                chosen = (np.asarray(ids.fill_null(1)) % anchor_every == 0) & np.asarray(ids.is_valid())
                yield from out(0, uid, ids, labels, scaled, np.flatnonzero(chosen))
                uid += part.num_rows

    return rows.mapInArrow(run, ROWS)


class Block:
    """Rows of one block, one array per dimension."""

    def __init__(self, uid: int, data: bytes, ids: bytes, labels: bytes, width: int):
        self.labels = np.frombuffer(labels, np.int64)
        n = len(self.labels)
        self.null = np.frombuffer(ids, np.bool_, n)
        self.ids = np.frombuffer(ids, np.int64, n, n)
        self.uids = uid + np.arange(n)
        self.columns = np.frombuffer(data, np.float64).reshape(width, n)
        self.low, self.high = (f(self.columns, axis=1) if width else np.zeros(0) for f in (np.min, np.max))
        self.magnitude = max(1.0, float(np.abs(self.columns).max(initial=0)))

    def best(self, score: np.ndarray, rows: np.ndarray, k: int) -> np.ndarray:
        """Places in ``rows`` of the k highest scores, ties by smaller id."""
        if len(rows) > 4 * k:
            at = np.flatnonzero(score >= np.partition(score, -k)[-k])
        else:
            at = np.arange(len(rows))
        order = np.lexsort((self.uids[rows[at]], self.ids[rows[at]], self.null[rows[at]], -score[at]))
        return at[order[:k]]

    def scan(self, anchor: np.ndarray, rows: np.ndarray, still) -> tuple[np.ndarray, np.ndarray]:
        """(scores, rows) of the ``rows`` that ``still(partial, least, most)``
        keeps until all dimensions are read."""
        if self.magnitude * float(np.abs(anchor).max(initial=0)) * max(1, len(anchor)) >= 2.0**53:
            anchor, columns = anchor.astype(np.int64), self.columns.astype(np.int64)
            low, high = self.low.astype(np.int64), self.high.astype(np.int64)
        else:
            columns, low, high = self.columns, self.low, self.high
        order = np.argsort(-np.abs(anchor), kind="stable")
        ends = np.minimum(anchor * low, anchor * high)[order], np.maximum(anchor * low, anchor * high)[order]
        least, most = (np.concatenate([np.cumsum(e[::-1])[::-1], e[:0], [0]]) for e in ends)
        partial = np.zeros(len(rows), columns.dtype)
        at, step = 0, FIRST_READ
        while at < len(order) and len(rows):
            dims = order[at : at + step]
            if 2 * len(rows) > columns.shape[1]:
                partial = partial + (anchor[dims] @ columns[dims])[rows]
            else:
                partial = partial + anchor[dims] @ columns[dims[:, None], rows]
            at, step = at + len(dims), step * 2
            keep = still(partial, least[at], most[at])
            partial, rows = partial[keep], rows[keep]
        return partial.astype(np.int64), rows


def _first(partial: np.ndarray, least: float, most: float, k: int) -> np.ndarray:
    """Which may be among the k highest."""
    if len(partial) <= k:
        return np.ones(len(partial), bool)
    return partial + most >= np.partition(partial, -k)[-k] + least


def _in_windows(partial: np.ndarray, least: float, most: float, windows: list[tuple[int, int]], k: int) -> np.ndarray:
    """Which may be among the k highest of some window of scores."""
    low, high = partial + least, partial + most
    keep = np.zeros(len(partial), bool)
    for a, b in windows:
        sure = low[(low >= a) & (high <= b)]
        if len(sure) >= k:
            a = max(a, np.partition(sure, -k)[-k])
        keep |= (high >= a) & (low <= b)
    return keep


def _windows(score: int) -> tuple[int, int]:
    """Least and greatest score s with LOW * p <= 100 * s <= HIGH * p."""
    return -(-LOW * score // 100), HIGH * score // 100


def _dealt(blocks: DataFrame, anchors: DataFrame, cells: int) -> DataFrame:
    """Blocks and, after them, the anchors of every cell, by cell."""
    rows = blocks.withColumn("cell", F.pmod(F.xxhash64("uid"), F.lit(cells)))
    every = anchors.withColumn("cell", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(cells - 1).cast("long"))))
    both = rows.unionByName(every, allowMissingColumns=True)
    tasks = min(cells, 4 * blocks.sparkSession.sparkContext.defaultParallelism)
    return both.repartition(tasks, "cell").sortWithinPartitions("cell", "kind")


def _meetings(batches: Iterable[pa.RecordBatch], width: int) -> Iterator[tuple[list[Block], pa.RecordBatch, int, np.ndarray]]:
    """(blocks of the cell, batch, row, anchor's vector) per anchor and cell."""
    cell, blocks = None, []
    for batch in batches:
        kinds, cells = batch.column("kind").to_pylist(), batch.column("cell").to_pylist()
        for i, kind in enumerate(kinds):
            if cells[i] != cell:
                cell, blocks = cells[i], []
            if kind == 0:
                blocks.append(Block(batch.column("uid")[i].as_py(), *(batch.column(c)[i].as_py() for c in ("data", "ids", "labels")), width))
            elif blocks:
                yield blocks, batch, i, np.frombuffer(batch.column("data")[i].as_py(), np.float64)


def _flush(rows: list[tuple], names: list[str], types: list[pa.DataType]) -> pa.RecordBatch:
    columns = zip(*rows, strict=True)
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=names)


def _emit(found: Iterator[tuple], names: list[str], types: list[pa.DataType]) -> Iterator[pa.RecordBatch]:
    held: list[tuple] = []
    for row in found:
        held.append(row)
        if len(held) >= 10_000:
            yield _flush(held, names, types)
            held = []
    if held:
        yield _flush(held, names, types)


def best_positives(blocks: DataFrame, anchors: DataFrame, cells: int, width: int, k: int) -> DataFrame:
    """(uid, vec_id, positives [(score, vec_id)]) of every anchor that has
    other rows of its label."""
    names, types = ["uid", "vec_id", "score", "other", "other_uid"], [pa.int64()] * 5

    def run(batches: Iterable[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        def found() -> Iterator[tuple]:
            for held, batch, i, vector in _meetings(batches, width):
                uid, name, label = (batch.column(c)[i].as_py() for c in ("uid", "vec_id", "label"))
                for block in held:
                    rows = np.flatnonzero((block.labels == label) & (block.uids != uid))
                    score, rows = block.scan(vector, rows, lambda p, a, b: _first(p, a, b, k))
                    for j in block.best(score, rows, k).tolist():
                        r = rows[j]
                        yield uid, name, int(score[j]), None if block.null[r] else int(block.ids[r]), int(block.uids[r])

        yield from _emit(found(), names, types)

    near = _dealt(blocks, anchors, cells).mapInArrow(run, "uid long, vec_id long, score long, other long, other_uid long")
    order = Window.partitionBy("uid").orderBy(F.desc("score"), F.asc_nulls_last("other"), "other_uid")
    first = near.withColumn("place", F.row_number().over(order)).where(F.col("place") <= k)
    listed = F.sort_array(F.collect_list(F.struct("place", "score", "other"))).alias("positives")
    return first.groupBy("uid").agg(listed)


def mine(spark: SparkSession, vectors: DataFrame, anchor_every: int = 100, positives: int = POSITIVES, negatives: int = NEGATIVES) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score,
    negative_score); ``vectors`` has vec_id, label and embedding."""
    clean = finite_vectors(vectors.where("label is not null"), "label")
    width = width_of(clean)
    table = stored(packed(clean.select("vec_id", "label", "embedding"), width, anchor_every), "bond-blocks", partition_by="kind")
    blocks, anchors = table.where("kind = 0"), table.where("kind = 1")
    cells = max(1, blocks.count())
    few = anchors.drop("ids", "labels")
    best = stored(best_positives(blocks, few, cells, width, positives), "bond-positives")
    windowed = stored(few.join(best, "uid"), "bond-windows")
    names = ["uid", "place", "anchor_id", "positive_id", "positive_score", "negative_score", "negative_id", "negative_uid"]
    types = [pa.int64(), pa.int32(), *[pa.int64()] * 6]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        def found() -> Iterator[tuple]:
            for held, batch, i, vector in _meetings(batches, width):
                uid, name, label = (batch.column(c)[i].as_py() for c in ("uid", "vec_id", "label"))
                best = batch.column("positives")[i].as_py()
                open_ = [(p, *_windows(p["score"])) for p in best]
                open_ = [x for x in open_ if x[1] <= x[2]]
                windows = list({x[1:] for x in open_})
                for block in held if open_ else []:
                    rows = np.flatnonzero(block.labels != label)
                    score, rows = block.scan(vector, rows, lambda p, a, b, w=windows: _in_windows(p, a, b, w, negatives))
                    for p, a, b in open_:
                        inside = np.flatnonzero((score >= a) & (score <= b))
                        for j in inside[block.best(score[inside], rows[inside], negatives)].tolist():
                            r = rows[j]
                            yield uid, p["place"], name, p["other"], p["score"], int(score[j]), None if block.null[r] else int(block.ids[r]), int(block.uids[r])

        yield from _emit(found(), names, types)

    schema = "uid long, place int, anchor_id long, positive_id long, positive_score long, negative_score long, negative_id long, negative_uid long"
    near = _dealt(blocks, windowed, cells).mapInArrow(run, schema)
    order = Window.partitionBy("uid", "place").orderBy(F.desc("negative_score"), F.asc_nulls_last("negative_id"), "negative_uid")
    ranked = near.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= negatives)
    return ranked.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")


def relabelled(vectors: DataFrame) -> DataFrame:
    """The label of every seventh id moves on by one, modulo ten."""
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return vectors.select("vec_id", moved.alias("label"), "embedding")
