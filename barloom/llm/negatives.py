"""Hard negatives of anchors in a table of vectors: segment summaries bound scores, level by level, before vectors are multiplied."""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from barloom.llm._shared import materialize, scratch

#: Segments of the finest summary; each coarser level joins two and two.
SEGMENTS = 16
#: Components that a round's anchors have together: what is sent to the tasks is eight bytes for each.
SENT = 1 << 21
#: Rows and anchors whose scores are looked at together.
ROWS, ANCHORS = 4096, 256
#: Largest component; with it a score of up to 2048 components fits a long.
LARGEST = 1 << 26
#: Share of pairs alive below which bounds and scores are computed pair by pair.
SPARSE = 0.05

_NONE = -np.inf


def borders(width: int, segments: int = SEGMENTS) -> np.ndarray:
    """Where the finest segments of a vector begin and end: a power of two of them, none empty."""
    n = 1
    while n * 2 <= min(segments, width):
        n *= 2
    return np.arange(n + 1) * width // n


def summary(vectors: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Mean of each segment of each vector, and the length of what is left without it."""
    if not vectors.shape[1]:
        return np.zeros((len(vectors), 1)), np.zeros((len(vectors), 1))
    size = np.diff(at)
    mean = np.add.reduceat(vectors, at[:-1], axis=1) / size
    return mean, np.sqrt(np.add.reduceat((vectors - np.repeat(mean, size, axis=1)) ** 2, at[:-1], axis=1))


def levels(mean: np.ndarray, rest: np.ndarray, at: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """Summaries from one segment to the finest; means are scaled by the root of the segment's size, so that their products add up to scores."""
    size = np.maximum(np.diff(at), 1).astype(float) if len(at) > 1 else np.ones(1)
    out = [(mean * np.sqrt(size), rest)]
    while mean.shape[1] > 1:
        total = size[0::2] + size[1::2]
        joined = (mean[:, 0::2] * size[0::2] + mean[:, 1::2] * size[1::2]) / total
        square = rest[:, 0::2] ** 2 + rest[:, 1::2] ** 2 + size[0::2] * (mean[:, 0::2] - joined) ** 2 + size[1::2] * (mean[:, 1::2] - joined) ** 2
        mean, rest, size = joined, np.sqrt(square), total
        out.append((mean * np.sqrt(size), rest))
    return out[::-1]


class Side(NamedTuple):
    """Some vectors with their names, labels and summaries; uid tells rows with one id apart."""

    uid: np.ndarray
    id: np.ndarray
    label: np.ndarray
    vectors: np.ndarray
    levels: list[tuple[np.ndarray, np.ndarray]]
    length: np.ndarray

    @classmethod
    def of(cls, uid: np.ndarray, id_: np.ndarray, label: np.ndarray, vectors: np.ndarray, at: np.ndarray, mean: np.ndarray | None = None, rest: np.ndarray | None = None) -> Side:
        if mean is None:
            mean, rest = summary(vectors, at)
        return cls(uid, id_, label, vectors, levels(mean, rest, at), np.sqrt((vectors**2).sum(axis=1)))

    def take(self, at: np.ndarray) -> Side:
        return Side(self.uid[at], self.id[at], self.label[at], self.vectors[at], [(m[at], r[at]) for m, r in self.levels], self.length[at])


def alive(a: Side, b: Side, low: np.ndarray, high: np.ndarray, may: np.ndarray) -> np.ndarray:
    """Pairs of `may` whose score can lie between low and high of their anchor.

    The products of the means, plus or minus those of the rests, bound a score (Cauchy-Schwarz in each segment); pairs that are
    left go to the next level of twice as many segments."""
    slack = (1 + 1e-5 * a.length * b.length.max(initial=0))[:, None]
    low, high = low[:, None] - slack, high[:, None] + slack
    for (m, r), (n, s) in zip(a.levels, b.levels, strict=True):
        if not may.any():
            break
        if may.mean() >= SPARSE:
            middle, width = m @ n.T, r @ s.T
            may = may & (middle + width >= low) & (middle - width <= high)
        else:
            i, j = np.nonzero(may)
            middle, width = np.einsum("ij,ij->i", m[i], n[j]), np.einsum("ij,ij->i", r[i], s[j])
            ok = (middle + width >= low[i, 0]) & (middle - width <= high[i, 0])
            may = np.zeros_like(may)
            may[i[ok], j[ok]] = True
    return may


def scores(a: Side, b: Side, may: np.ndarray) -> np.ndarray:
    """Exact scores of the pairs that are alive, minus infinity for the others."""
    exact = np.abs(a.vectors).max(initial=0) * np.abs(b.vectors).max(initial=0) * a.vectors.shape[1] < 2.0**53
    kind = np.float64 if exact else np.longdouble  # 64 bits of significand
    if may.mean() >= SPARSE:
        return np.where(may, a.vectors.astype(kind) @ b.vectors.astype(kind).T, kind(_NONE))
    out = np.full(may.shape, _NONE, kind)
    i, j = np.nonzero(may)
    out[i, j] = np.einsum("ij,ij->i", a.vectors[i].astype(kind), b.vectors[j].astype(kind))
    return out


class Best:
    """The k best rows of each slot met so far: higher scores first, then smaller ids."""

    def __init__(self, slots: int, k: int):
        self.score, self.id, self.uid = np.full((slots, k), _NONE, np.longdouble), np.zeros((slots, k), np.int64), np.zeros((slots, k), np.int64)

    def least(self) -> np.ndarray:
        return self.score[:, -1].astype(float)

    def add(self, slots: np.ndarray, score: np.ndarray, b: Side) -> None:
        """Rows of b, which are in the order of their ids, with a row of scores for each slot. The matrix of scores is used up."""
        k = self.score.shape[1]
        line = np.arange(len(slots))
        got = []
        for _ in range(min(k, score.shape[1])):
            j = score.argmax(axis=1)  # the first of the highest
            got.append((score[line, j].astype(np.longdouble), b.id[j], b.uid[j]))
            score[line, j] = _NONE
        every = [np.concatenate([old[slots], np.stack([g[c] for g in got], axis=1)], axis=1) for c, old in enumerate((self.score, self.id, self.uid))]
        flat = [x.reshape(-1) for x in every]
        order = np.lexsort((flat[2], flat[1], -flat[0], np.repeat(line, every[0].shape[1]))).reshape(len(line), -1)[:, :k]
        for x, own in zip(flat, (self.score, self.id, self.uid), strict=True):
            own[slots] = x[order]


def _matrix(column: pa.Array, width: int, kind: type = np.float64) -> np.ndarray:
    """List rows as a matrix; what a shorter vector lacks is 0."""
    size = np.diff(column.offsets.to_numpy())
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(kind)
    if (size == width).all():
        return flat.reshape(len(size), width)
    out = np.zeros((len(size), width), kind)
    row = np.repeat(np.arange(len(size)), size)
    out[row, np.arange(len(flat)) - np.repeat(np.cumsum(size) - size, size)] = flat
    return out


def _tiles(batches: Iterator[pa.RecordBatch], at: np.ndarray) -> Iterator[Side]:
    width = int(at[-1]) if len(at) > 1 else 0
    for b in batches:
        for x in range(0, b.num_rows, ROWS):
            t = b.slice(x, ROWS)
            uid, id_, label = (t.column(k).to_numpy() for k in range(3))
            order = np.lexsort((uid, id_))
            mean, rest = (_matrix(t.column(k), len(at) - 1 if width else 1) for k in (4, 5))
            yield Side.of(uid, id_, label, _matrix(t.column(3), width), at, mean, rest).take(order)


_ROW = "uid bigint, id bigint, label bigint, vector array<bigint>, mean array<float>, rest array<float>"
_FOUND = "anchor bigint, slot int, score bigint, id bigint, uid bigint"


def summarized(rows: DataFrame, width: int) -> DataFrame:
    """Rows (uid, id, label, vector) with the mean and the rest of each segment beside the vector."""
    at = borders(width)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            lists = [pa.FixedSizeListArray.from_arrays(pa.array(x.astype(np.float32).reshape(-1)), x.shape[1]).cast(pa.list_(pa.float32())) for x in summary(_matrix(b.column(3), width), at)]
            yield pa.RecordBatch.from_arrays([*b.columns, *lists], ["uid", "id", "label", "vector", "mean", "rest"])

    return rows.mapInArrow(run, _ROW)


def _emit(a: Side, best: Best, slots: int) -> pa.RecordBatch:
    i, j = np.nonzero(best.score != _NONE)
    cols = [pa.array(a.uid[i // slots]), pa.array((i % slots).astype(np.int32)), *(pa.array(x[i, j].astype(np.int64)) for x in (best.score, best.id, best.uid))]
    return pa.RecordBatch.from_arrays(cols, ["anchor", "slot", "score", "id", "uid"])


def _positives(rows: DataFrame, held, at: np.ndarray, k: int) -> DataFrame:
    """The best k other rows of each anchor's label, from each task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a = Side.of(*held.value[:4], at)
        best = Best(len(a.uid), k)
        mine = {x: np.flatnonzero(a.label == x) for x in np.unique(a.label)}
        for tile in _tiles(batches, at):
            for label in np.unique(tile.label):
                b = tile.take(np.flatnonzero(tile.label == label))
                own = mine.get(label, [])
                for x in range(0, len(own), ANCHORS):
                    i = own[x : x + ANCHORS]
                    part = a.take(i)
                    may = alive(part, b, best.least()[i], np.full(len(i), np.inf), part.uid[:, None] != b.uid[None, :])
                    if may.any():
                        rows_, cols = np.flatnonzero(may.any(axis=1)), np.flatnonzero(may.any(axis=0))
                        near = b.take(cols)
                        best.add(i[rows_], scores(part.take(rows_), near, may[np.ix_(rows_, cols)]), near)
        yield _emit(a, best, 1)

    return rows.mapInArrow(run, _FOUND)


def _negatives(rows: DataFrame, held, at: np.ndarray, k: int) -> DataFrame:
    """The best k rows of other labels within the limits of each anchor's positives, from each task; slots are the positives' ranks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a = Side.of(*held.value[:4], at)
        low, high = held.value[4:]  # for each anchor and positive; an empty range where there is none
        slots = low.shape[1]
        best = Best(len(a.uid) * slots, k)
        for tile in _tiles(batches, at):
            for x in range(0, len(a.uid), ANCHORS):
                i = np.arange(x, min(x + ANCHORS, len(a.uid)))
                part = a.take(i)
                wanted = np.maximum(low[i], best.least().reshape(-1, slots)[i])
                open_ = wanted <= high[i]
                least, most = np.where(open_, wanted, np.inf).min(axis=1), np.where(open_, high[i], -np.inf).max(axis=1)
                may = alive(part, tile, least, most, part.label[:, None] != tile.label[None, :])
                if not may.any():
                    continue
                rows_, cols = np.flatnonzero(may.any(axis=1)), np.flatnonzero(may.any(axis=0))
                near = tile.take(cols)
                found = scores(part.take(rows_), near, may[np.ix_(rows_, cols)])
                for s in range(slots):
                    lo, hi = low[i[rows_], s][:, None], high[i[rows_], s][:, None]
                    fits = np.where((found >= lo) & (found <= hi), found, _NONE)
                    some = (fits != _NONE).any(axis=1)
                    if some.any():
                        best.add((i[rows_] * slots + s)[some], fits[some], near)
        yield _emit(a, best, slots)

    return rows.mapInArrow(run, _FOUND)


def hard_negatives(rows: DataFrame, anchors: str, id_col: str = "vec_id", label_col: str = "label", vector_col: str = "vector", positives: int = 5, negatives: int = 5, low: int = 80, high: int = 100, sent: int = SENT) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) for the rows that the condition `anchors` (SQL over the columns of rows) picks.

    A score is the inner product of whole-numbered vectors; higher ones come first, then smaller ids. An anchor's positives are its first
    `positives` other rows of the same label; for each, the first `negatives` rows of other labels are returned whose score is between low and high
    percent of the positive's.

    Each row is written once with the mean and the rest (the length of what the mean leaves) of up to 16 segments. Anchors go to the tasks in rounds of
    `sent` components, so what is sent does not grow with the table, and every row meets every anchor of a round where it lies: the segments' bounds, from one segment to all,
    leave out pairs that cannot be among the best so far or within the limits, and only the rest is multiplied. A task returns at most its best rows for each anchor.

    Rows with a null id, label or vector, or a null in a vector, take no part; what a shorter vector lacks counts as 0, components are held to +-2^26 so that scores fit a long; rows that
    repeat, and rows with one id, are rows of their own (two anchors with one id both return rows); an anchor without other rows of its label, or with
    none within the limits, has no rows; empty in, empty out; other columns are not read."""
    spark = rows.sparkSession
    held_to = F.transform(vector_col, lambda x: F.greatest(F.lit(-LARGEST), F.least(F.lit(LARGEST), x)).cast("bigint"))
    rows = rows.where(F.col(vector_col).isNotNull() & ~F.exists(vector_col, lambda x: x.isNull()))
    plain = rows.select(F.monotonically_increasing_id().alias("uid"), F.col(id_col).cast("bigint").alias("id"), F.col(label_col).cast("bigint").alias("label"), held_to.alias("vector"), F.coalesce(F.expr(anchors), F.lit(False)).alias("asks"))
    plain = plain.where("id is not null and label is not null")
    with scratch(spark):
        plain = materialize(plain, "vectors")
        n, width = plain.agg(F.sum(F.expr("bigint(asks)")), F.max(F.size("vector"))).first()
        width = max(width or 0, 0)
        at = borders(width) if width else np.zeros(1, np.int64)
        table = materialize(summarized(plain.drop("asks"), width), "summaries", keep=True)
        rounds = max(1, -(-(n or 0) * max(width, 1) // sent))
        asked = plain.where("asks").withColumn("round", F.pmod(F.xxhash64("uid"), F.lit(rounds)))
        asked = materialize(asked.drop("asks"), "anchors", keep=True)
        best = Window.partitionBy("anchor", "slot").orderBy(F.desc("score"), "id", "uid")
        out = None
        for r in range(rounds):
            t = asked.where(F.col("round") == r).drop("round").toArrow().combine_chunks()
            uid, id_, label = (t.column(k).to_numpy() for k in range(3))
            vectors = _matrix(t.column(3).chunk(0), width) if t.num_rows else np.zeros((0, width))
            held = spark.sparkContext.broadcast((uid, id_, label, vectors))
            own = _positives(table, held, at, positives).withColumn("n", F.row_number().over(best)).where(F.col("n") <= positives)
            own = materialize(own.select("anchor", F.col("n").alias("slot"), F.col("score").alias("positive_score"), F.col("id").alias("positive_id")), "positives", keep=True)
            got = own.toArrow()  # at most `positives` rows for each anchor of the round
            place = np.argsort(uid)
            of = place[np.searchsorted(uid, got.column("anchor").to_numpy(), sorter=place)] if got.num_rows else np.zeros(0, np.int64)
            slot, score = got.column("slot").to_numpy() - 1, got.column("positive_score").to_numpy()
            least, most = np.full((len(uid), positives), np.inf), np.full((len(uid), positives), -np.inf)
            least[of, slot], most[of, slot] = -(-low * score // 100), high * score // 100
            limits = spark.sparkContext.broadcast((uid, id_, label, vectors, least, most))
            far = _negatives(table, limits, at, negatives).withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= negatives)
            far = far.select("anchor", (F.col("slot") + 1).alias("slot"), "rank", F.col("score").alias("negative_score"), F.col("id").alias("negative_id"))
            met = far.join(own, ["anchor", "slot"]).join(asked.select(F.col("uid").alias("anchor"), F.col("id").alias("anchor_id")), "anchor")
            met = materialize(met.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"), "negatives", keep=True)
            out = met if out is None else out.union(met)
            held.destroy()
            limits.destroy()
    return out
