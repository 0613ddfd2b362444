"""Benchmark decontamination by winnowed fingerprints, a join, and extension of the hits."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barloom.llm._shared import materialize, text_or_empty
from barloom.llm._words import LOWER, U, buffers, chunks, frugal, grams, words

#: Words of a window that counts as shared, and words of a fingerprint's k-gram.
WINDOW, GRAM = 10, 5
#: Bytes of item texts up to which the items' fingerprints are broadcast instead of joined.
BROADCAST_BYTES = 8 << 20

_OUT = "n_words bigint, n_hit bigint, n_items bigint, items_sha256 string"


def winnow(g: np.ndarray, width: int) -> np.ndarray:
    """Positions of the k-grams that are least in some run of `width` k-grams: any two texts that share a run share one of them."""
    n = len(g) - width + 1
    if n <= 0:
        return np.zeros(0, np.int64)
    least = g[:n].copy()
    for j in range(1, width):
        np.minimum(least, g[j : j + n], out=least)
    picked = np.zeros(len(g), bool)
    for j in range(width):
        picked[j : j + n] |= g[j : j + n] == least
    return np.flatnonzero(picked)


class Words:
    """The words of some texts: hashes, which find places where words may agree, and bytes, which decide."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        self.data = data
        self.h, self.start, self.end, self.first = words(data, offsets)

    def same(self, at: np.ndarray, other: Words, there: np.ndarray) -> np.ndarray:
        """Whether the words at places `at` have the bytes of those of `other` at the places `there`, A-Z as a-z."""
        a, b = self.start[at], other.start[there]
        size = self.end[at] - a
        equal = size == other.end[there] - b
        a, b, size = a[equal], b[equal], size[equal]
        if len(size):  # a word is never empty
            begin = np.cumsum(size) - size
            step = np.arange(size.sum()) - np.repeat(begin, size)
            bytes_ = LOWER[self.data[np.repeat(a, size) + step]] == LOWER[other.data[np.repeat(b, size) + step]]
            equal[equal] = np.logical_and.reduceat(bytes_, begin)
        return equal


class Items:
    """The windows of a set of items, ready to be looked for in documents: their words, and per fingerprint its places."""

    def __init__(self, ids: list, texts: list, window: int = WINDOW, gram: int = GRAM):
        self.words = Words(*buffers(pa.array([t or "" for t in texts], pa.large_string())))
        self.h, first = self.words.h, self.words.first
        self.ids, self.first, self.window, self.gram = ["" if i is None else str(i) for i in ids], first, window, gram
        keys, place, owner = [], [], []
        self.short: dict[int, tuple[list, list]] = {}
        for i in range(len(ids)):
            a, b = first[i], first[i + 1]
            if 0 < b - a < window:
                s = self.short.setdefault(int(b - a), ([], []))
                s[0].append(grams(self.h[a:b], int(b - a))[0])
                s[1].append(i)
            elif b - a >= window:
                g = grams(self.h[a:b], gram)
                at = winnow(g, window - gram + 1)
                keys.append(g[at])
                place.append(at + a)
                owner.append(np.full(len(at), i))
        empty = np.zeros(0, np.int64)
        self.keys = np.concatenate(keys) if keys else np.zeros(0, U)
        order = np.argsort(self.keys, kind="stable")
        self.keys = self.keys[order]
        self.place = (np.concatenate(place) if place else empty)[order]
        self.owner = (np.concatenate(owner) if owner else empty)[order]
        self.short_keys = {n: (np.array(k, dtype=U), v) for n, (k, v) in self.short.items()}

    def marks(self, text: Words, low: int, high: int) -> tuple[np.ndarray, set[int]]:
        """Which of the words low:high of `text`, a document, lie in an occurrence of a window, and the items with occurrences."""
        h = text.h[low:high]
        marks, found = np.zeros(len(h) + 1, np.int64), set()
        if len(self.keys) and len(h) >= self.window:
            g = grams(h, self.gram)
            at = winnow(g, self.window - self.gram + 1)
            lo = np.searchsorted(self.keys, g[at], "left")
            hi = np.searchsorted(self.keys, g[at], "right")
            done: dict[tuple[int, int], int] = {}  # (item, diagonal): end of the run that is extended already
            for p, a, b in zip(at[hi > lo].tolist(), lo[hi > lo].tolist(), hi[hi > lo].tolist(), strict=True):
                for x in range(a, b):
                    i, q = int(self.owner[x]), int(self.place[x])
                    if done.get((i, q - p), -1) > p:
                        continue
                    start, end = self.extend(text, low, high, p, q, i)
                    done[i, q - p] = max(end, p + 1)
                    if end - start >= self.window:
                        marks[start] += 1
                        marks[end] -= 1
                        found.add(i)
        for n, (keys, owners) in self.short_keys.items():
            if len(h) >= n:
                g = grams(h, n)
                for x in np.flatnonzero(np.isin(keys, g)):
                    at = np.flatnonzero(g == keys[x])
                    mine = int(self.first[owners[x]]) + np.tile(np.arange(n), len(at))
                    at = at[text.same(low + np.repeat(at, n) + np.tile(np.arange(n), len(at)), self.words, mine).reshape(-1, n).all(axis=1)]
                    if len(at):
                        found.add(owners[x])
                        np.add.at(marks, at, 1)
                        np.add.at(marks, at + n, -1)
        return np.cumsum(marks[:-1]) > 0, found

    def runs(self, text: Words) -> list[list[int]]:
        """Word ranges of a document that occurrences cover, one for each maximal run."""
        edge = np.flatnonzero(np.diff(np.concatenate([[0], self.marks(text, 0, len(text.h))[0].astype(np.int8), [0]])))
        return edge.reshape(-1, 2).tolist()

    def extend(self, text: Words, low: int, high: int, p: int, q: int, i: int) -> tuple[int, int]:
        """The longest run of equal words around document word p and item word q: hashes bound it, bytes settle it."""
        h = text.h[low:high]
        back = min(p, q - int(self.first[i]))
        a, b = h[p - back : p][::-1], self.h[q - back : q][::-1]
        d = np.flatnonzero(a != b)
        left = int(d[0]) if len(d) else back
        ahead = min(len(h) - p, int(self.first[i + 1]) - q)
        d = np.flatnonzero(h[p : p + ahead] != self.h[q : q + ahead])
        right = int(d[0]) if len(d) else ahead
        steps = np.arange(-left, right)
        other = np.flatnonzero(~text.same(low + p + steps, self.words, q + steps)) - left
        before, after = other[other < 0], other[other >= 0]
        return p + (int(before[-1]) + 1 if len(before) else -left), p + (int(after[0]) if len(after) else right)


def _digest(names: list[str]) -> str:
    import hashlib

    return hashlib.sha256(",".join(sorted(names)).encode()).hexdigest()


def _scan(items: Items, text: pa.Array) -> list[pa.Array]:
    n_words, n_hit, n_items, digest = [], [], [], []
    none = _digest([])
    data, offsets = buffers(text)
    for i, j in chunks(offsets):
        text = Words(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i])
        first = text.first
        for d in range(j - i):
            hit, found = items.marks(text, int(first[d]), int(first[d + 1]))
            n_words.append(int(first[d + 1] - first[d]))
            n_hit.append(int(hit.sum()))
            names = {items.ids[x] for x in found}
            n_items.append(len(names))
            digest.append(_digest(list(names)) if names else none)
    return [pa.array(n_words, pa.int64()), pa.array(n_hit, pa.int64()), pa.array(n_items, pa.int64()), pa.array(digest, pa.string())]


def _fits(items: DataFrame, limit: int) -> bool:
    return (items.agg(F.sum(F.coalesce(F.octet_length("text"), F.lit(0)) + 64)).first()[0] or 0) <= limit


def _sent(docs: DataFrame, items: DataFrame) -> Broadcast:
    rows = items.collect()  # of the size that _fits allows
    return docs.sparkSession.sparkContext.broadcast(([r["item"] for r in rows], [r["text"] for r in rows]))


def _broadcast(docs: DataFrame, items: DataFrame, window: int, gram: int) -> DataFrame:
    held = _sent(docs, items)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Items(*held.value, window, gram)
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0), *_scan(known, b.column(1))], ["id", "n_words", "n_hit", "n_items", "items_sha256"])

    return docs.mapInArrow(frugal(run), f"id {dict(docs.dtypes)['id']}, {_OUT}")


def fingerprints(rows: DataFrame, short: list[int], window: int, gram: int) -> DataFrame:
    """(key, print, windows) rows for `rows` of (key, text): each winnowed fingerprint with the hashes of the windows around it, and the n-grams of each length in `short`, each its own window."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            data, offsets = buffers(b.column(1))
            for i, j in chunks(offsets, 1 << 18):
                h, _, _, first = words(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i])
                rows_, prints, windows, sizes = [], [], [], []
                for d in range(j - i):
                    own = h[first[d] : first[d + 1]]
                    g, whole = grams(own, gram), grams(own, window)
                    at = winnow(g, window - gram + 1)
                    lo, hi = np.maximum(at - (window - gram), 0), np.minimum(at, len(whole) - 1)
                    size = hi - lo + 1
                    near = np.repeat(lo - np.cumsum(size) + size, size) + np.arange(size.sum())
                    parts = [np.unique(grams(own, n)) + U(n) for n in short]
                    prints += [g[at], *parts]
                    windows += [whole[near], *parts]
                    sizes += [size, *(np.ones(len(x), np.int64) for x in parts)]
                    rows_.append(np.full(len(at) + sum(map(len, parts)), i + d))
                lists = pa.array(np.concatenate([[0], np.cumsum(np.concatenate(sizes))]), pa.int32())
                found = pa.ListArray.from_arrays(lists, pa.array(np.concatenate(windows).view(np.int64)))
                yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array(np.concatenate(rows_))), pa.array(np.concatenate(prints).view(np.int64)), found], ["key", "print", "windows"])

    return rows.mapInArrow(frugal(run), f"key {dict(rows.dtypes)['key']}, print bigint, windows array<bigint>")


def _joined(docs: DataFrame, items: DataFrame, window: int, gram: int) -> DataFrame:
    """The way for item tables of any size: fingerprints meet in a join, what met is told apart by its windows, and the texts of the pairs that are left are compared.

    A text is known by its digest, so copies are looked at once; an item by its row, since ids may be null or repeat."""
    items = materialize(items.where("text is not null").withColumnRenamed("item", "name").withColumn("item", F.monotonically_increasing_id()), "items")
    docs = docs.withColumn("node", F.unhex(F.sha2("text", 256)))

    def lengths(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            data, offsets = buffers(b.column(b.num_columns - 1))
            n = np.concatenate([np.diff(words(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i])[3]) for i, j in chunks(offsets)] or [np.zeros(0, np.int64)])
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], pa.array(n, pa.int64())], [*b.schema.names[:-1], "n"])

    counts = items.select("text").mapInArrow(lengths, "n bigint").where(f"n > 0 and n < {window}").distinct()
    short = sorted(r["n"] for r in counts.collect())  # at most window - 1 numbers
    own = materialize(fingerprints(items.select(F.col("item").alias("key"), "text"), short, window, gram), "prints")
    met = fingerprints(docs.select(F.col("node").alias("key"), "text"), short, window, gram).join(own.select("print").distinct(), "print", "left_semi")
    met = met.select(F.col("key").alias("node"), F.explode("windows").alias("w")).distinct()
    met = materialize(met.join(own.select(F.col("key").alias("item"), F.explode("windows").alias("w")).distinct(), "w").select("node", "item").distinct(), "met")
    texts = docs.select("node", "text").join(met.select("node").distinct(), "node", "left_semi").distinct()
    pairs = met.join(items, "item").select("node", "name", F.col("text").alias("item_text")).join(texts, "node")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows, names, spans = [], [], []
            for n, (item, mine, text) in enumerate(zip(b.column(1).to_pylist(), b.column(2).to_pylist(), b.column(3).to_pylist(), strict=True)):
                known = Items([item], [mine], window, gram)
                at = known.runs(Words(*buffers(pa.array([text], pa.large_string()))))
                if at:
                    rows.append(n)
                    names.append("" if item is None else str(item))
                    spans.append(at)
            yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array(rows, pa.int64())), pa.array(names, pa.string()), pa.array(spans, pa.list_(pa.list_(pa.int64())))], ["node", "item", "spans"])

    found = pairs.select("node", "name", "item_text", "text").mapInArrow(frugal(run), "node binary, item string, spans array<array<bigint>>")
    per = found.groupBy("node").agg(F.array_sort(F.collect_set("item")).alias("items"), F.array_sort(F.flatten(F.collect_list("spans"))).alias("spans"))

    def hits(spans: Column) -> Column:
        """Words in the union of ranges that are in order: each adds what lies beyond the furthest end before it."""
        start = F.struct(F.lit(0).cast("bigint").alias("n"), F.lit(0).cast("bigint").alias("end"))
        step = lambda a, x: F.struct((a["n"] + F.greatest(F.lit(0).cast("bigint"), x[1] - F.greatest(x[0], a["end"]))).alias("n"), F.greatest(a["end"], x[1]).alias("end"))
        return F.aggregate(spans, start, step, lambda a: a["n"])

    per = per.select("node", hits(F.col("spans")).alias("n_hit"), F.size("items").cast("bigint").alias("n_items"), F.array_join("items", ",").alias("names"))
    counted = docs.select("id", "node", "text").mapInArrow(lengths, f"id {dict(docs.dtypes)['id']}, node binary, n bigint")
    zero = lambda c: F.coalesce(c, F.lit(0).cast("bigint")).alias(c)
    return counted.join(per, "node", "left").select("id", F.col("n").alias("n_words"), zero("n_hit"), zero("n_items"), F.sha2(F.coalesce("names", F.lit("")), 256).alias("items_sha256"))


def decontaminate(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", window: int = WINDOW, gram: int = GRAM, broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """One row per document: id, n_words, n_hit, n_items, items_sha256, contaminated.

    A window is `window` consecutive words of an item, or the whole of a shorter one. Documents and
    items are winnowed with k-grams of `gram` words in runs of window - gram + 1, so every shared window has a
    fingerprint in common; each hit is extended to the longest run of equal words, whose bytes are compared, and runs shorter than a window fall away.
    Items of fewer words than a window have one fingerprint of their whole length. If the items' texts
    have at most broadcast_bytes, they are sent to the tasks and no document is shuffled; beyond that fingerprints meet in a join.

    Null and empty texts have no words; items without words match nothing; very long texts are taken whole. Repeated rows each get a
    row; items with the same id count as one, and a null item id as the empty string; both ways agree in this. Null ids are kept. Empty tables give
    no hits or no rows; other columns, whatever their names, are not read."""
    own = items.select(F.col(item_col).alias("item"), F.col(item_text_col).alias("text"))
    rows = docs.select(F.col(id_col).alias("id"), text_or_empty(text_col).alias("text"))
    if _fits(own, broadcast_bytes):
        out = _broadcast(rows, own, window, gram)
    else:
        out = _joined(rows, own, window, gram)
    return out.withColumnRenamed("id", id_col).withColumn("contaminated", F.col("n_hit") > 0)


def clean(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", window: int = WINDOW, gram: int = GRAM, broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """The rows of docs whose text has no hit, with all their columns.

    Whether a row goes depends on its text alone, so rows with one id, or none, stay or go each by its own text, and rows
    that repeat stay or go together; null and empty texts stay. Up to broadcast_bytes of items the rows are filtered in place; beyond that
    the digests of texts with hits are joined against them."""
    own = items.select(F.col(item_col).alias("item"), F.col(item_text_col).alias("text"))
    if not _fits(own, broadcast_bytes):
        node = F.unhex(F.sha2(text_or_empty(text_col), 256))
        hits = decontaminate(docs.select(node.alias("_node"), F.col(text_col).alias("_text")), items, "_node", "_text", item_col, item_text_col, window, gram, broadcast_bytes)
        bad = hits.where("contaminated").select("_node").distinct()
        named = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"), node.alias("_node"))
        return named.join(bad, "_node", "left_anti").select("_row.*")
    held, at = _sent(docs, own), docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Items(*held.value, window, gram)
        for b in batches:
            yield b.filter(pc.equal(_scan(known, b.column(at))[1], 0))

    return docs.mapInArrow(frugal(run), docs.schema)
