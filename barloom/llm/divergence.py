"""How far the sources of a language differ in their words: term counts by sorting pointers to word starts, then exact divergences."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from barloom.llm._shared import materialize, scratch, text_or_empty
from barloom.llm._words import LOWER, U, buffers, chunks

#: Bytes of text whose pointers are sorted at a time.
SLICE = 4 << 20
#: Documents of a language that a term must be in, and how many terms a source lists.
DOCUMENTS, TERMS = 3, 200
#: Whole of the shares that are compared, as integers.
UNIT = 1_000_000_000
#: Sources of a term that are paired with all its sources in one row, and pairs computed at a time.
SOURCES, PAIRS = 1024, 1 << 20

_BYTE = np.arange(256)
LETTER = ((_BYTE >= 65) & (_BYTE <= 90)) | ((_BYTE >= 97) & (_BYTE <= 122)) | (_BYTE >= 128)
#: Keep the first k of eight bytes, the first one being the highest.
_MASK = np.array([(1 << 64) - (1 << (64 - 8 * k)) if k else 0 for k in range(9)], U)


def pointers(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the words of a buffer; rows are told apart by the caller."""
    w = np.concatenate([[False], LETTER[data], [False]])
    edge = np.flatnonzero(w[1:] != w[:-1])
    return edge[0::2], edge[1::2]


def pointer_sort(data: np.ndarray, start: np.ndarray, end: np.ndarray, group: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order of pointers by group and word, and where in that order another word begins; equal words stay in the order given.

    Multikey quicksort with eight bytes as one character: all words are split by their first, only ties go on to the next.
    Beyond 64 bytes a character is as long as all before it, so that a word of any length ends after a few rounds."""
    if not len(start):
        return np.zeros(0, np.int64), np.zeros(0, bool)
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    eight = np.ndarray((len(data) + 1,), ">u8", buffer=padded.tobytes(), strides=(1,))

    def character(at: np.ndarray, depth: int) -> np.ndarray:
        left = np.clip(end[at] - start[at] - depth, 0, 8)
        return eight[np.minimum(start[at] + depth, len(data))].astype(U) & _MASK[left]

    def long_character(at: np.ndarray, depth: int) -> np.ndarray:
        blocks = [data[a : max(a, b)].tobytes() for a, b in zip((start[at] + depth).tolist(), np.minimum(start[at] + 2 * depth, end[at]).tolist(), strict=True)]
        rank = {x: k for k, x in enumerate(sorted(set(blocks)))}
        return np.array([rank[x] for x in blocks], U)

    every = np.arange(len(start))
    key = character(every, 0)
    order = np.lexsort((key, group))
    new = np.concatenate([[True], (key[order][1:] != key[order][:-1]) | (group[order][1:] != group[order][:-1])])
    size = end - start
    depth = 8
    while True:
        first = np.flatnonzero(new)
        count = np.diff(np.append(first, len(order)))
        longest = np.maximum.reduceat(size[order], first)
        at = np.flatnonzero(np.repeat((count > 1) & (longest > depth), count))
        if not len(at):
            return order, new
        tie = np.cumsum(new)[at]
        key = character(order[at], depth) if depth < 64 else long_character(order[at], depth)
        by = np.lexsort((key, tie))
        order[at] = order[at][by]
        key = key[by]
        new[at[1:]] |= (key[1:] != key[:-1]) & (tie[1:] == tie[:-1])
        depth = depth + 8 if depth < 64 else 2 * depth


def _gathered(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of ranges one after the other, and their offsets."""
    offsets = np.concatenate([[0], np.cumsum(end - start)])
    return data[np.repeat(start - offsets[:-1], end - start) + np.arange(offsets[-1])], offsets


def equal_runs(data: np.ndarray, start: np.ndarray, end: np.ndarray, group: np.ndarray, row: np.ndarray, weight: np.ndarray | None = None) -> tuple[np.ndarray, ...]:
    """For each group and word: group, bytes, offsets, number of occurrences (or sum of weights), number of rows; rows come in ascending order."""
    order, new = pointer_sort(data, start, end, group)
    first = np.flatnonzero(new)
    n = np.diff(np.append(first, len(order))) if weight is None else np.add.reduceat(weight[order], first) if len(first) else first
    another = new.copy()
    another[1:] |= row[order][1:] != row[order][:-1]
    rows = np.add.reduceat(another.astype(np.int64), first) if len(first) else first
    lead = order[first]
    return group[lead], *_gathered(data, start[lead], end[lead]), n.astype(np.int64), rows


def _long_row(data: np.ndarray, limit: int) -> tuple[np.ndarray, ...]:
    """equal_runs of one long row: pieces that end between words are sorted each, then their distinct words with the counts as weights."""
    parts, at = [], 0
    while at < len(data):
        to = min(at + limit, len(data))
        while to < len(data) and LETTER[data[to]]:
            ahead = np.flatnonzero(~LETTER[data[to : to + limit]])
            to = to + int(ahead[0]) if len(ahead) else min(to + limit, len(data))
        piece = LOWER[data[at:to]]
        start, end = pointers(piece)
        parts.append(equal_runs(piece, start, end, np.zeros(len(start), np.int64), np.zeros(len(start), np.int64)))
        at = to
    joined = np.concatenate([p[1] for p in parts])
    base = np.cumsum([0] + [len(p[1]) for p in parts])
    start = np.concatenate([p[2][:-1] + b for p, b in zip(parts, base, strict=False)])
    end = np.concatenate([p[2][1:] + b for p, b in zip(parts, base, strict=False)])
    zero = np.zeros(len(start), np.int64)
    return equal_runs(joined, start, end, zero, zero, np.concatenate([p[3] for p in parts]))


def term_counts(docs: DataFrame, limit: int = SLICE) -> DataFrame:
    """(lang, source, term, n, rows) of docs(lang, source, text), a row for each slice of a task that has the term, and rows without a term for each group.

    A document is in one slice, so `rows` adds up to its document frequency."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["lang", "source", "term", "n", "rows"]
        for b in batches:
            lang, source = (b.column(k).dictionary_encode() for k in (0, 1))
            code = lang.indices.to_numpy().astype(np.int64) * max(1, len(source.dictionary)) + source.indices.to_numpy()
            used, group = np.unique(code, return_inverse=True)

            def named(code: np.ndarray, a: pa.Array = lang.dictionary, c: pa.Array = source.dictionary) -> list[pa.Array]:
                return [a.take(pa.array(code // max(1, len(c)))), c.take(pa.array(code % max(1, len(c))))]

            none = pa.array(np.zeros(len(used), np.int64))
            yield pa.RecordBatch.from_arrays([*named(used), pa.nulls(len(used), pa.string()), none, none], names)
            data, offsets = buffers(b.column(2))
            for i, j in chunks(offsets, limit):
                part = data[offsets[i] : offsets[j]]
                if len(part) > limit:  # a single row
                    g, text, ends, n, rows = _long_row(part, limit)
                    g = g + group[i]
                else:
                    part = LOWER[part]
                    bounds = offsets[i : j + 1] - offsets[i]
                    start, end, row = _cut(part, bounds)
                    g, text, ends, n, rows = equal_runs(part, start, end, group[i + row], row)
                text = pa.LargeStringArray.from_buffers(len(n), pa.py_buffer(ends.astype(np.int64)), pa.py_buffer(np.ascontiguousarray(text))).cast(pa.string())
                yield pa.RecordBatch.from_arrays([*named(used[g]), text, pa.array(n), pa.array(rows)], names)

    return docs.mapInArrow(run, "lang string, source string, term string, n bigint, rows bigint")


def _cut(part: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Pointers to the words of several rows and the row of each; a word ends where its row does."""
    start, end = pointers(part)
    at = np.unique(bounds[1:-1])
    word = np.searchsorted(start, at, side="right") - 1
    inside = (word >= 0) & (at > start[np.maximum(word, 0)]) & (at < end[np.maximum(word, 0)]) if len(start) else np.zeros(len(at), bool)
    start, end = np.sort(np.concatenate([start, at[inside]])), np.sort(np.concatenate([end, at[inside]]))
    return start, end, np.searchsorted(bounds, start, side="right") - 1


def _share(n: Column, total: Column, terms: Column) -> Column:
    """1 + floor(UNIT * (n + 1) / (total + terms)), exact for counts of any size."""
    top = F.lit(UNIT).cast("decimal(10,0)") * (n + F.lit(1)).cast("decimal(20,0)")
    return F.lit(1).cast("bigint") + F.call_function("div", top, (total + terms).cast("decimal(20,0)"))


def _far(p: Column, q: Column) -> Column:
    """floor((p - q)^2 / q) of shares, which fits a long as they are at most UNIT + 1."""
    return F.call_function("div", (p - q) * (p - q), q)


def _met(sources: int):
    """For terms of two sources, what their value differs by from that of terms which only one or none of them has, summed by pair."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            block = b.column(1).to_numpy()
            own = b.column(2)
            ends = own.offsets.to_numpy() - own.offsets[0].as_py()
            flat = own.flatten()
            name = flat.field("source").dictionary_encode()
            s, p, d = name.indices.to_numpy().astype(np.int64), flat.field("p").to_numpy(), flat.field("d").to_numpy()
            lang = b.column(0).dictionary_encode()
            of_lang = lang.indices.to_numpy().astype(np.int64)
            many = len(name.dictionary)
            m = np.diff(ends)
            rows = np.minimum(m - block * sources, sources)
            sums: dict[str, list] = {"key": [], "value": []}
            done = np.cumsum(rows * m)
            x = 0
            while x < len(m):
                y = max(x + 1, int(np.searchsorted(done, (done[x - 1] if x else 0) + PAIRS, side="right")))
                n = rows[x:y] * m[x:y]
                of = np.repeat(np.arange(x, y), n)
                step = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
                i, j = ends[of] + block[of] * sources + step // m[of], ends[of] + step % m[of]
                of, i, j = of[i != j], i[i != j], j[i != j]
                far = lambda p, q: (p - q) ** 2 // q
                value = far(p[i], p[j]) - far(p[i], d[j]) - far(d[i], p[j]) + far(d[i], d[j])
                key = (of_lang[of] * many + s[i]) * many + s[j]
                order = np.argsort(key, kind="stable")
                first = np.flatnonzero(np.concatenate([[True], key[order][1:] != key[order][:-1]])) if len(key) else order
                sums["key"].append(key[order][first])
                sums["value"].append(np.add.reduceat(value[order], first) if len(first) else value)
                x = y
            key, value = (np.concatenate(v) if v else np.zeros(0, np.int64) for v in sums.values())
            key, back = np.unique(key, return_inverse=True)
            total = np.zeros(len(key), np.int64)
            np.add.at(total, back, value)
            cols = [lang.dictionary.take(pa.array(key // (many * many or 1))), name.dictionary.take(pa.array(key // (many or 1) % (many or 1))), name.dictionary.take(pa.array(key % (many or 1))), pa.array(total)]
            yield pa.RecordBatch.from_arrays(cols, ["lang", "source", "item", "value"])

    return run


def divergence(docs: DataFrame, lang_col: str = "lang", source_col: str = "source", text_col: str = "text", documents: int = DOCUMENTS, terms: int = TERMS) -> DataFrame:
    """(lang, source, part, item, value, rank): how far each source of a language is from each other one, and its most over-used terms.

    A language keeps the terms that at least `documents` of its rows have. A source's share of a term is 1 + floor(UNIT * (count + 1) / (its
    occurrences of kept terms + kept terms)); p stands against q with floor((p - q)^2 / q). Part `pair` sums that over all kept terms with the other source's q;
    part `term` lists up to `terms` terms that a source has and whose share is above that in the whole language. Ranks go by value from high to low, then by
    item in the order of its bytes.

    The sum for a pair is taken apart: terms that neither has count alike, terms of one of them depend on its count alone and are summed by count, and only
    terms of both are looked at by pair, added up inside the tasks. The result has a row for each pair of sources of a language, so lists by source are no larger
    than a row of it.

    Null lang, source and text count as empty; every row is a document, repeated ones too; a language without kept terms has pairs of value 0 and no terms;
    ties are settled by the item; very long texts are cut between words and counted whole; an empty table gives no rows; other columns are not read."""
    rows = docs.select(text_or_empty(lang_col).alias("lang"), text_or_empty(source_col).alias("source"), text_or_empty(text_col).alias("text"))
    with scratch(docs.sparkSession):
        found = term_counts(rows).groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("rows").alias("rows"))
        found = materialize(found, "terms", keep=True)
        of_term = Window.partitionBy("lang", "term")
        kept = found.where("term is not null").withColumn("total", F.sum("n").over(of_term)).withColumn("docs", F.sum("rows").over(of_term))
        kept = kept.withColumn("lead", F.row_number().over(of_term.orderBy("source")) == 1).where(F.col("docs") >= documents)
        kept = materialize(kept.select("lang", "source", "term", "n", "total", "lead"), "kept", keep=True)
        langs = kept.groupBy("lang").agg(F.sum(F.col("lead").cast("bigint")).alias("v"), F.sum("n").alias("in_lang"))
        sizes = kept.groupBy("lang", "source").agg(F.sum("n").alias("in_source"), F.count(F.lit(1)).alias("own"))
        zero = F.lit(0).cast("bigint")
        groups = found.where("term is null").select("lang", "source").join(sizes, ["lang", "source"], "left").join(langs, "lang", "left")
        groups = groups.select("lang", "source", *(F.coalesce(c, zero).alias(c) for c in ("in_source", "own", "v", "in_lang")))
        groups = groups.withColumn("d", F.when(F.col("v") > 0, _share(zero, F.col("in_source"), F.col("v"))))
        groups = materialize(groups, "groups", keep=True)
        shares = kept.join(groups, ["lang", "source"]).withColumn("p", _share(F.col("n"), F.col("in_source"), F.col("v")))
        shares = shares.withColumn("q", F.when(F.col("n") > 0, _share(F.col("total"), F.col("in_lang"), F.col("v"))))
        shares = materialize(shares.select("lang", "source", "term", "p", "q", "d"), "shares", keep=True)

    best = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    term = shares.where("p > q").select("lang", "source", F.col("term").alias("item"), _far(F.col("p"), F.col("q")).alias("value"))
    term = term.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= terms)

    lists = shares.groupBy("lang", "term").agg(F.collect_list(F.struct("source", "p", "d")).alias("of")).where("size(of) > 1")
    lists = lists.select("lang", F.explode(F.expr(f"sequence(0L, (size(of) - 1) div {SOURCES})")).alias("block"), "of")
    met = lists.mapInArrow(_met(SOURCES), "lang string, source string, item string, value bigint")
    other = groups.select("lang", F.col("source").alias("item"), F.col("own").alias("their"), F.col("d").alias("e"))
    counted = shares.groupBy("lang", "source", "p").agg(F.count(F.lit(1)).alias("times")).join(other, "lang").where("source <> item")
    one = counted.groupBy("lang", "source", "item").agg(F.sum(F.col("times") * _far(F.col("p"), F.col("e"))).alias("a"), F.sum(F.col("times") * _far(F.col("e"), F.col("p"))).alias("b"))
    base = groups.join(other, "lang").where("source <> item")
    base = base.select("lang", "source", "item", F.coalesce((F.col("v") - F.col("own") - F.col("their")) * _far(F.col("d"), F.col("e")), zero).alias("value"))
    pair = base.union(one.select("lang", "source", "item", "a")).union(one.select("lang", "item", "source", "b")).union(met)
    pair = pair.groupBy("lang", "source", "item").agg(F.sum("value").alias("value")).withColumn("rank", F.row_number().over(best))
    columns = ["lang", "source", "part", "item", "value", "rank"]
    return pair.withColumn("part", F.lit("pair")).select(columns).union(term.withColumn("part", F.lit("term")).select(columns))
