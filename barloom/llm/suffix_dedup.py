"""Removal of repeated byte strings by deep-shallow suffix sorting, in tasks over anchored spans.

Sorting all suffixes of a corpus moves every position. Here each window of `length` bytes belongs to one
content-chosen anchor, so equal windows lie at equal offsets of equal anchors, and only anchors that occur
more than once can hold repeats. Spans (all windows of an anchor) with equal bytes are pre-aggregated by a keyed digest
of those bytes, whose secret is new in each run; where spans of one anchor differ, at the ends of a repeated passage, their
suffixes are sorted to depth `length`. Rolling hashes choose anchors and bring spans together; they never decide equality."""

from __future__ import annotations

import secrets
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from barloom.llm._anchors import anchors, digests, pieces
from barloom.llm._shared import materialize, partitions, scratch, text_or_empty
from barloom.llm._words import U, buffers, mix, prefix_hash, span_hash

LENGTH = 200
#: Bytes that multikey quicksort orders before blind tries take over.
SHALLOW = 16
#: Different spans of one anchor above which they are split into blocks, and how far apart the windows of a block start.
HOT, BLOCKS = 128, (16, 4, 1)
#: Windows that are sorted at a time.
BLOCK = 40_000
#: Bytes of cut spans that are handed on at a time.
CUT_BYTES = 1 << 25


def _ranges(group: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    first = np.flatnonzero(np.concatenate([[True], group[1:] != group[:-1]])) if len(group) else np.zeros(0, np.int64)
    return first, np.diff(np.append(first, len(group)))


def _grouped(*keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The order of rows by several keys, and where in that order another group begins."""
    order = np.lexsort(keys[::-1])
    new = np.zeros(max(len(order) - 1, 0), bool)
    for k in keys:
        new |= k[order][1:] != k[order][:-1]
    return order, np.concatenate([[True], new]) if len(order) else new


def deep_shallow(strings: np.ndarray, group: np.ndarray, shallow: int = SHALLOW) -> tuple[np.ndarray, np.ndarray]:
    """Order of fixed-length byte strings (rows) within their groups, and for that order the class of equal strings.

    Shallow: multikey quicksort with 8 bytes as one character, all groups at once; only ties go on to
    the next character. Deep: what still ties shares at least `shallow` bytes and goes to blind tries: the strings of a tie are
    compared with its first one only, the least place of a difference is the trie node's branching
    depth, and the byte there splits the tie, until every leaf holds equal strings."""
    n, width = strings.shape
    order = np.argsort(group, kind="stable")
    _, sizes = _ranges(group[order])
    tie = np.repeat(np.arange(len(sizes)), sizes)

    def split(at: np.ndarray, key: np.ndarray) -> None:
        """Sort the rows of `order` at the places `at` by tie and key; those that differ get different ties."""
        nonlocal tie
        by = np.lexsort((key, tie[at]))
        order[at] = order[at][by]
        key = key[by]
        cut = np.zeros(n, np.int64)
        new = (key[1:] != key[:-1]) & (tie[at][1:] == tie[at][:-1])
        cut[at[1:][new]] = 1
        tie = tie + np.cumsum(cut)

    def tied() -> np.ndarray:
        first, count = _ranges(tie)
        return np.flatnonzero(np.repeat(count > 1, count))

    for depth in range(0, min(shallow, width // 8 * 8), 8):
        at = tied()
        if not len(at):
            break
        split(at, np.ascontiguousarray(strings[order[at], depth : depth + 8]).view(">u8").reshape(-1).astype(U))
    at = tied()
    while len(at):
        first, count = _ranges(tie[at])
        rows = strings[order[at]]
        differs = rows != rows[np.repeat(first, count)]
        place = np.where(differs.any(axis=1), differs.argmax(axis=1), width)
        branch = np.minimum.reduceat(place, first)
        go = np.repeat(branch < width, count)
        if not go.any():
            break
        key = rows[np.arange(len(at)), np.minimum(np.repeat(branch, count), width - 1)]
        at = at[go]
        split(at, key[go])
        first, count = _ranges(tie[at])
        at = at[np.repeat(count > 1, count)]
    return order, tie


def _anchored(length: int, secret: bytes):
    names = ["key", "span", "more", "node", "first", "stop", "anchor", "repeated", "counts"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            data, offsets = buffers(b.column(1))
            got = []
            for i, j, base, end in pieces(offsets, length):
                key, row, a, first, stop = anchors(data[base:end], np.clip(offsets[i : j + 1], base, end) - base, length)
                span, more = digests(data[base:end], first, stop + length, a - first, secret)
                start = (offsets[i : j + 1] - base)[row]
                got.append((key, span, more, row + i, first - start, stop - start, a - start))
            key, span, more, row, first, stop, a = (np.concatenate([x[c] for x in got]) for c in range(7)) if got else [np.zeros(0, np.int64)] * 7
            # equal spans of this batch: the first stands for them in the count, and all are known to repeat
            order, new = _grouped(key, span, more)
            times = np.diff(np.append(np.flatnonzero(new), len(key)))
            repeated, leads = np.zeros(len(key), bool), np.zeros(len(key), bool)
            repeated[order] = np.repeat(times > 1, times)
            leads[order] = new
            cols = [*(pa.array(x.view(np.int64)) for x in (key, span, more)), b.column(0).take(pa.array(row)), pa.array(first.astype(np.int32)), pa.array(stop.astype(np.int32)), pa.array(a.astype(np.int32)), pa.array(repeated), pa.array(leads)]
            yield pa.RecordBatch.from_arrays(cols, names)

    return run


#: Columns of spans with their bytes; in rows without, the whole range is known to repeat.
_CUT = "g bigint, node binary, first int, stop int, anchor int, repeated boolean, hot boolean, cut binary"
_CUT_NAMES = ["g", "node", "first", "stop", "anchor", "repeated", "hot", "cut"]


def _pieces(at: np.ndarray, to: np.ndarray, limit: int) -> Iterator[tuple[int, int]]:
    """Ranges of rows whose byte ranges at:to have about limit bytes together."""
    ends = np.cumsum(to - at)
    x = 0
    while x < len(at):
        y = max(x + 1, int(np.searchsorted(ends, (ends[x - 1] if x else 0) + limit, side="right")))
        yield x, y
        x = y


def _copied(data: np.ndarray, at: np.ndarray, to: np.ndarray) -> pa.Array:
    """The bytes of each range at:to as one Arrow column."""
    o = np.concatenate([[0], np.cumsum(to - at)]).astype(np.int32)
    take = np.repeat(at - o[:-1], to - at) + np.arange(o[-1])
    return pa.Array.from_buffers(pa.binary(), len(at), [None, pa.py_buffer(o), pa.py_buffer(np.ascontiguousarray(data[take]))])


def _cut(length: int):
    """Bytes of the spans that are to be sorted."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            data, offsets = buffers(b.column(1))
            spans = b.column(2)
            row = np.repeat(np.arange(len(spans)), np.diff(spans.offsets.to_numpy()))
            flat = spans.flatten()
            key, first, stop, a, known, hot = (flat.field(n).to_numpy(zero_copy_only=False) for n in ("key", "first", "stop", "anchor", "repeated", "hot"))
            g = mix(key.view(U)).view(np.int64)
            at, to = offsets[row] + first, offsets[row] + stop + length
            for x, y in _pieces(at, to, CUT_BYTES):
                cols = [pa.array(g[x:y], pa.int64()), b.column(0).take(pa.array(row[x:y])), *(pa.array(v[x:y].astype(np.int32)) for v in (first, stop, a)), pa.array(known[x:y]), pa.array(hot[x:y]), _copied(data, at[x:y], to[x:y])]
                yield pa.RecordBatch.from_arrays(cols, _CUT_NAMES)

    return run


def _split(length: int, width: int, secret: bytes):
    """Spans of hot groups cut into blocks of windows that start `width` places or fewer apart, grouped anew by the bytes that all windows of a block have in common.

    Blocks lie at fixed offsets of the anchor, so two equal windows are in the same block of either span and their blocks share
    those bytes. Of equal blocks of a batch one goes on; all of them repeat, and those not known to are returned without bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            g, first, stop, a, known = (b.column(_CUT_NAMES.index(n)).to_numpy(zero_copy_only=False) for n in ("g", "first", "stop", "anchor", "repeated"))
            data, offsets = buffers(b.column(_CUT_NAMES.index("cut")))
            for x, y in _pieces(offsets[:-1], offsets[1:], CUT_BYTES):
                prefix = prefix_hash(data[offsets[x] : offsets[y]])
                near, far = (a - stop)[x:y] // width, (a - first)[x:y] // width
                of = np.repeat(np.arange(x, y), far - near + 1)
                block = near[of - x] + np.arange(len(of)) - np.repeat(np.cumsum(far - near + 1) - (far - near + 1), far - near + 1)
                base = offsets[of] - offsets[x] - first[of]  # of the text's first byte in data
                f, s = np.maximum(first[of], a[of] - block * width - width + 1), np.minimum(stop[of], a[of] - block * width)
                core = base + a[of] - block * width
                new = mix(mix(g[of].view(U)) + block.astype(U)) ^ span_hash(prefix, core, core - width + 1 + length)
                order, lead = _grouped(new, *digests(data[offsets[x] : offsets[y]], base + f, base + s + length, a[of] - f, secret))
                times = np.diff(np.append(np.flatnonzero(lead), len(order)))
                twice = np.zeros(len(of), bool)
                twice[order] = np.repeat(times > 1, times)
                go = order[lead]
                go.sort()
                node = b.column(1)
                at, to = (base + f)[go], (base + s)[go] + length
                for u, v in _pieces(at, to, CUT_BYTES):
                    k = go[u:v]
                    cols = [pa.array(new[k].view(np.int64)), node.take(pa.array(of[k])), *(pa.array(c[k].astype(np.int32)) for c in (f, s)), pa.array(a[of[k]].astype(np.int32)), pa.array(known[of[k]] | twice[k]), pa.array(np.zeros(len(k), bool)), _copied(data[offsets[x] :], at[u:v], to[u:v])]
                    yield pa.RecordBatch.from_arrays(cols, _CUT_NAMES)
                k = np.flatnonzero(twice & ~known[of])
                cols = [pa.array(np.zeros(len(k), np.int64)), node.take(pa.array(of[k])), *(pa.array(c[k].astype(np.int32)) for c in (f, s)), pa.array(a[of[k]].astype(np.int32)), pa.array(np.ones(len(k), bool)), pa.array(np.zeros(len(k), bool)), pa.nulls(len(k), pa.binary())]
                yield pa.RecordBatch.from_arrays(cols, _CUT_NAMES)

    return run


def _sorted_repeats(g: np.ndarray, first: np.ndarray, stop: np.ndarray, anchor: np.ndarray, data: np.ndarray, offsets: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows and window starts whose `length` bytes another window of the same group and offset has, too."""
    count = (stop - first + 1).astype(np.int64)
    of = np.repeat(np.arange(len(g)), count)
    step = np.arange(len(of)) - np.repeat(np.cumsum(count) - count, count)
    strings = np.lib.stride_tricks.sliding_window_view(data, length)[offsets[of] + step]
    where = mix(g[of].view(U)) + (anchor[of] - first[of] - step).astype(U)
    order, tie = deep_shallow(strings, where)
    _, size = _ranges(tie)
    hit = order[np.repeat(size > 1, size)]
    hit.sort()
    return of[hit], first[of[hit]] + step[hit]


def _runs(row: np.ndarray, start: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Byte ranges of windows, consecutive starts of a row joined."""
    if not len(row):
        return row, start, start
    cut = np.flatnonzero(np.concatenate([[True], (row[1:] != row[:-1]) | (start[1:] != start[:-1] + 1)]))
    last = np.append(cut[1:], len(row)) - 1
    return row[cut], start[cut], start[last] + length


def _union(start: np.ndarray, stop: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ranges in order of their starts, those that meet or overlap joined."""
    if not len(start):
        return start, stop
    far = np.maximum.accumulate(stop)
    cut = np.flatnonzero(start[1:] > far[:-1])
    return start[np.concatenate([[0], cut + 1])], far[np.concatenate([cut, [len(far) - 1]])]


def _sorter(length: int):
    """Takes rows in the order of g; a group is sorted once its last row is there, groups of up to BLOCK windows together."""

    def emit(held: list[pa.RecordBatch]) -> pa.RecordBatch:
        t = pa.Table.from_batches(held).combine_chunks()
        cut = t.column("cut").chunk(0) if t.num_rows else pa.array([], pa.binary())
        g, first, stop, a, known = (t.column(n).to_numpy() for n in ("g", "first", "stop", "anchor", "repeated"))
        data, offsets = buffers(cut)
        row, start = _sorted_repeats(g, first, stop, a, data, offsets[:-1], length)
        new = ~known[row]
        r, s, e = _runs(row[new], start[new], length)
        node = t.column("node").chunk(0).take(pa.array(r))
        return pa.RecordBatch.from_arrays([node, pa.array(s.astype(np.int32)), pa.array(e.astype(np.int32))], ["node", "start", "stop"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        total = 0
        for b in batches:
            g = b.column(0).to_numpy()
            if not len(g):
                continue
            count = b.column(3).to_numpy().astype(np.int64) - b.column(2).to_numpy() + 1
            sums = np.cumsum(count)
            ends = np.append(np.flatnonzero(g[1:] != g[:-1]) + 1, [])
            ends = ends.astype(np.int64)
            begin, before = 0, 0
            if held and held[-1].column(0)[held[-1].num_rows - 1].as_py() != g[0] and total >= BLOCK:
                yield emit(held)
                held, total = [], 0
            for z in ends.tolist():
                if total + sums[z - 1] - before >= BLOCK:
                    held.append(b.slice(begin, z - begin))
                    yield emit(held)
                    held, total, begin, before = [], 0, z, int(sums[z - 1])
            if begin < len(g):
                held.append(b.slice(begin))
                total += int(sums[-1]) - before
        if held:
            yield emit(held)

    return run


def repeated_ranges(texts: DataFrame, length: int = LENGTH, hot: int = HOT) -> DataFrame:
    """(node, start, stop) byte ranges of repeats for texts of (id, node, text), node being a digest of the text.

    A text that occurs in several rows is one node; all its windows repeat. Ranges of a node may overlap."""
    spark, secret = texts.sparkSession, secrets.token_bytes(32)
    found = texts.select("node", "text").mapInArrow(_anchored(length, secret), "key bigint, span bigint, more bigint, node binary, first int, stop int, anchor int, repeated boolean, counts boolean")
    found = materialize(found, "anchors")
    of_key, of_span = Window.partitionBy("key"), Window.partitionBy("key", "span", "more")
    met = found.where("counts").withColumn("n", F.row_number().over(of_span.orderBy("node", "first")))
    met = met.withColumn("last", F.max("n").over(of_span)).withColumn("rows", F.count(F.lit(1)).over(of_key)).withColumn("spans", F.sum(F.expr("int(n = 1)")).over(of_key))
    met = met.where("rows > 1 or repeated").withColumn("repeated", F.expr("repeated or last > 1"))
    met = materialize(met.select("key", "node", "first", "stop", "anchor", "repeated", "n", "spans"), "met")
    whole = found.where("repeated and not counts").select("node", "first", "stop").union(met.where("repeated").select("node", "first", "stop"))
    whole = whole.select("node", F.col("first").alias("start"), (F.col("stop") + length).alias("stop"))
    open_ = met.where("spans > 1 and n = 1").groupBy("node").agg(F.collect_list(F.struct("key", "first", "stop", "anchor", "repeated", (F.col("spans") > hot).alias("hot"))).alias("of"))
    one = texts.groupBy("node").agg(F.min("id").alias("one_id"))
    open_ = open_.join(one, "node").withColumnRenamed("node", "n")
    cut = texts.join(open_, (F.col("node") == F.col("n")) & F.col("id").eqNullSafe(F.col("one_id"))).select("node", "text", "of")
    cut = materialize(cut.mapInArrow(_cut(length), _CUT), "cut")
    ready, crowded = cut.where("not hot"), cut.where("hot")
    for width in BLOCKS:
        if crowded.isEmpty():
            break
        split = materialize(crowded.mapInArrow(_split(length, width, secret), _CUT), "split")
        whole = whole.union(split.where("cut is null").select("node", F.col("first").alias("start"), (F.col("stop") + length).alias("stop")))
        met_again = split.where("cut is not null").groupBy("g").agg(F.count(F.lit(1)).alias("met")).where("met > 1")  # a block of its own repeats nowhere
        live = materialize(split.where("cut is not null").drop("hot").join(met_again, "g").withColumn("hot", F.expr(f"met > {hot} and {width} > 1")).select(*_CUT_NAMES), "live")
        ready, crowded = ready.union(live.where("not hot")), live.where("hot")
    dealt = ready.drop("hot").repartition(partitions(spark), "g").sortWithinPartitions("g")
    ends = dealt.mapInArrow(_sorter(length), "node binary, start int, stop int")
    return whole.union(ends)


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH) -> DataFrame:
    """One row per document: id, kept (the remaining bytes), n_bytes, n_removed, n_spans.

    A byte goes if it lies in a string of `length` UTF-8 bytes that also starts at another place of the same or
    another document; all occurrences go, overlapping ones too, judged on the input. n_spans counts
    maximal removed runs. Null counts as empty; texts of fewer than `length` bytes stay whole; rows that repeat are
    documents of their own, so long ones go entirely, whatever their ids. Very long texts are taken whole. Empty in, empty out; other columns, whatever their names, are not read."""
    text = text_or_empty(text_col)
    rows = docs.select(F.col(id_col).alias("id"), F.unhex(F.sha2(text, 256)).alias("node"), text.alias("text"))
    with scratch(docs.sparkSession):
        ranges = repeated_ranges(rows, length)
        per = ranges.groupBy("node").agg(F.sort_array(F.collect_list(F.struct("start", "stop"))).alias("ranges"))
        per = materialize(per, "ranges", keep=True)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            data, offsets = buffers(b.column(1))
            ranges = b.column(2)
            lists = ranges.offsets.to_numpy() if ranges.null_count < len(ranges) else None
            valid = ranges.is_valid().to_numpy(zero_copy_only=False)
            flat = ranges.values
            s, e = (flat.field(n).to_numpy() for n in ("start", "stop"))
            kept, size, gone, runs = [], [], [], []
            for i in range(len(ranges)):
                t = data[offsets[i] : offsets[i + 1]]
                begin, end = (s[lists[i] : lists[i + 1]], e[lists[i] : lists[i + 1]]) if valid[i] and lists is not None else (s[:0], e[:0])
                begin, end = _union(begin, end)
                edges = np.concatenate([[0], np.stack([begin, end], axis=1).reshape(-1), [len(t)]])
                kept.append(b"".join(t[x:y].tobytes() for x, y in edges.reshape(-1, 2).tolist()))
                gone.append(int((end - begin).sum()))
                runs.append(len(begin))
                size.append(len(t))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(kept, pa.binary()), *(pa.array(x, pa.int64()) for x in (size, gone, runs))], ["id", "kept", "n_bytes", "n_removed", "n_spans"])

    joined = rows.join(per, "node", "left").select("id", "text", "ranges")
    return joined.mapInArrow(run, f"id {dict(rows.dtypes)['id']}, kept binary, n_bytes bigint, n_removed bigint, n_spans bigint").withColumnRenamed("id", id_col)
