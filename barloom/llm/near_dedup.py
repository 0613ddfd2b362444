"""Near-duplicate classes: DartMinHash signatures, banded joining, exact verification, connected components."""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from barloom.llm._shared import materialize, scratch, text_or_empty
from barloom.llm._words import U, buffers, chunks, frugal, grams, mix, words

#: Words in a shingle, similarity from which two texts are linked, bands and rows of the signature.
SHINGLE, SIMILARITY, BANDS, ROWS = 5, 0.8, 20, 5
#: Ratio of the sizes in a cell in which shingles meet.
CELL = 1.1
#: Bits by which texts are told apart before they are compared.
BITS = 512
_STEP = U(0x9E3779B97F4A7C15)
#: Distribution function of the number of darts in a region of unit area.
_POISSON = np.cumsum([np.exp(-1.0) / np.prod(np.arange(1.0, n + 1)) for n in range(18)])


def shingles(data: np.ndarray, offsets: np.ndarray, size: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """Shingle hashes of all rows and each shingle's row; a row of fewer than `size` words, but not none, is one shingle."""
    h, _, _, first = words(data, offsets)
    counts = np.diff(first)
    g = grams(h, size)
    doc = np.repeat(np.arange(len(counts)), np.maximum(counts - size + 1, 0))
    begin = np.concatenate([[0], np.cumsum(np.maximum(counts - size + 1, 0))])
    at = np.arange(len(doc)) - begin[doc] + first[doc]
    out, rows = g[at] if len(at) else np.zeros(0, U), doc
    short = np.flatnonzero((counts > 0) & (counts < size))
    if len(short):
        whole = np.array([grams(h[first[d] : first[d + 1]], counts[d])[0] for d in short], dtype=U)
        out, rows = np.concatenate([out, mix(whole + U(1))]), np.concatenate([rows, short])
    return out, rows


def dart_signatures(elements: np.ndarray, doc: np.ndarray, n_docs: int, k: int, weights: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """DartMinHash signatures, (n_docs, k) 64-bit dart names, and which rows have one.

    Each element owns a strip of the (weight, rank) plane, cut into regions of unit area: weights
    [0,1), [1,2), [2,4) and so on, with ranks in steps of 1 over the width. A region's darts, their
    number (Poisson), places and coordinates follow from hashes of element and region alone, so sets that share
    an element share its darts. A dart counts if it lies below the element's weight and below the
    rank limit; the earliest in each of the k coordinates is the signature. The limit t / total weight
    makes about t = k (ln k + 3) darts, and is doubled for rows in which a coordinate stays empty."""
    signature = np.zeros((n_docs, k), dtype=U)
    total = np.bincount(doc, weights=weights, minlength=n_docs)
    limit = k * (np.log(k) + 3) / np.maximum(total, 1e-300)
    todo = total > 0
    has = todo.copy()
    while todo.any():
        mine = todo[doc]
        e, d = elements[mine], doc[mine]
        w = None if weights is None else weights[mine]
        best = np.full(n_docs * k, np.inf)
        found = []
        level, low, high = 0, 0.0, 1.0
        while True:  # the weight ranges
            part = slice(None) if w is None else w > low
            pe, pd, pw = e[part], d[part], None if w is None else w[part]
            if len(pe) == 0:
                break
            width = high - low
            cells = np.ceil(limit[pd] * width).astype(np.int64)
            more = np.repeat(np.arange(len(pe)), cells)
            step = np.arange(len(more)) - np.repeat(np.cumsum(cells) - cells, cells)
            region = mix(pe[more] + U(level * 0xA24BAED4963EE407 % (1 << 64)) + step.astype(U) * U(0x9FB21C651E98DF25))
            darts = np.searchsorted(_POISSON, (region >> U(11)) * 2.0**-53, side="right")
            for j in range(int(darts.max(initial=0))):
                on = np.flatnonzero(darts > j)
                name = mix(region[on] + U((j + 1) * int(_STEP) % (1 << 64)))
                rank = (step[on] + (name >> U(11)) * 2.0**-53) / width
                ok = rank < limit[pd[more[on]]]
                if pw is not None:
                    ok &= low + (mix(name + U(7)) >> U(11)) * 2.0**-53 * width < pw[more[on]]
                on, name, rank = on[ok], name[ok], rank[ok]
                slot = pd[more[on]] * k + (mix(name + U(3)) % U(k)).astype(np.int64)
                np.minimum.at(best, slot, rank)
                found.append((slot, rank, name))
            if w is None:
                break
            level, low, high = level + 1, high, high * 2
        flat = signature.reshape(-1)
        for slot, rank, name in found:
            win = rank == best[slot]
            flat[slot[win]] = name[win]
        todo &= np.isinf(best.reshape(n_docs, k)).any(axis=1)
        limit[todo] *= 2
    return signature, has


def band_values(signature: np.ndarray, rows: int) -> np.ndarray:
    """One 64-bit value for each band of `rows` coordinates, distinct between bands."""
    n, k = signature.shape
    out = np.zeros((n, k // rows), dtype=U)
    for j in range(rows):
        out = out * _STEP + signature[:, j::rows][:, : k // rows]
    return mix(out + np.arange(1, k // rows + 1, dtype=U) * U(0x2545F4914F6CDD1D))


def _signed(data: pa.Array, bands: int, rows: int, size: int, weighted: bool) -> pa.Array:
    data_bytes, offsets = buffers(data)
    parts = []
    for i, j in chunks(offsets):
        s, d = shingles(data_bytes[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i], size)
        w = None
        if weighted and len(s):
            order = np.lexsort((s, d))
            s, d = s[order], d[order]
            new = np.concatenate([[True], (s[1:] != s[:-1]) | (d[1:] != d[:-1])])
            at = np.flatnonzero(new)
            w = np.diff(np.append(at, len(s))).astype(float)
            s, d = s[at], d[at]
        sig, has = dart_signatures(s, d, j - i, bands * rows, w)
        values = band_values(sig, rows).view(np.int64)
        lengths = np.where(has, bands, 0)
        parts.append(pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(lengths)]), pa.int32()), pa.array(values[has].reshape(-1))))
    return pa.concat_arrays(parts) if parts else pa.array([], pa.list_(pa.int64()))


def signatures(docs: DataFrame, bands: int = BANDS, rows: int = ROWS, size: int = SHINGLE, weighted: bool = False) -> DataFrame:
    """node, bands for docs of (id, node, text): the band values of each text, none for a text without words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), _signed(b.column(2), bands, rows, size, weighted)], ["id", "node", "bands"])

    return docs.select("id", "node", "text").mapInArrow(frugal(run), f"id {dict(docs.dtypes)['id']}, node binary, bands array<bigint>")


def candidates(members: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Pairs (a, c) to compare first, for members of (node, band), and the members of shared buckets.

    A bucket is led by its most popular member, popularity being the sum of the sizes of a node's buckets: the text that
    others are edited from falls in with most of its copies in most bands. Each node is paired with the most popular
    leader of its buckets, so there is a pair a node at most; `left_out` finds what that leaves unlinked."""
    sizes = members.groupBy("band").agg(F.count(F.lit(1)).alias("size")).where("size > 1")
    shared = materialize(members.join(sizes, "band"), "members")
    popular = shared.groupBy("node").agg(F.sum("size").alias("popularity"))
    ranked = shared.select("node", "band").join(popular, "node").select("band", F.struct("popularity", "node").alias("m"))
    leaders = ranked.groupBy("band").agg(F.max("m").alias("c"))
    best = shared.select("node", "band").join(leaders, "band").where("c.node != node").groupBy("node").agg(F.max("c").alias("c"))
    return best.select(F.col("node").alias("a"), F.col("c.node").alias("c")), shared.select("node", "band")


def _texts_by_rarity(docs: DataFrame, similarity: float, size: int) -> DataFrame:
    """node, root, n (shingles in the text), own (those that no other text has), weight (numbers of texts that have them, added up), bits and prefix: of each text of (node, root, text) with shingles that others have.

    Two texts of the given similarity share one of their n - ceil(similarity n) + 1 rarest shingles; prefix lists those of them that texts of other roots have, with their place (nth) in
    that order, which is one for all texts: by the number of texts that have it, then by its value. bits are 512, of which each shingle that others have turns one over (see `_may_be_similar`)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            data, offsets = buffers(b.column(2))
            for i, j in chunks(offsets):
                s, d = _distinct(*shingles(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i], size))
                n = np.bincount(d, minlength=j - i)
                at = pa.array(d + i)
                yield pa.RecordBatch.from_arrays([b.column(0).take(at), b.column(1).take(at), pa.array(n[d]), pa.array(s.view(np.int64))], ["node", "root", "n", "shingle"])

    every = materialize(docs.select("node", "root", "text").mapInArrow(frugal(run), "node binary, root binary, n bigint, shingle bigint"), "shingled")
    common = every.groupBy("shingle").agg(F.count(F.lit(1)).alias("df"), F.min("root").alias("lo"), F.max("root").alias("hi")).where("df > 1")
    of_others = every.join(common, "shingle").select("node", "root", "n", "df", "shingle", F.expr("lo < hi").alias("open"))
    bits = [F.expr(f"bit_xor(if((shingle & 511) >> 6 = {i}, shiftleft(1L, cast(shingle & 63 as int)), 0L))").alias(f"b{i}") for i in range(BITS // 64)]
    ranked = of_others.groupBy("node", "root", "n").agg(F.count(F.lit(1)).alias("others"), F.sum("df").alias("weight"), *bits, F.sort_array(F.collect_list(F.struct("df", "shingle", "open"))).alias("rare"))
    length = F.col("n") - F.ceil(F.col("n") * similarity - 1e-9) + 1  # shingles that no other text has come before all others
    cut = ranked.withColumn("own", F.col("n") - F.col("others")).withColumn("rare", F.slice("rare", F.lit(1), F.greatest(length - F.col("own"), F.lit(0)).cast("int")))
    prefix = F.expr("transform(filter(transform(rare, (x, i) -> struct(own + i + 1 AS nth, x.shingle AS shingle, x.open AS open)), x -> x.open), x -> struct(x.nth, x.shingle)) AS prefix")
    return cut.select("node", "root", "n", "own", "weight", F.struct(*[f"b{i}" for i in range(BITS // 64)]).alias("bits"), prefix)


def _may_be_similar(x: str, y: str, similarity: float) -> Column:
    """Whether texts x and y (structs of n, own and bits) can have the given similarity.

    Then they differ in at most (n + m) (1 - similarity) / (1 + similarity) shingles, and they do differ in all that no other text has,
    and in at least as many of the rest as bits are unlike."""
    unlike = " + ".join(f"bit_count({x}.bits.b{i} ^ {y}.bits.b{i})" for i in range(BITS // 64))
    near = F.least(F.col(f"{x}.n"), F.col(f"{y}.n")) >= F.greatest(F.col(f"{x}.n"), F.col(f"{y}.n")) * similarity - 1e-9
    return near & (F.expr(f"{x}.own + {y}.own + {unlike}") <= (F.col(f"{x}.n") + F.col(f"{y}.n")) * ((1 - similarity) / (1 + similarity)) + 1e-6)


def _rooted(shared: DataFrame, roots: DataFrame, texts: DataFrame, similarity: float, size: int) -> DataFrame:
    """`_texts_by_rarity` of all texts of buckets whose members are not in one component."""
    rooted = shared.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    split = rooted.groupBy("band").agg(F.min("root").alias("lo"), F.max("root").alias("hi")).where("lo < hi").select("band")
    open_nodes = materialize(rooted.join(split, "band", "left_semi").select("node", "root").distinct(), "open")
    return materialize(_texts_by_rarity(texts.join(open_nodes, "node"), similarity, size), "rare")


def _central(rare: DataFrame, similarity: float) -> DataFrame:
    """Pairs (a, c) of each text with the weightiest ones that share a shingle of its prefix, if these are of other roots and can be similar: no more pairs than prefixes have shingles.

    A text's weight is what it has in common with all texts, so that of edited copies the one with the fewest edits comes first: the one that most of what
    can be linked at all is linked with."""
    rows = rare.select(F.struct("weight", "node", "root", "n", "own", "bits").alias("t"), F.explode("prefix.shingle").alias("shingle"))
    centers = rows.groupBy("shingle").agg(F.max("t").alias("c"))
    return rows.join(centers, "shingle").where((F.col("t.root") != F.col("c.root")) & _may_be_similar("t", "c", similarity)).select(F.col("t.node").alias("a"), F.col("c.node").alias("c")).distinct()


def _cells(rare: DataFrame, similarity: float) -> DataFrame:
    """key, short, node, root, n, reach, own, bits, main: the rows that meet (see `left_out`), a row for each cell of several roots that a shingle of a text's prefix is in; `main` tells those of a cell's most frequent root."""
    n = F.col("n")
    prefix = rare.withColumn("_p", F.explode("prefix")).select("*", "_p.nth", "_p.shingle")
    prefix = prefix.withColumn("reach", F.floor((n - F.col("nth") + 1) * ((1 + similarity) / similarity) - n + 1e-9))
    cell = lambda x: F.floor(F.log(x.cast("double")) / float(np.log(CELL)) + 1e-9)
    least = F.ceil(n * similarity - 1e-9)
    short = prefix.where("reach >= n").withColumn("s", cell(n)).withColumn("l", F.explode(F.sequence(cell(n), cell(F.least(F.floor(n / similarity + 1e-9), F.col("reach"))))))
    long = prefix.where(F.col("reach") >= least).withColumn("l", cell(n)).withColumn("s", F.explode(F.sequence(cell(least), cell(F.least(n, F.col("reach"))))))
    row = lambda d, is_short: d.select(F.xxhash64("shingle", "s", "l").alias("key"), F.lit(is_short).alias("short"), "node", "root", "n", "reach", "own", "bits")
    rows = row(short, True).union(row(long, False))
    per = rows.groupBy("key", "root").agg(F.count(F.lit(1)).alias("times")).groupBy("key").agg(F.max_by("root", "times").alias("most"), F.count(F.lit(1)).alias("roots")).where("roots > 1")
    return materialize(rows.join(per.select("key", "most"), "key").withColumn("main", F.expr("root = most")).drop("most"), "cells")


def _meeting(cells: DataFrame, similarity: float) -> DataFrame:
    """Pairs (a, c) of the rows of `_cells` that can be similar."""
    side = lambda short, end: cells.where("short" if short else "not short").select("key", F.struct("node", "root", "n", "reach", "own", "bits", "main").alias(end))
    x, y = side(True, "x"), side(False, "y")
    fits = F.expr("x.root != y.root and x.reach >= y.n and y.reach >= x.n and (x.n < y.n or x.n = y.n and x.node < y.node)") & _may_be_similar("x", "y", similarity)
    parts = [x.where(m).join(y.where(k), "key").where(fits).select(F.col("x.node").alias("a"), F.col("y.node").alias("c")) for m, k in (("not x.main", "true"), ("x.main", "not y.main"))]
    return reduce(DataFrame.union, parts).distinct()


def left_out(shared: DataFrame, roots: DataFrame, texts: DataFrame, similarity: float, size: int) -> DataFrame:
    """Pairs (a, c) of nodes in different components that can still be similar, among all texts (node, text) of buckets whose members are not in one component.

    Similar texts share one of their rarest shingles (see `_texts_by_rarity`). Texts of n and m shingles need similarity (n + m) / (1 + similarity)
    in common, and where the first shared one is at place nth of a text, no more than n - nth + 1 are: so a shingle at a
    late place reaches partners of few sizes only. Shingles meet in cells of sizes that both can reach, and
    in a cell the rows of its most frequent component meet only those of others, and of these only those that by their bits can be similar (`_may_be_similar`). What many texts share, such as a common
    passage or the body of a large class, thus pairs nobody, and no pair of the given similarity is lost."""
    return _meeting(_cells(_rooted(shared, roots, texts, similarity, size), similarity), similarity)


def united(roots: DataFrame, links: DataFrame) -> DataFrame:
    """roots (node, root) after the components that links (a, c) of their nodes join have become one."""
    root = lambda c: roots.select(F.col("node").alias(c), F.col("root").alias(f"r{c}"))
    joined = components(links.join(root("a"), "a").join(root("c"), "c").select(F.col("ra").alias("a"), F.col("rc").alias("c")).distinct())
    joined = joined.select(F.col("node").alias("root"), F.col("root").alias("least"))
    return materialize(roots.join(joined, "root", "left").select("node", F.coalesce("least", "root").alias("root")), "roots")


def completed(shared: DataFrame, roots: DataFrame, texts: DataFrame, similarity: float, size: int) -> DataFrame:
    """node, root of all nodes of shared buckets, after the links that `left_out` finds.

    Where chance has given a large class a poor leader, many of its texts are still alone, and each would meet all of that class. So texts are
    compared with the central ones first (`_central`), what is linked becomes one, and only then all remaining pairs are compared."""
    roots = materialize(shared.select("node").distinct().join(roots, "node", "left").select("node", F.coalesce("root", "node").alias("root")), "roots")
    rare = _rooted(shared, roots, texts, similarity, size)
    links = materialize(verified(_central(rare, similarity), texts, similarity, size), "central")
    if not links.isEmpty():
        roots = united(roots, links)
        rare = rare.drop("root").join(roots, "node")
    links = materialize(verified(_meeting(_cells(rare, similarity), similarity), texts, similarity, size), "more")
    return roots if links.isEmpty() else united(roots, links)


def _distinct(s: np.ndarray, d: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each shingle of a row once, rows in order."""
    order = np.lexsort((s, d))
    s, d = s[order], d[order]
    new = np.concatenate([[True], (s[1:] != s[:-1]) | (d[1:] != d[:-1])]) if len(s) else np.zeros(0, bool)
    return s[new], d[new]


def _jaccard(a: pa.Array, b: pa.Array, size: int) -> np.ndarray:
    out = np.zeros(len(a))
    (da, oa), (db, ob) = buffers(a), buffers(b)
    for i, j in chunks(oa + ob):
        sides = [_distinct(*shingles(data[o[i] : o[j]], o[i : j + 1] - o[i], size)) for data, o in ((da, oa), (db, ob))]
        s, d = (np.concatenate([x[n] for x in sides]) for n in (0, 1))
        order = np.lexsort((s, d))
        s, d = s[order], d[order]
        both = np.bincount(d[1:][(s[1:] == s[:-1]) & (d[1:] == d[:-1])], minlength=j - i)
        union = np.bincount(d, minlength=j - i) - both
        out[i:j] = both / np.maximum(union, 1)
    return out


def verified(pairs: DataFrame, texts: DataFrame, similarity: float, size: int) -> DataFrame:
    """The pairs whose shingle sets have at least this Jaccard similarity, computed from the whole texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            keep = pa.array(_jaccard(b.column(2), b.column(3), size) >= similarity - 1e-12)
            yield pa.RecordBatch.from_arrays([b.column(0).filter(keep), b.column(1).filter(keep)], ["a", "c"])

    one = pairs.join(texts.select(F.col("node").alias("a"), F.col("text").alias("ta")), "a")
    two = one.join(texts.select(F.col("node").alias("c"), F.col("text").alias("tc")), "c")
    return two.select("a", "c", "ta", "tc").mapInArrow(frugal(run), "a binary, c binary")


def components(links: DataFrame) -> DataFrame:
    """node, root for every node of the links (a, c): root is the least node of its connected component.

    Each round replaces a node's label by the least one among its neighbours' and then by that node's own label
    (pointer jumping); minima combine on the map side, so a hub of any degree is no hot task. Every
    round is written to the shared folder; the driver only learns how many labels changed."""
    edges = materialize(links.union(links.select("c", "a")).distinct(), "edges")
    labels = materialize(edges.groupBy("a").agg(F.min("c").alias("m")).select(F.col("a").alias("node"), F.least("a", "m").alias("root")), "labels")
    while True:
        near = edges.join(labels, edges.c == labels.node).groupBy("a").agg(F.min("root").alias("m"))
        step = labels.join(near, labels.node == near.a, "left").select("node", F.col("root").alias("old"), F.least("root", F.coalesce("m", "root")).alias("mid"))
        jump = labels.select(F.col("node").alias("mid"), F.col("root").alias("far"))
        new = materialize(step.join(jump, "mid", "left").select("node", "old", F.least("mid", F.coalesce("far", "mid")).alias("root")), "labels")
        if new.where("old != root").isEmpty():
            return new.select("node", "root")
        labels = new.select("node", "root")


def _row_key(id_: str, node: str) -> Column:
    """Id and text digest of a row as one value that is never null."""
    return F.concat(F.col(node), F.encode(F.coalesce(F.concat(F.lit("="), F.col(id_).cast("string")), F.lit("")), "UTF-8"))


def _classes(docs: DataFrame, id_col: str, text_col: str, similarity: float = SIMILARITY, bands: int = BANDS, rows: int = ROWS, size: int = SHINGLE, weighted: bool = False) -> DataFrame:
    """id, node, class_id, class_size, kept for each row; see near_duplicates."""
    text = text_or_empty(text_col)
    rows_ = docs.select(F.col(id_col).alias("id"), F.unhex(F.sha2(text, 256)).alias("node"), text.alias("text"))
    with scratch(docs.sparkSession):
        signed = materialize(signatures(rows_, bands, rows, size, weighted), "signed", keep=True)
        nodes = signed.groupBy("node").agg(F.min("id").alias("first_id"), F.count(F.lit(1)).alias("copies"))
        pairs, shared = candidates(signed.select("node", F.explode("bands").alias("band")).distinct())
        wanted = shared.select("node").distinct().join(nodes.select("node", "first_id"), "node").select(_row_key("first_id", "node").alias("pick"))
        found = rows_.withColumn("pick", _row_key("id", "node")).join(wanted, "pick", "left_semi")  # by id, too: copies of a text are spread
        texts = materialize(found.dropDuplicates(["pick"]).select("node", "text"), "texts")
        roots = components(verified(pairs, texts, similarity, size))
        roots = completed(shared, roots, texts, similarity, size)
        classed = materialize(nodes.join(roots, "node", "left").select("node", F.coalesce("root", "node").alias("root"), "first_id", "copies"), "classed", keep=True)
    # an id may stand on two texts of one class: the least text of that id is the one that stays
    head = F.min(F.struct(F.col("first_id").isNull(), F.col("first_id"), F.col("node"))).alias("head")
    classes = classed.groupBy("root").agg(F.min("first_id").alias("class_id"), F.sum("copies").alias("class_size"), head)
    named = classed.join(classes, "root").select("node", "class_id", "class_size", F.expr("head.node = node").alias("stays"))
    times = signed.groupBy("id", "node").agg(F.count(F.lit(1)).alias("times"))
    out = times.join(named, "node").select("*", F.explode(F.sequence(F.lit(1).cast("long"), "times")).alias("nth"))
    return out.select("id", "node", "class_id", "class_size", (F.col("id").eqNullSafe(F.col("class_id")) & F.col("stays") & (F.col("nth") == 1)).alias("kept"))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """One row per document: id, class_id (least id of its class), class_size, kept (whether it is the one that stays).

    Classes are the connected components of links between texts whose sets of five-word shingles have
    a Jaccard similarity of 0.8 or more. Of two texts that share a band all links count: those that comparison with the
    leaders of buckets leaves out are sought by their rarest shingles. Options are similarity, bands, rows (of a band), size (words of a shingle) and
    `weighted`, which takes a shingle's count as its weight in the signatures instead of 1; the check of a
    link is on sets either way, so by default signatures estimate that same similarity.

    Null and empty texts are equal texts; equal texts are collapsed first and always share a class. A text with no words links to
    none but its equals, one of fewer than five words is a single shingle. Very long texts are taken whole. Repeated rows and rows with one id share
    a class if their texts do; of rows with one id and text one stays. Ties between texts of the least id go to the least digest. Null ids come last: such a
    row stays only where its class has no id. Empty in, empty out; other columns, whatever their names, are not read."""
    return _classes(docs, id_col, text_col, **options).select(F.col("id").alias(id_col), "class_id", "class_size", "kept")


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The rows of docs that stay, one of each class, with all their columns.

    Rows are known by id and text, so rows of one id with texts of different classes stay or go each by its own; of rows that
    agree in both, that whose other columns come first as JSON stays. Nulls, empty and long texts are as in near_duplicates."""
    kept = _classes(docs, id_col, text_col, **options).where("kept").select(_row_key("id", "node").alias("_key"))
    named = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"), F.col(id_col).alias("_id"), F.unhex(F.sha2(text_or_empty(text_col), 256)).alias("_node"))
    rest = F.to_json(F.struct(*[F.col(f"_row.`{c}`") for c in docs.columns if c not in (id_col, text_col)], F.lit(0).alias("_0")))
    joined = named.select("_row", _row_key("_id", "_node").alias("_key")).join(kept, "_key", "left_semi")
    one = Window.partitionBy("_key").orderBy(rest)
    return joined.withColumn("_n", F.row_number().over(one)).where("_n = 1").select("_row.*")
