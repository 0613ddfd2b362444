"""Toxicity scores: a Levenshtein automaton intersected with a lexicon trie, and context windows around its hits."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barloom.llm._shared import text_or_empty
from barloom.llm._words import buffers, chunks, frugal, words

#: Labelled rows, at most, from which lexicon and weights are learned.
SAMPLE = 20_000
#: Words on either side of a hit that make its context.
CONTEXT = 8
#: Quotation marks.
QUOTES = '"“”„«»‹›'
#: Shortest stem in the lexicon, and shortest terms that may have one and two misspelled letters.
STEM, ONE, TWO = 4, 5, 9


def held_out(id_col: str) -> Column:
    """Rows that only test the scores: those whose id's CRC-32, as text, is a multiple of five."""
    return F.crc32(F.col(id_col).cast("string").cast("binary")) % 5 == 0


class Lexicon:
    """The deterministic product of a trie of terms and the Levenshtein automata of their lengths.

    A state is a set of (trie node, edits so far) together with the least edits of a stem that was
    read through; the subset construction walks trie and edits at once, so only states that some word can reach exist. Terms
    ending in * are stems: any ending may follow."""

    def __init__(self, terms: list[str]):
        children: list[dict[int, int]] = [{}]
        ends: dict[int, int] = {}  # node: edits allowed for the whole word that ends here
        stems: dict[int, int] = {}
        room = [0]  # most edits that any term below the node allows
        for term in terms:
            label = term.removesuffix("*").encode()
            allowed = (len(label) >= ONE) + (len(label) >= TWO)
            node = 0
            room[0] = max(room[0], allowed)
            for byte in label:
                if byte not in children[node]:
                    children[node][byte] = len(children)
                    children.append({})
                    room.append(0)
                node = children[node][byte]
                room[node] = max(room[node], allowed)
            target = stems if term.endswith("*") else ends
            target[node] = allowed
        letters = sorted({b for t in terms for b in t.removesuffix("*").encode()})
        self.kind = np.zeros(256, np.int64)
        self.kind[letters] = np.arange(1, len(letters) + 1)
        none = 3

        def close(items: set[tuple[int, int]]) -> frozenset:
            todo, best = list(items), {}
            while todo:
                node, e = todo.pop()
                if e >= best.get(node, none) or e > room[node]:
                    continue
                best[node] = e
                todo += [(c, e + 1) for c in children[node].values()]  # a letter of the term is missing
            return frozenset(best.items())

        def stem(state: frozenset, read: int) -> int:
            return min([read, *(e for node, e in state if e <= stems.get(node, -1))])

        start = close({(0, 0)})
        begin = (start, stem(start, none))
        found, todo, table = {begin: 0}, [begin], []
        while todo:
            state, read = todo.pop(0)
            row = []
            for byte in [-1, *letters]:
                if read == 0:
                    nxt = (frozenset(), 0)
                else:
                    to: set[tuple[int, int]] = set()
                    for node, e in state:
                        if byte in children[node]:
                            to.add((children[node][byte], e))
                        to.add((node, e + 1))  # a letter too many
                        to.update((c, e + 1) for c in children[node].values())  # another letter
                    closed = close(to)
                    nxt = (closed, stem(closed, read))
                if nxt not in found:
                    found[nxt] = len(found)
                    todo.append(nxt)
                row.append(found[nxt])
            table.append(row)
        self.table = np.array(table, np.int32)
        self.edits = np.full(len(found), none, np.int8)
        self.dead = np.zeros(len(found), bool)
        for (state, read), i in found.items():
            self.edits[i] = min([read, *(e for node, e in state if e <= ends.get(node, -1))])
            self.dead[i] = not state

    def match(self, data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Edits between each word and the nearest term, 3 where no term is near enough; all words step through the table at once."""
        state = np.zeros(len(start), np.int32)
        on, step = np.arange(len(start)), 0
        kinds = self.kind[data] if len(data) else np.zeros(0, np.int64)
        while len(on):
            state[on] = self.table[state[on], kinds[start[on] + step]]
            step += 1
            on = on[(start[on] + step < end[on]) & ~self.dead[state[on]]]
        return self.edits[state]


FEATURES = 3 * 2 * 2 + 2


def features(lexicon: Lexicon, text: pa.Array, context: int = CONTEXT) -> np.ndarray:
    """For each text: presence and log count of hits with 0, 1 and 2 edits, apart for abuse and quotation, the density of abuse, and a length term.

    A hit is quotation if quotation marks stand within `context` words before it and after it."""
    data, offsets = buffers(text)
    out = np.zeros((len(text), FEATURES))
    marks = sorted({q.encode()[0] for q in QUOTES})
    for i, j in chunks(offsets):
        part = data[offsets[i] : offsets[j]]
        edge = offsets[i : j + 1] - offsets[i]
        _, start, end, first = words(part, edge)
        edits = lexicon.match(part, start, end)
        row = np.repeat(np.arange(j - i), np.diff(first))
        hit = np.flatnonzero(edits < 3)
        counts = np.zeros((j - i, 6))
        if len(hit):
            quoted = np.zeros(len(hit), bool)
            is_mark = np.isin(part, marks)
            for n, h in enumerate(hit.tolist()):
                r = row[h]
                a, z = start[max(first[r], h - context)], end[min(first[r + 1] - 1, h + context)]
                low, high = max(edge[r], a - 3), min(edge[r + 1], z + 3)  # a mark beside the outermost words counts, one of another text does not
                if is_mark[low:high].any():
                    before = part[low : start[h]].tobytes().decode("utf-8", "ignore")
                    after = part[end[h] : high].tobytes().decode("utf-8", "ignore")
                    quoted[n] = any(q in before for q in QUOTES) and any(q in after for q in QUOTES)
            np.add.at(counts, (row[hit], edits[hit] * 2 + quoted), 1)
        n_words = np.diff(first)
        out[i:j, 0:6] = counts > 0
        out[i:j, 6:12] = np.log1p(counts)
        out[i:j, 12] = counts[:, [0, 2, 4]].sum(axis=1) * 20 / np.maximum(n_words, 20)
        out[i:j, 13] = np.log1p(n_words) / 10
    return out


def fit_logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray | None = None, ridge: float = 1.0, rounds: int = 30) -> np.ndarray:
    """Weights (the last is the constant) of a ridge logistic regression by Newton's method."""
    x = np.hstack([x, np.ones((len(x), 1))])
    w = np.zeros(x.shape[1])
    s = np.ones(len(x)) if weight is None else weight
    penalty = ridge * np.eye(x.shape[1])
    penalty[-1, -1] = 1e-6
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (s * p * (1 - p))[:, None]).T @ x + penalty, x.T @ (s * (y - p)) - penalty @ w)
        w += step
        if np.abs(step).max() < 1e-8:
            break
    return w


@dataclass
class Model:
    terms: list[str]
    lexicon: Lexicon
    weights: np.ndarray | None

    def scores(self, text: pa.Array) -> np.ndarray:
        if self.weights is None:
            return np.zeros(len(text))
        x = features(self.lexicon, text)
        return 1 / (1 + np.exp(-np.clip(x @ self.weights[:-1] + self.weights[-1], -30, 30)))


def training_rows(docs: DataFrame, labels: DataFrame, sample: int, id_col: str, text_col: str, label_col: str) -> DataFrame:
    """At most `sample` labelled texts outside the held-out fifth, those with the least digest of the id; y is 0 or 1."""
    own = labels.select(F.col(id_col).alias("id"), F.col(label_col).cast("double").alias("y")).where(F.col("y").isin(0.0, 1.0) & F.col("id").isNotNull())
    own = own.where(~held_out("id")).groupBy("id").agg(F.max("y").alias("y")).orderBy(F.md5(F.col("id").cast("string")), "id").limit(sample)
    rows = docs.select(F.col(id_col).alias("id"), F.lower(text_or_empty(text_col)).alias("text"))
    found = rows.join(F.broadcast(own), "id").groupBy("id").agg(F.min("text").alias("text"), F.max("y").alias("y"))  # at most `sample` rows, however often an id occurs
    # copies would lend weight to whatever else stands in them: of equal texts one is taken
    return found.groupBy("text").agg(F.max("y").alias("y"))


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic") -> Model:
    """Learn the lexicon (words and stems that mark toxic texts) and the weights of the features from labelled rows."""
    rows = training_rows(docs, labels, sample, id_col, text_col, label_col)
    totals = rows.agg(F.sum("y").alias("bad"), F.count(F.lit(1)).alias("all"), F.sum(F.length("text")).alias("size")).first()
    bad, good = totals["bad"] or 0.0, totals["all"] - (totals["bad"] or 0.0)
    if not bad or not good:
        return Model([], Lexicon([]), None)
    found = rows.select("y", F.explode(F.array_distinct(F.regexp_extract_all("text", F.lit(r"[\p{L}\p{N}]+"), 0))).alias("word"))
    of_word = found.groupBy("word").agg(F.sum("y").alias("a"), F.count(F.lit(1)).alias("n"))
    # stems are counted from the words' counts: a text counts once for each of its words with the stem
    stems = F.transform(F.sequence(F.lit(STEM), F.lit(STEM + 3)), lambda n: F.when(F.length("word") > n, F.concat(F.substring("word", F.lit(1), n), F.lit("*"))))
    both = of_word.select("a", "n", F.explode(F.array_compact(F.concat(F.array("word"), stems))).alias("term"))
    counts = both.groupBy("term").agg(F.sum("a").alias("a"), F.sum(F.col("n") - F.col("a")).alias("b"))
    # log likelihood of the labels under the term's own rate against the rate of all; chance alone seldom exceeds the log of the number of terms
    share, own = bad / (bad + good), F.col("a") / (F.col("a") + F.col("b"))
    gain = F.col("a") * F.log(own / share) + F.when(F.col("b") > 0, F.col("b") * F.log((1 - own) / (1 - share))).otherwise(0.0)
    least = 5 + np.log(max(1.0, float(totals["size"] or 0)))
    top = counts.where((F.col("a") >= max(3.0, 0.01 * bad)) & (own > 0.9) & (gain >= least)).collect()  # words that mark one in a hundred toxic texts of the sample: no more than a hundred times what such a text has
    chosen: list[str] = []
    stems_: set[str] = set()
    top.sort(key=lambda r: r["term"])
    for r in sorted(top, key=lambda r: (not r["term"].endswith("*"), len(r["term"]), r["term"])):
        t = r["term"].removesuffix("*")
        if any(t[:n] in stems_ for n in range(STEM, len(t) + 1)) or r["term"].endswith("*") and any(x["term"].startswith(t) and not x["term"].endswith("*") and x["a"] >= 0.9 * r["a"] for x in top):
            continue  # covered by a shorter stem, or a stem that stands for one word
        chosen.append(r["term"])
        if r["term"].endswith("*"):
            stems_.add(t)
    strength = {r["term"]: r["a"] for r in top}
    chosen = sorted(chosen, key=lambda t: (-strength[t], t))
    lexicon = Lexicon(chosen)
    held = docs.sparkSession.sparkContext.broadcast(lexicon)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = features(held.value, b.column(0))
            yield pa.RecordBatch.from_arrays([pa.FixedSizeListArray.from_arrays(pa.array(x.reshape(-1)), FEATURES).cast(pa.list_(pa.float64())), b.column(1)], ["x", "y"])

    got = rows.select("text", "y").mapInArrow(frugal(run), "x array<double>, y double").collect()  # at most `sample` rows of a few numbers
    x, y = np.array([r["x"] for r in got]), np.array([r["y"] for r in got])
    return Model(chosen, lexicon, fit_logistic(x, y))


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: id, held_out, score (0 to 1), predicted.

    The score reads the text alone. Null counts as empty; empty texts get the score of no hits and no words.
    Very long texts are taken whole, and a text's score does not depend on its neighbours. A null id is not held out. Repeated rows each keep theirs, ties get equal scores; empty in, empty out;
    other columns, whatever their names, are not read."""
    held = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(held.value.scores(pc.utf8_lower(b.column(1))))], ["id", "score"])

    rows = docs.select(F.col(id_col).alias("id"), text_or_empty(text_col).alias("text"))
    out = rows.mapInArrow(frugal(run), f"id {dict(rows.dtypes)['id']}, score double")
    return out.select(F.col("id").alias(id_col), F.coalesce(held_out("id"), F.lit(False)).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def gentle(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """The rows of docs whose text is not predicted toxic, with all their columns; each by its own text, whatever its id. Null and empty texts score as in `score`."""
    held, at = docs.sparkSession.sparkContext.broadcast(model), docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield b.filter(pa.array(held.value.scores(pc.utf8_lower(b.column(at))) < 0.5))

    return docs.mapInArrow(frugal(run), docs.schema)
