"""Quality scores from weak labels: EM weighs overlapping heuristics, and its posterior labels train a hashed linear scorer."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barloom.llm._shared import text_or_empty
from barloom.llm._words import U, buffers, chunks, mix, prefix_hash, span_hash, words

#: Rows, at most, that train the linear scorer, and slots of its weights.
SAMPLE, SLOTS = 4_000, 1 << 16
HEURISTICS = ("length", "symbols", "capitals", "digits", "repeated_lines", "variety", "word_length", "sentences", "markup")

_B = np.arange(256)
_CLASS = {
    "letter": ((_B | 32) >= 97) & ((_B | 32) <= 122) | (_B >= 128),
    "upper": (_B >= 65) & (_B <= 90),
    "digit": (_B >= 48) & (_B <= 57),
    "space": (_B == 32) | ((_B >= 9) & (_B <= 13)),
    "stop": np.isin(_B, [ord(c) for c in ".!?"]),
    "markup": np.isin(_B, [ord(c) for c in "<>{}|\\#*%$&@^~_="]),
}


def measures(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """For each text: words, and shares of symbols, capitals, digits, repeated lines, distinct words; mean word length, words per sentence, share of markup."""
    n = len(offsets) - 1
    sums = {}
    for name, table in _CLASS.items():
        c = np.concatenate([[0], np.cumsum(table[data])])
        sums[name] = np.diff(c[offsets]).astype(float)
    size = np.diff(offsets).astype(float)
    h, start, end, first = words(data, offsets)
    count = np.diff(first).astype(float)
    row = np.repeat(np.arange(n), np.diff(first))
    order = np.lexsort((h, row))
    new = np.concatenate([[True], (h[order][1:] != h[order][:-1]) | (row[order][1:] != row[order][:-1])]) if len(h) else np.zeros(0, bool)
    distinct = np.bincount(row[order][new], minlength=n)
    length = np.bincount(row, weights=(end - start), minlength=n)
    # lines as spans between line ends
    ends = np.unique(np.concatenate([np.flatnonzero(data == 10), offsets[1:]]))
    ends = ends[(ends > 0) | (len(data) == 0)]
    begins = np.concatenate([[0], ends[:-1]]) if len(ends) else ends
    lines = span_hash(prefix_hash(data), np.minimum(begins + (data[np.minimum(begins, max(len(data) - 1, 0))] == 10 if len(data) else 0), ends), ends)
    long = (ends - begins) > 8
    of = np.clip(np.searchsorted(offsets, begins, side="right") - 1, 0, max(n - 1, 0))[long]
    lines, span = lines[long], (ends - begins)[long]
    order = np.lexsort((lines, of))
    again = np.concatenate([[False], (lines[order][1:] == lines[order][:-1]) & (of[order][1:] == of[order][:-1])]) if len(lines) else np.zeros(0, bool)
    repeated = np.bincount(of[order][again], weights=span[order][again], minlength=n)
    letters = np.maximum(sums["letter"], 1)
    solid = np.maximum(size - sums["space"], 1)
    other = np.maximum(size - sums["letter"] - sums["digit"] - sums["space"], 0)
    # variety falls with length, so it is held against the root of the count
    return np.stack([
        count, other / solid, sums["upper"] / letters, sums["digit"] / solid, repeated / np.maximum(size, 1),
        distinct / np.maximum(np.minimum(count, 40 * np.sqrt(np.maximum(count, 1))), 1), length / np.maximum(count, 1),
        count / np.maximum(sums["stop"], 1), sums["markup"] / solid,
    ], axis=1)


def votes(m: np.ndarray) -> np.ndarray:
    """Votes of the heuristics, in their order: 0 bad, 1 good, 2 no opinion."""
    low = np.array([5, 0.0, 0.0, 0.0, 0.0, 0.35, 2.5, 2.5, 0.0])
    high = np.array([1e9, 0.16, 0.35, 0.15, 0.2, 9.0, 16.0, 80.0, 0.05])
    sure_low = np.array([30, 0.0, 0.0, 0.0, 0.0, 0.5, 3.0, 4.0, 0.0])
    sure_high = np.array([1e9, 0.09, 0.15, 0.05, 0.02, 9.0, 11.0, 40.0, 0.015])
    bad = (m < low) | (m > high)
    good = (m >= sure_low) & (m <= sure_high)
    return np.where(bad, 0, np.where(good, 1, 2))


def expectation_maximization(patterns: np.ndarray, counts: np.ndarray, rounds: int = 100, prior: float = 0.8) -> tuple[np.ndarray, np.ndarray, float]:
    """Posterior of `good` for each vote pattern, the labellers' tables P(vote | class), and the share of good.

    A Dawid-Skene model: votes are independent given the class. It starts from the share of good votes, with one vote of each kind added."""
    seen = patterns[:, :, None] == np.arange(3)
    good, bad = seen[:, :, 1].sum(axis=1), seen[:, :, 0].sum(axis=1)
    post = (good + 1.0) / (good + 2.0 * bad + 2.0)
    share, table = prior, np.zeros((2, patterns.shape[1], 3))
    for _ in range(rounds):
        for c, p in ((0, 1 - post), (1, post)):
            t = np.einsum("n,njv->jv", counts * p, seen) + 1.0
            table[c] = t / t.sum(axis=1, keepdims=True)
        share = float((counts * post).sum() / max(counts.sum(), 1e-9))
        share = min(max(share, 1e-4), 1 - 1e-4)
        logs = [np.log(table[c][np.arange(patterns.shape[1]), patterns]).sum(axis=1) for c in (0, 1)]
        new = 1 / (1 + np.exp(np.clip(np.log(1 - share) + logs[0] - np.log(share) - logs[1], -500, 500)))
        done = np.abs(new - post).max(initial=0.0) < 1e-9
        post = new
        if done:
            break
    return post, table, share


def slots(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashed features as (text, slot, value): words by their shapes and hashes, and the measures in steps, each text with unit norm of its words."""
    h, start, end, first = words(data, offsets)
    n = len(offsets) - 1
    row = np.repeat(np.arange(n), np.diff(first))
    # the byte after a word; a text's last word has a blank there, whatever text comes next
    after = np.where(end < offsets[row + 1], data[np.minimum(end, len(data) - 1)], 32).astype(U) if len(end) else np.zeros(0, U)
    sign = np.concatenate([h % U(SLOTS - 4096), U(SLOTS - 4096) + after % U(256) * U(4) + np.minimum((end - start) // 6, 3).astype(U)]).astype(np.int64)
    both = np.concatenate([row, row])
    key = both * SLOTS + sign
    uniq, times = np.unique(key, return_counts=True)
    r, s, v = uniq // SLOTS, uniq % SLOTS, np.log1p(times.astype(float))
    norm = np.sqrt(np.bincount(r, weights=v * v, minlength=n))
    v = v / np.maximum(norm[r], 1e-9)
    m = measures(data, offsets)
    step = np.minimum((np.log1p(m * np.array([1, 50, 50, 50, 50, 20, 2, 1, 100])) * 4).astype(np.int64), 63)
    base = SLOTS - 3072 + np.arange(m.shape[1]) * 64
    return np.concatenate([r, np.repeat(np.arange(n), m.shape[1])]), np.concatenate([s, (base + step).reshape(-1)]), np.concatenate([v, np.full(m.size, 0.5)])


def fit_hashed(rows: list[tuple[np.ndarray, np.ndarray]], y: np.ndarray, rounds: int = 200, ridge: float = 1e-4) -> np.ndarray:
    """Weights of a logistic regression on soft labels by gradient steps with per-slot scaling; the last is the constant."""
    w = np.zeros(SLOTS + 1)
    if not rows:
        return w
    r = np.repeat(np.arange(len(rows)), [len(s) for s, _ in rows])
    s, v = np.concatenate([x[0] for x in rows]), np.concatenate([x[1] for x in rows]).astype(float)
    seen = np.full(SLOTS + 1, 1e-8)
    for _ in range(rounds):
        z = np.bincount(r, weights=v * w[s], minlength=len(rows)) + w[-1]
        e = 1 / (1 + np.exp(-np.clip(z, -30, 30))) - y
        g = np.append(np.bincount(s, weights=v * e[r], minlength=SLOTS) / len(rows), e.mean()) + ridge * np.append(w[:-1], 0)
        seen += g * g
        w -= 0.5 * g / np.sqrt(seen)
    return w


@dataclass
class Model:
    accuracy: dict[str, float]
    share: float
    posterior: dict[int, float]
    weights: np.ndarray


def _pattern(v: np.ndarray) -> np.ndarray:
    return (v * 3 ** np.arange(v.shape[1])).sum(axis=1)


def patterns(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id and vote pattern (base 3, one digit for each heuristic) of every document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            data, offsets = buffers(b.column(1))
            got = [_pattern(votes(measures(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i]))) for i, j in chunks(offsets)]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(np.concatenate(got) if got else np.zeros(0, np.int64), pa.int64())], ["id", "pattern"])

    rows = docs.select(F.col(id_col).alias("id"), text_or_empty(text_col).alias("text"))
    return rows.mapInArrow(run, f"id {dict(rows.dtypes)['id']}, pattern bigint")


def fit(docs: DataFrame, sample: int = SAMPLE, id_col: str = "doc_id", text_col: str = "text") -> Model:
    """Weigh the heuristics on all documents and train the scorer on `sample` of them, those with the least digest of the id.

    EM runs on the counts of vote patterns, at most 3**9 numbers however many documents there are."""
    counted = patterns(docs, id_col, text_col).groupBy("pattern").count().collect()
    codes, counts = np.array([r["pattern"] for r in counted], np.int64), np.array([r["count"] for r in counted], float)
    digits = codes[:, None] // 3 ** np.arange(len(HEURISTICS)) % 3
    post, table, share = expectation_maximization(digits, counts)
    posterior = dict(zip(codes.tolist(), post.tolist(), strict=True))
    right = [float((share * table[1, j, 1] + (1 - share) * table[0, j, 0]) / max(1e-9, share * table[1, j, :2].sum() + (1 - share) * table[0, j, :2].sum())) for j in range(len(HEURISTICS))]

    chosen = docs.select(F.col(id_col).alias("id"), text_or_empty(text_col).alias("text"))
    names = chosen.select("id").where("id is not null").distinct().orderBy(F.md5(F.col("id").cast("string")), "id").limit(sample)
    chosen = chosen.join(F.broadcast(names), "id").groupBy("id").agg(F.min("text").alias("text")).select("text")  # at most `sample` rows, however often an id occurs

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            data, offsets = buffers(b.column(0))
            for i, j in chunks(offsets):
                part, o = data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i]
                codes_ = _pattern(votes(measures(part, o)))
                r, s, v = slots(part, o)
                order = np.argsort(r, kind="stable")
                cut = np.searchsorted(r[order], np.arange(1, j - i))
                ss, vv = np.split(s[order].astype(np.int32), cut), np.split(v[order].astype(np.float32), cut)
                yield pa.RecordBatch.from_arrays([pa.array(codes_), pa.array([x.tobytes() for x in ss], pa.binary()), pa.array([x.tobytes() for x in vv], pa.binary())], ["pattern", "s", "v"])

    got = chosen.mapInArrow(run, "pattern bigint, s binary, v binary").collect()  # at most `sample` rows of hashed counts
    rows = [(np.frombuffer(r["s"], np.int32), np.frombuffer(r["v"], np.float32)) for r in got]
    return Model(dict(zip(HEURISTICS, right, strict=True)), share, posterior, fit_hashed(rows, np.array([posterior[r["pattern"]] for r in got])))


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: id, weak (the posterior of its votes), score (the linear scorer's, 0 to 1), keep (score of 0.5 or more).

    Null counts as empty; an empty text has bad or no votes throughout; very long texts are taken whole. Repeated rows and null ids each
    keep their row, and a text's scores do not depend on its neighbours; empty in, empty out; other columns, whatever their names, are not read. Labels are never read."""
    held = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = held.value
        for b in batches:
            data, offsets = buffers(b.column(1))
            weak, scores = [], []
            for i, j in chunks(offsets):
                part, o = data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i]
                weak += [m.posterior.get(c, m.share) for c in _pattern(votes(measures(part, o))).tolist()]
                r, s, v = slots(part, o)
                scores.append(1 / (1 + np.exp(-np.clip(np.bincount(r, weights=v * m.weights[s], minlength=j - i) + m.weights[-1], -30, 30))))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(weak, pa.float64()), pa.array(np.concatenate(scores) if scores else np.zeros(0))], ["id", "weak", "score"])

    rows = docs.select(F.col(id_col).alias("id"), text_or_empty(text_col).alias("text"))
    out = rows.mapInArrow(run, f"id {dict(rows.dtypes)['id']}, weak double, score double")
    return out.select(F.col("id").alias(id_col), "weak", "score", (F.col("score") >= 0.5).alias("keep"))
