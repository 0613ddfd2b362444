"""The quality and toxicity queries, and the whole pipeline on odd rows, against plain Python."""

import collections
import math
import re

import corpus_pipeline
import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pytest
from test_corpus import SF, odd
from test_pipeline import contaminated, library, near, sha, words

from barloom.llm import quality, queries, toxicity

WORD = re.compile(rb"[0-9A-Za-z\x80-\xff]+")


def texts_of(spark, name="documents"):
    return {r["doc_id"]: (r["text"] or "").encode() for r in spark.read.parquet(f"{SF}/{name}.parquet").collect()}


def plain_measures(t):
    letters = sum(b >= 128 or chr(b).isalpha() for b in t)
    digits, upper = sum(48 <= b <= 57 for b in t), sum(65 <= b <= 90 for b in t)
    space = sum(b == 32 or 9 <= b <= 13 for b in t)
    ws = [w.translate(bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))) for w in WORD.findall(t)]
    ends = sorted({*(m.start() for m in re.finditer(b"\n", t) if m.start() > 0), len(t)}) if t else []
    seen, repeated, begin = set(), 0, 0
    for end in ends:
        if end - begin > 8:
            line = t[begin + (t[begin : begin + 1] == b"\n") : end]
            repeated += (end - begin) * (line in seen)
            seen.add(line)
        begin = end
    solid, n = max(len(t) - space, 1), len(ws)
    symbols = max(len(t) - letters - digits - space, 0)
    stops, markup = sum(b in b".!?" for b in t), sum(b in b"<>{}|\\#*%$&@^~_=" for b in t)
    return [n, symbols / solid, upper / max(letters, 1), digits / solid, repeated / max(len(t), 1), len(set(ws)) / max(min(n, 40 * math.sqrt(max(n, 1))), 1), sum(map(len, ws)) / max(n, 1), n / max(stops, 1), markup / solid]


def plain_posteriors(votes):
    """Dawid-Skene by dictionaries, a document at a time."""
    post = {i: (v.count(1) + 1) / (v.count(1) + 2 * v.count(0) + 2) for i, v in votes.items()}
    for _ in range(100):
        share = min(max(sum(post.values()) / len(post), 1e-4), 1 - 1e-4)
        table = {}
        for c in (0, 1):
            for j in range(9):
                t = [1.0, 1.0, 1.0]
                for i, v in votes.items():
                    t[v[j]] += post[i] if c else 1 - post[i]
                table[c, j] = [x / sum(t) for x in t]
        new = {}
        for i, v in votes.items():
            good, bad = (math.log(s) + sum(math.log(table[c, j][v[j]]) for j in range(9)) for c, s in ((1, share), (0, 1 - share)))
            new[i] = 1 / (1 + math.exp(min(max(bad - good, -500), 500)))
        done = max(abs(new[i] - post[i]) for i in post) < 1e-9
        post = new
        if done:
            break
    return post


def test_quality_query_against_plain_python(spark):
    texts = texts_of(spark)
    votes = {i: quality.votes(np.array([plain_measures(t)]))[0].tolist() for i, t in texts.items()}
    want = plain_posteriors(votes)
    model = quality.fit(spark.read.parquet(f"{SF}/documents.parquet"))
    got = {r["doc_id"]: (r["weak"], r["score"], r["keep"]) for r in queries.op6_quality(spark, SF).collect()}
    assert got.keys() == texts.keys()
    for i, t in texts.items():
        r, s, v = quality.slots(np.frombuffer(t, np.uint8), np.array([0, len(t)]))  # one text alone
        score = 1 / (1 + math.exp(-min(max(float((v * model.weights[s]).sum() + model.weights[-1]), -30), 30)))
        assert got[i][0] == pytest.approx(want[i], abs=1e-6) and got[i][1] == pytest.approx(score, abs=1e-6) and got[i][2] == (got[i][1] >= 0.5)


def distance(a, b, most=2):
    if abs(len(a) - len(b)) > most:
        return most + 1
    d = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, d[0] = d[0], i
        for j, y in enumerate(b, 1):
            last, d[j] = d[j], min(d[j] + 1, d[j - 1] + 1, last + (x != y))
    return d[-1]


def plain_features(terms, t, cache):
    """Hits by trying every term, quotation by looking at every mark near a hit."""
    found = list(WORD.finditer(t))
    counts = [0] * 6
    for k, m in enumerate(found):
        w = m[0]
        if w not in cache:
            best = 3
            for term in terms:
                s = term.rstrip("*").encode()
                allowed = (len(s) >= toxicity.ONE) + (len(s) >= toxicity.TWO)
                heads = {w[:n] for n in range(max(0, len(s) - 2), min(len(w), len(s) + 2) + 1)} if term.endswith("*") else {w}
                e = min((distance(h, s) for h in heads), default=3)
                if e <= allowed:
                    best = min(best, e)
            cache[w] = best
        if cache[w] < 3:
            a, z = found[max(0, k - toxicity.CONTEXT)].start(), found[min(len(found) - 1, k + toxicity.CONTEXT)].end()
            sides = [t[max(0, a - 3) : m.start()], t[m.end() : z + 3]]
            quoted = all(any(q in s.decode("utf-8", "ignore") for q in toxicity.QUOTES) for s in sides)
            counts[cache[w] * 2 + quoted] += 1
    n = len(found)
    return [float(c > 0) for c in counts] + [math.log1p(c) for c in counts] + [(counts[0] + counts[2] + counts[4]) * 20 / max(n, 20), math.log1p(n) / 10]


def test_toxicity_query_against_plain_python(spark):
    docs, labels = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")
    texts = texts_of(spark)
    quote = 'He said "moron" and left.'
    model = toxicity.Model(["moron", "disgusting", "lowei*"], toxicity.Lexicon(["moron", "disgusting", "lowei*"]), np.linspace(-1, 1, toxicity.FEATURES + 1))
    own = {1: quote, 2: "m0ron", 3: '"', 4: "a moron", 5: '"', 6: "disgustng loweixyz “disgusting” end", 7: "", 8: "x " * 30 + "moron " + "y " * 30}
    table = spark.createDataFrame(list(own.items()), "doc_id long, text string").coalesce(1)
    for m, d, t in ((model, table, {i: s.encode() for i, s in own.items()}), (toxicity.fit(docs, labels), docs, texts)):
        cache, got = {}, {r["doc_id"]: r["score"] for r in toxicity.score(d, m).collect()}
        assert got.keys() == t.keys()
        for i, s in t.items():
            low = pc.utf8_lower(pa.scalar(s.decode())).as_py().encode()
            z = float(np.dot(plain_features(m.terms, low, cache), m.weights[:-1]) + m.weights[-1]) if m.weights is not None else None
            assert got[i] == pytest.approx(0.0 if z is None else 1 / (1 + math.exp(-min(max(z, -30), 30))), abs=1e-9), i
    names = {r["doc_id"] for r in queries.op7_toxicity(spark, SF).collect()}
    assert names == texts.keys()


def test_stages_on_odd_rows(spark, tmp_path):
    """All five stages one after the other on nulls, empty and long texts, ties, repeated rows and clashing columns."""
    item, other = (r["text"] for r in spark.read.parquet(f"{SF}/benchmark.parquet").orderBy("item_id").limit(2).collect())
    more = [(7, f"a passage {item} in a text", "en", "s", 1, "x", "y"), (7, "clean words under the same id as another", "en", "s", 1, "x", "z"), (None, f"so {other}", None, None, None, None, None), (None, "no id and clean", "en", "s", 1, None, None)]
    body = " ".join(f"w{i}" for i in range(200))
    more += [(8, body, "en", "s", 1, "", ""), (9, body + " tail", "en", "s", 1, "", ""), (9, body + " other tail", "en", "s", 1, "", "")]
    docs = odd(spark).union(spark.createDataFrame(more, odd(spark).schema))
    rows = [tuple(r) for r in docs.collect()]

    def run(n, table, path):
        out = corpus_pipeline.STAGES[n][1](spark, table, SF)
        out.write.parquet(path)
        return spark.read.parquet(path)

    key = lambda r: (r[0] is None, r[0] or 0)
    got = run(0, docs, f"file://{tmp_path}/0")
    assert got.columns == docs.columns and sorted(map(tuple, got.collect()), key=repr) == sorted(rows, key=repr)  # nothing here is toxic

    groups = collections.defaultdict(list)
    for r in rows:
        groups[re.sub(r"[ \t\n\r\f\v]+", " ", r[1] or "")].append(r)
    want = [min(g, key=lambda r: (*key(r), r[1] or "", repr(r[2:]))) for g in groups.values()]
    got = run(1, got, f"file://{tmp_path}/1")
    left = [tuple(r) for r in got.collect()]
    assert got.columns == docs.columns and sorted((r[:2] for r in left), key=repr) == sorted((r[:2] for r in want), key=repr)

    # plain components over rows numbered in the order of their ids
    order = sorted(left, key=key)
    roots = near({i: r[1] or "" for i, r in enumerate(order)})
    got = run(2, got, f"file://{tmp_path}/2")
    kept = [tuple(r) for r in got.collect()]
    assert len(kept) == len(roots) and {r[0] for r in kept} == {order[i][0] for i in roots} and (8, body) in {r[:2] for r in kept}
    assert not {body + " tail", body + " other tail"} & {r[1] for r in kept}

    items = collections.defaultdict(set)
    for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect():
        w = words(r["text"])
        n = min(len(w), 10)
        if n:
            items[n] |= {tuple(w[k : k + n]) for k in range(len(w) - n + 1)}
    got = run(3, got, f"file://{tmp_path}/3")
    clean = [r for r in kept if not contaminated(r[1], items)]
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(clean, key=repr) and len(clean) == len(kept) - 2
    t, out = library(), run(4, got, f"file://{tmp_path}/4").collect()
    found = collections.Counter((r["doc_id"], tuple(r["ids"]), r["n_tokens"], r["decoded_sha256"]) for r in out)
    ids = [(r[0], t.encode(r[1] or "", add_special_tokens=False).ids) for r in clean]
    assert found == collections.Counter((i, tuple(x), len(x), sha(t.decode(x, skip_special_tokens=False))) for i, x in ids)
