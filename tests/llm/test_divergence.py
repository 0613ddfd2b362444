"""The source divergence audit against plain Python on odd rows, and its pointer sort."""

import collections
import random
import re

import numpy as np

from barloom.llm import divergence

TERM = re.compile(rb"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")


def plain(rows, documents, terms):
    counts, docs, groups = collections.defaultdict(collections.Counter), collections.defaultdict(collections.Counter), set()
    for lang, source, text in rows:
        lang, source = lang or "", source or ""
        groups.add((lang, source))
        found = TERM.findall(bytes(c + 32 if 65 <= c <= 90 else c for c in (text or "").encode()))
        counts[lang, source].update(found)
        docs[lang].update(set(found))
    out = []
    for lang in {x for x, _ in groups}:
        kept = [t for t, n in docs[lang].items() if n >= documents]
        sources = sorted((s for x, s in groups if x == lang), key=str.encode)
        share = lambda c: {t: 1 + 1_000_000_000 * (c[t] + 1) // (sum(c[k] for k in kept) + len(kept)) for t in kept}
        whole = share(sum((counts[lang, s] for s in sources), collections.Counter()))
        p = {s: share(counts[lang, s]) for s in sources}
        for s in sources:
            pairs = [(-sum((p[s][t] - p[o][t]) ** 2 // p[o][t] for t in kept), o) for o in sources if o != s]
            out += [(lang, s, "pair", o, -v, k + 1) for k, (v, o) in enumerate(sorted(pairs, key=lambda x: (x[0], x[1].encode())))]
            own = [(-((p[s][t] - whole[t]) ** 2 // whole[t]), t) for t in kept if counts[lang, s][t] and p[s][t] > whole[t]]
            out += [(lang, s, "term", t.decode(), -v, k + 1) for k, (v, t) in enumerate(sorted(own)[:terms])]
    return sorted(out)


def rows_(n=120):
    r = random.Random(3)
    words = ["the", "The", "of", "ab", "abcdefgh", "abcdefghi", "abcdefghij", "abcdefgh-ijk", "été", "漢字", "É", "x" * 70, "x" * 70 + "y", "x" * 300, "don't", "a1b", "w_z"]
    rows = [(r.choice(["en", "fr", "", None]), r.choice(["s1", "s2", "s3", "", None, "é"]), " ".join(r.choice(words) for _ in range(r.choice([0, 1, 3, 40])))) for _ in range(n)]
    return rows + [("de", "only", "one two"), ("de", "other", None), ("de", None, ""), ("xx", "s1", "alone alone alone"), ("xx", "s1", "alone"), ("xx", "s1", "alone"), ("en", "s1", None)] + rows[:9]


def test_divergence_against_plain_python(spark, monkeypatch):
    rows = rows_()
    docs = spark.createDataFrame([(k, *r, "n") for k, r in enumerate(rows)], "doc_id int, lang string, source string, text string, term string").repartition(3)
    got = sorted(tuple(r[c] for c in ("lang", "source", "part", "item", "value", "rank")) for r in divergence.divergence(docs).collect())
    assert got == plain(rows, 3, 200)
    monkeypatch.setattr(divergence, "SOURCES", 2)
    got = sorted(tuple(r[c] for c in ("lang", "source", "part", "item", "value", "rank")) for r in divergence.divergence(docs, documents=1, terms=4).collect())
    assert got == plain(rows, 1, 4)
    assert divergence.divergence(docs.limit(0)).count() == 0


def test_long_rows_in_slices(spark):
    rows = [r for r in rows_() if r[2]] + [("en", "s9", "été " * 900 + "x" * 500 + " ab the")]
    docs = spark.createDataFrame(rows, "lang string, source string, text string").na.fill("")
    got = collections.Counter()
    for r in divergence.term_counts(docs.coalesce(1), limit=64).where("term is not null").collect():
        got[r["lang"], r["source"], r["term"], "n"] += r["n"]
        got[r["lang"], r["source"], r["term"], "rows"] += r["rows"]
    want = collections.Counter()
    for lang, source, text in rows:
        found = TERM.findall(bytes(c + 32 if 65 <= c <= 90 else c for c in text.encode()))
        for t in found:
            want[lang or "", source or "", t.decode(), "n"] += 1
        for t in set(found):
            want[lang or "", source or "", t.decode(), "rows"] += 1
    assert got == want


def test_pointer_sort_orders_words():
    r = random.Random(8)
    words = [("".join(r.choice("ab") for _ in range(r.choice([1, 8, 9, 63, 64, 65, 130, 700])))) * r.choice([1, 1, 2]) for _ in range(300)]
    words += words[:80] + ["a" * 3000, "a" * 3000, "a" * 2999 + "b", "a" * 2999]
    data = np.frombuffer((" ".join(words)).encode(), np.uint8)
    start, end = divergence.pointers(data)
    group = np.array([r.randrange(3) for _ in words])
    order, new = divergence.pointer_sort(data, start, end, group)
    keys = [(int(group[k]), words[k], k) for k in order]
    assert keys == sorted(keys)
    assert new.tolist() == [k == 0 or keys[k][:2] != keys[k - 1][:2] for k in range(len(keys))]
