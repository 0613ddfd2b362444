"""A run of the pipeline, each stage held against plain Python; digests of BPE and toxicity queries."""

import collections
import hashlib
import itertools
import re

import corpus_pipeline
import pyarrow as pa

from barloom.llm import near_dedup, queries, toxicity

SF = "/root/testdata/sf0.001"


def sha(s):
    return hashlib.sha256(s.encode()).hexdigest()


def words(text):
    return [re.sub("[A-Z]", lambda m: m[0].lower(), w) for w in re.findall(r"[0-9A-Za-z\u0080-\U0010ffff]+", text or "")]


def first_of(groups):
    return {min(g) for g in groups}


def near(docs):
    sets = {i: frozenset(near_dedup.shingles(*near_dedup.buffers(pa.array([t])))[0].tolist()) for i, t in docs.items()}
    root = {i: i for i in docs}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, j in itertools.combinations(sorted(docs), 2):
        both = len(sets[i] & sets[j])
        if docs[i] == docs[j] or (both and both / (len(sets[i]) + len(sets[j]) - both) >= 0.8):
            a, b = sorted((find(i), find(j)))
            root[b] = a
    return {find(i) for i in docs}


def contaminated(text, items):
    w = words(text)
    for n, known in items.items():
        if any(tuple(w[k : k + n]) in known for k in range(len(w) - n + 1)):
            return True
    return False


def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(queries.vocabulary_path())


def test_each_stage_of_a_run(spark, monkeypatch):
    paths = []
    new_path = corpus_pipeline.new_path
    monkeypatch.setattr(corpus_pipeline, "new_path", lambda *a: paths.append(new_path(*a)) or paths[-1])
    out = corpus_pipeline.run(spark, SF).collect()
    table = spark.read.parquet(f"{SF}/documents.parquet")
    docs = {r["doc_id"]: r["text"] or "" for r in table.collect()}
    assert len(docs) == table.count() == 200 and len(paths) == 5
    stages = [sorted(r["doc_id"] for r in spark.read.parquet(p).collect()) for p in paths]

    model = toxicity.fit(table, spark.read.parquet(f"{SF}/labels.parquet"))
    bad = {r["doc_id"] for r in toxicity.score(table, model).where("predicted = 1").collect()}
    assert stages[0] == sorted(docs.keys() - bad)
    groups = collections.defaultdict(list)
    for i in stages[0]:
        groups[re.sub(r"[ \t\n\r\f\v]+", " ", docs[i])].append(i)
    assert stages[1] == sorted(first_of(groups.values()))
    assert stages[2] == sorted(near({i: docs[i] for i in stages[1]}))
    items = collections.defaultdict(set)
    for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect():
        w = words(r["text"])
        n = min(len(w), 10)
        if n:
            items[n] |= {tuple(w[k : k + n]) for k in range(len(w) - n + 1)}
    assert stages[3] == sorted(i for i in stages[2] if not contaminated(docs[i], items))
    assert len(docs) > len(stages[1]) > len(stages[2]) > len(stages[3]) > 0
    t = library()
    assert sorted(r["doc_id"] for r in out) == stages[3]
    for r in out:
        ids = t.encode(docs[r["doc_id"]], add_special_tokens=False).ids
        assert r["ids"] == ids and r["n_tokens"] == len(ids) and r["decoded_sha256"] == sha(t.decode(ids, skip_special_tokens=False))


def test_bpe_query_digests_of_all_rows(spark):
    docs = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    t, got = library(), queries.op8_bpe(spark, SF).collect()
    assert len(got) == len(docs)
    for r in got:
        ids = t.encode(docs[r["doc_id"]], add_special_tokens=False).ids
        want = (len(ids), sha(",".join(map(str, ids))), sha(t.decode(ids, skip_special_tokens=False)))
        assert (r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) == want
