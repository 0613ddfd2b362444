"""Clashing column names, very long values, ties and repeated rows of the chat, WARC, BPE and sharding operators."""

import collections
import hashlib

from barloom.llm import bpe, chat, sharding, warc
from barloom.llm.queries import vocabulary_path


def test_chat_ties_long_turns_and_clashing_columns(spark):
    long = "word " * 200_000
    rows = [(1, 0, "user", "b"), (1, 0, "user", "a"), (2, 0, "user", "a"), (2, 0, "user", "b"), (2, 1, "assistant", long), (3, None, None, None), (3, None, None, None), (None, 1, "user", "y"), (None, 0, "user", "x")]
    rows = [(*r, f"c{n}", n, b"f") for n, r in enumerate(rows)]
    turns = spark.createDataFrame(rows, "conv_id int, turn int, role string, text string, conv string, turns int, full binary")
    got = {r["conv_id"]: (r["n_turns"], r["n_copies"], r["rendered"]) for r in chat.format_chats(turns).collect()}
    say = lambda *x: "".join(f"<|im_start|>{r}\n{t}<|im_end|>\n" for r, t in x)
    # turns of one number are in the order of their texts, so conversation 1 is the beginning of 2
    assert got == {2: (3, 1, say(("user", "a"), ("user", "b"), ("assistant", long))), 3: (2, 1, say(("", ""), ("", ""))), None: (2, 1, say(("user", "x"), ("user", "y")))}


def test_warc_long_payloads_ties_and_clashing_columns(spark):
    long = "<p>é" + "long " * 400_000
    rows = [(1, "http://a", long, 9, "x"), (1, "http://a", long, 8, "y"), (2, "http://b", long, 7, "z"), (3, None, None, None, None), (3, None, None, None, None), (None, "u", "", 1, "1")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, id int, payload string")
    got = collections.Counter((r["page_id"], r["record_type"], r["refers_to"], r["payload_bytes"], r["payload_digest"]) for r in warc.archive(pages).collect())
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    n = len(long.encode())
    assert got == {(1, "response", None, n, sha(long)): 1, (1, "revisit", 1, n, sha(long)): 1, (2, "revisit", 1, n, sha(long)): 1, (3, "response", None, 0, sha("")): 2, (None, "response", None, 0, sha("")): 1}


def test_bpe_of_odd_rows(spark):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(vocabulary_path())
    texts = [None, "", "word " * 50_000, "<|endoftext|>a<|endoftext|>", "é漢😀\n\t  x", "same", "same"]
    docs = spark.createDataFrame([(n % 3, x, "a", b"b") for n, x in enumerate(texts)], "doc_id int, text string, id string, ids binary")
    got = collections.Counter((r["doc_id"], tuple(r["ids"]), r["decoded"]) for r in bpe.encode(docs, bpe.read_vocabulary(vocabulary_path()), decoded=True).collect())
    ids = [t.encode(x or "", add_special_tokens=False).ids for x in texts]
    assert got == collections.Counter((n % 3, tuple(x), t.decode(x, skip_special_tokens=False)) for n, x in enumerate(ids))


def test_shards_of_repeated_rows_and_clashing_columns(spark):
    rows = [(1, "same", "s", 1, 0)] * 40 + [(None, None, None, None, None)] * 20 + [(n, "long " * 100_000, "t", 2, 0) for n in range(4)]
    docs = spark.createDataFrame(rows, "doc_id int, text string, source string, r int, cell int")
    got = sharding.interleave(docs, shards=8, rows_per_cell=4).collect()
    per = collections.Counter(r["shard"] for r in got)
    assert len(got) == 64 and set(per.values()) == {8}
    for s in range(8):
        assert sorted(r["slot"] for r in got if r["shard"] == s) == list(range(8))
        of = collections.Counter(r["source"] for r in got if r["shard"] == s)
        assert abs(of["s"] - 5) <= 1 and abs(of[None] - 2.5) <= 1.5
    assert {(r["size"], r["text_crc32"]) for r in got if r["doc_id"] is None} == {(1, 0)}
