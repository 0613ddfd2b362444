"""Equality rests on bytes: texts made to agree under rolling hashes, and brute force that uses nothing of the library."""

import base64
import collections
import hashlib
import re

import pytest

from barloom.llm import decontamination, suffix_dedup

#: Two texts of 304 bytes without a common string of 200 bytes, on which a polynomial hash modulo 2^64 agrees.
PAIR = [
    "UHBwUHBQUHBwUFBwUHBwUHBQUHBQcHBQUHBwUHBQUHBwUFBwUHBwUFBwcFBwUFBwUHBwUHBQUHBwUFBwUHBwUGUqKmUqZWUqKmVlKmUqKmUqZWUqZSoqZWUqKmUqZWUqKmVlKmUqKmVlKiplKmVlKmUqKmUqZWUqKmVlKmUqKmVjZW1mZXZseHllbWZ2cmZlc2hkdGJmZWd1Ym9oYWFhZW9pd2ZmemRjdnhoaWZyZGV6Z2d6Z3p6Z2d6emd6Z2d6Z3p6Z3pnZ3p6Z2d6Z3p6Z2d6emd6Z2d6emdnemd6emd6Z2d6Z3p6Z2d6emd6Z2d6SkNDSkNKSkNDSkpDSkNDSkNKSkNKQ0NKSkNDSkNKSkNDSkpDSkNDSkpDQ0pDSkpDSkNDSkNKSkNDSkpDSkNDSg==",
    "cFBQcFBwcFBQcHBQcFBQcFBwcFBwUFBwcFBQcFBwcFBQcHBQcFBQcHBQUHBQcHBQcFBQcFBwcFBQcHBQcFBQcCplZSplKiplZSoqZSplZSplKiplKmVlKiplZSplKiplZSoqZSplZSoqZWUqZSoqZSplZSplKiplZSoqZSplZSpjZW1mZXZseHllbWZ2cmZlc2hkdGJmZWd1Ym9oYWFhZW9pd2ZmemRjdnhoaWZyZGVnenpnemdnenpnZ3pnenpnemdnemd6emdnenpnemdnenpnZ3pnenpnZ3p6Z3pnZ3pnenpnemdnenpnZ3pnenpnQ0pKQ0pDQ0pKQ0NKQ0pKQ0pDQ0pDSkpDQ0pKQ0pDQ0pKQ0NKQ0pKQ0NKSkNKQ0NKQ0pKQ0pDQ0pKQ0NKQ0pKQw==",
]
SIGNS = [bin(i).count("1") & 1 for i in range(1024)]
FIRST, SECOND = ("".join(letters[x] for x in SIGNS) for letters in ("ab", "ba"))


def removed(texts: list[bytes], length: int = 200) -> list[tuple[bytes, int, int]]:
    seen = collections.Counter(t[k : k + length] for t in texts for k in range(len(t) - length + 1))
    out = []
    for t in texts:
        m = bytearray(len(t))
        for k in range(len(t) - length + 1):
            if seen[t[k : k + length]] > 1:
                m[k : k + length] = b"\1" * length
        out.append((bytes(c for c, x in zip(t, m, strict=True) if not x), sum(m), len([x for x in bytes(m).split(b"\0") if x])))
    return out


def test_all_texts_and_texts_of_equal_rolling_hashes(spark):
    rows = [(r["doc_id"], r["text"] or "") for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect()]
    pair = [base64.b64decode(x).decode() for x in PAIR]
    rows += [(10_000, pair[0]), (10_001, pair[1]), (10_002, FIRST * 2), (10_003, SECOND), (10_004, FIRST[100:700] + SECOND[:250])]
    want = dict(zip((n for n, _ in rows), removed([t.encode() for _, t in rows]), strict=True))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = {r["doc_id"]: (bytes(r["kept"]), r["n_removed"], r["n_spans"]) for r in suffix_dedup.remove_repeats(docs).collect()}
    assert got == want and want[10_000][1:] == want[10_001][1:] == (0, 0)


def test_split_blocks_of_equal_rolling_hashes(spark):
    pair = [base64.b64decode(x).decode() for x in PAIR]
    rows = [(n, x) for n, x in enumerate(pair)] + [(5, pair[0][:250] + "!"), (6, "?" + pair[1][40:])]
    docs = spark.createDataFrame(rows, "id int, text string").selectExpr("id", "unhex(sha2(text, 256)) AS node", "text")
    nodes = {bytes(r["node"]): r["id"] for r in docs.collect()}
    covered = collections.defaultdict(set)
    for r in suffix_dedup.repeated_ranges(docs, hot=1).collect():
        covered[nodes[bytes(r["node"])]] |= set(range(r["start"], r["stop"]))
    assert {n: len(x) for n, x in covered.items()} == {n: x[1] for (n, _), x in zip(rows, removed([t.encode() for _, t in rows]), strict=True) if x[1]}


WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text: str | None) -> list[bytes]:
    return WORD.findall(bytes(c + 32 if 65 <= c <= 90 else c for c in (text or "").encode()))


@pytest.mark.parametrize("limit", [-1, 8 << 20])
def test_windows_of_equal_word_hashes(spark, limit):
    """Words that only their hashes make equal hit nothing, alone, inside a window, and beside a true occurrence."""
    around = "one two three four five six seven eight nine"
    items = [("a", FIRST), ("b", f"{around} {FIRST}"), ("c", f"{FIRST} {around} {around} ten"), ("d", "one")]
    rows = [(1, SECOND), (2, FIRST), (3, f"{around} {SECOND}"), (4, f"x {around} {FIRST} y"), (5, f"{SECOND} {around} {around} TEN"), (6, f"{FIRST} {around} {around} ten"), (7, f"{FIRST} {SECOND}"), (8, None)]
    want = {}
    for n, text in rows:
        mine, hit, found = words(text), set(), set()
        for item, other in items:
            w = words(other)
            size = min(10, len(w))
            grams = {tuple(w[k : k + size]) for k in range(len(w) - size + 1)}
            at = [k for k in range(len(mine) - size + 1) if tuple(mine[k : k + size]) in grams]
            hit |= {x for k in at for x in range(k, k + size)}
            found |= {item} if at else set()
        want[n] = (len(mine), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), bool(hit))
    got = decontamination.decontaminate(spark.createDataFrame(rows, "doc_id int, text string"), spark.createDataFrame(items, "item_id string, text string"), broadcast_bytes=limit)
    assert {r["doc_id"]: tuple(r)[1:] for r in got.select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated").collect()} == want
    assert want[1] == (1, 0, 0, hashlib.sha256(b"").hexdigest(), False) and want[4][1] == 10
