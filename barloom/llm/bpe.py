"""BPE encoding by a deterministic automaton over tokens, and decoding by its arc labels."""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barloom.llm._shared import text_or_empty
from barloom.llm._words import buffers, chunks, frugal

#: The pre-split pattern of byte-level BPE vocabularies, over Unicode classes, and the same over ASCII alone.
SPLIT = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
SPLIT_ASCII = r"'(?:[sdmt]|ll|ve|re)| ?[A-Za-z]+| ?[0-9]+| ?[^\t-\r A-Za-z0-9]+|[\t-\r ]+(?![^\t-\r ])|[\t-\r ]+"
#: Pre-split words in each of the two generations that a Python worker remembers.
REMEMBERED = 400_000
#: Bytes of text that a task encodes before it hands on the result.
SLICE = 2 << 20


def byte_names() -> dict[str, int]:
    """The characters that stand for bytes in such vocabularies: printable Latin-1 for itself, the rest from U+0100 on."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b]
    other = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(other)}


def latin_split() -> tuple[re.Pattern, re.Pattern]:
    """The same split for texts of Latin letters and general punctuation, with the classes written out, and what finds a character beyond."""
    known = [chr(c) for c in (*range(0x250), *range(0x2000, 0x2070))]

    def of(category: str) -> str:
        match = regex.compile(category).match
        return "".join(re.escape(c) for c in known if match(c))

    letter, number, space = of(r"\p{L}"), of(r"\p{N}"), of(r"\s")
    split = rf"'(?:[sdmt]|ll|ve|re)| ?[{letter}]+| ?[{number}]+| ?[^{space}{letter}{number}]+|[{space}]+(?![^{space}])|[{space}]+"
    return re.compile(split), re.compile("[^\0-\u024f\u2000-\u206f]")


class Automaton:
    """Accepts exactly the token sequences that BPE's merges produce; its arcs are labelled with tokens.

    It begins as one state with a loop for each byte. The gadget of a merge (a, b) -> c takes the state q that all
    a-arcs enter: if b leaves q, a copy of q without that arc becomes the new end of the a-arcs, so a can no longer
    be followed by b, and each state with an a-arc gets a c-arc to where b led. All arcs of one token end in one
    state, so a state goes by its token. Copies are not written out: `lacks` holds for each token the arcs that its
    state lost and at which merge; the rest of the state is that of the token's right part when the token was made.
    An arc that a state did not lose is there if the arc of its label's left part was when the label was made."""

    def __init__(self, vocab: dict[str, int], merges: list, special: list[tuple[str, int]]):
        names = byte_names()
        labels = {i: bytes(names[c] for c in t) for t, i in vocab.items()}
        self.labels = [labels.get(i, b"") for i in range(max([-1, *labels, *(i for _, i in special)]) + 1)]
        for text, i in special:
            self.labels[i] = text.encode()
        self.special = dict(special)
        self.ids = {b: i for i, b in labels.items() if i not in self.special.values()}
        n = len(self.labels)
        self.left, self.right, self.born = [-1] * n, [-1] * n, [-1] * n
        self.live = [len(b) == 1 for b in self.labels]
        self.lacks: list[dict[int, int]] = [{} for _ in range(n)]
        for t, m in enumerate(merges):
            a, b = m.split(" ") if isinstance(m, str) else m
            x, y, c = vocab[a], vocab[b], vocab[a + b]
            if self.live[x] and self.live[y] and self.born[c] < 0 and self.arc(x, y):
                self.left[c], self.right[c], self.born[c], self.live[c] = x, y, t, True
                self.lacks[x][y] = t
        self.trie: dict[int, list] = {}  # of the live tokens: byte -> [the bytes that may follow, token or -1]
        for label, i in self.ids.items():
            node, below = None, self.trie
            for byte in label if self.live[i] else b"":
                node = below.setdefault(byte, [{}, -1])
                below = node[0]
            if node:
                node[1] = i
        self.table: dict[int, bool] = {}
        self.known: dict[str, tuple[int, ...]] = {}
        self.older: dict[str, tuple[int, ...]] = {}
        self.split = regex.compile(SPLIT)
        self.split_latin, self.beyond = latin_split()
        self.split_ascii = re.compile(SPLIT_ASCII)
        self.cut = re.compile("(" + "|".join(map(re.escape, sorted(self.special, key=len, reverse=True))) + ")") if special else None

    def arc(self, state: int, token: int) -> bool:
        """Whether the state that arcs of one token enter has an arc labelled with the other."""
        until = len(self.born)
        while token >= 0:
            at, before = state, len(self.born)
            while at >= 0:
                lost = self.lacks[at].get(token, before)
                if lost < before and lost <= until:
                    return False
                before, at = self.born[at], self.right[at]
            until, token = self.born[token], self.left[token]
        return True

    def matches(self, word: bytes, at: int) -> list[tuple[int, int]]:
        """Live tokens that the word has at this place, with their ends, shortest first."""
        below, end, out = self.trie, at, []
        for byte in word[at:] if at else word:
            node = below.get(byte)
            if node is None:
                break
            below, token = node
            end += 1
            if token >= 0:
                out.append((token, end))
        return out

    def word(self, word: bytes) -> tuple[int, ...]:
        """The labels of the only path that spells the word, the longest arc first.

        A place in the word is reached by one token only, whatever comes later, so a place from which the path cannot go on is left for good."""
        whole = self.ids.get(word)
        if whole is not None and self.live[whole]:
            return (whole,)
        n, table, matches = len(word), self.table, self.matches
        path, behind, dead, at, last, here = [], [], set(), 0, -1, matches(word, 0)
        while at < n:
            while here:
                token, end = here.pop()
                if end in dead:
                    continue
                if last >= 0:
                    ok = table.get(last << 32 | token)
                    if ok is None:
                        ok = table[last << 32 | token] = self.arc(last, token)
                    if not ok:
                        continue
                path.append(token)
                behind.append((here, at, last))
                at, last = end, token
                here = matches(word, at) if at < n else []
                break
            else:
                dead.add(at)
                path.pop()
                here, at, last = behind.pop()
        return tuple(path)

    def encode(self, text: str) -> np.ndarray:
        if self.cut and any(s in text for s in self.special):
            parts = [np.array([self.special[p]], np.int32) if k % 2 else self.ordinary(p) for k, p in enumerate(self.cut.split(text))]
            return np.concatenate(parts)
        return self.ordinary(text)

    def ordinary(self, text: str) -> np.ndarray:
        if text.isascii():
            words = self.split_ascii.findall(text)
        else:
            words = (self.split if self.beyond.search(text) else self.split_latin).findall(text)
        if len(self.known) >= REMEMBERED:
            self.older, self.known = self.known, {}
        if len(self.table) >= REMEMBERED:
            self.table.clear()
        known, older, long = self.known, self.older, {}
        for w in set(words).difference(known):
            got = older.get(w)
            if got is None:
                got = self.word(w.encode())
            if len(w) <= 64:
                known[w] = got
            else:
                long[w] = got
        of = known.__getitem__ if not long else lambda w: long[w] if w in long else known[w]
        return np.fromiter(chain.from_iterable(map(of, words)), np.int32)

    def decode(self, ids: list[int]) -> str:
        return b"".join(map(self.labels.__getitem__, ids)).decode("utf-8", "replace")


_made: dict[int, tuple[str, Automaton]] = {}


def automaton(source: str) -> Automaton:
    """The automaton of a tokenizer file's content, made once in each Python process."""
    key = hash(source)
    if key not in _made or _made[key][0] != source:
        t = json.loads(source)
        special = [(a["content"], a["id"]) for a in t.get("added_tokens", [])]
        _made.clear()
        _made[key] = (source, Automaton(t["model"]["vocab"], t["model"]["merges"], special))
    return _made[key][1]


def forget() -> None:
    """Drop the words that this process remembers: they serve one task, and would otherwise stay beside the stages that follow."""
    for _, a in _made.values():
        a.known, a.older, a.table = {}, {}, {}


def read_vocabulary(path: str) -> str:
    with open(path, encoding="utf-8") as f:  # on the driver; tasks get the content by broadcast
        return f.read()


def encode(docs: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text", decoded: bool = False) -> DataFrame:
    """One row per document: id, ids (array of token ids) and, if asked for, decoded (the text that the ids give).

    vocabulary is the content of a tokenizers JSON file with byte-level BPE; its size bounds the broadcast.
    Strings of the file's added tokens become those tokens. Null counts as empty, empty texts have no ids, repeated rows and null ids
    each keep their row; very long texts are encoded whole. Empty in, empty out; other columns, whatever their names, are not read."""
    held = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a = automaton(held.value)
        for whole in batches:
            _, offsets = buffers(whole.column(1))
            for i, j in chunks(offsets, SLICE) if len(whole.column(1)) else ():
                b = whole.slice(i, j - i)
                flat, sizes, texts = [], [0], []
                for text in b.column(1):
                    ids = a.encode(text.as_py() or "")
                    flat.append(ids)
                    sizes.append(sizes[-1] + len(ids))
                    if decoded:
                        texts.append(a.decode(ids.tolist()))
                got = pa.ListArray.from_arrays(pa.array(sizes, pa.int32()), pa.array(np.concatenate(flat)))
                yield pa.RecordBatch.from_arrays([b.column(0), got] + ([pa.array(texts, pa.string())] if decoded else []), ["id", "ids"] + ["decoded"] * decoded)

    rows = docs.select(F.col(id_col).alias("id"), text_or_empty(text_col).alias("text"))
    return rows.mapInArrow(frugal(run, forget), f"id {dict(rows.dtypes)['id']}, ids array<int>" + ", decoded string" * decoded).withColumnRenamed("id", id_col)


def decode(tokens: DataFrame, vocabulary: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """One row per row of tokens: id, text. Null ids are no tokens, and ids outside the vocabulary stand for nothing."""
    held = tokens.sparkSession.sparkContext.broadcast(vocabulary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a = automaton(held.value)
        for b in batches:
            texts = [a.decode([i for i in ids or [] if i is not None and 0 <= i < len(a.labels)]) for ids in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(texts, pa.string())], ["id", "text"])

    rows = tokens.select(F.col(id_col).alias("id"), F.col(ids_col).alias("ids"))
    return rows.mapInArrow(frugal(run), f"id {dict(rows.dtypes)['id']}, text string").withColumnRenamed("id", id_col)
