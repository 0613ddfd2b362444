"""Chat formatting with cumulative snapshots collapsed to the longest conversation."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barloom.llm._shared import materialize

#: The template's opening and closing of a turn.
OPEN, CLOSE = "<|im_start|>", "<|im_end|>"


def _chained(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rolling hashes: the hash of a prefix is that of the shorter prefix and one more turn."""
    for b in batches:
        full, shorter = [], []
        for turns in b.column(1).to_pylist():
            h, own = b"", []
            for t in turns:
                role, text = t["role"].encode(), t["text"].encode()
                h = hashlib.blake2b(h + len(role).to_bytes(8, "big") + role + text, digest_size=16).digest()
                own.append(h)
            full.append(own[-1])
            shorter.append(own[:-1])
        yield pa.RecordBatch.from_arrays([b.column(0), pa.array(full, pa.binary()), pa.array(shorter, pa.list_(pa.binary()))], ["conv", "full", "shorter"])


def format_chats(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """One row per maximal conversation: conv_id, n_turns, n_copies (conversations with equal turns), rendered.

    A conversation whose turns (role and text) are the first turns of a longer one is a snapshot of it and goes; of equal
    conversations the one with the smallest id stays. Turns are ordered by turn, then role and text, so
    ties and repeated turns have one order; null turns come first; null roles and texts count as empty; rows with a null conversation id are
    one conversation. Very long turns are taken whole. Empty in, empty out; other columns, whatever their names, are not read. A conversation is one output row, so its turns are gathered; hashes of shared
    beginnings are made distinct before they meet."""
    rows = turns.select(F.col(conv_col).alias("conv"), F.struct(F.col(turn_col).alias("turn"), F.coalesce(role_col, F.lit("")).alias("role"), F.coalesce(text_col, F.lit("")).alias("text")).alias("t"))
    chats = materialize(rows.groupBy("conv").agg(F.sort_array(F.collect_list("t")).alias("turns")), "chats")
    kind = dict(rows.dtypes)["conv"]
    hashed = materialize(chats.mapInArrow(_chained, f"conv {kind}, full binary, shorter array<binary>"), "hashes")
    first = hashed.groupBy("full").agg(F.min("conv").alias("conv"), F.count(F.lit(1)).alias("n_copies"))
    shorter = hashed.select(F.explode("shorter").alias("full")).distinct()
    longest = first.join(shorter, "full", "left_anti").select(F.col("conv").alias("c"), "n_copies")
    kept = chats.join(longest, F.col("conv").eqNullSafe(F.col("c")))
    rendered = F.array_join(F.transform("turns", lambda t: F.concat(F.lit(OPEN), t["role"], F.lit("\n"), t["text"], F.lit(f"{CLOSE}\n"))), "")
    return kept.select(F.col("conv").alias(conv_col), F.size("turns").cast("long").alias("n_turns"), "n_copies", rendered.alias("rendered"))
