"""The registered WARC query leaves room for files that are rolled by compressed size."""

import inspect

from barloom.llm import queries, warc


def test_shards_are_well_above_the_roll_size(spark, monkeypatch):
    used, write = [], warc.write_warc

    def spy(*a, **o):
        bound = inspect.signature(write).bind(*a, **o)
        bound.apply_defaults()
        used.append((bound.arguments["shard_bytes"], bound.arguments["roll_bytes"]))
        return write(*a, **o)

    monkeypatch.setattr(warc, "write_warc", spy)
    got = queries.op2_warc(spark, "/root/testdata/sf0.001")
    assert got.count() == spark.read.parquet("/root/testdata/sf0.001/pages.parquet").count()
    assert used and used[0][0] >= 4 * used[0][1]
