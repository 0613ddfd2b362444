"""Streams over files, cut in several ways, against the batch versions of the same jobs."""

import datetime as dt
import random
import uuid

import pytest

from barloom.streaming import bar_watch, reactions

DAY = dt.date(2021, 3, 1)


def files(spark, folder, rows, schema, cuts):
    """Rows as files, one for each cut, with times in their order."""
    for n, (a, b) in enumerate(zip([0, *cuts], [*cuts, len(rows)], strict=True)):
        spark.createDataFrame(rows[a:b], schema).coalesce(1).write.parquet(f"{folder}/part={n:04d}")


def ran(spark, df, folder, mode="append"):
    name = "q" + uuid.uuid4().hex
    q = df.writeStream.format("memory").queryName(name).outputMode(mode).option("checkpointLocation", f"{folder}/{name}").trigger(availableNow=True).start()
    try:
        q.awaitTermination(240)
        assert q.exception() is None
        return sorted(map(tuple, spark.table(name).collect()), key=repr), q
    finally:
        q.stop()


def read(spark, folder, schema):
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).option("recursiveFileLookup", True).option("latestFirst", False).parquet(folder)


@pytest.fixture
def store(spark):
    old = spark.conf.get(bar_watch.STORE[0])
    spark.conf.set(*bar_watch.STORE)
    spark.conf.set("spark.sql.shuffle.partitions", "2")
    yield
    spark.conf.set(bar_watch.STORE[0], old)
    spark.conf.set("spark.sql.shuffle.partitions", "4")


def bars():
    r = random.Random(4)
    rows = []
    for t in range(4):
        day, close = 0, 100.0
        while day < 200:
            rows.append((t, DAY + dt.timedelta(day), round(close, 3)))
            close *= r.choice([0.98, 1.01, 1.02, 2.0, 0.45, 1.0])
            day += r.choice([1, 1, 1, 2, 3, 10, 11, 25, 59, 60, 61, 75])
    rows += [(9, DAY + dt.timedelta(3), 5.0), (2, rows[0][1], 7.0)]
    rows.sort(key=lambda x: (x[1], x[0]))
    for k in range(0, len(rows) - 3, 3):  # a little out of order
        if (rows[k + 2][1] - rows[k][1]).days < 4:
            rows[k : k + 3] = rows[k : k + 3][::-1]
    return [*rows, (-1, DAY + dt.timedelta(300), 1.0)]  # the last one moves the watermark on


@pytest.mark.parametrize("cuts", [[9, 10, 31], [5, 20]])
def test_keyed_state_equals_the_batch_events(spark, store, tmp_path, cuts):
    rows, schema = bars(), "ticker long, date date, close double"
    files(spark, str(tmp_path / "in"), rows, schema, cuts)
    got, q = ran(spark, bar_watch.watched(read(spark, str(tmp_path / "in"), schema)), str(tmp_path))
    until = str(DAY + dt.timedelta(295))
    want = sorted(map(tuple, bar_watch.events(spark.createDataFrame(rows, schema), until).collect()), key=repr)
    assert got == want and {r[2] for r in got} == {"splice", "stale"}
    assert reactions.late_rows(q) == 0
    state = q.lastProgress["stateOperators"][0]
    assert state["numRowsTotal"] <= 3  # all but the last ticker are forgotten


def test_bars_behind_the_watermark_change_nothing(spark, store, tmp_path):
    schema = "ticker long, date date, close double"
    rows = [(1, DAY, 10.0), (2, DAY + dt.timedelta(40), 1.0), (1, DAY + dt.timedelta(1), 90.0), (2, DAY + dt.timedelta(60), 1.0)]
    files(spark, str(tmp_path / "in"), rows, schema, [2, 3])
    got, q = ran(spark, bar_watch.watched(read(spark, str(tmp_path / "in"), schema)), str(tmp_path))
    mine = [r for r in got if r[0] == 1]
    assert reactions.late_rows(q) + sum(r[2] == "late" for r in mine) == 1 and [r[3] for r in mine if r[2] != "late"] == [DAY]


def test_interval_join_of_streams_equals_that_of_tables(spark, tmp_path):
    r = random.Random(6)
    at = lambda h: dt.datetime(2021, 3, 1) + dt.timedelta(hours=h)
    a = sorted(((n, r.randrange(5), at(r.randrange(400))) for n in range(60)), key=lambda x: x[2]) + [(900, 99, at(900)), (901, 98, at(901))]
    b = sorted({(r.randrange(4), at(24 * r.randrange(17))): float(n) for n in range(40)}.items(), key=lambda x: x[0][1])
    b = [(t, when, x) for (t, when), x in b] + [(99, at(901), 1.0), (97, at(902), 1.0)]
    one, two = "article_id int, ticker int, published_at timestamp", "ticker int, bar_at timestamp, close double"
    files(spark, str(tmp_path / "a"), a, one, [7, 8, 33, 60])
    files(spark, str(tmp_path / "b"), b, two, [10, 30])
    got, q = ran(spark, reactions.reactions(read(spark, str(tmp_path / "a"), one), read(spark, str(tmp_path / "b"), two)), str(tmp_path))
    want = reactions.reactions(spark.createDataFrame(a, one), spark.createDataFrame(b, two)).collect()
    # the newest articles wait for bars that may still come
    assert got == sorted((tuple(x) for x in want if x["article_id"] < 900 or x["bar_at"] is not None), key=repr)
    assert any(x[3] is None for x in got) and any(x[3] is not None for x in got)
