"""Tables of files: what a change leaves alone, what it rewrites, and how it is committed."""

import datetime as dt
import hashlib
from pathlib import Path

import pytest

from barloom.sources.file_tables import FileTable, repaired, sessions_to_rescan

SCHEMA = "ticker string, date date, close double, source string"
DAY = dt.date(2024, 1, 1)


def day(k):
    return DAY + dt.timedelta(k)


def contents(path, files):
    return {f: hashlib.sha256(Path(path, f).read_bytes()).hexdigest() for f in files}


def made(spark, path):
    t = FileTable(spark, str(path), SCHEMA)
    for k in range(6):
        t.append(spark.createDataFrame([(f"t{n}", day(k), float(10 * k + n), "canonical" if k < 4 else "other") for n in range(5)], SCHEMA).coalesce(1))
    return t


def test_only_touched_files_are_rewritten(spark, tmp_path):
    t = made(spark, tmp_path / "t")
    before = t.files()
    sums = contents(t.path, before)
    fresh = [("t1", day(2), -1.0, "canonical"), ("t1", day(2), -2.0, "canonical"), ("t9", day(2), -3.0, "x"), ("t2", day(4), -4.0, "y"), (None, day(1), -5.0, "z")]
    version, old = t.upsert(spark.createDataFrame(fresh, SCHEMA), ["ticker", "date"])
    assert version == 6 and len(old) == 2 and set(old) < set(before)
    kept = [f for f in t.files() if f in sums]
    assert len(kept) == 4 and contents(t.path, kept) == {f: sums[f] for f in kept}
    got = {(r["ticker"], r["date"]): r["close"] for r in t.read().collect()}
    assert t.read().count() == 32 and got["t1", day(2)] == -1.0 and got["t2", day(4)] == -4.0 and got["t9", day(2)] == -3.0 and got[None, day(1)] == -5.0 and got["t0", day(2)] == 20.0
    assert t.read(5).count() == 30 and t.files(5) == before  # the version before is still there
    assert t.upsert(t.read().limit(0), ["ticker", "date"]) == (6, [])


def test_commits_do_not_overwrite(spark, tmp_path, monkeypatch):
    t = made(spark, tmp_path / "t")
    other = FileTable(spark, t.path, SCHEMA)
    monkeypatch.setattr(other, "versions", lambda: [0, 1, 2, 3, 4])  # has not seen the last version
    with pytest.raises(RuntimeError):
        other.append(spark.createDataFrame([("a", DAY, 1.0, "s")], SCHEMA))
    assert t.versions() == list(range(6)) and t.read().count() == 30 and not [p for p in Path(t.path).iterdir() if p.name.startswith("staged")]
    empty = FileTable(spark, str(tmp_path / "none"), SCHEMA)
    assert empty.read().count() == 0 and empty.files() == [] and empty.touched(t.read(), ["ticker"]) == []


def test_rescan_repairs_open_sessions_and_skips_canonical_ones(spark, tmp_path):
    t = made(spark, tmp_path / "t")
    t.upsert(spark.createDataFrame([("t3", day(3), None, "canonical")], SCHEMA), ["ticker", "date"])
    sums = contents(t.path, t.files())
    names = spark.createDataFrame([(f"t{n}",) for n in range(5)], "ticker string")
    plan = sessions_to_rescan(t.read(), t.read().select("date"), names, str(day(5)), "canonical", 4)
    assert {r["date"]: r["canonical"] for r in plan.collect()} == {day(2): True, day(3): False, day(4): False, day(5): False}
    fresh = [(f"t{n}", day(k), float(100 * k + n), "canonical") for k in (1, 2, 3, 4) for n in range(5)] + [("t0", day(5), None, "canonical"), ("t1", day(5), 1.0, "worst")]
    rows = repaired(t.read(), spark.createDataFrame(fresh, SCHEMA), plan, {"canonical": 3, "other": 2, "worst": 1})
    assert sorted((r["ticker"], (r["date"] - DAY).days) for r in rows.collect()) == sorted([(f"t{n}", k) for k in (3, 4) for n in range(5)])
    _, old = t.upsert(rows, ["ticker", "date"])
    kept = [f for f in t.files() if f in sums]
    assert contents(t.path, kept) == {f: sums[f] for f in kept} and len(kept) == 4 and len(old) in (2, 3)  # the session that was changed before may lie in two files
    got = {(r["ticker"], (r["date"] - DAY).days): (r["close"], r["source"]) for r in t.read().collect()}
    assert got["t3", 3] == (303.0, "canonical") and got["t0", 4] == (400.0, "canonical") and got["t0", 2] == (20.0, "canonical") and got["t1", 5] == (51.0, "other")
    after = sessions_to_rescan(t.read(), t.read().select("date"), names, str(day(5)), "canonical", 4)
    assert {r["date"]: r["canonical"] for r in after.collect()} == {day(2): True, day(3): True, day(4): True, day(5): False}
