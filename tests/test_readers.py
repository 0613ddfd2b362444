"""Files as tables: names from paths."""

import re

from barloom.sources import readers


def test_a_file_names_its_ticker_without_a_pattern_over_its_whole_path(spark, tmp_path):
    names = ["AB", "C.D", "part", "x.parquet"]
    for n in names:
        spark.createDataFrame([(1.0,)], "close double").selectExpr("DATE '2024-01-02' AS date", "close").coalesce(1).write.parquet(f"{tmp_path}/{n}.parquet")
    single = next(p for p in (tmp_path / "AB.parquet").iterdir() if p.name.startswith("part-"))
    (tmp_path / "single.parquet").write_bytes(single.read_bytes())
    got = readers.price_history(spark, [f"{tmp_path}/{n}.parquet" for n in [*names, "single"]], "date date, close double", "name")
    assert sorted(r["name"] for r in got.collect()) == sorted([*names, "single"])
    assert "regexp_extract" not in got._jdf.queryExecution().optimizedPlan().toString()
    old = re.compile(r"([^/]+?)(?:\.parquet)?(?:/part-[^/]*)?$")
    paths = ["file:/a/b/T1.parquet/part-0-x.snappy.parquet", "file:/a/b/T1.parquet", "s3://a/T1/part-7", "file:/a/.parquet", "file:/a/T.parquet.parquet", "file:/a/name=T3.parquet/part-1"]
    df = spark.createDataFrame([(p,) for p in paths], "p string").select("p", readers._named("p").alias("n"))
    assert {r["p"]: r["n"] for r in df.collect()} == {p: old.search(p)[1] for p in paths}
