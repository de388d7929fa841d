"""Heads, fingerprints, inferred types and dictionaries."""

import glob
import random

import pytest
from pyspark.sql import functions as F

from fleetprep.operators import fingerprint as X
from fleetprep.operators import infer as I
from fleetprep.operators import prepare as P
from fleetprep.operators.dictionary import dictionary, encode
from fleetprep.sources import tables as IO


def test_head_reads_the_files_it_needs(spark, folder):
    path = folder + "/a table"
    spark.range(0, 100, 1, 10).write.parquet(path)
    files = sorted(glob.glob(path + "/part-*"))
    for n, want in ((0, 0), (1, 1), (10, 10), (25, 25), (100, 100), (500, 100)):
        assert [r["id"] for r in IO.head(spark.read.parquet(path), n).orderBy("id").collect()] == list(range(want))
    part = IO.head(spark.read.parquet(path), 25)
    for f in files[3:]:  # what lies behind the head may be anything by now
        with open(f, "wb") as out:
            out.write(b"no parquet")
    assert part.count() == 25 and "Sort" not in part._jdf.queryExecution().executedPlan().toString()


def test_fingerprint_tells_tables_apart(spark):
    rows = [(1, "a", 1.5), (2, None, -0.5), (3, "ab", None), (3, "ab", None)]
    make = lambda rows: spark.createDataFrame(rows, "k int, t string, x double")
    df = make(rows)
    assert X.same_content(df, make(rows[::-1]).repartition(3).select("x", "k", "t"))
    for other in (
        [(1, None, 1.5), (2, "a", -0.5), *rows[2:]], rows[:3], [*rows, rows[0]], [(1, "a", 1.25), *rows[1:]], [rows[0], rows[0], rows[1], rows[1]],
        [(1, "b", 1.5), *rows[1:]], [],
    ):
        assert not X.same_content(df, make(other))
    assert not X.same_content(df, df.withColumnRenamed("x", "y"))
    two = lambda a, b: spark.createDataFrame([(a, b)], "a string, b string")
    assert not X.same_content(two("ab", "c"), two("a", "bc")) and not X.same_content(two(None, "-"), two("-", None))
    assert tuple(X.fingerprint(make([])).first()) == (0, "0", 0)


def test_inferred_types(spark, folder):
    with open(folder + "/t.csv", "w") as out:
        out.write("a,b,c,d,e,f\n1,2,2024-01-02,x,NA,1\n-3,.5,2024-12-31,7,,2024-01-01\n+0,1e3,NaN,y,null,2\n")
    df = IO.scan_csv_inferred(spark, folder + "/t.csv")
    assert dict(df.dtypes) == {"a": "bigint", "b": "double", "c": "date", "d": "string", "e": "string", "f": "string"}
    assert [r["a"] for r in df.collect()] == [1, -3, 0] and df.where("c is null").count() == 1 and df.where("e is null").count() == 3
    text = spark.read.option("header", True).csv(folder + "/t.csv")
    found = {r["variable"]: r for r in I.infer_types(text).collect()}
    assert found["d"]["counter_example"] == "x" and found["f"]["counter_example"] == "2024-01-01" and found["e"]["type"] == "empty" and found["b"]["counter_example"] is None
    assert I.infer_types(text.where("false"), ["a"]).first()["type"] == "empty"


def test_dictionary_and_vectors(spark):
    r = random.Random(1)
    values = [f"v{int(r.paretovariate(0.7)) % 3000}" for _ in range(6000)]
    df = spark.createDataFrame([(v,) for v in values], "c string").repartition(7)
    counts = df.groupBy(F.col("c").alias("value")).agg(F.count("*").alias("n"))
    table = dictionary(counts)
    want = sorted(set(values), key=lambda v: (-values.count(v), v))
    assert {x["value"]: x["id"] for x in table.collect()} == {v: k for k, v in enumerate(want)}
    got = encode(spark.createDataFrame([(1, want[0]), (2, want[-1]), (3, "new"), (4, None)], "k int, c string"), {"c": (table, len(want))})
    rows = {x["k"]: x["c_vector"] for x in got.collect()}
    assert got.columns == ["k", "c_vector"] and all(v.size == len(want) for v in rows.values())
    assert rows[1].indices.tolist() == [0] and rows[2].indices.tolist() == [len(want) - 1] and not len(rows[3].indices) and not len(rows[4].indices)
    assert dictionary(counts.where("false")).count() == 0


def test_wide_columns_in_the_preparation(spark, prepared):
    _, narrow, split = prepared
    size = {c: len(v) for c, v in narrow.categories.items()}
    widest = max(size, key=lambda c: (size[c], c))
    params = P.Params.from_json(P.fit(split, most=sum(size.values()) - 1).to_json())
    assert params.modes == narrow.modes and params.medians == narrow.medians and set(params.wide) == {widest} and params.sizes == {widest: size[widest]}
    out, plain = P.transform(split, params), P.transform(split, narrow)
    assert out.columns[-1] == f"{widest}_vector" and out.count() == plain.count()
    ids = {r["value"]: r["id"] for r in spark.read.parquet(params.wide[widest]).collect()}
    both = out.select("vehicle_record_id", f"{widest}_vector").join(plain, "vehicle_record_id").collect()
    assert sorted(ids) == narrow.categories[widest]
    assert all(r[f"{widest}_{v}"] == (k in r[f"{widest}_vector"].indices) for r in both for v, k in ids.items())
    with pytest.raises(ValueError, match="more than"):
        P.fit_categories(split, list(narrow.categories), most=2)
