"""Streams that are broken off, repeated and restarted."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from custodia.operators import state
from custodia.streaming import attempts as tries
from custodia.streaming import state as streams

START = dt.datetime(2024, 1, 1)


def put(spark, src, rows):
    rows = [(s, START + dt.timedelta(minutes=m), r) for s, m, r in rows]
    spark.createDataFrame(rows, "site string, at timestamp, record_id string").coalesce(1).write.mode("append").parquet(src)


def run(spark, src, target, checkpoint):
    events = spark.readStream.schema("site string, at timestamp, record_id string").parquet(src)
    tries.write_attempts(tries.new_attempts(events, "30 minutes", 2), target, checkpoint).awaitTermination()


def total(spark, target):
    got = tries.read_attempts(spark, target).groupBy("site").agg(F.sum("tries").alias("n"), F.max_by("record_id", "at").alias("r")).collect()
    return {x.site: (x.n, x.r) for x in got}


def test_attempts_count_once(spark, tmp_path):
    src, target, point = (str(tmp_path / x) for x in ("src", "target", "point"))
    put(spark, src, [("a", 0, "1"), ("a", 1, "2"), ("b", 5, None), ("a", 1, "2"), (None, 3, "x")])
    run(spark, src, target, point)
    assert total(spark, target) == {"a": (2, "2"), "b": (1, None)}
    put(spark, src, [("a", 1, "2"), ("a", 10, "3"), ("b", 5, None), ("c", 11, "9")])  # two of them again

    # the batch is written, and the run breaks off before Spark notes that it is done
    ended = []

    class Broken(Exception):
        pass

    def write(attempts):
        def batch(df, number):
            df.write.mode("overwrite").parquet(f"{target}/batch={number}")
            ended.append(number)
            raise Broken

        return attempts.writeStream.foreachBatch(batch).outputMode("update").option("checkpointLocation", point).trigger(availableNow=True).start()

    events = spark.readStream.schema("site string, at timestamp, record_id string").parquet(src)
    with pytest.raises(Exception, match="Broken"):
        write(tries.new_attempts(events, "30 minutes", 2)).awaitTermination()
    assert ended
    run(spark, src, target, point)
    assert total(spark, target) == {"a": (3, "3"), "b": (1, None), "c": (1, "9")}

    # after two hours the first attempts are forgotten; what is behind the watermark is dropped, so nothing counts twice
    put(spark, src, [("a", 300, "5")])
    run(spark, src, target, point)
    put(spark, src, [("a", 0, "1"), ("a", 301, "6")])
    run(spark, src, target, point)
    assert total(spark, target)["a"] == (5, "6")

    docs = spark.createDataFrame([("a", {"note": "kept", "number_of_tries": "4"})], "site string, doc map<string,string>")
    merged = {r.site: r.doc for r in state.merge_attempts(docs, tries.read_attempts(spark, target)).collect()}
    assert merged["a"] == {"note": "kept", "number_of_tries": "9", "record_id": "6", "updated": merged["a"]["updated"]} and merged["c"]["number_of_tries"] == "1"
    last = tries.read_attempts(spark, target).agg(F.max("batch")).first()[0]
    assert tries.read_attempts(spark, target, last).count() == 0
    assert tries.read_attempts(spark, str(tmp_path / "none")).count() == 0


def test_done_set_reads_its_own_parts(spark, tmp_path):
    src, target = str(tmp_path / "src"), str(tmp_path / "done")
    put = lambda *names: spark.createDataFrame([(n,) for n in names], "path string").coalesce(1).write.mode("append").parquet(src)
    go = lambda point: streams.append_done(spark.readStream.schema("path string").parquet(src), target, str(tmp_path / point)).awaitTermination()
    put(*(f"/p/{i}" for i in range(400)), "/p/3")
    go("one")
    put("/p/7", "/p/new")
    go("one")
    go("two")  # everything once more
    assert sorted(r.path for r in spark.read.parquet(target).collect()) == sorted([f"/p/{i}" for i in range(400)] + ["/p/new"])
    bucket = spark.range(1).select(state.done_bucket(F.lit("/p/7"))).first()[0]
    held = streams.done_parts(spark, target, [bucket])
    assert {r.path for r in held.collect()} >= {"/p/7"}
    scan = held._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(bucket" in scan  # folders of other parts are not opened
    assert all(f"bucket={bucket}/" in r[0] for r in held.select(F.input_file_name()).collect())
    assert streams.done_parts(spark, str(tmp_path / "none"), [bucket]).count() == 0
