"""Files that tasks write and read in numbers and sizes that no task holds at once."""

import os
import zipfile

from pyspark.sql import functions as F

from custodia.plans import sourcing
from custodia.sources import files


def test_archives_are_written_as_their_entries_come(spark, tmp_path):
    """An archive's entries come over many batches; one without entries is there too."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        rows = spark.range(400).selectExpr("concat('s/', id % 3, '.zip') AS path", "concat('e', lpad(id, 4, '0')) AS name", "repeat('x', CAST(id AS INT)) AS data")
        marks = spark.createDataFrame([("t/none.zip", "", ""), ("s/0.zip", "", "")], "path string, name string, data string")
        sourcing._pack(rows.unionByName(marks), str(tmp_path))
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    for k in range(3):
        with zipfile.ZipFile(tmp_path / "s" / f"{k}.zip") as z:
            assert [(i.filename, i.file_size) for i in z.infolist()] == [(f"e{i:04d}", i) for i in range(400) if i % 3 == k]
            assert z.testzip() is None
    with zipfile.ZipFile(tmp_path / "t" / "none.zip") as z:
        assert z.namelist() == []
    assert sorted(os.listdir(tmp_path / "s")) == ["0.zip", "1.zip", "2.zip"]


def test_entries_of_a_large_archive_come_in_batches(spark, tmp_path):
    with zipfile.ZipFile(tmp_path / "a.zip", "w") as z:
        for i in range(40000):
            z.writestr(f"d/{i}", b"")
    with zipfile.ZipFile(tmp_path / "none.zip", "w"):
        pass
    paths = spark.createDataFrame([("s", str(tmp_path / n)) for n in ("a.zip", "none.zip", "lost.zip")], "site string, path string")
    got = files.read_archive_entries(paths).groupBy("archive", "error").agg(F.count("n").alias("n"), F.max("n").alias("last")).collect()
    assert sorted((r.archive, r.error, r.n, r.last) for r in got) == [("a.zip", None, 40000, 39999), ("lost.zip", "unreadable: FileNotFoundError", 0, None)]


def test_long_results_logs_are_read_by_many_tasks_in_their_order(spark, tmp_path):
    from custodia.sources import tables

    for part in range(3):
        rows = "".join(f'SITE {i % 7},"failed\n{part * 5000 + i}"\n' if i % 5 else "n/a,x\n" for i in range(5000))
        (tmp_path / f"part-{part}.csv").write_text("site,error_message\n" + rows)
    rows = tables.read_dirty_csv(spark, str(tmp_path), 4096, place=True)
    assert rows.select(F.spark_partition_id().alias("t")).distinct().count() > 10
    got = [r.error_message for r in rows.where("site <> 'n/a'").orderBy("_place").collect()]
    assert got == [f"failed\n{p * 5000 + i}" for p in range(3) for i in range(5000) if i % 5]
    want = {f"{i % 7:03d}": f"failed\n{10000 + i}" for i in range(5000) if i % 5}
    assert {r.key: r.error_message for r in files.read_results(spark, str(tmp_path), range_bytes=4096).collect()} == want


def test_state_documents_are_found_and_read_by_tasks(spark, tmp_path):
    """Folders of any name; what is empty or no JSON is a note; other files are not looked into."""
    for name, doc in (("S 1", '{"record_id": "a", "number_of_tries": 2}'), ("S%202", "{broken"), ("S3", ""), ("T4", '{"record_id": 7}')):
        (tmp_path / name).mkdir()
        (tmp_path / name / "upload_state.json").write_text(doc)
        (tmp_path / name / "request.json").write_text('{"response": {"id": 5}}')
    (tmp_path / "S5").mkdir()
    docs = files.read_state_docs(spark, f"{tmp_path}/*/upload_state.json")
    assert docs.rdd.getNumPartitions() <= spark.sparkContext.defaultParallelism * 4  # not one for every few files
    assert sorted((r.site, r.record_id, r.tries, r.note) for r in docs.collect()) == [
        ("S 1", "a", "2", None), ("S%202", None, None, "unreadable"), ("S3", None, None, "unreadable"), ("T4", "7", "0 (legacy)", None),
    ]
    assert sorted(r.site for r in files.read_state_docs(spark, f"{tmp_path}/S*/upload_*.json").collect()) == ["S 1", "S%202", "S3"]
    assert {(r.site, r.record_id) for r in files.read_request_logs(spark, f"{tmp_path}/*/request.json").collect()} == {(s, "5") for s in ("S 1", "S%202", "S3", "T4")}
