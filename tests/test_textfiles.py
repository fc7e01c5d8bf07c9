"""Files that tasks write: order over partitions, several files, failed and repeated tasks."""

import os

import pytest
from pyspark import TaskContext
from pyspark.sql import functions as F

from citeloom.sources import textfiles as X


def lines(spark, n, files=("a.txt", "sub/b.txt")):
    file = F.element_at(F.array(*map(F.lit, files)), (F.col("id") % len(files) + 1).cast("int"))
    return spark.range(n).select(file.alias("file"), F.col("id").alias("place"), F.concat(F.lit("é"), F.col("id").cast("string"), F.lit("\n")).alias("text"))


def test_order_over_partitions(spark, tmp_path):
    X.write_files(lines(spark, 500).repartition(7), str(tmp_path), "place")
    for k, name in enumerate(("a.txt", "sub/b.txt")):
        assert (tmp_path / name).read_text() == "".join(f"é{n}\n" for n in range(k, 500, 2))
    assert sorted(os.listdir(tmp_path)) == ["a.txt", "sub"]
    # files of a name are replaced, others stay; an empty write changes nothing
    X.write_files(lines(spark, 3, ("a.txt",)), str(tmp_path), "place")
    assert (tmp_path / "a.txt").read_text() == "é0\né1\né2\n" and (tmp_path / "sub" / "b.txt").exists()
    X.write_files(lines(spark, 0), str(tmp_path), "place")
    assert sorted(os.listdir(tmp_path)) == ["a.txt", "sub"]


def test_failed_writes_leave_nothing(spark, tmp_path):
    (tmp_path / "a.txt").write_text("old")

    def fail(batches):
        for batch in batches:
            yield batch
            if TaskContext.get().partitionId() == 2:
                raise RuntimeError("lost")

    rows = lines(spark, 100, ("a.txt",)).select("file", "text").repartition(4).mapInArrow(fail, "file string, text string")
    X.registered(spark)
    with pytest.raises(Exception):
        rows.write.format(X.NAME).mode("append").save(str(tmp_path))
    assert os.listdir(tmp_path) == ["a.txt"] and (tmp_path / "a.txt").read_text() == "old"


def test_parts_that_no_report_names(tmp_path):
    """A task that ran twice leaves parts of the attempt that isn't reported; a part that isn't whole stops the commit."""
    writer = X.FilesWriter(str(tmp_path))

    def part(partition, attempt, text):
        folder = tmp_path / writer.stage / f"{partition}-{attempt}"
        folder.mkdir(parents=True)
        (folder / "1").write_text(text)
        return X.Parts(partition, [("f", str(folder / "1"), len(text))])

    part(0, 0, "torn")
    reports = [part(1, 3, "second"), None, part(0, 2, "first ")]
    writer.commit(reports)
    assert (tmp_path / "f").read_text() == "first second" and os.listdir(tmp_path) == ["f"]
    again = X.FilesWriter(str(tmp_path))
    folder = tmp_path / again.stage / "0-0"
    folder.mkdir(parents=True)
    (folder / "1").write_text("abc")
    with pytest.raises(OSError):
        again.commit([X.Parts(0, [("f", str(folder / "1"), 5)])])
    again.abort([])
    assert (tmp_path / "f").read_text() == "first second" and os.listdir(tmp_path) == ["f"]


def test_overwrite_is_refused(spark, tmp_path):
    X.registered(spark)
    with pytest.raises(Exception, match="append"):
        lines(spark, 3).select("file", "text").write.format(X.NAME).mode("overwrite").save(str(tmp_path))
