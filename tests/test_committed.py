"""The source and sink of committed files: filters, offsets, restarts, repeated batches, aborted writes."""

import os

import pytest
from helpers import rows
from pyspark.sql import functions as F

from streamlens.sources.committed import Added, Folder, register

SCHEMA = "id BIGINT, name STRING"


@pytest.fixture(scope="module")
def source(spark):
    return register(spark)


def add(spark, path, first, last, parts=2):
    df = spark.range(first, last, 1, parts).select("id", F.concat(F.lit("n"), "id").alias("name"))
    df.write.format("committed").mode("append").save(path)


def load(spark, path):
    return spark.read.format("committed").schema(SCHEMA).load(path)


def files(path):
    """All files, those of no commit too."""
    return sorted(f"{os.path.basename(at)}/{n}" for at, _, names in os.walk(f"{path}/data") for n in names if n.endswith(".parquet"))


def test_rows_are_read_as_written(source, tmp_path):
    path = str(tmp_path / "t")
    assert load(source, path).count() == 0
    odd = source.createDataFrame([(1, "a"), (1, "a"), (None, None), (2, "")], SCHEMA)
    odd.write.format("committed").mode("append").save(path)
    odd.limit(0).write.format("committed").mode("append").save(path)
    assert rows(load(source, path)) == rows(odd)
    assert rows(load(source, path).where("id = 2")) == [(2, "")]


def test_files_are_skipped_by_range(source, tmp_path):
    path = str(tmp_path / "t")
    for k in range(4):
        add(source, path, k * 100, k * 100 + 100, 1)
    assert load(source, path).rdd.getNumPartitions() == 4
    for test, parts in (("id >= 250", 2), ("id < 100", 1), ("id = 399", 1), ("id > 199 AND id <= 200", 1)):
        found = load(source, path).where(test)
        assert found.rdd.getNumPartitions() == parts
        assert rows(found.select("id")) == rows(source.range(400).where(test))


def test_an_aborted_write_leaves_nothing(source, tmp_path):
    path = str(tmp_path / "t")
    add(source, path, 0, 10)
    before = files(path)
    fails = source.range(0, 100_000, 1, 3).select("id", F.when(F.col("id") < 99_000, "x").otherwise(F.raise_error(F.lit("no"))).cast("string").alias("name"))
    with pytest.raises(Exception, match="no"):
        fails.write.format("committed").mode("append").save(path)
    assert files(path) == before and len(Folder(path).commits()) == 1
    assert load(source, path).count() == 10


def test_a_commit_is_never_replaced(tmp_path):
    a, b = Folder(str(tmp_path)), Folder(str(tmp_path))
    b.commits = lambda: []  # as if it had looked before the other one committed
    a.commit("job", [Added("x", 1, {})])
    with pytest.raises(FileExistsError):
        b.commit("job", [Added("y", 1, {})])
    assert [f.name for f in a.files(a.commits())] == ["x"] and os.listdir(tmp_path / "commits") == a.commits()


def copy(spark, path, out, checkpoint):
    stream = spark.readStream.format("committed").schema(SCHEMA).load(path)
    query = stream.writeStream.format("committed").option("checkpointLocation", checkpoint).outputMode("append") \
        .trigger(availableNow=True).start(out)
    query.awaitTermination()


def test_each_row_once_over_restarts_and_repeated_batches(source, tmp_path):
    path, out, checkpoint = (str(tmp_path / n) for n in ("t", "out", "checkpoint"))
    for k in range(3):
        add(source, path, k * 50, k * 50 + 50)
        copy(source, path, out, checkpoint)
    assert rows(load(source, out)) == rows(load(source, path))
    assert files(out) == sorted(a.name for a in Folder(out).files(Folder(out).commits()))
    # the last batch is done again: its commit was written, the stream's own note of it is lost
    last = max(int(n) for n in os.listdir(f"{checkpoint}/commits") if n.isdigit())
    for name in (f"{last}", f".{last}.crc"):
        if os.path.exists(f"{checkpoint}/commits/{name}"):
            os.unlink(f"{checkpoint}/commits/{name}")
    kept = files(out)
    copy(source, path, out, checkpoint)
    assert files(out) == kept and rows(load(source, out)) == rows(load(source, path))
    add(source, path, 150, 160)
    copy(source, path, out, checkpoint)
    assert rows(load(source, out).select("id")) == rows(source.range(160))


def test_a_micro_batch_is_bounded(source, tmp_path):
    path, out, checkpoint = (str(tmp_path / n) for n in ("t", "out", "checkpoint"))
    for k in range(5):
        add(source, path, k * 10, k * 10 + 10, 1)
    stream = source.readStream.format("committed").schema(SCHEMA).option("commitsPerBatch", "2").load(path)
    query = stream.writeStream.format("committed").option("checkpointLocation", checkpoint).start(out)
    try:
        query.processAllAvailable()
    finally:
        query.stop()
    sizes = [sum(f.rows for f in Folder(out).files([c])) for c in Folder(out).commits()]
    assert sizes == [20, 20, 10]
