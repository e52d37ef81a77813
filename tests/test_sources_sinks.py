import json
import os

import pytest
from pyspark.sql import functions as F

from helpers import numbers, rows
from streamlens import session
from streamlens.operators.dedup import dedup_keys
from streamlens.sources import connectors, files, sinks


def test_behavior_csv(spark, tmp_path):
    path = tmp_path / "log.csv"
    path.write_text("543462,1715,1464116,pv,1511658000\nnot,a,line\n662867,2244074,1575622,buy,1511658001\n")
    parsed = files.parse_behavior_csv(files.read_lines(spark, str(path)), unit="s")
    good = parsed.where(F.col(files.CORRUPT).isNull()).orderBy("userID").collect()
    assert [(r.userID, r.behavior, str(r.ts)) for r in good] == [
        (543462, "pv", "2017-11-26 01:00:00"), (662867, "buy", "2017-11-26 01:00:01")]
    bad = parsed.where(F.col(files.CORRUPT).isNotNull()).collect()
    assert [r[files.CORRUPT] for r in bad] == ["not,a,line"]
    assert files.read_events(spark, str(path)).count() == 3


def test_json_and_pairs(spark):
    text = '{"client_id":"1001","client_name":"n","transaction_amount":60000,"transfer_accounts":1,"time":5}'
    from streamlens.schemas import TRANSACTION

    df = spark.createDataFrame([(text,), ("broken",)], "value string")
    assert rows(files.parse_json(df, TRANSACTION)) == [
        ("1001", "n", 60000, 1, 5), (None, None, None, None, None)]
    pairs = spark.createDataFrame([("a-1",), ("b-2",), ("none",), ("c-x",)], "value string")
    assert rows(files.parse_kv(pairs)) == [("a", 1), ("b", 2)]
    rules = spark.createDataFrame([("high-risk:call",), ("nothing",)], "value string")
    assert rows(files.parse_rule(rules)) == [("high-risk", "call")]


def test_kafka_options():
    options = connectors.kafka_options("h:1", "t", "earliest", group="g", committed=True, min_bytes=9)
    assert options["startingOffsets"] == "earliest" and "startingTimestamp" not in options
    assert options["kafka.isolation.level"] == "read_committed"
    assert options["kafka.group.id"] == "g" and options["kafka.fetch.min.bytes"] == "9"
    assert connectors.kafka_options("h:1", "t", 1623401174665)["startingTimestamp"] == "1623401174665"
    sink = connectors.kafka_sink_options("h:1", "t")
    assert sink["kafka.acks"] == "all" and sink["kafka.enable.idempotence"] == "true"


def test_kafka_records(spark):
    df = spark.createDataFrame([(1, "a")], "id long, name string")
    out = connectors.kafka_records(df, key="id")
    assert json.loads(out.first().value) == {"id": 1, "name": "a"} and out.first().key == "1"


def test_jdbc_options():
    options = connectors.jdbc_options("jdbc:x", "accounts", partition_column="id", bounds=(0, 99), partitions=4)
    assert (options["lowerBound"], options["upperBound"], options["numPartitions"]) == ("0", "99", "4")
    with pytest.raises(ValueError):
        connectors.jdbc_options("jdbc:x", "accounts", partition_column="id")


def test_account_line(spark):
    df = spark.createDataFrame([("f", "d", "x", "z")], "fund_account string, open_date string, xz string, zt string")
    assert connectors.account_line(df).first().value == "f,d,x,z"


def test_lookup_keeps_unknown_keys(spark):
    dim = spark.createDataFrame([(1, "a", "b")], "id long, u string, v string")
    found = connectors.lookup_dimension(numbers(spark, 1, 2, "k"), dim, "k", "id", ["u", "v"])
    assert rows(found) == [(1, "a -love- b"), (2, None)]


def test_overwrite_replaces_all_rows(spark, tmp_path):
    sinks.overwrite_table(numbers(spark, 1, 5), "overwrite_me")
    reader = spark.table("overwrite_me")
    sinks.overwrite_table(numbers(spark, 7, 8), "overwrite_me")
    assert rows(spark.table("overwrite_me")) == [(7,), (8,)]
    assert rows(reader) in ([(i,) for i in range(1, 6)], [(7,), (8,)])
    sinks.overwrite_table(spark.table("overwrite_me").where("n = 8"), "overwrite_me")
    assert rows(spark.table("overwrite_me")) == [(8,)]


def test_failed_overwrite_changes_nothing(spark):
    sinks.overwrite_table(numbers(spark, 1, 2), "keep_me")
    broken = numbers(spark, 1, 9).select(F.raise_error(F.lit("lost")).cast("bigint").alias("n"))
    with pytest.raises(Exception, match="lost"):
        sinks.overwrite_table(broken, "keep_me")
    assert rows(spark.table("keep_me")) == [(1,), (2,)]


def test_search_files(spark, tmp_path):
    path = str(tmp_path / "index")
    sinks.write_search_index(numbers(spark, 1, 2), path, "i")
    lines = [json.loads(r.value) for r in files.read_lines(spark, path).collect()]
    assert sorted(map(str, lines)) == sorted(map(str, [
        {"index": {"_index": "i"}}, {"data": {"n": 1}}, {"index": {"_index": "i"}}, {"data": {"n": 2}}]))


@pytest.mark.parametrize("by", [[], ["part"]])
def test_a_table_is_overwritten_many_times(spark, by):
    name = "many_times" + "_parts" * len(by)
    make = lambda n: numbers(spark, n, n + 1).withColumn("part", F.col("n") % 2)
    make(0).write.partitionBy(*by).saveAsTable(name)
    for n in range(1, 10):
        sinks.overwrite_table(make(n), name)
        assert rows(spark.table(name).select("n")) == sorted([(n,), (n + 1,)], key=str)
    spark.sql(f"DROP TABLE {name}")


def test_a_repeated_batch_indexes_once(spark, tmp_path):
    path = str(tmp_path / "index")
    for first, batch in ((1, 0), (3, 1), (3, 1)):
        sinks.write_search_index(numbers(spark, first, first + 1), path, "i", batch)
    found = files.read_lines(spark, path).where("value LIKE '%data%'").select("value")
    assert rows(found) == [(f'{{"data":{{"n":{n}}}}}',) for n in range(1, 5)]


def test_an_overwrite_that_cannot_rename_keeps_the_old_table(spark, monkeypatch):
    parts = numbers(spark, 1, 4).withColumn("part", F.col("n") % 2)
    parts.write.partitionBy("part").saveAsTable("kept_parts")
    sql = type(spark).sql

    def failing(self, text, *args, **more):
        if "_new_" in text and text.endswith("RENAME TO kept_parts"):
            raise RuntimeError("catalog away")
        return sql(self, text, *args, **more)

    monkeypatch.setattr(type(spark), "sql", failing)
    with pytest.raises(RuntimeError, match="catalog away"):
        sinks.overwrite_table(parts.where("n > 2"), "kept_parts")
    monkeypatch.undo()
    assert rows(spark.table("kept_parts").select("n")) == [(1,), (2,), (3,), (4,)]
    assert [t.name for t in spark.catalog.listTables() if t.name.startswith("kept_parts")] == ["kept_parts"]
    sinks.overwrite_table(parts.where("n > 2"), "kept_parts")
    assert rows(spark.table("kept_parts").select("n")) == [(3,), (4,)]
    spark.sql("DROP TABLE kept_parts")


def test_set_and_latest(spark):
    df = spark.createDataFrame([(1, 1, "a"), (1, 3, "b"), (1, 2, "c"), (2, 1, "d")], "k long, t long, v string")
    assert rows(sinks.latest_value_table(df, ["k"], ["t"])) == [(1, 3, "b"), (2, 1, "d")]
    assert dedup_keys(df, ["k"]).count() == 2


def test_console_marks_rows(spark, tmp_path):
    spark.range(3).write.parquet(str(tmp_path / "in"))
    stream = files.stream_files(spark, str(tmp_path / "in"), "id BIGINT")
    query = sinks.console(stream, "main", str(tmp_path / "checkpoint"))
    query.awaitTermination()
    assert query.lastProgress["sink"]["numOutputRows"] == 3


def test_repeated_batch_replaces_its_rows(spark, tmp_path):
    write = sinks.batch_files(str(tmp_path / "out"))
    write(numbers(spark, 1, 3), 0)
    write(numbers(spark, 1, 3), 0)
    write(numbers(spark, 4, 4), 1)
    assert spark.read.parquet(str(tmp_path / "out")).count() == 4


def test_pinned_rows_live_in_the_shared_folder(spark):
    pinned = session.pin(numbers(spark, 1, 4), "test")
    assert rows(pinned) == [(1,), (2,), (3,), (4,)]
    assert all(f.startswith("file:" + session.shared_dir(spark)) or session.shared_dir(spark) in f
               for f in pinned.inputFiles())
    assert os.path.isdir(session.shared_dir(spark))


def test_overwrite_keeps_format_types_and_partitions(spark):
    spark.sql("DROP TABLE IF EXISTS shaped")
    spark.sql("CREATE TABLE shaped (n INT, label STRING, part STRING) USING orc PARTITIONED BY (part)")
    spark.sql("INSERT INTO shaped VALUES (1, 'a', 'x'), (2, 'b', 'y')")
    rows = spark.createDataFrame([("z", 7, "c"), ("x", 8, "d")], "part string, n long, label string")
    sinks.overwrite_table(rows, "shaped")
    assert {tuple(r) for r in spark.table("shaped").collect()} == {(7, "c", "z"), (8, "d", "x")}
    assert spark.table("shaped").schema["n"].dataType.simpleString() == "int"
    told = {r.col_name: r.data_type for r in spark.sql("DESCRIBE FORMATTED shaped").collect()}
    assert told["Provider"].lower() == "orc"
    assert [r[0] for r in spark.sql("SHOW PARTITIONS shaped").orderBy("partition").collect()] == ["part=x", "part=z"]
    spark.sql("DROP TABLE shaped")


def test_repeated_records_are_read_once(spark):
    df = spark.createDataFrame([(1, "a", None), (2, None, "a"), (3, "a", None)], "id int, x string, y string")
    sent = connectors.kafka_records(df, dedup=["x", "y"])
    assert connectors.once(sent.unionByName(sent)).count() == 2  # rows 1 and 3 have the same id by choice
    whole = connectors.kafka_records(df, dedup=["id"])
    plain = connectors.kafka_records(df)
    assert connectors.once(whole.unionByName(whole)).count() == 3
    assert connectors.once(plain.unionByName(plain)).count() == 6


def test_jdbc_batches_replace_their_own_rows(spark, monkeypatch):
    table = []  # stands for the database: rows with the id of their batch
    monkeypatch.setattr(connectors, "write_jdbc", lambda df, url, name, **more: table.extend(tuple(r) for r in df.collect()))

    def execute(statement):
        batch = int(statement.removeprefix("DELETE FROM t WHERE batch_id = "))
        table[:] = [r for r in table if r[-1] != batch]

    write = connectors.jdbc_batches("jdbc:x", "t", execute)
    write(numbers(spark, 1, 3), 0)
    write(numbers(spark, 1, 2), 1)
    write(numbers(spark, 1, 2), 1)
    assert sorted(r[-1] for r in table) == [0, 0, 0, 1, 1]


def test_routes_have_their_own_writers(spark, tmp_path):
    df = spark.createDataFrame([(1, "a"), (2, "b"), (3, "a")], "id int, route string")
    targets = {k: sinks.batch_files(str(tmp_path / k)) for k in "ab"}
    write = sinks.route_writers(targets)
    for _ in range(2):  # a repeated batch replaces what it wrote
        write(df, 0)
    read = {k: sorted(r.id for r in spark.read.parquet(str(tmp_path / k)).collect()) for k in "ab"}
    assert read == {"a": [1, 3], "b": [2]}
    with pytest.raises(ValueError, match="no writer"):
        sinks.route_writers({"a": targets["a"]})(df, 1)
    assert spark.read.parquet(str(tmp_path / "a")).count() == 2


def test_repeated_records_of_a_stream(spark, tmp_path):
    df = spark.sql("SELECT id, TIMESTAMP'2024-01-01' AS ts FROM range(3)")
    sent = connectors.kafka_records(df, ts="ts", dedup=["id"])
    plain = connectors.kafka_records(df, ts="ts")
    sent.unionByName(sent).unionByName(plain).unionByName(plain).coalesce(1).write.parquet(str(tmp_path / "in"))
    sent.coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    stream = files.stream_files(spark, str(tmp_path / "in"), "value STRING, timestamp TIMESTAMP", maxFilesPerTrigger="1")
    out, checkpoint = str(tmp_path / "out"), str(tmp_path / "checkpoint")
    sinks.write_exactly_once(connectors.once(stream), out, checkpoint).awaitTermination()
    assert spark.read.parquet(out).count() == 9  # three once, three without an id twice
