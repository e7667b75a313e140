"""Stored tables, topics and batch-wise replay."""

import pytest
from pyspark.sql import functions as F

from sensorloom.session import checkpoint_root, scratch_path, write_scratch
from sensorloom.sinks import tables as k
from sensorloom.sources import tables as src
from sensorloom.sources import topic


def ids(df):
    return sorted(r["id"] for r in df.select("id").collect())


def test_checkpoint_root_is_the_session_setting(spark):
    assert checkpoint_root(spark) == spark.conf.get("spark.checkpoint.dir").rstrip("/")
    assert scratch_path(spark, "a") != scratch_path(spark, "a")
    assert ids(write_scratch(spark.range(3), "t")) == [0, 1, 2]


def test_repeated_batch_replaces_itself(spark):
    path = scratch_path(spark, "t")
    write = k.append_batch_to_table(path)
    write(spark.range(5), 0)
    write(spark.range(5, 8), 1)
    write(spark.range(5), 0)
    assert ids(k.read_batches(spark, path)) == list(range(8))


def test_append_replace_delete(spark):
    path = scratch_path(spark, "t")
    k.append_rows(spark.range(10), path, rows_per_file=4)
    k.append_rows(spark.range(10, 11), path)
    stored = spark.read.parquet(path)
    k.replace_table(stored.where("id > 2"), path)  # input is the table itself
    assert ids(spark.read.parquet(path)) == list(range(3, 11))
    k.delete_rows(spark, path, F.col("id") % 2 == 0)
    assert ids(spark.read.parquet(path)) == [3, 5, 7, 9]


def test_delete_keeps_unknown(spark):
    df = spark.createDataFrame([(1, "a"), (2, None), (3, "b")], "id int, s string")
    assert ids(k.keep_after_delete(df, F.col("s") == "a")) == [2, 3]


def test_csv(spark):
    path = scratch_path(spark, "csv")
    rows = [(1, "2022.08.04 18:00", -1.5), (2, None, None), (3, "", 0.0), (4, "a\nb", 1.0), (5, 'say "so";\r\n', 2.0), (6, " x ", 3.0), (7, "\\", 4.0)]
    df = spark.createDataFrame(rows, "id int, timestamp string, x double")
    k.export_csv(df, path, sep=";")
    assert sorted(map(tuple, src.read_exported_csv(spark, path, df.schema, ";").collect())) == rows
    k.export_csv(df, path, drop=("id",))
    assert src.read_exported_csv(spark, path, "timestamp string, x double").count() == 7
    with pytest.raises(Exception, match="cannot be exported"):
        k.export_csv(spark.createDataFrame([("\\N",)], "s string"), path)


def test_a_broken_off_replace_leaves_the_table(spark, monkeypatch):
    path = scratch_path(spark, "replaced")
    k.append_rows(spark.range(3), path)
    real = k._folders

    class Broken:
        def __init__(self, fs):
            self.fs, self.renames = fs, 0

        def __getattr__(self, name):
            return getattr(self.fs, name)

        def rename(self, a, b):
            self.renames += 1
            if self.renames == 2:
                raise OSError("lost")
            return self.fs.rename(a, b)

    monkeypatch.setattr(k, "_folders", lambda s, p: (Broken(real(s, p)[0]), *real(s, p)[1:]))
    with pytest.raises(OSError, match="lost"):
        k.replace_table(spark.range(10, 12), path)
    monkeypatch.undo()
    assert ids(src.read_table(spark, path)) == [0, 1, 2]
    k.replace_table(src.read_table(spark, path).where("id > 0"), path)
    assert ids(src.read_table(spark, path)) == [1, 2]


def test_catalog(spark):
    spark.sql("CREATE DATABASE IF NOT EXISTS loom_test")
    try:
        df = spark.range(3)
        df.write.mode("overwrite").option("path", scratch_path(spark, "tbl")).saveAsTable("loom_test.readings")
        assert "readings" in [r["name"] for r in src.list_tables(spark, "loom_test").collect()]
        assert ids(src.read_table(spark, "loom_test.readings")) == [0, 1, 2]
    finally:
        spark.sql("DROP DATABASE loom_test CASCADE")


def test_schema_inference(spark):
    df = spark.createDataFrame([], "a string, b float, c int, d bigint")
    assert src.infer_table_schema(df) == {"a": "STRING", "b": "DOUBLE", "c": "INT", "d": "BIGINT"}
    with pytest.raises(TypeError):
        src.infer_table_schema(spark.createDataFrame([], "a array<int>"))


def test_topic_options():
    got = topic.topic_options("h:9092", "t", "earliest", None, False, 500)
    assert got == {
        "kafka.bootstrap.servers": "h:9092", "subscribe": "t", "startingOffsets": "earliest",
        "failOnDataLoss": "false", "maxOffsetsPerTrigger": "500",
    }
    assert topic.topic_options("h", "t")["failOnDataLoss"] == "true"


def test_backfill_in_order(spark, skewed):
    """Ordered batches of bounded size, each sent once, with progress."""
    out = scratch_path(spark, "out")
    seen = []

    def send(batch, number):
        k.append_batch_to_table(out)(batch, number)

    n = k.backfill_in_batches(skewed, ["ts", "id"], scratch_path(spark, "stage"), send, 200, seen.append)
    assert n == 5 and [p["rows"] for p in seen] == [200, 200, 200, 200, 100] and seen[-1]["sent"] == seen[-1]["total"] == 900
    rows = spark.read.parquet(out).orderBy("ts", "id").collect()
    assert [r["batch_id"] for r in rows] == [i // 200 for i in range(900)]


def test_message_files(spark, skewed):
    path = scratch_path(spark, "messages")
    k.to_json_messages(skewed).select(F.col("value").cast("string")).write.text(path)
    assert topic.read_message_files(spark, path).count() == 900
    keyed = k.to_json_messages(skewed, "series")
    assert dict(keyed.dtypes) == {"key": "binary", "value": "binary"}


def test_scratch_belongs_to_the_application(spark):
    path = scratch_path(spark, "x")
    assert spark.sparkContext.applicationId in path and path.startswith(checkpoint_root(spark))
