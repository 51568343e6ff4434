import os

from pyspark.sql import types as T

from parcelflow.plans import sinks

SCHEMA = T.StructType([T.StructField("v", T.StringType()), T.StructField("k", T.StringType())])


def rows(spark, path):
    return sorted(map(tuple, sinks.read_or_empty(spark, path, SCHEMA).select("k", "v").collect()))


def test_overwrite_replaces_only_written_partitions(spark, root):
    path = os.path.join(root, "t")
    sinks.overwrite_partitions(spark.createDataFrame([("1", "a"), ("2", "b")], SCHEMA), path, ["k"])
    sinks.overwrite_partitions(spark.createDataFrame([("3", "a")], SCHEMA), path, ["k"])
    assert rows(spark, path) == [("a", "3"), ("b", "2")]
    sinks.overwrite_partitions(spark.createDataFrame([], SCHEMA), path, ["k"])
    assert rows(spark, path) == [("a", "3"), ("b", "2")]


def test_clear_partitions(spark, root):
    path = os.path.join(root, "t")
    sinks.overwrite_partitions(spark.createDataFrame([("1", "a"), ("2", "b"), ("3", "c's")], SCHEMA),
                               path, ["k"])
    sinks.clear_partitions(spark, path, SCHEMA, ["k"], [{"k": "b"}, {"k": "c's"}])
    assert rows(spark, path) == [("a", "1")]


def test_full_replace_counts(spark, root):
    path = os.path.join(root, "t")
    first = sinks.full_replace(spark, spark.createDataFrame([("1", "a"), ("2", "b")], SCHEMA), path)
    assert first == {"deleted_rows": 0, "inserted_rows": 2}
    second = sinks.full_replace(spark, spark.createDataFrame([("9", "z")], SCHEMA), path)
    assert second == {"deleted_rows": 2, "inserted_rows": 1}
    assert rows(spark, path) == [("z", "9")]


def test_exists(spark, root):
    assert not sinks.exists(spark, os.path.join(root, "nothing"))
    path = os.path.join(root, "t")
    sinks.append(spark.createDataFrame([("1", "a")], SCHEMA), path)
    assert sinks.exists(spark, path)


def test_scale_conf_applies(spark):
    from parcelflow.session import scale_conf
    conf = scale_conf(100 * 1024 ** 4, 8000)
    assert conf["spark.sql.shuffle.partitions"] == "50000"
    assert scale_conf(10 ** 9, 8)["spark.sql.shuffle.partitions"] == "16"
    old = {k: spark.conf.get(k, None) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        assert spark.conf.get("spark.sql.files.maxPartitionBytes") in ("512m", str(512 * 1024 ** 2))
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)
