"""Writers: what a batch may lack, repeat or leave out without harm to the table."""
import os

import pytest
from pyspark.sql import functions as F

from playledger.functions.jsonfn import infer_json_schema, unpack_json
from playledger.operators import lookup as L
from playledger.session import ensure_checkpoint_dir, input_bytes, scratch_path
from playledger.sources import sinks as SK


def local(spark, name):
    return scratch_path(spark, name).replace("file:", "")


def test_null_keys_are_replaced_not_added(spark):
    path = local(spark, "null-key")
    batch = spark.createDataFrame([(1, "a"), (None, "b")], "id long, v string")
    for _ in range(3):
        SK.write_upsert(spark, batch, path, ["id"], buckets=4)
    assert SK.read_upserted(spark, path).count() == 2


def test_bucket_count_is_kept(spark):
    path = local(spark, "buckets")
    rows = spark.range(100).withColumn("v", F.col("id"))
    SK.write_upsert(spark, rows, path, ["id"], buckets=4)
    with pytest.raises(ValueError, match="4 buckets"):
        SK.write_upsert(spark, rows, path, ["id"], buckets=64)
    SK.write_upsert(spark, rows, path, ["id"])
    assert SK.read_upserted(spark, path).count() == 100 and SK.bucket_count(spark, path) == 4


def test_small_batch_rewrites_few_buckets(spark):
    path = local(spark, "share")
    rows = spark.range(1000).withColumn("v", F.col("id"))
    SK.write_upsert(spark, rows, path, ["id"], buckets=100)

    def files():
        return {os.path.join(d, f) for d, _, names in os.walk(path) for f in names if f.endswith(".parquet")}

    before = files()
    SK.write_upsert(spark, rows.where("id < 10").withColumn("v", F.lit(-1).cast("long")), path, ["id"])
    gone = before - files()
    assert 0 < len(gone) <= 10 * len(before) / 100 + 1
    assert SK.read_upserted(spark, path).where("v = -1").count() == 10


def test_damaged_table_is_an_error(spark):
    path = local(spark, "damaged")
    SK.write_upsert(spark, spark.range(9), path, ["id"], buckets=1)
    part = os.path.join(path, "__bucket=0")
    for f in os.listdir(part):
        os.remove(os.path.join(part, f))
    with open(os.path.join(part, "part-0.parquet"), "wb") as f:
        f.write(b"not parquet")
    with pytest.raises(Exception):
        SK.write_upsert(spark, spark.range(3), path, ["id"])
    assert SK.table_exists(spark, path) and not SK.table_exists(spark, path + "-none")


def test_empty_batch_leaves_table_and_no_staging(spark):
    path = local(spark, "guarded")
    assert SK.write_guarded(spark.range(5), path)
    assert not SK.write_guarded(spark.range(0), path)
    assert spark.read.parquet(path).count() == 5
    assert [n for n in os.listdir(os.path.dirname(path)) if n.startswith(os.path.basename(path) + "__")] == []


def test_failed_rebuild_leaves_the_table(spark):
    path = local(spark, "failed")
    SK.write_guarded(spark.range(5), path)
    with pytest.raises(Exception):
        SK.write_guarded(spark.range(5).select(F.raise_error(F.lit("boom")).alias("id")), path)
    assert spark.read.parquet(path).count() == 5


def test_few_files_for_each_day(spark):
    path = local(spark, "layout")
    rows = spark.range(0, 20000, numPartitions=8).select("id", F.date_format(F.date_add(F.lit("2024-01-01"), (F.col("id") % 200).cast("int")), "yyyy-MM-dd").alias("day"))
    SK.write_guarded(rows, path, partition_by=["day"])
    n = sum(len([f for f in names if f.endswith(".parquet")]) for _, _, names in os.walk(path))
    assert 200 <= n <= 400


def test_json_keys_beside_a_scalar(spark):
    df = spark.createDataFrame([('{"a": 1, "b": {"c": "x"}}',), ("5",), ("[1]",), (None,), ("no json",)], "j string")
    assert unpack_json(df, "j").columns == ["j_a", "j_b.c"]
    odd = spark.createDataFrame([('{"OBJECT<x": 1, "y z": 2}',)], "j string")
    assert [f.name for f in infer_json_schema(odd, "j").fields] == ["OBJECT<x", "y z"]


def test_overrides_mask_and_order(spark):
    df = spark.createDataFrame([(1, None, 77), (2, 5, None), (3, None, None)], "res long, camp long, line long")
    ov = spark.createDataFrame([(1, 900, 901), (2, 902, 903), (3, 7, 3), (3, 7, 4)], "res long, camp long, line long")
    out = {r.res: (r.camp, r.line) for r in L.override_where_null(df, "res", ov, ["camp", "line"], when_null="camp").collect()}
    assert out == {1: (900, 901), 2: (5, None), 3: (7, 4)}
    each = {r.res: (r.camp, r.line) for r in L.override_where_null(df, "res", ov, ["camp", "line"]).collect()}
    assert each == {1: (900, 77), 2: (5, 903), 3: (7, 4)}


def test_rows_without_a_key_are_dealt_out(spark):
    old = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.enabled", "spark.sql.autoBroadcastJoinThreshold")}
    try:
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        left = spark.range(8000).select("id", F.when(F.col("id") % 2 == 0, F.col("id")).alias("k"))
        dim = spark.range(0, 8000, 4).select(F.col("id").alias("k"), (F.col("id") + 1).alias("name"))
        out = L.lookup_join(left, dim, "k", ["name"])
        sizes = [r["count"] for r in out.groupBy(F.spark_partition_id().alias("p")).count().collect()]
        assert max(sizes) < 8000 / 2 and len(sizes) == int(spark.conf.get("spark.sql.shuffle.partitions"))
        assert out.where("name IS NOT NULL").count() == 2000 and out.count() == 8000
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)


def test_shared_folder_is_required_off_a_local_master():
    class Context:
        master = "spark://somewhere:7077"

        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext = Context()
        conf = {}

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        ensure_checkpoint_dir(Session())


def test_input_bytes(spark):
    path = local(spark, "bytes")
    spark.range(1000).write.parquet(path)
    assert input_bytes([path, path + "-none"], spark) > 1000
