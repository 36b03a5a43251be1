"""Session helpers: measured broadcast, split estimate, checkpoint folder."""

import pytest
from pyspark.sql import functions as F

from quillspark.session import (_bytes, default_parallelism, ensure_checkpoint_dir, fits_broadcast, input_partitions,
                                is_local, row_bytes, work_path)

SF = "/root/testdata/sf0.001"


def test_row_bytes_measures_real_lengths(spark):
    df = spark.createDataFrame([("x" * 20000, [1, 2], {"k": "y" * 500})], "s string, a array<int>, m map<string,string>")
    assert df.select(row_bytes(df).alias("b")).first()["b"] > 20500


def test_fits_broadcast_is_one_partial_aggregate(spark):
    wide = spark.range(100).select(F.repeat(F.lit("x"), 20000).alias("s"))
    assert fits_broadcast(wide, 3_000_000) and not fits_broadcast(wide, 1_900_000)
    assert fits_broadcast(wide.limit(0))


def test_a_wide_change_set_is_not_broadcast(spark, monkeypatch):
    from quillspark import session
    from quillspark.operators import merge
    target = spark.range(50).select(F.col("id").alias("k"), F.lit("a").alias("s"))
    delta = spark.range(40).select(F.col("id").alias("k"), F.repeat(F.lit("x"), 20000).alias("s"), F.lit("UPDATED").alias("flag"))
    monkeypatch.setattr(merge, "fits_broadcast", lambda d: session.fits_broadcast(d, 100_000))
    plan = merge.merge_change_flags(target, delta, ["k"], "flag")._jdf.queryExecution().executedPlan().toString()
    assert "FullOuter" in plan and "BroadcastHashJoin" not in plan


class _Cluster:
    """A session of a cluster, as far as the checkpoint folder goes."""
    class _Conf:
        def get(self, *a):
            return None

    class _Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

        def getConf(self):
            return _Cluster._Conf()
    conf, sparkContext = _Conf(), _Context()


def test_a_cluster_without_a_shared_checkpoint_folder_is_an_error():
    assert is_local("local") and is_local("local[4]") and not is_local("local-cluster[2,1,1024]") and not is_local("yarn")
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        ensure_checkpoint_dir(_Cluster)


def test_input_partitions_without_running_jobs(spark):
    li = spark.read.parquet(f"{SF}/lineitem.parquet")
    agg = li.groupBy("l_orderkey").count()
    assert input_partitions(agg) >= 1
    assert default_parallelism(agg) >= int(spark.conf.get("spark.sql.shuffle.partitions"))


def test_size_strings():
    assert _bytes("134217728b") == 134217728
    assert _bytes("128m") == 128 * 1024 ** 2
    assert _bytes("1g") == 1024 ** 3


def test_work_path_is_unique_and_under_checkpoint_root(spark):
    a, b = work_path(spark, "x"), work_path(spark, "x")
    assert a != b
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    assert a.startswith(root.rstrip("/").replace("file:", "")) or a.startswith(root.rstrip("/"))
