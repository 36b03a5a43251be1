"""Session construction and the few cluster-facing helpers every module uses."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Session settings that make results repeatable and plans scale-aware.
#  * UTC session zone: the driver's timestamps carry no zone.
#  * AQE with skew-join splitting and partition coalescing: hot keys in the
#    claim, event and merge joins are split at run time instead of landing
#    in one task.
DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.localShuffleReader.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    # Let Spark remove reliable-checkpoint files once their DataFrame is gone.
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app_name: str = "quillspark", extra: dict | None = None) -> SparkSession:
    """Return a session with the library defaults.

    ``master`` and ``shuffle_partitions`` are only set when given, so a
    cluster submit keeps its own values.
    """
    b = SparkSession.builder.appName(app_name)
    if master:
        b = b.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    ensure_checkpoint_dir(spark)
    return spark


def is_local(master: str) -> bool:
    """True for ``local``, ``local[..]``: driver and executors are one process."""
    return master == "local" or master.startswith("local[")


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder, setting one only when none is set.

    On a cluster ``spark.checkpoint.dir`` must name a shared folder and is
    used as given: without it this raises, because a folder of one machine
    cannot hold intermediate data of others.  Only a local master (tests) gets
    a fresh temporary folder.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf_dir = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if not conf_dir:
        if not is_local(sc.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        conf_dir = tempfile.mkdtemp(prefix="quillspark-ckpt-")
    sc.setCheckpointDir(conf_dir)
    return sc.getCheckpointDir() or conf_dir


def input_partitions(df: DataFrame) -> int:
    """Estimated number of input splits behind ``df``: the optimizer's size of
    the plan over ``spark.sql.files.maxPartitionBytes``.

    Metadata only: no file is listed or opened for it, and no job runs.  The
    optimizer multiplies sizes through joins, so the estimate is capped at
    ``MAX_ESTIMATED_PARTITIONS``; it steers parallelism, never results.
    """
    split = _bytes(df.sparkSession.conf.get("spark.sql.files.maxPartitionBytes", "128m"))
    size = int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())
    return min(MAX_ESTIMATED_PARTITIONS, max(1, -(-size // max(1, split))))


MAX_ESTIMATED_PARTITIONS = 100_000


def _bytes(text: str) -> int:
    """Spark size string (``134217728b``, ``128m``, ``1g``) to bytes."""
    m = re.fullmatch(r"\s*(\d+)\s*([kmgtp]?)b?\s*", text.lower())
    if not m:
        return 128 * 1024 * 1024
    return int(m.group(1)) * 1024 ** " kmgtp".index(m.group(2) or " ")


def default_parallelism(df: DataFrame) -> int:
    """Partition count for a range/hash repartition of ``df``: at least the
    shuffle setting and at least one partition per input split."""
    return max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), input_partitions(df))


def work_path(spark: SparkSession, *parts: str, unique: bool = True) -> str:
    """A folder under the shared checkpoint folder for tables this library writes.

    ``unique`` appends a random component, so two runs never share a folder
    (old folders are left to the cluster's retention policy, never removed
    here).
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or ensure_checkpoint_dir(spark)
    root = root.rstrip("/")
    leaf = "/".join(parts) if parts else "work"
    if unique:
        leaf = f"{leaf}-{uuid.uuid4().hex[:12]}"
    return f"{root}/quillspark/{leaf}"


def _file_system(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a file or folder exists in whatever store ``path`` names."""
    fs, p = _file_system(spark, path)
    return fs.exists(p)


def delete_path(spark: SparkSession, path: str) -> None:
    """Remove a folder that this library wrote (nothing happens if it is gone)."""
    fs, p = _file_system(spark, path)
    fs.delete(p, True)


def _value_bytes(c: Column, t: T.DataType) -> Column:
    """Bytes of one value, real lengths of text, arrays and maps included."""
    if isinstance(t, (T.StringType, T.BinaryType)):
        return 16 + F.coalesce(F.octet_length(c), F.lit(0))
    if isinstance(t, T.VariantType):
        return 16 + F.coalesce(F.octet_length(F.to_json(c)), F.lit(0))
    if isinstance(t, T.StructType):
        out: Column = F.lit(16)
        for f in t.fields:
            out = out + _value_bytes(c[f.name], f.dataType)
        return out
    if isinstance(t, T.ArrayType):
        each = F.aggregate(c, F.lit(0).cast("long"), lambda acc, x: acc + _value_bytes(x, t.elementType).cast("long"))
        return 16 + F.coalesce(each, F.lit(0))
    if isinstance(t, T.MapType):
        return 16 + _value_bytes(F.map_keys(c), T.ArrayType(t.keyType)) + _value_bytes(F.map_values(c), T.ArrayType(t.valueType))
    return F.lit(16)


def row_bytes(df: DataFrame) -> Column:
    """Bytes of a row of ``df`` in memory, measured value by value."""
    out: Column = F.lit(16)
    for f in df.schema.fields:
        out = out + _value_bytes(F.col(f"`{f.name}`"), f.dataType)
    return out


# Upper bound on the measured size of a broadcast side.
BROADCAST_MAX_BYTES = 64 * 1024 * 1024


def fits_broadcast(df: DataFrame, max_bytes: int = BROADCAST_MAX_BYTES) -> bool:
    """Whether the rows of ``df`` together measure at most ``max_bytes``.

    One partial aggregate over ``df``: each task sums its own rows and sends one
    number.  Meant for written, small frames (``df`` is read once for it).
    """
    return (df.agg(F.sum(row_bytes(df).cast("long")).alias("b")).first()["b"] or 0) <= max_bytes


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Read one driver table ``<sf_dir>/<name>.parquet``."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
