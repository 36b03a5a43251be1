"""The skew-safe replacements for windows and pair joins, checked against
brute force on random inputs that include one hot key and many ties."""

import datetime as dt
import random

from pyspark.sql import Window
from pyspark.sql import functions as F

from conftest import rows
from quillspark.operators import claims


def _claims_and_reversals(spark, seed=3):
    rnd = random.Random(seed)
    base = dt.datetime(2024, 1, 1)
    c, r = [], []
    for i in range(800):
        key = "hot" if rnd.random() < 0.35 else f"k{rnd.randint(0, 40)}"
        row = (i, key, rnd.choice(["A", "B"]), base + dt.timedelta(days=rnd.randint(0, 20)))
        (c if rnd.random() < 0.5 else r).append(row)
    schema = "id long, k1 string, k2 string, t timestamp_ntz"
    return spark.createDataFrame(c, schema), spark.createDataFrame(r, schema)


def test_count_matches_equals_pair_join(spark):
    c, r = _claims_and_reversals(spark)
    pairs = claims.match_reversals(c, r, ["k1", "k2"], "t", "t")
    want = (pairs.count(), pairs.select("id").distinct().count())
    got = claims.count_matches(c, r, ["k1", "k2"], "t", "t").first()
    assert tuple(got) == want


def test_apply_reversals_picks_latest_then_largest_id(spark):
    c, r = _claims_and_reversals(spark)
    pairs = claims.match_reversals(c, r, ["k1", "k2"], "t", "t")
    w = Window.partitionBy("id").orderBy(F.col("rev_t").desc(), F.col("rev_id").desc())
    best = pairs.withColumn("rn", F.row_number().over(w)).filter("rn = 1")
    want = rows(best, "id", "rev_id", "rev_t")
    out = claims.apply_reversals(c, r, ["k1", "k2"], "t", "t", "id").filter("reversed")
    assert rows(out, "id", "reversed_record_id", "reversal_time") == want


def test_count_matches_of_odd_values(spark):
    """19-digit keys beside NULLs, the year 9999, many times in one day, no rows."""
    base, far = dt.datetime(2024, 1, 1), dt.datetime(9999, 12, 31, 23)
    big = 1367454241321304065
    c = [(big, base), (big + 1, base), (big + 2, far), (None, base), (big, None), (big, far)]
    r = [(big, far), (big, base + dt.timedelta(microseconds=1)), (big + 1, base), (None, far), (big + 2, far)]
    c += [(7, base + dt.timedelta(microseconds=i)) for i in range(300)]
    r += [(7, base + dt.timedelta(microseconds=3 * i)) for i in range(50)] * 2
    cd, rd = (spark.createDataFrame(x, "k long, t timestamp_ntz") for x in (c, r))
    pairs = [(i, j) for i, (k, t) in enumerate(c) for j, (l, u) in enumerate(r)
             if k is not None and k == l and t is not None and t < u]
    assert tuple(claims.count_matches(cd, rd, ["k"], "t", "t").first()) == (len(pairs), len({i for i, _ in pairs}))
    assert tuple(claims.count_matches(cd.limit(0), rd, ["k"], "t", "t").first()) == (0, 0)


def test_count_matches_plan_has_no_python_and_two_keyed_exchanges(spark):
    c, r = _claims_and_reversals(spark)
    plan = claims.count_matches(c, r, ["k1", "k2"], "t", "t")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 2 and "Python" not in plan and "Pandas" not in plan


def test_recluster_splits_a_hot_bucket(spark):
    from quillspark.operators.layout import recluster
    rows_ = [(i, "bad" if i % 3 == 0 else f"2024-01-01 {i % 24:02d}:00:00", "t") for i in range(3000)]
    df = spark.createDataFrame(rows_, "id long, ev string, typ string")
    out = recluster(df, F.col("ev"), F.col("typ"), n_parts=6)
    sizes = out.groupBy(F.spark_partition_id().alias("p")).count().collect()
    hot = out.filter(F.col("cluster_day") == F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"))
    hot_parts = hot.select(F.spark_partition_id().alias("p")).distinct().count()
    assert hot.count() == 1000 and hot_parts >= 2           # the 1970 bucket is split
    assert max(r["count"] for r in sizes) < 1000             # no partition holds the whole hot bucket
