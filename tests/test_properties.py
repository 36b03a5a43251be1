"""Property tests: merge semantics against a plain-Python model on generated
inputs (few examples: each one runs Spark jobs)."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from conftest import rows
from quillspark.operators import merge

FLAGS = ["NEW", "UPDATED", "DELETED", "BOGUS", "", None]

keys = st.one_of(st.none(), st.integers(0, 12))
target_rows = st.lists(st.tuples(keys, st.integers(0, 99)), max_size=12)
delta_rows = st.lists(st.tuples(keys, st.integers(100, 199), st.sampled_from(FLAGS)), max_size=12,
                      unique_by=lambda r: r[0] if r[0] is not None else object())

SETTINGS = settings(max_examples=12, deadline=None,
                    suppress_health_check=[HealthCheck.function_scoped_fixture, HealthCheck.too_slow])


def model_merge(target, delta):
    """Reference semantics of the change-flag MERGE, row by row."""
    by_key = {k: (v, f) for k, v, f in delta if k is not None}
    out = []
    for k, v in target:
        if k is not None and k in by_key:
            dv, f = by_key[k]
            if f == "DELETED":
                continue
            out.append((k, dv if f == "UPDATED" else v))
        else:
            out.append((k, v))
    present = {k for k, _ in target if k is not None}
    for k, v, f in delta:
        if (k is None or k not in present) and f in ("NEW", "UPDATED"):
            out.append((k, v))
    return sorted(out, key=lambda t: (t[0] is None, t[0] if t[0] is not None else 0, t[1]))


@SETTINGS
@given(target=target_rows, delta=delta_rows)
def test_merge_matches_model(spark, target, delta):
    t = spark.createDataFrame(target, "k long, v long")
    d = spark.createDataFrame(delta, "k long, v long, flag string")
    for broadcast in (True, False):
        got = merge.merge_change_flags(t, d, ["k"], "flag", broadcast=broadcast)
        assert sorted(rows(got), key=lambda r: (r[0] is None, r[0] or 0, r[1])) == model_merge(target, delta)
