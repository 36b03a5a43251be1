"""The corpus pipeline against brute force, stage by stage, and its edge cases."""

import re
from collections import Counter

import corpus_pipeline
from conftest import SF_SMALL
from pyspark.sql import functions as F
from quillspark.llm import language, queries

from test_corpus_operators import brute_components, brute_fingerprint, brute_hits, brute_mix

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def words(text):
    return len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))


def brute_stages(spark):
    """Row by row: what each stage keeps of ``documents``, as (doc_id, text, source) lists."""
    docs = [(r["doc_id"], r["text"], r["source"]) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()]
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{SF_SMALL}/benchmark.parquet").collect()]
    known = {r["doc_id"] for r in queries.op3_language(spark, SF_SMALL).collect()
             if r["lang_pred"] != "und" and r["score"] >= corpus_pipeline.LEAST_SCORE}
    out = [("language", [d for d in docs if d[0] in known])]
    fps = {d: brute_fingerprint(t) for d, t, _ in out[-1][1]}
    near = [(a, b) for a in fps for b in fps if a < b and bin(fps[a] ^ fps[b]).count("1") <= 2]
    part = brute_components(fps, near)
    out.append(("near_copies", [d for d in out[-1][1] if part[d[0]] == d[0]]))
    out.append(("benchmark", [d for d in out[-1][1] if not brute_hits(d[1], items)[1]]))
    return out


def test_every_stage_against_brute_force(spark):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language", "near_copies", "benchmark", "mixing", "sharding"]
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    want = dict(brute_stages(spark))
    for name, stage in corpus_pipeline.STAGES[:3]:
        docs = stage(spark, docs, SF_SMALL).checkpoint()
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
        assert sorted((r["doc_id"], r["text"], r["source"]) for r in docs.collect()) == sorted(want[name])
    _, taken = brute_mix(want["benchmark"])
    mixed = corpus_pipeline.mix_sources(spark, docs, SF_SMALL).checkpoint()
    got = Counter()
    texts = {d: t for d, t, _ in want["benchmark"]}
    for r in mixed.collect():
        got[r["doc_id"]] += words(r["text"])
        assert texts[r["doc_id"]].startswith(r["text"]) and (r["text"] != texts[r["doc_id"]]) <= (r["n_chars"] == len(r["text"]))
    assert {k: v for k, v in got.items() if v} == {d: n for (d, _), n in taken.items() if n}
    final = corpus_pipeline.shard(spark, mixed, SF_SMALL).collect()
    sizes = Counter(r["shard"] for r in final)
    assert len(final) == mixed.count() and set(sizes) <= set(range(40))
    assert max(sizes.values()) - min(sizes.get(s, 0) for s in range(40)) <= 1


def test_run_is_the_stages_in_order_and_repeats(spark):
    a = Counter(tuple(r) for r in corpus_pipeline.run(spark, SF_SMALL).collect())
    assert a and a == Counter(tuple(r) for r in corpus_pipeline.run(spark, SF_SMALL).collect())
    assert corpus_pipeline.ORACLE_SQL is None


def test_language_stage_keeps_all_clean_documents(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    kept = {r["doc_id"] for r in corpus_pipeline.language_id(spark, docs, SF_SMALL).collect()}
    lost = [r for r in docs.collect() if r["doc_id"] not in kept]
    assert all(not r["text"] or not language.has_letter(r["text"]) for r in lost)


def test_stages_on_odd_rows(spark):
    rows = [(1, "the same text of some words here", "en", "a", 5), (1, "the same text of some words here", "en", "a", 5),
            (2, None, None, None, None), (3, "", "en", None, 0), (None, "a row without an id", "en", "b", 1),
            (4, "word " * 50000, "en", "b", 250000), (5, "123 456", "de", "a", 7), (6, "und noch ein Text", "de", None, 3)]
    docs = spark.createDataFrame(rows, DOCS)
    for table in (docs, docs.limit(0), docs.withColumn("text", F.lit(None).cast("string"))):
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, table, SF_SMALL)
            extra = ["shard", "slot"] if name == "sharding" else []
            assert out.columns == [*docs.columns, *extra]
            out.collect()
    kept = corpus_pipeline.near_copies(spark, docs, SF_SMALL).collect()
    assert Counter(r["doc_id"] for r in kept) == Counter([1, 2, None, 4, 5, 6])
