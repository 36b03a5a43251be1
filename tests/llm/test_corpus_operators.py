"""Near duplicates, decontamination, mixing, sharding and components against brute force and edge cases."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from quillspark.llm import decontaminate, embeddings, graph, mixing, queries, sharding, simhash

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def documents(spark):
    return {r["doc_id"]: r for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()}


def brute_components(nodes, linked):
    parent = {n: n for n in nodes}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x
    for a, b in linked:
        a, b = root(a), root(b)
        parent[max(a, b)] = min(a, b)
    return {n: root(n) for n in nodes}


# --- components -------------------------------------------------------------------------

@pytest.mark.parametrize("seed,n,m", [(1, 40, 30), (2, 200, 120), (3, 60, 400)])
def test_components_random(spark, seed, n, m):
    r = random.Random(seed)
    edges = [(r.randrange(n), r.randrange(n)) for _ in range(m)] + [(5, 5), (None, 3), (4, None)]
    got = {x["node"]: x["component"] for x in graph.components(spark.createDataFrame(edges, "u long, v long")).collect()}
    real = [(a, b) for a, b in edges if a is not None and b is not None and a != b]
    assert got == brute_components({x for e in real for x in e}, real)


def test_components_long_chain_star_and_empty(spark):
    chain = [(i, i + 1) for i in range(70)] + [(1000, 1000 + i) for i in range(1, 300)]
    got = {x["node"]: x["component"] for x in graph.components(spark.createDataFrame(chain, "u long, v long")).collect()}
    assert set(got[i] for i in range(71)) == {0} and set(got[1000 + i] for i in range(300)) == {1000}
    assert graph.components(spark.createDataFrame([], "u long, v long")).count() == 0


# --- SimHash ----------------------------------------------------------------------------

def brute_fingerprint(text):
    from xxhash import xxh64_intdigest
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    w = re.findall(r"[^\x20\x09-\x0D]+", low)
    s = [" ".join(w[i:i + 3]) for i in range(len(w) - 2)] or ([" ".join(w)] if w else [])
    h = [xxh64_intdigest(x.encode(), 42) for x in s]
    return sum(1 << i for i in range(64) if 2 * sum(x >> i & 1 for x in h) > len(h))


def test_fingerprint_of_odd_texts():
    for t in (None, "", " \n", "One", "one TWO", "a b c", "É é A a\x0b b\x1cc", "x " * 500, "a b c a b c a b c"):
        assert simhash.fingerprint(t) % 2 ** 64 == brute_fingerprint(t)
    long = " ".join(str(i % 97) for i in range(5000))
    assert simhash.fingerprint(long, piece=64) % 2 ** 64 == simhash.fingerprint(long) % 2 ** 64 == brute_fingerprint(long)


def test_simhash_query_against_all_pairs(spark):
    docs = documents(spark)
    got = {r["doc_id"]: r for r in queries.op4_simhash(spark, SF_SMALL).collect()}
    fps = {d: brute_fingerprint(r["text"]) for d, r in docs.items()}
    assert {d: int(r["fingerprint"], 16) for d, r in got.items()} == fps
    near = [(a, b) for a in fps for b in fps if a < b and bin(fps[a] ^ fps[b]).count("1") <= 2]
    assert {d: r["component_id"] for d, r in got.items()} == brute_components(fps, near)


@pytest.mark.parametrize("max_bits", [0, 2, 5])
def test_gray_index_loses_no_link(spark, max_bits):
    r = random.Random(max_bits)
    codes = {r.getrandbits(64) for _ in range(150)}
    for c in list(codes)[:60]:  # neighbours around some codes, and a dense group
        for _ in range(3):
            codes.add(c ^ (1 << r.randrange(64)) ^ (1 << r.randrange(64)))
    codes |= {sum(1 << b for b in r.sample(range(64), 2)) for _ in range(150)} | {0, 2 ** 64 - 1}
    signed = [c - (1 << 64) if c >> 63 else c for c in codes]
    df = spark.createDataFrame([(c,) for c in signed], "fp long")
    found = simhash.links(df, max_bits, node=8, fan=2, top=3, group=4)  # many levels
    got = {x["node"]: x["component"] for x in graph.components(found).collect()}
    near = [(a, b) for i, a in enumerate(signed) for b in signed[:i] if bin((a ^ b) % 2 ** 64).count("1") <= max_bits]
    want = brute_components(signed, near)
    assert {c: got.get(c, c) for c in signed} == want
    assert all(bin((x["u"] ^ x["v"]) % 2 ** 64).count("1") <= max_bits or want[x["u"]] == want[x["v"]] for x in found.collect())


def test_gray_rank_orders_codes_one_bit_apart(spark):
    df = spark.range(16).select("id", simhash.gray_rank(F.col("id")).alias("rank")).orderBy("rank").collect()
    codes = [r["id"] for r in df]
    assert [r["rank"] for r in df] == list(range(16)) and all(bin(a ^ b).count("1") == 1 for a, b in zip(codes, codes[1:]))


def test_simhash_edges_and_keep_first(spark):
    rows = [(3, "a b c d e f", "en", "s", 1), (1, "a b c d e f", "en", "s", 1), (1, "a b c d e f", "en", "s", 1), (7, None, None, None, None),
            (8, "", "en", "s", 0), (9, "quite another text with words", "en", "s", 2), (None, "a null id", "en", "s", 1)]
    df = spark.createDataFrame(rows, DOCS).withColumn("fp", F.lit("clash")).withColumn("component_id", F.lit(0))
    found = simhash.near_duplicates(df)
    got = {(r["doc_id"], r["component_id"]) for r in found.collect()}
    assert got == {(3, 1), (1, 1), (7, 7), (8, 7), (9, 9), (None, None)}
    kept = simhash.keep_first(df, found)
    assert kept.columns == df.columns and sorted(str(r["doc_id"]) for r in kept.collect()) == ["1", "7", "9", "None"]
    assert simhash.near_duplicates(df.limit(0)).count() == 0


def test_keep_first_decides_by_row_where_ids_repeat(spark):
    a, b, c, d = ("one text of some plain words", "another story about the sea and wind", "numbers go up and down at night",
                  "a fourth thing nobody said before today")
    rows = [(1, a), (5, a), (5, b), (5, c), (5, c), (9, c), (None, d), (None, d), (None, a)]
    df = spark.createDataFrame([(i, t, "en", "s", 1) for i, t in rows], DOCS)
    kept = simhash.keep_first(df, simhash.near_duplicates(df)).collect()
    assert Counter((r["doc_id"], r["text"]) for r in kept) == Counter([(1, a), (5, b), (5, c), (None, d)])


# --- embeddings -------------------------------------------------------------------------

def brute_vectors(rows, cosine=0.95):
    ok = {i: np.array(v, float) for i, v in rows if v and all(x is not None and np.isfinite(x) for x in v) and any(v)}
    near = [(a, b) for a in ok for b in ok if a < b and len(ok[a]) == len(ok[b])
            and ok[a] @ ok[b] / np.sqrt((ok[a] @ ok[a]) * (ok[b] @ ok[b])) >= cosine]
    n = Counter(x for e in near for x in e)
    part = brute_components([i for i, _ in rows], near)
    return {i: (n[i], part[i], part[i] == i) for i, _ in rows}


@pytest.mark.parametrize("dims,blocks,cell_dims,chunk", [(16, 4, 2, 7), (16, 8, 1, 2048), (5, 4, 3, 3), (1, 4, 2, 2), (64, 4, 2, 16)])
def test_embeddings_against_all_pairs(spark, dims, blocks, cell_dims, chunk):
    r = np.random.default_rng(dims)
    centres = r.normal(size=(12, dims))
    rows = [(i, (centres[i % 12] * r.uniform(0.1, 9) + r.normal(size=dims) * r.choice([0.05, 0.2, 0.3])).tolist()) for i in range(160)]
    rows += [(200 + i, rows[3][1]) for i in range(25)]  # equal vectors
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = embeddings.near_duplicates(df, blocks=blocks, cell_dims=cell_dims, chunk=chunk, tile=8, sample=50)
    assert {x["vec_id"]: (x["n_links"], x["component_id"], x["kept"]) for x in got.collect()} == brute_vectors(rows)


def test_embeddings_edges(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, None), (2, []), (3, [0.0, 0.0]), (4, [1.0, None]), (5, [nan, 1.0]), (6, [inf, 1.0]), (7, [1.0, 0.0]), (8, [2.0, 0.0]),
            (9, [1.0, 0.0, 0.0]), (10, [-1.0, 0.0]), (11, [1e-200, 0.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn("v", F.lit(1)).withColumn("n_links", F.lit(1))
    got = {x["vec_id"]: (x["n_links"], x["component_id"], x["kept"]) for x in embeddings.near_duplicates(df.union(df)).collect()}
    assert got == {i: (1, 7, i == 7) if i in (7, 8) else (0, i, True) for i, _ in rows}  # 1e-200 is zero as a float
    assert embeddings.near_duplicates(df.limit(0)).count() == 0
    none = embeddings.near_duplicates(spark.createDataFrame([(None, [1.0])], "vec_id long, embedding array<float>")).collect()
    assert [tuple(r) for r in none] == [(None, 0, None, False)]


def test_embeddings_query_finds_every_link(spark):
    sf = SF_SMALL.replace("sf0.001", "sf0.01")
    rows = [(r["vec_id"], list(r["embedding"])) for r in spark.read.parquet(f"{sf}/embeddings.parquet").collect()]
    got = {x["vec_id"]: (x["n_links"], x["component_id"], x["kept"]) for x in queries.op8_embeddings(spark, sf).collect()}
    assert got == brute_vectors(rows)


# --- decontamination --------------------------------------------------------------------

def brute_words(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)


def brute_hits(text, items, size=10):
    w = brute_words(text)
    hit, found = set(), set()
    for item, t in items:
        b = brute_words(t)
        for i in range(max(1, len(b) - size + 1) if b else 0):
            win = b[i:i + size]
            for j in range(len(w) - len(win) + 1):
                if w[j:j + len(win)] == win:
                    hit |= set(range(j, j + len(win)))
                    found.add(str(item))
    return len(w), len(hit), sorted(found)


def test_contamination_against_brute_force(spark):
    r = random.Random(4)
    vocab = ["the", "of", "a", "Cat", "dÉg", "x1", "42", "Straße", "b-c", "q"]
    text = lambda n: "".join(r.choice(vocab) + r.choice([" ", ", ", "\n", "-"]) for _ in range(n))
    items = [(i, text(r.choice([0, 1, 3, 10, 11, 25]))) for i in range(14)] + [(50, None), (51, "..."), (52, "the"), (10, "the of the of")]
    rows = []
    for i in range(60):
        t = text(r.randint(0, 40)) + r.choice([items[r.randrange(14)][1], "", items[r.randrange(14)][1].upper()]) + text(r.randint(0, 9))
        rows.append((i, t))
    rows += [(1, "the of the of"), (1, "the of the of"), (None, items[5][1]), (None, None), (70, None), (71, ""), (72, "the " * 30000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("w", F.lit(1)).withColumn("item_id", F.lit("c"))
    bench = spark.createDataFrame(items, "item_id long, text string").withColumn("terms", F.lit(0))
    got = Counter((x["doc_id"], x["n_words"], x["n_hit"], tuple(x["items"])) for x in decontaminate.contamination(docs, bench).collect())
    want = Counter()
    for d, t in rows:
        n, h, f = brute_hits(t, items) if len(t or "") < 50000 else (30000, 30000, brute_hits(t[:200], items)[2])
        want[(d, n, h, tuple(f))] += 1
    assert got == want
    clean = decontaminate.clean(docs, bench)
    assert clean.columns == docs.columns
    assert Counter(r["doc_id"] for r in clean.collect()) == Counter(d for d, n, h, f in want.elements() if not h)


def test_contamination_without_broadcast_and_empty(spark, monkeypatch):
    docs = spark.createDataFrame([(1, "a b c d"), (2, "b c")], "doc_id long, text string")
    bench = spark.createDataFrame([(1, "b c")], "item_id long, text string")
    rows = lambda: sorted(tuple(r) for r in decontaminate.contamination(docs, bench).collect())
    want = [(1, 4, 2, ["1"]), (2, 2, 2, ["1"])]
    assert rows() == want
    monkeypatch.setattr(decontaminate, "fits", lambda t: False)
    monkeypatch.setattr(decontaminate, "checked_broadcast", lambda t: t)
    assert rows() == want
    assert decontaminate.contamination(docs.limit(0), bench).count() == 0
    assert [r["n_hit"] for r in decontaminate.contamination(docs, bench.limit(0)).collect()] == [0, 0]


def test_proximity_against_brute_force(spark):
    r = random.Random(9)
    docs = [(i, " ".join(r.choice("abcdefgh") for _ in range(40))) for i in range(25)]
    items = [(1, "a b c"), (2, "h a"), (3, "e")]
    got = {(x["doc_id"], x["item_id"]) for x in decontaminate.proximity(
        spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"), 5).collect()}
    want = {(d, str(i)) for d, t in docs for i, q in items for s in range(40)
            if set(q.split()) <= set(t.split()[s:s + 5])}
    assert got == want


# --- mixing -----------------------------------------------------------------------------

def brute_targets(sizes, weights=(5, 2, 1), share=1.5, epochs=2):
    w = {s: weights[i % len(weights)] for i, s in enumerate(sorted(sizes))}
    total, shut = share * sum(sizes.values()), set()
    while True:
        left = total - sum(epochs * sizes[s] for s in shut)
        ws = sum(w[s] for s in sizes if s not in shut)
        t = {s: float(epochs * sizes[s]) if s in shut else w[s] * left / ws for s in sizes}
        over = {s for s in sizes if s not in shut and t[s] >= epochs * sizes[s]}
        if not over:
            return t
        shut |= over


def brute_mix(rows, seed=23):
    key = lambda s: "t" if s is None else "s" + s
    size = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    by = defaultdict(list)
    for d, t, s in rows:
        k = hashlib.md5(f"{seed}:{'null' if d is None else d}".encode()).hexdigest() + f"{zlib.crc32((t or '').encode()):08X}"
        by[key(s)].append((k, d, size(t)))
    t = brute_targets({s: sum(x[2] for x in v) for s, v in by.items()})
    taken = Counter()
    for s, v in by.items():
        of = sum(x[2] for x in v)
        left = int(t[s] + 0.5)
        for k, d, n in sorted(v, key=lambda x: x[0]):
            if of:
                again = max(0, min(n, left % of))
                before = sum(x[2] for x in v if x[0] < k)
                taken[(d, s)] += left // of * n + max(0, min(n, left % of - before))
    return t, taken


def test_mixing_against_brute_force(spark):
    r = random.Random(6)
    names = ["b", "a", None, "Z", "é", "\U0001f600", "empty", "c"]
    rows = [(i, " ".join("w" * r.randint(1, 5) for _ in range(r.choice([0, 1, 5, 30, 400]))), r.choice(names[:6])) for i in range(400)]
    rows += [(900, None, "empty"), (901, "", "empty"), (902, "only one", "c"), (None, "null id", "b")]
    df = spark.createDataFrame([(d, t, "en", s, 0) for d, t, s in rows], DOCS).withColumn("size", F.lit("clash")).withColumn("src", F.lit(1))
    got = mixing.mix(df, range_rows=16)
    t, taken = brute_mix(rows)
    out = got.collect()
    assert len(out) == len(rows) and got.columns == [*df.columns, "mix"]
    for x in out:
        s = "t" if x["source"] is None else "s" + x["source"]
        assert x["mix"]["target"] == pytest.approx(t[s], rel=1e-12)
        assert x["mix"]["taken"] == taken[(x["doc_id"], s)] <= 2 * x["mix"]["size"]
    whole = Counter()
    for x in mixing.repeat_rows(got).collect():
        whole[x["doc_id"]] += len(re.findall(r"[^\x20\x09-\x0D]+", x["text"] or ""))
    assert {k: v for k, v in whole.items() if v} == {x["doc_id"]: x["mix"]["taken"] for x in out if x["mix"]["taken"]}


def test_mixing_repeats_and_empty(spark):
    same = spark.createDataFrame([(1, "a b c d e", "en", "s", 9)] * 10 + [(2, "x", "en", "u", 1)], DOCS)
    out = mixing.mix(same).collect()
    assert len(out) == 11 and len({x["mix"]["taken"] for x in out if x["doc_id"] == 1}) == 1
    assert mixing.mix(same.limit(0)).count() == 0
    none = mixing.mix(same.withColumn("text", F.lit(None).cast("string"))).collect()
    assert {x["mix"]["taken"] for x in none} == {0} and {x["mix"]["target"] for x in none} == {0.0}
    cut = [x for x in mixing.repeat_rows(mixing.mix(spark.createDataFrame(
        [(i, " a  b\tc d e f g h", "en", "s", 17) for i in range(3)] + [(9, "y " * 40, "en", "t", 80)], DOCS))).collect() if x["source"] == "s"]
    assert all(" a  b\tc d e f g h".startswith(x["text"]) and x["n_chars"] == len(x["text"]) for x in cut)


def test_mixing_query_is_stable_and_meets_targets(spark):
    a, b = ({r["doc_id"]: tuple(r) for r in queries.op9_mixing(spark, SF_SMALL).collect()} for _ in range(2))
    assert a == b
    docs, sums, targets = documents(spark), Counter(), {}
    for d, r in a.items():
        sums[docs[d]["source"]] += r[4]
        targets[docs[d]["source"]] = r[3]
    assert all(abs(sums[s] - targets[s]) <= 0.5 for s in targets)


# --- sharding ---------------------------------------------------------------------------

@pytest.mark.parametrize("n,shards,bucket_rows", [(1000, 40, 50), (37, 40, 4), (500, 7, 2048), (1, 3, 1)])
def test_sharding_is_even_and_proportional(spark, n, shards, bucket_rows):
    r = random.Random(n)
    rows = [(i, f"t{i}", "en", r.choice(["hot"] * 6 + ["b", "c", None]), 0) for i in range(n)]
    df = spark.createDataFrame(rows, DOCS).withColumn("rank", F.lit("clash")).repartition(5)
    got = sharding.stratified_shards(df, shards, bucket_rows=bucket_rows).collect()
    by = defaultdict(list)
    for x in got:
        by[x["shard"]].append(x)
    assert len(got) == n and set(by) <= set(range(shards))
    assert max(len(by[s]) for s in range(shards)) - min(len(by[s]) for s in range(shards)) <= 1
    assert all(sorted(x["slot"] for x in v) == list(range(len(v))) for v in by.values())
    strata = Counter(x["source"] for x in got)
    for v in by.values():
        for s, k in strata.items():
            assert abs(sum(x["source"] == s for x in v) - k * len(v) / n) <= len(strata)
    # The sequence is the one of exact fractions.
    seq = [x for s in sorted(by) for x in sorted(by[s], key=lambda x: x["slot"])]
    name = lambda x: "n" if x["source"] is None else "s" + x["source"]
    want, seen = sorted(((2 * k + 1) / (2 * m), s) for s, m in Counter(map(name, got)).items() for k in range(m)), Counter()
    assert [name(x) for x in seq] == [s for _, s in want]


def test_sharding_query_and_edges(spark):
    docs = documents(spark)
    got = queries.op5_sharding(spark, SF_SMALL).collect()
    for x in got:
        t = (docs[x["doc_id"]]["text"] or "").encode()
        assert (x["size"], x["text_crc32"], x["law"], x["grown_shard"]) == (len(t) + 16, zlib.crc32(t), "rows", None)
    assert {tuple(x) for x in got} == {tuple(x) for x in queries.op5_sharding(spark, SF_SMALL).collect()}
    same = spark.createDataFrame([(1, "a", "en", "s", 0)] * 50 + [(None, None, None, None, None)] * 3, DOCS)
    sizes = Counter(x["shard"] for x in sharding.stratified_shards(same, 4).collect())
    assert sorted(sizes.values()) == [13, 13, 13, 14]
    assert sharding.stratified_shards(same.limit(0), 4).count() == 0
    clash = same.withColumn("shard", F.lit("old")).withColumn("_q_src", F.lit(1))
    assert sharding.stratified_shards(clash, 4).columns[-2:] == ["shard", "slot"]


# --- rows of any type, many sources -------------------------------------------------------

def test_deduplicate_like_keep_first_and_with_maps(spark):
    a, b, c, d = ("one text of some plain words", "another story about the sea and wind", "numbers go up and down at night",
                  "a fourth thing nobody said before today")
    rows = [(1, a), (5, a), (5, b), (5, c), (5, c), (9, c), (None, d), (None, d), (None, a), (7, None), (8, "")]
    df = spark.createDataFrame([(i, t, "en", "s", 1) for i, t in rows], DOCS).withColumn("_row", F.lit("clash"))
    want = Counter([(1, a), (5, b), (5, c), (None, d), (7, None)])
    assert Counter((r["doc_id"], r["text"]) for r in simhash.deduplicate(df).collect()) == want
    held = df.withColumn("extra", F.create_map(F.lit("k"), F.array(F.col("n_chars"))))
    got = simhash.deduplicate(held)
    assert got.columns == held.columns and Counter((r["doc_id"], r["text"]) for r in got.collect()) == want
    assert Counter((r["doc_id"], r["text"]) for r in simhash.keep_first(df, simhash.near_duplicates(df)).collect()) == want
    assert simhash.deduplicate(held.limit(0)).count() == 0


def test_deduplicate_moves_texts_by_one_join_at_every_size(spark):
    df = spark.createDataFrame([(i, f"text number {i} of a few", "en", "s", 1) for i in range(30)], DOCS)
    plan = simhash.deduplicate(df)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("SortMergeJoin") >= 1 and "LeftSemi" in plan and "component_fp" not in plan.split("LeftSemi")[0]


def test_sharding_of_many_sources_and_maps(spark):
    rows = [(i, "t", "en", f"s{i % 300}" if i < 600 else f"one{i}", 0) for i in range(900)]
    df = spark.createDataFrame(rows, DOCS).withColumn("extra", F.create_map(F.lit("k"), F.col("doc_id")))
    got = sharding.stratified_shards(df, 7, bucket_rows=5).collect()
    by = defaultdict(list)
    for x in got:
        by[x["shard"]].append(x)
    assert len(got) == 900 and all(sorted(x["slot"] for x in v) == list(range(len(v))) for v in by.values())
    seq = [x["source"] for s in sorted(by) for x in sorted(by[s], key=lambda x: x["slot"])]
    want = sorted(((2 * k + 1) / (2 * m), s) for s, m in Counter(x["source"] for x in got).items() for k in range(m))
    assert seq == [s for _, s in want]


def test_fraction_keys_sort_like_fractions(spark):
    from fractions import Fraction
    r = random.Random(6)
    cells = [(k, m) for m in range(1, 25) for k in range(m)]
    for m in (2 ** 40 - 1, 2 ** 40 - 2, 10 ** 12, 3 * 10 ** 11 + 1):
        k = r.randrange(m)
        cells += [(k, m), (k + 1 if k + 1 < m else 0, m), (0, m), (m - 1, m), (m // 2, m)]
    df = spark.createDataFrame(cells, "k long, m long")
    a, b = sharding.fraction_key(F.col("k"), F.col("m"))
    got = [(Fraction(2 * x["k"] + 1, 2 * x["m"]), x["a"], x["b"]) for x in df.select("k", "m", a.alias("a"), b.alias("b")).collect()]
    assert len({f for f, *_ in got}) == len({x[1:] for x in got})
    assert [f for f, *_ in sorted(got)] == [f for f, *_ in sorted(got, key=lambda x: x[1:])]
