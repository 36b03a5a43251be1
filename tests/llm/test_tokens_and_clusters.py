"""Centroid clustering, transducer token counts and tokenizer alignment against brute force, and edge cases."""

import hashlib
import json
import random
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from conftest import SF_SMALL
from quillspark.llm import alignment, clustering, queries, transducer

WORDS = str(public_tokenizers.path("word_bpe_49k.json"))
BYTES = str(public_tokenizers.path("byte_bpe_50k.json"))
PIECES = str(public_tokenizers.path("piece_bpe_32k.model"))

VECS = "vec_id long, embedding array<double>, cluster string"


# --- clustering ---------------------------------------------------------------------------

def brute_clusters(rows, k, rounds, dims, scale=256):
    kept = [(i, [int(np.floor(scale * x)) for x in v]) for i, v in rows
            if v is not None and len(v) == dims and all(x is not None and np.isfinite(x) for x in v)]
    named = [(i is None, hashlib.sha256(f"2:{i}".encode()).hexdigest() if i is not None else "", v) for i, v in kept]
    cents = [v for *_, v in sorted(named)[:k]]

    def assign():
        return [min((sum((a - b) ** 2 for a, b in zip(v, c)), j) for j, c in enumerate(cents)) for _, v in kept]
    for _ in range(rounds):
        groups = defaultdict(list)
        for (_, j), (_, v) in zip(assign(), kept):
            groups[j].append(v)
        for j, vs in groups.items():
            cents[j] = [sum(x) // len(vs) for x in zip(*vs)]
    found = assign()
    per = Counter()
    for d, j in found:
        per[j] += d
    return sorted((str(i), j, d, per[j], sum(per.values()), hashlib.sha256(",".join(map(str, cents[j])).encode()).hexdigest())
                  for (i, _), (d, j) in zip(kept, found))


def clustered(spark, rows, k, rounds, dims, **settings):
    df = spark.createDataFrame([(i, v, "x") for i, v in rows], VECS)
    return sorted((str(r[0]), *r[1:]) for r in clustering.cluster(df, k, rounds, dims=dims, **settings).collect())


@pytest.mark.parametrize("seed,n,k,dims,block,bits", [(1, 300, 7, 4, 16, 2), (2, 90, 40, 3, 5, 1), (3, 200, 5, 8, 128, 3)])
def test_clusters_like_brute_force(spark, seed, n, k, dims, block, bits):
    r = random.Random(seed)
    centres = [[r.uniform(-3, 3) for _ in range(dims)] for _ in range(5)]
    rows = [(i % (n - 10), [c + r.gauss(0, .2) for c in r.choice(centres)]) for i in range(n)]
    rows += rows[:20] + [(1, None), (2, []), (3, [1.0] * (dims + 1)), (4, [None] * dims), (None, centres[0]), (None, centres[1]),
                         (5, [float("nan")] * dims), (6, [float("inf")] * dims), (7, [1e5] * dims)]
    assert clustered(spark, rows, k, 5, dims, block=block, bits=bits) == brute_clusters(rows, k, 5, dims)


def test_clusters_ties_copies_and_empty(spark):
    rows = [(i, [0.0, 0.0]) for i in range(60)] + [(100 + i, [1.0, 0.0]) for i in range(3)]
    assert clustered(spark, rows, 4, 3, 2, block=7) == brute_clusters(rows, 4, 3, 2)
    assert clustered(spark, [], 4, 3, 2) == [] and clustered(spark, [(1, None)], 4, 3, 2) == []
    with pytest.raises(Exception, match="a component is above"):
        clustered(spark, [(1, [1e9, 0.0])], 1, 1, 2)


def test_hilbert_keys_walk_to_neighbours():
    for dims, bits in ((2, 3), (3, 2), (4, 2)):
        cells = np.stack(np.meshgrid(*[np.arange(1 << bits)] * dims, indexing="ij"), -1).reshape(-1, dims)
        order = cells[np.lexsort(clustering.hilbert_keys(cells, bits).T[::-1])]
        assert (np.abs(np.diff(order, axis=0)).sum(1) == 1).all()


def test_boxes_keep_every_nearest_centroid():
    r = np.random.default_rng(4)
    fewer = 0
    for _ in range(200):
        v = r.integers(-50, 50, 6) + r.integers(-9, 9, (20, 6))
        cents = r.integers(-60, 60, (30, 6))
        some = clustering.candidates(v.min(0), v.max(0), cents)
        apart = np.square(v[:, None] - cents[None]).sum(2)
        assert set(apart.argmin(1)) <= set(some)
        at, d = clustering.nearest(v, v.min(0), v.max(0), cents)
        assert (at == apart.argmin(1)).all() and (d == apart.min(1)).all()
        fewer += len(some) < 15
    assert fewer > 150


def test_large_components_stay_exact():
    v = np.array([[clustering.LARGEST, -clustering.LARGEST], [clustering.LARGEST - 1, 3]])
    at, d = clustering.nearest(v, v.min(0), v.max(0), np.array([[0, 0], [clustering.LARGEST, 2]]))
    assert at.tolist() == [1, 1] and d.tolist() == [(clustering.LARGEST + 2) ** 2, 2]


# --- token counts ---------------------------------------------------------------------------

@pytest.fixture(scope="module")
def words():
    return Tokenizer.from_file(WORDS)


@pytest.fixture(scope="module")
def machine():
    with open(WORDS, encoding="utf-8") as f:
        return transducer.Machine(json.load(f))


ALPHABETS = ["abehinorst's", "=.-'", "😂🇺🇸❤️", "aé漢 字1２½", "IſΣςİ ", "'revlldmst re 're 've 'll''s ́　\x85\x1cͅ",
             "ab<|>'", "thequickbrownfox"]


def odd_texts(seed=5, n=600):
    r = random.Random(seed)
    out = [None, "", " ", "'", "'r", "'v'", "'ll", "'lx", "''s", "!'s", "a'S", "<|endoftext|>", "x<|ENDOFTEXT|>", "é", "\x00"]
    for i in range(n):
        a = r.choice(ALPHABETS) + r.choice(ALPHABETS) * (i % 2)
        s = "".join(r.choice(a) for _ in range(r.randrange(80)))
        out.append(s + " <|endoftext|>" + s + "<|startoftext|>" if i % 7 == 0 else s)
    return out + ["aeiou" * 2000, "😂" * 900, "=" * 5000, "word " * 3000, "ab" * 3000 + "\n"]


@pytest.mark.parametrize("size,lanes", [(transducer.BUFFER, transducer.LANES), (1000, 7), (333, 64)])
def test_counts_like_the_library(words, machine, size, lanes):
    texts = odd_texts()
    want = [len(words.encode(t or "", add_special_tokens=False).ids) for t in texts]
    assert transducer.count_texts(machine, texts, size, lanes) == want


def test_entry_state_and_chunks_do_not_matter(machine):
    text = "the quick'll thequickbrownfox 'r 1e5 =--= " * 40
    symbols = np.array([ord(c) for c in text + text], np.int64)
    whole, end = transducer.run(machine, symbols, 0)
    for cut in (1, 17, 64, 100, 777):
        left, state = transducer.run(machine, symbols[:cut], 0, 3)
        right, last = transducer.run(machine, symbols[cut:], state, 5)
        assert (np.concatenate([left, right]) == whole).all() and last == end


def test_prefixes_with_one_future_share_a_state(words):
    with open(WORDS, encoding="utf-8") as f:
        m = transducer.Machine(json.load(f))
    r = random.Random(1)
    text = "".join(r.choice("=.") for _ in range(20000))
    assert transducer.count_texts(m, [text]) == [len(words.encode(text, add_special_tokens=False).ids)]
    assert len(m.table.known) < 5000  # far fewer than the prefixes of the run


def test_count_query(spark, words):
    got = {r["doc_id"]: tuple(r)[1:] for r in queries.op12_token_counts(spark, SF_SMALL).collect()}
    rows = spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()
    want = {}
    for r in rows:
        n = len(words.encode(r["text"] or "", add_special_tokens=False).ids)
        want[r["doc_id"]] = (len((r["text"] or "").encode()), n, n > 2048)
    assert got == want


def test_count_clashing_columns_and_empty(spark):
    df = spark.createDataFrame([(1, "it's", "x"), (1, "it's", "x"), (None, None, None)], "n_tokens long, text string, over_limit string")
    got = transducer.token_counts(df, WORDS, 1)
    assert sorted(got.select("n_tokens", "over_limit").collect()) == [(0, False), (2, True), (2, True)]
    assert transducer.token_counts(df.where("false"), WORDS, 1).count() == 0


# --- alignment ------------------------------------------------------------------------------

@pytest.fixture(scope="module")
def encoders():
    return alignment.Encoders(BYTES, PIECES)


def brute_document(e, text):
    """Links as pairs, and the row's other values, from the whole text's tokens."""
    whole = b" " + (text or "").encode()
    a = e.a.encode(" " + (text or ""), add_special_tokens=False).ids
    b = e.b.encode(text or "")
    if not text or b"".join(e.a_bytes[i] for i in a) != whole or b"".join(e.b_bytes[i] for i in b) != whole:
        return [], (0, 0, 0, "")
    a_end, b_end = np.cumsum([len(e.a_bytes[i]) for i in a]).tolist(), np.cumsum([len(e.b_bytes[i]) for i in b]).tolist()
    said, links, i, j = [], [], 0, 0
    for cut in sorted(set(a_end) & set(b_end)):
        p, q = a_end.index(cut) + 1, b_end.index(cut) + 1
        said.append(",".join(map(str, a[i:p])) + "|" + ",".join(map(str, b[j:q])))
        links.append((a[p - 1], b[q - 1]))
        i, j = p, q
    return links, (len(a), len(b), len(links), hashlib.sha256(";".join(said).encode()).hexdigest())


def brute_corpus(e, texts):
    docs = [brute_document(e, t) for t in texts]
    count = Counter(x for links, _ in docs for x in links)
    most = Counter()
    for (_, b), n in count.items():
        most[b] = max(most[b], n)
    return [(n_a, n_b, n_groups, len(links), sum(count[x] == most[x[1]] for x in links), sum(count[x] for x in links), sha)
            for links, (n_a, n_b, n_groups, sha) in docs]


ODD = [None, "", " ", "▁", "a▁b", "<s> x </s>", "<|endoftext|>", "x\x00y", "  two  spaces ", "\n\nx", "😂漢é ñ", "a b c d " * 50, "<0x41>",
       "　a \xa0b\x1cc d", "x" * 3000, "same same", "same same"]


@pytest.mark.parametrize("stretch,buffer", [(alignment.STRETCH, alignment.BUFFER), (7, 500), (1, 1)])
def test_alignment_like_brute_force(encoders, stretch, buffer):
    r = random.Random(2)
    texts = ODD + ["".join(r.choice("ab c1 .,'\n😂é") for _ in range(r.randrange(200))) for _ in range(300)]
    got = alignment.align_texts(encoders, texts, stretch, buffer)
    for text, row in zip(texts, got):
        links, values = brute_document(encoders, text)
        assert row[:4] == values
        assert dict(zip(row[4].tolist(), row[5].tolist())) == Counter(a << 32 | b for a, b in links)


def test_alignment_forgets_and_slices(encoders, monkeypatch):
    text = "".join(random.Random(3).choice("ab c1 .") for _ in range(4000))
    want = brute_document(encoders, text)[1]
    monkeypatch.setattr(alignment, "SLICE", 50)
    monkeypatch.setattr(alignment, "MOST_UNITS", 10)
    assert [r[:4] for r in alignment.align_texts(encoders, [text, "", text], 3, 20)] == [want, (0, 0, 0, ""), want]


def test_lockstep_meets_where_both_end():
    a, b = np.array([1, 3, 4, 6, 7, 9]), np.array([3, 5, 6, 8, 9])
    cut_a, cut_b = alignment.lockstep(a, b, np.array([0, 4]), np.array([0, 3]), np.array([4, 6]))
    assert a[cut_a].tolist() == b[cut_b].tolist() == [3, 6, 9]


@pytest.mark.parametrize("broadcast", [True, False])
def test_alignment_of_a_corpus(spark, encoders, broadcast, monkeypatch):
    if not broadcast:
        monkeypatch.setattr(alignment, "checked_broadcast", lambda table: table)
    rows = [(i % 5 or None, t, "a", "b") for i, t in enumerate(ODD)]
    df = spark.createDataFrame(rows, "doc_id long, text string, row string, pairs string").repartition(3)
    got = [tuple(r) for r in alignment.align(df, BYTES, PIECES).collect()]
    want = [(i, *values) for (i, *_), values in zip(rows, brute_corpus(encoders, [r[1] for r in rows]))]
    assert sorted(got, key=str) == sorted(want, key=str)
    assert alignment.align(df.where("false"), BYTES, PIECES).count() == 0


def test_alignment_query(spark, encoders):
    rows = spark.read.parquet(f"{SF_SMALL}/documents.parquet").orderBy("doc_id").collect()
    got = [tuple(r) for r in queries.op13_alignment(spark, SF_SMALL).orderBy("doc_id").collect()]
    want = brute_corpus(encoders, [r["text"] for r in rows])
    assert got == [(r["doc_id"], *w) for r, w in zip(rows, want)]


def test_pair_table_names_best_partners(spark):
    found = spark.createDataFrame([([1 << 32 | 7, 2 << 32 | 7], [3, 1]), ([2 << 32 | 7, 2 << 32 | 8], [2, 1])],
                                  "pairs array<long>, counts array<long>")
    got = {(r["a"], r["b"]): (r["count"], r["best"]) for r in alignment.pair_counts(found).collect()}
    assert got == {(1, 7): (3, True), (2, 7): (3, True), (2, 8): (1, True)}
    assert alignment.pair_counts(found).where(F.col("best")).count() == 3
