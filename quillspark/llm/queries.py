"""The registered queries ``opN_*`` and ``pipeline``'s helpers, with their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillspark.llm import (alignment, chat, clustering, decontaminate, embeddings, extract_html, language, mixing, pii,
                            sharding, simhash, toxicity, transducer)
from quillspark.session import read_table


def op1_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    found = extract_html.extract(read_table(spark, sf_dir, "pages").select("page_id", "url", "html"))
    return found.select("page_id", "url", "text", F.char_length("text").cast("long").alias("n_chars"))


#: Text of both turns of the added conversation -7: it imitates other templates' markers.
MARKER_TEXT = "\\### Assistant: </turn> ok"


def op2_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations and conversation -7, formatted and read back from the formatted text."""
    cols = ["conv_id", "turn", "role", "text"]
    added = spark.range(2).select(F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"),
                                  F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
                                  F.lit(MARKER_TEXT).alias("text"))
    rows = read_table(spark, sf_dir, "conversations").select(cols).unionByName(added)
    out = chat.format_chats(rows.select("conv_id", "turn", "role", chat.text_parts(F.col("text")).alias("content")))
    turns = chat.read_turns(F.col("formatted"))
    out = out.select("conv_id", "formatted", turns.alias("turns"), chat.read_loss(F.col("formatted"), F.col("loss")).alias("loss"))
    said = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return out.select("conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(said.cast("binary"), 256).alias("turns_sha256"),
                      F.char_length("loss").cast("long").alias("loss_chars"), F.sha2(F.col("loss").cast("binary"), 256).alias("loss_sha256"),
                      F.char_length("formatted").cast("long").alias("formatted_chars"))


def op3_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document; the fold of remainder 1 is held out of training."""
    docs = read_table(spark, sf_dir, "documents")
    held_out = language.fold("doc_id", 3) == 1
    found = language.identify(docs.select("doc_id", "text"), docs.where(~held_out))
    return found.select("doc_id", held_out.alias("held_out"), F.col("language.lang").alias("lang_pred"),
                        "language.score")


def op4_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and near-duplicate component of every document."""
    found = simhash.near_duplicates(read_table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op5_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in 40 shards; law ``rows``."""
    docs = read_table(spark, sf_dir, "documents")
    text = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    rows = docs.select("doc_id", "source", (F.octet_length(text) + 16).cast("long").alias("size"),
                       F.crc32(text).alias("text_crc32"))
    out = sharding.stratified_shards(rows, 40)
    return out.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
                      F.lit(None).cast("int").alias("grown_shard"))


def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of every document that lie inside a benchmark passage."""
    found = decontaminate.contamination(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"),
                        (F.col("n_hit") > 0).alias("contaminated"))


def op7_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data in every document: counts and a digest of the base spans, all spans as text."""
    found = pii.find_pii(read_table(spark, sf_dir, "documents").select("doc_id", "text"))
    base = F.filter("pii", lambda s: s["base"])
    named = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
    count = lambda kind: F.size(F.filter(base, lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    return found.select("doc_id", *[count(k) for k in ("email", "ip", "card", "phone")],
                        F.sha2(named(base).cast("binary"), 256).alias("base_sha256"), named(F.col("pii")).alias("spans"))


def op8_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links and component of every vector."""
    return embeddings.near_duplicates(read_table(spark, sf_dir, "embeddings"))


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents mixed to the 5-2-1 weights; words taken per document."""
    docs = read_table(spark, sf_dir, "documents")
    return mixing.mix(docs, carry=("doc_id",)).select(
        "doc_id", "mix.size", "mix.source_size", "mix.target", "mix.taken")


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document; the fold of remainder 0 is held out of training."""
    docs = read_table(spark, sf_dir, "documents")
    held_out = language.fold("doc_id", 5) == 0
    labels = read_table(spark, sf_dir, "labels").where(~held_out).select("doc_id", "toxic")
    labelled = toxicity.sampled(labels).join(docs.select("doc_id", "text"), "doc_id")
    found = toxicity.score(docs.select("doc_id", "text"), toxicity.train(labelled))
    return found.select("doc_id", held_out.alias("held_out"), F.col("toxicity").alias("score"),
                        F.when(F.col("toxicity") >= 0.5, 1).otherwise(0).alias("predicted"))


def tokenizer(name: str) -> str:
    """Place of a public tokenizer file."""
    import public_tokenizers
    return str(public_tokenizers.path(name))


def op11_clustering(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cluster of every vector: 40 centroids, 5 rounds."""
    return clustering.cluster(read_table(spark, sf_dir, "embeddings"), k=40, rounds=5)


def op12_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of every document, and whether they are more than 2048."""
    rows = read_table(spark, sf_dir, "documents").select(
        "doc_id", F.octet_length(F.coalesce(F.col("text"), F.lit(""))).cast("long").alias("n_bytes"), "text")
    return transducer.token_counts(rows, tokenizer("word_bpe_49k.json"), 2048).select(
        "doc_id", "n_bytes", "n_tokens", "over_limit")


def op13_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links between the tokens of two tokenizers in every document."""
    return alignment.align(read_table(spark, sf_dir, "documents"), tokenizer("byte_bpe_50k.json"), tokenizer("piece_bpe_32k.model"))


def _op11_sql(k: int = 40, rounds: int = 5) -> str:
    """Each round's assignment and centroids as one step of a chain."""
    steps = [f"""
kept AS MATERIALIZED (
  SELECT row_number() OVER () AS r, vec_id, [floor(256 * x::DOUBLE)::BIGINT FOR x IN embedding] AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(embedding) = 64 AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
c0 AS MATERIALIZED (
  SELECT n - 1 AS c, v FROM (SELECT row_number() OVER (ORDER BY sha256('2:' || vec_id), v) AS n, v FROM kept) WHERE n <= {k})"""]
    for i in range(rounds + 1):
        steps.append(f"""
a{i} AS MATERIALIZED (
  SELECT r, any_value(vec_id) AS vec_id, any_value(x) AS v, min(d * {k} + c) AS best
  FROM (SELECT r, vec_id, kept.v AS x, c, (list_dot_product(kept.v::DOUBLE[], kept.v::DOUBLE[])
          - 2 * list_dot_product(kept.v::DOUBLE[], c{i}.v::DOUBLE[]) + list_dot_product(c{i}.v::DOUBLE[], c{i}.v::DOUBLE[]))::BIGINT AS d
        FROM kept, c{i}) GROUP BY r)""")
        if i < rounds:
            steps.append(f"""
c{i + 1} AS MATERIALIZED (
  SELECT c, coalesce(moved, v) AS v FROM c{i} LEFT JOIN (
    SELECT c, list(m ORDER BY j) AS moved FROM (
      SELECT c, j, ((s - ((s % n) + n) % n) / n)::BIGINT AS m FROM (
        SELECT best % {k} AS c, j, sum(v[j]) AS s, count(*) AS n FROM a{i}, range(1, 65) t(j) GROUP BY ALL)) GROUP BY c) USING (c))""")
    return "WITH" + ",".join(steps) + f"""
SELECT vec_id, (best % {k})::INT AS cluster, best // {k} AS distance,
       (sum(best // {k}) OVER (PARTITION BY best % {k}))::BIGINT AS cluster_inertia, (sum(best // {k}) OVER ())::BIGINT AS inertia,
       sha256(array_to_string(c{rounds}.v, ',')) AS centroid_sha256
FROM a{rounds} JOIN c{rounds} ON c = best % {k}"""


OP9_SQL = r"""
WITH RECURSIVE sized AS (
  SELECT doc_id, coalesce(source, chr(1114111)) AS src, md5('23:' || doc_id) AS k,
         coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS size
  FROM documents),
per AS (SELECT src, sum(size)::BIGINT AS source_size FROM sized GROUP BY src),
weighed AS (
  SELECT src, source_size, 2 * source_size AS cap,
         [5, 2, 1][1 + (row_number() OVER (ORDER BY src) - 1) % 3] AS w FROM per),
share AS (  -- reshare by weight until none is above its cap
  SELECT 0 AS round, src, source_size, cap, w, false AS shut,
         w * (sum(source_size) OVER () * 1.5::DOUBLE) / sum(w) OVER () AS target
  FROM weighed
  UNION ALL
  SELECT round + 1, src, source_size, cap, w, shut OR target >= cap,
         CASE WHEN shut OR target >= cap THEN cap::DOUBLE
              ELSE w * (sum(source_size) OVER () * 1.5::DOUBLE - sum(CASE WHEN shut OR target >= cap THEN cap ELSE 0 END) OVER ())
                   / sum(CASE WHEN shut OR target >= cap THEN 0 ELSE w END) OVER () END
  FROM share WHERE round < (SELECT count(*) FROM per)),
final AS (SELECT * FROM share WHERE round = (SELECT count(*) FROM per)),
placed AS (
  SELECT s.*, f.source_size, f.target, floor(f.target + 0.5)::BIGINT AS budget,
         coalesce(sum(size) OVER (PARTITION BY s.src ORDER BY k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS before
  FROM sized s JOIN final f USING (src))
SELECT doc_id, size::BIGINT AS size, source_size, target,
       (CASE WHEN source_size = 0 THEN 0 ELSE (budget // source_size) * size
             + least(greatest(budget % source_size - before, 0), size) END)::BIGINT AS taken
FROM placed
"""

OP2_SQL = r"""
WITH said AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
  UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok')
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn)) AS turns_sha256,
       coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn) FILTER (role = 'assistant'), '')) AS loss_sha256,
       sum(length('<|turn|><|body|><|end|>') + length(regexp_replace(role, '<(\\*)\|', '<\\\1|', 'g'))
           + length(regexp_replace(text, '<(\\*)\|', '<\\\1|', 'g')))::BIGINT AS formatted_chars
FROM said GROUP BY conv_id
"""

OP8_SQL = """
WITH RECURSIVE valid AS (
  SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0
    AND list_dot_product(embedding::DOUBLE[], embedding::DOUBLE[]) > 0),
link AS (
  SELECT a.vec_id AS u, b.vec_id AS v FROM valid a JOIN valid b ON a.vec_id <> b.vec_id
  WHERE list_dot_product(a.e, b.e) / sqrt(list_dot_product(a.e, a.e) * list_dot_product(b.e, b.e)) >= 0.95),
reach AS (SELECT vec_id AS u, vec_id AS v FROM embeddings UNION SELECT r.u, l.v FROM reach r JOIN link l ON r.v = l.u),
part AS (SELECT u, min(v) AS component_id FROM reach GROUP BY u),
n AS (SELECT u, count(*) AS n FROM link GROUP BY u)
SELECT e.vec_id, coalesce(n.n, 0)::BIGINT AS n_links, component_id, e.vec_id = component_id AS kept
FROM embeddings e JOIN part ON part.u = e.vec_id LEFT JOIN n ON n.u = e.vec_id
"""

OP6_SQL = r"""
WITH doc AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents),
item AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                     '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark),
wins AS (
  SELECT item_id, least(len(w), 10) AS n, array_to_string(w[i:i + 9], ' ') AS k
  FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i FROM item WHERE len(w) > 0)),
lens AS (SELECT DISTINCT n FROM wins),
grams AS (
  SELECT doc_id, i, n, array_to_string(w[i:i + n - 1], ' ') AS k
  FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM doc, lens WHERE len(w) >= n)),
hits AS (SELECT DISTINCT doc_id, i, g.n, item_id FROM grams g JOIN wins USING (n, k)),
covered AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM hits) GROUP BY doc_id),
named AS (SELECT doc_id, count(*) AS n_items, string_agg(id, ',' ORDER BY id) AS ids
          FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS id FROM hits) GROUP BY doc_id)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM doc LEFT JOIN covered USING (doc_id) LEFT JOIN named USING (doc_id)
"""

QUERIES = {"op1_html": op1_html, "op2_chat": op2_chat, "op3_language": op3_language, "op4_simhash": op4_simhash,
           "op5_sharding": op5_sharding, "op6_decontamination": op6_decontamination, "op7_pii": op7_pii,
           "op8_embeddings": op8_embeddings, "op9_mixing": op9_mixing, "op10_toxicity": op10_toxicity,
           "op11_clustering": op11_clustering, "op12_token_counts": op12_token_counts, "op13_alignment": op13_alignment}
ORACLE = {"op2_chat": OP2_SQL, "op6_decontamination": OP6_SQL, "op8_embeddings": OP8_SQL, "op9_mixing": OP9_SQL,
          "op11_clustering": _op11_sql()}
