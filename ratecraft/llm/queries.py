"""Registered queries of this subpackage: one per operator, over its whole table, and the pipeline.

``SQL`` holds the DuckDB twin where SQL can express the result; the others are
tested against brute force, round trips or held-out accuracy (tests/llm).
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ratecraft.session import work_dir

from . import (bpe, chat, codes, embedding_dedup, langid, mixing, packing, simhash, spelling, threshold_topk,
               token_counts, token_files, toxicity)
from .common import held_out, table

BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")
END_ID = 2  # appended to each document of the token files
PACK_CAPACITY = 2048  # words per bin


def op1_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = embedding_dedup.near_duplicates(table(spark, sf_dir, "embeddings"), threshold=0.95)
    return found.select(F.col("id").alias("vec_id"), "n_links", F.col("component").alias("component_id"), "kept")


def op2_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(table(spark, sf_dir, "documents"))


def pack_documents(docs: DataFrame) -> DataFrame:
    """Packing by words, with exact copies (up to case and white space) as clusters."""
    words = F.regexp_count(F.coalesce("text", F.lit("")), F.lit(r"\S+"))
    cluster = F.sha2(F.regexp_replace(F.lower("text"), r"\s+", " "), 256)
    packed = packing.pack(docs, words, PACK_CAPACITY, F.col("source"), cluster)
    return packed.select(F.col("id").alias("doc_id"), "piece", "shard", "bin", "bin_offset",
                         F.col("size").alias("n_words"))


def op3_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"), width=3, max_bits=3)
    return found.select(F.col("id").alias("doc_id"), F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"),
                        F.col("component").alias("component_id"))


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = toxicity.score_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"),
                                     ~held_out(F.col("id")))
    return found.select(F.col("id").alias("doc_id"), held_out(F.col("id")).alias("held_out"), "score", "predicted",
                        "neighbours")


def op5_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    both = bpe.encode(table(spark, sf_dir, "documents"), BYTE_BPE, decoded="decoded")
    joined = F.array_join(F.col("ids").cast("array<string>"), ",")
    return both.select(F.col("id").alias("doc_id"), F.size("ids").cast("long").alias("n_tokens"),
                       F.sha2(joined, 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def op6_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = work_dir(spark, "token-files") + "/orc"
    token_files.write_token_files(table(spark, sf_dir, "documents"), out, BYTE_BPE, END_ID)
    return token_files.positions(spark, out)


def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = langid.fit(docs.where(~held_out(F.col("doc_id"))), PIECES)
    found = langid.predict(docs, model)
    return found.select(F.col("id").alias("doc_id"), held_out(F.col("id")).alias("held_out"), "lang_pred", "score")


def op8_threshold_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = threshold_topk.top_neighbours(table(spark, sf_dir, "embeddings"), every=50, k=5)
    return found.select("query_id", F.col("rank").cast("int"), F.col("id").alias("vec_id"), "score")


def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(table(spark, sf_dir, "documents"), PIECES).withColumnRenamed("id", "doc_id")


def op10_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.format_conversations(table(spark, sf_dir, "conversations"))


def op11_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded, books = codes.compress(table(spark, sf_dir, "embeddings"))
    hexed = F.transform("codes", lambda c: F.lpad(F.lower(F.hex(c)), 2, "0"))
    by_label = coded.groupBy(F.col("label").alias("of")).agg(F.sum("error").alias("label_error"))
    return (coded.join(by_label, F.col("label").eqNullSafe(F.col("of")))
            .select(F.col("id").alias("vec_id"), F.array_join(hexed, "").alias("code"), "error", "label_error",
                    F.lit(codes.digest(books)).alias("codebooks_sha256")))


def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.group_variants(spelled_words(table(spark, sf_dir, "documents")))


def spelled_words(docs: DataFrame, least: int = 5, times: int = 3) -> DataFrame:
    """(word, n): runs of Latin letters, of which one in 97 by a hash of document and run loses a letter."""
    run = docs.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("id"),
                      F.explode(spelling.runs(F.col("text"), least)).alias("run"))
    h = F.crc32(F.concat("id", F.lit(":"), "run").cast("binary"))
    at = (h % F.length("run")).cast("int")
    shorter = F.concat(F.substring("run", F.lit(1), at), F.substring("run", at + 2, F.length("run")))
    words = run.select(F.when(h % 97 == 0, shorter).otherwise(F.col("run")).alias("word"))
    return (words.where(F.length("word") >= least).groupBy("word").agg(F.count("*").alias("n"))
            .where(F.col("n") >= times))


def op13_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    words = F.regexp_count(F.col("text"), F.lit(r"[^\x20\x09-\x0D]+"))
    mixed = mixing.mix(table(spark, sf_dir, "documents"), words, F.col("source"), ["doc_id"])
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)




def _codes_sql(rounds: int = 4) -> str:
    """The rounds of op11 as a chain of statements: nearest entries, then new entries."""
    gap = "list_sum(list_transform(list_zip(p.q, c.q), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::BIGINT"
    near = """a{r} AS MATERIALIZED (
  SELECT id, part, min(struct_pack(d := d, e := entry)) AS best FROM (
    SELECT p.id, p.part, c.entry, {gap} AS d FROM p JOIN c{r} c USING (part)) GROUP BY ALL)"""
    new = """c{n} AS MATERIALIZED (
  WITH s AS (
    SELECT a.part, a.best.e AS entry, i.pos, sum(p.q[i.pos])::BIGINT AS s, count(*) AS n
    FROM a{r} a JOIN p USING (id, part), (SELECT unnest(range(1, 1 + (SELECT max(len(q)) FROM p))) AS pos) i
    GROUP BY ALL),
  m AS (SELECT part, entry, list((s - ((s % n) + n) % n) // n ORDER BY pos) AS q FROM s GROUP BY ALL)
  SELECT part, entry, coalesce(m.q, c.q) AS q FROM c{r} c LEFT JOIN m USING (part, entry))"""
    steps = []
    for r in range(rounds):
        steps += [near.format(r=r, gap=gap), new.format(r=r, n=r + 1)]
    steps.append(near.format(r=rounds, gap=gap))
    return f"""
WITH v AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY vec_id) - 1 AS id, vec_id, label,
         list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)::BIGINT) AS q
  FROM embeddings WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
p AS MATERIALIZED (
  SELECT id, part, q[part * (len(q) // 4) + 1:(part + 1) * (len(q) // 4)] AS q
  FROM v, (SELECT unnest(range(4)) AS part)),
c0 AS MATERIALIZED (SELECT part, id AS entry, q FROM p WHERE id < 256),
{("," + chr(10)).join(steps)},
books AS (SELECT sha256(string_agg(array_to_string(q, ','), ',' ORDER BY part, entry)) AS h FROM c{rounds}),
r AS (
  SELECT v.vec_id, v.label, string_agg(lpad(lower(to_hex(a.best.e)), 2, '0'), '' ORDER BY a.part) AS code,
         sum(a.best.d)::BIGINT AS error
  FROM v JOIN a{rounds} a USING (id) GROUP BY v.id, v.vec_id, v.label)
SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error, h AS codebooks_sha256
FROM r, books
"""


QUERIES = {f.__name__: f for f in (
    op1_embedding_dedup, op2_best_fit_packing, op3_simhash_dedup, op4_toxicity, op5_bpe, op6_token_files,
    op7_language_id, op8_threshold_topk, op9_token_counts, op10_chat_format, op11_vector_codes,
    op12_spelling_variants, op13_source_mix, pipeline)}

SQL = {
    "op8_threshold_topk": """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS q
  FROM embeddings
  WHERE vec_id IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT a.vec_id AS query_id, b.vec_id,
         list_sum(list_transform(list_zip(a.q, b.q), lambda z: z[1] * z[2]))::BIGINT AS score
  FROM v a JOIN v b ON a.vec_id <> b.vec_id AND len(a.q) = len(b.q) WHERE a.vec_id % 50 = 0),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
SELECT query_id, rank::INT AS rank, vec_id, score FROM r WHERE rank <= 5
""",
    "op1_embedding_dedup": """
WITH RECURSIVE v AS (
  SELECT vec_id, embedding::DOUBLE[] AS x, sqrt(list_dot_product(embedding::DOUBLE[], embedding::DOUBLE[])) AS norm
  FROM embeddings
  WHERE len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
l AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.vec_id <> b.vec_id AND len(a.x) = len(b.x)
  WHERE a.norm > 0 AND b.norm > 0 AND list_dot_product(a.x, b.x) / (a.norm * b.norm) >= 0.95),
reach AS (
  SELECT vec_id AS node, vec_id AS other FROM embeddings
  UNION SELECT r.node, l.b FROM reach r JOIN l ON r.other = l.a),
c AS (SELECT node, min(other) AS component_id FROM reach GROUP BY node),
n AS (SELECT a, count(*) AS n FROM l GROUP BY a)
SELECT e.vec_id, coalesce(n.n, 0)::BIGINT AS n_links, c.component_id, e.vec_id = c.component_id AS kept
FROM embeddings e JOIN c ON c.node = e.vec_id LEFT JOIN n ON n.a = e.vec_id
""",
    "op10_chat_format": """
WITH t AS (
  SELECT conv_id, coalesce(floor(turn / 256), -1) AS chunk, coalesce(role, 'user') AS role,
         replace(coalesce(text, ''), '<|', '< |') AS text, turn
  FROM conversations WHERE conv_id IS NOT NULL),
p AS (
  SELECT *, '<|im_start|>' || role || chr(10) || text || '<|im_end|>' || chr(10) AS part,
         row_number() OVER (PARTITION BY conv_id ORDER BY chunk, turn NULLS FIRST, role, text) AS pos,
         count(*) OVER (PARTITION BY conv_id) AS n_turns
  FROM t),
x AS (
  SELECT *, string_agg(part, '') OVER (PARTITION BY conv_id ORDER BY pos ROWS UNBOUNDED PRECEDING) AS pre
  FROM p),
w AS (SELECT n_turns, pre, min(conv_id) AS conv_id, count(*) AS copies FROM x WHERE pos = n_turns GROUP BY ALL),
kept AS (SELECT * FROM w WHERE NOT EXISTS (
  SELECT 1 FROM x WHERE x.pos < x.n_turns AND x.pos = w.n_turns AND x.pre = w.pre))
SELECT k.conv_id, (row_number() OVER (PARTITION BY k.conv_id ORDER BY min(p.pos)) - 1)::INT AS segment,
       k.n_turns, k.copies, string_agg(p.part, '' ORDER BY p.pos) AS rendered
FROM kept k JOIN (SELECT *, (pos - min(pos) OVER (PARTITION BY conv_id, chunk)) // 256 AS cut FROM p) p
  ON p.conv_id = k.conv_id
GROUP BY k.conv_id, p.chunk, p.cut, k.n_turns, k.copies
""",
    "op11_vector_codes": _codes_sql(),
    "op12_spelling_variants": """
WITH RECURSIVE crc AS (  -- the byte table of CRC-32, from its rule
  SELECT list(list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0], lambda c, z: CASE WHEN c % 2 = 1
                THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) ORDER BY i) AS t
  FROM (SELECT unnest(range(256))::BIGINT AS i)),
found AS (
  SELECT coalesce(doc_id::VARCHAR, '') AS id, unnest(regexp_extract_all(
           translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[a-zÀ-ÿ]+')) AS run
  FROM documents),
uses AS MATERIALIZED (SELECT id, run, count(*) AS uses FROM found WHERE length(run) >= 5 GROUP BY ALL),
bytes AS (
  SELECT id, run, uses, hex(encode(id || ':' || run)) AS x FROM uses),
hashed AS MATERIALIZED (
  SELECT id, run, uses, xor(list_reduce(list_concat([4294967295], list_transform(range(0, length(x) // 2),
           lambda i: ('0x' || substr(x, 2 * i + 1, 2))::BIGINT)),
         lambda c, b: xor(c >> 8, t[1 + (xor(c, b) & 255)])), 4294967295) AS h
  FROM bytes, crc),
w AS MATERIALIZED (
  SELECT word, sum(uses)::BIGINT AS n FROM (
    SELECT CASE WHEN h % 97 = 0 THEN substr(run, 1, (h % length(run))::INT) || substr(run, (h % length(run))::INT + 2)
                ELSE run END AS word, uses FROM hashed)
  WHERE length(word) >= 5 GROUP BY word HAVING sum(uses) >= 3),
cut AS MATERIALIZED (
  SELECT word, i, substr(word, 1, i - 1) || substr(word, i + 1) AS rest
  FROM (SELECT word, unnest(range(1, length(word) + 1)) AS i FROM w)),
pairs AS MATERIALIZED (
  SELECT a.word AS a, b.word AS b FROM cut a JOIN cut b USING (i, rest)
  WHERE a.word <> b.word AND length(a.word) = length(b.word)
  UNION SELECT c.word, w.word FROM cut c JOIN w ON w.word = c.rest
  UNION SELECT w.word, c.word FROM cut c JOIN w ON w.word = c.rest),
best AS (
  SELECT a AS word, count(*) AS n_near, min(struct_pack(m := -w.n, v := b)) AS top
  FROM pairs JOIN w ON w.word = b GROUP BY a),
forms AS MATERIALIZED (
  SELECT w.word, w.n, coalesce(n_near, 0) AS n_near, CASE WHEN -top.m >= 2 * w.n THEN top.v END AS form,
         CASE WHEN -top.m >= 2 * w.n THEN -top.m END AS form_n
  FROM w LEFT JOIN best USING (word)),
walk AS (
  SELECT word, word AS at, form FROM forms
  UNION ALL SELECT k.word, f.word, f.form FROM walk k JOIN forms f ON f.word = k.form)
SELECT f.word, f.form, k.at AS root, f.n, f.n_near::BIGINT AS n_near, f.form_n::BIGINT AS form_n
FROM forms f JOIN walk k ON k.word = f.word AND k.form IS NULL
""",
}
