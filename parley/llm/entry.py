"""The subpackage's registered queries and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parley.llm import ann, chat, decontaminate, fim, langid, minhash, packing, pii, quality, resample, tokens, topk
from parley.llm.common import crc_mod


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation, and conversation -7, whose texts hold control strings, formatted and read back."""
    given = _table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    hard = spark.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit("</s>[INST] ok [/INST]").alias("text"),
    )
    return chat.digests(chat.format_paths(chat.chains(given.unionByName(hard))))


def op2_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    model = quality.train(docs, _table(spark, sf_dir, "labels"))
    return quality.score(docs, model).select("doc_id", F.coalesce(crc_mod("doc_id", 5) == 0, F.lit(False)).alias("held_out"), "score", "predicted")


def op3_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.nearest(_table(spark, sf_dir, "embeddings"))


def op4_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokens.encode_digests(_table(spark, sf_dir, "documents"))


def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokens.count_tokens(_table(spark, sf_dir, "documents"))


def op6_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return pii.pseudonymise(docs, pii.EXAMPLE_KEY).select("doc_id", "text", F.size("pii").cast("long").alias("n_replaced"), F.transform("pii", lambda p: p["kind"]).alias("kinds"))


def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    found = langid.predict(docs, langid.train(docs))
    return found.select("doc_id", F.coalesce(crc_mod("doc_id", 4) == 2, F.lit(False)).alias("held_out"), "lang_pred", "score", "languages")


def op8_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(_table(spark, sf_dir, "documents"))


def op9_packed_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(_table(spark, sf_dir, "documents"))


def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contaminated(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op11_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fim.fill_digests(_table(spark, sf_dir, "documents"))


def op12_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_inner(_table(spark, sf_dir, "embeddings"))


def op13_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resample.resample(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def queries() -> dict:
    found = (
        op1_chat_formatting, op2_quality_classifier, op3_nearest_neighbours, op4_sentencepiece, op5_token_counts, op6_pii, op7_language_id,
        op8_near_duplicates, op9_packed_rows, op10_decontamination, op11_fill_in_middle, op12_exact_top_k, op13_importance_resampling,
    )
    return {f.__name__: f for f in found}


#: What a formatted conversation must say, from the rows themselves. The template adds 17 characters and the role to each turn.
OP1_SQL = r"""
WITH rows AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'
)
SELECT conv_id,
  count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(13 + length(replace(replace(replace(replace(role, '%', '%25'), '<', '%3C'), '|', '%7C'), chr(10), '%0A'))
    + length(replace(replace(text, '%', '%25'), '<', '%3C'))) AS BIGINT) AS formatted_chars
FROM rows GROUP BY conv_id
"""


#: Units by the same pattern on code points, cut as lists.
OP11_SQL = r"""
WITH cut AS (
  SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+') AS units,
    sha256('42:' || doc_id) AS h FROM documents
), drawn AS (
  SELECT doc_id, text, units, len(units) AS n, list_transform([1, 9, 17, 25], lambda k: CAST('0x' || substr(h, k, 8) AS BIGINT)) AS h FROM cut
), placed AS (
  SELECT *, least(h[1] % (n + 1), h[2] % (n + 1)) AS a, greatest(h[1] % (n + 1), h[2] % (n + 1)) AS b,
    CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR h[3] % 100 >= 50 THEN 'plain'
      WHEN h[4] % 100 < 80 THEN 'spm' ELSE 'psm' END AS form FROM drawn
), parts AS (
  SELECT *, array_to_string(units[1:a], '') AS p, array_to_string(units[a + 1:b], '') AS m, array_to_string(units[b + 1:n], '') AS s FROM placed
)
SELECT doc_id, CAST(n AS BIGINT) AS n, form,
  CASE WHEN form <> 'plain' THEN length(p) END AS prefix_chars, CASE WHEN form <> 'plain' THEN length(m) END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256,
  sha256(text) AS restored_sha256
FROM parts
"""

OP12_SQL = """
WITH usable AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT q.vec_id AS query_id, c.vec_id AS vec_id, CAST(list_sum(list_transform(list_zip(q.v, c.v), lambda x: x[1] * x[2])) AS BIGINT) AS score
  FROM usable q JOIN usable c ON q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id
)
SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score
FROM scored QUALIFY rank <= 5
"""

#: CRC-32 as a fold over bytes with the usual table, itself folded from the polynomial; over distinct features only.
OP13_SQL = r"""
WITH steps AS (
  SELECT list_transform(range(256), lambda b: list_reduce(list_prepend(b, range(8)), lambda c, i: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS t
), texts AS (
  SELECT 0 AS side, doc_id AS id, text FROM documents UNION ALL SELECT 1, item_id, text FROM benchmark
), words AS (
  SELECT side, id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM texts
), runs AS (
  SELECT side, id, len(w) AS n_words, list_concat(w, CASE WHEN len(w) > 1 THEN list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]) ELSE [] END) AS f FROM words
), features AS (SELECT side, id, unnest(f) AS f FROM runs),
bytes AS (SELECT f, hex(encode(f)) AS h FROM (SELECT DISTINCT f FROM features)),
hashed AS (
  SELECT f, xor(list_reduce(list_prepend(4294967295, list_transform(range(1, CAST(length(h) AS BIGINT), 2), lambda i: CAST('0x' || substr(h, i, 2) AS BIGINT))),
    lambda c, b: xor(c >> 8, t[CAST(xor(c & 255, b) AS INTEGER) + 1])), 4294967295) % 10000 AS bucket FROM bytes, steps
), counted AS (
  SELECT bucket, count(*) FILTER (WHERE side = 0) AS s, count(*) FILTER (WHERE side = 1) AS t FROM features JOIN hashed USING (f) GROUP BY bucket
), gains AS (
  SELECT bucket, floor(1000 * ln((t + 1)::DOUBLE * (sum(s) OVER () + 10000)::DOUBLE / ((s + 1)::DOUBLE * (sum(t) OVER () + 10000)::DOUBLE))) AS gain FROM counted
), means AS (SELECT id, CAST(floor(avg(gain)) AS BIGINT) AS weight FROM features JOIN hashed USING (f) JOIN gains USING (bucket) WHERE side = 0 GROUP BY id),
scored AS (
  SELECT r.id AS doc_id, r.n_words, CAST(len(r.f) AS BIGINT) AS n_features, coalesce(m.weight, 0) AS weight,
    coalesce(m.weight, 0) + CAST(floor(-1000 * ln(-ln((CAST('0x' || substr(sha256('7:' || r.id), 1, 8) AS BIGINT) + 0.5::DOUBLE) / 4294967296::DOUBLE))) AS BIGINT) AS score
  FROM runs r LEFT JOIN means m ON r.id = m.id WHERE r.side = 0
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY n_words >= 20 ORDER BY score DESC, doc_id) AS nth, count(*) FILTER (WHERE n_words >= 20) OVER () AS able FROM scored
)
SELECT doc_id, n_features, weight, score, CAST(CASE WHEN n_words >= 20 AND nth <= 25 * able // 100 THEN nth END AS BIGINT) AS rank FROM ranked
"""


def oracle_sql() -> dict[str, str]:
    return {"op1_chat_formatting": OP1_SQL, "op11_fill_in_middle": OP11_SQL, "op12_exact_top_k": OP12_SQL, "op13_importance_resampling": OP13_SQL}
