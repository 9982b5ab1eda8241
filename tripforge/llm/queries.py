"""The registered query of each operator, over its whole table."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripforge.llm import ann, bpe, chat, importance, jaccard, language, lm, middle, mixing, secret_scan, sentencepieces, toxicity, voronoi
from tripforge.llm.common import crc_mod, table


def op1_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = crc_mod("doc_id", 7) == 2
    model, words = lm.train(docs.filter(~held_out).select("text"))
    return lm.score(docs.select("doc_id", "text", held_out.alias("held_out")), model, words)


def op2_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    hard = spark.sql("""SELECT cast(-1 AS bigint) conv_id, cast(id AS bigint) turn,
        CASE id WHEN 0 THEN 'user' ELSE 'assistant' END role, '</s>[INST] ok [/INST]' text FROM range(2)""")
    return chat.digests(rows.unionByName(hard))


def op3_mixing_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def op4_posting_list_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.search(table(spark, sf_dir, "embeddings"))


def op5_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digests(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = crc_mod("doc_id", 3) == 1
    model = language.fit(docs.filter(~held_out))
    return language.predict(docs.select("doc_id", "text", held_out.alias("held_out")), model).select("doc_id", "held_out", "lang_pred", "score")


def op7_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return secret_scan.digests(docs, secret_scan.fit(docs))


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = crc_mod("doc_id", 3) == 1
    model = toxicity.fit(docs.filter(~held_out), table(spark, sf_dir, "labels"))
    scored = toxicity.score(docs.select("doc_id", "text", held_out.alias("held_out")), model)
    return scored.select("doc_id", "held_out", "score", F.when(F.col("score") >= toxicity.PREDICT_FROM, 1).otherwise(0).alias("predicted"))


def op9_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.link_documents(table(spark, sf_dir, "documents"), words=4, percent=85)


def op10_voronoi_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return voronoi.search(table(spark, sf_dir, "embeddings"))


def op11_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    drawn = importance.resample(docs, table(spark, sf_dir, "benchmark"), keep_text=False)
    return drawn.select("doc_id", "n_features", "weight", "score", "rank")


def op12_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = middle.transform(table(spark, sf_dir, "documents").select("doc_id", "text"))
    d = middle.restore(d.drop("text"))
    return d.select("doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"),
                    F.sha2("restored", 256).alias("restored_sha256"))


def op13_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sentencepieces.digests(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


QUERIES = {f.__name__: f for f in (
    op1_lm_scoring, op2_chat_formatting, op3_mixing_sources, op4_posting_list_ann, op5_byte_bpe,
    op6_language_id, op7_secret_scan, op8_toxicity, op9_ngram_jaccard, op10_voronoi_topk,
    op11_importance_resampling, op12_fill_in_middle, op13_sentencepiece)}

#: crc32 of UTF-8 text byte by byte; the table of 256 remainders is made by its rule.
_CRC32_TABLE = """(SELECT list(c ORDER BY i) FROM (SELECT i, list_reduce([i::UBIGINT, 1, 2, 3, 4, 5, 6, 7, 8],
    lambda c, k: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384::UBIGINT) ELSE c // 2 END) AS c FROM range(256) r(i)))"""

OP11_SQL = rf"""
WITH words AS (SELECT doc_id, unnest(w) AS word FROM (SELECT doc_id, regexp_extract_all(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[0-9a-z\x{{80}}-\x{{10FFFF}}]+') AS w FROM documents)),
target AS (SELECT unnest(regexp_extract_all(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[0-9a-z\x{{80}}-\x{{10FFFF}}]+')) AS word FROM benchmark),
crc AS (SELECT {_CRC32_TABLE} AS t),
vocabulary AS (SELECT word, hex(encode(word)) AS h FROM (SELECT word FROM words UNION SELECT word FROM target)),
bucket_of AS (SELECT word, xor(list_reduce(list_concat([4294967295::UBIGINT], list_transform(range(1, length(h) + 1, 2),
        lambda i: ((strpos('0123456789ABCDEF', h[i]) - 1) * 16 + strpos('0123456789ABCDEF', h[i + 1]) - 1)::UBIGINT)),
        lambda c, b: xor(c // 256, t[(xor(c, b) % 256 + 1)::BIGINT])), 4294967295::UBIGINT) % 10000 AS bucket FROM vocabulary, crc),
source_count AS (SELECT bucket, count(*) AS s FROM words JOIN bucket_of USING (word) GROUP BY bucket),
target_count AS (SELECT bucket, count(*) AS t FROM target JOIN bucket_of USING (word) GROUP BY bucket),
totals AS (SELECT (SELECT count(*) FROM words) AS s_all, (SELECT count(*) FROM target) AS t_all),
gain AS (SELECT bucket, floor(1000 * ln(((coalesce(t, 0) + 1) * (s_all + 10000))::DOUBLE / ((s + 1) * (t_all + 10000))::DOUBLE))::BIGINT AS g
    FROM source_count LEFT JOIN target_count USING (bucket), totals),
sums AS (SELECT doc_id, count(*) AS n, sum(g)::BIGINT AS g FROM words JOIN bucket_of USING (word) JOIN gain USING (bucket) GROUP BY doc_id),
weighed AS (SELECT d.doc_id, coalesce(n, 0) AS n_features, CASE WHEN n IS NULL THEN 0 ELSE (g - ((g % n) + n) % n) // n END AS weight,
    ('0x' || left(sha256('2024:' || d.doc_id), 8))::BIGINT AS h FROM documents d LEFT JOIN sums USING (doc_id)),
scored AS (SELECT doc_id, n_features, weight, weight + floor(-1000 * ln(-ln((h + 0.5::DOUBLE) / 4294967296::DOUBLE)))::BIGINT AS score FROM weighed),
ranked AS (SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS r FROM scored WHERE n_features >= 20)
SELECT s.doc_id, s.n_features, s.weight, s.score,
    CASE WHEN r <= (SELECT count(*) FROM ranked) * 10 // 100 THEN r END AS rank
FROM scored s LEFT JOIN ranked USING (doc_id)
"""

OP12_SQL = r"""
WITH cut AS (SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+') AS u,
        sha256('42:' || doc_id) AS h FROM documents),
drawn AS (SELECT *, len(u) AS n, ('0x' || h[1:8])::BIGINT % (len(u) + 1) AS a, ('0x' || h[9:16])::BIGINT % (len(u) + 1) AS b,
        CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR ('0x' || h[17:24])::BIGINT % 100 >= 50 THEN 'plain'
             WHEN ('0x' || h[25:32])::BIGINT % 100 < 80 THEN 'spm' ELSE 'psm' END AS form FROM cut),
parts AS (SELECT *, array_to_string(u[1:least(a, b)], '') AS p, array_to_string(u[least(a, b) + 1:greatest(a, b)], '') AS m,
        array_to_string(u[greatest(a, b) + 1:], '') AS s FROM drawn)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(p) END AS prefix_chars, CASE WHEN form <> 'plain' THEN length(m) END AS middle_chars,
    sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256,
    sha256(text) AS restored_sha256
FROM parts
"""

OP10_SQL = """
WITH one AS (SELECT vec_id, min(embedding) AS embedding FROM embeddings WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 GROUP BY vec_id),
whole AS (SELECT vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)::BIGINT) AS v FROM one),
scores AS (SELECT q.vec_id AS query_id, d.vec_id, list_sum(list_transform(list_zip(q.v, d.v), lambda z: z[1] * z[2]))::BIGINT AS score
    FROM whole q, whole d WHERE q.vec_id % 20 = 0 AND d.vec_id <> q.vec_id)
SELECT query_id, (row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id))::INTEGER AS rank, vec_id, score FROM scores
QUALIFY row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) <= 20
"""

OP2_SQL = r"""
WITH turns AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    UNION ALL VALUES (-1, 0, 'user', '</s>[INST] ok [/INST]'), (-1, 1, 'assistant', '</s>[INST] ok [/INST]')),
sized AS (SELECT *, length(text) + len(regexp_extract_all(text, '<\\*(?:/?s>|</?SYS>>)')) + len(regexp_extract_all(text, '\[\\*/?INST\]')) AS n FROM turns)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
    coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0)::BIGINT AS loss_chars,
    sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
    sum(CASE WHEN role = 'assistant' THEN length('<s>') + n + length('</s>') ELSE length('<s>[INST]') + length(role) + 1 + n + length('[/INST]') END)::BIGINT AS formatted_chars
FROM sized GROUP BY conv_id
"""

OP9_SQL = r"""
WITH RECURSIVE cut AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x20\x09-\x0D]+') AS w FROM documents),
sets AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) < 4 THEN list_filter([array_to_string(w, ' ')], lambda x: x <> '')
        ELSE list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i:i + 3], ' ')) END) AS g FROM cut),
sizes AS (SELECT doc_id, count(*) AS n FROM sets GROUP BY doc_id),
shared AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS k FROM sets a JOIN sets b USING (g) WHERE a.doc_id <> b.doc_id GROUP BY ALL),
links AS (SELECT x, y FROM shared JOIN sizes p ON p.doc_id = x JOIN sizes q ON q.doc_id = y WHERE 100 * k >= 85 * (p.n + q.n - k)),
reach AS (SELECT doc_id, doc_id AS other FROM documents UNION SELECT reach.doc_id, links.y FROM reach JOIN links ON reach.other = links.x)
SELECT doc_id, coalesce(any_value(n), 0) AS n_shingles, min(other) AS component_id FROM reach LEFT JOIN sizes USING (doc_id) GROUP BY doc_id
"""

ORACLE_SQL: dict[str, str] = {
    "op2_chat_formatting": OP2_SQL, "op9_ngram_jaccard": OP9_SQL, "op10_voronoi_topk": OP10_SQL,
    "op11_importance_resampling": OP11_SQL, "op12_fill_in_middle": OP12_SQL}
