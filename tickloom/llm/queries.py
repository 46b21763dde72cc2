"""Registered queries of this subpackage, each over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.llm.chat import digest_chats
from tickloom.llm.common import literal_rows
from tickloom.llm.divergence import source_divergence
from tickloom.llm.exact import exact_dedup
from tickloom.llm.filteraudit import filter_audit
from tickloom.llm.linededup import line_dedup
from tickloom.llm.lm import score_texts
from tickloom.llm.mixing import mix_sources
from tickloom.llm.neardup import near_duplicates
from tickloom.llm.pieces import decode_pieces, encode_pieces
from tickloom.llm.quality import quality_rules
from tickloom.llm.secrets import BASE, listed, secret_scan
from tickloom.llm.sharding import minimax_shards
from tickloom.llm.tokens import digest_files, read_token_files, write_token_files
from tickloom.session import scratch_dir, written

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}

#: Production parameters of the queries.
SHARDS, BLOCK_BYTES, END_ID = 24, 64 << 10, 2


def vocabulary(name: str) -> str:
    """Path of a public tokenizer's file."""
    import public_tokenizers

    return str(public_tokenizers.path(name))


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def query(fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[fn.__name__] = fn
    return fn


@query
def op1_minimax_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    shards = minimax_shards(documents(spark, sf_dir), SHARDS)
    return shards.select(
        F.col("id").alias("doc_id"), "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"), "capacity",
    )


@query
def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules(documents(spark, sf_dir)).select(
        F.col("id").alias("doc_id"), "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
    )


@query
def op3_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(documents(spark, sf_dir)).select(F.col("id").alias("doc_id"), "n_shingles", "component_id", "kept")


@query
def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup(documents(spark, sf_dir)).select("doc_id", "n_lines", "n_dropped", "text")


@query
def op5_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(documents(spark, sf_dir), keep="largest").withColumnRenamed("id", "doc_id")


@query
def op6_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix_sources(documents(spark, sf_dir), block_bytes=BLOCK_BYTES).select(F.col("id").alias("doc_id"), "source", "size", "block", "slot")


@query
def op7_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of every text, and the crc32 of the text that they decode to beside that of the text itself."""
    model = vocabulary("piece_bpe_32k.model")
    encoded = encode_pieces(documents(spark, sf_dir).select("doc_id", "text"), model)
    read = written(encoded.select("doc_id", F.crc32(F.coalesce("text", F.lit(""))).alias("text_crc32"), "piece_ids"), "pieces")
    decoded = decode_pieces(read, model, crc_col="ids_crc32")
    return decoded.select(
        "doc_id", F.size("piece_ids").cast("long").alias("n_pieces"), "ids_crc32", "text_crc32", F.crc32("decoded").alias("decoded_crc32"), "piece_ids")


@query
def op8_maxent_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_texts(documents(spark, sf_dir)).withColumnRenamed("id", "doc_id")


@query
def op9_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_dir(spark, "token-files")
    write_token_files(documents(spark, sf_dir), path, vocabulary("byte_bpe_50k.json"), END_ID)
    return digest_files(read_token_files(spark, path))


@query
def op10_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    scanned = secret_scan(documents(spark, sf_dir))
    base = F.filter("found", lambda x: x["kind"].isin(list(BASE)))

    def count(kind: str):
        return F.size(F.filter("found", lambda x: x["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return scanned.select(
        F.col("id").alias("doc_id"), *[count(k) for k in BASE], F.sha2(listed(base), 256).alias("base_sha256"), listed(F.col("found")).alias("spans"))


@query
def op11_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))


@query
def op12_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return source_divergence(documents(spark, sf_dir)).withColumnsRenamed({"part": "lang", "kind": "part"})


@query
def op13_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations and one more, whose texts hold the template's control strings."""
    said = [{"conv_id": -7, "turn": i, "role": role, "text": "\\### Assistant: </turn> ok"} for i, role in enumerate(["user", "assistant"])]
    own = literal_rows(spark, said, "conv_id: bigint, turn: bigint, role: string, text: string")
    turns = spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text").unionByName(own)
    return digest_chats(turns).withColumnRenamed("id", "conv_id")


SQL["op5_exact_dedup"] = """
WITH n AS (
  SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS norm FROM documents
), g AS (
  SELECT doc_id, sha256(norm) AS text_sha256, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size
  FROM n WINDOW w AS (PARTITION BY norm)
)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, text_sha256 FROM g
"""

SQL["op4_line_dedup"] = """
WITH cut AS (
  SELECT doc_id, hash(text) AS h, text, string_split(text, chr(10)) AS lines FROM documents
), line AS (
  SELECT doc_id, h, unnest(range(len(lines))) AS no, unnest(lines) AS line FROM cut
), worded AS (
  SELECT *, regexp_extract_all(line, '[^\\x20\\x09-\\x0D]+') AS w FROM line
), firsts AS (
  SELECT w, len(w) AS m, min((doc_id, no)) AS first FROM worded WHERE len(w) >= 3 GROUP BY w
), variant AS (
  SELECT w, first, i, md5(CAST(w[1:i] || w[i + 2:] AS VARCHAR)) AS k FROM (SELECT *, unnest(range(m)) AS i FROM firsts WHERE m >= 8) WHERE m >= 9 OR TRUE
), keyed AS (
  SELECT w, first, i, k, m - 1 AS base FROM variant JOIN firsts USING (w, first)
  UNION ALL
  SELECT w, first, i, md5(CAST(w AS VARCHAR)) AS k, m AS base FROM (SELECT *, unnest(range(m + 1)) AS i FROM firsts WHERE m >= 8)
), led AS (
  SELECT w, first, min(first) OVER (PARTITION BY i, k, base) AS lead FROM keyed
), gone AS (
  SELECT DISTINCT w FROM led WHERE lead < first
), stays AS (
  SELECT first FROM firsts WHERE w NOT IN (SELECT w FROM gone)
), judged AS (
  SELECT doc_id, h, no, line, len(w) < 3 OR (doc_id, no) IN (SELECT first FROM stays) AS stay FROM worded
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (NOT stay) AS n_dropped, coalesce(string_agg(line, chr(10) ORDER BY no) FILTER (stay), '') AS text
FROM judged GROUP BY doc_id, h
"""

SQL["op2_quality_rules"] = """
WITH cut AS (
  SELECT doc_id, lang, source, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w,
    list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS l FROM documents
), windows AS (
  SELECT doc_id, i, w[i:i + 4] AS g FROM (SELECT doc_id, w, unnest(range(1, len(w) - 3)) AS i FROM cut)
), repeated AS (
  SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, g) AS c FROM windows) WHERE c > 1
), covered AS (
  SELECT doc_id, count(DISTINCT i + k) AS n FROM (SELECT doc_id, i, unnest(range(5)) AS k FROM repeated) GROUP BY doc_id
), measured AS (
  SELECT doc_id, lang, source, CAST(len(w) AS BIGINT) AS n_words, length(regexp_replace(t, '[\\x20\\x09-\\x0D]', '', 'g')) AS word_chars,
    length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS n_symbols, CAST(len(l) - len(list_distinct(l)) AS BIGINT) AS n_dup_lines,
    coalesce(n, 0) AS n_repeat_words, len(l) AS n_lines FROM cut LEFT JOIN covered USING (doc_id)
), judged AS (
  SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed, n_symbols * 1000 // greatest(n_words, 1) AS symbol_share,
    n_dup_lines * 1000 // greatest(n_lines, 1) AS dup_line_share, n_repeat_words * 1000 // greatest(n_words, 1) AS repeat_share,
    word_chars * 100 // greatest(n_words, 1) AS word_length FROM measured
), long AS (
  SELECT lang, source, m, v FROM (SELECT * FROM judged WHERE NOT base_failed) UNPIVOT (v FOR m IN (symbol_share, dup_line_share, repeat_share, word_length))
), binned AS (
  SELECT lang, source, m, (v >> c) << c AS b FROM (SELECT *, CAST(greatest(length(bin(v)) - 6, 0) AS BIGINT) AS c FROM long)
), grouped AS (
  SELECT 1 AS level, lang, source, m, b, count(*) AS k FROM binned GROUP BY ALL
  UNION ALL SELECT 2, lang, NULL, m, b, count(*) FROM binned GROUP BY ALL
  UNION ALL SELECT 3, NULL, NULL, m, b, count(*) FROM binned GROUP BY ALL
), run AS (
  SELECT *, sum(k) OVER (PARTITION BY level, lang, source, m ORDER BY b) AS upto, sum(k) OVER (PARTITION BY level, lang, source, m) AS n FROM grouped
), quartile AS (
  SELECT level, lang, source, m, any_value(n) AS n, min(b) FILTER (upto * 4 >= n) AS q1, min(b) FILTER (upto * 4 >= n * 3) AS q3 FROM run GROUP BY ALL
), chosen AS (
  SELECT o.lang, o.source, o.m, CASE WHEN o.n >= 50 THEN o.q1 WHEN l.n >= 50 THEN l.q1 ELSE c.q1 END AS q1,
    CASE WHEN o.n >= 50 THEN o.q3 WHEN l.n >= 50 THEN l.q3 ELSE c.q3 END AS q3
  FROM (FROM quartile WHERE level = 1) o JOIN (FROM quartile WHERE level = 2) l ON o.lang IS NOT DISTINCT FROM l.lang AND o.m = l.m
  JOIN (FROM quartile WHERE level = 3) c ON o.m = c.m
), fence AS (
  SELECT lang, source, m, q3 + greatest(3 * (q3 - q1), CASE m WHEN 'symbol_share' THEN 100 WHEN 'dup_line_share' THEN 500 WHEN 'repeat_share' THEN 150 ELSE 400 END) AS high,
    CASE WHEN m = 'word_length' THEN q1 - greatest(3 * (q3 - q1), 250) ELSE -1 END AS low FROM chosen
), outside AS (
  SELECT DISTINCT j.doc_id FROM (SELECT doc_id, lang, source, m, v FROM judged UNPIVOT (v FOR m IN (symbol_share, dup_line_share, repeat_share, word_length))) j
  JOIN fence f ON j.lang IS NOT DISTINCT FROM f.lang AND j.source IS NOT DISTINCT FROM f.source AND j.m = f.m WHERE v > high OR v < low
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND doc_id NOT IN (SELECT doc_id FROM outside) AS kept FROM judged
"""

SQL["op11_filter_audit"] = """
WITH base AS (
  SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w FROM documents
), marked AS (
  SELECT doc_id, coalesce(bool_or(quality = 1), false) AS good, coalesce(bool_or(toxic = 1), false) AS bad FROM labels GROUP BY doc_id
), failed AS (
  SELECT part, coalesce(good, false) AS good, coalesce(bad, false) AS bad,
    CASE WHEN len(w) < 200 THEN 1 ELSE 0 END + CASE WHEN 100 * len(list_distinct(w)) < 50 * len(w) THEN 2 ELSE 0 END
    + CASE WHEN 100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 3 * length(t) THEN 4 ELSE 0 END
    + CASE WHEN regexp_matches(t, '[#$%&*|]') THEN 8 ELSE 0 END
    + CASE WHEN doc_id > min(doc_id) OVER (PARTITION BY t) THEN 16 ELSE 0 END AS bits
  FROM base LEFT JOIN marked USING (doc_id)
), cell AS (
  SELECT part, bits, count(*) AS n, count(*) FILTER (good) AS n_good, count(*) FILTER (bad) AS n_bad FROM failed GROUP BY ALL
), letter AS (
  SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x
), ordered AS (
  SELECT a.x || b.x || c.x || d.x || e.x AS o FROM letter a, letter b, letter c, letter d, letter e WHERE len(list_distinct([a.x, b.x, c.x, d.x, e.x])) = 5
), stepped AS (
  SELECT o, s, 1 << (instr('ABCDE', substr(o, s, 1)) - 1) AS own,
    (SELECT coalesce(sum(1 << (instr('ABCDE', x) - 1)), 0) FROM letter WHERE instr(substr(o, 1, s - 1), x) > 0) AS earlier
  FROM (SELECT o, CAST(unnest(range(1, 6)) AS INTEGER) AS s FROM ordered)
), counted AS (
  SELECT part, o AS filter_order, s AS step, own,
    sum(n) FILTER (bits & (own | CAST(earlier AS BIGINT)) = 0) AS kept, sum(n) FILTER (bits & own > 0 AND bits & CAST(earlier AS BIGINT) = 0) AS removed,
    sum(n) FILTER (bits & own > 0 AND bits & CAST(earlier AS BIGINT) > 0) AS redundant, sum(n) FILTER (bits = own) AS unique_fails,
    sum(n_good) FILTER (bits & own > 0 AND bits & CAST(earlier AS BIGINT) = 0) AS good_lost,
    sum(n_bad) FILTER (bits & own > 0 AND bits & CAST(earlier AS BIGINT) = 0) AS toxic_lost
  FROM cell CROSS JOIN stepped GROUP BY ALL
)
SELECT part, filter_order, step, CAST(coalesce(kept, 0) AS BIGINT) AS kept, CAST(coalesce(removed, 0) AS BIGINT) AS removed,
  CAST(coalesce(redundant, 0) AS BIGINT) AS redundant, CAST(coalesce(unique_fails, 0) AS BIGINT) AS unique_fails,
  CAST(coalesce(good_lost, 0) AS BIGINT) AS good_lost, CAST(coalesce(toxic_lost, 0) AS BIGINT) AS toxic_lost,
  CAST(sum(coalesce(removed, 0)) OVER (PARTITION BY part, own) AS BIGINT) AS shapley
FROM counted
"""

SQL["op12_source_divergence"] = """
WITH d AS (
  SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[a-z\\x{80}-\\x{10FFFF}]+') AS w FROM documents
), c AS (
  SELECT lang, source, term, count(*) AS n, count(DISTINCT r) AS docs FROM (SELECT r, lang, source, unnest(w) AS term FROM d) GROUP BY ALL
), k AS (
  SELECT lang, term, sum(n) AS n FROM c GROUP BY ALL HAVING sum(docs) >= 10
), z AS (
  SELECT lang, count(*) AS v, sum(n) AS n FROM k GROUP BY lang
), g AS (
  SELECT DISTINCT lang, source FROM d
), s AS (
  SELECT g.lang, g.source, coalesce(sum(c.n), 0) AS n FROM g LEFT JOIN (c SEMI JOIN k USING (lang, term)) c USING (lang, source) GROUP BY ALL
), p AS (
  SELECT s.lang, s.source, k.term, coalesce(c.n, 0) AS c, CAST(1 + (1000000000 * (coalesce(c.n, 0) + 2)) // (s.n + 2 * z.v) AS BIGINT) AS p,
    CAST(1 + (1000000000 * (k.n + 2)) // (z.n + 2 * z.v) AS BIGINT) AS q
  FROM s JOIN z USING (lang) JOIN k USING (lang) LEFT JOIN c ON c.lang = s.lang AND c.source = s.source AND c.term = k.term
), far AS (
  SELECT a.lang, a.source, b.source AS item, sum(((a.p - b.p) * (a.p - b.p)) // (a.p + b.p)) AS value
  FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL
), pair AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, CAST(coalesce(f.value, 0) AS BIGINT) AS value
  FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source LEFT JOIN far f ON f.lang = a.lang AND f.source = a.source AND f.item = b.source
), single AS (
  SELECT lang, source, 'term' AS part, term AS item, ((p - q) * (p - q)) // (p + q) AS value FROM p WHERE c > 0 AND p > q
), ranked AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS INTEGER) AS rank FROM (FROM pair UNION ALL FROM single)
)
SELECT * FROM ranked WHERE part = 'pair' OR rank <= 10
"""

SQL["op13_chat_format"] = """
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, i, r, '\\### Assistant: </turn> ok' FROM (VALUES (0, 'user'), (1, 'assistant')) AS v(i, r)
), m AS (
  SELECT *, CASE role WHEN 'system' THEN 'System' WHEN 'user' THEN 'User' WHEN 'assistant' THEN 'Assistant' ELSE '@' || url_encode(role) END AS name,
    len(regexp_extract_all(text, '<[\\\\]*/turn>')) AS n_ends, len(regexp_extract_all(text, '###[\\\\]* (System|User|Assistant|@[A-Za-z0-9.*_%+-]*): ')) AS n_heads
  FROM t
)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(4 + length(name) + 2 + length(text) + n_ends + n_heads + 8) AS BIGINT) AS formatted_chars
FROM m GROUP BY conv_id
"""
