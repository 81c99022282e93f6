"""The operators of this package as named queries over the whole test tables, with SQL where it can say the same."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wattloom.llm import conversation_repair, decontamination, jaccard_join, language_model, line_dedup, mixing, periodic_runs, pii, quality_classifier, quality_rules, simhash, token_counts, warc
from wattloom.llm.storage import importable
from wattloom.llm.text import WORD

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(body: Callable[[SparkSession, str], DataFrame]):
        QUERIES[name] = lambda spark, folder: body(importable(spark), folder)
        if sql is not None:
            SQL[name] = sql
        return body

    return register


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


LINE_DEDUP_SQL = r"""
WITH lines AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
         generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos
  FROM documents
), keyed AS (
  SELECT doc_id, pos, line,
         translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k
  FROM lines
), frequent AS (
  SELECT k FROM keyed WHERE length(k) >= 1 GROUP BY k HAVING count(DISTINCT doc_id) >= 10
)
SELECT doc_id, count(*) AS n_lines, count(f.k) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE f.k IS NULL), '')) AS kept_sha256
FROM keyed LEFT JOIN frequent f ON keyed.k = f.k
GROUP BY doc_id
"""


@query("op1_line_dedup", LINE_DEDUP_SQL)
def op1(spark: SparkSession, folder: str) -> DataFrame:
    cut = line_dedup.drop_frequent_lines(_table(spark, folder, "documents"))
    return cut.select("doc_id", "n_lines", "n_dropped", "kept_sha256")


@query("op2_jaccard_join")
def op2(spark: SparkSession, folder: str) -> DataFrame:
    groups = jaccard_join.near_duplicates(_table(spark, folder, "documents"), words=4, percent=85)
    return groups.withColumnRenamed("id", "doc_id")


@query("op3_decontamination")
def op3(spark: SparkSession, folder: str) -> DataFrame:
    return decontamination.found(_table(spark, folder, "documents"), _table(spark, folder, "benchmark"))


MIXING_SQL = r"""
WITH sized AS (
  SELECT doc_id, source, CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size FROM documents
), ranked AS (
  SELECT source, sum(size)::BIGINT AS source_size,
         [5, 2, 1][1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3] AS w
  FROM sized GROUP BY source
), ordered AS (
  SELECT *, row_number() OVER o AS place, sum(source_size) OVER () AS total,
         coalesce(sum(3 * source_size) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS capped,
         sum(w) OVER (o ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS open
  FROM ranked WINDOW o AS (ORDER BY 3 * source_size::DOUBLE / w, source NULLS LAST)
), level AS (
  SELECT (total::DOUBLE - capped::DOUBLE) / open::DOUBLE AS level FROM ordered
  WHERE (total::DOUBLE - capped::DOUBLE) / open::DOUBLE <= 3 * source_size::DOUBLE / w ORDER BY place LIMIT 1
), targets AS (
  SELECT source, source_size, least(level * w, 3 * source_size::DOUBLE) AS target,
         CAST('0x' || substr(md5('7:' || coalesce(source, '')), 1, 8) AS BIGINT)::DOUBLE / 4294967296.0 AS off
  FROM ordered, level
), placed AS (
  SELECT s.doc_id, s.size, t.source_size, t.target, t.off,
         CASE WHEN t.source_size > 0 THEN t.target / t.source_size ELSE 0 END AS step,
         row_number() OVER (PARTITION BY s.source ORDER BY s.size, s.doc_id) AS n
  FROM sized s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source
)
SELECT doc_id, size, source_size, target,
       CAST(CASE WHEN size > 0 THEN least(floor(n * step + off) - floor((n - 1) * step + off), 3) ELSE 0 END AS BIGINT) * size AS taken
FROM placed
"""


@query("op4_mixing", MIXING_SQL)
def op4(spark: SparkSession, folder: str) -> DataFrame:
    mixed = mixing.mix_copies(_table(spark, folder, "documents"))
    return mixed.select(F.col("id").alias("doc_id"), "size", "source_size", "target", "taken")


@query("op5_pii")
def op5(spark: SparkSession, folder: str) -> DataFrame:
    return pii.find(_table(spark, folder, "documents")).withColumnRenamed("id", "doc_id")


@query("op6_token_counts")
def op6(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents").select("doc_id", "text")
    trees = token_counts.with_trees(docs).withColumn("edits", token_counts.every_match_edits())
    counted = token_counts.recount(trees)
    return counted.select(F.col("id").alias("doc_id"), *(c for c in token_counts.COUNTED if c != "edited"))


@query("op7_quality_classifier")
def op7(spark: SparkSession, folder: str) -> DataFrame:
    scored = quality_classifier.classify(_table(spark, folder, "documents"), _table(spark, folder, "labels"))
    return scored.withColumnRenamed("id", "doc_id")


@query("op8_language_model")
def op8(spark: SparkSession, folder: str) -> DataFrame:
    return language_model.score(_table(spark, folder, "documents")).withColumnRenamed("id", "doc_id")


@query("op9_quality_rules")
def op9(spark: SparkSession, folder: str) -> DataFrame:
    return quality_rules.quality_rules(_table(spark, folder, "documents").select("doc_id", "text")).drop("text")


WARC_SQL = """
WITH p AS (SELECT page_id, coalesce(html, '') AS html, octet_length(encode(coalesce(html, ''))) AS n FROM pages),
r AS (SELECT html, max(page_id) AS response FROM p WHERE n >= 1000 GROUP BY html)
SELECT page_id, CAST(n AS BIGINT) AS payload_bytes, sha1(p.html) AS payload_digest,
       CASE WHEN response <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN response <> page_id THEN response END AS refers_to
FROM p LEFT JOIN r ON p.html = r.html
"""


@query("op10_warc", WARC_SQL)
def op10(spark: SparkSession, folder: str) -> DataFrame:
    return warc.archive_pages(_table(spark, folder, "pages")).withColumnRenamed("id", "page_id")


@query("op11_simhash")
def op11(spark: SparkSession, folder: str) -> DataFrame:
    return simhash.near_duplicates(_table(spark, folder, "documents")).withColumnRenamed("id", "doc_id")


def _repeated_from_somewhere(docs: DataFrame) -> DataFrame:
    """(doc_id, text): in every tenth document, by hash, the words from some place on repeat a stretch of its own."""
    h = F.crc32(F.col("doc_id").cast("string"))
    words, g = F.regexp_extract_all("text", F.lit(WORD), F.lit(0)), F.floor(h / 10)
    n = F.size(words)
    a = (g % n).cast("int")
    p = (F.lit(1) + F.floor((n - a) / (F.lit(3) + g % 8))).cast("int")
    tail = F.flatten(F.array_repeat(F.slice(words, a + 1, p), F.ceil((n - a) / p).cast("int")))
    repeated = F.array_join(F.concat(F.slice(words, F.lit(1), a), F.slice(tail, F.lit(1), n - a)), " ")
    return docs.select("doc_id", F.when(h % 10 == 0, F.when(n > 0, repeated).otherwise(F.col("text"))).otherwise(F.col("text")).alias("text"))


@query("op12_periodic_runs")
def op12(spark: SparkSession, folder: str) -> DataFrame:
    found = periodic_runs.find_runs(_repeated_from_somewhere(_table(spark, folder, "documents")))
    longest = F.array_max(F.transform("runs", lambda r: F.struct(r.length.alias("length"), (-r.start).alias("start"), (-r.period).alias("period"))))
    listed = F.array_join(F.transform("runs", lambda r: F.concat(F.concat_ws(",", r.start, r.length, r.period), F.lit("\n"))), "")
    return found.withColumn("_longest", longest).select(
        F.col("id").alias("doc_id"), F.size("runs").cast("long").alias("n_runs"),
        (-F.col("_longest.start")).alias("start"), F.col("_longest.length").alias("length"), (-F.col("_longest.period")).alias("period"),
        F.floor(1000 * F.col("_longest.length") / (-F.col("_longest.period"))).alias("exponent_milli"),
        F.sha2(listed, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


def _repair_sql() -> str:
    """The cheapest edits by a plain table over turns and states, each with its edits and repaired text carried along."""
    insert = lambda v, role: f"{{'c': {v}.c + 3, 'e': {v}.e || 'I', 'r': {v}.r || chr(10) || '{role}:'}}"
    delete = lambda v: f"{{'c': {v}.c + 4, 'e': {v}.e || 'D', 'r': {v}.r}}"

    def emit(v: str, role: str) -> str:
        keeps = f"initial = '{role[0]}'"
        cost = f"CASE WHEN gone THEN 1000000 WHEN {keeps} THEN 0 ELSE {3 if role != 'system' else 1000000} END + CASE WHEN truncated THEN 3 ELSE 0 END"
        return f"{{'c': {v}.c + {cost}, 'e': {v}.e || CASE WHEN {keeps} THEN 'K' ELSE 'R' END, 'r': {v}.r || chr(10) || CASE WHEN {keeps} THEN role ELSE '{role}' END || ':' || text}}"

    least = lambda *options: f"list_min([{', '.join(options)}])"
    start = lambda c: f"{{'c': {c}::BIGINT, 'e': '', 'r': ''}}"
    return rf"""
WITH RECURSIVE keyed AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         xor(list_reduce(list_prepend(4294967295::UBIGINT, list_transform(string_split(k, ''), lambda c: ord(c)::UBIGINT)),
             lambda a, b: list_reduce([xor(a, b), 0, 0, 0, 0, 0, 0, 0, 0]::UBIGINT[], lambda x, y: xor(x >> 1, 3988292384::UBIGINT * (x & 1)))), 4294967295::UBIGINT) % 20 AS d
  FROM (SELECT *, coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS k FROM conversations)
), damaged AS (
  SELECT conv_id, turn, CASE WHEN d = 4 THEN 'user' ELSE role END AS role,
         CASE WHEN d = 1 THEN '' WHEN d = 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
         unnest(CASE WHEN d = 3 THEN [1, 2] ELSE [1] END) AS copy
  FROM keyed WHERE d <> 0
), numbered AS (
  SELECT *, left(role, 1) AS initial, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, md5(length(role) || ':' || role || ':' || text), copy) AS i FROM damaged
), told AS (
  SELECT *, NOT regexp_matches(text, '[^\x20\x09-\x0D]') AS is_blank, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 AS is_again,
         NOT regexp_matches(text, '[.!?][\x20\x09-\x0D]*$') AS is_cut, lag(initial) OVER (PARTITION BY conv_id ORDER BY i) || initial AS pair FROM numbered
), faults AS (
  SELECT *, is_blank OR is_again AS gone, is_cut AND NOT (is_blank OR is_again) AS truncated FROM told
), counts AS (
  SELECT conv_id, max(i) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (WHERE is_blank) AS blank,
         count(*) FILTER (WHERE is_again AND NOT is_blank) AS duplicate, count(*) FILTER (WHERE truncated) AS truncated,
         count(*) FILTER (WHERE pair NOT IN ('su', 'ua', 'au')) AS illegal
  FROM faults GROUP BY conv_id
), way AS (
  SELECT conv_id, 0::BIGINT AS i, {start(0)} AS n, {start(1000000)} AS s, {start(1000000)} AS u, {start(1000000)} AS a FROM counts
  UNION ALL
  SELECT conv_id, i, {delete('n')}, {least(delete('s'), emit('n', 'system'))}, {least(delete('u'), emit('n', 'user'), emit('s', 'user'), emit('a', 'user'))}, {least(delete('a'), emit('u', 'assistant'))}
  FROM (
    SELECT conv_id, i, role, text, initial, gone, truncated, n, s, u, {least('a', insert('u', 'assistant'))} AS a
    FROM (
      SELECT w.conv_id, f.i, f.role, f.text, f.initial, f.gone, f.truncated, n, s, a, {least('u', insert('n', 'user'), insert('s', 'user'), insert('a', 'user'))} AS u
      FROM way w JOIN faults f ON f.conv_id IS NOT DISTINCT FROM w.conv_id AND f.i = w.i + 1
    )
  )
), best AS (
  SELECT w.conv_id, {least('w.n', 'w.a', insert('w.u', 'assistant'), "{'c': w.s.c + 6, 'e': w.s.e || 'II', 'r': w.s.r || chr(10) || 'user:' || chr(10) || 'assistant:'}")} AS b
  FROM way w JOIN counts c ON c.conv_id IS NOT DISTINCT FROM w.conv_id AND c.n = w.i
)
SELECT o.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0)::BIGINT AS blank, coalesce(duplicate, 0)::BIGINT AS duplicate, coalesce(truncated, 0)::BIGINT AS truncated,
       coalesce(illegal, 0)::BIGINT AS illegal, coalesce(b.c, 0)::BIGINT AS cost, coalesce(b.e, '') AS audit, sha256(coalesce(substr(b.r, 2), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) o
LEFT JOIN counts c ON c.conv_id IS NOT DISTINCT FROM o.conv_id
LEFT JOIN best ON best.conv_id IS NOT DISTINCT FROM o.conv_id
"""


def _damaged(conversations: DataFrame) -> DataFrame:
    """Turns with faults, chosen by hash: some dropped, emptied, without full stops, twice, or given to the user."""
    key = F.concat_ws(":", *(F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")))
    role, text = (F.coalesce(c, F.lit(" ")) for c in ("role", "text"))
    d = F.col("_fault")
    return (
        conversations.select("conv_id", "turn", "role", "text", (F.crc32(key) % 20).alias("_fault")).where(d != 0)
        .select(
            "conv_id", "turn", F.when(d == 4, "user").otherwise(role).alias("role"),
            F.when(d == 1, "").when(d == 2, F.regexp_replace(text, "[.!?]", "")).otherwise(text).alias("text"),
            F.explode(F.when(d == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))).alias("_copy"),
        ).drop("_copy")
    )


@query("op13_conversation_repair", _repair_sql())
def op13(spark: SparkSession, folder: str) -> DataFrame:
    conversations = _table(spark, folder, "conversations")
    return conversation_repair.audit(_damaged(conversations), conversations.select("conv_id")).withColumnRenamed("conv", "conv_id")
