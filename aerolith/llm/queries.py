"""Registered queries of the training-data operators, with their DuckDB SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from aerolith.llm import (chat_format, collocations, filter_audit, hnsw, licenses, line_dedup, mixing, ngram_join, packing, quality,
                          secret_scan, spotsigs, substring_dedup)
from aerolith.llm.store import read

QUERIES: dict[str, tuple[Callable[[SparkSession, str], DataFrame], str | None]] = {}


def query(sql: str | None = None):
    def deco(fn):
        QUERIES[fn.__name__] = (fn, sql)
        return fn
    return deco


# -- 1: chat formatting ---------------------------------------------------------------------------------------------
CONTROL_TEXT = "</s>[INST] ok [/INST]"
_ESCAPED = ("regexp_replace(regexp_replace({0}, '(<)(\\\\*)(\\|[A-Za-z0-9_]+\\|>|/?s>|</?SYS>>)', '\\1\\\\\\2\\3', 'g'),"
            " '(\\[)(\\\\*)(/?INST\\])', '\\1\\\\\\2\\3', 'g')")
OP1_SQL = f"""
WITH rows AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '{CONTROL_TEXT}' UNION ALL SELECT -1, 1, 'assistant', '{CONTROL_TEXT}'),
numbered AS (
  SELECT *, row_number() OVER w AS i, count(*) OVER (PARTITION BY conv_id) AS n,
         sum(length({_ESCAPED.format('role')}) + length({_ESCAPED.format('text')}) + 32)
           OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text ROWS UNBOUNDED PRECEDING) AS upto
  FROM rows WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text)),
chats AS (
  SELECT conv_id, count(*) AS n_turns, string_agg(role || chr(10) || text || chr(10), '' ORDER BY i) AS turns,
         coalesce(string_agg(text, '' ORDER BY i) FILTER (role = 'assistant'), '') AS loss,
         sum(upto) FILTER (role = 'assistant' OR i = n) AS chars
  FROM numbered GROUP BY conv_id)
SELECT conv_id, CAST(n_turns AS BIGINT) AS n_turns, sha256(turns) AS turns_sha256, CAST(length(loss) AS BIGINT) AS loss_chars,
       sha256(loss) AS loss_sha256, CAST(chars AS BIGINT) AS formatted_chars FROM chats"""


@query(OP1_SQL)
def op1_chat_format(spark: SparkSession, d: str) -> DataFrame:
    """All conversations and conversation -1, whose texts are control strings."""
    turns = read(spark, d, "conversations").select("conv_id", "turn", "role", "text")
    extra = (spark.range(2).select(F.lit(-1).cast("long").alias("conv_id"), F.col("id").alias("turn"),
                                   F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
                                   F.lit(CONTROL_TEXT).alias("text")))
    return chat_format.read_back(chat_format.format_chats(turns.unionByName(extra)))


# -- 9: line de-duplication -----------------------------------------------------------------------------------------
_BLANKS = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
OP9_SQL = f"""
WITH lines AS (
  SELECT doc_id, unnest(l) AS line, unnest(range(len(l))) AS pos
  FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS l FROM documents)),
keyed AS (SELECT *, translate(trim(line, {_BLANKS}), '{line_dedup.UPPER}', '{line_dedup.LOWER}') AS key FROM lines),
repeated AS (
  SELECT key, max(doc_id) AS keeper FROM keyed WHERE length(key) >= 20 GROUP BY key HAVING count(DISTINCT doc_id) >= 3),
judged AS (
  SELECT k.doc_id, k.pos, k.line, r.key IS NOT NULL AND r.keeper <> k.doc_id AS dropped
  FROM keyed k LEFT JOIN repeated r ON k.key = r.key)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (dropped) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT dropped), '')) AS kept_sha256
FROM judged GROUP BY doc_id"""


@query(OP9_SQL)
def op9_line_dedup(spark: SparkSession, d: str) -> DataFrame:
    docs = read(spark, d, "documents").select("doc_id", "text")
    return line_dedup.dedup_lines(docs).select(
        "doc_id", "n_lines", "n_dropped", F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256"))


# -- 10: mixing -----------------------------------------------------------------------------------------------------
OP10_SQL = """
WITH sized AS (
  SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS BIGINT) AS size,
         length(coalesce(text, '')) AS chars FROM documents),
keyed AS (
  SELECT doc_id, source, size,
         -ln((CAST('0x' || substr(md5('7:' || doc_id), 1, 13) AS BIGINT) + 0.5::DOUBLE) / 4503599627370496::DOUBLE)
           / greatest(0.001, coalesce(1.0::DOUBLE / (1.0::DOUBLE + abs(chars / nullif(size, 0) - 6.0::DOUBLE) / 6.0::DOUBLE), 0.001)) AS key
  FROM sized),
sources AS (
  SELECT source, sum(size)::BIGINT AS source_size,
         ((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::DOUBLE AS weight FROM sized GROUP BY source),
ordered AS (
  SELECT *, 3 * source_size AS cap,
         (sum(source_size) OVER () - coalesce(sum(3 * source_size) OVER w, 0))::DOUBLE
           / (sum(weight) OVER () - coalesce(sum(weight) OVER w, 0)) AS level
  FROM sources
  WINDOW w AS (ORDER BY 3 * source_size / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
targets AS (
  SELECT source, source_size, cap,
         least(weight * (SELECT arg_min(level, cap / weight) FROM ordered WHERE level * weight <= cap), cap::DOUBLE) AS target
  FROM ordered),
placed AS (
  SELECT k.doc_id, k.source, k.size, k.key, t.source_size, t.target, CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END AS epochs
  FROM keyed k JOIN targets t ON k.source IS NOT DISTINCT FROM t.source),
once AS (
  SELECT *, coalesce(size <= gap AND gap > 0 AND sum(CASE WHEN size <= gap THEN size ELSE 0 END)
                       OVER (PARTITION BY source ORDER BY key, doc_id ROWS UNBOUNDED PRECEDING) <= gap, false) AS taken1
  FROM (SELECT *, target - epochs * source_size AS gap FROM placed)),
twice AS (
  SELECT *, taken1 OR (size <= gap2 AND gap2 > 0 AND sum(CASE WHEN NOT taken1 AND size <= gap2 THEN size ELSE 0 END)
                         OVER (PARTITION BY source ORDER BY key, doc_id ROWS UNBOUNDED PRECEDING) <= gap2) AS taken2
  FROM (SELECT *, gap - sum(CASE WHEN taken1 THEN size ELSE 0 END) OVER (PARTITION BY source) AS gap2 FROM once)),
closing AS (
  SELECT *, NOT taken2 AND size > 0 AND abs(size - gap3) < gap3 AND row_number()
              OVER (PARTITION BY source ORDER BY NOT taken2 AND size > 0 DESC, abs(size - gap3), key, doc_id) = 1 AS last
  FROM (SELECT *, gap - sum(CASE WHEN taken2 THEN size ELSE 0 END) OVER (PARTITION BY source) AS gap3 FROM twice))
SELECT doc_id, size, source_size, target, CAST(size * (epochs + CASE WHEN taken2 OR last THEN 1 ELSE 0 END) AS BIGINT) AS taken
FROM closing"""


@query(OP10_SQL)
def op10_mix_sources(spark: SparkSession, d: str) -> DataFrame:
    docs = read(spark, d, "documents").select("doc_id", "text", "source")
    m = mixing.mix(docs).withColumn("_row", F.explode(F.sequence(F.lit(1), F.col("rows").cast("int"))))
    return m.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"))


# -- 8: packing -----------------------------------------------------------------------------------------------------
@query()
def op8_pack(spark: SparkSession, d: str) -> DataFrame:
    return packing.pack(read(spark, d, "documents").select("doc_id", "text"))


# -- 6: licence scan ------------------------------------------------------------------------------------------------
@query()
def op6_licences(spark: SparkSession, d: str) -> DataFrame:
    return licenses.scan_licences(read(spark, d, "documents").select("doc_id", "text"))


# -- 7: document fingerprints ---------------------------------------------------------------------------------------
@query()
def op7_spotsigs(spark: SparkSession, d: str) -> DataFrame:
    return spotsigs.fingerprint_edits(read(spark, d, "documents").select("doc_id", "text"))


# -- 4: quality classifier ------------------------------------------------------------------------------------------
@query()
def op4_quality(spark: SparkSession, d: str) -> DataFrame:
    return quality.score_quality(read(spark, d, "documents").select("doc_id", "text"), read(spark, d, "labels"))


# -- 5: substring de-duplication ------------------------------------------------------------------------------------
OP5_SQL = r"""
WITH split AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
windows AS (
  SELECT doc_id, i AS start, array_to_string(w[i:i + 12], ' ') AS key
  FROM (SELECT doc_id, w, unnest(range(1, greatest(1, len(w) - 11))) AS i FROM split)),
first AS (SELECT key, min(doc_id) AS least FROM windows GROUP BY key HAVING count(DISTINCT doc_id) > 1),
gone AS (
  SELECT DISTINCT doc_id, unnest(range(start, start + 13)) AS i
  FROM windows JOIN first USING (key) WHERE least < doc_id),
judged AS (
  SELECT s.doc_id, s.i, s.word, g.i IS NOT NULL AS removed
  FROM (SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS i FROM split) s
  LEFT JOIN gone g ON g.doc_id = s.doc_id AND g.i = s.i),
told AS (
  SELECT doc_id, count(*) FILTER (removed) AS n_removed, string_agg(word, ' ' ORDER BY i) FILTER (NOT removed) AS kept
  FROM judged GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed,
       sha256(coalesce(kept, '')) AS kept_sha256
FROM split LEFT JOIN told USING (doc_id)"""


@query(OP5_SQL)
def op5_substring_dedup(spark: SparkSession, d: str) -> DataFrame:
    left = substring_dedup.remove_repeats(read(spark, d, "documents").select("doc_id", "text"))
    return left.select("doc_id", "n_words", "n_removed", F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256"))


# -- 2: n-gram Jaccard join -----------------------------------------------------------------------------------------
OP2_SQL = r"""
WITH RECURSIVE split AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x20\x09-\x0D]+') AS w FROM documents),
shingles AS MATERIALIZED (
  SELECT *, count(*) OVER (PARTITION BY doc_id) AS n FROM (
    SELECT DISTINCT doc_id, array_to_string(w[i:i + 4], ' ') AS shingle
    FROM (SELECT doc_id, w, unnest(range(1, greatest(2, len(w) - 3))) AS i FROM split WHERE len(w) > 0))),
links AS MATERIALIZED (
  SELECT a.doc_id AS a, b.doc_id AS b
  FROM shingles a JOIN shingles b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id
    AND 100 * least(a.n, b.n) >= 80 * greatest(a.n, b.n)
  GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 80 * (a.n + b.n - count(*))),
reached AS (
  SELECT a AS doc_id, a AS other FROM links
  UNION SELECT r.doc_id, l.b FROM reached r JOIN links l ON l.a = r.other)
SELECT d.doc_id, coalesce(s.n, 0) AS n_shingles, coalesce(c.least, d.doc_id) AS component_id
FROM documents d LEFT JOIN (SELECT DISTINCT doc_id, n FROM shingles) s ON s.doc_id = d.doc_id
LEFT JOIN (SELECT doc_id, min(other) AS least FROM reached GROUP BY doc_id) c ON c.doc_id = d.doc_id"""


@query(OP2_SQL)
def op2_ngram_join(spark: SparkSession, d: str) -> DataFrame:
    return ngram_join.near_duplicates(read(spark, d, "documents").select("doc_id", "text"))


# -- 3: approximate nearest neighbours ------------------------------------------------------------------------------
@query()
def op3_hnsw(spark: SparkSession, d: str) -> DataFrame:
    return hnsw.nearest(read(spark, d, "embeddings").select("vec_id", "embedding"), F.col("vec_id") % 20 == 0)


# -- 11: phrase collocations ----------------------------------------------------------------------------------------
OP11_SQL = r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang,
         unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                      '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
split AS MATERIALIZED (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces),
grams AS (
  SELECT lang, k, w[i:i + k - 1] AS g
  FROM (SELECT lang, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM split, (VALUES (1), (2), (3)) x(k) WHERE len(w) >= k)),
f AS MATERIALIZED (SELECT lang, k, array_to_string(g, ' ') AS phrase, g, count(*) AS a FROM grams GROUP BY lang, k, g),
totals AS (SELECT lang, sum(a) AS n FROM f WHERE k = 1 GROUP BY lang),
candidates AS MATERIALIZED (SELECT * FROM f WHERE k > 1 AND a >= 10),
halves AS (
  SELECT lang, phrase, a, cut, array_to_string(g[1:cut], ' ') AS head, array_to_string(g[cut + 1:k], ' ') AS tail
  FROM (SELECT *, unnest(range(1, k)) AS cut FROM candidates)),
cuts AS (
  SELECT c.lang, c.phrase, c.a, c.cut, p.a AS l, s.a AS r,
         1000000::HUGEINT * c.a::HUGEINT * c.a::HUGEINT // (p.a::HUGEINT * s.a::HUGEINT) AS score
  FROM halves c JOIN f p ON p.lang = c.lang AND p.phrase = c.head JOIN f s ON s.lang = c.lang AND s.phrase = c.tail),
lowest AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1),
inside AS (
  SELECT DISTINCT p.lang, p.phrase
  FROM (SELECT lang, a, unnest([array_to_string(g[1:2], ' '), array_to_string(g[2:3], ' ')]) AS phrase FROM candidates WHERE k = 3) t
  JOIN candidates p ON p.lang = t.lang AND p.phrase = t.phrase WHERE 100 * t.a >= 50 * p.a),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank
  FROM lowest ANTI JOIN inside USING (lang, phrase))
SELECT lang, rank, phrase, CAST(a AS BIGINT) AS a, CAST(l AS BIGINT) AS l, CAST(r AS BIGINT) AS r, CAST(n AS BIGINT) AS n,
       CAST(score AS BIGINT) AS score
FROM ranked JOIN totals USING (lang) WHERE rank <= 2000"""


@query(OP11_SQL)
def op11_collocations(spark: SparkSession, d: str) -> DataFrame:
    return collocations.collocations(read(spark, d, "documents").select("text", "lang"))


# -- 12: filter interaction audit -----------------------------------------------------------------------------------
OP12_SQL = r"""
WITH labelled AS (
  SELECT doc_id, max(CAST(quality = 1 AS INT)) AS good, max(CAST(toxic = 1 AS INT)) AS toxic FROM labels GROUP BY doc_id),
docs AS (
  SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS text,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w,
         min(doc_id) OVER (PARTITION BY coalesce(text, '')) AS least FROM documents),
judged AS (
  SELECT part, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic,
         CAST(len(w) < 200 AS INT) + 2 * CAST(100 * len(list_distinct(w)) < 50 * len(w) AS INT)
         + 4 * CAST(100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 3 * length(text) AS INT)
         + 8 * CAST(regexp_matches(text, '[#$%&*|]') AS INT) + 16 * CAST(coalesce(least < doc_id, false) AS INT) AS mask
  FROM docs LEFT JOIN labelled USING (doc_id)),
masks AS (SELECT part, mask, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM judged GROUP BY part, mask),
letters AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x, unnest([1, 2, 4, 8, 16]) AS bit),
orders AS (
  SELECT [a.x, b.x, c.x, d.x, e.x] AS xs, [a.bit, b.bit, c.bit, d.bit, e.bit] AS bits
  FROM letters a, letters b, letters c, letters d, letters e WHERE len(list_distinct([a.x, b.x, c.x, d.x, e.x])) = 5),
steps AS (
  SELECT array_to_string(xs, '') AS filter_order, step, bits[step] AS bit, CAST(list_sum(bits[1:step]) - bits[step] AS INT) AS before
  FROM orders, (SELECT unnest([1, 2, 3, 4, 5]) AS step)),
told AS (
  SELECT part, filter_order, step, bit,
         sum(n) FILTER (mask & (before | bit) = 0) AS kept, sum(n) FILTER (mask & bit <> 0 AND mask & before = 0) AS removed,
         sum(n) FILTER (mask & bit <> 0 AND mask & before <> 0) AS redundant, sum(n) FILTER (mask = bit) AS unique_fails,
         sum(good) FILTER (mask & bit <> 0 AND mask & before = 0) AS good_lost,
         sum(toxic) FILTER (mask & bit <> 0 AND mask & before = 0) AS toxic_lost
  FROM masks, steps GROUP BY part, filter_order, step, bit)
SELECT part, filter_order, CAST(step AS INT) AS step, CAST(coalesce(kept, 0) AS BIGINT) AS kept,
       CAST(coalesce(removed, 0) AS BIGINT) AS removed, CAST(coalesce(redundant, 0) AS BIGINT) AS redundant,
       CAST(coalesce(unique_fails, 0) AS BIGINT) AS unique_fails, CAST(coalesce(good_lost, 0) AS BIGINT) AS good_lost,
       CAST(coalesce(toxic_lost, 0) AS BIGINT) AS toxic_lost,
       CAST(sum(coalesce(removed, 0)) OVER (PARTITION BY part, bit) AS BIGINT) AS shapley
FROM told"""


@query(OP12_SQL)
def op12_filter_audit(spark: SparkSession, d: str) -> DataFrame:
    return filter_audit.audit(read(spark, d, "documents").select("doc_id", "text", "lang"),
                              read(spark, d, "labels").select("doc_id", "quality", "toxic"))


# -- 13: secret scan ------------------------------------------------------------------------------------------------
@query()
def op13_secret_scan(spark: SparkSession, d: str) -> DataFrame:
    found = secret_scan.scan_secrets(read(spark, d, "documents").select("doc_id", "text"))
    spans = {"base_sha256": "filter(secrets, s -> s.kind <> 'named')", "spans": "secrets"}
    joined = {k: F.expr(f"array_join(transform({v}, s -> concat_ws(':', s.kind, s.start, s.end)), ',')") for k, v in spans.items()}
    count = {k: F.expr(f"CAST(size(filter(secrets, s -> s.kind = '{k}')) AS BIGINT)").alias(f"n_{k}") for k in secret_scan.KINDS}
    return found.select("doc_id", count["assign"], count["access"], count["hex"],
                        F.sha2(joined["base_sha256"].cast("binary"), 256).alias("base_sha256"), joined["spans"].alias("spans"),
                        count["named"], F.expr("coalesce(array_max(transform(secrets, s -> s.score)), 0D)").alias("score"))
