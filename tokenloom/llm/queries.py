"""One registered query per operator, over its whole table, and the oracle SQL where SQL can say it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tokenloom.llm import (
    conversation_trie, embedding_dedup, fingerprints, jaccard_join, language_id, line_dedup, lm_scoring, mixing, packing,
    structure_repair, substring_dedup, url_filter, warc)
from tokenloom.llm.common import table

QUERIES: dict = {}
ORACLE: dict = {}


def _register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


_WS = r"[\x20\x09-\x0D]"

_LINE_SQL = rf"""
WITH l AS (
  SELECT doc_id, unnest(s) AS line, generate_subscripts(s, 1) AS n
  FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS s FROM documents)),
k AS (
  SELECT *, translate(regexp_replace(line, '^{_WS}+|{_WS}+$', '', 'g'),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l),
h AS (SELECT key, min(doc_id) AS keeper FROM k WHERE length(key) >= 10
      GROUP BY key HAVING count(DISTINCT doc_id) > 1),
j AS (SELECT k.doc_id, k.n, k.line, h.key IS NOT NULL AND h.keeper <> k.doc_id AS gone FROM k LEFT JOIN h USING (key))
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY n) FILTER (NOT gone), '')) AS kept_sha256
FROM j GROUP BY doc_id
"""


@_register("op1_line_dedup", _LINE_SQL)
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return line_dedup.dedup_lines(spark, docs).select(
        "doc_id", "n_lines", "n_dropped", F.sha2(F.col("kept_text").cast("binary"), 256).alias("kept_sha256"))


_MIX_SQL = rf"""
WITH d AS (SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size FROM documents),
k AS (SELECT *, ('0x' || substr(md5('{mixing.SEED}:' || doc_id || ':' || size), 1, 12))::BIGINT AS key FROM d),
s AS (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source),
w AS (SELECT *, [5.0, 2.0, 1.0][((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::INT]::DOUBLE AS weight,
        source_size * 2.0::DOUBLE AS cap FROM s),
r AS (SELECT *, cap / weight AS ratio FROM w),
v AS (SELECT *, row_number() OVER b0 AS place, ((sum(source_size) OVER ())::DOUBLE * 1.5::DOUBLE - coalesce(sum(cap) OVER b, 0))
          / (sum(weight) OVER () - coalesce(sum(weight) OVER b, 0)) AS level FROM r
      WINDOW b0 AS (ORDER BY ratio, source NULLS LAST), b AS (ORDER BY ratio, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
g AS (SELECT source, source_size, least(cap, coalesce((SELECT arg_min(level, place) FROM v WHERE level <= ratio) * weight, cap)) AS target FROM v),
o AS (SELECT k.*, g.source_size, g.target, floor(g.target)::BIGINT AS budget,
        coalesce(sum(k.size) OVER (PARTITION BY k.source ORDER BY k.key, k.doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS before
      FROM k JOIN g ON k.source IS NOT DISTINCT FROM g.source)
SELECT doc_id, size, source_size, target,
  (CASE WHEN source_size > 0 THEN (budget // source_size) * size
   + greatest(0, least(size, budget % source_size - before)) ELSE 0 END)::BIGINT AS taken FROM o
"""


@_register("op3_mix_sources", _MIX_SQL)
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    return mixing.mix(spark, docs).select("doc_id", "size", "source_size", "target", "taken")


def _rule_sql() -> str:
    rows = ", ".join(f"('{a}', '{h}', '{p}')" for a, h, p in url_filter.RULES)
    hit = lambda t: f"regexp_matches(u, '(^|[^a-z0-9]){t}($|[^a-z0-9])')::INT"
    strict = " + ".join(hit(t) for t in url_filter.STRICT_TERMS)
    soft = " + ".join(hit(t) for t in url_filter.SOFT_TERMS)
    return rf"""
WITH p AS (SELECT page_id, lower(coalesce(url, '')) AS u,
    regexp_extract(coalesce(url, ''), '^(?s:.*?)://([^/?#]*)', 1) AS h,
    regexp_extract(coalesce(url, ''), '^(?s:.*?)://[^/?#]*([^?#]*)', 1) AS path FROM pages),
q AS (SELECT *, translate(h, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host FROM p),
rules(action, rh, rp) AS (VALUES {rows}),
f AS (SELECT page_id, arg_max(rh || rp, length(rh || rp)) AS rule, arg_max(action, length(rh || rp)) AS action
      FROM q JOIN rules ON (host = rh OR ends_with(host, '.' || rh)) AND starts_with(path, rp) GROUP BY page_id)
SELECT q.page_id, host, path, rule,
  coalesce(action, CASE WHEN ({strict}) >= 1 OR ({soft}) >= {url_filter.SOFT_HITS} THEN 'block' ELSE 'allow' END) AS verdict
FROM q LEFT JOIN f USING (page_id)
"""


@_register("op7_url_filter", _rule_sql())
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return url_filter.judge_urls(pages).select("page_id", "host", "path", "rule", "verdict")


@_register("op6_language_id")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    return language_id.identify(spark, docs, spans=False).select("doc_id", "held_out", "lang_pred", "score")


@_register("op8_best_fit_packing")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(spark, table(spark, sf_dir, "documents").select("doc_id", "text"))


@_register("op9_jaccard_join")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.jaccard_classes(spark, table(spark, sf_dir, "documents").select("doc_id", "text"))


@_register("op10_embedding_dedup")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup.embedding_classes(spark, table(spark, sf_dir, "embeddings"))


_SUBSTRING_SQL = r"""
WITH w AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents),
p AS (SELECT doc_id, unnest(range(1, len(ws) - 33)) AS i, ws FROM w WHERE len(ws) >= 35),
k AS (SELECT doc_id, i, md5(array_to_string(ws[i:i + 34], ' ')) AS h FROM p),
r AS (SELECT h FROM k GROUP BY h HAVING count(*) > 1),
c AS (SELECT DISTINCT doc_id, i + o AS j FROM k JOIN r USING (h), range(0, 35) t(o)),
g AS (SELECT doc_id, list(j) AS js FROM c GROUP BY doc_id)
SELECT w.doc_id, len(ws)::BIGINT AS n_words, coalesce(len(js), 0)::BIGINT AS n_removed,
  sha256(array_to_string(CASE WHEN js IS NULL THEN ws ELSE
    [ws[x] FOR x IN range(1, len(ws) + 1) IF NOT list_contains(js, x)] END, ' ')) AS kept_sha256
FROM w LEFT JOIN g USING (doc_id)
"""


@_register("op2_substring_dedup", _SUBSTRING_SQL)
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return substring_dedup.remove_repeats(spark, docs).select(
        "doc_id", "n_words", "n_removed", F.sha2(F.col("kept_text").cast("binary"), 256).alias("kept_sha256"))


@_register("op4_fingerprints")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.compare_edits(spark, table(spark, sf_dir, "documents").select("doc_id", "text"))


@_register("op5_lm_scoring")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    return lm_scoring.score_by_labels(spark, docs.select("doc_id", "text"), labels).select(
        "doc_id", "n_tokens", "target_loss", "background_loss", "score")


def _crc_sql(text: str) -> str:
    """Unsigned crc32 of an ASCII expression; ``tab`` is the table's row from ``_CRC_TABLE``."""
    return (f"xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split({text}, ''), lambda x: ascii(x)::BIGINT)), "
            "lambda c, b: xor(c >> 8, tab[(xor(c, b) & 255) + 1])), 4294967295)")


_CRC_TABLE = """crc AS (SELECT list_transform(range(256), lambda x: list_reduce(list_prepend(x::BIGINT, [0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[]),
    lambda c, z: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS tab)"""

_TRIE_SQL = f"""
WITH {_CRC_TABLE},
t AS (SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
        row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS place
      FROM conversations WHERE conv_id IS NOT NULL),
l AS (SELECT conv_id, list({{'r': role, 't': text}} ORDER BY place) AS turns FROM t GROUP BY conv_id),
c AS (SELECT conv_id, turns, {_crc_sql("conv_id::VARCHAR")} % 9 AS h FROM l, crc),
b AS (SELECT c.conv_id, list_concat(coalesce(d.turns[1:c.h], []), c.turns[c.h + 1:]) AS seq
      FROM c LEFT JOIN l d ON d.conv_id = c.conv_id - c.conv_id % 5),
p AS (SELECT conv_id, len(seq) AS size, unnest(range(0, len(seq) + 1)) AS depth, seq FROM b),
q AS (SELECT conv_id, size, depth, seq[1:depth] AS path FROM p),
n AS (SELECT path, depth, min(conv_id) AS conv_id, count(*) AS n_convs,
        coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (size = depth), '') AS ends,
        (count(*) - 1) * CASE WHEN depth = 0 THEN 0 ELSE strlen(path[-1].t) END AS own
      FROM q GROUP BY path, depth),
k AS (SELECT path[:-2] AS path, depth - 1 AS depth, count(*) AS n_children FROM n WHERE depth > 0 GROUP BY ALL),
m AS (SELECT n.*, coalesce(n_children, 0) AS n_children FROM n LEFT JOIN k USING (path, depth)),
u AS (SELECT a.path, a.depth, count(*) FILTER (s.n_children = 0) AS n_leaves, sum(s.own) AS saved
      FROM m a JOIN m s ON s.depth >= a.depth AND s.path[1:a.depth] = a.path GROUP BY ALL)
SELECT m.conv_id, m.depth, par.conv_id AS parent_conv_id, m.n_convs, m.n_children, u.n_leaves,
  u.saved::BIGINT AS saved_tokens, sha256(m.ends) AS ends_sha256
FROM m JOIN u USING (path, depth) LEFT JOIN m par ON par.depth = m.depth - 1 AND par.path = m.path[:-2]
"""


@_register("op11_conversation_trie", _TRIE_SQL)
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversation_trie.rebuilt_trie(spark, table(spark, sf_dir, "conversations"))


_REPAIR_SQL = rf"""
WITH RECURSIVE {_CRC_TABLE},
d0 AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         {_crc_sql("concat(coalesce(conv_id::VARCHAR, ' '), ':', coalesce(turn::VARCHAR, ' '))")} % 20 AS hit FROM conversations, crc),
d1 AS (SELECT conv_id, turn, CASE WHEN hit = 4 THEN 'user' ELSE role END AS role,
         CASE hit WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
         unnest(CASE WHEN hit = 3 THEN [1, 2] ELSE [1] END) AS copy FROM d0 WHERE hit <> 0),
d2 AS (SELECT conv_id, turn, role, text, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS pos FROM d1),
d3 AS (SELECT *, lag(role) OVER (PARTITION BY conv_id ORDER BY pos) AS before,
         row_number() OVER (PARTITION BY conv_id, role, text ORDER BY pos) AS nth FROM d2),
r AS (SELECT *, left(role, 1) AS i, CASE WHEN NOT regexp_matches(text, '[^ 	-
]') THEN 1 WHEN nth > 1 THEN 2
         WHEN NOT regexp_matches(text, '[.!?][ 	-
]*\z') THEN 3 ELSE 0 END AS fault FROM d3),
ins(p, q, c, a) AS (VALUES (0, 0, 0, ''), (1, 1, 0, ''), (2, 2, 0, ''), (3, 3, 0, ''), (0, 2, 2, 'I'), (1, 2, 2, 'I'), (3, 2, 2, 'I'),
  (2, 3, 2, 'I'), (0, 3, 4, 'II'), (1, 3, 4, 'II')),
move(p, q, i) AS (VALUES (0, 1, 's'), (0, 2, 'u'), (1, 2, 'u'), (3, 2, 'u'), (2, 3, 'a')),
e AS (SELECT conv_id, pos, p, q, 3 AS c, 'D' AS a FROM r, (SELECT DISTINCT p, p AS q FROM ins)
      UNION ALL SELECT conv_id, pos, p, q, (fault = 3)::INT, 'K' FROM r JOIN move USING (i) WHERE fault NOT IN (1, 2)
      UNION ALL SELECT conv_id, pos, p, q, 2 + (fault = 3)::INT, 'R' FROM r, move WHERE move.i <> 's' AND fault NOT IN (1, 2)),
s AS (SELECT DISTINCT conv_id, 0::BIGINT AS pos, 0 AS q, {{'c': 0::BIGINT, 'a': ''}} AS best FROM r
      UNION ALL
      SELECT s.conv_id, e.pos, e.q, min({{'c': s.best.c + ins.c + e.c, 'a': s.best.a || ins.a || e.a}})
      FROM s JOIN ins ON ins.p = s.q JOIN e ON e.conv_id IS NOT DISTINCT FROM s.conv_id AND e.pos = s.pos + 1 AND e.p = ins.q
      GROUP BY s.conv_id, e.pos, e.q),
n AS (SELECT conv_id, count(*) AS n, count(*) FILTER (fault = 1) AS blank, count(*) FILTER (fault = 2) AS duplicate,
        count(*) FILTER (fault = 3) AS truncated, count(*) FILTER (pos > 1 AND left(before, 1) || i NOT IN ('su', 'ua', 'au')) AS illegal,
        coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps FROM r GROUP BY conv_id),
f AS (SELECT s.conv_id, min({{'c': s.best.c + ins.c, 'a': s.best.a || ins.a}}) AS best
      FROM s JOIN n ON n.conv_id IS NOT DISTINCT FROM s.conv_id AND n.n = s.pos JOIN ins ON ins.p = s.q AND ins.q IN (0, 3) GROUP BY s.conv_id),
x AS (SELECT conv_id, unnest(string_split(best.a, '')) AS a, generate_subscripts(string_split(best.a, ''), 1) AS k FROM f),
y AS (SELECT conv_id, a, k, sum((a <> 'I')::INT) OVER w AS pos, sum((a <> 'D')::INT) OVER w AS made,
        sum((a <> 'D')::INT) OVER (PARTITION BY conv_id) AS total FROM x WINDOW w AS (PARTITION BY conv_id ORDER BY k)),
z AS (SELECT y.conv_id, y.k, CASE WHEN a = 'K' THEN r.role WHEN (made - 1 - total % 2) % 2 = 0 THEN 'user' ELSE 'assistant' END
        || ':' || CASE WHEN a = 'I' THEN '' ELSE r.text END AS line
      FROM y JOIN r ON r.conv_id IS NOT DISTINCT FROM y.conv_id AND r.pos = greatest(y.pos, 1) WHERE a <> 'D'),
g AS (SELECT conv_id, string_agg(line, chr(10) ORDER BY k) AS whole FROM z GROUP BY conv_id)
SELECT o.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
  coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, coalesce(best.c, 0) AS cost, coalesce(best.a, '') AS audit,
  sha256(coalesce(whole, '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) o LEFT JOIN n ON n.conv_id IS NOT DISTINCT FROM o.conv_id
  LEFT JOIN f ON f.conv_id IS NOT DISTINCT FROM o.conv_id LEFT JOIN g ON g.conv_id IS NOT DISTINCT FROM o.conv_id
"""


@_register("op12_structure_repair", _REPAIR_SQL)
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return structure_repair.repair_damaged(spark, table(spark, sf_dir, "conversations"))


_WARC_SQL = """
WITH p AS (SELECT page_id, coalesce(html, '') AS html, strlen(coalesce(html, '')) AS payload_bytes FROM pages),
m AS (SELECT html, max(page_id) AS keeper FROM p WHERE payload_bytes >= 1000 GROUP BY html HAVING count(*) > 1),
j AS (SELECT p.*, CASE WHEN keeper IS NOT NULL AND (page_id IS NULL OR page_id < keeper) THEN keeper END AS refers_to FROM p LEFT JOIN m USING (html))
SELECT page_id, payload_bytes, sha1(html) AS payload_digest, CASE WHEN refers_to IS NULL THEN 'response' ELSE 'revisit' END AS record_type,
  refers_to FROM j
"""


@_register("op13_warc", _WARC_SQL)
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archive_round_trip(spark, table(spark, sf_dir, "pages").select("page_id", "url", "html")).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
