"""The registered queries of this subpackage over the driver's tables, and their SQL."""

from __future__ import annotations

from tripmart.llm import (
    bpe, embeddedup, filteraudit, licenses, linededup, minhash, mixing, quotes, syncmers, tokencount, topk, toxicity, turnrepair,
)
from tripmart.llm.common import lean, table


def op1_toxicity(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return toxicity.score(docs, toxicity.learn(docs, table(spark, sf_dir, "labels")))


def op2_quote_links(spark, sf_dir):
    return quotes.conversations(table(spark, sf_dir, "conversations"))


def op3_syncmers(spark, sf_dir):
    return syncmers.fingerprints(table(spark, sf_dir, "documents"))


def op4_minhash_inverted(spark, sf_dir):
    return minhash.near_duplicates(table(lean(spark), sf_dir, "documents"))


def op5_byte_bpe(spark, sf_dir):
    return bpe.encode(table(spark, sf_dir, "documents"))


def op6_source_mixing(spark, sf_dir):
    return mixing.plan(table(spark, sf_dir, "documents")).select(
        "doc_id", "size", "source_size", "target", "taken"
    )


def op7_license_scan(spark, sf_dir):
    return licenses.scan(table(spark, sf_dir, "documents"))


def op8_segment_topk(spark, sf_dir):
    return topk.search(table(spark, sf_dir, "embeddings"))


def op9_line_dedup(spark, sf_dir):
    return linededup.dedup_lines(table(spark, sf_dir, "documents"))


def op10_token_counts(spark, sf_dir):
    return tokencount.count_tokens(table(spark, sf_dir, "documents"))


def op11_embedding_dedup(spark, sf_dir):
    return embeddedup.near_duplicates(table(spark, sf_dir, "embeddings"))


def op12_filter_audit(spark, sf_dir):
    return filteraudit.audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op13_turn_repair(spark, sf_dir):
    return turnrepair.report(table(spark, sf_dir, "conversations"))


QUERIES = {
    "op1_toxicity": op1_toxicity,
    "op2_quote_links": op2_quote_links,
    "op3_syncmers": op3_syncmers,
    "op4_minhash_inverted": op4_minhash_inverted,
    "op5_byte_bpe": op5_byte_bpe,
    "op6_source_mixing": op6_source_mixing,
    "op7_license_scan": op7_license_scan,
    "op8_segment_topk": op8_segment_topk,
    "op9_line_dedup": op9_line_dedup,
    "op10_token_counts": op10_token_counts,
    "op11_embedding_dedup": op11_embedding_dedup,
    "op12_filter_audit": op12_filter_audit,
    "op13_turn_repair": op13_turn_repair,
}

ORACLE_SQL = {
    "op8_segment_topk": """
WITH v AS (
  SELECT vec_id, min(list_transform(embedding, lambda x: CAST(floor(CAST(x AS DOUBLE) * 1024) AS BIGINT))) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
  GROUP BY vec_id),
e AS (SELECT vec_id, generate_subscripts(v, 1) AS i, unnest(v) AS x, len(v) AS n FROM v),
scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(sum(q.x * c.x) AS BIGINT) AS score
  FROM e q JOIN e c ON q.i = c.i AND q.n = c.n AND q.vec_id <> c.vec_id
  WHERE q.vec_id % 100 = 0
  GROUP BY ALL),
ranked AS (
  SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank, vec_id, score
  FROM scored)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM ranked WHERE rank <= 10
""",
    # The closed form of the resharing: with sources in order of size per weight, the
    # capped ones are a prefix, the longest whose members are above their share.
    "op6_source_mixing": r"""
WITH sizes AS (
  SELECT doc_id, source, CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size
  FROM documents),
sources AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM sizes GROUP BY source),
weighted AS (
  SELECT source, source_size,
         CASE (row_number() OVER (ORDER BY encode(source) ASC NULLS LAST) - 1) % 3
              WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS weight
  FROM sources),
ordered AS (
  SELECT *, sum(source_size) OVER () AS total, sum(weight) OVER () AS weights,
         coalesce(sum(source_size) OVER before, 0) AS size_before,
         coalesce(sum(weight) OVER before, 0) AS weight_before
  FROM weighted
  WINDOW before AS (ORDER BY CAST(source_size AS DOUBLE) / weight, source NULLS LAST
                    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
tested AS (
  SELECT *, weight * (3 * total - 4 * size_before) > 4 * source_size * (weights - weight_before) AS over
  FROM ordered),
level AS (
  SELECT 3 * max(total) - 4 * coalesce(sum(source_size) FILTER (WHERE over), 0) AS remaining,
         max(weights) - coalesce(sum(weight) FILTER (WHERE over), 0) AS weights
  FROM tested),
targets AS (
  SELECT source, source_size,
         CASE WHEN over THEN CAST(source_size AS DOUBLE) * 2.0
              ELSE CAST(weight AS DOUBLE) * CAST(remaining AS DOUBLE)
                   / CAST(2 * CASE WHEN level.weights = 0 THEN 0.5 ELSE level.weights END AS DOUBLE) END AS target
  FROM tested, level),
rated AS (
  SELECT s.doc_id, s.size, t.source_size, t.target,
         CASE WHEN t.source_size > 0 THEN t.target / CAST(t.source_size AS DOUBLE) ELSE 0.0 END AS rate,
         CAST(CAST('0x' || substr(md5('mix-1|' || coalesce(CAST(s.doc_id AS VARCHAR), 'null')), 1, 13) AS BIGINT)
              AS DOUBLE) / 4503599627370496.0 AS draw
  FROM sizes s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target,
       size * (CAST(floor(rate) AS BIGINT) + CASE WHEN draw < rate - floor(rate) THEN 1 ELSE 0 END) AS taken
FROM rated
""",
}


def _license_sql() -> str:
    """Every unit against every template, without the pruning by key words."""
    quoted = [(n, t.replace("'", "''")) for n, t in licenses.TEMPLATES]
    values = ",\n  ".join(f"('{n}', '{t}')" for n, t in quoted)
    normal = r"trim(regexp_replace(lower({}), '[^\p{{L}}\p{{N}}]+', ' ', 'g'))"
    pairs = "list_distinct(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]))"
    return rf"""
WITH templates(name, template) AS (VALUES
  {values}),
t AS (SELECT name, {pairs} AS b FROM (SELECT name, string_split({normal.format('template')}, ' ') AS w FROM templates)),
units AS (
  SELECT doc_id, unnest(list_distinct([text] || string_split(text, chr(10)) || string_split(
           regexp_replace(text, '([.!?;])[\x20\x09-\x0D]+', '\1' || chr(10), 'g'), chr(10)))) AS unit
  FROM documents WHERE text IS NOT NULL),
u AS (SELECT DISTINCT doc_id, {pairs} AS b FROM (SELECT doc_id, string_split({normal.format('unit')}, ' ') AS w FROM units)),
found AS (
  SELECT doc_id, name, max(score) AS score
  FROM (SELECT u.doc_id, t.name, 2.0 * len(list_intersect(u.b, t.b)) / (len(u.b) + len(t.b)) AS score
        FROM u JOIN t ON 2 * least(len(u.b), len(t.b)) >= 0.79 * (len(u.b) + len(t.b)))
  WHERE score >= 0.8 GROUP BY ALL),
best AS (
  SELECT doc_id, arg_min(name, (-score, name)) AS license, max(score) AS score, string_agg(name, ',' ORDER BY name) AS licenses
  FROM found GROUP BY doc_id)
SELECT d.doc_id, license, CAST(coalesce(score, 0) AS DOUBLE) AS score, coalesce(licenses, '') AS licenses
FROM documents d LEFT JOIN best ON d.doc_id = best.doc_id
"""


ORACLE_SQL["op7_license_scan"] = _license_sql()

# Every pair of different sets that share a shingle, and components by reachability.
ORACLE_SQL["op4_minhash_inverted"] = r"""
WITH RECURSIVE worded AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
           'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
  FROM documents),
sets AS (
  SELECT doc_id, list_sort(list_distinct(CASE WHEN len(w) = 0 THEN []
           WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
           ELSE list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]) END)) AS s
  FROM worded),
named AS (SELECT doc_id, s, len(s) AS n, CASE WHEN len(s) > 0 THEN md5(CAST(s AS VARCHAR)) END AS node FROM sets),
nodes AS (SELECT node, min(doc_id) AS first_id, any_value(s) AS s, any_value(n) AS n FROM named
          WHERE node IS NOT NULL GROUP BY node),
posted AS (SELECT node, n, unnest(s) AS shingle FROM nodes),
common AS (
  SELECT a.node AS a, b.node AS b, count(*) AS c, any_value(a.n) AS an, any_value(b.n) AS bn
  FROM posted a JOIN posted b ON a.shingle = b.shingle AND a.node <> b.node
    AND 100 * a.n >= 85 * b.n AND 100 * b.n >= 85 * a.n
  GROUP BY 1, 2),
linked AS (SELECT a, b FROM common WHERE 100 * c >= 85 * (an + bn - c)),
reach AS (
  SELECT a AS root, a AS node FROM linked
  UNION SELECT reach.root, linked.b FROM reach JOIN linked ON reach.node = linked.a),
heads AS (SELECT root AS node, min(first_id) AS head FROM reach JOIN nodes ON reach.node = nodes.node GROUP BY 1)
SELECT r.doc_id, CAST(r.n AS BIGINT) AS n_shingles, coalesce(h.head, m.first_id, r.doc_id) AS component_id,
       r.doc_id = coalesce(h.head, m.first_id, r.doc_id) AS kept
FROM named r LEFT JOIN nodes m ON r.node = m.node LEFT JOIN heads h ON r.node = h.node
"""

ORACLE_SQL["op2_quote_links"] = r"""
WITH RECURSIVE messages AS (
  SELECT conv_id, turn, role, text,
         md5(concat_ws('|', coalesce(CAST(conv_id AS VARCHAR), '-'), coalesce(CAST(turn AS VARCHAR), '-'),
                       coalesce('r' || role, '-'), coalesce('t' || text, '-'))) AS key,
         regexp_matches(coalesce(text, ''), '(?m)^[\x20\x09]*>') AS quotes
  FROM conversations),
known AS (SELECT DISTINCT conv_id, turn, key, text FROM messages
          WHERE conv_id IN (SELECT conv_id FROM messages WHERE quotes) AND turn IS NOT NULL),
split AS (
  SELECT conv_id, turn, key, unnest(l) AS line, generate_subscripts(l, 1) AS pos
  FROM (SELECT *, string_split_regex(coalesce(text, ''), '\r?\n') AS l FROM known)),
marked AS (
  SELECT conv_id, turn, key, pos,
         length(regexp_replace(regexp_extract(line, '^[\x20\x09]*((?:>[\x20\x09]?)+)', 1), '[^>]', '', 'g')) AS level,
         regexp_replace(line, '^[\x20\x09]*((?:>[\x20\x09]?)+)', '') AS line
  FROM split),
starts AS (
  SELECT *, CASE WHEN lag(level) OVER w = level THEN 0 ELSE 1 END AS opens FROM marked
  WINDOW w AS (PARTITION BY key ORDER BY pos)),
runs AS (SELECT *, sum(opens) OVER (PARTITION BY key ORDER BY pos) AS run FROM starts),
passages AS (
  SELECT conv_id, turn, key, level, run, string_agg(line, chr(10) ORDER BY pos) AS passage FROM runs GROUP BY ALL),
pieces AS (
  SELECT conv_id, turn, key, level, passage AS piece, 1 AS least FROM passages
  UNION ALL SELECT conv_id, turn, key, level, unnest(string_split_regex(passage, '\n[\x20\x09]*\n')), 12 FROM passages
  UNION ALL SELECT conv_id, turn, key, level, unnest(string_split(passage, chr(10))), 12 FROM passages),
units AS (
  SELECT DISTINCT conv_id, turn, key, level, unit
  FROM (SELECT *, trim(regexp_replace(lower(piece), '[\x20\x09-\x0D]+', ' ', 'g')) AS unit FROM pieces)
  WHERE length(unit) >= least),
sided AS (
  SELECT *, level = 0 AS own,
         last_value(CASE WHEN level = 0 THEN {'turn': turn, 'key': key} END IGNORE NULLS) OVER (
           PARTITION BY conv_id, unit ORDER BY turn, level = 0, key
           ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS source
  FROM units),
answers AS (
  SELECT key, arg_max(source, (-level, length(unit), source.turn, source.key)) AS source, count(DISTINCT unit) AS n_linked
  FROM sided WHERE level > 0 AND source IS NOT NULL GROUP BY key),
steps AS (
  SELECT DISTINCT m.conv_id, m.key, a.source.key AS parent, a.source.turn AS parent_turn, coalesce(a.n_linked, 0) AS n_linked,
         {'turn': coalesce(m.turn, 9223372036854775807), 'key': m.key} AS step
  FROM messages m LEFT JOIN answers a ON m.key = a.key),
paths AS (
  SELECT conv_id, key, parent_turn, n_linked, [step] AS path FROM steps WHERE parent IS NULL
  UNION ALL
  SELECT s.conv_id, s.key, s.parent_turn, s.n_linked, list_append(p.path, s.step)
  FROM steps s JOIN paths p ON s.parent = p.key),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY path) - 1 AS place FROM paths)
SELECT m.conv_id, m.turn, m.role, p.place, CAST(len(p.path) - 1 AS INTEGER) AS depth, p.parent_turn AS reply_to, p.n_linked,
       CASE WHEN quotes THEN array_to_string(list_filter(string_split_regex(m.text, '\r?\n'),
              lambda x: NOT regexp_matches(x, '^[\x20\x09]*>')), chr(10)) ELSE coalesce(m.text, '') END AS text
FROM messages m JOIN placed p ON m.key = p.key
"""

# Every pair of vectors, and components by reachability.
ORACLE_SQL["op11_embedding_dedup"] = """
WITH RECURSIVE v AS (
  SELECT row_number() OVER () AS row, vec_id, CAST(embedding AS DOUBLE[]) AS e,
         vec_id IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
         AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
         AND len(list_filter(embedding, lambda x: x <> 0)) > 0 AS fine
  FROM embeddings),
linked AS (
  SELECT a.row AS a, b.row AS b FROM v a JOIN v b ON a.row <> b.row AND len(a.e) = len(b.e) AND a.fine AND b.fine
  WHERE a.e = b.e OR list_cosine_similarity(a.e, b.e) >= 0.95),
reach AS (
  SELECT a AS root, b AS row FROM linked
  UNION SELECT reach.root, linked.b FROM reach JOIN linked ON reach.row = linked.a),
heads AS (SELECT root AS row, min(vec_id) AS head FROM reach JOIN v ON reach.row = v.row GROUP BY 1),
counts AS (SELECT a AS row, count(*) AS n FROM linked GROUP BY 1)
SELECT vec_id, coalesce(n, 0) AS n_links, least(head, vec_id) AS component_id, coalesce(vec_id <= coalesce(head, vec_id), true) AS kept
FROM v LEFT JOIN heads ON v.row = heads.row LEFT JOIN counts ON v.row = counts.row
"""

# Every order looked at by itself.
ORACLE_SQL["op12_filter_audit"] = r"""
WITH words AS (
  SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w
  FROM documents),
failing AS (
  SELECT doc_id, part,
         CASE WHEN len(w) < 200 THEN 'A' ELSE '' END
         || CASE WHEN 100 * len(list_distinct(w)) < 50 * len(w) THEN 'B' ELSE '' END
         || CASE WHEN 100 * len(regexp_extract_all(t, '[A-Z]')) > 3 * length(t) THEN 'C' ELSE '' END
         || CASE WHEN regexp_matches(t, '[#$%&*|]') THEN 'D' ELSE '' END
         || CASE WHEN doc_id > min(doc_id) OVER (PARTITION BY t) THEN 'E' ELSE '' END AS fails
  FROM words),
marks AS (SELECT doc_id, max(coalesce(quality = 1, false)) AS good, max(coalesce(toxic = 1, false)) AS toxic FROM labels GROUP BY doc_id),
groups AS (
  SELECT part, fails, count(*) AS n, count(*) FILTER (WHERE good) AS good, count(*) FILTER (WHERE toxic) AS toxic
  FROM failing LEFT JOIN marks ON failing.doc_id = marks.doc_id GROUP BY part, fails),
letters AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS l),
orders AS (
  SELECT a.l || b.l || c.l || d.l || e.l AS filter_order
  FROM letters a JOIN letters b ON b.l <> a.l JOIN letters c ON c.l NOT IN (a.l, b.l)
  JOIN letters d ON d.l NOT IN (a.l, b.l, c.l) JOIN letters e ON e.l NOT IN (a.l, b.l, c.l, d.l)),
steps AS (SELECT filter_order, CAST(unnest(range(1, 6)) AS INTEGER) AS step FROM orders),
met AS (
  SELECT part, filter_order, step, n, good, toxic, filter_order[step] AS letter, contains(fails, filter_order[step]) AS hit,
         fails = filter_order[step] AS only_it,
         fails <> '' AND regexp_matches(filter_order[1:step - 1], '[' || CASE WHEN fails = '' THEN '-' ELSE fails END || ']') AS before
  FROM groups JOIN steps ON true),
summed AS (
  SELECT part, filter_order, step, any_value(letter) AS letter,
         coalesce(sum(n) FILTER (WHERE NOT hit AND NOT before), 0) AS kept,
         coalesce(sum(n) FILTER (WHERE hit AND NOT before), 0) AS removed,
         coalesce(sum(n) FILTER (WHERE hit AND before), 0) AS redundant,
         coalesce(sum(n) FILTER (WHERE only_it), 0) AS unique_fails,
         coalesce(sum(good) FILTER (WHERE hit AND NOT before), 0) AS good_lost,
         coalesce(sum(toxic) FILTER (WHERE hit AND NOT before), 0) AS toxic_lost
  FROM met GROUP BY part, filter_order, step)
SELECT part, filter_order, step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed,
       CAST(redundant AS BIGINT) AS redundant, CAST(unique_fails AS BIGINT) AS unique_fails,
       CAST(good_lost AS BIGINT) AS good_lost, CAST(toxic_lost AS BIGINT) AS toxic_lost,
       CAST(sum(removed) OVER (PARTITION BY part, letter) AS BIGINT) AS shapley
FROM summed
"""
