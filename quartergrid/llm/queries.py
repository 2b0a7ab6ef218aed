"""One query per operator of this subpackage, and the SQL of those it can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quartergrid.llm.best_fit_packing import pack_documents
from quartergrid.llm.common import scratch, table
from quartergrid.llm.decontamination import contamination
from quartergrid.llm.html_text import extract_main_text
from quartergrid.llm.jaccard_join import jaccard_classes
from quartergrid.llm.language_id import identify_languages
from quartergrid.llm.line_dedup import dedup_lines
from quartergrid.llm.online_packing import pack_online
from quartergrid.llm.prefix_trie import numbered_turns, prefix_trie, with_lent_openings
from quartergrid.llm.quality_rules import quality_verdicts
from quartergrid.llm.secret_scan import NOVEL, PATTERNS, scan_secrets, span_text
from quartergrid.llm.structure_repair import damaged, read_rows, repair_conversations
from quartergrid.llm.substring_dedup import remove_repeated_passages
from quartergrid.llm.warc import read_archives, write_archives

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(build: Callable[[SparkSession, str], DataFrame]):
    QUERIES[build.__name__] = build
    return build


@query
def op5_jaccard_join(spark, sf_dir):
    return jaccard_classes(table(spark, sf_dir, "documents"), size=4, percent=85)


#: DuckDB SQL pieces. Lower case of A-Z only; words between ASCII white space.
LOWER = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
WORDS = r"'[^\x20\x09-\x0D]+'"

ORACLE["op5_jaccard_join"] = f"""
WITH RECURSIVE w AS (
  SELECT doc_id, coalesce(regexp_extract_all({LOWER}, {WORDS}), []) AS ws FROM documents
), s AS (
  SELECT DISTINCT doc_id, shingle FROM (
    SELECT doc_id, unnest(CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 4 THEN [array_to_string(ws, ' ')]
      ELSE list_transform(range(1, len(ws) - 2), lambda i: array_to_string(ws[i:i + 3], ' ')) END) AS shingle
    FROM w)
), n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY 1),
p AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS met
  FROM s a JOIN s b ON a.shingle = b.shingle AND a.doc_id < b.doc_id GROUP BY 1, 2
), l AS (
  SELECT x, y FROM p JOIN n a ON a.doc_id = x JOIN n b ON b.doc_id = y
  WHERE 100 * met >= 85 * (a.n + b.n - met)
), e AS (SELECT x AS a, y AS b FROM l UNION ALL SELECT y, x FROM l),
r(node, root) AS (
  SELECT doc_id, doc_id FROM w UNION SELECT e.b, r.root FROM r JOIN e ON e.a = r.node
)
SELECT w.doc_id, coalesce(any_value(n.n), 0) AS n_shingles, min(r.root) AS component_id
FROM w LEFT JOIN n USING (doc_id) JOIN r ON r.node = w.doc_id GROUP BY w.doc_id
"""


@query
def op4_substring_dedup(spark, sf_dir):
    return remove_repeated_passages(table(spark, sf_dir, "documents"), size=50, with_text=False)


ORACLE["op4_substring_dedup"] = f"""
WITH w AS (
  SELECT doc_id, coalesce(regexp_extract_all(text, {WORDS}), []) AS ws FROM documents
), starts AS (
  SELECT doc_id, ws, unnest(range(1, len(ws) - 48)) AS i FROM w WHERE len(ws) >= 50
), win AS (SELECT doc_id, i, sha256(array_to_string(ws[i:i + 49], ' ')) AS h FROM starts),
least AS (SELECT h, min(doc_id) AS low FROM win GROUP BY h),
gone AS (
  SELECT DISTINCT doc_id, unnest(range(i, i + 50)) AS i FROM win JOIN least USING (h) WHERE low < doc_id
), kept AS (
  SELECT e.doc_id, count(g.i) AS n_removed, string_agg(e.word, ' ' ORDER BY e.i) FILTER (g.i IS NULL) AS text
  FROM (SELECT doc_id, unnest(ws) AS word, generate_subscripts(ws, 1) AS i FROM w) e
  LEFT JOIN gone g ON g.doc_id = e.doc_id AND g.i = e.i GROUP BY e.doc_id
)
SELECT w.doc_id, len(ws)::BIGINT AS n_words, coalesce(n_removed, 0)::BIGINT AS n_removed,
  sha256(coalesce(kept.text, '')) AS kept_sha256
FROM w LEFT JOIN kept USING (doc_id)
"""


@query
def op8_best_fit_packing(spark, sf_dir):
    return pack_documents(table(spark, sf_dir, "documents"), capacity=1024, with_ids=False, added=True)


@query
def op10_quality_rules(spark, sf_dir):
    return quality_verdicts(table(spark, sf_dir, "documents"))


@query
def op2_decontamination(spark, sf_dir):
    return contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).drop("item_ids")


#: Words of lower-case letters, digits and all that is not ASCII.
PLAIN = r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'"

ORACLE["op2_decontamination"] = f"""
WITH d AS (
  SELECT doc_id, coalesce(regexp_extract_all({LOWER}, {PLAIN}), []) AS ws FROM documents
), b AS (
  SELECT item_id, regexp_extract_all({LOWER}, {PLAIN}) AS ws FROM benchmark
), iw AS (
  SELECT DISTINCT item_id, k, array_to_string(ws[i:i + k - 1], ' ') AS win
  FROM (SELECT item_id, ws, least(len(ws), 10) AS k, unnest(range(1, len(ws) - least(len(ws), 10) + 2)) AS i
        FROM b WHERE len(ws) > 0)
), dw AS (
  SELECT doc_id, i, k, array_to_string(ws[i:i + k - 1], ' ') AS win
  FROM (SELECT doc_id, ws, k, unnest(range(1, len(ws) - k + 2)) AS i
        FROM d, (SELECT DISTINCT k FROM iw) WHERE len(ws) >= k)
), m AS (SELECT doc_id, i, k, item_id FROM dw JOIN iw USING (k, win)),
h AS (
  SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + k)) AS p FROM m) GROUP BY 1
), t AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item_id::VARCHAR, ',' ORDER BY item_id::VARCHAR) AS ids
  FROM (SELECT DISTINCT doc_id, item_id FROM m) GROUP BY 1
)
SELECT doc_id, len(ws)::BIGINT AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(ids, '')) AS items_sha256, n_hit IS NOT NULL AS contaminated
FROM d LEFT JOIN h USING (doc_id) LEFT JOIN t USING (doc_id)
"""


@query
def op1_language_id(spark, sf_dir):
    remainder = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4
    return identify_languages(table(spark, sf_dir, "documents"), F.coalesce(remainder == 2, F.lit(False)))


@query
def op9_line_dedup(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return dedup_lines(docs).select("doc_id", "n_lines", "n_removed", "kept_sha256")


ORACLE["op9_line_dedup"] = f"""
WITH s AS (SELECT doc_id, text, string_split(text, chr(10)) AS lines FROM documents),
l AS (SELECT doc_id, unnest(lines) AS text, generate_subscripts(lines, 1) AS line FROM s),
e AS (
  SELECT doc_id, line, len(ws) AS n, array_to_string(ws, ' ') AS s
  FROM (SELECT doc_id, line, regexp_extract_all({LOWER}, {WORDS}) AS ws FROM l) WHERE len(ws) >= 5
), f AS (SELECT s, any_value(n) AS n, min((doc_id, line)) AS o FROM e GROUP BY s),
v AS (
  SELECT s, o, i, array_to_string(list_concat(ws[:i - 1], ws[i + 1:]), ' ') AS v
  FROM (SELECT s, o, string_split(s, ' ') AS ws, unnest(range(1, n + 1)) AS i FROM f WHERE n >= 8)
), near AS (
  SELECT a.s FROM v a JOIN (SELECT v, i, min(o) AS o FROM v GROUP BY v, i) b ON a.v = b.v AND a.i = b.i WHERE b.o < a.o
  UNION SELECT a.s FROM v a JOIN f b ON a.v = b.s WHERE b.n >= 8 AND b.o < a.o
  UNION SELECT b.s FROM v a JOIN f b ON a.v = b.s WHERE b.n >= 8 AND a.o < b.o
), gone AS (
  SELECT e.doc_id, e.line FROM e JOIN f USING (s)
  WHERE (e.doc_id, e.line) != f.o OR s IN (SELECT s FROM near)
)
SELECT s.doc_id, any_value(coalesce(len(s.lines), 0))::BIGINT AS n_lines, count(g.line) AS n_removed,
  sha256(coalesce(string_agg(l.text, chr(10) ORDER BY l.line) FILTER (g.line IS NULL), '')) AS kept_sha256
FROM s LEFT JOIN l ON l.doc_id = s.doc_id LEFT JOIN gone g ON g.doc_id = l.doc_id AND g.line = l.line
GROUP BY s.doc_id
"""


@query
def op6_warc(spark, sf_dir):
    folder = write_archives(table(spark, sf_dir, "pages"), scratch(spark, "archives"))
    return read_archives(spark, folder, with_payload=False).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


ORACLE["op6_warc"] = """
WITH p AS (
  SELECT page_id, encode(coalesce(html, '')) AS payload FROM pages
), k AS (
  SELECT payload, max(page_id) AS keeper FROM p WHERE octet_length(payload) >= 1000 GROUP BY payload
)
SELECT page_id, octet_length(p.payload)::BIGINT AS payload_bytes, sha1(p.payload) AS payload_digest,
  CASE WHEN keeper IS NOT NULL AND page_id != keeper THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN page_id != keeper THEN keeper END AS refers_to
FROM p LEFT JOIN k ON k.payload = p.payload
"""


@query
def op3_html_extraction(spark, sf_dir):
    return extract_main_text(table(spark, sf_dir, "pages"))


@query
def op7_secret_scan(spark, sf_dir):
    found = scan_secrets(table(spark, sf_dir, "documents"))
    base = F.filter("secrets", lambda s: s["kind"] != NOVEL)
    counts = [
        F.size(F.filter("secrets", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
        for kind in PATTERNS
    ]
    return found.select(
        "doc_id", *counts, F.sha2(span_text(base), 256).alias("base_sha256"),
        span_text(F.col("secrets")).alias("spans"))


def crc32_sql(text: str) -> str:
    """CRC-32 of an ASCII string, bit by bit: DuckDB has no function for it."""
    bits = f"list_transform(range(8 * length({text})), lambda i: (ascii({text}[i // 8 + 1]) >> (i % 8)) & 1)"
    step = "lambda c, b: xor(c >> 1, 3988292384 * (xor(c, b) & 1))"
    return f"xor(list_reduce(list_concat([4294967295::BIGINT], {bits}), {step}), 4294967295)"


@query
def op11_prefix_trie(spark, sf_dir):
    turns, lengths = numbered_turns(table(spark, sf_dir, "conversations"))
    return prefix_trie(*with_lent_openings(turns, lengths)).drop("node")


ORACLE["op11_prefix_trie"] = f"""
WITH t AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), md5(coalesce(text, ''))) AS i
  FROM conversations WHERE conv_id IS NOT NULL
), c AS (
  SELECT conv_id, n, conv_id - conv_id % 20 AS base,
    CASE WHEN conv_id % 20 = 0 THEN 0 ELSE {crc32_sql("name")} % 4 END AS h
  FROM (SELECT conv_id, conv_id::VARCHAR AS name, count(*) AS n FROM t GROUP BY 1, 2)
), p AS (
  SELECT c.*, least(c.h, coalesce(b.n, 0)) AS k FROM c LEFT JOIN c b ON b.conv_id = c.base
), s AS (
  SELECT p.conv_id, i - h + k AS d, role, text FROM p JOIN t USING (conv_id) WHERE i > h
  UNION ALL SELECT p.conv_id, i, role, text FROM p JOIN t ON t.conv_id = p.base WHERE h > 0 AND i <= k
), l AS (
  SELECT p.conv_id, coalesce(list(sha256(md5(role) || md5(text)) ORDER BY d) FILTER (d IS NOT NULL), []) AS keys,
    coalesce(list(len(regexp_extract_all(text, {WORDS})) ORDER BY d) FILTER (d IS NOT NULL), []) AS words
  FROM p LEFT JOIN s USING (conv_id) GROUP BY 1
), m AS (
  SELECT conv_id, d, len(keys) AS n, sha256(array_to_string(keys[1:d], '')) AS node,
    CASE WHEN d > 0 THEN sha256(array_to_string(keys[1:d - 1], '')) END AS up, CASE WHEN d > 0 THEN words[d] ELSE 0 END AS words
  FROM (SELECT conv_id, keys, words, unnest(range(len(keys) + 1)) AS d FROM l)
), v AS (
  SELECT d, node, any_value(up) AS up, min(conv_id) AS conv_id, count(*) AS n_convs, (count(*) - 1) * any_value(words) AS saved,
    coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (d = n), '') AS ends
  FROM m GROUP BY 1, 2
), k AS (
  SELECT v.*, coalesce(x.n, 0) AS n_children
  FROM v LEFT JOIN (SELECT up, d - 1 AS d, count(*) AS n FROM v WHERE d > 0 GROUP BY 1, 2) x ON x.up = v.node AND x.d = v.d
), below AS (
  SELECT DISTINCT a.d AS at_d, a.node AS at_node, b.d, b.node
  FROM v b JOIN m b1 ON b1.conv_id = b.conv_id AND b1.d = b.d JOIN m a ON a.conv_id = b.conv_id AND a.d <= b.d
), r AS (
  SELECT at_d, at_node, sum(CASE WHEN n_children = 0 THEN 1 ELSE 0 END) AS n_leaves, sum(saved) AS saved_tokens
  FROM below JOIN k ON k.d = below.d AND k.node = below.node GROUP BY 1, 2
)
SELECT k.conv_id, k.d::BIGINT AS depth, u.conv_id AS parent_conv_id, k.n_convs, k.n_children, n_leaves::BIGINT AS n_leaves,
  saved_tokens::BIGINT AS saved_tokens, sha256(k.ends) AS ends_sha256
FROM k JOIN r ON r.at_d = k.d AND r.at_node = k.node LEFT JOIN v u ON u.node = k.up AND u.d = k.d - 1
"""


@query
def op12_online_packing(spark, sf_dir):
    return pack_online(table(spark, sf_dir, "documents"), capacity=1024, with_ids=False, added=True)


@query
def op13_structure_repair(spark, sf_dir):
    return repair_conversations(damaged(read_rows(table(spark, sf_dir, "conversations"))))


ORACLE["op13_structure_repair"] = f"""
WITH RECURSIVE o AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS name
  FROM conversations
), w AS (SELECT *, {crc32_sql("name")} % 20 AS draw FROM o),
d AS (
  SELECT conv_id, turn, CASE WHEN draw = 4 THEN 'user' ELSE role END AS role,
    CASE draw WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, w.role, md5(w.text), copy) AS i
  FROM (SELECT *, unnest(CASE WHEN draw = 3 THEN [0, 1] ELSE [0] END) AS copy FROM w WHERE draw != 0) w
), f AS (
  SELECT *, CASE WHEN NOT regexp_matches(text, '[^\\x20\\x09-\\x0D]') THEN 'blank'
      WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 THEN 'duplicate'
      WHEN NOT regexp_matches(text, '[.!?][\\x20\\x09-\\x0D]*\\z') THEN 'truncated' ELSE 'none' END AS fault,
    left(role, 1) AS e, lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY i) AS e0
  FROM d
), q AS (
  SELECT conv_id, CASE WHEN count(turn) > 0 THEN max(turn) - min(turn) + 1 - count(DISTINCT turn) ELSE 0 END AS gaps,
    count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate,
    count(*) FILTER (fault = 'truncated') AS truncated,
    count(*) FILTER (e0 IS NOT NULL AND e0 || e NOT IN ('su', 'ua', 'au')) AS illegal, count(*) AS n
  FROM f GROUP BY conv_id
), g AS (  -- least (cost, edits) of a beginning that ends with nothing, s, u and a
  SELECT conv_id, 0::BIGINT AS i, {{'c': 0::BIGINT, 'a': ''}} AS n, {{'c': 1000000000::BIGINT, 'a': ''}} AS s,
    {{'c': 3::BIGINT, 'a': 'I'}} AS u, {{'c': 6::BIGINT, 'a': 'II'}} AS a
  FROM q
  UNION ALL
  SELECT conv_id, i, n, s, u, list_min([a, {{'c': u.c + 3, 'a': u.a || 'I'}}])
  FROM (
    SELECT conv_id, i, n, s, a, list_min([u, {{'c': n.c + 3, 'a': n.a || 'I'}}, {{'c': s.c + 3, 'a': s.a || 'I'}}, {{'c': a.c + 3, 'a': a.a || 'I'}}]) AS u
    FROM (
      SELECT p.conv_id, f.i, {{'c': p.n.c + 4, 'a': p.n.a || 'D'}} AS n,
        list_min([{{'c': p.s.c + 4, 'a': p.s.a || 'D'}}, {{'c': p.n.c + y + CASE WHEN e = 's' THEN 0 ELSE 1000000000 END, 'a': p.n.a || 'K'}}]) AS s,
        list_min([{{'c': p.u.c + 4, 'a': p.u.a || 'D'}}] || flatten(list_transform([p.n, p.s, p.a], lambda z: [
          {{'c': z.c + y + CASE WHEN e = 'u' THEN 0 ELSE 1000000000 END, 'a': z.a || 'K'}}, {{'c': z.c + y + 3, 'a': z.a || 'R'}}]))) AS u,
        list_min([{{'c': p.a.c + 4, 'a': p.a.a || 'D'}}, {{'c': p.u.c + y + CASE WHEN e = 'a' THEN 0 ELSE 1000000000 END, 'a': p.u.a || 'K'}},
          {{'c': p.u.c + y + 3, 'a': p.u.a || 'R'}}]) AS a
      FROM g p JOIN (SELECT *, CASE fault WHEN 'none' THEN 0 WHEN 'truncated' THEN 3 ELSE 1000000000 END AS y FROM f) f
        ON f.conv_id IS NOT DISTINCT FROM p.conv_id AND f.i = p.i + 1
    )
  )
), b AS (
  SELECT q.*, list_min([g.n, g.a]) AS best FROM q JOIN g ON g.conv_id IS NOT DISTINCT FROM q.conv_id AND g.i = q.n
), x AS (
  SELECT conv_id, k, substr(audit, k, 1) AS edit, length(replace(audit, 'D', '')) AS total,
    length(replace(left(audit, k), 'I', '')) AS i, length(replace(left(audit, k), 'D', '')) AS place
  FROM (SELECT conv_id, best.a AS audit, unnest(range(1, length(best.a) + 1)) AS k FROM b)
), z AS (
  SELECT x.conv_id, string_agg(CASE WHEN edit = 'K' THEN f.role WHEN place % 2 = total % 2 THEN 'assistant' ELSE 'user' END
    || ':' || CASE WHEN edit = 'I' THEN '' ELSE f.text END, chr(10) ORDER BY k) AS text
  FROM x LEFT JOIN f ON f.conv_id IS NOT DISTINCT FROM x.conv_id AND f.i = x.i AND edit != 'I' WHERE edit != 'D' GROUP BY 1
)
SELECT o.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
  coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, coalesce(best.c, 0)::BIGINT AS cost,
  coalesce(best.a, '') AS audit, sha256(coalesce(z.text, '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) o
LEFT JOIN b ON b.conv_id IS NOT DISTINCT FROM o.conv_id LEFT JOIN z ON z.conv_id IS NOT DISTINCT FROM o.conv_id
"""
