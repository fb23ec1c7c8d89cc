"""Registered queries of this subpackage, and the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tillbook.llm.byte_bpe import op1_byte_bpe
from tillbook.llm.class_lm import op6_class_lm
from tillbook.llm.infill import op13_infill
from tillbook.llm.jaccard import op7_jaccard_join
from tillbook.llm.licenses import op9_licenses
from tillbook.llm.lines import op8_line_dedup
from tillbook.llm.neighbours import op3_multiprobe
from tillbook.llm.quality import op2_quality
from tillbook.llm.repeats import op10_repeats
from tillbook.llm.templates import op4_templates
from tillbook.llm.token_planes import op5_token_planes
from tillbook.llm.toxicity import op11_toxicity
from tillbook.llm.tries import op12_burst_trie


Query = Callable[[SparkSession, str], DataFrame]


def registered() -> dict[str, Query]:
    found = [op1_byte_bpe, op5_token_planes, op6_class_lm, op10_repeats, op4_templates, op2_quality, op8_line_dedup, op7_jaccard_join, op3_multiprobe, op9_licenses, op11_toxicity, op12_burst_trie, op13_infill]
    return {f.__name__: f for f in found}


# Window by window: in which document it is first; windows that are earlier elsewhere, put together to spans; what lies between those.
_REPEATS_SQL = """
WITH docs AS (
  SELECT row_number() OVER () AS row_id, doc_id, hex(encode(coalesce(text, ''))) AS hx FROM documents
), windows AS (
  SELECT row_id, doc_id, pos, substr(hx, 2 * pos - 1, 100) AS w
  FROM docs, unnest(range(1, length(hx) // 2 - 48)) AS u(pos)
  WHERE doc_id IS NOT NULL
), firsts AS (
  SELECT w, min(doc_id) AS first_doc FROM windows GROUP BY w
), starts AS (
  SELECT row_id, pos, lag(pos) OVER (PARTITION BY row_id ORDER BY pos) AS before
  FROM windows JOIN firsts USING (w) WHERE first_doc < doc_id
), numbered AS (
  SELECT row_id, pos, count(*) FILTER (WHERE before IS NULL OR before < pos - 50) OVER (PARTITION BY row_id ORDER BY pos) AS span FROM starts
), spans AS (
  SELECT row_id, span, min(pos) AS a, max(pos) + 49 AS b FROM numbered GROUP BY row_id, span
), between_spans AS (
  SELECT row_id, a, b, lag(b, 1, 0) OVER (PARTITION BY row_id ORDER BY a) AS before FROM spans
), cut AS (
  SELECT row_id, count(*) AS n_spans, sum(b - a + 1) AS n_removed,
    string_agg(hx[2 * before + 1 : 2 * a - 2], '' ORDER BY a) || any_value(hx)[2 * max(b) + 1 :] AS kept
  FROM between_spans JOIN docs USING (row_id) GROUP BY row_id
)
SELECT doc_id, (length(hx) // 2)::BIGINT AS n_bytes, coalesce(n_removed, 0)::BIGINT AS n_removed, coalesce(n_spans, 0)::BIGINT AS n_spans,
  sha256(unhex(coalesce(kept, hx))) AS kept_sha256
FROM docs LEFT JOIN cut USING (row_id)
"""

# Sets of shingles, every pair of sets that shares one, and what is reached over the links.
_JACCARD_SQL = """
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') AS w
  FROM documents
), shingles AS (
  SELECT doc_id, list_sort(list_distinct(CASE WHEN len(w) >= 5 THEN list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i : i + 4], ' '))
    WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END)) AS s
  FROM words
), sets AS (
  SELECT row_number() OVER () AS node, s, len(s) AS n, count(*) AS docs, min(doc_id) AS first_doc FROM shingles GROUP BY s
), tokens AS (
  SELECT node, n, unnest(s) AS token FROM sets
), links AS (
  SELECT a.node AS a, b.node AS b FROM tokens a JOIN tokens b ON a.token = b.token AND a.node <> b.node
  GROUP BY a.node, b.node, a.n, b.n HAVING 5 * count(*) >= 4 * (a.n + b.n - count(*))
), reached AS (
  SELECT node, node AS other FROM sets
  UNION
  SELECT r.node, l.b FROM reached r JOIN links l ON r.other = l.a
), classes AS (
  SELECT r.node, min(s.first_doc) AS class_id FROM reached r JOIN sets s ON r.other = s.node GROUP BY r.node
), counts AS (
  SELECT l.a AS node, count(*) AS n_sets, sum(s.docs) AS n_docs FROM links l JOIN sets s ON l.b = s.node GROUP BY l.a
)
SELECT d.doc_id, c.class_id, (t.docs - 1 + coalesce(n.n_docs, 0))::BIGINT AS n_links, coalesce(n.n_sets, 0)::BIGINT AS n_linked_sets
FROM shingles d JOIN sets t ON d.s = t.s JOIN classes c USING (node) LEFT JOIN counts n USING (node)
"""


# CRC-32 of the id bit by bit; every rebuilt conversation as a list of turns; nodes are its first parts, joined below each other by the parts' parts.
_TRIE_SQL = r"""
WITH t AS (
  SELECT conv_id, struct_pack(r := coalesce(role, ''), x := coalesce(text, '')) AS v, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST) AS pos
  FROM conversations WHERE conv_id IS NOT NULL
), own AS (
  SELECT conv_id, list(v ORDER BY pos) AS vs FROM t GROUP BY conv_id
), sized AS (
  SELECT conv_id, vs, list_reduce(list_concat([4294967295::BIGINT], list_transform(string_split(conv_id::VARCHAR, ''), lambda ch: ascii(ch)::BIGINT)),
    lambda c, b: list_reduce(list_concat([xor(c, b)], [0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[]), lambda r, k: xor(r >> 1, 3988292384 * (r & 1)))) AS crc FROM own
), cut AS (
  SELECT conv_id, vs, xor(crc, 4294967295) % 4 AS h FROM sized
), built AS (
  SELECT c.conv_id, list_concat(coalesce(b.vs, [])[1:c.h], c.vs[c.h + 1:]) AS vs FROM cut c LEFT JOIN own b ON b.conv_id = c.conv_id - c.conv_id % 20
), steps AS (
  SELECT conv_id, d, vs[1:d] AS seq, len(vs) = d AS at_end FROM built, unnest(range(0, len(vs) + 1)) AS u(d)
), nodes AS (
  SELECT d AS depth, seq, min(conv_id) AS conv_id, count(*) AS n_convs,
    sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (WHERE at_end), '')) AS ends_sha256,
    CASE WHEN d = 0 THEN 0 ELSE (count(*) - 1) * len(regexp_extract_all(any_value(seq)[d].x, '[^\x20\x09-\x0D]+')) END AS saved
  FROM steps GROUP BY d, seq
), kids AS (
  SELECT p.depth, p.seq, count(k.depth) AS n_children FROM nodes p LEFT JOIN nodes k ON k.depth = p.depth + 1 AND k.seq[1:p.depth] = p.seq GROUP BY p.depth, p.seq
), below AS (
  SELECT n.seq[1:u.a] AS seq, u.a AS depth, sum(n.saved) AS saved_tokens, count(*) FILTER (WHERE k.n_children = 0) AS n_leaves
  FROM nodes n JOIN kids k USING (depth, seq), unnest(range(0, n.depth + 1)) AS u(a) GROUP BY 1, 2
)
SELECT n.conv_id, n.depth::BIGINT AS depth, p.conv_id AS parent_conv_id, n.n_convs::BIGINT AS n_convs, k.n_children::BIGINT AS n_children,
  b.n_leaves::BIGINT AS n_leaves, b.saved_tokens::BIGINT AS saved_tokens, n.ends_sha256
FROM nodes n JOIN kids k USING (depth, seq) JOIN below b USING (depth, seq) LEFT JOIN nodes p ON p.depth = n.depth - 1 AND p.seq = n.seq[1:n.depth - 1]
"""

# Substrings by code point; the parts put together again in the text's order.
_INFILL_SQL = """
WITH docs AS (
  SELECT doc_id, coalesce(text, '') AS t, length(coalesce(text, '')) AS n, sha256('1:' || coalesce(doc_id::VARCHAR, '')) AS hx FROM documents
), h AS (
  SELECT *, ('0x' || hx[1:8])::BIGINT % (n + 1) AS c1, ('0x' || hx[9:16])::BIGINT % (n + 1) AS c2, ('0x' || hx[17:24])::BIGINT % 100 AS h3, ('0x' || hx[25:32])::BIGINT % 100 AS h4 FROM docs
), forms AS (
  SELECT doc_id, t, n, least(c1, c2) AS a, greatest(c1, c2) AS b,
    CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h3 >= 90 THEN 'plain' WHEN h4 < 20 THEN 'spm' ELSE 'psm' END AS form FROM h
), parts AS (
  SELECT *, substr(t, 1, a) AS p, substr(t, a + 1, b - a) AS m, substr(t, b + 1) AS s FROM forms
)
SELECT doc_id, n::BIGINT AS n, form, CASE WHEN form <> 'plain' THEN a::BIGINT END AS prefix_chars, CASE WHEN form <> 'plain' THEN (b - a)::BIGINT END AS middle_chars,
  sha256(CASE form WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m WHEN 'spm' THEN '<S>' || s || '<P>' || p || '<M>' || m ELSE t END) AS output_sha256,
  sha256(p || m || s) AS restored_sha256
FROM parts
"""


def oracle_queries() -> dict[str, str]:
    """SQL of the queries whose exact rows SQL can give; the others are held against brute force in tests/llm."""
    return {"op10_repeats": _REPEATS_SQL, "op7_jaccard_join": _JACCARD_SQL, "op12_burst_trie": _TRIE_SQL, "op13_infill": _INFILL_SQL}
