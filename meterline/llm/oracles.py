"""SQL twins, for DuckDB, of the operators that SQL can express. They compare all rows with all rows."""

from __future__ import annotations

from meterline.llm import mixing
from meterline.llm.quality_rules import BASE, CURRENT, POLICIES, RULES

_W = r"[^\x20\x09-\x0D]"

EMBEDDING_DUPLICATES = """
WITH RECURSIVE v AS (
  SELECT vec_id, label, list_transform(embedding, lambda x: x::DOUBLE) AS e FROM embeddings
  WHERE label IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0
), links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
  WHERE list_cosine_similarity(a.e, b.e) >= 0.98
), reach AS (
  SELECT vec_id AS v, vec_id AS r FROM embeddings UNION SELECT l.a, reach.r FROM links l JOIN reach ON l.b = reach.v
)
SELECT vec_id, (SELECT COUNT(*) FROM links WHERE a = vec_id) AS n_links, least(MIN(r), vec_id) AS component_id,
       vec_id = least(MIN(r), vec_id) AS kept
FROM embeddings JOIN reach ON v = vec_id GROUP BY vec_id
"""


def near_duplicates(width: int, percent: int) -> str:
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    return f"""
WITH RECURSIVE d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{upper}', '{lower}'), '{_W}+') AS w FROM documents
), sets AS (
  SELECT DISTINCT doc_id, list_slice(w, i, i + {width - 1}) AS s
  FROM (SELECT doc_id, w, UNNEST(range(1, greatest(2, len(w) - {width - 2}))) AS i FROM d WHERE len(w) > 0)
), sizes AS (
  SELECT doc_id, COUNT(*) AS n FROM sets GROUP BY doc_id
), common AS (
  SELECT x.doc_id AS a, y.doc_id AS b, COUNT(*) AS c FROM sets x JOIN sets y ON x.s = y.s AND x.doc_id <> y.doc_id GROUP BY ALL
), links AS (
  SELECT a, b FROM common JOIN sizes p ON p.doc_id = a JOIN sizes q ON q.doc_id = b WHERE 100 * c >= {percent} * (p.n + q.n - c)
), reach AS (
  SELECT doc_id AS v, doc_id AS r FROM documents UNION SELECT l.a, reach.r FROM links l JOIN reach ON l.b = reach.v
), roots AS (
  SELECT v AS doc_id, MIN(r) AS component_id FROM reach GROUP BY v
)
SELECT doc_id, coalesce(n, 0) AS n_shingles, component_id, doc_id = component_id AS kept
FROM documents JOIN roots USING (doc_id) LEFT JOIN sizes USING (doc_id)
"""


def _quality_rules() -> str:
    bits = " + ".join(f"CASE WHEN {fails} THEN {1 << i} ELSE 0 END" for i, (_, fails) in enumerate(RULES))
    return f"""
WITH t AS (
  SELECT row_number() OVER () AS id, doc_id, coalesce(text, '') AS text FROM documents
), d AS (
  SELECT *, regexp_extract_all(text, '{_W}+') AS w, list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '{_W}')) AS lines FROM t
), windows AS (
  SELECT id, i, list_slice(w, i, i + 4) AS g FROM (SELECT id, w, UNNEST(range(1, greatest(1, len(w) - 3))) AS i FROM d)
), often AS (
  SELECT id, i, COUNT(*) OVER (PARTITION BY id, g) AS c FROM windows
), repeated AS (
  SELECT id, COUNT(DISTINCT i + k) AS n FROM often, range(5) AS r(k) WHERE c > 1 GROUP BY id
), m AS (
  SELECT d.doc_id, len(w) AS n_words, length(array_to_string(w, '')) AS word_chars,
    length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS n_symbols, len(lines) - len(list_distinct(lines)) AS n_dup_lines,
    coalesce(n, 0) AS n_repeat_words, len(lines) AS n_lines,
    len(list_filter(w, lambda x: regexp_matches(x, '[A-Z]') AND NOT regexp_matches(x, '[a-z]'))) AS n_upper_words,
    len(list_filter(range(1, len(w)), lambda i: w[i] = w[i + 1])) AS n_adjacent,
    (length(text) - length(replace(text, '!! ', ''))) // 3 + CASE WHEN ends_with(text, '!!') THEN 1 ELSE 0 END AS n_exclaimed
  FROM d LEFT JOIN repeated USING (id)
), f AS (
  SELECT *, CAST({bits} AS BIGINT) AS failed FROM m
)
SELECT doc_id, CAST(n_words AS BIGINT) AS n_words, CAST(word_chars AS BIGINT) AS word_chars, CAST(n_symbols AS BIGINT) AS n_symbols,
       CAST(n_dup_lines AS BIGINT) AS n_dup_lines, CAST(n_repeat_words AS BIGINT) AS n_repeat_words,
       (failed & {BASE}) <> 0 AS base_failed, (failed & {POLICIES[CURRENT]}) = 0 AS kept, failed
FROM f
"""


def _merkle(levels: int = 8, top_levels: int = 4) -> str:
    """Levels enough for 8 ** levels rows of a language and 8 ** top_levels languages; a level above the root changes nothing."""
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    fields = [f"coalesce(strlen({c}::VARCHAR) || ':' || {c}::VARCHAR, '-')" for c in ("doc_id", "source", "lang", "n_chars", "text")]
    leaf = f"sha256({' || '.join(fields)})"
    claim = leaf.replace("text::VARCHAR", f"translate(text, '{upper}', '{lower}')")
    # a byte is exclusive-ored in (items from 0), then eight bits are shifted out (items -1)
    crc = (
        "xor(list_reduce(list_prepend(4294967295::BIGINT, flatten(list_transform(range(1, len(doc_id::VARCHAR) + 1),"
        " lambda i: list_concat([unicode((doc_id::VARCHAR)[i])::BIGINT], list_transform(range(8), lambda j: -1::BIGINT))))),"
        " lambda c, x: CASE WHEN x >= 0 THEN xor(c, x) ELSE xor(c >> 1, 3988292384::BIGINT * (c & 1)) END), 4294967295::BIGINT)"
    )
    parts = [
        f"""WITH d AS MATERIALIZED (
  SELECT doc_id, t, row_number() OVER (PARTITION BY t ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos, leaf,
    CASE WHEN {crc} % 3 = 0 THEN claim ELSE leaf END AS claim
  FROM (SELECT doc_id, dense_rank() OVER (ORDER BY lang NULLS FIRST) - 1 AS t, {leaf} AS leaf, {claim} AS claim FROM documents)
), n0 AS MATERIALIZED (SELECT t, pos, leaf AS node, COUNT(*) OVER (PARTITION BY t) AS n FROM d),
w0 AS MATERIALIZED (SELECT doc_id, t, pos, leaf, claim AS f, '' AS proof FROM d)"""
    ]
    run = "OVER (PARTITION BY t, pos // 8 ORDER BY pos ROWS BETWEEN"
    total = levels + top_levels
    for k in range(total):
        again = k == levels - 1  # what is left of each language becomes a node of the last tree
        tree = "0" if again else "t"
        parts.append(
            f"""p{k} AS MATERIALIZED (
  SELECT t, pos, n, coalesce(string_agg(node, '') {run} UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS l,
    coalesce(string_agg(node, '') {run} 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS r FROM n{k}
), w{k + 1} AS MATERIALIZED (
  SELECT doc_id, {tree if again else 'w.t'} AS t, {'w.t' if again else 'w.pos // 8'} AS pos, leaf, CASE WHEN n > 1 THEN sha256(l || f || r) ELSE f END AS f,
    CASE WHEN n > 1 THEN proof || l || r ELSE proof END AS proof{', w.t AS lang_no' if again else ', lang_no' if k >= levels else ''}
  FROM w{k} w JOIN p{k} p ON p.t = w.t AND p.pos = w.pos
), m{k + 1} AS MATERIALIZED (
  SELECT t, pos // 8 AS pos, CASE WHEN MAX(n) > 1 THEN sha256(string_agg(node, '' ORDER BY pos)) ELSE MAX(node) END AS node FROM n{k} GROUP BY t, pos // 8
), n{k + 1} AS MATERIALIZED (SELECT t, pos, node, COUNT(*) OVER (PARTITION BY t) AS n FROM (SELECT {tree} AS t, {'t' if again else 'pos'} AS pos, node FROM m{k + 1}))"""
        )
    return (
        ",\n".join(parts)
        + f"""
SELECT doc_id, leaf, s.node AS subroot, top.node AS root, sha256(proof) AS proof_sha256, f AS folded_root, f = top.node AS verified
FROM w{total} JOIN n{levels} s ON s.pos = lang_no CROSS JOIN n{total} top
"""
    )


HARD_NEGATIVES = """
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS q
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT a.vec_id AS anchor_id, b.vec_id AS other_id, a.label = b.label AS same,
    CASE WHEN len(a.q) = 0 THEN 0 ELSE list_inner_product(a.q, b.q) END::BIGINT AS score
  FROM v a JOIN v b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id AND len(a.q) = len(b.q)
), positives AS (
  SELECT anchor_id, other_id AS positive_id, score AS positive_score FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) <= 5
)
SELECT anchor_id, positive_id, CAST(row_number() OVER best AS INT) AS rank, other_id AS negative_id, positive_score, score AS negative_score
FROM positives JOIN scored USING (anchor_id)
WHERE NOT same AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score
WINDOW best AS (PARTITION BY anchor_id, positive_id ORDER BY score DESC, other_id)
QUALIFY rank <= 10
"""

ORACLES: dict[str, str] = {
    "op1_embedding_duplicates": EMBEDDING_DUPLICATES,
    "op4_quality_rules": _quality_rules(),
    "op7_near_duplicates": near_duplicates(3, 85),
    "op8_mixing": mixing.ORACLE,
    "op11_hard_negatives": HARD_NEGATIVES,
    "op13_manifest": _merkle(),
}
