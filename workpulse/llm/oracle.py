"""DuckDB SQL for the registered queries of this subpackage that SQL can express.

The other operators learn a model, align texts, hash with functions that DuckDB lacks or compress; tests
hold them against brute force, a library or held-out rows.
"""

from __future__ import annotations

from workpulse.llm.secrets import BASE_RULES, RULES, Rule


def _rule_spans(place: int, rule: Rule) -> str:
    """Rows (doc_id, kind, place, first, last) of one rule: a text is cut at its matches, and the lengths
    of what stands before a match add up to its offset."""
    # a maximal run of at least so many characters is asked for as such
    whole_run = rule.group == 0 and rule.pattern.endswith("]+") and rule.pattern.count("+") == 1
    least = f"{{{rule.least - rule.pattern.index('[')},}}" if whole_run else ""
    pattern = (rule.pattern[:-1] + least if whole_run else rule.pattern).replace("'", "''")
    return f"""
SELECT doc_id, '{rule.kind}' AS kind, {place} AS place, ahead + before AS first, ahead + before + size AS last
FROM (
  SELECT doc_id, tested, size, before,
         coalesce(SUM(before + size) OVER (PARTITION BY doc_id ORDER BY i
                                           ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS ahead
  FROM (
    SELECT doc_id, unnest(range(1, len(found) + 1)) AS i, length(unnest(pieces[1:len(found)])) AS before,
           length(unnest(found)) AS size, length(unnest(inner_found)) AS tested
    FROM (
      SELECT doc_id, regexp_split_to_array(t, '{pattern}') AS pieces,
             regexp_extract_all(t, '{pattern}', 0) AS found,
             regexp_extract_all(t, '{pattern}', {rule.group}) AS inner_found
      FROM texts WHERE regexp_matches(t, '{pattern}')
    ) cut
  ) lengths
) offsets WHERE tested >= {rule.least}"""


def secrets_sql() -> str:
    base = [rule.kind for rule in BASE_RULES]
    counts = ", ".join(f"CAST(COUNT(*) FILTER (kind = '{k}') AS BIGINT) AS n_{k}" for k in base)
    of_base = ", ".join(f"'{k}'" for k in base)
    listed = "string_agg(kind || ':' || CAST(first AS BIGINT) || ':' || CAST(last AS BIGINT), ',' ORDER BY first, place)"
    return f"""
WITH texts AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
spans AS ({" UNION ALL ".join(_rule_spans(place, rule) for place, rule in enumerate(RULES))})
SELECT d.doc_id, {counts},
       sha256(coalesce({listed} FILTER (kind IN ({of_base})), '')) AS base_sha256,
       coalesce({listed} FILTER (kind IS NOT NULL), '') AS spans
FROM texts d LEFT JOIN spans USING (doc_id) GROUP BY d.doc_id"""


def prefix_trie_sql() -> str:
    # crc32 from its definition: eight shifts for each byte
    crc = """xor(4294967295, list_reduce(
      list_prepend(4294967295::BIGINT, list_transform(string_split(conv_id::VARCHAR, ''), lambda s: ascii(s)::BIGINT)),
      lambda a, b: list_reduce(list_prepend(xor(a, b), list_transform(range(8), lambda z: 0::BIGINT)),
                               lambda x, y: xor(x >> 1, (x & 1) * 3988292384))))"""
    return f"""
WITH own AS (
  SELECT conv_id, ROW_NUMBER() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST) AS pos,
         sha256(coalesce(role, '') || chr(1) || coalesce(text, '')) AS said, length(coalesce(text, '')) AS chars
  FROM conversations WHERE conv_id IS NOT NULL
),
ids AS (SELECT conv_id, conv_id - conv_id % 100 AS opening, {crc} % 6 AS h FROM (SELECT DISTINCT conv_id FROM own)),
rebuilt AS (
  SELECT conv_id, ROW_NUMBER() OVER (PARTITION BY conv_id ORDER BY part, pos) - 1 AS depth, said, chars
  FROM (
    SELECT conv_id, 0 AS part, 0 AS pos, '' AS said, 0 AS chars FROM ids
    UNION ALL
    SELECT i.conv_id, 1, o.pos, o.said, o.chars FROM ids i JOIN own o ON o.conv_id = i.opening AND o.pos <= i.h
    UNION ALL
    SELECT o.conv_id, 2, o.pos, o.said, o.chars FROM own o JOIN ids i USING (conv_id) WHERE o.pos > i.h
  ) parts
),
members AS (
  SELECT conv_id, depth, chars, string_agg(said, '') OVER w AS path,
         LEAD(depth) OVER (PARTITION BY conv_id ORDER BY depth) IS NULL AS ends
  FROM rebuilt WINDOW w AS (PARTITION BY conv_id ORDER BY depth ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
),
nodes AS (
  SELECT path, depth, left(path, greatest(0, length(path) - 64)) AS above, MIN(conv_id) AS conv_id, COUNT(*) AS n_convs,
         MIN(chars) AS chars,
         sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (ends), '')) AS ends_sha256
  FROM members GROUP BY path, depth
),
children AS (SELECT above AS path, COUNT(*) AS n_children FROM nodes WHERE depth > 0 GROUP BY above),
whole AS (
  SELECT n.*, coalesce(c.n_children, 0) AS n_children, p.conv_id AS parent_conv_id
  FROM nodes n LEFT JOIN children c USING (path) LEFT JOIN nodes p ON n.depth > 0 AND p.path = n.above
),
subtrees AS (
  SELECT left(path, 64 * k) AS path, SUM((n_children = 0)::INT) AS n_leaves, SUM((n_convs - 1) * chars) AS saved_tokens
  FROM (SELECT path, n_children, n_convs, chars, unnest(range(0, depth + 1)) AS k FROM whole) up GROUP BY 1
)
SELECT conv_id, depth::BIGINT AS depth, parent_conv_id, n_convs::BIGINT AS n_convs, n_children::BIGINT AS n_children,
       n_leaves::BIGINT AS n_leaves, saved_tokens::BIGINT AS saved_tokens, ends_sha256
FROM whole JOIN subtrees USING (path)"""


def ranked_search_sql() -> str:
    found = r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"
    return f"""
WITH docs AS (SELECT ROW_NUMBER() OVER () AS row, doc_id, {found} AS terms FROM documents),
sizes AS (SELECT row, doc_id, len(terms)::BIGINT AS n FROM docs),
whole AS (SELECT COUNT(*) FILTER (n > 0)::BIGINT AS big_n, SUM(n)::BIGINT AS big_l FROM sizes),
items AS (SELECT ROW_NUMBER() OVER () AS item, item_id, {found} AS terms FROM benchmark),
asked AS (SELECT item, item_id, unnest(list_distinct(terms)) AS term FROM items),
freqs AS (
  SELECT row, term, COUNT(*)::BIGINT AS tf FROM (SELECT row, unnest(terms) AS term FROM docs) each
  WHERE term IN (SELECT term FROM asked) GROUP BY row, term
),
weights AS (
  SELECT term, floor(1000 * ln((2 * MIN(big_n) + 2)::DOUBLE / (2 * COUNT(*) + 1)::DOUBLE))::BIGINT AS w
  FROM freqs, whole GROUP BY term
),
scores AS (
  SELECT item, item_id, row, doc_id,
         SUM(w * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 90 + (90 * n * big_n) // big_l))))::BIGINT AS score
  FROM asked JOIN freqs USING (term) JOIN weights USING (term) JOIN sizes USING (row), whole
  GROUP BY item, item_id, row, doc_id
)
SELECT item_id, rank::INT AS rank, doc_id, score FROM (
  SELECT item_id, doc_id, score, ROW_NUMBER() OVER (PARTITION BY item ORDER BY score DESC, doc_id NULLS FIRST, row) AS rank
  FROM scores WHERE score > 0
) ranked WHERE rank <= 10"""


ORACLE: dict[str, str] = {
    "op1_secrets": secrets_sql(),
    "op12_prefix_trie": prefix_trie_sql(),
    "op13_ranked_search": ranked_search_sql(),
}
