"""The same results in DuckDB's SQL, for the operators that have such a form."""

from __future__ import annotations

SMALL = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

RANKED_SEARCH = rf"""
WITH words AS (
    SELECT doc_id, r, unnest(regexp_extract_all({SMALL.format("text")}, '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
    FROM (SELECT doc_id, text, row_number() OVER () AS r FROM documents)
),
held AS (SELECT r, doc_id, term, count(*) AS tf FROM words GROUP BY ALL),
sizes AS (SELECT r, sum(tf) AS n FROM held GROUP BY r),
totals AS (SELECT count(*) AS n_docs, CAST(sum(n) AS BIGINT) AS n_terms FROM sizes),
weights AS (
    SELECT term, CAST(floor(1000 * ln((2 * max(n_docs) + 2) / (2 * count(*) + 1))) AS BIGINT) AS w
    FROM held, totals GROUP BY term
),
gains AS (
    SELECT held.r, doc_id, term, w * ((1000000000 * tf) // (1000 * tf + 12 * (100 - 25 + ((25 * n * n_docs) // n_terms)))) AS gain
    FROM held JOIN sizes USING (r) JOIN weights USING (term), totals
),
asked AS (
    SELECT i, item_id, unnest(regexp_extract_all({SMALL.format("text")}, '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
    FROM (SELECT item_id, text, row_number() OVER () AS i FROM benchmark)
),
scores AS (
    SELECT i, item_id, r, doc_id, CAST(sum(gain) AS BIGINT) AS score
    FROM asked JOIN gains USING (term) GROUP BY i, item_id, r, doc_id HAVING sum(gain) > 0
)
SELECT item_id, CAST(row_number() OVER (PARTITION BY i ORDER BY score DESC, doc_id NULLS FIRST) AS INTEGER) AS rank, doc_id, score
FROM scores QUALIFY rank <= 20"""

LINE_DEDUP = f"""
WITH split AS (
    SELECT row_number() OVER () AS r, doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents
),
numbered AS (SELECT r, doc_id, unnest(lines) AS line, unnest(range(len(lines))) AS line_no FROM split),
keyed AS (
    SELECT *, {SMALL.format("trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13))")} AS key FROM numbered
),
frequent AS (SELECT key FROM keyed WHERE key <> '' GROUP BY key HAVING count(DISTINCT r) >= 10)
SELECT doc_id, count(*) AS n_lines, count(frequent.key) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY line_no) FILTER (WHERE frequent.key IS NULL), '')) AS kept_sha256
FROM keyed LEFT JOIN frequent ON keyed.key = frequent.key GROUP BY r, doc_id"""


def _trees(name: str, levels: int) -> str:
    """Levels of trees over `<name>0(tree, idx, n, node)`, and each level's runs. Complete to 8 to the power `levels`."""
    steps = []
    for i in range(levels):
        steps.append(f"""{name}_runs{i} AS (
    SELECT tree, idx // 8 AS run, n, list(node ORDER BY idx) AS nodes FROM {name}{i} GROUP BY tree, idx // 8, n
)""")
        steps.append(f"""{name}{i + 1} AS (
    SELECT tree, run AS idx, (n + 7) // 8 AS n,
           CASE WHEN n > 1 THEN sha256(array_to_string(nodes, '')) ELSE nodes[1] END AS node
    FROM {name}_runs{i}
)""")
    return ",\n".join(steps)


def _paths(name: str, source: str, tree: str, idx: str, levels: int) -> str:
    """Rows of `source` with `own` folded up the trees and the siblings met on the way added to `met`."""
    steps, before = [], source
    for i in range(levels):
        digit = f"CAST(p.{idx} // {8**i} % 8 AS BIGINT)"
        left, right = f"array_to_string(nodes[1:{digit}], '')", f"array_to_string(nodes[{digit} + 2:], '')"
        steps.append(f"""{name}{i} AS (
    SELECT p.* EXCLUDE (own, met),
           CASE WHEN r.n > 1 THEN sha256({left} || own || {right}) ELSE own END AS own,
           CASE WHEN r.n > 1 THEN met || {left} || {right} ELSE met END AS met
    FROM {before} AS p JOIN {name[:-5]}_runs{i} AS r ON p.{tree} = r.tree AND p.{idx} // {8 ** (i + 1)} = r.run
)""")
        before = f"{name}{i}"
    return ",\n".join(steps)


def merkle(levels: int = 7, top_levels: int = 2) -> str:
    def field(value: str) -> str:
        return f"coalesce(CAST(strlen(CAST({value} AS VARCHAR)) AS VARCHAR) || ':' || CAST({value} AS VARCHAR), '-')"

    def leaf(text: str) -> str:
        return "sha256(" + " || ".join(field(x) for x in ("doc_id", "source", "lang", "n_chars", text)) + ")"

    codes = "list_transform(string_split(coalesce(CAST(doc_id AS VARCHAR), ''), ''), lambda c: CAST(ascii(c) AS BIGINT))"
    shifted = "list_reduce(list_prepend(xor(crc, code), range(8)), lambda x, i: xor(x >> 1, (x & 1) * 3988292384))"
    crc = f"xor(list_reduce(list_prepend(4294967295, {codes}), lambda crc, code: {shifted}), 4294967295)"
    return f"""
WITH leaves AS (
    SELECT doc_id, lang, {leaf("text")} AS leaf, CASE WHEN {crc} % 3 = 0 THEN {leaf(SMALL.format("text"))} ELSE {leaf("text")} END AS tampered
    FROM documents
),
langs AS (SELECT lang, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS tree, count(*) AS n FROM leaves GROUP BY lang),
placed AS (
    SELECT doc_id, leaf, tampered AS own, '' AS met, tree, n, 0 AS top,
           row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS idx
    FROM leaves JOIN langs ON leaves.lang IS NOT DISTINCT FROM langs.lang
),
low0 AS (SELECT tree, idx, n, leaf AS node FROM placed),
{_trees("low", levels)},
top0 AS (SELECT 0 AS tree, tree AS idx, (SELECT count(*) FROM langs) AS n, node FROM low{levels}),
{_trees("top", top_levels)},
{_paths("low_path", "placed", "tree", "idx", levels)},
{_paths("top_path", f"low_path{levels - 1}", "top", "tree", top_levels)}
SELECT doc_id, leaf, sub.node AS subroot, root.node AS root, sha256(met) AS proof_sha256, own AS folded_root, own = root.node AS verified
FROM top_path{top_levels - 1} AS p JOIN low{levels} AS sub USING (tree), top{top_levels} AS root"""


ORACLES = {"op11_ranked_search": RANKED_SEARCH, "op12_line_dedup": LINE_DEDUP, "op13_merkle_manifest": merkle()}
