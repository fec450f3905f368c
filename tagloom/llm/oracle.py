"""DuckDB SQL of the queries that SQL can express."""

from __future__ import annotations

from tagloom.llm.licenses import AGREEING, TEMPLATES, THRESHOLD, WHOLE

#: A window is 10 consecutive words of an item, or all of a shorter one's.
_DECONTAMINATION = r"""
WITH doc AS (
    SELECT doc_id, row_number() OVER () AS r,
        regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
    FROM documents
), item AS (
    SELECT CAST(item_id AS VARCHAR) AS item,
        regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
    FROM benchmark
), known AS (
    SELECT DISTINCT item, least(10, len(w)) AS n, array_to_string(w[i : i + least(10, len(w)) - 1], ' ') AS words
    FROM (SELECT item, w, unnest(range(1, greatest(2, len(w) - 8))) AS i FROM item WHERE len(w) > 0)
), place AS (
    SELECT r, w, n, unnest(range(1, len(w) - n + 2)) AS i
    FROM doc, (SELECT DISTINCT n FROM known) WHERE len(w) >= n
), hit AS (
    SELECT p.r, p.i, p.n, k.item FROM place p JOIN known k
    ON k.n = p.n AND k.words = array_to_string(p.w[p.i : p.i + p.n - 1], ' ')
), marked AS (
    SELECT r, count(DISTINCT place) AS n FROM (SELECT r, unnest(range(i, i + n)) AS place FROM hit) GROUP BY r
), named AS (
    SELECT r, count(*) AS n, string_agg(item, ',' ORDER BY item) AS items
    FROM (SELECT DISTINCT r, item FROM hit WHERE item IS NOT NULL) GROUP BY r
)
SELECT doc_id, len(w) AS n_words, coalesce(m.n, 0) AS n_hit, coalesce(i.n, 0) AS n_items,
    sha256(coalesce(items, '')) AS items_sha256, coalesce(m.n, 0) > 0 AS contaminated
FROM doc LEFT JOIN marked m USING (r) LEFT JOIN named i USING (r)
"""

_TOP_K = """
WITH v AS (
    SELECT DISTINCT vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS e
    FROM embeddings
    WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
        AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
    SELECT q.vec_id AS query_id, c.vec_id,
        CAST(coalesce(list_sum(list_transform(list_zip(q.e, c.e), lambda p: p[1] * p[2])), 0) AS BIGINT) AS score
    FROM v q, v c WHERE q.vec_id % 100 = 0 AND c.vec_id != q.vec_id AND len(c.e) = len(q.e)
), ranked AS (
    SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM scored
)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 10
"""


def _licenses() -> str:
    rows = ", ".join(
        f"({k}, {k >= len(TEMPLATES)}, '{name}', '{text.lower().replace(chr(39), chr(39) * 2)}')"
        for k, (name, text) in enumerate(TEMPLATES + WHOLE)
    )
    return f"""
WITH template(k, whole, license, text) AS (VALUES {rows}),
doc AS (
    SELECT row_number() OVER () AS r, doc_id, lower(text) AS text,
        CASE WHEN doc_id % 1000 = 0 THEN concat_ws('/', CAST(doc_id // 1000 AS VARCHAR), 'LICENSE')
            WHEN doc_id % 100 = 0 THEN concat_ws('/', CAST(doc_id // 1000 AS VARCHAR), CAST(doc_id // 100 AS VARCHAR), 'LICENSE')
            WHEN doc_id IS NOT NULL THEN concat_ws('/', CAST(doc_id // 1000 AS VARCHAR), CAST(doc_id // 100 AS VARCHAR),
                coalesce(lang, 'unknown'), coalesce(source, 'unknown'), CAST(doc_id AS VARCHAR) || '.txt') END AS path
    FROM documents
), template_tf AS (
    SELECT k, whole, license, term, count(*) AS tf
    FROM (SELECT k, whole, license, unnest(regexp_extract_all(text, '[a-z0-9]+')) AS term FROM template) GROUP BY ALL
), frequency AS (
    SELECT term, count(*) AS df
    FROM (SELECT DISTINCT r, unnest(regexp_extract_all(text, '[a-z0-9]+')) AS term FROM doc)
    WHERE term IN (SELECT term FROM template_tf) GROUP BY term
), size AS (SELECT count(*) AS n FROM doc),
idf AS (
    SELECT DISTINCT t.term, ln((1 + n) / (1 + coalesce(df, 0))) + 1 AS idf
    FROM template_tf t CROSS JOIN size LEFT JOIN frequency f ON f.term = t.term
), template_weight AS (
    SELECT k, whole, license, term, tf * idf / sqrt(sum((tf * idf) ** 2) OVER (PARTITION BY k)) AS weight
    FROM template_tf JOIN idf USING (term)
), prefix AS (
    SELECT k, term FROM (
        SELECT k, term, 1 - coalesce(sum(weight ** 2) OVER (PARTITION BY k ORDER BY weight DESC, term DESC
            ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS rest FROM template_weight WHERE NOT whole)
    WHERE rest >= {THRESHOLD} ** 2
), place AS (
    SELECT k, term, q, count(*) OVER (PARTITION BY k) AS places, size
    FROM (SELECT k, unnest(t) AS term, generate_subscripts(t, 1) - 1 AS q, len(t) AS size
        FROM (SELECT k, regexp_extract_all(text, '[a-z0-9]+') AS t FROM template WHERE NOT whole)) JOIN prefix USING (k, term)
), word AS (
    SELECT r, unnest(t) AS term, generate_subscripts(t, 1) - 1 AS p, len(t) AS n_words
    FROM (SELECT r, regexp_extract_all(text, '[a-z0-9]+') AS t FROM doc)
), start AS (
    SELECT r, k, p - q AS start, any_value(size) AS size FROM word JOIN place USING (term)
    WHERE p >= q AND p - q + size <= n_words GROUP BY r, k, p - q HAVING count(*) >= least({AGREEING}, any_value(places))
), line AS (
    SELECT r, unnest(string_split(text, chr(10))) AS text, generate_subscripts(string_split(text, chr(10)), 1) AS line_no FROM doc
), bag AS (
    SELECT r, 'line' AS kind, line_no AS number, -1 AS own, term, count(*) AS tf
    FROM (SELECT r, line_no, unnest(regexp_extract_all(text, '[a-z0-9]+')) AS term FROM line) GROUP BY ALL
    UNION ALL
    SELECT s.r, 'window', start, k, term, count(*) FROM start s JOIN word w ON w.r = s.r AND p >= start AND p < start + size
    GROUP BY ALL
    UNION ALL
    SELECT r, 'whole', 0, -1, term, count(*) FROM word JOIN doc USING (r) WHERE regexp_matches(path, '(^|/)LICENSE$') GROUP BY ALL
), weighed AS (
    SELECT r, kind, number, own, term, tf * coalesce(idf, ln((1 + n) / 1) + 1) AS w
    FROM bag CROSS JOIN size LEFT JOIN idf USING (term)
), norm AS (SELECT r, kind, number, own, sqrt(sum(w * w)) AS norm FROM weighed GROUP BY ALL),
close AS (
    SELECT r, license, round(sum(w * weight) / any_value(norm), 9) AS similarity
    FROM weighed JOIN template_weight t USING (term) JOIN norm USING (r, kind, number, own)
    WHERE whole = (kind = 'whole') AND (own = -1 OR own = k)
    GROUP BY r, kind, number, own, k, license HAVING sum(w * weight) / any_value(norm) >= {THRESHOLD}
), own AS (
    SELECT r, license FROM close QUALIFY row_number() OVER (PARTITION BY r ORDER BY similarity DESC, license) = 1
), marked AS (
    SELECT doc.r, doc_id, path, regexp_replace(path, '/[^/]*$', '') AS dir, license
    FROM doc LEFT JOIN own ON own.r = doc.r
), licensed AS (
    SELECT dir, min(license) AS license FROM marked
    WHERE license IS NOT NULL AND regexp_matches(path, '(^|/)LICENSE$') GROUP BY dir
), found AS (
    SELECT m.r, l.license, len(string_split(m.dir, '/')) - len(string_split(l.dir, '/')) AS levels
    FROM marked m JOIN licensed l ON m.dir = l.dir OR starts_with(m.dir, l.dir || '/')
    WHERE m.license IS NULL QUALIFY row_number() OVER (PARTITION BY m.r ORDER BY len(l.dir) DESC) = 1
)
SELECT doc_id, path, coalesce(m.license, f.license) AS license,
    CASE WHEN m.license IS NOT NULL THEN 'header' WHEN f.license IS NOT NULL THEN 'inherited' END AS origin,
    CAST(f.levels AS INTEGER) AS levels
FROM marked m LEFT JOIN found f USING (r)
"""


#: Levels of runs of eight in the SQL of the manifest: 8^8 rows of a language, 8^3 languages.
_LEAF_LEVELS, _GROUP_LEVELS = 8, 3


def _tree(nodes: str, levels: int, name: str) -> str:
    """CTEs {name}0 to {name}N, the nodes (tree, pos, h, n) of each level over those of `nodes`, and near_{name}K with the
    joined siblings before and after each node. A tree with one node left keeps it."""
    parts = [f"{name}0 AS MATERIALIZED (SELECT tree, pos, h, n FROM {nodes})"]
    for k in range(levels):
        parts.append(f"""near_{name}{k} AS MATERIALIZED (
    SELECT a.tree, a.pos, any_value(a.n) AS n, coalesce(string_agg(b.h, '' ORDER BY b.pos) FILTER (b.pos < a.pos), '') AS before,
        coalesce(string_agg(b.h, '' ORDER BY b.pos) FILTER (b.pos > a.pos), '') AS after
    FROM {name}{k} a JOIN {name}{k} b ON a.tree = b.tree AND a.pos // 8 = b.pos // 8 GROUP BY a.tree, a.pos
)""")
        parts.append(f"""{name}{k + 1} AS MATERIALIZED (
    SELECT tree, pos // 8 AS pos, CASE WHEN n > 1 THEN sha256(string_agg(h, '' ORDER BY pos)) ELSE any_value(h) END AS h,
        (n + 7) // 8 AS n
    FROM {name}{k} GROUP BY tree, pos // 8, n
)""")
    return ", ".join(parts)


def _manifest() -> str:
    def field(c: str) -> str:
        return f"coalesce(strlen(CAST({c} AS VARCHAR)) || ':' || CAST({c} AS VARCHAR), '-')"

    def leaf(text: str) -> str:
        return "sha256(" + " || ".join(map(field, ("doc_id", "source", "lang", "n_chars", text))) + ")"

    def climb(start: str, keys: str, tree: str, pos: str, name: str, levels: int) -> str:
        """CTEs that fold `cur` level by level and gather `proof`; the last is {name}_done."""
        parts, before = [], start
        for k in range(levels):
            after = f"{name}_done" if k == levels - 1 else f"{name}_{k}"
            parts.append(f"""{after} AS MATERIALIZED (
    SELECT {keys}, proof || before || after AS proof, CASE WHEN m.n > 1 THEN sha256(before || cur || after) ELSE cur END AS cur
    FROM {before} p JOIN near_{name}{k} m ON m.tree = p.{tree} AND m.pos = p.{pos} // {8**k}
)""")
            before = after
        return ", ".join(parts)

    lower = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    return f"""
WITH crc AS (
    SELECT list(list_reduce(list_concat([i], [0, 0, 0, 0, 0, 0, 0, 0]),
        lambda c, z: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) ORDER BY i) AS t
    FROM (SELECT unnest(range(256)) AS i)
), doc AS (
    SELECT *, xor(list_reduce(list_concat([4294967295], list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda x: ascii(x))),
        lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295) % 3 = 0 AS hit
    FROM documents, crc
), leaf AS MATERIALIZED (
    SELECT doc_id, coalesce('+' || lang, '') AS tree, {leaf('text')} AS h,
        CASE WHEN hit THEN {leaf(lower)} ELSE {leaf('text')} END AS changed FROM doc
), placed AS MATERIALIZED (
    SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, h) - 1 AS pos, count(*) OVER (PARTITION BY tree) AS n
    FROM leaf
), {_tree("placed", _LEAF_LEVELS, "x")}, subroot AS MATERIALIZED (
    SELECT tree AS lang, h, row_number() OVER (ORDER BY encode(tree)) - 1 AS pos, count(*) OVER () AS n, 0 AS tree FROM x{_LEAF_LEVELS}
), {_tree("subroot", _GROUP_LEVELS, "y")}, start AS (
    SELECT doc_id, tree, pos, h AS leaf, '' AS proof, changed AS cur FROM placed
), {climb("start", "doc_id, leaf, p.tree, p.pos", "tree", "pos", "x", _LEAF_LEVELS)}, upper AS (
    SELECT d.doc_id, d.leaf, s.h AS subroot, 0 AS tree, s.pos, d.proof, d.cur FROM x_done d JOIN subroot s ON s.lang = d.tree
), {climb("upper", "doc_id, leaf, subroot, p.tree, p.pos", "tree", "pos", "y", _GROUP_LEVELS)}
SELECT doc_id, leaf, subroot, r.h AS root, sha256(proof) AS proof_sha256, cur AS folded_root, cur = r.h AS verified
FROM y_done, y{_GROUP_LEVELS} r
"""


SQL: dict[str, str] = {
    "op1_vector_topk": _TOP_K,
    "op6_license_scans": _licenses(),
    "op8_decontamination": _DECONTAMINATION,
    "op12_merkle_manifest": _manifest(),
}
