"""DuckDB statements of the queries that SQL can express."""

from __future__ import annotations

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_SPACE_WORDS = rf"regexp_extract_all({_LOWER}, '[^\x20\x09-\x0D]+')"
_ALNUM_WORDS = rf"regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

JACCARD_JOIN = f"""
WITH RECURSIVE w AS (SELECT doc_id, {_SPACE_WORDS} AS w FROM documents),
s AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) >= 3 THEN list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])
                                          WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS g FROM w),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY ALL),
l AS (SELECT x, y FROM p JOIN n nx ON nx.doc_id = x JOIN n ny ON ny.doc_id = y WHERE 100 * c >= 90 * (nx.n + ny.n - c)),
r(doc_id, root) AS (SELECT doc_id, doc_id FROM documents UNION SELECT l.y, r.root FROM r JOIN l ON l.x = r.doc_id)
SELECT doc_id, coalesce(n, 0) AS n_shingles, component_id
FROM (SELECT doc_id, min(root) AS component_id FROM r GROUP BY doc_id) c LEFT JOIN n USING (doc_id)"""

DECONTAMINATION = f"""
WITH b AS (SELECT DISTINCT item_id, {_ALNUM_WORDS} AS w FROM benchmark),
g AS (SELECT DISTINCT cast(item_id AS VARCHAR) AS item, least(13, len(w)) AS n,
             unnest(list_transform(range(1, len(w) - least(13, len(w)) + 2), lambda i: array_to_string(w[i:i + least(13, len(w)) - 1], ' '))) AS words
      FROM b WHERE len(w) > 0),
d AS (SELECT doc_id, {_ALNUM_WORDS} AS w FROM documents),
e AS (SELECT doc_id, n, unnest(range(1, len(w) - n + 2)) AS pos, w FROM d, (SELECT DISTINCT n FROM g) z WHERE len(w) >= n),
h AS (SELECT doc_id, pos, n, item FROM (SELECT doc_id, n, pos, array_to_string(w[pos:pos + n - 1], ' ') AS words FROM e) x JOIN g USING (n, words)),
k AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(pos, pos + n)) AS p FROM (SELECT DISTINCT doc_id, pos, n FROM h) y) q GROUP BY doc_id),
i AS (SELECT doc_id, count(DISTINCT item) AS n_items, string_agg(DISTINCT item, ',' ORDER BY item) AS items FROM h GROUP BY doc_id)
SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(items, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN k USING (doc_id) LEFT JOIN i USING (doc_id)"""

CHAT_FORMAT = r"""
WITH c AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
           UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok' UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok')
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
       cast(coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
       cast(sum(length('<turn><text></turn>') + 3 * length(role || text) - length(replace(role || text, '\', '')) - length(replace(role || text, '<', ''))) AS BIGINT)
         AS formatted_chars
FROM c GROUP BY conv_id"""

SUBSTRING_DEDUP = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
g AS (SELECT doc_id, unnest(range(1, len(w) - 48)) AS p, w FROM d WHERE len(w) >= 50),
h AS (SELECT doc_id, p, md5(array_to_string(w[p:p + 49], ' ')) AS t FROM g),
f AS (SELECT t, min(doc_id) AS first FROM h GROUP BY t),
r AS (SELECT DISTINCT doc_id, unnest(range(p, p + 50)) AS q FROM (SELECT doc_id, p FROM h JOIN f USING (t) WHERE first < doc_id) x),
e AS (SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS q FROM d),
k AS (SELECT doc_id, count(*) AS n, string_agg(word, ' ' ORDER BY q) AS kept FROM e ANTI JOIN r USING (doc_id, q) GROUP BY doc_id)
SELECT doc_id, len(w) AS n_words, len(w) - coalesce(n, 0) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256 FROM d LEFT JOIN k USING (doc_id)"""

DIVERGENCE = r"""
WITH d AS (SELECT coalesce(lang, '') AS lang, coalesce(source, '') AS source,
                  regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM documents),
k AS (SELECT lang, t FROM (SELECT lang, unnest(list_distinct(w)) AS t FROM d) u GROUP BY ALL HAVING count(*) >= 10),
c AS (SELECT lang, source, t, count(*) AS n FROM (SELECT lang, source, unnest(w) AS t FROM d) u SEMI JOIN k USING (lang, t) GROUP BY ALL),
v AS (SELECT lang, count(*) AS v FROM k GROUP BY lang),
g AS (SELECT e.lang, e.source, coalesce(s.total, 0) AS total, coalesce(v.v, 0) AS v FROM (SELECT DISTINCT lang, source FROM d) e
      LEFT JOIN (SELECT lang, source, sum(n) AS total FROM c GROUP BY ALL) s USING (lang, source) LEFT JOIN v USING (lang)),
x AS (SELECT g.lang, g.source, k.t, coalesce(c.n, 0) AS n, 1 + (1000000000::HUGEINT * (coalesce(c.n, 0) + 2)) // (total + 2 * v) AS p
      FROM g JOIN k USING (lang) LEFT JOIN c USING (lang, source, t)),
l AS (SELECT lang, t, 1 + (1000000000::HUGEINT * (n + 2)) // (total + 2 * v) AS q
      FROM (SELECT lang, t, sum(n) AS n FROM c GROUP BY ALL) a JOIN (SELECT lang, sum(total) AS total, max(v) AS v FROM g GROUP BY lang) b USING (lang)),
f AS (SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // (a.p + b.p)) AS value FROM x a JOIN x b USING (lang, t) WHERE a.source <> b.source GROUP BY ALL),
r AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(f.value, 0) AS value
      FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source LEFT JOIN f ON f.lang = a.lang AND f.source = a.source AND f.item = b.source
      UNION ALL SELECT lang, source, 'term', t, (p - q) * (p - q) // (p + q) FROM x JOIN l USING (lang, t) WHERE n > 0 AND p > q)
SELECT lang, source, part, item, cast(value AS BIGINT) AS value, cast(rank AS INTEGER) AS rank
FROM (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank FROM r) z WHERE part = 'pair' OR rank <= 10"""


def _merkle() -> str:
    """Levels written out: six a source, four over the subroots."""
    def part(value: str) -> str:
        return f"coalesce(strlen(cast({value} AS VARCHAR)) || ':' || cast({value} AS VARCHAR), '-')"

    def leaf(text: str) -> str:
        return "sha256(" + " || ".join(map(part, ("doc_id", "source", "lang", "n_chars", text))) + ")"

    def climb(name: str, depth: int) -> list[str]:
        out = []
        for k in range(depth):
            out.append(f"{name}g{k} AS (SELECT tree, pos // 16 AS run, list(h ORDER BY pos) AS hs FROM {name}{k} WHERE n > 1 GROUP BY ALL)")
            out.append(f"{name}{k + 1} AS (SELECT tree, run AS pos, sha256(array_to_string(hs, '')) AS h, count(*) OVER (PARTITION BY tree) AS n FROM {name}g{k} "
                       f"UNION ALL SELECT tree, pos, h, n FROM {name}{k} WHERE n = 1)")
        return out

    def fold(source: str, target: str, groups: str, depth: int) -> list[str]:
        out = []
        for k in range(depth):
            before = source if k == 0 else f"{target}{k}"
            left, right = "array_to_string(g.hs[1:f.pos % 16], '')", "array_to_string(g.hs[f.pos % 16 + 2:], '')"
            out.append(f"{target}{k + 1} AS (SELECT f.* REPLACE (CASE WHEN g.hs IS NULL THEN f.node ELSE sha256({left} || f.node || {right}) END AS node, "
                       f"f.proof || coalesce({left} || {right}, '') AS proof, f.pos // 16 AS pos) FROM {before} f LEFT JOIN {groups}{k} g ON g.tree = f.tree AND g.run = f.pos // 16)")
        return out

    text = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    # CRC-32, bit by bit: a byte enters at every eighth step
    step = "CASE WHEN i % 8 = 0 THEN xor(c, ascii(substr(cast(doc_id AS VARCHAR), cast(i // 8 + 1 AS BIGINT), 1))) ELSE c END"
    crc = (f"xor(list_reduce(list_prepend(4294967295::BIGINT, range(8 * strlen(cast(doc_id AS VARCHAR)))), "
           f"lambda c, i: xor(({step}) >> 1, 3988292384::BIGINT * (({step}) & 1))), 4294967295::BIGINT)")
    parts = [f"d AS (SELECT doc_id, coalesce('s' || source, '') AS tree, {leaf('text')} AS leaf, CASE WHEN {crc} % 5 = 0 THEN {leaf(text)} END AS other FROM documents)",
             "x0 AS (SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos, count(*) OVER (PARTITION BY tree) AS n FROM d)",
             "a0 AS (SELECT tree, pos, leaf AS h, n FROM x0)", *climb("a", 6),
             "y0 AS (SELECT tree AS name, h AS subroot, row_number() OVER (ORDER BY tree) - 1 AS pos, count(*) OVER () AS n FROM a6)",
             "b0 AS (SELECT '' AS tree, pos, subroot AS h, n FROM y0)", *climb("b", 4),
             "f0 AS (SELECT doc_id, leaf, tree, pos, coalesce(other, leaf) AS node, '' AS proof FROM x0)", *fold("f0", "f", "ag", 6),
             "e0 AS (SELECT f6.doc_id, f6.leaf, f6.node, f6.proof, y0.subroot, y0.pos, '' AS tree FROM f6 JOIN y0 ON y0.name = f6.tree)", *fold("e0", "e", "bg", 4)]
    return "WITH " + ",\n".join(parts) + ("\nSELECT doc_id, leaf, subroot, b4.h AS root, sha256(proof) AS proof_sha256, node AS folded_root, node = b4.h AS verified "
                                         "FROM e4 JOIN b4 ON b4.tree = e4.tree")


MERKLE = _merkle()
