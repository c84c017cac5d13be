"""SQL (DuckDB) for the queries that SQL can express over whole tables."""

WORDS = r"'[^\x20\x09-\x0D]+'"
LOWERED = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
TERMS = r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'"

LINE_FREQUENCY = f"""
WITH d AS (
    SELECT row_number() OVER () AS r, doc_id, source, coalesce(text, '') AS t,
           regexp_extract_all(coalesce(text, ''), {WORDS}) AS w FROM documents),
grams AS (
    SELECT r, s, count(*) OVER (PARTITION BY r, list_slice(w, s, s + 7)) AS n
    FROM (SELECT r, w, unnest(range(1, len(w) - 6)) AS s FROM d WHERE len(w) >= 8) AS x),
repeats AS (
    SELECT r, count(DISTINCT p) AS n FROM (SELECT r, unnest(range(s, s + 8)) AS p FROM grams WHERE n > 1) AS x GROUP BY r),
lines AS (
    SELECT r, source, t, line, len(regexp_extract_all(line, {WORDS})) AS n,
           array_to_string(regexp_extract_all(lower(line), {WORDS}), ' ') AS k
    FROM (SELECT r, source, t, unnest(string_split(t, chr(10))) AS line FROM d) AS x
    WHERE len(regexp_extract_all(line, {WORDS})) > 0),
twice AS (SELECT r, count(*) - count(DISTINCT line) AS n FROM lines GROUP BY r),
often AS (SELECT source, k, count(DISTINCT t) AS n FROM lines GROUP BY source, k HAVING count(DISTINCT t) > 20),
hosts AS (SELECT source, count(DISTINCT t) AS n FROM d GROUP BY source),
above AS (
    SELECT often.source, often.k FROM often JOIN hosts ON often.source IS NOT DISTINCT FROM hosts.source
    WHERE often.n * 100 > hosts.n * 5),
gone AS (
    SELECT r, sum(n) AS n FROM lines JOIN above ON lines.k = above.k AND lines.source IS NOT DISTINCT FROM above.source
    GROUP BY r),
figures AS (
    SELECT doc_id, len(w) AS n_words, length(array_to_string(w, '')) AS word_chars,
           length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS n_symbols, coalesce(twice.n, 0) AS n_dup_lines,
           coalesce(repeats.n, 0) AS n_repeat_words, coalesce(gone.n, 0) AS n_removed_words
    FROM d LEFT JOIN repeats ON repeats.r = d.r LEFT JOIN twice ON twice.r = d.r LEFT JOIN gone ON gone.r = d.r)
SELECT doc_id, CAST(n_words AS BIGINT) AS n_words, CAST(word_chars AS BIGINT) AS word_chars,
       CAST(n_symbols AS BIGINT) AS n_symbols, CAST(n_dup_lines AS BIGINT) AS n_dup_lines,
       CAST(n_repeat_words AS BIGINT) AS n_repeat_words, CAST(n_removed_words AS BIGINT) AS n_removed_words,
       n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed,
       NOT (n_words < 20 OR 100 * n_repeat_words > 30 * n_words OR n_removed_words * 100 > n_words * 70) AS kept
FROM figures
"""

NEAR_DUPLICATES = f"""
WITH RECURSIVE w AS (
    SELECT doc_id, regexp_extract_all(coalesce({LOWERED}, ''), {WORDS}) AS w FROM documents),
sets AS (
    SELECT DISTINCT doc_id, array_to_string(list_slice(w, s, s + 2), ' ') AS g
    FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 1, 2))) AS s FROM w WHERE len(w) > 0) AS x),
sizes AS (SELECT doc_id, count(*) AS n FROM sets GROUP BY doc_id),
links AS (
    SELECT x.a, x.b FROM (
        SELECT p.doc_id AS a, q.doc_id AS b, count(*) AS n FROM sets AS p JOIN sets AS q ON p.g = q.g AND p.doc_id <> q.doc_id
        GROUP BY p.doc_id, q.doc_id) AS x
    JOIN sizes AS m ON m.doc_id = x.a JOIN sizes AS o ON o.doc_id = x.b
    WHERE 100 * x.n >= 85 * (m.n + o.n - x.n)),
reach AS (
    SELECT doc_id AS a, doc_id AS b FROM documents
    UNION SELECT reach.a, links.b FROM reach JOIN links ON links.a = reach.b),
named AS (SELECT a AS doc_id, min(b) AS component_id FROM reach GROUP BY a)
SELECT named.doc_id, CAST(coalesce(sizes.n, 0) AS BIGINT) AS n_shingles, component_id,
       named.doc_id = component_id AS kept
FROM named LEFT JOIN sizes ON sizes.doc_id = named.doc_id
"""

CONTAMINATION = f"""
WITH d AS (
    SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(coalesce({LOWERED}, ''), {TERMS}) AS w FROM documents),
b AS (
    SELECT row_number() OVER () AS item, item_id, regexp_extract_all(coalesce({LOWERED}, ''), {TERMS}) AS w FROM benchmark),
windows AS (
    SELECT item, item_id, list_slice(w, s, s + 12) AS g
    FROM (SELECT item, item_id, w, unnest(range(1, greatest(len(w) - 12, 1) + 1)) AS s FROM b WHERE len(w) > 0) AS x),
lengths AS (SELECT DISTINCT len(g) AS n FROM windows),
places AS (
    SELECT r, s, n, list_slice(w, s, s + n - 1) AS g
    FROM (SELECT r, w, n, unnest(range(1, len(w) - n + 2)) AS s FROM d JOIN lengths ON len(w) >= n) AS x),
met AS (SELECT DISTINCT r, s, n, item, item_id FROM places JOIN windows ON places.g = windows.g),
hit AS (SELECT r, count(DISTINCT p) AS n FROM (SELECT r, unnest(range(s, s + n)) AS p FROM met) AS x GROUP BY r),
items AS (
    SELECT r, count(*) AS n, string_agg(CAST(item_id AS VARCHAR), ',' ORDER BY CAST(item_id AS VARCHAR)) AS ids
    FROM (SELECT DISTINCT r, item, item_id FROM met) AS x GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(hit.n, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(items.n, 0) AS BIGINT) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
       coalesce(hit.n, 0) > 0 AND 20 * coalesce(hit.n, 0) >= len(w) AS contaminated
FROM d LEFT JOIN hit ON hit.r = d.r LEFT JOIN items ON items.r = d.r
"""

CONVERSATION_TRIE = f"""
WITH own AS (
    SELECT conv_id, list({{'r': coalesce(role, ''), 'x': coalesce(text, '')}}
                         ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS turns
    FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id),
hashed AS (
    SELECT conv_id, turns, xor(list_reduce(
        list_transform(string_split(CAST(conv_id AS VARCHAR), ''), lambda c: CAST(ascii(c) AS BIGINT)),
        lambda h, c: list_reduce(range(8), lambda x, i: xor(x >> 1, CAST(3988292384 AS BIGINT) * (x & 1)), xor(h, c)),
        CAST(4294967295 AS BIGINT)), CAST(4294967295 AS BIGINT)) % 4 AS h
    FROM own),
paths AS (
    SELECT a.conv_id, list_concat(coalesce(list_slice(b.turns, 1, a.h), []), list_slice(a.turns, a.h + 1, len(a.turns))) AS p
    FROM hashed AS a LEFT JOIN own AS b ON b.conv_id = a.conv_id - a.conv_id % 20),
nodes AS (
    SELECT k, len(k) AS depth, min(conv_id) AS conv_id, count(*) AS n,
           sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (WHERE whole), '')) AS ends,
           CASE WHEN len(k) > 0 THEN len(regexp_extract_all(k[len(k)].x, {WORDS})) ELSE 0 END AS words
    FROM (SELECT conv_id, list_slice(p, 1, d) AS k, d = len(p) AS whole
          FROM (SELECT conv_id, p, unnest(range(0, len(p) + 1)) AS d FROM paths) AS x) AS y GROUP BY k),
children AS (SELECT list_slice(k, 1, depth - 1) AS k, count(*) AS n FROM nodes WHERE depth > 0 GROUP BY 1),
figures AS (
    SELECT nodes.*, coalesce(children.n, 0) AS n_children FROM nodes LEFT JOIN children ON children.k = nodes.k),
subtrees AS (
    SELECT list_slice(k, 1, d) AS k, sum(CASE WHEN n_children = 0 THEN 1 ELSE 0 END) AS leaves, sum((n - 1) * words) AS saved
    FROM (SELECT *, unnest(range(0, depth + 1)) AS d FROM figures) AS x GROUP BY 1)
SELECT f.conv_id, CAST(f.depth AS BIGINT) AS depth, up.conv_id AS parent_conv_id, CAST(f.n AS BIGINT) AS n_convs,
       CAST(f.n_children AS BIGINT) AS n_children, CAST(s.leaves AS BIGINT) AS n_leaves,
       CAST(s.saved AS BIGINT) AS saved_tokens, f.ends AS ends_sha256
FROM figures AS f JOIN subtrees AS s ON s.k = f.k
LEFT JOIN nodes AS up ON f.depth > 0 AND up.k = list_slice(f.k, 1, f.depth - 1)
"""


def centroid_clusters(rounds: int = 5, clusters: int = 40, size: int = 64) -> str:
    """Every round is a pair of tables: the nearest centroid of each vector, and the floors of the means."""
    steps = [f"""
v AS (
    SELECT row_number() OVER () AS r, vec_id,
           list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS x
    FROM embeddings
    WHERE len(embedding) = {size} AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = {size}),
c0 AS (
    SELECT row_number() OVER (ORDER BY sha256('2:' || CAST(vec_id AS VARCHAR)), x) - 1 AS k, x
    FROM v ORDER BY k LIMIT {clusters})"""]
    nearest = """
a{i} AS MATERIALIZED (
    SELECT r, min(CAST(d AS BIGINT)) AS d, arg_min(k, (d, k)) AS k FROM (
        SELECT v.r, c.k, list_sum(list_transform(list_zip(v.x, c.x), lambda p: (p[1] - p[2]) * (p[1] - p[2]))) AS d
        FROM v CROSS JOIN c{i} AS c) AS y GROUP BY r)"""
    means = """
c{j} AS MATERIALIZED (
    SELECT c.k, coalesce(m.x, c.x) AS x FROM c{i} AS c LEFT JOIN (
        SELECT k, list(CAST(divide(s - ((s % n) + n) % n, n) AS BIGINT) ORDER BY place) AS x FROM (
            SELECT k, place, CAST(sum(e) AS BIGINT) AS s, count(*) AS n FROM (
                SELECT a.k, unnest(v.x) AS e, generate_subscripts(v.x, 1) AS place FROM v JOIN a{i} AS a ON a.r = v.r) AS y
            GROUP BY k, place) AS z GROUP BY k) AS m ON m.k = c.k)"""
    for i in range(rounds):
        steps += [nearest.format(i=i), means.format(i=i, j=i + 1)]
    steps.append(nearest.format(i=rounds))
    return f"""
WITH {','.join(steps)}
SELECT v.vec_id, CAST(a.k AS INTEGER) AS cluster, a.d AS distance,
       CAST(sum(a.d) OVER (PARTITION BY a.k) AS BIGINT) AS cluster_inertia, CAST(sum(a.d) OVER () AS BIGINT) AS inertia,
       sha256(array_to_string(c.x, ',')) AS centroid_sha256
FROM a{rounds} AS a JOIN v ON v.r = a.r JOIN c{rounds} AS c ON c.k = a.k
"""
