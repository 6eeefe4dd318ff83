"""DuckDB SQL of the registered queries that SQL can express. The others are tested against brute force."""

from __future__ import annotations

WORDS_ALNUM = r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
WORDS = r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+')"



def clusters_sql(k: int = 16, rounds: int = 3, dims: int = 64) -> str:
    """Assignment and moved centroids of each round, one after the other."""
    gap = "(k.x[i] - c.x[i])"
    steps = [f"""kept AS (
    SELECT vec_id, list_transform(embedding, lambda c: CAST(floor(64 * CAST(c AS DOUBLE)) AS BIGINT)) AS x FROM embeddings
    WHERE embedding IS NOT NULL AND len(embedding) = {dims}
      AND NOT list_contains(list_transform(embedding, lambda c: c IS NULL OR NOT isfinite(c)), true)),
c0 AS (SELECT row_number() OVER (ORDER BY h) - 1 AS cluster, x FROM (
    SELECT sha256('1:' || vec_id) AS h, x FROM kept ORDER BY h LIMIT {k}))"""]
    for r in range(rounds + 1):
        steps.append(f"""a{r} AS (
    SELECT k.vec_id, any_value(k.x) AS x, min(struct_pack(
        distance := list_sum(list_transform(range(1, {dims + 1}), lambda i: {gap} * {gap})), cluster := c.cluster)) AS near
    FROM kept k CROSS JOIN c{r} c GROUP BY k.vec_id)""")
        if r < rounds:
            steps.append(f"""s{r} AS (
    SELECT near.cluster AS cluster, i, CAST(sum(x[i]) AS BIGINT) AS s, count(*) AS n FROM a{r} CROSS JOIN range(1, {dims + 1}) t(i) GROUP BY 1, 2),
c{r + 1} AS (
    SELECT c.cluster, coalesce(m.x, c.x) AS x FROM c{r} c LEFT JOIN (
        SELECT cluster, list((s - ((s % n + n) % n)) // n ORDER BY i) AS x FROM s{r} GROUP BY cluster) m USING (cluster))""")
    return "WITH " + ",\n".join(steps) + f"""
SELECT a.vec_id, CAST(near.cluster AS INTEGER) AS cluster, CAST(near.distance AS BIGINT) AS distance,
    CAST(sum(near.distance) OVER (PARTITION BY near.cluster) AS BIGINT) AS cluster_inertia,
    CAST(sum(near.distance) OVER () AS BIGINT) AS inertia, sha256(array_to_string(c.x, ',')) AS centroid_sha256
FROM a{rounds} a JOIN c{rounds} c ON c.cluster = a.near.cluster"""


ORACLES: dict[str, str] = {
    "op11_pivot_clusters": clusters_sql(),
    "op2_ngram_jaccard_join": f"""
WITH RECURSIVE words AS (SELECT doc_id, {WORDS} AS w FROM documents),
grams AS (
    SELECT DISTINCT doc_id, array_to_string(w[i:i + 2], ' ') AS g
    FROM (SELECT doc_id, w, unnest(range(1, greatest(2, len(w) - 1))) AS i FROM words WHERE len(w) > 0)),
sizes AS (SELECT doc_id, count(*) AS n FROM grams GROUP BY doc_id),
-- equal sets are one, so that large groups of copies stay cheap
digests AS (SELECT doc_id, sha256(string_agg(g, chr(10) ORDER BY g)) AS d FROM grams GROUP BY doc_id),
reps AS (SELECT d, min(doc_id) AS rep FROM digests GROUP BY d),
own AS (SELECT g.doc_id, g.g, s.n FROM grams g JOIN reps r ON r.rep = g.doc_id JOIN sizes s ON s.doc_id = g.doc_id),
pairs AS (
    SELECT a.doc_id AS a, b.doc_id AS b, a.n AS na, b.n AS nb, count(*) AS common
    FROM own a JOIN own b ON a.g = b.g AND a.doc_id <> b.doc_id AND 100 * least(a.n, b.n) >= 90 * greatest(a.n, b.n)
    GROUP BY ALL),
links AS (SELECT a, b FROM pairs WHERE 100 * common >= 90 * (na + nb - common)),
reach AS (SELECT rep AS a, rep AS b FROM reps UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a),
least_of AS (SELECT a, min(b) AS c FROM reach GROUP BY a)
SELECT w.doc_id, coalesce(s.n, 0) AS n_shingles, coalesce(l.c, w.doc_id) AS component_id
FROM words w LEFT JOIN sizes s USING (doc_id) LEFT JOIN digests d USING (doc_id) LEFT JOIN reps r ON r.d = d.d
LEFT JOIN least_of l ON l.a = r.rep""",
    "op4_decontaminate": f"""
WITH items AS (SELECT item_id, {WORDS_ALNUM} AS w FROM benchmark),
windows AS (
    SELECT DISTINCT item_id, least(len(w), 10) AS n, array_to_string(w[i:i + 9], ' ') AS g
    FROM (SELECT item_id, w, unnest(range(1, greatest(2, len(w) - 8))) AS i FROM items WHERE len(w) > 0)),
words AS (SELECT doc_id, {WORDS_ALNUM} AS w FROM documents),
places AS (SELECT doc_id, w, unnest(range(1, len(w) + 1)) AS i FROM words),
found AS (
    SELECT p.doc_id, p.i, v.n, v.item_id FROM (SELECT DISTINCT n FROM windows) k
    JOIN places p ON p.i + k.n - 1 <= len(p.w) JOIN windows v ON v.n = k.n AND v.g = array_to_string(p.w[p.i:p.i + k.n - 1], ' ')),
hit AS (SELECT doc_id, count(DISTINCT j) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS j FROM found) GROUP BY doc_id),
named AS (
    SELECT doc_id, count(*) AS n_items, sha256(string_agg(item, ',' ORDER BY item)) AS items_sha256
    FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item FROM found) GROUP BY doc_id)
SELECT w.doc_id, len(w.w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
    coalesce(items_sha256, sha256('')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM words w LEFT JOIN hit USING (doc_id) LEFT JOIN named USING (doc_id)""",
    "op6_chat_format": r"""
WITH turns AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    UNION ALL SELECT -1, i, r, '</s>[INST] ok [/INST]' FROM (VALUES (0, 'user'), (1, 'assistant')) AS t(i, r)),
escaped AS (
    SELECT *, regexp_replace(regexp_replace(replace(text, '\', '\b'),
        '<(<SYS>>|</SYS>>|<ROLE>>|</ROLE>>|</TURN>>|s>|/s>)', '\\l\1', 'g'), '\[(INST\]|/INST\])', '\\o\1', 'g') AS e FROM turns),
formatted AS (
    SELECT *, CASE role WHEN 'system' THEN '<<SYS>>' || chr(10) || e || chr(10) || '<</SYS>>' || chr(10)
        WHEN 'user' THEN '[INST] ' || e || ' [/INST]' WHEN 'assistant' THEN '<s>' || e || '</s>' END AS f FROM escaped)
SELECT conv_id, count(*) AS n_turns,
    sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
    coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
    sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
    sum(length(f))::BIGINT AS formatted_chars
FROM formatted GROUP BY conv_id""",
    "op8_exact_dedup": """
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size, doc_id = max(doc_id) OVER same AS kept,
    sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW same AS (PARTITION BY coalesce(text, ''))""",
    "op9_warc": """
WITH rows AS (SELECT page_id, coalesce(html, '') AS html, strlen(coalesce(html, '')) AS n, sha1(coalesce(html, '')) AS d FROM pages),
kept AS (SELECT *, max(page_id) OVER (PARTITION BY html) AS keeper FROM rows)
SELECT page_id, n AS payload_bytes, d AS payload_digest,
    CASE WHEN n >= 1000 AND page_id <> keeper THEN 'revisit' ELSE 'response' END AS record_type,
    CASE WHEN n >= 1000 AND page_id <> keeper THEN keeper END AS refers_to
FROM kept""",
}
