"""The same results in DuckDB's SQL, where SQL can express them."""

ORACLE: dict[str, str] = {
    "op1_exact_dedup": r"""
WITH normal AS (
    SELECT doc_id, length(coalesce(text, '')) AS size,
           regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS body
    FROM documents
)
SELECT doc_id,
       first_value(doc_id) OVER longest AS keep_id,
       count(*) OVER (PARTITION BY body) AS group_size,
       doc_id = first_value(doc_id) OVER longest AS kept,
       sha256(body) AS text_sha256
FROM normal
WINDOW longest AS (PARTITION BY body ORDER BY size DESC, doc_id)
""",
    "op2_warc": """
WITH bodies AS (
    SELECT page_id, coalesce(html, '') AS body, strlen(coalesce(html, '')) AS payload_bytes
    FROM pages
), named AS (
    SELECT *, max(page_id) OVER (PARTITION BY body) AS largest FROM bodies
), decided AS (
    SELECT *, payload_bytes >= 1000 AND page_id <> largest AS revisit FROM named
)
SELECT page_id, payload_bytes, sha1(body) AS payload_digest,
       CASE WHEN revisit THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN revisit THEN largest END AS refers_to
FROM decided
""",
    "op11_line_dedup": r"""
WITH split AS (
    SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents
), numbered AS (
    SELECT doc_id, unnest(lines) AS line, generate_subscripts(lines, 1) AS n FROM split
), keyed AS (
    SELECT *, translate(
        regexp_replace(line, '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g'),
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
    FROM numbered
), shared AS (
    SELECT key, max(doc_id) AS keeper FROM keyed
    WHERE length(key) >= 20 GROUP BY key HAVING count(DISTINCT doc_id) >= 3
), decided AS (
    SELECT doc_id, line, n, coalesce(doc_id <> keeper, false) AS gone
    FROM keyed LEFT JOIN shared USING (key)
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY n) FILTER (NOT gone), '')) AS kept_sha256
FROM decided GROUP BY doc_id
""",
    "op12_filter_audit": r"""
WITH texts AS (
    SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS body,
           regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words
    FROM documents
), judged AS (
    SELECT part, coalesce(quality = 1, false) AS good, coalesce(toxic = 1, false) AS bad,
           len(words) < 100 AS a,
           100 * len(list_distinct(words)) < 80 * len(words) AS b,
           100 * length(regexp_replace(body, '[^A-Z]', '', 'g')) > 10 * length(body) AS c,
           regexp_matches(body, '[#$%&*|]') AS d,
           doc_id > min(doc_id) OVER (PARTITION BY body) AS e
    FROM texts LEFT JOIN labels USING (doc_id)
), masks AS (
    SELECT part, a, b, c, d, e, count(*) AS docs,
           count(*) FILTER (good) AS good, count(*) FILTER (bad) AS bad
    FROM judged GROUP BY ALL
), letters AS (
    SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS l
), orders AS (
    SELECT p.l || q.l || r.l || s.l || t.l AS filter_order
    FROM letters p JOIN letters q ON q.l <> p.l
    JOIN letters r ON r.l NOT IN (p.l, q.l)
    JOIN letters s ON s.l NOT IN (p.l, q.l, r.l)
    JOIN letters t ON t.l NOT IN (p.l, q.l, r.l, s.l)
), removals AS (
    SELECT *, least(
        CASE WHEN a THEN strpos(filter_order, 'A') ELSE 9 END,
        CASE WHEN b THEN strpos(filter_order, 'B') ELSE 9 END,
        CASE WHEN c THEN strpos(filter_order, 'C') ELSE 9 END,
        CASE WHEN d THEN strpos(filter_order, 'D') ELSE 9 END,
        CASE WHEN e THEN strpos(filter_order, 'E') ELSE 9 END) AS gone_at
    FROM masks CROSS JOIN orders
), steps AS (
    SELECT part, filter_order, step, substr(filter_order, step, 1) AS letter,
           CASE letter WHEN 'A' THEN a WHEN 'B' THEN b WHEN 'C' THEN c WHEN 'D' THEN d
                ELSE e END AS fails,
           a::INT + b::INT + c::INT + d::INT + e::INT AS failed, gone_at, docs, good, bad
    FROM removals CROSS JOIN (SELECT unnest([1, 2, 3, 4, 5]) AS step)
), counted AS (
    SELECT part, filter_order, step, letter,
           coalesce(sum(docs) FILTER (gone_at > step), 0) AS kept,
           coalesce(sum(docs) FILTER (gone_at = step), 0) AS removed,
           coalesce(sum(docs) FILTER (fails AND gone_at < step), 0) AS redundant,
           coalesce(sum(docs) FILTER (fails AND failed = 1), 0) AS unique_fails,
           coalesce(sum(good) FILTER (gone_at = step), 0) AS good_lost,
           coalesce(sum(bad) FILTER (gone_at = step), 0) AS toxic_lost
    FROM steps GROUP BY ALL
)
SELECT part, filter_order, step::INT AS step, kept::BIGINT AS kept, removed::BIGINT AS removed,
       redundant::BIGINT AS redundant, unique_fails::BIGINT AS unique_fails,
       good_lost::BIGINT AS good_lost, toxic_lost::BIGINT AS toxic_lost,
       (sum(removed) OVER (PARTITION BY part, letter))::BIGINT AS shapley
FROM counted
""",
    "op13_hard_negatives": r"""
WITH rows AS (
    SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
           list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS q
    FROM embeddings
    WHERE label IS NOT NULL AND embedding IS NOT NULL
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
    SELECT a.vec_id AS anchor_id, r.vec_id AS other_id, a.label = r.label AS same,
           list_inner_product(a.q, r.q)::BIGINT AS score
    FROM rows a JOIN rows r ON a.vec_id % 50 = 0 AND r.vec_id <> a.vec_id
), positives AS (
    SELECT * FROM scored WHERE same
    QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) <= 5
)
SELECT anchor_id, p.other_id AS positive_id,
       (row_number() OVER best)::INT AS rank, n.other_id AS negative_id,
       p.score AS positive_score, n.score AS negative_score
FROM positives p JOIN scored n USING (anchor_id)
WHERE NOT n.same AND 50 * p.score <= 100 * n.score AND 100 * n.score <= 95 * p.score
WINDOW best AS (PARTITION BY anchor_id, p.other_id ORDER BY n.score DESC, n.other_id)
QUALIFY rank <= 3
""",
}
