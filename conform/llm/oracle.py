"""Results of the queries in DuckDB SQL, where SQL can express them."""

from __future__ import annotations

#: The fixed white space of the contracts.
_BLANKS = r"\x20\x09-\x0D"

ORACLE_SQL = {
    "op3_exact_dedup": rf"""
        WITH plain AS (
            SELECT doc_id, CAST(length(coalesce(text, '')) AS BIGINT) AS n_points,
                sha256(regexp_replace(coalesce(text, ''), '[{_BLANKS}]+', '', 'g')) AS text_sha256,
                regexp_replace(coalesce(text, ''), '[{_BLANKS}]+', '', 'g') AS plain
            FROM documents)
        SELECT doc_id, first_value(doc_id) OVER same AS keep_id, count(*) OVER (PARTITION BY plain) AS group_size,
            row_number() OVER same = 1 AS kept, text_sha256, n_points
        FROM plain
        WINDOW same AS (PARTITION BY plain ORDER BY n_points DESC, doc_id NULLS LAST)
    """,
    "op4_mixing": rf"""
        WITH sized AS (
            SELECT doc_id, source,
                CAST(len(regexp_extract_all(coalesce(text, ''), '[^{_BLANKS}]+')) AS BIGINT) AS size,
                md5('mix:' || coalesce(CAST(doc_id AS VARCHAR), 'null') || ':' || md5(coalesce(text, ''))) AS hash
            FROM documents),
        sizes AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM sized GROUP BY source),
        weighed AS (
            SELECT *, 2.0::DOUBLE * source_size AS cap,
                CAST([5, 2, 1][((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::INT] AS DOUBLE) AS weight
            FROM sizes),
        levels AS (
            SELECT *, (1.5::DOUBLE * sum(source_size) OVER () - coalesce(sum(cap) OVER (
                    ORDER BY cap / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
                / sum(weight) OVER (
                    ORDER BY cap / weight, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
            FROM weighed),
        chosen AS (SELECT max(level) AS level FROM levels WHERE level * weight <= cap),
        targets AS (
            SELECT source, source_size, least(coalesce(weight * (SELECT level FROM chosen), cap), cap) AS target
            FROM levels),
        plans AS (
            SELECT *, CASE WHEN source_size > 0 THEN CAST(floor(target / source_size) AS BIGINT) ELSE 0 END AS rounds
            FROM targets),
        ordered AS (
            SELECT s.doc_id, s.size, p.source_size, p.target, p.rounds, target - rounds * source_size
                - coalesce(sum(s.size) OVER (
                    PARTITION BY s.source ORDER BY hash ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS left_over
            FROM sized s JOIN plans p ON s.source IS NOT DISTINCT FROM p.source)
        SELECT doc_id, size, source_size, target,
            CAST(size * (rounds + CASE WHEN left_over > 0 AND size - left_over <= left_over THEN 1 ELSE 0 END) AS BIGINT)
                AS taken
        FROM ordered
    """,
    "op7_revisits": r"""
        WITH bare AS (
            SELECT *, regexp_replace(regexp_replace(coalesce(url, ''), '(?s)#.*$', ''),
                '^[A-Za-z][A-Za-z0-9+.-]*://', '') AS rest
            FROM pages),
        fields AS (
            SELECT *, list_sort(list_filter(string_split(regexp_extract(rest, '(?s)^[^?]*\?(.*)$', 1), '&'),
                lambda x: x <> '' AND NOT regexp_matches(x, '^(utm_[a-z]+|ref|fbclid|gclid|msclkid)(=|$)'))) AS query
            FROM bare),
        addresses AS (
            SELECT page_id, '"' || md5(coalesce(html, '')) || '"' AS etag, strlen(coalesce(html, '')) AS size,
                regexp_replace(lower(regexp_extract(rest, '^[^/?]*', 0)), ':(80|443)$', '')
                || regexp_replace(regexp_extract(rest, '^[^/?]*([^?]*)', 1), '/+$', '')
                || CASE WHEN len(query) > 0 THEN '?' || array_to_string(query, '&') ELSE '' END AS url_key
            FROM fields),
        events AS (
            SELECT page_id * 2 AS record_id, url_key, 1700000000 + page_id * 7919 % 31536000 AS moment, 1 AS whole,
                etag, size
            FROM addresses
            UNION ALL
            SELECT page_id * 2 + 1, url_key, 1700000000 + (page_id * 104729 + 15768000) % 31536000, 0,
                CASE WHEN page_id % 5 = 0 THEN '"changed"' ELSE etag END, 0
            FROM addresses),
        earlier AS (
            SELECT *, last_value(CASE WHEN whole = 1 THEN {'id': record_id, 'etag': etag, 'size': size} END IGNORE NULLS)
                OVER (PARTITION BY url_key ORDER BY moment, whole, record_id
                    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS base
            FROM events)
        SELECT record_id, url_key, base.id AS response_id,
            CASE WHEN base IS NULL THEN 'missing' WHEN base.etag = etag THEN 'resolved' ELSE 'mismatch' END AS state,
            'cache-control=max-age=60;content-length='
            || CASE WHEN base IS NOT NULL AND base.etag = etag THEN base.size || ';content-type=text/html' ELSE '0' END
            || ';date=' || moment || ';etag=' || etag AS headers
        FROM earlier WHERE whole = 0
    """,
    "op12_hard_negatives": r"""
        WITH vectors AS (
            SELECT row_number() OVER () AS place, vec_id,
                CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
                list_transform(embedding, lambda c: floor(256 * CAST(c AS DOUBLE))) AS x
            FROM embeddings
            WHERE label IS NOT NULL AND embedding IS NOT NULL
                AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0),
        scores AS (
            SELECT a.place AS anchor, a.vec_id AS anchor_id, b.place, b.vec_id, a.label = b.label AS same,
                CAST(list_inner_product(a.x, b.x) AS BIGINT) AS score
            FROM vectors a JOIN vectors b ON a.place <> b.place AND len(a.x) = len(b.x)
            WHERE a.vec_id % 100 = 0),
        positives AS (
            SELECT * FROM scores WHERE same
            QUALIFY row_number() OVER (PARTITION BY anchor ORDER BY score DESC, vec_id NULLS LAST, place) <= 5)
        SELECT p.anchor_id, p.vec_id AS positive_id,
            CAST(row_number() OVER (PARTITION BY p.anchor, p.place ORDER BY n.score DESC, n.vec_id NULLS LAST) AS INT)
                AS rank,
            n.vec_id AS negative_id, p.score AS positive_score, n.score AS negative_score
        FROM positives p JOIN scores n
            ON p.anchor = n.anchor AND NOT n.same AND 80 * p.score <= 100 * n.score AND 100 * n.score <= 100 * p.score
        QUALIFY rank <= 5
    """,
}
