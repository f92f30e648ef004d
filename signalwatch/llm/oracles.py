"""SQL equivalents, for DuckDB, of the queries that SQL can express."""

from __future__ import annotations

from signalwatch.llm.spaced_seeds import MAY_DIFFER, WINDOW

_MAY_DIFFER = " + ".join(f"CAST(width >= {n} AS INTEGER)" for n in MAY_DIFFER)

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

_TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"

ORACLES = {
    # all pairs that share a shingle, and everything that can be reached by links
    "op1_minmax_dedup": rf"""
        WITH RECURSIVE w AS (
            SELECT doc_id, list_filter(regexp_split_to_array(
                       translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'),
                       '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws
            FROM documents),
        s AS (
            SELECT DISTINCT doc_id, unnest(CASE WHEN len(ws) < 2 THEN ws ELSE
                       list_transform(range(1, len(ws)), lambda k: ws[k] || ' ' || ws[k + 1])
                       END) AS shingle
            FROM w),
        sizes AS (
            SELECT doc_id, count(*) AS n, list(shingle ORDER BY shingle) AS whole
            FROM s GROUP BY doc_id),
        classes AS (
            SELECT doc_id, n, min(doc_id) OVER (PARTITION BY whole) AS class_id FROM sizes),
        heads AS (SELECT DISTINCT class_id FROM classes),
        common AS (
            SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS n
            FROM s AS a JOIN s AS b USING (shingle)
            WHERE a.doc_id < b.doc_id AND a.doc_id IN (FROM heads) AND b.doc_id IN (FROM heads)
            GROUP BY ALL),
        links AS (
            SELECT x, y FROM common JOIN classes AS a ON a.doc_id = x JOIN classes AS b ON b.doc_id = y
            WHERE 100 * common.n >= 80 * (a.n + b.n - common.n)),
        ways AS (SELECT x, y FROM links UNION ALL SELECT y, x FROM links),
        reach AS (
            SELECT class_id AS x, class_id AS y FROM heads
            UNION SELECT reach.x, ways.y FROM reach JOIN ways ON ways.x = reach.y),
        least AS (SELECT x, min(y) AS component_id FROM reach GROUP BY x)
        SELECT w.doc_id, coalesce(n, 0) AS n_shingles,
               coalesce(component_id, w.doc_id) AS component_id,
               w.doc_id = coalesce(component_id, w.doc_id) AS kept,
               coalesce(class_id, w.doc_id) AS class_id
        FROM w LEFT JOIN classes USING (doc_id) LEFT JOIN least ON x = class_id""",
    # every window of every item against every shift at which a word agrees
    "op6_spaced_seeds": rf"""
        WITH d AS (
            SELECT doc_id, list_filter(regexp_split_to_array(lower(coalesce(text, '')),
                                       '[^\p{{L}}\p{{N}}]+'), lambda w: w <> '') AS ws
            FROM documents),
        i AS (
            SELECT item_id, list_filter(regexp_split_to_array(lower(coalesce(text, '')),
                                        '[^\p{{L}}\p{{N}}]+'), lambda w: w <> '') AS ws
            FROM benchmark),
        dw AS (SELECT doc_id, unnest(ws) AS w, generate_subscripts(ws, 1) - 1 AS p FROM d),
        iw AS (SELECT item_id, unnest(ws) AS w, generate_subscripts(ws, 1) - 1 AS q FROM i
               WHERE len(ws) >= 6),
        hit AS (SELECT doc_id, item_id, p - q AS shift, q FROM dw JOIN iw USING (w)),
        bounded AS (
            SELECT hit.*, len(i.ws) AS n_words, least({WINDOW}, len(i.ws)) AS width,
                   greatest(0, -shift) AS first, least(len(i.ws), len(d.ws) - shift) AS behind
            FROM hit JOIN i USING (item_id) JOIN d USING (doc_id)),
        counted AS (
            SELECT *, count(*) OVER (PARTITION BY doc_id, item_id, shift) AS n_equal,
                   count(*) OVER (PARTITION BY doc_id, item_id, shift ORDER BY q
                                  RANGE BETWEEN width - 1 PRECEDING AND CURRENT ROW) AS at_end,
                   count(*) FILTER (q < first + width)
                       OVER (PARTITION BY doc_id, item_id, shift) AS at_start
            FROM bounded WHERE behind - first >= width),
        best AS (
            SELECT doc_id, item_id, shift, width, n_words, n_equal,
                   greatest(max(at_start), max(at_end)) AS n_best
            FROM counted GROUP BY ALL)
        SELECT doc_id, item_id, max(n_equal) AS n_equal, max(n_words) AS n_words,
               max(n_best) AS n_best
        FROM best WHERE n_best >= width - ({_MAY_DIFFER})
        GROUP BY doc_id, item_id""",
    # masks by document, then every order and step
    "op12_filter_audit": rf"""
        WITH d AS (
            SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS text,
                   regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws
            FROM documents),
        known AS (
            SELECT doc_id, max(CAST(quality = 1 AS INTEGER)) AS good,
                   max(CAST(toxic = 1 AS INTEGER)) AS toxic
            FROM labels GROUP BY doc_id),
        failing AS (
            SELECT part, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic,
                   (CASE WHEN len(ws) < 100 THEN 'A' ELSE '' END)
                   || (CASE WHEN 100 * len(list_distinct(ws)) < 80 * len(ws) THEN 'B' ELSE '' END)
                   || (CASE WHEN 100 * length(regexp_replace(text, '[^A-Z]', '', 'g'))
                                 > 10 * length(text) THEN 'C' ELSE '' END)
                   || (CASE WHEN regexp_matches(text, '[#$%&*|]') THEN 'D' ELSE '' END)
                   || (CASE WHEN doc_id > min(doc_id) OVER (PARTITION BY text) THEN 'E' ELSE '' END)
                   AS failed
            FROM d LEFT JOIN known USING (doc_id)),
        counts AS (
            SELECT part, failed, count(*) AS n, sum(good) AS n_good, sum(toxic) AS n_toxic
            FROM failing GROUP BY ALL),
        letters AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x),
        orders AS (
            SELECT a.x || b.x || c.x || d.x || e.x AS filter_order
            FROM letters AS a, letters AS b, letters AS c, letters AS d, letters AS e
            WHERE len(list_distinct([a.x, b.x, c.x, d.x, e.x])) = 5),
        steps AS (
            SELECT counts.*, filter_order, step, filter_order[step] AS letter,
                   contains(failed, filter_order[step]) AS fails,
                   step > 1 AND len(list_filter(range(1, step),
                                    lambda k: contains(failed, filter_order[k]))) > 0 AS gone
            FROM counts, orders, (SELECT CAST(unnest(range(1, 6)) AS INTEGER) AS step)),
        sums AS (
            SELECT part, filter_order, step, any_value(letter) AS letter,
                   coalesce(sum(n) FILTER (NOT fails AND NOT gone), 0) AS kept,
                   coalesce(sum(n) FILTER (fails AND NOT gone), 0) AS removed,
                   coalesce(sum(n) FILTER (fails AND gone), 0) AS redundant,
                   coalesce(sum(n) FILTER (fails AND length(failed) = 1), 0) AS unique_fails,
                   coalesce(sum(n_good) FILTER (fails AND NOT gone), 0) AS good_lost,
                   coalesce(sum(n_toxic) FILTER (fails AND NOT gone), 0) AS toxic_lost
            FROM steps GROUP BY part, filter_order, step)
        SELECT part, filter_order, step, CAST(kept AS BIGINT) AS kept,
               CAST(removed AS BIGINT) AS removed, CAST(redundant AS BIGINT) AS redundant,
               CAST(unique_fails AS BIGINT) AS unique_fails, CAST(good_lost AS BIGINT) AS good_lost,
               CAST(toxic_lost AS BIGINT) AS toxic_lost,
               CAST(sum(removed) OVER (PARTITION BY part, letter) AS BIGINT) AS shapley
        FROM sums""",
    # all documents that share a term with an item
    "op13_lexical_search": rf"""
        WITH d AS (
            SELECT row_number() OVER () AS r, doc_id,
                   regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'),
                                      '{_TERM}') AS ws
            FROM documents),
        total AS (SELECT count(*) FILTER (len(ws) > 0) AS n, sum(len(ws)) AS l FROM d),
        tf AS (
            SELECT r, w, any_value(doc_id) AS doc_id, any_value(n) AS n, count(*) AS tf
            FROM (SELECT r, doc_id, len(ws) AS n, unnest(ws) AS w FROM d) GROUP BY r, w),
        df AS (SELECT w, count(*) AS df FROM tf GROUP BY w),
        terms AS (
            SELECT item_id, w, count(*) AS times
            FROM (SELECT item_id, unnest(regexp_extract_all(
                             translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '{_TERM}')) AS w
                  FROM (SELECT DISTINCT item_id, text FROM benchmark))
            GROUP BY ALL),
        scores AS (
            SELECT item_id, r, any_value(doc_id) AS doc_id,
                   CAST(sum(times * CAST(floor(1000 * ln((2 * total.n + 2) / (2 * df + 1))) AS BIGINT)
                            * ((1000000000 * tf)
                               // (1000 * tf + 12 * (100 - 25 + ((25 * tf.n * total.n) // l)))))
                        AS BIGINT) AS score
            FROM terms JOIN tf USING (w) JOIN df USING (w), total
            GROUP BY item_id, r)
        SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)
                             AS INTEGER) AS rank, doc_id, score
        FROM scores WHERE score > 0
        QUALIFY rank <= 20""",
}
