"""The same results in SQL, where SQL can express them."""

ORACLE = {
    "op6_exact_dedup": """
        WITH d AS (
            SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t
            FROM documents)
        SELECT doc_id, max(doc_id) OVER (PARTITION BY t) AS keep_id, count(*) OVER (PARTITION BY t) AS group_size,
               doc_id = max(doc_id) OVER (PARTITION BY t) AS kept, sha256(t) AS text_sha256
        FROM d""",
    "op8_source_mix": r"""
        WITH s AS (
            SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size
            FROM documents),
        per AS (
            SELECT source, sum(size)::BIGINT AS source_size, (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 AS class,
                   [5, 2, 1][((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::INT]::BIGINT AS w
            FROM s GROUP BY source),
        run AS (
            SELECT *, sum(source_size) OVER ()::HUGEINT AS total, sum(w) OVER ()::BIGINT AS all_w,
                   coalesce(sum(source_size) OVER before, 0)::HUGEINT * 3 AS taken_up,
                   coalesce(sum(w) OVER before, 0)::BIGINT AS w_before
            FROM per
            WINDOW before AS (ORDER BY source_size / w, source NULLS LAST
                              ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
        marked AS (
            SELECT *, (total - taken_up) * w > source_size::HUGEINT * 3 * (all_w - w_before) AS capped,
                   (total - taken_up)::DOUBLE / (all_w - w_before)::DOUBLE AS level
            FROM run),
        aimed AS (
            SELECT source, source_size, class,
                   CASE WHEN capped THEN (source_size * 3)::DOUBLE
                        ELSE (SELECT arg_min(level, source_size / w) FROM marked m WHERE NOT m.capped) * w END AS target
            FROM marked),
        run_docs AS (
            SELECT s.doc_id, s.size, a.source_size, a.target, a.class,
                   sum(s.size) OVER (PARTITION BY s.source
                                     ORDER BY ('0x' || substr(md5(coalesce(s.doc_id::VARCHAR, '')), 1, 15))::BIGINT,
                                              s.doc_id, s.size
                                     ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) - s.size AS start,
                   CASE WHEN a.source_size > 0 THEN floor(a.target / a.source_size)::BIGINT ELSE 0 END AS whole
            FROM s JOIN aimed a ON s.source IS NOT DISTINCT FROM a.source),
        passed AS (
            SELECT *, whole + CASE WHEN (2 * start + size)::DOUBLE < 2 * (target - whole * source_size) THEN 1 ELSE 0 END AS passes,
                   least(greatest(coalesce((start + size / 2) / nullif(target, 0), 0), 0), 1)::DOUBLE AS u
            FROM run_docs)
        SELECT doc_id, size, source_size, target, (size * passes)::BIGINT AS taken,
               CASE WHEN passes > 0 THEN round(least(1.0::DOUBLE, CASE class
                   WHEN 0 THEN u * 2 / (1.5 + sqrt(greatest(2.25 - 2 * u, 0)))
                   WHEN 1 THEN u
                   ELSE CASE WHEN u < 0.375 THEN u * 2 / (0.5 + sqrt(0.25 + 2 * u))
                             ELSE 0.5 + (u - 0.375) * 2 / (1 + sqrt(1 + 2 * (u - 0.375))) END END), 9) END AS position
        FROM passed""",
    "op11_phrase_collocations": r"""
        WITH pieces AS (
            SELECT coalesce(lang, 'und') AS lang,
                   unnest(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                                                       'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
            FROM documents),
        words AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS ws FROM pieces),
        totals AS (SELECT lang, sum(len(ws))::HUGEINT AS n FROM words GROUP BY lang),
        places AS (SELECT lang, ws, m, unnest(range(1, len(ws) - m + 2)) AS i
                   FROM words, (SELECT unnest([1, 2, 3, 4, 5]) AS m) WHERE len(ws) >= m),
        grams AS (SELECT lang, m, ws[i : i + m - 1] AS g, count(*) AS f FROM places GROUP BY ALL HAVING count(*) >= 100),
        gone AS (
            SELECT DISTINCT s.lang, s.g FROM grams s
            JOIN (SELECT lang, g[1 : m - 1] AS part, f FROM grams WHERE m > 2
                  UNION ALL SELECT lang, g[2 : m], f FROM grams WHERE m > 2) x
              ON s.lang = x.lang AND s.g = x.part AND x.f >= s.f),
        cuts AS (SELECT lang, m, g, f, unnest(range(1, m)) AS k FROM grams
                 WHERE m > 1 AND NOT EXISTS (SELECT 1 FROM gone o WHERE o.lang = grams.lang AND o.g = grams.g)),
        scored AS (
            SELECT c.lang, c.g, c.f AS a, c.k, x.f AS l, y.f AS r, t.n,
                   (1000::HUGEINT * c.f * t.n) // (x.f::HUGEINT * y.f) AS score
            FROM cuts c JOIN grams x ON x.lang = c.lang AND x.g = c.g[1 : c.k]
            JOIN grams y ON y.lang = c.lang AND y.g = c.g[c.k + 1 : c.m]
            JOIN totals t ON t.lang = c.lang),
        lowest AS (SELECT lang, array_to_string(g, ' ') AS phrase, a, l, r, n, score FROM scored
                   QUALIFY row_number() OVER (PARTITION BY lang, g ORDER BY score, k) = 1)
        SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r,
               n::BIGINT AS n, score::BIGINT AS score
        FROM lowest QUALIFY rank <= 2000""",
}
