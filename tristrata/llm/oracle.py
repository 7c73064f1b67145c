r"""The queries that SQL can express, in DuckDB's SQL.

The others are beyond it: trained models, merges of byte pairs, XXH64 and a search that is
approximate. Tests hold those against brute force, a library or held-out rows.
"""

WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

ORACLE: dict[str, str] = {
    "op1_substrings": f"""
        WITH docs AS (SELECT doc_id, {WORDS} AS words FROM documents),
        windows AS (
            SELECT doc_id, i, array_to_string(words[i:i + 12], ' ') AS phrase
            FROM (SELECT doc_id, words, unnest(range(1, len(words) - 11)) AS i FROM docs)),
        firsts AS (SELECT phrase, min(doc_id) AS first_id FROM windows GROUP BY phrase),
        gone AS (
            SELECT DISTINCT doc_id, i + k AS place
            FROM windows JOIN firsts USING (phrase), range(13) r(k) WHERE first_id < doc_id),
        each AS (SELECT doc_id, unnest(words) AS word, unnest(range(1, len(words) + 1)) AS place FROM docs),
        kept AS (
            SELECT doc_id, string_agg(word, ' ' ORDER BY place) AS kept, count(*) AS n_kept
            FROM each ANTI JOIN gone USING (doc_id, place) GROUP BY doc_id)
        SELECT doc_id, len(words) AS n_words, len(words) - coalesce(n_kept, 0) AS n_removed,
            sha256(coalesce(kept, '')) AS kept_sha256
        FROM docs LEFT JOIN kept USING (doc_id)""",
    "op5_mixing": f"""
        WITH sizes AS (SELECT doc_id, source, CAST(len({WORDS}) AS BIGINT) AS size,
            md5(coalesce(CAST(doc_id AS VARCHAR), '') || ':' || md5(coalesce(text, ''))) AS drawn FROM documents),
        sums AS (
            SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM sizes GROUP BY source),
        weighed AS (
            SELECT *, CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3
                WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS weight FROM sums),
        shared AS (
            SELECT *, row_number() OVER by_cap AS nth,
                sum(source_size) OVER () - coalesce(3 * sum(source_size) OVER
                    (by_cap ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS left_over,
                sum(weight) OVER (by_cap ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS open
            FROM weighed WINDOW by_cap AS (ORDER BY source_size / weight, source NULLS LAST)),
        first_open AS (
            SELECT nth AS first_nth, left_over AS first_left, open AS first_sum FROM shared
            WHERE left_over * weight <= 3 * source_size * open ORDER BY nth LIMIT 1),
        targets AS (
            SELECT source, source_size, CASE WHEN nth < first_nth THEN CAST(3 * source_size AS DOUBLE)
                ELSE CAST(first_left * weight AS DOUBLE) / CAST(first_sum AS DOUBLE) END AS target
            FROM shared, first_open),
        copies AS (
            SELECT s.*, source_size, target, CASE WHEN source_size > 0
                THEN least(target / source_size, 3.0::DOUBLE) ELSE 0.0::DOUBLE END AS times,
                (CAST('0x' || substr(drawn, 1, 12) AS BIGINT) + 0.5::DOUBLE)
                    / 281474976710656.0::DOUBLE AS u
            FROM sizes s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source),
        ranked AS (
            SELECT *, floor(times) AS sure, times - floor(times) AS chance,
                target - floor(times) * source_size AS wanted FROM copies),
        placed AS (
            SELECT *, CASE WHEN chance > 0 AND size > 0 THEN
                (u / (1.0::DOUBLE - u)) / (chance / (1.0::DOUBLE - chance)) END AS rank FROM ranked),
        summed AS (
            SELECT *, sum(CASE WHEN rank IS NOT NULL THEN size END) OVER (
                PARTITION BY source ORDER BY rank NULLS LAST, doc_id, size
                ROWS UNBOUNDED PRECEDING) AS upto FROM placed)
        SELECT doc_id, size, source_size, target, CAST(size * (sure + CASE WHEN rank IS NOT NULL
            AND upto - CAST(size AS DOUBLE) / 2 <= wanted THEN 1 ELSE 0 END) AS BIGINT) AS taken
        FROM summed""",
    "op9_exact_dedup": f"""
        WITH digests AS (
            SELECT doc_id, sha256(translate(coalesce(text, ''), '{UPPER}', '{LOWER}')) AS text_sha256
            FROM documents)
        SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
            doc_id = max(doc_id) OVER same AS kept, text_sha256
        FROM digests WINDOW same AS (PARTITION BY text_sha256)""",
    "op12_fill_in_middle": """
        WITH drawn AS (
            SELECT doc_id, coalesce(text, '') AS text,
                regexp_extract_all(coalesce(text, ''), '[A-Za-z]+|[^A-Za-z]') AS units,
                sha256('1:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h FROM documents),
        numbered AS (
            SELECT *, CAST(len(units) AS BIGINT) AS n, CAST('0x' || h[1:8] AS BIGINT) AS h1,
                CAST('0x' || h[9:16] AS BIGINT) AS h2, CAST('0x' || h[17:24] AS BIGINT) AS h3,
                CAST('0x' || h[25:32] AS BIGINT) AS h4 FROM drawn),
        cut AS (
            SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
                CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>')
                    OR contains(text, '<M>') OR h3 % 100 >= 90 THEN 'plain'
                    WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form FROM numbered),
        pieces AS (
            SELECT *, array_to_string(units[1:a], '') AS prefix, array_to_string(units[a + 1:b], '') AS middle,
                array_to_string(units[b + 1:], '') AS suffix FROM cut)
        SELECT doc_id, n, form,
            CASE WHEN form <> 'plain' THEN length(prefix) END AS prefix_chars,
            CASE WHEN form <> 'plain' THEN length(middle) END AS middle_chars,
            sha256(CASE form WHEN 'plain' THEN text
                WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
                ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
            sha256(text) AS restored_sha256
        FROM pieces""",
    "op13_spelling": f"""
        WITH RECURSIVE crc AS (
            SELECT list_transform(range(256), lambda x: list_reduce(list_prepend(x, range(8)), lambda c, i:
                CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END)) AS steps),
        runs AS (
            SELECT doc_id, run, count(*) AS times
            FROM (SELECT doc_id, unnest(regexp_extract_all(
                translate(text, '{UPPER}', '{LOWER}'), '[a-z\u00C0-\u00FF]+')) AS run FROM documents)
            GROUP BY doc_id, run),
        coded AS (
            SELECT run, times, hex(coalesce(CAST(doc_id AS VARCHAR), '') || ':' || run) AS code FROM runs),
        spelled AS (
            SELECT run, times, list_transform(range(len(code) // 2), lambda i:
                CAST('0x' || substr(code, 2 * i + 1, 2) AS BIGINT)) AS bytes FROM coded),
        hashed AS (
            SELECT run, times, xor(4294967295, list_reduce(list_prepend(4294967295, bytes), lambda c, b:
                xor(c // 256, steps[(xor(c, b) % 256) + 1]))) AS h FROM spelled, crc),
        words AS (
            SELECT CASE WHEN h % 199 = 0 THEN substr(run, 1, h % length(run))
                || substr(run, (h % length(run)) + 2) ELSE run END AS word, CAST(sum(times) AS BIGINT) AS n
            FROM hashed GROUP BY word HAVING length(word) >= 6 AND sum(times) >= 5),
        cut AS (
            SELECT word, n, i, substr(word, 1, i - 1) || substr(word, i + 1) AS rest
            FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM words)),
        shorter AS (
            SELECT DISTINCT cut.word AS long_word, cut.n AS long_n, words.word AS short_word, words.n AS short_n
            FROM cut JOIN words ON rest = words.word),
        near AS (
            SELECT a.word, b.word AS near, b.n AS near_n
            FROM cut a JOIN cut b ON a.rest = b.rest AND a.i = b.i AND a.word <> b.word
            UNION ALL SELECT long_word, short_word, short_n FROM shorter
            UNION ALL SELECT short_word, long_word, long_n FROM shorter),
        best AS (
            SELECT word, count(*) OVER (PARTITION BY word) AS n_near, near, near_n FROM near
            QUALIFY row_number() OVER (PARTITION BY word ORDER BY near_n DESC, near) = 1),
        forms AS (
            SELECT word, n, coalesce(n_near, 0) AS n_near, CASE WHEN near_n >= 5 * n THEN near END AS form,
                CASE WHEN near_n >= 5 * n THEN near_n END AS form_n FROM words LEFT JOIN best USING (word)),
        walk AS (
            SELECT word, form AS place FROM forms WHERE form IS NOT NULL
            UNION ALL SELECT walk.word, forms.form FROM walk JOIN forms ON place = forms.word
            WHERE forms.form IS NOT NULL),
        ends AS (
            SELECT walk.word, place FROM walk JOIN forms ON place = forms.word WHERE forms.form IS NULL)
        SELECT word, form, coalesce(place, word) AS root, n, n_near, form_n
        FROM forms LEFT JOIN ends USING (word)""",
}
