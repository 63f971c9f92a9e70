"""The queries once more as SQL for another engine, to compare results."""

from __future__ import annotations

from evenkeel.functions import patterns as P
from evenkeel.plans import standins as S

# RE2 syntax: no (?d), \z is the same.
RX_WEBSITE = P.RX_WEBSITE.removeprefix("(?d)")


def text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def listed(values) -> str:
    return "(" + ", ".join(text(v) for v in values) + ")"


LINKS = f"""
p AS (SELECT page_id, html, CASE WHEN starts_with(bare, 'www.') THEN bare ELSE 'www.' || bare END AS link
      FROM (SELECT *, regexp_replace(url, {text(P.RX_SCHEME)}, '') AS bare FROM pages)),
pl AS (SELECT *, nullif(regexp_extract(link, {text(RX_WEBSITE)}), '') AS website,
              sha256(link) AS link_hash FROM p),
ul AS (SELECT DISTINCT link, link_hash FROM pl WHERE link IS NOT NULL)"""

KEYED = LINKS + """,
keyed AS (SELECT link, website, link_hash,
                 d.source || chr(10) || d.lang || chr(10) || d.text AS response
          FROM pl JOIN documents d ON pl.page_id = d.doc_id % (SELECT count(*) FROM pages))"""

ROW = """md5(to_json({'link': link, 'link_hash': link_hash, 'response': response,
                      'website': website})::VARCHAR)"""

PREPARED = KEYED + f""",
counts AS (SELECT website, count(*) AS n FROM keyed WHERE website IS NOT NULL GROUP BY 1),
held AS (SELECT website FROM counts ORDER BY n, website LIMIT 16),
split AS (SELECT website, n, website NOT IN (SELECT website FROM held) AS train FROM counts),
quota AS (SELECT train, min(n) AS quota FROM split GROUP BY 1),
prepared AS (
  SELECT link, website, link_hash, response, train
  FROM keyed JOIN split USING (website) JOIN quota USING (train)
  QUALIFY row_number() OVER (PARTITION BY website ORDER BY md5('0:' || link), {ROW}) <= quota)"""

CLEAN = f"""regexp_replace(regexp_replace(html, {text(P.RX_NONTEXT_PLAIN)}, '\\1\\2', 'g'),
             {text(P.RX_BLANKS)}, ' ', 'g')"""

LISTING = """
listing AS (SELECT link_hash || '.html' AS file_name FROM pl WHERE page_id % 5 = 0
            UNION ALL SELECT 'page-' || page_id || '.html' FROM pl WHERE page_id % 17 = 0)"""

TABLE_LISTING = """
listing AS (SELECT link_hash || '.html' AS file_name FROM pl WHERE page_id % 5 = 0)"""

PLAN = LINKS + "," + LISTING + """,
failed AS (SELECT DISTINCT 'http://' || link AS url FROM pl WHERE page_id % 7 = 0),
classed AS (SELECT link, link_hash, 'http://' || link AS url, md5('0:' || link) AS crawl_order,
                   CASE WHEN link_hash || '.html' IN (SELECT file_name FROM listing) THEN 'cached'
                        WHEN 'http://' || link IN (SELECT url FROM failed) THEN 'known_failed'
                        ELSE 'pending' END AS status FROM ul),
plan AS (SELECT link, link_hash, url, crawl_order,
                CASE WHEN status = 'pending'
                      AND row_number() OVER (PARTITION BY status ORDER BY crawl_order)
                          > greatest((SELECT count(*) FROM pages) // 2 - (SELECT count(*) FROM listing), 0)
                     THEN 'backlog' ELSE status END AS status FROM classed)"""

MIGRATION = LINKS + """,
names AS (SELECT DISTINCT file_name FROM (
    SELECT md5('http://' || link) || '.html' AS file_name FROM pl WHERE page_id % 3 != 0 OR page_id % 5 = 0
    UNION ALL SELECT link_hash || '.html' FROM pl WHERE page_id % 3 = 0 OR page_id % 5 = 0
    UNION ALL SELECT 'page-' || page_id || '.html' FROM pl WHERE page_id % 17 = 0)),
mapping AS (SELECT md5('http://' || link) || '.html' AS old_name, link_hash || '.html' AS new_name FROM ul),
actions AS (SELECT file_name, m.new_name,
      CASE WHEN file_name IN (SELECT new_name FROM mapping) THEN 'already_migrated'
           WHEN m.new_name IS NULL THEN 'unmatched'
           WHEN m.new_name IN (SELECT file_name FROM names) THEN 'conflict'
           ELSE 'rename' END AS action
      FROM names LEFT JOIN mapping m ON m.old_name = file_name),
plan AS (SELECT file_name, CASE WHEN action IN ('conflict', 'rename') THEN new_name END AS new_name, action
         FROM actions)"""

ATTEMPTS = """
log AS (SELECT event_id, ts, strftime(ts, '%Y-%m-%d') AS day,
               'http://www.u' || user_id || '.com/' AS url, value,
               CASE event_type WHEN 'error' THEN 'failed' WHEN 'purchase' THEN 'saved'
                               ELSE 'responded' END AS kind,
               CASE WHEN event_type != 'error' THEN 200
                    WHEN json_extract_string(props, '$.k')::INTEGER % 4 = 1 THEN 404
                    WHEN json_extract_string(props, '$.k')::INTEGER % 4 = 2 THEN 429
                    WHEN json_extract_string(props, '$.k')::INTEGER % 4 = 3 THEN 503 END AS status
        FROM events),
closed AS (SELECT *, count(*) FILTER (kind != 'failed') OVER (
               PARTITION BY day, url ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS c
           FROM log),
numbered AS (SELECT *, (row_number() OVER (PARTITION BY day, url, c ORDER BY ts, event_id) - 1) % 2 + 1 AS attempt
             FROM closed),
a AS (SELECT *, day || '/' || count(*) FILTER (attempt = 1) OVER (
                    PARTITION BY day, url ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS run,
             (epoch_us(ts) // 60000000) * 60 AS tick,
             CASE WHEN status IS NOT NULL THEN round(value * 100)::BIGINT END AS bytes FROM numbered)"""

OUTCOMES = ATTEMPTS + """,
outcomes AS (SELECT run, url, max(attempt)::INTEGER AS attempts,
                    min(CASE WHEN attempt = 1 AND kind = 'failed' THEN ts END) AS failed_at,
                    CASE WHEN bool_or(kind = 'saved') THEN 'saved'
                         WHEN count(*) FILTER (kind = 'failed') = 2 THEN 'failed_permanently'
                         WHEN count(*) FILTER (kind = 'failed') = 1 AND count(*) = 1 THEN 'retry_pending'
                         ELSE 'responded_not_saved' END AS outcome
             FROM a GROUP BY 1, 2)"""

OUTCOME_COLUMNS = """SELECT run, url, attempts, outcome,
       (epoch_us(failed_at) // 1000000)::BIGINT AS first_failure FROM outcomes"""

POINTS = ATTEMPTS + """,
points AS (
  SELECT run, tick, 'rate/requests_per_min' AS tag, count(*)::DOUBLE AS value FROM a GROUP BY 1, 2
  UNION ALL SELECT run, tick, 'rate/responses_per_min', count(status)::DOUBLE FROM a GROUP BY 1, 2
  UNION ALL SELECT run, tick, 'rate/htmls_per_min', count(*) FILTER (kind = 'saved')::DOUBLE
            FROM a GROUP BY 1, 2
  UNION ALL SELECT run, tick, 'rate/failed_permanently_per_min',
                   count(*) FILTER (kind = 'failed' AND attempt = 2)::DOUBLE FROM a GROUP BY 1, 2
  UNION ALL SELECT run, tick, 'rate/mb_per_min', coalesce(sum(bytes), 0)::DOUBLE / 1000000.0::DOUBLE
            FROM a GROUP BY 1, 2
  UNION ALL SELECT run, tick, 'http/' || status || '_per_min', count(*)::DOUBLE FROM a
            WHERE status IS NOT NULL GROUP BY 1, 2, status)"""

FILLED = POINTS + """,
every AS (SELECT run, tag, unnest(generate_series(first_tick, last_tick, 60)) AS tick
          FROM (SELECT run, tag, min(tick) AS first_tick FROM points GROUP BY 1, 2)
          JOIN (SELECT run, max(tick) AS last_tick FROM points GROUP BY 1) USING (run)),
filled AS (SELECT run, tick, tag, coalesce(value, 0) AS value
           FROM every LEFT JOIN points USING (run, tag, tick))"""


def stepped(table: str, where: str = "") -> str:
    return f"""SELECT run, tick, ((tick - min(tick) OVER (PARTITION BY run)) // 60 + 1)::BIGINT AS step,
       tag, value FROM {table} {where}"""


SENTENCES = f"""
steps AS (SELECT doc_id, unnest(lines) AS line, (generate_subscripts(lines, 1) - 1)::INTEGER AS step
          FROM (SELECT doc_id, string_split(text, chr(10)) AS lines FROM documents)),
found AS (SELECT doc_id, step, regexp_extract_all(replace(line, '; ', '. '),
                                                  {text(P.RX_SENTENCE)}) AS s FROM steps),
sentences AS (SELECT doc_id, step, sentence_no::INTEGER AS sentence_no,
                     trim(s[sentence_no + 1], {text(P.WHITE_SPACE)}) AS sentence
              FROM (SELECT *, unnest(CASE WHEN len(s) = 0 THEN [NULL]
                                          ELSE range(len(s)) END) AS sentence_no FROM found))"""


def token_ids(column: str) -> str:
    return (f"[('0x' || substr(md5(t), 1, 7))::INTEGER % 32752 + 16 "
            f"for t in regexp_extract_all({column}, {text(P.RX_TOKEN)})]")


TOKENS = f"""
rendered AS (SELECT doc_id, text AS response,
                    '<|im_start|>user' || chr(10) || {CLEAN} || '<|im_end|>' || chr(10)
                    || '<|im_start|>assistant' || chr(10) AS prompt
             FROM pages JOIN documents ON page_id = doc_id % (SELECT count(*) FROM pages)),
tokens AS (SELECT doc_id, {token_ids("prompt")} AS pi,
                  list_concat({token_ids("response")}, [1]) AS ri FROM rendered),
masked AS (SELECT doc_id, list_concat(pi, ri) AS ids,
                  list_concat([-100 for t in pi], ri) AS labels FROM tokens)"""

STATS = f"""
stats AS (SELECT count(*) AS rows, max(n)::BIGINT AS max_tokens, sum(n)::DOUBLE / count(*) AS mean_tokens,
                 median(n)::DOUBLE AS median_tokens
          FROM (SELECT len(regexp_extract_all(html, {text(P.RX_TOKEN)})) AS n FROM source_pages))
SELECT *, max_tokens * max_tokens * 2 AS attn_matrix_bytes_fp16_max,
       mean_tokens * mean_tokens * 2 AS attn_matrix_bytes_fp16_mean,
       median_tokens * median_tokens * 2 AS attn_matrix_bytes_fp16_median FROM stats"""

SQL: dict[str, str] = {
    "format_links": f"WITH {LINKS} SELECT page_id, link FROM p",
    "extract_websites": f"""WITH {LINKS} SELECT page_id, link, website,
        nullif(regexp_extract(link, {text(P.RX_WEBSITE_STRICT)}), '') AS website_strict FROM pl""",
    "build_responses": """SELECT doc_id, source || chr(10)
        || CASE WHEN doc_id % 10 != 0 THEN lang END || chr(10) || text AS response FROM documents""",
    "link_keys": f"""WITH {LINKS} SELECT page_id, link, link_hash,
        md5('http://' || link) || '.html' AS legacy_name, 'http://' || link AS fetch_url FROM pl""",
    "unique_links": f"WITH {LINKS} SELECT link, link_hash FROM ul",
    "website_distribution": f"""WITH {LINKS} SELECT website, count(*) AS n,
        count(*)::DOUBLE / (SELECT count(*) FROM pl) AS frequency FROM pl GROUP BY 1""",
    "group_split": f"""WITH {LINKS},
        held AS (SELECT website FROM pl WHERE website IS NOT NULL GROUP BY 1
                 ORDER BY count(*), website LIMIT 16)
        SELECT page_id, website, coalesce(website IN (SELECT website FROM held), FALSE) AS eval FROM pl""",
    "balanced_sample": f"""WITH {LINKS},
        least_n AS (SELECT min(n) AS n FROM (SELECT count(*) AS n FROM pl WHERE website IS NOT NULL
                                             GROUP BY website))
        SELECT page_id, link, website FROM pl WHERE website IS NOT NULL
        QUALIFY row_number() OVER (PARTITION BY website ORDER BY md5('0:' || link),
            md5(to_json({{'link': link, 'page_id': page_id, 'website': website}})::VARCHAR))
            <= (SELECT n FROM least_n)""",
    "balanced_targets": """WITH least_n AS (SELECT min(n) AS n FROM (
            SELECT count(*) AS n FROM documents WHERE lang IS NOT NULL GROUP BY lang))
        SELECT doc_id, lang FROM documents WHERE lang IS NOT NULL
        QUALIFY row_number() OVER (PARTITION BY lang ORDER BY md5('0:' || doc_id))
            <= (SELECT n FROM least_n)""",
    "balanced_copies": """WITH least_n AS (SELECT min(n) AS n FROM (
            SELECT count(*) AS n FROM documents WHERE lang IS NOT NULL GROUP BY lang))
        SELECT lang, source FROM documents WHERE lang IS NOT NULL
        QUALIFY row_number() OVER (PARTITION BY lang ORDER BY md5('0:' || source))
            <= (SELECT n FROM least_n)""",
    "rejected_rows": f"""WITH {LINKS},
        cut AS (SELECT page_id, CASE WHEN page_id % 11 = 0 THEN split_part(link, '/', 1) ELSE link END AS link FROM pl)
        SELECT page_id, link, NULL::VARCHAR AS website FROM cut
        WHERE nullif(regexp_extract(link, {text(RX_WEBSITE)}), '') IS NULL""",
    "dedup_rare_first": """WITH counts AS (SELECT lang, count(*) AS n FROM documents GROUP BY 1)
        SELECT doc_id, lang, text AS response FROM documents JOIN counts USING (lang)
        QUALIFY row_number() OVER (PARTITION BY text ORDER BY n, lang, doc_id) = 1""",
    "prepared_dataset": f"WITH {PREPARED} SELECT * FROM prepared",
    "split_report": f"""WITH {PREPARED},
        sizes AS (SELECT count(*) FILTER (train) AS train_rows, count(*) FILTER (NOT train) AS eval_rows,
                         (SELECT count(*) FROM keyed) AS rows_before FROM prepared)
        SELECT train_rows, eval_rows, eval_rows::DOUBLE / nullif(train_rows, 0) AS eval_to_train,
               rows_before, train_rows + eval_rows AS rows_after,
               rows_before - train_rows - eval_rows AS rows_lost FROM sizes""",
    "clean_html": f"SELECT page_id, {CLEAN} AS html_data FROM pages",
    "scraped_only": f"""WITH {KEYED} SELECT link, website, link_hash FROM keyed
        WHERE link_hash IN (SELECT link_hash FROM pl WHERE page_id % 5 != 0)""",
    "training_table": f"""WITH {KEYED},
        held AS (SELECT website FROM keyed WHERE website IS NOT NULL GROUP BY 1
                 ORDER BY count(*), website LIMIT 16),
        store AS (SELECT link_hash, {CLEAN} AS html_data FROM pl WHERE page_id % 5 != 0),
        scraped AS (SELECT *, website NOT IN (SELECT website FROM held) AS train FROM keyed
                    WHERE website IS NOT NULL AND link_hash IN (SELECT link_hash FROM store)),
        least_n AS (SELECT min(n) AS n FROM (SELECT count(*) AS n FROM scraped GROUP BY website)),
        drawn AS (SELECT * FROM scraped QUALIFY row_number() OVER (
            PARTITION BY website ORDER BY md5('0:' || link),
            md5(to_json({{'link': link, 'link_hash': link_hash, 'response': response, 'train': train,
                          'website': website}})::VARCHAR)) <= (SELECT n FROM least_n))
        SELECT link, website, link_hash, response, train, 'user' AS role, html_data AS content
        FROM drawn JOIN store USING (link_hash)""",
    "crawl_plan": f"WITH {PLAN} SELECT * FROM plan",
    "crawl_plan_report": f"""WITH {PLAN} SELECT count(*) AS links,
        count(*) FILTER (status = 'cached') AS cached,
        count(*) FILTER (status = 'known_failed') AS known_failed,
        count(*) FILTER (status = 'pending') AS pending,
        count(*) FILTER (status = 'backlog') AS backlog,
        (SELECT count(*) FROM listing) AS already_cached FROM plan""",
    "crawl_outcome": f"WITH {OUTCOMES} {OUTCOME_COLUMNS}",
    "retry_batches": f"""WITH {OUTCOMES} SELECT run, url,
        ((row_number() OVER (ORDER BY failed_at, md5('0:' || url), url) - 1)
         // 100)::BIGINT AS retry_batch FROM outcomes WHERE outcome = 'retry_pending'""",
    "permanent_failures": f"WITH {OUTCOMES} SELECT url FROM outcomes WHERE outcome = 'failed_permanently'",
    "crawl_rates": f"WITH {POINTS} {stepped('points')}",
    "crawl_rates_filled": f"WITH {FILLED} {stepped('filled')}",
    "counter_deltas": f"""WITH {FILLED},
        totals AS (SELECT run, tick, tag, sum(CASE WHEN tag = 'rate/mb_per_min' THEN round(value * 1000000)
                                                   ELSE value END) OVER w AS total FROM filled
                   WINDOW w AS (PARTITION BY run, tag ORDER BY tick ROWS UNBOUNDED PRECEDING)),
        deltas AS (SELECT run, tick, tag, total - coalesce(lag(total) OVER w, 0) AS grown FROM totals
                   WINDOW w AS (PARTITION BY run, tag ORDER BY tick)),
        found AS (SELECT run, tick, tag, CASE WHEN tag = 'rate/mb_per_min' THEN grown / 1000000.0::DOUBLE
                                              ELSE grown END AS value FROM deltas)
        {stepped('found')}""",
    "crawl_progress": f"""WITH {ATTEMPTS},
        sizes AS (SELECT run, count(DISTINCT url) AS pending, count(DISTINCT url) // 10 AS backlog
                  FROM a GROUP BY 1),
        totals AS (SELECT run, tick, sum(s) OVER w AS saved, sum(f) OVER w AS failed, sum(q) OVER w AS queued
                   FROM (SELECT run, tick, count(*) FILTER (kind = 'saved') AS s,
                                count(*) FILTER (kind = 'failed' AND attempt = 2) AS f,
                                count(*) FILTER (kind = 'failed' AND attempt = 1)
                                - count(*) FILTER (attempt = 2) AS q FROM a GROUP BY 1, 2)
                   WINDOW w AS (PARTITION BY run ORDER BY tick)),
        wide AS (SELECT *, least(failed, backlog) AS drawn FROM totals JOIN sizes USING (run)),
        points AS (
          SELECT run, tick, 'progress/htmls_saved_total' AS tag, saved::DOUBLE AS value FROM wide
          UNION ALL SELECT run, tick, 'progress/failed_permanently_total', failed::DOUBLE FROM wide
          UNION ALL SELECT run, tick, 'progress/backlog_drawn_total', drawn::DOUBLE FROM wide
          UNION ALL SELECT run, tick, 'progress/remaining', (pending - saved - (failed - drawn))::DOUBLE
                    FROM wide
          UNION ALL SELECT run, tick, 'progress/retry_queue', queued::DOUBLE FROM wide)
        {stepped('points')}""",
    "key_audit": f"""WITH {LINKS},
        stored AS (SELECT DISTINCT link, CASE WHEN page_id % 11 = 0 THEN reverse(link_hash)
                                              ELSE link_hash END AS link_hash FROM pl),
        source AS (SELECT DISTINCT link, link_hash AS link_hash_recomputed FROM pl WHERE page_id % 13 != 0)
        SELECT link, link_hash, link_hash_recomputed,
               CASE WHEN link_hash_recomputed IS NULL THEN 'missing'
                    WHEN link_hash != link_hash_recomputed THEN 'mismatched' ELSE 'ok' END AS verdict
        FROM stored LEFT JOIN source USING (link)""",
    "key_collisions": f"""WITH {LINKS},
        mapping AS (SELECT md5('http://' || website) || '.html' AS old_name,
                           link_hash || '.html' AS new_name FROM pl
                    UNION SELECT md5('http://' || link) || '.html', sha256(website) || '.html'
                    FROM pl WHERE page_id % 2 = 0)
        SELECT 'old_to_many' AS kind, old_name AS name, count(*) AS n FROM mapping GROUP BY 2
        HAVING count(*) > 1
        UNION ALL SELECT 'many_to_new', new_name, count(*) FROM mapping GROUP BY 2 HAVING count(*) > 1""",
    "key_migration_plan": f"WITH {MIGRATION} SELECT * FROM plan",
    "key_migration_report": f"""WITH {MIGRATION} SELECT count(*) AS files,
        count(*) FILTER (action = 'rename') AS rename,
        count(*) FILTER (action = 'already_migrated') AS already_migrated,
        count(*) FILTER (action = 'conflict') AS conflict,
        count(*) FILTER (action = 'unmatched') AS unmatched,
        count(*) FILTER (action = 'ambiguous') AS ambiguous FROM plan""",
    "key_migration_examples": f"""WITH {MIGRATION}
        (SELECT * FROM plan WHERE action = 'conflict' ORDER BY file_name LIMIT 10)
        UNION ALL (SELECT * FROM plan WHERE action = 'rename' ORDER BY file_name LIMIT 3)""",
    "migrated_keys": f"""WITH {MIGRATION},
        store AS (SELECT md5('http://' || link) AS k FROM pl WHERE page_id % 3 != 0 OR page_id % 5 = 0
                  UNION ALL SELECT link_hash FROM pl WHERE page_id % 3 = 0 OR page_id % 5 = 0
                  UNION ALL SELECT 'page-' || page_id FROM pl WHERE page_id % 17 = 0)
        SELECT CASE WHEN action = 'rename' THEN replace(new_name, '.html', '') ELSE k END AS link_hash
        FROM store JOIN plan ON file_name = k || '.html'""",
    "direction_sentences": f"WITH {SENTENCES} SELECT doc_id, step, sentence_no, sentence FROM sentences",
    "phrasal_pairs": f"""WITH {SENTENCES},
        words AS (SELECT doc_id, step, sentence_no, unnest(w) AS word, generate_subscripts(w, 1) AS pos
                  FROM (SELECT *, regexp_extract_all(lower(sentence), {text(P.RX_WORD)}) AS w
                        FROM sentences WHERE sentence IS NOT NULL)),
        hits AS (SELECT p.doc_id, p.step, p.sentence_no, p.pos,
                        arg_max(v.word, v.pos) || ' ' || any_value(p.word) AS pair
                 FROM words p JOIN words v ON v.doc_id = p.doc_id AND v.step = p.step
                      AND v.sentence_no = p.sentence_no AND v.pos BETWEEN p.pos - 4 AND p.pos - 1
                 WHERE p.word IN {listed(S.PARTICLES)} AND v.word IN {listed(S.VERBS)}
                 GROUP BY 1, 2, 3, 4)
        SELECT d.doc_id, count(pair) AS n,
               coalesce(string_agg(pair, '|' ORDER BY step, sentence_no, pos), '') AS pairs
        FROM documents d LEFT JOIN hits h ON h.doc_id = d.doc_id GROUP BY 1""",
    "chat_render": """SELECT conv_id, turn, '<|im_start|>' || role || chr(10) || text || '<|im_end|>'
        || chr(10) || '<|im_start|>assistant' || chr(10) AS prompt FROM conversations""",
    "chat_conversations": """SELECT conv_id, count(*) AS messages,
        string_agg('<|im_start|>' || role || chr(10) || text || '<|im_end|>' || chr(10), ''
                   ORDER BY turn, role, text) || '<|im_start|>assistant' || chr(10) AS prompt
        FROM conversations GROUP BY 1""",
    "chat_json_roundtrip": """SELECT conv_id, turn, 1::BIGINT AS messages,
        json_extract_string(j, '$.role') AS role, json_extract_string(j, '$.content') AS content
        FROM (SELECT conv_id, turn, to_json({'role': role, 'content': text}) AS j FROM conversations)""",
    "tokenize_examples": f"""WITH {TOKENS} SELECT doc_id, array_to_string(pi, ',') AS prompt_ids,
        array_to_string(ri, ',') AS response_ids FROM tokens""",
    "label_mask": f"""WITH {TOKENS} SELECT doc_id, array_to_string(ids, ',') AS input_ids,
        array_to_string(labels, ',') AS labels FROM masked""",
    "training_batches": f"""WITH {TOKENS},
        placed AS (SELECT *, row_number() OVER (ORDER BY md5('42:' || doc_id), doc_id) AS position
                   FROM masked),
        batched AS (SELECT *, (position - 1) // 8 AS batch FROM placed),
        wide AS (SELECT *, max(len(ids)) OVER (PARTITION BY batch) AS width FROM batched)
        SELECT doc_id, position, batch::BIGINT AS batch, width,
               md5(array_to_string(list_concat(ids, [0 for i in range(width - len(ids))]), ',')) AS input_ids,
               md5(array_to_string(list_concat(labels, [-100 for i in range(width - len(ids))]), ','))
                   AS labels, len(ids) AS attended FROM wide""",
    "token_stats": f"WITH source_pages AS (SELECT html FROM pages), {STATS}",
    "token_stats_first_pages": f"""WITH source_pages AS (SELECT html FROM pages ORDER BY page_id LIMIT 100),
        {STATS}""",
    "crawl_rates_stream": f"WITH {POINTS} {stepped('points')}",
    "crawl_outcome_stream": f"WITH {OUTCOMES} {OUTCOME_COLUMNS}",
    "csv_recipes": """SELECT source AS title, doc_id::VARCHAR AS link, md5('a "b", c' || chr(10) || text) AS directions,
        NULL::VARCHAR AS bad FROM documents
        UNION ALL SELECT 'short', NULL, NULL, 'short,' || doc_id FROM documents""",
    "page_files": f"WITH {LINKS} SELECT link_hash, md5(html) AS html FROM pl",
    "page_table_roundtrip": f"WITH {LINKS} SELECT link_hash, md5({CLEAN}) AS html_data FROM pl",
    "bucketed_training": f"""WITH {KEYED} SELECT link, website, link_hash, md5(response) AS response,
               (SELECT any_value(md5({CLEAN})) FROM pl WHERE pl.link_hash = k.link_hash) AS html_data
        FROM keyed k WHERE link_hash IN (SELECT link_hash FROM pl WHERE page_id % 5 != 0)""",
    "backlog_draws": f"""WITH {PLAN}, {ATTEMPTS.strip()},
        failures AS (SELECT day AS run, url || '#' || run AS url, min(ts) AS failed_at FROM a
                     WHERE kind = 'failed' AND attempt = 2 GROUP BY 1, 2),
        placed AS (SELECT *, row_number() OVER (PARTITION BY run ORDER BY failed_at, md5('0:' || url), url) AS position
                   FROM failures),
        waiting AS (SELECT strftime(date '{S.FIRST_DAY}' + ('0x' || substr(crawl_order, 1, 4))::INTEGER % {S.DAYS}, '%Y-%m-%d')
                               AS run, url, crawl_order FROM plan WHERE status = 'backlog'),
        drawn AS (SELECT run, url AS replacement, row_number() OVER (PARTITION BY run ORDER BY crawl_order, url) AS position
                  FROM waiting)
        SELECT run, url, position, replacement FROM placed LEFT JOIN drawn USING (run, position)""",
    "progress_marks": f"""WITH {ATTEMPTS},
        links AS (SELECT *, url || '#' || run AS link FROM a),
        ends AS (SELECT link, ts, kind = 'saved' AS is_saved FROM links
                 WHERE kind = 'saved' OR (kind = 'failed' AND attempt = 2)),
        counted AS (SELECT *, count(*) FILTER (is_saved) OVER w AS saved, count(*) FILTER (NOT is_saved) OVER w AS failed
                    FROM ends WINDOW w AS (ORDER BY ts, md5('0:' || link), link ROWS UNBOUNDED PRECEDING)),
        sizes AS (SELECT count(DISTINCT link) AS pending FROM links)
        SELECT '2024' AS run, link AS url, epoch_us(ts) AS ts, saved,
               pending - saved - greatest(failed - pending // 10, 0) AS remaining
        FROM counted, sizes WHERE is_saved AND saved % 100 = 0""",
    "retry_events": f"""WITH {OUTCOMES} SELECT run, url, CASE outcome WHEN 'retry_pending' THEN 'retry_due' ELSE outcome END
        AS event, (epoch_us(failed_at) // 1000000)::BIGINT AS first_failure
        FROM outcomes WHERE outcome IN ('retry_pending', 'failed_permanently')""",
    "token_stats_merged": f"""SELECT count(*) AS rows, max(n)::BIGINT AS max_tokens, sum(n)::DOUBLE / count(*) AS mean_tokens,
               true AS median_in_bound
        FROM (SELECT len(regexp_extract_all(html, {text(P.RX_TOKEN)})) AS n FROM pages)""",
    "crawl_plan_page_table": f"WITH {PLAN.replace(LISTING, TABLE_LISTING)} SELECT * FROM plan",
    "failed_log_roundtrip": f"""WITH {LINKS}, {OUTCOMES.strip()}
        SELECT url FROM outcomes WHERE outcome = 'failed_permanently'
        UNION SELECT 'http://' || link FROM pl WHERE page_id % 7 = 0""",
    "shuffled_order": """SELECT doc_id, md5(text) AS text, row_number() OVER (ORDER BY md5('42:' || doc_id), doc_id) AS position
        FROM documents""",
    "points_roundtrip": f"WITH {POINTS} {stepped('points')}",
}
SQL |= {"ordered_batches": SQL["training_batches"], "prepared_roundtrip": SQL["prepared_dataset"], "training_roundtrip": SQL["training_table"],
        "scraped_only_filtered": SQL["scraped_only"], "crawl_rates_compacted": SQL["crawl_rates_stream"],
        "crawl_outcome_compacted": SQL["crawl_outcome_stream"], "converted_pages": SQL["page_table_roundtrip"],
        "training_stream": f"SELECT link, link_hash, md5(response) AS response FROM ({SQL['training_table']}) WHERE train"}
