"""SQL counterparts of the queries over several runs, batches or stored states."""

from __future__ import annotations

from newsloom.catalog.oracles import (
    _ARTICLES,
    _DOCS,
    _PAGE_LINKS,
    _RULES,
    CONFIG,
    canonical,
    content,
    domain,
    iso,
    key,
    lang,
    ruled,
    shown,
    site,
    trim,
)
from newsloom.catalog.stand_ins import LANGS

stream_seen_state = f"""
WITH arrivals AS (
  SELECT 0 AS batch, page_id, url AS raw, html FROM pages WHERE regexp_matches(url, '[?#]')
  UNION ALL
  SELECT 1, page_id, url, CASE WHEN {lang('url')} = 'fr' THEN html || 'x' ELSE html END FROM pages
),
per_url AS (
  SELECT batch, {canonical('raw')} AS url, arg_max(md5(html), page_id) AS content_hash,
         count(*) AS n, min(page_id) AS low, max(page_id) AS high
  FROM arrivals GROUP BY 1, 2
)
SELECT p.batch, p.url, p.content_hash,
       CASE WHEN b.url IS NULL THEN 'new' WHEN b.content_hash = p.content_hash THEN 'unchanged'
            ELSE 'updated' END AS change_status,
       p.n + coalesce(b.n, 0) AS n_seen,
       {iso("epoch_ms(least(p.low, b.low) * 1000)")} AS first_seen,
       {iso("epoch_ms(greatest(p.high, b.high) * 1000)")} AS last_seen
FROM per_url p LEFT JOIN per_url b ON p.batch = 1 AND b.batch = 0 AND b.url = p.url"""

answer_journal = f"""
WITH {_DOCS},
known AS (SELECT DISTINCT url FROM docs WHERE doc_id IN (SELECT doc_id FROM labels)),
short AS (SELECT doc_id, url, title, body AS excerpt FROM docs)
SELECT doc_id, CASE WHEN url IN (SELECT url FROM known) THEN 'first' ELSE 'second' END AS asked_by,
       {_RULES['startup_website']} AS startup_website
FROM short"""

link_changes = f"""
WITH {_PAGE_LINKS},
whole AS (
  SELECT url AS section_url, canon AS url, min(pos) - 1 AS pos FROM links WHERE pos > 0 GROUP BY 1, 2
),
one AS (SELECT * FROM whole WHERE regexp_matches(section_url, '[?#]')),
two AS (
  SELECT p.url AS section_url, l.url, min(l.link_pos) AS pos
  FROM page_links l JOIN pages p USING (page_id) GROUP BY 1, 2
),
three AS (SELECT * FROM whole WHERE contains(section_url, '?')),
names AS (SELECT section_url, url FROM one UNION SELECT section_url, url FROM two),
seen AS (
  SELECT n.*, o.pos AS first_pos, t.pos AS second_pos, h.pos AS third_pos,
         contains(n.section_url, '?') AS last_read
  FROM names n LEFT JOIN one o USING (section_url, url) LEFT JOIN two t USING (section_url, url)
  LEFT JOIN three h USING (section_url, url)
)
SELECT section_url, url,
       CASE WHEN first_pos IS NULL THEN 'run-2' ELSE 'run-1' END AS first_run,
       (CASE WHEN first_pos IS NULL THEN second_pos // 2 ELSE 0 END)::INTEGER AS first_step,
       coalesce(first_pos, second_pos)::BIGINT AS first_pos,
       CASE WHEN third_pos IS NOT NULL THEN 'run-3' WHEN second_pos IS NOT NULL THEN 'run-2'
            ELSE 'run-1' END AS last_run,
       CASE WHEN third_pos IS NOT NULL THEN NULL WHEN second_pos IS NULL THEN 'run-2'
            WHEN last_read THEN 'run-3' END AS gone_run,
       CASE WHEN NOT last_read THEN NULL
            WHEN third_pos IS NOT NULL AND second_pos IS NULL THEN 'back'
            WHEN third_pos IS NOT NULL THEN 'kept'
            WHEN second_pos IS NULL THEN 'still_gone' ELSE 'gone' END AS change
FROM seen"""

dense_summaries = """
WITH days AS (
  SELECT DISTINCT strftime(ts, '%Y-%m-%d') AS run_id FROM events UNION ALL SELECT '2024-12-31'
),
spine AS (
  SELECT run_id, unnest(['click', 'error', 'idle', 'purchase', 'signup', 'view']) AS id FROM days
),
per AS (
  SELECT strftime(ts, '%Y-%m-%d') AS run_id, event_type AS id, count(*) AS scanned,
         count(*) FILTER (WHERE value < 10) AS "new"
  FROM events GROUP BY 1, 2
),
dense AS (
  SELECT s.run_id, s.id, coalesce(scanned, 0) AS scanned, coalesce("new", 0) AS "new"
  FROM spine s LEFT JOIN per USING (run_id, id)
)
SELECT run_id, (sum(scanned) OVER day)::BIGINT AS total_scanned,
       (sum("new") OVER day)::BIGINT AS total_new,
       row_number() OVER (PARTITION BY run_id ORDER BY id) - 1 AS place, id, scanned, "new",
       scanned - "new" AS skipped
FROM dense WINDOW day AS (PARTITION BY run_id)"""

# thirty pages per run and domain: those never read (0), then those read longest ago
section_limit = f"""
WITH listed AS (
  SELECT {domain('url')} AS source_id, {site('url')} || '/list/' || page_id AS section_url, page_id
  FROM pages
),
one AS (
  SELECT *, CASE WHEN row_number() OVER (PARTITION BY source_id ORDER BY page_id) <= 30
                 THEN 1 ELSE 0 END AS run1
  FROM listed
),
two AS (
  SELECT *, CASE WHEN row_number() OVER (PARTITION BY source_id ORDER BY run1, page_id) <= 30
                 THEN 2 ELSE run1 END AS run2
  FROM one
),
three AS (
  SELECT *, CASE WHEN row_number() OVER (PARTITION BY source_id ORDER BY run2, page_id) <= 30
                 THEN 3 ELSE run2 END AS run3
  FROM two
)
SELECT source_id, section_url, nullif(run3, 0)::INTEGER AS run FROM three"""

_T, _B = shown('"text"')


def _judged(rows: str) -> str:
    """CTE ``judged``: the first outcome of rows (source_id, place, url, title, body, least)
    when nothing is known from earlier runs."""
    rules = ruled("title", "body")
    return f"""
hashed_rows AS (
  SELECT *, CASE WHEN title = '' THEN 'missing_title'
                 WHEN length({trim('body')}) < least THEN 'empty_body' END AS early,
         {content('title', 'body')} AS now
  FROM {rows}
),
keyed_rows AS (
  SELECT *, CASE WHEN early IS NULL THEN {key('url', 'now')} END AS key_now FROM hashed_rows
),
told_rows AS (
  SELECT *, key_now IS NOT NULL AND row_number() OVER (
           PARTITION BY source_id, key_now ORDER BY place) > 1 AS again,
         {rules['is_relevant']} AS is_relevant, {rules['startup_name']} AS startup_name,
         {rules['news_summary']} AS summary
  FROM keyed_rows
),
judged AS (
  SELECT source_id, url, key_now,
    CASE WHEN early IS NOT NULL OR again THEN 'skipped' WHEN NOT is_relevant THEN 'not_relevant'
         WHEN startup_name IS NULL OR summary IS NULL THEN 'error' ELSE 'new' END AS event,
    CASE WHEN early IS NOT NULL THEN early WHEN again THEN 'duplicate_in_run'
         WHEN is_relevant AND (startup_name IS NULL OR summary IS NULL)
         THEN 'incomplete_extraction' END AS reason
  FROM told_rows
)"""


_LISTED = f"""{_ARTICLES},
fetched AS (
  SELECT {canonical('url')} AS url, max(page_id) AS page_id FROM pages GROUP BY 1
),
listings AS (
  SELECT d AS source_id, k, 'https://list.example.' || d || '/' || k AS url
  FROM (SELECT unnest(['com', 'net']) AS d), range(11) r(k)
  WHERE k < 10 OR d = 'net'
),
listed AS (
  SELECT {domain('url')} AS source_id, page_id % 10 AS k, {canonical('url')} AS url,
         min(page_id) AS page_id
  FROM pages WHERE {domain('url')} <> 'org' GROUP BY 1, 2, 3
),
lost AS (
  SELECT source_id, url FROM listings
  WHERE (source_id, k) NOT IN (SELECT source_id, k FROM listed)
),
html_rows AS (
  SELECT l.source_id, l.k * 1000000000 + l.page_id AS place, l.url, a.title, a.body, 1 AS least
  FROM listed l JOIN fetched f USING (url) JOIN parsed a ON a.page_id = f.page_id
)"""

cycle = f"""
WITH {_LISTED},
snapshot_rows AS (
  SELECT lang AS source_id, min(doc_id) AS place,
         'https://docs.example.com/' || lang || '/' || md5("text") AS url, {_T} AS title,
         {_B} AS body, 80 AS least
  FROM documents WHERE lang IN {tuple(x for x in LANGS if x != 'es')} GROUP BY lang, "text"
),
rows_in AS (SELECT * FROM html_rows UNION ALL SELECT * FROM snapshot_rows),
{_judged('rows_in')}
SELECT source_id, event, url, reason, CASE WHEN event = 'new' THEN key_now END AS entry_key
FROM judged
UNION ALL
SELECT source_id, 'error', url, 'section_fetch: page not fetched', NULL FROM lost"""

listing_then_articles = f"""
WITH {_LISTED},
{_judged('html_rows')},
logged AS (
  SELECT 0 AS batch, source_id, 'error' AS event, 'article_fetch: page not fetched' AS reason
  FROM listed
  UNION ALL SELECT 1, source_id, event, reason FROM judged
  UNION ALL SELECT unnest([0, 1]), source_id, 'error', 'section_fetch: page not fetched' FROM lost
)
SELECT '{CONFIG.run_id}-00000000' || batch AS run_id, source_id, event, reason, count(*) AS n
FROM logged GROUP BY ALL"""

parser_plugins = f"""
WITH {_PAGE_LINKS},
own AS (
  SELECT page_id, count(DISTINCT canon) AS n FROM links WHERE pos > 0 AND path <> '/' GROUP BY 1
)
SELECT p.page_id,
       (CASE WHEN contains(html, 'worthless') THEN 0 ELSE coalesce(o.n, 0) END)::INTEGER AS n_links,
       CASE WHEN contains(html, 'worthless') THEN 'section_parse: ValueError: worthless page' END
         AS listing_error,
       CASE WHEN NOT contains(html, 'license')
            THEN {trim("split_part(split_part(html, '<title>', 2), '</title>', 1)")} END AS title,
       CASE WHEN contains(html, 'license') THEN 'article_parse: KeyError: ''license''' END
         AS article_error
FROM pages p LEFT JOIN own o USING (page_id)"""

truth_cases = """
SELECT doc_id, doc_id % 12 IN (0, 2, 5, 7) AS is_relevant,
       CASE WHEN doc_id % 12 < 8 THEN doc_id::VARCHAR WHEN doc_id % 12 = 8 THEN 'x' END
         AS startup_name,
       doc_id % 12 IN (9, 11) AS extraction_failed
FROM documents"""

recorded_files = f"""
SELECT 'https://docs.example.com/' || doc_id AS url, md5("text") AS content_hash,
       {iso('epoch_ms(doc_id * 1000)')} AS last_seen_at, 'earlier' AS last_run_id,
       lang <> 'es' AS extraction_complete, lang AS source_id, 'new' AS action,
       {iso('epoch_ms(doc_id * 1000)')} AS "at",
       md5('https://docs.example.com/' || lang || '/' || md5("text")) AS entry_key,
       1 AS attempt,
       24 + 17 * len(string_split("text", chr(10))) + length("text")
         + length("text") - length(replace("text", '"', '')) AS snapshot_chars
FROM documents"""

STATE_ORACLES: dict[str, str] = {
    "stream_seen_state": stream_seen_state,
    "answer_journal": answer_journal,
    "link_changes": link_changes,
    "dense_summaries": dense_summaries,
    "section_limit": section_limit,
    "cycle": cycle,
    "listing_then_articles": listing_then_articles,
    "parser_plugins": parser_plugins,
    "truth_cases": truth_cases,
    "recorded_files": recorded_files,
}
