"""SQL counterparts of the registered queries, for an independent engine.

Each is one statement over the test tables. Shared pieces are text snippets put
together here, as the statements cannot rely on functions defined beforehand.
"""

from __future__ import annotations

from newsloom.catalog.stand_ins import COMPLETED_AT, CONFIG, LANGS
from newsloom.functions.text import WS_CHARS

WS = WS_CHARS
PREFIX = CONFIG.entry_key_prefix


def trim(x: str) -> str:
    return f"trim({x}, '{WS}')"


def collapse(x: str) -> str:
    return f"regexp_replace({x}, '[{WS}]+', ' ', 'g')"


def text_of(x: str) -> str:
    """Markup to text."""
    x = f"regexp_replace({x}, '(?is)<script.*?</script>', ' ', 'g')"
    x = f"regexp_replace({x}, '(?is)<style.*?</style>', ' ', 'g')"
    x = f"regexp_replace({x}, '<[^>]+>', ' ', 'g')"
    for entity, char in (("&nbsp;", " "), ("&amp;", "&"), ("&lt;", "<"), ("&gt;", ">")):
        x = f"replace({x}, '{entity}', '{char}')"
    x = f"replace({x}, '&#039;', '''')"
    return trim(collapse(x))


def cut(x: str, n: int) -> str:
    return f"CASE WHEN length({x}) <= {n} THEN {x} ELSE substr({x}, 1, {n - 1}) || chr(8230) END"


def content(title: str, body: str) -> str:
    joined = f"{trim(title)} || chr(1) || {trim(body)}"
    return f"md5(lower({collapse(joined)}))"


def key(url: str, hash_: str) -> str:
    return f"md5('{PREFIX}:' || {url} || ':' || {hash_})"


def canonical(u: str) -> str:
    base = f"split_part(split_part({u}, '#', 1), '?', 1)"
    host = f"regexp_replace(lower(regexp_extract({base}, '^https?://([^/]*)', 1)), '^www\\.', '')"
    path = f"rtrim(regexp_extract({base}, '^https?://[^/]*(.*)$', 1), '/')"
    return (
        f"(regexp_extract({base}, '^(https?)', 1) || '://' || {host} || "
        f"CASE WHEN {path} = '' THEN '/' ELSE {path} END)"
    )


def words(x: str) -> str:
    t = trim(x)
    return (
        f"CASE WHEN length({t}) = 0 THEN 0 "
        f"ELSE len(regexp_split_to_array({t}, '[{WS}]+')) END"
    )


def domain(u: str) -> str:
    return f"regexp_extract({u}, '^https?://[^/]*\\.([a-z]+)/', 1)"


def lang(u: str) -> str:
    return f"regexp_extract({u}, '^https?://[^/]+/([a-z]+)/', 1)"


def site(u: str) -> str:
    return f"regexp_extract({u}, '^(https?://[^/]+)', 1)"


def encoded(path: str) -> str:
    """Percent-encode what a URL path may not hold (letters beyond ASCII in the data)."""
    return (
        f"array_to_string(list_transform(string_split({path}, ''), "
        "lambda c: CASE WHEN regexp_matches(c, '[^\\x21-\\x7e]|[\"<>`{}]') "
        "THEN replace(url_encode(c), '+', '%20') ELSE c END), '')"
    )


HREFS = """regexp_extract_all(html, '<a href="([^"]*)"', 1)"""
ISO = "'%Y-%m-%dT%H:%M:%S.%gZ'"


def iso(ts: str) -> str:
    return f"strftime({ts}, {ISO})"


# --- URLs and listing pages ---------------------------------------------------------

# every page URL (pos 0) and link with its absolute form and raw path
_LINKS = f"""
raw AS (
  SELECT page_id, url, 0 AS pos, url AS link FROM pages
  UNION ALL
  SELECT page_id, url, pos,
         {site('url')} || href AS link
  FROM (SELECT page_id, url, unnest({HREFS}) AS href,
               generate_subscripts({HREFS}, 1) AS pos FROM pages)
),
pathed AS (
  SELECT *, regexp_replace({site('url')}, '^(https?://)www[.]', '\\1') AS home,
         regexp_extract(split_part(split_part(link, '#', 1), '?', 1),
                        '^https?://[^/]*(.*)$', 1) AS path
  FROM raw
),
links AS (
  SELECT *, home || CASE WHEN rtrim(path, '/') = '' THEN '/'
                         ELSE {encoded("rtrim(path, '/')")} END AS canon
  FROM pathed
)"""

_SLUG = (
    "(regexp_matches(path, '^/[A-Za-z0-9-]+$') AND path NOT IN ('/', '/and') "
    "AND NOT starts_with(path, '/tion'))"
)
_KEPT = "NOT (starts_with(path, '/the') OR starts_with(path, '/De'))"

# article links per page, first seen first
_PAGE_LINKS = f"""{_LINKS},
firsts AS (
  SELECT page_id, canon AS url, min(pos) AS pos
  FROM links WHERE pos > 0 AND {_SLUG} AND {_KEPT} GROUP BY 1, 2
),
page_links AS (
  SELECT page_id, row_number() OVER (PARTITION BY page_id ORDER BY pos) - 1 AS link_pos, url
  FROM firsts
)"""

_LINK_HASHES = f"""{_PAGE_LINKS},
hashes AS (
  SELECT p.page_id, p.url AS section_url, count(l.url) AS n_links,
         md5(coalesce(string_agg(l.url, chr(10) ORDER BY l.url), '')) AS link_hash
  FROM pages p LEFT JOIN page_links l USING (page_id) GROUP BY ALL
)"""

# all links of a page, whatever the rule, as stored for pages seen before
_OLD_HASHES = f"""
olds AS (
  SELECT url AS section_url, md5(coalesce(string_agg(c, chr(10) ORDER BY c), '')) AS content_hash
  FROM (SELECT DISTINCT url, canon AS c FROM links WHERE pos > 0)
  RIGHT JOIN (SELECT url FROM pages WHERE regexp_matches(url, '[?#]')) USING (url)
  GROUP BY url
)"""

canonical_urls = f"""
SELECT page_id, url, {canonical('url')} AS canonical,
       lower(regexp_extract(url, '^https?://([^/]*)', 1)) AS host,
       regexp_extract(split_part(split_part(url, '#', 1), '?', 1), '^https?://[^/]*(.*)$', 1) AS path
FROM pages"""

article_url_filter = f"""
WITH {_LINKS}
SELECT page_id, pos, link, {_SLUG} AS is_slug,
       (regexp_matches(lower(path), '^/(de|en|es|fr)/')
        AND len(list_filter(string_split(path, '/'), lambda s: s <> '')) >= 2) AS is_prefix,
       {_KEPT} AS not_excluded
FROM links"""

page_links = f"WITH {_PAGE_LINKS} SELECT page_id, link_pos, url FROM page_links"

link_set_hash = f"WITH {_LINK_HASHES} SELECT page_id, n_links, link_hash FROM hashes"

section_changes = f"""
WITH {_LINK_HASHES}, {_OLD_HASHES}
SELECT h.section_url, h.link_hash, coalesce(o.content_hash = h.link_hash, false) AS is_unchanged
FROM hashes h LEFT JOIN olds o USING (section_url)"""

section_snapshots = f"""
WITH {_LINK_HASHES}
SELECT section_url, link_hash AS content_hash, '1970-01-02T00:00:00.000Z' AS checked_at
FROM hashes"""

section_links = f"""
WITH {_PAGE_LINKS},
seeds AS (
  SELECT {domain('url')} AS source_id, page_id * 2 AS section_ord, {canonical('url')} AS section_key
  FROM pages
  UNION ALL
  SELECT {domain('url')}, page_id * 2 + 1, canon FROM links WHERE pos = 1
),
latest AS (
  SELECT {canonical('url')} AS section_key, max(page_id) AS page_id FROM pages GROUP BY 1
)
SELECT f.source_id, f.section_ord, f.section_key,
       CASE WHEN t.page_id IS NULL THEN 'page not fetched' END AS fetch_error,
       l.link_pos, l.url
FROM seeds f LEFT JOIN latest t USING (section_key) LEFT JOIN page_links l ON l.page_id = t.page_id
WHERE f.source_id <> 'org'"""

# --- article pages ------------------------------------------------------------------

def decoded(x: str, ampersand: str) -> str:
    """The two entities of the data, of which a cut may have taken the semicolon."""
    x = f"regexp_replace({x}, '&quot;?', '\"', 'g')"
    return f"regexp_replace({x}, '&amp;?', '{ampersand}', 'g')"


# titles and bodies as a tokenizer gives them: entities decoded, markup serialised again
_ARTICLES = f"""
parsed AS (
  SELECT page_id, url,
    {trim(decoded("regexp_extract(html, '(?s)<h1>(.*?)</h1>', 1)", '&'))} AS title,
    {text_of(decoded("regexp_extract(html, '(?s)<article>(.*?)</article>', 1)", '&amp;'))} AS body
  FROM pages
)"""

page_articles = f"""
WITH {_ARTICLES}
SELECT page_id, title, length(body) AS body_chars, md5(body) AS body_hash,
       {cut('body', 2000)} AS body_excerpt
FROM parsed"""

page_text_native = f"""
SELECT page_id, {text_of("regexp_extract(html, '(?s)<h1>(.*?)</h1>', 1)")} AS title,
       {text_of("regexp_extract(html, '(?s)<article>(.*?)</article>', 1)")} AS body,
       {text_of('html')} AS "text"
FROM pages"""

_SHOWN = """regexp_extract(html, '(?s)<div class="ad">(.*?)</div>', 1)"""
_ESCAPED = f"replace(replace(replace({_SHOWN}, '&', '&amp;'), '<', '&lt;'), '>', '&gt;')"

thin_pages = f"""
WITH {_ARTICLES},
paired AS (
  SELECT a.page_id, p.html, length(p.html) < 2000 AS is_thin,
         length(p.html) < 2000 AND contains({_SHOWN}, '.') AS from_snapshot, a.title, a.body
  FROM parsed a JOIN pages p USING (page_id)
)
SELECT page_id, is_thin,
       CASE WHEN from_snapshot
            THEN {trim("regexp_extract(html, '(?s)<title>(.*?)</title>', 1)")} ELSE title END AS title,
       md5(CASE WHEN from_snapshot THEN {text_of(_ESCAPED)} ELSE body END) AS body_hash
FROM paired"""

article_join = f"""
WITH {_PAGE_LINKS}, {_ARTICLES},
latest AS (
  SELECT {canonical('url')} AS url, max(page_id) AS page_id FROM pages GROUP BY 1
),
wanted AS (
  SELECT page_id, {canonical('url')} AS url FROM pages
  UNION ALL
  SELECT page_id, url FROM page_links
)
SELECT w.page_id, w.url, a.title, md5(a.body) AS body_hash,
       CASE WHEN t.page_id IS NULL THEN 'page not fetched' END AS fetch_error
FROM wanted w LEFT JOIN latest t USING (url) LEFT JOIN parsed a ON a.page_id = t.page_id"""

# --- documents ----------------------------------------------------------------------

_DOCS = f"""
cut_docs AS (
  SELECT doc_id, lang AS source_id, "text",
         'https://docs.example.com/' || lang || '/' || md5("text") AS url,
         CASE WHEN contains("text", chr(10)) THEN substr("text", 1, strpos("text", chr(10)) - 1)
              ELSE "text" END AS title,
         CASE WHEN contains("text", chr(10)) THEN substr("text", strpos("text", chr(10)) + 1)
              ELSE '' END AS body
  FROM documents
),
hashed AS (SELECT *, {content('title', 'body')} AS content_hash FROM cut_docs),
docs AS (SELECT *, {key('url', 'content_hash')} AS entry_key FROM hashed)"""

content_keys = f"WITH {_DOCS} SELECT doc_id, content_hash, entry_key FROM docs"

duplicate_in_run = f"""
WITH {_DOCS}
SELECT doc_id, entry_key,
       row_number() OVER (PARTITION BY source_id, entry_key ORDER BY doc_id) > 1 AS is_duplicate
FROM docs"""

first_seen_content = f"""
WITH {_DOCS}
SELECT content_hash, doc_id, source_id, title FROM docs
QUALIFY row_number() OVER (PARTITION BY content_hash ORDER BY doc_id) = 1"""

_FEED = f"SELECT DISTINCT {canonical('url')} FROM pages WHERE contains(url, 'utm_source=feed')"

fresh_urls = f"SELECT page_id, url FROM pages WHERE {canonical('url')} NOT IN ({_FEED})"

freshness = f"""
SELECT {domain('url')} AS source_id, count(*) AS collected,
       count(*) FILTER (WHERE {canonical('url')} NOT IN ({_FEED})) AS fresh,
       count(*) FILTER (WHERE {canonical('url')} IN ({_FEED})) AS already_known
FROM pages GROUP BY 1"""

_INDEX = f"""{_DOCS},
own AS (
  SELECT d.doc_id, d.source_id, 'https://docs.example.com/' || d.doc_id AS url, d.content_hash,
         {content('d.title', "'old'")} AS old_hash, l.quality, l.toxic
  FROM docs d LEFT JOIN labels l USING (doc_id)
)"""

change_states = f"""
WITH {_INDEX}
SELECT doc_id,
       CASE WHEN quality IS NULL THEN 'new'
            WHEN toxic = 1 AND content_hash <> old_hash THEN 'updated'
            WHEN quality <> 1 OR source_id = 'fr' THEN 'retry'
            ELSE 'unchanged' END AS change_status
FROM own"""

url_index_merge = f"""
WITH {_INDEX}
SELECT url, content_hash, '1970-01-02T00:00:00.000Z' AS last_seen_at,
       '{CONFIG.run_id}' AS last_run_id, source_id <> 'es' AS extraction_complete
FROM own"""

# --- outcomes -----------------------------------------------------------------------


def outcome_chain(rows: str, min_body: int = 1, wall: str = "false") -> str:
    """CTE ``decided``: the outcome of each row of ``rows``, which has doc_id, source_id,
    url, title, body, quality, toxic."""
    return f"""
checked AS (
  SELECT *, {content('title', 'body')} AS hash_now,
         CASE WHEN {wall} THEN 'login_required'
              WHEN title = '' THEN 'missing_title'
              WHEN length({trim('title')}) = 0 OR length({trim('body')}) < {min_body}
              THEN 'empty_body' END AS early
  FROM {rows}
),
named AS (
  SELECT *, CASE WHEN early IS NULL THEN {key('url', 'hash_now')} END AS key_now FROM checked
),
marked AS (
  SELECT *, key_now IS NOT NULL AND
         row_number() OVER (PARTITION BY source_id, key_now ORDER BY doc_id) > 1 AS is_duplicate
  FROM named
),
decided AS (
  SELECT *,
    CASE WHEN early = 'login_required' THEN 'error'
         WHEN early IS NOT NULL THEN 'skipped'
         WHEN is_duplicate THEN 'skipped'
         WHEN quality IS NULL THEN 'error'
         WHEN quality <> 1 THEN 'not_relevant'
         WHEN toxic = 1 OR length({trim('title')}) = 0
              OR length({trim("split_part(title, ' ', 1)")}) = 0 THEN 'error'
         ELSE 'new' END AS action,
    CASE WHEN early IS NOT NULL THEN early
         WHEN is_duplicate THEN 'duplicate_in_run'
         WHEN quality IS NULL THEN 'extraction_failed'
         WHEN quality <> 1 THEN NULL
         WHEN toxic = 1 OR length({trim('title')}) = 0
              OR length({trim("split_part(title, ' ', 1)")}) = 0 THEN 'incomplete_extraction'
         END AS reason
  FROM marked
)"""


_LABELLED = f"""{_DOCS},
labelled AS (SELECT d.*, l.quality, l.toxic FROM docs d LEFT JOIN labels l USING (doc_id))"""

_OUTCOMES = f"{_LABELLED}, {outcome_chain('labelled')}"

outcomes = f"WITH {_OUTCOMES} SELECT doc_id, key_now AS entry_key, action, reason FROM decided"

outcomes_without_extractor = f"""
WITH {_OUTCOMES}
SELECT doc_id, 'skipped' AS action,
       coalesce(early, CASE WHEN is_duplicate THEN 'duplicate_in_run' ELSE 'ai_disabled' END) AS reason
FROM decided"""

scan_caps = f"""
WITH {_LABELLED},
capped AS (
  SELECT * FROM labelled QUALIFY row_number() OVER (PARTITION BY source_id ORDER BY doc_id) <= 65
),
{outcome_chain('capped')},
counted AS (
  SELECT *, coalesce(sum(CASE WHEN action = 'new' THEN 1 ELSE 0 END) OVER (
    PARTITION BY source_id ORDER BY doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
  FROM decided
)
SELECT doc_id, source_id, action, reason FROM counted WHERE before < 20"""

event_caps = """
WITH capped AS (
  SELECT * FROM events
  QUALIFY row_number() OVER (PARTITION BY event_type ORDER BY event_id) <= 1500
),
counted AS (
  SELECT *, coalesce(sum(CASE WHEN value > 10 THEN 1 ELSE 0 END) OVER (
    PARTITION BY event_type ORDER BY event_id
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
  FROM capped
)
SELECT event_type AS source_id, event_id, value FROM counted WHERE before < 900"""

# --- snapshots ----------------------------------------------------------------------


def shown(text: str) -> tuple[str, str]:
    """Title and body of a text shown as snapshot lines: its lines that are not blank."""
    kept = f"list_filter(string_split({text}, chr(10)), lambda x: length({trim('x')}) > 0)"
    title = f"coalesce(({kept})[1], '')"
    body = f"array_to_string(({kept})[2:], chr(10))"
    return title, body


_T, _B = shown('"text"')

snapshot_articles = f"""
WITH read AS (
  SELECT doc_id, "text", {_T} AS title, {_B} AS body FROM documents
)
SELECT doc_id, len(string_split("text", chr(10))) + 1 AS n_lines,
       len(list_filter(string_split("text", chr(10)), lambda x: length({trim('x')}) > 0)) AS n_texts,
       title, md5(body) AS body_hash, substr(body, 1, 300) AS body_cut,
       length({trim('title')}) > 0 AND length({trim('body')}) >= 80 AS complete
FROM read"""

snapshot_page_links = f"""
WITH {_PAGE_LINKS},
cut_links AS (
  SELECT page_id, pos, split_part(split_part({site('url')} ||
         CASE WHEN pos = 0 THEN regexp_extract(url, '^https?://[^/]*(.*)$', 1) ELSE path END,
         ',', 1), ']', 1) AS link
  FROM links
),
seen_links AS (
  SELECT page_id, {canonical('link')} AS url, min(pos) AS pos
  FROM cut_links
  WHERE regexp_matches(split_part(split_part(link, '#', 1), '?', 1), '^https?://[^/]*/[A-Za-z0-9-]+/?$')
    AND regexp_extract({canonical('link')}, '^https?://[^/]*(.*)$', 1) NOT IN ('/', '/and')
  GROUP BY 1, 2
),
seen AS (
  SELECT page_id, list(url ORDER BY pos) AS urls FROM seen_links GROUP BY 1
),
found AS (
  SELECT page_id, list(url ORDER BY link_pos) AS urls FROM page_links GROUP BY 1
),
paired AS (
  SELECT p.page_id, coalesce(f.urls, []) AS links, coalesce(s.urls, []) AS seen
  FROM pages p LEFT JOIN found f USING (page_id) LEFT JOIN seen s USING (page_id)
),
added AS (
  SELECT *, list_filter(seen, lambda u: NOT list_contains(links, u)) AS extra FROM paired
)
SELECT page_id, len(seen) AS n_seen, array_to_string(links || extra, ' ') AS merged,
       array_to_string(extra, ' ') AS added
FROM added"""

# what each of the three tries shows; toxic documents meet a wall at the second one
_TRIES = f"""
tries AS (
  SELECT d.doc_id, d.lang AS source_id, 'https://docs.example.com/' || d.lang || '/' || md5(d.text) AS url,
         l.quality, l.toxic, t.attempt,
         CASE t.attempt
           WHEN 1 THEN string_split(d.text, chr(10))[1]
           WHEN 2 THEN array_to_string(list_slice(string_split(d.text, chr(10)), 1, 2), chr(10)) ||
                       CASE WHEN l.toxic = 1 THEN chr(10) || 'Please Sign in to CONTINUE' ELSE '' END
           ELSE d.text END AS shown
  FROM documents d LEFT JOIN labels l USING (doc_id), (VALUES (1), (2), (3)) t(attempt)
),
told AS (
  SELECT *, contains(lower(shown), 'sign in to continue')
            OR (contains(lower(shown), 'sign in') AND contains(lower(shown), 'join us')) AS paywalled,
         {shown('shown')[0]} AS title, {shown('shown')[1]} AS body
  FROM tries
),
judged AS (
  SELECT *, length({trim('title')}) > 0 AND length({trim('body')}) >= 80 AS complete FROM told
),
chosen AS (
  SELECT * FROM judged
  QUALIFY row_number() OVER (PARTITION BY doc_id
    ORDER BY CASE WHEN paywalled OR complete THEN attempt ELSE 10 - attempt END) = 1
)"""

attempt_select = f"""
WITH {_TRIES}
SELECT doc_id, attempt, paywalled, complete, title, md5(body) AS body_hash FROM chosen"""

# --- extraction ---------------------------------------------------------------------

extraction_parse = f"""
WITH {_LABELLED}
SELECT doc_id,
       md5(to_json({{'sourceUrl': url, 'title': title, 'bodyExcerpt': body}})::VARCHAR) AS payload_hash,
       coalesce(quality = 1, false) AS is_relevant,
       CASE WHEN quality IS NOT NULL THEN nullif({trim("split_part(title, ' ', 1)")}, '') END AS startup_name,
       NULL::VARCHAR AS startup_website,
       CASE WHEN quality IS NOT NULL THEN source_id END AS description,
       CASE WHEN toxic = 0 THEN nullif({trim('title')}, '') END AS news_summary,
       quality IS NULL AS extraction_failed,
       coalesce(quality, 0) <> 1 OR (toxic = 0 AND length({trim('title')}) > 0
         AND length({trim("split_part(title, ' ', 1)")}) > 0) AS complete
FROM labelled"""

_WORDS = "the|nicht|elle|worthless|license"


def ruled(title: str, body: str) -> dict[str, str]:
    """The keyword extractor's answer on a title and an excerpt."""
    test = f"'(?i)(?:^|[^a-z])({_WORDS})(?:[^a-z]|$)'"
    relevant = f"(regexp_matches({title}, {test}) OR regexp_matches({body}, {test}))"
    before = trim(
        f"regexp_extract({title}, '(?is)^(|.*?[^a-z])(?:{_WORDS})(?:[^a-z]|$)', 1)"
    )
    name = f"coalesce(nullif({before}, ''), nullif({trim(f'''split_part({title}, ' ', 1)''')}, ''))"
    return {
        "is_relevant": relevant,
        "startup_name": f"CASE WHEN {relevant} THEN {name} END",
        "startup_website": f"CASE WHEN {relevant} THEN "
        f"nullif(regexp_extract({body}, 'https?://[a-z0-9.-]+'), '') END",
        "news_summary": f"CASE WHEN {relevant} THEN "
        f"nullif({trim(f'''regexp_extract({body}, '(?s)^(.*?[.])(?:\\s|$)', 1)''')}, '') END",
    }


_RULES = ruled("title", "excerpt")

rule_extraction = f"""
WITH {_DOCS}, short AS (SELECT doc_id, title, body AS excerpt FROM docs)
SELECT doc_id, {_RULES['is_relevant']} AS is_relevant, {_RULES['startup_name']} AS startup_name,
       {_RULES['startup_website']} AS startup_website, NULL::VARCHAR AS description,
       {_RULES['news_summary']} AS news_summary, false AS extraction_failed
FROM short"""

# --- runs and stores ----------------------------------------------------------------

_ACTIVITY = """
activity AS (
  SELECT strftime(ts, '%Y-%m-%d') AS run_id, 'u' || user_id AS source_id,
         event_type = 'signup' AS is_section,
         CASE event_type
           WHEN 'signup' THEN CASE WHEN value < 10 THEN 'section_unchanged' END
           WHEN 'error' THEN 'error' WHEN 'purchase' THEN 'new' WHEN 'click' THEN 'skipped'
           ELSE CASE WHEN value < 10 THEN 'updated' ELSE 'not_relevant' END END AS action
  FROM events
),
durations AS (SELECT 'u' || user_id AS source_id, count(*) * 7 AS duration_ms FROM events GROUP BY 1),
stats AS (
  SELECT run_id, source_id,
         count(*) FILTER (WHERE is_section) AS sections_checked,
         count(*) FILTER (WHERE action = 'section_unchanged') AS sections_skipped,
         count(*) FILTER (WHERE NOT is_section) AS articles_scanned,
         count(*) FILTER (WHERE action = 'new') AS "new",
         count(*) FILTER (WHERE action = 'updated') AS updated,
         count(*) FILTER (WHERE action = 'skipped') AS skipped,
         count(*) FILTER (WHERE action = 'not_relevant') AS not_relevant,
         count(*) FILTER (WHERE action = 'error') AS errors,
         any_value(duration_ms) AS duration_ms
  FROM activity JOIN durations USING (source_id) GROUP BY 1, 2
)"""

source_counters = f"WITH {_ACTIVITY} SELECT * FROM stats"

run_counters = f"""
WITH {_ACTIVITY}
SELECT run_id, sum(sections_checked)::BIGINT AS sections_checked,
       sum(sections_skipped)::BIGINT AS sections_skipped,
       sum(articles_scanned)::BIGINT AS articles_scanned, sum("new")::BIGINT AS "new",
       sum(updated)::BIGINT AS updated, sum(skipped)::BIGINT AS skipped,
       sum(not_relevant)::BIGINT AS not_relevant, sum(errors)::BIGINT AS errors,
       sum(duration_ms)::BIGINT AS duration_ms
FROM stats GROUP BY 1"""

run_summaries = f"""
WITH {_OUTCOMES},
per AS (
  SELECT source_id AS id, count(*) AS scanned,
         count(*) FILTER (WHERE action = 'new') AS "new",
         count(*) FILTER (WHERE action = 'skipped') AS skipped,
         count(*) FILTER (WHERE action = 'not_relevant') AS not_relevant,
         count(*) FILTER (WHERE action = 'error') AS errors
  FROM decided GROUP BY 1
)
SELECT 'orchestrator' AS logged_by, true AS paths_null, '{CONFIG.run_id}' AS run_id,
       '{COMPLETED_AT}' AS completed_at, true AS tables_on,
       (sum(scanned) OVER ())::BIGINT AS total_scanned, (sum("new") OVER ())::BIGINT AS total_new,
       (sum(errors) OVER ())::BIGINT AS total_errors,
       row_number() OVER (ORDER BY id) - 1 AS place, per.*
FROM per"""

event_union = f"""
WITH {_OUTCOMES}
SELECT source_id, action AS event, reason, count(*) AS n,
       count(*) FILTER (WHERE action = 'new') AS keyed
FROM decided GROUP BY ALL
UNION ALL SELECT 'orchestrator', 'run_complete', NULL, 1, 0"""

log_append = """
SELECT strftime(ts, '%Y-%m-%dT%H-%M-%S-%gZ') AS run_id, 'u' || user_id AS source_id,
       CASE event_type WHEN 'purchase' THEN 'new' WHEN 'click' THEN 'skipped'
                       WHEN 'view' THEN 'not_relevant' ELSE event_type END AS event,
       'https://e.example.com/' || event_id AS url,
       CASE WHEN value < 10 THEN 'small' END AS reason, NULL::VARCHAR AS entry_key, props AS meta,
       CASE WHEN ts < TIMESTAMP '2024-01-16' THEN '2024-01-16T01:00:00.000Z'
            ELSE '2024-01-31T01:00:00.000Z' END AS logged_at
FROM events WHERE event_type <> 'signup'"""

news_upsert = f"""
WITH {_DOCS},
firsts AS (
  SELECT entry_key, source_id FROM docs WHERE doc_id IN (SELECT doc_id FROM labels)
  QUALIFY row_number() OVER (PARTITION BY entry_key ORDER BY doc_id DESC) = 1
),
lasts AS (
  SELECT * FROM docs QUALIFY row_number() OVER (PARTITION BY entry_key ORDER BY doc_id DESC) = 1
)
SELECT l.entry_key, l.url AS source_url, coalesce(f.source_id, 'again') AS source_id,
       nullif({trim('l.title')}, '') AS startup_name, NULL::VARCHAR AS startup_website,
       'doc ' || l.doc_id AS description, length(l.body)::VARCHAR AS news_summary,
       'updated' AS entry_status, '1970-01-03T00:00:00.000Z' AS discovered_at, l.content_hash
FROM lasts l LEFT JOIN firsts f USING (entry_key)"""

bucketed_upsert = f"""
WITH {_DOCS},
firsts AS (
  SELECT * FROM docs QUALIFY row_number() OVER (PARTITION BY entry_key ORDER BY doc_id DESC) = 1
),
seconds AS (
  SELECT * FROM docs WHERE doc_id IN (SELECT doc_id FROM labels WHERE toxic = 1)
  QUALIFY row_number() OVER (PARTITION BY entry_key ORDER BY doc_id DESC) = 1
)
SELECT f.entry_key, f.source_id, 'doc ' || coalesce(s.doc_id, f.doc_id) AS description,
       CASE WHEN s.doc_id IS NULL THEN 'new' ELSE 'updated' END AS entry_status,
       CASE WHEN s.doc_id IS NULL THEN '1970-01-02T00:00:00.000Z'
            ELSE '1970-01-03T00:00:00.000Z' END AS discovered_at,
       true AS files_as_expected
FROM firsts f LEFT JOIN seconds s USING (entry_key)"""

_ACCEPTED = "SELECT * FROM decided WHERE action = 'new'"

news_store = f"""
WITH {_OUTCOMES},
accepted AS ({_ACCEPTED}),
per_url AS (SELECT url, count(*) AS n_events FROM decided GROUP BY 1),
indexed AS (
  SELECT url, hash_now AS content_hash, action IN ('new', 'not_relevant') AS extraction_complete
  FROM decided WHERE key_now IS NOT NULL AND NOT is_duplicate
  UNION ALL SELECT DISTINCT url, NULL, false FROM decided WHERE key_now IS NULL
)
SELECT url, a.key_now AS entry_key, a.source_id,
       nullif({trim("split_part(a.title, ' ', 1)")}, '') AS startup_name,
       CASE WHEN a.key_now IS NOT NULL THEN 'new' END AS entry_status,
       i.content_hash, i.extraction_complete, p.n_events
FROM indexed i LEFT JOIN accepted a USING (url) LEFT JOIN per_url p USING (url)"""

flat_export = f"""
WITH {_OUTCOMES}
SELECT key_now AS entry_key, url AS source_url, source_id,
       nullif({trim("split_part(title, ' ', 1)")}, '') AS startup_name,
       NULL::VARCHAR AS startup_website, source_id AS description,
       nullif({trim('title')}, '') AS news_summary, 'new' AS entry_status,
       '{COMPLETED_AT.replace('Z', '.000Z')}' AS discovered_at
FROM decided WHERE action = 'new'"""

size_profiles = f"""
WITH {_DOCS}
SELECT source_id, count(*) AS "rows",
       sum(length("text"))::BIGINT AS text_chars, sum({words('"text"')})::BIGINT AS text_words,
       sum(length(title))::BIGINT AS title_chars, sum({words('title')})::BIGINT AS title_words,
       sum(length(body))::BIGINT AS body_excerpt_chars, sum({words('body')})::BIGINT AS body_excerpt_words
FROM docs GROUP BY 1"""

document_sizes = f"""
WITH {_DOCS}
SELECT doc_id, length("text") AS text_chars, {words('"text"')} AS text_words,
       length(title) AS title_chars, {words('title')} AS title_words
FROM docs"""

# --- whole jobs ---------------------------------------------------------------------

_LANG_PATH = "regexp_matches(lower(path), '^/(de|en|es|fr)/[^/]')"


def _discover(max_items: int | None, max_new: int | None) -> str:
    item_cap = f"WHERE place <= {max_items}" if max_items else ""
    new_cap = f"WHERE before < {max_new}" if max_new else ""
    return f"""
WITH {_ARTICLES},
listed AS (
  SELECT page_id, url, {domain('url')} AS source_id, {site('url')} || '/list/' || page_id AS section_url,
         regexp_replace({canonical('url')}, '^(https?://[^/]*)/.*$', '\\1') AS home
  FROM pages
),
found AS (
  SELECT page_id, source_id, section_url, url AS raw, 0 AS link_pos, {canonical('url')} AS url FROM listed
  UNION ALL
  SELECT page_id, source_id, section_url, url, 1, home || '/' || {lang('url')} || '/x' || page_id FROM listed
),
latest AS (SELECT {canonical('url')} AS url, max(page_id) AS page_id FROM pages GROUP BY 1),
current AS (
  SELECT t.url, a.title, a.body FROM latest t JOIN parsed a USING (page_id)
),
hashed AS (SELECT *, {content('title', 'body')} AS now FROM current),
idx AS (
  SELECT h.url, max(CASE WHEN regexp_matches(p.url, '/$|#') THEN h.now ELSE md5('') END) AS last_hash,
         max({lang('p.url')}) NOT IN ('fr', 'de') AS complete
  FROM hashed h JOIN pages p ON {canonical('p.url')} = h.url
  WHERE regexp_matches(p.url, '/$|\\.html$|#') GROUP BY 1
),
sections AS (
  SELECT source_id, section_url, contains(url, '#') AS unchanged FROM listed
),
links AS (
  SELECT f.* FROM found f JOIN sections s USING (section_url)
  WHERE NOT s.unchanged OR f.url IN (SELECT url FROM idx WHERE NOT complete)
),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY source_id ORDER BY page_id, link_pos) AS place FROM links
),
capped AS (SELECT * FROM placed {item_cap}),
joined AS (
  SELECT c.*, h.title, h.body, h.now,
         CASE WHEN h.url IS NULL THEN 'article_fetch: page not fetched'
              WHEN h.title = '' THEN 'missing_title'
              WHEN length({trim('h.body')}) < 1 THEN 'empty_body' END AS early,
         CASE WHEN i.url IS NULL THEN 'new'
              WHEN i.last_hash <> h.now OR h.now IS NULL THEN 'updated'
              WHEN NOT i.complete THEN 'retry' ELSE 'unchanged' END AS state
  FROM capped c LEFT JOIN hashed h USING (url) LEFT JOIN idx i USING (url)
),
keyed AS (
  SELECT *, CASE WHEN early IS NULL THEN {key('url', 'now')} END AS key_now FROM joined
),
marked AS (
  SELECT *, key_now IS NOT NULL AND row_number() OVER (
    PARTITION BY source_id, key_now ORDER BY page_id, link_pos) > 1 AS is_duplicate
  FROM keyed
),
told AS (
  SELECT *, {ruled('title', 'body')['is_relevant']} AS is_relevant,
         {ruled('title', 'body')['startup_name']} AS startup_name,
         {ruled('title', 'body')['news_summary']} AS summary
  FROM marked
),
decided AS (
  SELECT *,
    CASE WHEN early IN ('missing_title', 'empty_body') THEN 'skipped'
         WHEN early IS NOT NULL THEN 'error'
         WHEN is_duplicate OR state = 'unchanged' THEN 'skipped'
         WHEN NOT is_relevant THEN 'not_relevant'
         WHEN startup_name IS NULL OR summary IS NULL THEN 'error'
         WHEN state = 'updated' THEN 'updated' ELSE 'new' END AS action,
    CASE WHEN early IS NOT NULL THEN early
         WHEN is_duplicate THEN 'duplicate_in_run'
         WHEN state = 'unchanged' THEN 'unchanged_content'
         WHEN NOT is_relevant THEN NULL
         WHEN startup_name IS NULL OR summary IS NULL THEN 'incomplete_extraction' END AS reason
  FROM told
),
counted AS (
  SELECT *, coalesce(sum(CASE WHEN action = 'new' THEN 1 ELSE 0 END) OVER (
    PARTITION BY source_id ORDER BY page_id, link_pos
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
  FROM decided
)
SELECT '{CONFIG.run_id}' AS run_id, source_id, 'section' AS kind, section_url AS url,
       CASE WHEN unchanged THEN 'section_unchanged' END AS action,
       CASE WHEN unchanged THEN 'unchanged' END AS reason,
       NULL::VARCHAR AS entry_key, NULL::VARCHAR AS startup_name
FROM sections
UNION ALL
SELECT '{CONFIG.run_id}', source_id, 'article', url, action, reason,
       CASE WHEN action IN ('new', 'updated') THEN key_now END,
       CASE WHEN action IN ('new', 'updated') THEN startup_name END
FROM counted {new_cap}"""


discover = _discover(90, 15)
discover_all = _discover(None, None)


def _snapshots(max_items: int | None, max_new: int | None) -> str:
    item_cap = f"WHERE place <= {max_items}" if max_items else ""
    new_cap = f"WHERE before < {max_new}" if max_new else ""
    return f"""
WITH {_TRIES},
firsts AS (
  SELECT min(doc_id) AS doc_id, source_id, url FROM tries GROUP BY 2, 3
),
known AS (
  SELECT f.url FROM firsts f JOIN labels l USING (doc_id) WHERE l.quality <> 1
),
fresh AS (SELECT * FROM firsts WHERE url NOT IN (SELECT url FROM known)),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY source_id ORDER BY doc_id) AS place FROM fresh
),
capped AS (SELECT * FROM placed {item_cap}),
-- copies of a text are tries of one URL; a wall seen by any of them counts
tries_by_url AS (
  SELECT url, attempt, bool_or(paywalled) AS paywalled, any_value(title) AS title,
         min(body) AS body, bool_or(complete) AS complete
  FROM judged GROUP BY 1, 2
),
by_url AS (
  SELECT * FROM tries_by_url
  QUALIFY row_number() OVER (PARTITION BY url
    ORDER BY CASE WHEN paywalled OR complete THEN attempt ELSE 10 - attempt END) = 1
),
rows_in AS (
  SELECT c.doc_id, c.source_id, c.url, ch.title, ch.body, ch.paywalled, l.quality, l.toxic
  FROM capped c JOIN by_url ch USING (url) LEFT JOIN labels l ON l.doc_id = c.doc_id
),
{outcome_chain('rows_in', 80, 'paywalled')},
counted AS (
  SELECT *, coalesce(sum(CASE WHEN action = 'new' THEN 1 ELSE 0 END) OVER (
    PARTITION BY source_id ORDER BY doc_id
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
  FROM decided
)
SELECT source_id, action AS event, url, reason,
       CASE WHEN action = 'new' THEN key_now END AS entry_key
FROM counted {new_cap}"""


discover_snapshots = _snapshots(65, 20)
discover_snapshots_all = _snapshots(None, None)

_STREAM_RUN = "'" + CONFIG.run_id + "-00000000"

discover_stream = f"""
WITH {_ARTICLES},
arrivals AS (
  SELECT 0 AS batch, page_id, url AS raw FROM pages WHERE regexp_matches(url, '[?#]')
  UNION ALL SELECT 1, page_id, url FROM pages
),
rows_in AS (
  SELECT r.batch, r.page_id, {canonical('r.raw')} AS url, a.title, a.body
  FROM arrivals r JOIN parsed a USING (page_id)
),
named AS (
  SELECT *, {content('title', 'body')} AS now,
         CASE WHEN title = '' THEN 'missing_title'
              WHEN length({trim('body')}) < 1 THEN 'empty_body' END AS early,
         {ruled('title', 'body')['is_relevant']} AS is_relevant,
         {ruled('title', 'body')['startup_name']} AS startup_name,
         {ruled('title', 'body')['news_summary']} AS summary
  FROM rows_in
),
marked AS (
  SELECT *, CASE WHEN early IS NULL THEN {key('url', 'now')} END AS key_now,
         early IS NULL AND row_number() OVER (
           PARTITION BY batch, url, now, early ORDER BY page_id) > 1 AS is_duplicate
  FROM named
),
last_seen AS (
  SELECT url, now AS last_hash,
         NOT is_relevant OR (startup_name IS NOT NULL AND summary IS NOT NULL) AS complete
  FROM marked WHERE batch = 0 AND early IS NULL AND NOT is_duplicate
  QUALIFY row_number() OVER (PARTITION BY url ORDER BY page_id DESC) = 1
),
stated AS (
  SELECT m.*,
         CASE WHEN m.batch = 0 OR s.url IS NULL THEN 'new'
              WHEN s.last_hash <> m.now THEN 'updated'
              WHEN NOT s.complete THEN 'retry' ELSE 'unchanged' END AS state
  FROM marked m LEFT JOIN last_seen s USING (url)
),
decided AS (
  SELECT *,
    CASE WHEN early IS NOT NULL OR is_duplicate OR state = 'unchanged' THEN 'skipped'
         WHEN NOT is_relevant THEN 'not_relevant'
         WHEN startup_name IS NULL OR summary IS NULL THEN 'error'
         WHEN state = 'updated' THEN 'updated' ELSE 'new' END AS event,
    CASE WHEN early IS NOT NULL THEN early
         WHEN is_duplicate THEN 'duplicate_in_run'
         WHEN state = 'unchanged' THEN 'unchanged_content'
         WHEN NOT is_relevant THEN NULL
         WHEN startup_name IS NULL OR summary IS NULL THEN 'incomplete_extraction' END AS reason
  FROM stated
)
SELECT {_STREAM_RUN}' || batch AS run_id, event, url, reason,
       CASE WHEN event IN ('new', 'updated') THEN key_now END AS entry_key
FROM decided"""

assert set(LANGS) == {"de", "en", "es", "fr"}

ORACLES: dict[str, str] = {
    "canonical_urls": canonical_urls,
    "article_url_filter": article_url_filter,
    "page_links": page_links,
    "page_links_native": page_links,
    "link_set_hash": link_set_hash,
    "section_links": section_links,
    "section_changes": section_changes,
    "section_snapshots": section_snapshots,
    "page_articles": page_articles,
    "page_text_native": page_text_native,
    "thin_pages": thin_pages,
    "article_join": article_join,
    "content_keys": content_keys,
    "duplicate_in_run": duplicate_in_run,
    "first_seen_content": first_seen_content,
    "fresh_urls": fresh_urls,
    "freshness": freshness,
    "change_states": change_states,
    "change_states_stored": change_states,
    "fresh_urls_stored": fresh_urls,
    "bucketed_upsert": bucketed_upsert,
    "url_index_merge": url_index_merge,
    "scan_caps": scan_caps,
    "event_caps": event_caps,
    "snapshot_articles": snapshot_articles,
    "snapshot_page_links": snapshot_page_links,
    "attempt_select": attempt_select,
    "extraction_parse": extraction_parse,
    "rule_extraction": rule_extraction,
    "outcomes": outcomes,
    "outcomes_without_extractor": outcomes_without_extractor,
    "source_counters": source_counters,
    "run_counters": run_counters,
    "run_summaries": run_summaries,
    "event_union": event_union,
    "log_append": log_append,
    "news_upsert": news_upsert,
    "news_store": news_store,
    "flat_export": flat_export,
    "size_profiles": size_profiles,
    "document_sizes": document_sizes,
    "discover": discover,
    "discover_all": discover_all,
    "discover_snapshots": discover_snapshots,
    "discover_snapshots_all": discover_snapshots_all,
    "discover_stream": discover_stream,
}
