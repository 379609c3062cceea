"""SQL counterparts of the registered queries that SQL can express."""

OP4_URL_FILTER = r"""
WITH split AS (
    SELECT page_id, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) END AS rest
    FROM pages
), parts AS (
    SELECT page_id, rest,
        translate(coalesce(regexp_extract(rest, '^[^/?#]*'), ''),
            'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
        coalesce(regexp_extract(rest, '^[^/?#]*(/[^?#]*)?', 1), '') AS path
    FROM split
), rules(rule_host, rule_path, verdict) AS (
    VALUES ('net', '/', 'block'), ('example.net', '/en/', 'allow'),
        ('example.com', '/de/', 'block'), ('org', '/fr/', 'allow')
), fitting AS (
    SELECT page_id, rule_host || rule_path AS rule, r.verdict,
        row_number() OVER (PARTITION BY page_id ORDER BY length(rule_host || rule_path) DESC) AS place
    FROM parts JOIN rules r
        ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path)
)
SELECT p.page_id, p.host, p.path, f.rule, coalesce(f.verdict, 'allow') AS verdict
FROM parts p LEFT JOIN fitting f ON f.page_id = p.page_id AND f.place = 1
"""

ORACLES = {"op4_url_filter": OP4_URL_FILTER}
