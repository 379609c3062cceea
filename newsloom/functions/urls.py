"""URL expressions: parsing, canonical form, resolving, article rules.

All of it is built-in SQL, null on input that is not an http or https URL. A URL is
taken apart once (``parts_sql``) and everything else works on the parts. Paths come out
as a WHATWG URL parser gives them: back slashes turned, dot segments removed, unsafe
characters percent-encoded. Functions ending in ``_sql`` give the text of an expression,
the others a column; arguments are column names or SQL expressions.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from newsloom.functions.sql import all_of, any_of, let, literal
from newsloom.specs import SourceSpec

# scheme, user info, host, port and path of a whole http(s) URL
_HTTP_URL = literal(
    r"(?i)\A(https?):[/\\]*"
    r"((?:[^/\\?#]*@)?)"
    r"(\[[0-9a-f:.]+\]|[^/\\?#:@\[\]\s<>^|%]+)"
    r"(?::([0-9]*))?"
    r"((?:[/\\][^?#]*)?)"
    r"(?:[?#](?s:.*))?\z"
)
_MARK = literal("\x01")
_MARKED = literal("\x01" + "\x01".join(("$1", "$2", "$3", "$4", "$5")))
_OUTER = literal(r"\A[\x00-\x20]+|[\x00-\x20]+\z|[\t\n\r]")
_DOT_SEGMENT = literal(r"(?i)/(?:\.|%2e){1,2}(?:/|\z)")
_SINGLE_DOT = literal(r"(?i)\A(?:\.|%2e)\z")
_DOUBLE_DOT = literal(r"(?i)\A(?:\.|%2e){2}\z")
_UNSAFE = literal(r"""[^\x21-\x7e]|["<>`{}]""")
_SCHEME = literal(r"(?i)\A[a-z][a-z0-9+.\-]*:")


def _clean(c: str) -> str:
    """What a URL parser drops before parsing: outer controls and spaces, inner tabs and breaks."""
    return f"regexp_replace({c}, {_OUTER}, '')"


def _drop_dot_segments(path: str) -> str:
    # element 1 is the empty text before the first slash and always stays
    parent = "slice(done, 1, greatest(size(done) - 1, 1))"
    step = (
        f"CASE WHEN part RLIKE {_DOUBLE_DOT} THEN {parent} "
        f"WHEN part RLIKE {_SINGLE_DOT} THEN done ELSE concat(done, array(part)) END"
    )
    folded = f"aggregate(slice(segs, 2, size(segs)), array(''), (done, part) -> {step})"
    last = "element_at(segs, -1)"
    ends_open = f"{last} RLIKE {_SINGLE_DOT} OR {last} RLIKE {_DOUBLE_DOT}"
    joined = f"concat(array_join({folded}, '/'), CASE WHEN {ends_open} THEN '/' ELSE '' END)"
    return let(f"split({path}, '/')", "segs", joined)


def _encode_unsafe(path: str) -> str:
    encode = (
        f"CASE WHEN ch = ' ' THEN '%20' WHEN ch RLIKE {_UNSAFE} THEN url_encode(ch) ELSE ch END"
    )
    return f"array_join(transform(split({path}, ''), ch -> {encode}), '')"


def _normal_path(path: str) -> str:
    no_dots = let(
        f"translate({path}, '\\\\', '/')",
        "raw",
        f"CASE WHEN raw RLIKE {_DOT_SEGMENT} THEN {_drop_dot_segments('raw')} ELSE raw END",
    )
    return let(
        no_dots, "way", f"CASE WHEN way RLIKE {_UNSAFE} THEN {_encode_unsafe('way')} ELSE way END"
    )


def parts_sql(c: str) -> str:
    """STRUCT<scheme, user, host, port, path> of an http(s) URL, else null. The path
    is normalised and may be empty; user info keeps its ``@``."""
    fields = (
        "named_struct('scheme', lower(bits[1]), 'user', bits[2], 'host', lower(bits[3]), "
        f"'port', bits[4], 'path', {_normal_path('bits[5]')})"
    )
    split = let(f"split(marked, {_MARK}, 6)", "bits", fields)
    return let(
        f"regexp_replace({_clean(c)}, {_HTTP_URL}, {_MARKED})",
        "marked",
        f"CASE WHEN startswith(marked, {_MARK}) THEN {split} END",
    )


def _full_path(parts: str) -> str:
    return f"CASE WHEN {parts}.path = '' THEN '/' ELSE {parts}.path END"


def _bare_host(parts: str) -> str:
    return f"regexp_replace({parts}.host, '^www[.]', '')"


def canonical_of(parts: str) -> str:
    """Canonical form, from the name of a variable or column that holds the parts."""
    path = f"trim(TRAILING '/' FROM {parts}.path)"
    return (
        f"concat({parts}.scheme, '://', {_bare_host(parts)}, "
        f"CASE WHEN {path} = '' THEN '/' ELSE {path} END)"
    )


def canonical_sql(c: str) -> str:
    return let(parts_sql(c), "site", canonical_of("site"))


def canonical_url(c: str) -> Column:
    """Identity form: no query, fragment, port or user info; host lower-case without
    ``www.``; no trailing slashes."""
    return F.expr(canonical_sql(c))


def url_host(c: str) -> Column:
    """Lower-case host name without user info and port."""
    return F.expr(let(parts_sql(c), "site", "site.host"))


def url_path(c: str) -> Column:
    """Normalised path, at least ``/``."""
    return F.expr(let(parts_sql(c), "site", _full_path("site")))


def snapshot_url_sql(c: str) -> str:
    default_port = "CASE WHEN site.scheme = 'http' THEN '80' ELSE '443' END"
    port = (
        f"CASE WHEN site.port IN ('', {default_port}) THEN '' ELSE concat(':', site.port) END"
    )
    href = f"concat(site.scheme, '://', site.user, site.host, {port}, {_full_path('site')})"
    return f"coalesce(regexp_replace({let(parts_sql(c), 'site', href)}, '/$', ''), {_clean(c)})"


def snapshot_url(c: str) -> Column:
    """Link form used inside snapshots: no query or fragment and without one trailing
    slash; text that is no URL is only trimmed."""
    return F.expr(snapshot_url_sql(c))


def base_sql(base: str) -> str:
    """What resolving needs of a page URL: STRUCT<scheme, origin, path, folder>."""
    port = "CASE WHEN site.port = '' THEN '' ELSE concat(':', site.port) END"
    fields = (
        "named_struct('scheme', site.scheme, "
        f"'origin', concat(site.scheme, '://', site.host, {port}), "
        f"'path', {_full_path('site')}, "
        f"'folder', regexp_extract({_full_path('site')}, '^.*/', 0))"
    )
    return let(parts_sql(base), "site", f"CASE WHEN site IS NOT NULL THEN {fields} END")


def resolve_against(href: str, base: str) -> str:
    """Absolute form of a link, given a name that holds ``base_sql`` of its page."""
    absolute = (
        "CASE WHEN link = '' THEN NULL "
        f"WHEN link RLIKE {_SCHEME} THEN link "
        f"WHEN link RLIKE {literal(r'^[/\\]{2}')} THEN concat({base}.scheme, ':', link) "
        f"WHEN link RLIKE {literal(r'^[/\\]')} THEN concat({base}.origin, link) "
        f"WHEN link RLIKE '^[#?]' THEN concat({base}.origin, {base}.path, link) "
        f"ELSE concat({base}.origin, {base}.folder, link) END"
    )
    return let(_clean(href), "link", absolute)


def resolve_sql(href: str, base: str) -> str:
    link = let(base_sql(base), "home", resolve_against(href, "home"))
    return let(link, "found", f"CASE WHEN {parts_sql('found')} IS NOT NULL THEN found END")


def resolve_href(href: str, base: str) -> Column:
    """Absolute http(s) URL of a link on the page ``base``; null when there is none.

    Blank links are dropped, as are links of other schemes."""
    return F.expr(resolve_sql(href, base))


def _starts_with_any(c: str, prefixes: tuple[str, ...]) -> str:
    return any_of(f"startswith({c}, {literal(p)})" for p in prefixes)


def article_sql(parts: str, spec: SourceSpec) -> str:
    """The article rule, on a name that holds the parts of a URL; false for null."""
    rule = spec.article_rule
    tests = [f"way != {literal(p)}" for p in rule.excluded_paths]
    tests.append("NOT " + _starts_with_any("way", rule.blocked_prefixes))
    if rule.path_pattern is not None:
        tests.append(f"way RLIKE {literal(rule.path_pattern)}")
    if rule.path_prefixes:
        tests.append(_starts_with_any("way", rule.path_prefixes))
        tests.append(
            f"size(filter(split(way, '/'), seg -> seg != '')) >= {rule.min_segments}"
        )
    path = _full_path(parts)
    path_ok = let(f"lower({path})" if rule.ignore_case else path, "way", all_of(tests))
    host_ok = "true" if spec.host is None else f"{_bare_host(parts)} = {literal(spec.host)}"
    return f"coalesce({parts} IS NOT NULL AND {host_ok} AND {path_ok}, false)"


def included_sql(parts: str, spec: SourceSpec) -> str:
    """The prefix filter, on a name that holds the parts of a URL."""
    test = "NOT " + _starts_with_any("way", spec.non_article_prefixes)
    return let(_full_path(parts), "way", test)


def is_article_url(c: str, spec: SourceSpec) -> Column:
    """Does the URL follow the article rule of the source? False when it is no URL."""
    return F.expr(let(parts_sql(c), "site", article_sql("site", spec)))


def not_excluded(c: str, spec: SourceSpec) -> Column:
    """True unless the path starts with one of the source's non-article prefixes
    (plain text prefixes, so ``/terms`` also drops ``/terms-of-use``)."""
    return F.expr(let(parts_sql(c), "site", included_sql("site", spec)))
