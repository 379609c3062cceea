"""Reading the extractor's answers: JSON text to a typed struct."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from newsloom.functions.sql import let, literal
from newsloom.functions.text import WS_CHARS, fence_sql, is_blank

# Field names of an answer, and ours.
TEXT_FIELDS = (
    ("startupName", "startup_name"),
    ("startupWebsite", "startup_website"),
    ("description", "description"),
    ("newsSummary", "news_summary"),
)


def json_sql(text: str) -> str:
    """VARIANT of a JSON text, null when the text is not exactly one JSON value.

    ``try_parse_json`` ignores what follows the first value. Wrapping the text
    once as an array and once as an object member makes any such rest an error."""
    member = "try_variant_get(try_parse_json(concat('{\"v\":', txt, '}')), '$.v', 'variant')"
    exact = f"CASE WHEN try_parse_json(concat('[', txt, ']')) IS NOT NULL THEN {member} END"
    return let(text, "txt", exact)


def truthy_sql(value: str) -> str:
    """JavaScript truth of a VARIANT: missing, null, false, 0 and "" are false, all else true."""
    test = (
        "CASE WHEN kind = 'VOID' THEN false "
        "WHEN kind = 'BOOLEAN' THEN try_variant_get(val, '$', 'boolean') "
        "WHEN kind = 'STRING' THEN try_variant_get(val, '$', 'string') != '' "
        "WHEN kind IN ('BIGINT', 'DOUBLE', 'FLOAT') OR startswith(kind, 'DECIMAL') "
        "THEN try_variant_get(val, '$', 'double') != 0 "
        "ELSE val IS NOT NULL END"
    )
    return let(value, "val", f"coalesce({let('schema_of_variant(val)', 'kind', test)}, false)")


def text_sql(value: str) -> str:
    """Trimmed text of a JSON string; null for blank text and for other types."""
    text = (
        "CASE WHEN schema_of_variant(val) = 'STRING' THEN "
        f"nullif(btrim(try_variant_get(val, '$', 'string'), {literal(WS_CHARS)}), '') END"
    )
    return let(value, "val", text)


def js_truthy(value: str) -> Column:
    return F.expr(truthy_sql(value))


def parse_extraction(raw: str) -> Column:
    """Raw answer to an extraction struct. No answer, an answer that is no JSON and a
    bare ``null`` are failures; JSON that is no object is merely not relevant."""

    def member(name: str) -> str:
        return f"try_variant_get(doc, '$.{name}', 'variant')"

    ok = "coalesce(schema_of_variant(doc) != 'VOID', false)"
    texts = ", ".join(
        f"'{ours}', CASE WHEN ok THEN {text_sql(member(js))} END" for js, ours in TEXT_FIELDS
    )
    fields = (
        f"named_struct('is_relevant', ok AND {truthy_sql(member('isRelevant'))}, "
        f"{texts}, 'extraction_failed', NOT ok)"
    )
    return F.expr(let(json_sql(fence_sql(raw)), "doc", let(ok, "ok", fields)))


def is_complete_extraction(
    is_relevant: Column | str, startup_name: Column | str, news_summary: Column | str
) -> Column:
    """A relevant answer needs a name and a summary; any other is complete as it is."""
    relevant = F.col(is_relevant) if isinstance(is_relevant, str) else is_relevant
    return ~F.coalesce(relevant, F.lit(False)) | (
        ~is_blank(startup_name) & ~is_blank(news_summary)
    )
