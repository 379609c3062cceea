"""Small helpers for expressions written as SQL text.

The nested expressions of this package (URLs, snapshots, answers) are written as SQL
text and handed to ``expr`` once: Spark parses one text instead of being called for
each of some hundred pieces. Arguments are column names or SQL expressions.
"""

from __future__ import annotations

from collections.abc import Iterable


def literal(text: str) -> str:
    """A SQL string literal."""
    out = []
    for ch in text:
        if ch in "\\'":
            out.append("\\" + ch)
        elif " " <= ch <= "~":
            out.append(ch)
        else:
            out.append(f"\\u{ord(ch):04x}")
    return "'" + "".join(out) + "'"


def let(value: str, name: str, body: str) -> str:
    """``body`` with ``name`` standing for ``value``, which is computed once."""
    return f"element_at(transform(array({value}), {name} -> {body}), 1)"


def any_of(tests: Iterable[str]) -> str:
    """Disjunction; false when there is nothing to test."""
    return "(" + (" OR ".join(tests) or "false") + ")"


def all_of(tests: Iterable[str]) -> str:
    """Conjunction; true when there is nothing to test."""
    return "(" + (" AND ".join(tests) or "true") + ")"
