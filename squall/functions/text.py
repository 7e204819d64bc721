"""Text functions."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F

from squall import constants as K

# Leading/trailing whitespace as Python's str.strip() defines it: Unicode white
# space plus the ASCII separators \x1c-\x1f.
_EDGE_WHITESPACE = r"(?U)^[\s\x1c-\x1f]+|[\s\x1c-\x1f]+$"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip(c) -> Column:
    """Remove leading and trailing whitespace (not only spaces)."""
    return F.regexp_replace(_col(c), _EDGE_WHITESPACE, "")


def blank_to_null(c) -> Column:
    """Empty text -> null (a CSV round trip does the same)."""
    return F.nullif(_col(c), F.lit(""))


def null_to_empty(c) -> Column:
    """Any column -> text, null -> ''."""
    return F.coalesce(_col(c).cast("string"), F.lit(""))


def first_translation(c) -> Column:
    """Text of the first element of a ``translation`` array, '' if absent."""
    return F.coalesce(F.try_element_at(_col(c), F.lit(1)).getField("text"), F.lit(""))


def route_from_header(route, header, pattern: str = K.ROUTE_IN_HEADER_PATTERN,
                      fallback: str = K.SYSTEM_WIDE_ROUTE) -> Column:
    """Keep a route; if null take the first ``[CODE]`` of the header, else fallback."""
    found = F.nullif(F.regexp_extract(F.coalesce(_col(header), F.lit("")), pattern, 1), F.lit(""))
    return F.coalesce(_col(route), found, F.lit(fallback))


def contains_any(c, keywords: Iterable[str], case_sensitive: bool = False) -> Column:
    """One column contains any of the keywords (LIKE '%kw%' semantics, 3-valued)."""
    keywords = list(keywords)
    if not keywords:
        return F.lit(False)
    if case_sensitive:
        return reduce(or_, [_col(c).contains(kw) for kw in keywords])
    # bound as a lambda variable, so the text is folded once and not per keyword
    found = F.transform(F.array(F.lower(_col(c))), lambda text: reduce(or_, [text.contains(kw.lower()) for kw in keywords]))
    return F.element_at(found, 1)


def matches_any(columns_to_keywords: Mapping[str, Sequence[str]] | Sequence[tuple],
                case_sensitive: bool = False) -> Column:
    """OR over columns of ``contains_any``.

    Null text gives null for that column's terms, so a row whose only
    candidates are null is filtered out, as in SQL.
    """
    items = columns_to_keywords.items() if isinstance(columns_to_keywords, Mapping) else columns_to_keywords
    # the same column listed twice is scanned once with the union of its keywords
    merged: dict[str, tuple[object, list[str]]] = {}
    for c, kws in items:
        slot = merged.setdefault(str(_col(c)), (c, []))
        slot[1].extend(k for k in kws if k not in slot[1])
    expr = None
    for c, kws in merged.values():
        term = contains_any(c, kws, case_sensitive)
        expr = term if expr is None else (expr | term)
    return F.lit(False) if expr is None else expr


def weather_keyword_predicate(header="header_text", description="description_text") -> Column:
    """F3 with the reporting view's fixed keyword lists."""
    return matches_any([(header, K.HEADER_WEATHER_KEYWORDS),
                        (description, K.DESCRIPTION_WEATHER_KEYWORDS)])


def extract_predicate(agency="agency", header="header", description="description",
                      case_sensitive: bool = True) -> Column:
    """agency match and any extraction keyword in header or description."""
    kws = K.EXTRACT_KEYWORDS
    return (_col(agency) == F.lit(K.EXTRACT_AGENCY)) & matches_any(
        [(header, kws), (description, kws)], case_sensitive=case_sensitive)


def categorise(c, rules=None, default: str | None = None) -> Column:
    """Ordered CASE over case-insensitive substring rules.

    ``rules`` is ``[(keywords, label), ...]``; the first rule with any keyword
    contained wins, else ``default`` (also for null input).
    """
    rules = K.FORECAST_CATEGORY_RULES if rules is None else rules
    default = K.FORECAST_CATEGORY_DEFAULT if default is None else default
    expr = None
    for keywords, label in rules:
        cond = contains_any(c, keywords, case_sensitive=False)
        expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
    return F.lit(default) if expr is None else expr.otherwise(F.lit(default))
