"""String expressions: artist-list parsing (P3), release year (P6) and the
catalogue text search predicate (F5). All are native Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# A quoted list element: "..." or '...'.
_QUOTED = "\"[^\"]*\"|'[^']*'"


def clean_artist(c: Column) -> Column:
    """``"['A', 'B']"`` -> ``"A, B"``; a bracketed text without quoted
    elements has brackets and quotes stripped; anything else is trimmed."""
    t = F.trim(c)
    parts = F.regexp_extract_all(t, F.lit(_QUOTED), 0)
    unquoted = F.transform(parts, lambda x: x.substr(F.lit(2), F.length(x) - 2))
    stripped = F.trim(F.translate(F.regexp_replace(t, r"^[\[\]]+|[\[\]]+$", ""), "'\"", ""))
    return (
        F.when(c.isNull(), F.lit(None).cast("string"))
        .when(t.startswith("[") & (F.size(parts) > 0), F.array_join(unquoted, ", "))
        .when(t.startswith("["), stripped)
        .otherwise(t)
    )


def clean_artist_sql(c: str) -> str:
    t = f"trim({c})"
    parts = f"regexp_extract_all({t}, '\"[^\"]*\"|''[^'']*''', 0)"
    return (
        f"CASE WHEN {c} IS NULL THEN NULL "
        f"WHEN starts_with({t}, '[') AND len({parts}) > 0 "
        f"THEN array_to_string(list_transform({parts}, lambda x: substr(x, 2, length(x) - 2)), ', ') "
        f"WHEN starts_with({t}, '[') THEN trim(translate(regexp_replace({t}, '^[\\[\\]]+|[\\[\\]]+$', '', 'g'), '''\"', '')) "
        f"ELSE {t} END"
    )


def leading_year(c: Column) -> Column:
    """Leading four-digit year of a date-like value, else NULL."""
    y = F.regexp_extract(c.cast("string"), r"^\s*(\d{4})", 1)
    return F.when(y == "", F.lit(None).cast("int")).otherwise(y.cast("int"))


def infer_year(columns: list[str], available: set[str], default: int = 2018) -> Column:
    """Row-level coalesce of the leading year over the candidate columns that
    exist; an input with none of them gets ``default``."""
    present = [c for c in columns if c in available]
    if not present:
        return F.lit(default).cast("int")
    return F.coalesce(*[leading_year(F.col(c)) for c in present])


def text_contains(c: Column, query: str, regex: bool = False) -> Column:
    """Case-insensitive containment; literal by default, NULL never matches."""
    if regex:
        m = c.rlike("(?i)" + query)
    else:
        m = F.lower(c).contains(query.lower())
    return F.coalesce(m, F.lit(False))
