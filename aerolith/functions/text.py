"""Text rendering and keyword matching as column expressions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def contains_any(q: Column, words: list[str]) -> Column:
    return reduce(lambda a, b: a | b, [q.contains(w) for w in words])


def contains_any_sql(q: str, words: list[str]) -> str:
    return "(" + " OR ".join(f"contains({q}, '{w.replace(chr(39), chr(39) * 2)}')" for w in words) + ")"


def first_group(q: Column, groups: list[tuple[str, list[str]]], default: str | None) -> Column:
    """Label of the first keyword group with a keyword contained in ``q``."""
    expr = None
    for label, words in groups:
        cond = contains_any(q, words)
        expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
    return expr.otherwise(F.lit(default)) if default is not None else expr


def first_group_sql(q: str, groups: list[tuple[str, list[str]]], default: str | None) -> str:
    whens = " ".join(f"WHEN {contains_any_sql(q, words)} THEN '{label}'" for label, words in groups)
    return f"CASE {whens} ELSE {repr(default) if default is not None else 'NULL'} END"


def shown(df: DataFrame, c: str) -> Column:
    """A value as the application's f-strings print it: missing column -> 'N/A',
    null string -> 'None', null number -> 'nan', numbers in shortest round-trip form."""
    if c not in df.columns:
        return F.lit("N/A")
    typ = df.schema[c].dataType.typeName()
    if typ in ("double", "float"):
        return F.coalesce(F.col(c).cast("string"), F.lit("nan"))
    return F.coalesce(F.col(c).cast("string"), F.lit("None"))


def shown_sql(c: str, numeric: bool) -> str:
    return f"coalesce(CAST({c} AS VARCHAR), '{'nan' if numeric else 'None'}')"


def yes_no(c: Column, yes: str = "YES", no: str = "No") -> Column:
    return F.when(c == 1, F.lit(yes)).otherwise(F.lit(no))


def render(df: DataFrame, template: list[tuple[str, str | None]]) -> Column:
    """Concatenate literal pieces and shown column values: [(text, column or None), ...]."""
    parts = []
    for text, c in template:
        parts.append(F.lit(text))
        if c is not None:
            parts.append(shown(df, c))
    return F.concat(*parts)


def render_sql(template: list[tuple[str, str | None]], numeric: set[str]) -> str:
    parts = []
    for text, c in template:
        parts.append("'" + text.replace("'", "''") + "'")
        if c is not None:
            parts.append(shown_sql(c, c in numeric))
    return " || ".join(parts)
