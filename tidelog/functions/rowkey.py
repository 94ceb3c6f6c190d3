"""Row keys "schema"."table"/"pk"/... as text, in SQL expressions and in Python.

Dots of names are doubled, slashes of key values are doubled, a null key value is a bare underscore.
"""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

_DOT, _SLASH = "\x01", "\x02"


def encode(schema: Column, table: Column, pk: list[Column]) -> Column:
    name = lambda c: F.concat(F.lit('"'), F.replace(c, F.lit("."), F.lit("..")), F.lit('"'))
    value = lambda c: F.coalesce(F.concat(F.lit('"'), F.replace(c.cast("string"), F.lit("/"), F.lit("//")), F.lit('"')), F.lit("_"))
    return F.concat_ws("/", F.concat_ws(".", name(schema), name(table)), *map(value, pk))


def parse(key: Column) -> Column:
    """Struct (schema, table, pk: array of strings, null for the underscore)."""
    parts = F.split(F.replace(key, F.lit("//"), F.lit(_SLASH)), "/")
    names = F.split(F.replace(parts[0], F.lit(".."), F.lit(_DOT)), r"\.")
    bare = lambda c: F.regexp_replace(c, '^"|"$', "")
    return F.struct(
        F.replace(bare(names[0]), F.lit(_DOT), F.lit(".")).alias("schema"),
        F.replace(bare(names[1]), F.lit(_DOT), F.lit(".")).alias("table"),
        F.transform(F.slice(parts, 2, F.size(parts)), lambda p: F.when(p != "_", F.replace(bare(p), F.lit(_SLASH), F.lit("/")))).alias("pk"),
    )


def encode_text(schema: str, table: str, pk: list[str | None]) -> str:
    head = ".".join('"' + x.replace(".", "..") + '"' for x in (schema, table))
    return "/".join([head, *("_" if x is None else '"' + x.replace("/", "//") + '"' for x in pk)])


def parse_text(key: str) -> tuple[str, str, list[str | None]]:
    head, *pk = key.replace("//", _SLASH).split("/")
    schema, table = (x.strip('"').replace(_DOT, ".") for x in head.replace("..", _DOT).split("."))
    if not re.fullmatch(r'"[^"]*"\."[^"]*"', head.replace("..", _DOT)):
        raise ValueError(f"not a row key: {key!r}")
    return schema, table, [None if x == "_" else x[1:-1].replace(_SLASH, "/") for x in pk]
