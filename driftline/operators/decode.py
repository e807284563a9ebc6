"""Typed bytes to columns, by the names of column types."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.column import Column

from driftline.functions import binary
from driftline.functions.naming import type_name

#: Fixed values of the format: bytes of a whole number, and the type that holds it.
UNSIGNED = {"UNSIGNED TINYINT": (1, "smallint"), "UNSIGNED SMALLINT": (2, "int"), "UNSIGNED INT": (4, "bigint"), "UNSIGNED LONG": (8, "bigint")}
SIGNED = {"TINYINT": (1, "smallint"), "SMALLINT": (2, "smallint"), "INTEGER": (4, "int"), "INT": (4, "int"), "BIGINT": (8, "bigint"), "LONG": (8, "bigint")}
MILLIS = {"TIMESTAMP": 12, "DATE": 8, "TIME": 8}


def decoded(value: Column, kind: str, scale: int = 18) -> Column:
    """A column of bytes as the type `kind` says; null stays null, a fixed-width type of another length fails.

    Times are milliseconds since 1970. A name that is not known is taken for text, as VARCHAR is.
    """
    name = type_name(kind)
    if name in UNSIGNED:
        size, to = UNSIGNED[name]
        return binary.unsigned(value, size).cast(to)
    if name in SIGNED:
        size, to = SIGNED[name]
        return binary.signed(value, size).cast(to)
    if name in MILLIS:
        return binary.millis(value, MILLIS[name])
    match name:
        case "CHAR" | "CHARACTER":
            return F.rtrim(value.cast("string"))
        case "FLOAT":
            return binary.float_of(value)
        case "DOUBLE":
            return binary.double_of(value)
        case "DECIMAL" | "NUMERIC" | "NUMBER":
            return binary.decimal_of(value, scale)
        case "BOOLEAN" | "BOOL":
            return binary.unsigned(value, 1) == 1
        case "VARCHAR ARRAY" | "STRING ARRAY" | "CHARACTER VARYING ARRAY" | "ARRAY":
            return binary.texts_of(value)
        case "VARBINARY" | "BINARY" | "BINARY VARYING":
            return value
    return value.cast("string")


def typed(rows: DataFrame, kinds: dict[str, str]) -> DataFrame:
    """rows with the columns of `kinds` decoded by their type's name; other columns stay as they are."""
    return rows.withColumns({c: decoded(F.col(c), kind) for c, kind in kinds.items()})


def keyed(rows: DataFrame, key: str, kinds: dict[str, str], salt: int = 0) -> DataFrame:
    """rows with the columns of a row key (name: type, in the key's order) before the others; those that can't be cut off are null."""
    width = {n: size for n, (size, _) in (UNSIGNED | SIGNED).items()} | MILLIS | {"FLOAT": 4, "DOUBLE": 8, "BOOLEAN": 1, "BOOL": 1}
    parts = binary.key_parts(F.col(key), [("", width.get(type_name(k), 0)) for k in kinds.values()], salt)
    cut = rows.select(parts.alias("_key_parts"), *rows.columns)
    return cut.select(*(decoded(F.col("_key_parts")[i], k).alias(c) for i, (c, k) in enumerate(kinds.items())), *rows.columns)
