"""Declared facts about an entity and its child tables."""

from __future__ import annotations

import re
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import types as T


@dataclass(frozen=True)
class ChildTable:
    """A history table: its own key and the key of the entity it belongs to."""

    name: str
    key: str


@dataclass(frozen=True)
class EntitySchema:
    """The entity key, the label and the child tables around it."""

    key: str
    label: str | None = None
    children: tuple[ChildTable, ...] = field(default_factory=tuple)

    @property
    def protected(self) -> tuple[str, ...]:
        """Columns that cleaning and encoding must leave alone."""
        names = [self.key, *(c.key for c in self.children)]
        if self.label:
            names.append(self.label)
        return tuple(dict.fromkeys(names))


def is_text(data_type: T.DataType) -> bool:
    return isinstance(data_type, (T.StringType, T.CharType, T.VarcharType))


def is_numeric(data_type: T.DataType) -> bool:
    return isinstance(data_type, (T.NumericType, T.BooleanType))


def is_floating(data_type: T.DataType) -> bool:
    return isinstance(data_type, (T.DoubleType, T.FloatType))


def text_columns(df: DataFrame, exclude: tuple[str, ...] | list[str] = ()) -> list[str]:
    return [f.name for f in df.schema if is_text(f.dataType) and f.name not in exclude]


def numeric_columns(df: DataFrame, exclude: tuple[str, ...] | list[str] = ()) -> list[str]:
    return [f.name for f in df.schema if is_numeric(f.dataType) and f.name not in exclude]


def floating_columns(df: DataFrame, exclude: tuple[str, ...] | list[str] = ()) -> list[str]:
    return [f.name for f in df.schema if is_floating(f.dataType) and f.name not in exclude]


def quoted(name: str) -> str:
    """A column name that may hold dots, dashes or slashes, ready for ``F.col``."""
    return "`" + name.replace("`", "``") + "`"


def sql_literal(value: str | int | float | bool | None) -> str:
    """The value as it is written in Spark SQL."""
    if value is None:
        return "NULL"
    if isinstance(value, bool):
        return str(value).lower()
    if isinstance(value, str):
        return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"
    return f"double('{value}')" if isinstance(value, float) else str(value)


def safe_name(text: str) -> str:
    """A value turned into a piece of a column name."""
    return re.sub(r"[^0-9A-Za-z_]+", "_", text)


def schema_from_names(names: list[str], rules: list[tuple[str, T.DataType]], default: T.DataType) -> T.StructType:
    """A read schema from header names: the first rule whose pattern matches decides."""
    fields = []
    for name in names:
        chosen = next((t for pattern, t in rules if re.search(pattern, name)), default)
        fields.append(T.StructField(name, chosen, True))
    return T.StructType(fields)
