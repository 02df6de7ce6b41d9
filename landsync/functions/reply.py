"""Typed reads from a VARIANT holding one model reply.

Replies are loosely typed: a number may come as text, a flag as ``"yes"``. Each
reader looks at the JSON type of the value and coerces it.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from landsync.functions.text import bind, first_match, parse_reply_money

_NUMBER = r"^(?:TINYINT|SMALLINT|INT|BIGINT|DECIMAL|FLOAT|DOUBLE)"


def _as(v: Column, kind: str) -> Column:
    return F.try_variant_get(v, "$", kind)


def field(reply: Column, name: str) -> Column:
    """The value under ``name``; null where absent, a JSON null stays a JSON null."""
    return F.try_variant_get(reply, f"$.{name}", "variant")


def _typed(v: Column, read: Callable[[Column, Column], Column]) -> Column:
    """``read(value, its JSON type)``, each looked up once."""
    return bind(F.struct(v.alias("v"), F.schema_of_variant(v).alias("kind")),
                lambda x: read(x["v"], x["kind"]))


def _is_true(v: Column, kind: Column) -> Column:
    return (F.when(kind == "STRING", _as(v, "string") != "")
            .when(kind == "BOOLEAN", _as(v, "boolean"))
            .when(kind.rlike(_NUMBER), _as(v, "double") != 0)
            .when(kind.startswith("ARRAY"), F.to_json(v) != "[]")
            .when(kind.startswith("OBJECT"), F.to_json(v) != "{}")
            .otherwise(F.lit(False)))


def _as_text(v: Column, kind: Column) -> Column:
    return (F.when(kind == "BOOLEAN", F.initcap(_as(v, "string")))
            .when(kind.startswith("ARRAY") | kind.startswith("OBJECT"), F.to_json(v))
            .otherwise(_as(v, "string")))


def text(reply: Column, name: str) -> Column:
    return _typed(field(reply, name), lambda v, kind: F.when(_is_true(v, kind), _as_text(v, kind)))


def number(reply: Column, name: str) -> Column:
    """Money or percentage; a numeric zero counts as missing."""
    return _typed(field(reply, name), lambda v, kind: (
        F.when(kind == "STRING", parse_reply_money(_as(v, "string")))
        .when(kind == "BOOLEAN", F.when(_as(v, "boolean"), F.lit(1.0)))
        .when(kind.rlike(_NUMBER), F.nullif(_as(v, "double"), F.lit(0.0)))))


def age(reply: Column, name: str) -> Column:
    """Whole number; zero is kept."""
    return _typed(field(reply, name), lambda v, kind: (
        F.when(kind == "STRING", first_match(_as(v, "string"), r"\d+", 0).try_cast("int"))
        .when(kind == "BOOLEAN", _as(v, "boolean").cast("int"))
        .when(kind.rlike(_NUMBER), _as(v, "double").try_cast("int"))))


def flag(reply: Column, name: str) -> Column:
    return _typed(field(reply, name), lambda v, kind: (
        F.when(v.isNull() | (kind == "VOID"), F.lit(None).cast("boolean"))
        .when(kind == "BOOLEAN", _as(v, "boolean"))
        .when(kind == "STRING", F.lower(_as(v, "string")).isin("true", "yes", "1"))
        .otherwise(_is_true(v, kind))))


def strings(reply: Column, name: str) -> Column:
    """Non-empty entries of a list as text; null where the value is no list."""
    items = F.try_variant_get(reply, f"$.{name}", "array<variant>")
    typed = F.transform(items, lambda v: F.struct(v.alias("v"), F.schema_of_variant(v).alias("kind")))
    true = F.filter(typed, lambda x: _is_true(x["v"], x["kind"]))
    return F.transform(true, lambda x: _as_text(x["v"], x["kind"]))
