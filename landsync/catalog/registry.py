"""Registry of the queries that run on the driver's tables, with their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query under its function name, with the SQL it must equal."""
    def register(fn: Query) -> Query:
        if fn.__name__ in QUERIES:
            raise ValueError(f"query registered twice: {fn.__name__}")
        QUERIES[fn.__name__] = fn
        if sql is not None:
            ORACLES[fn.__name__] = sql
        return fn
    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def nothing(kind: str) -> Column:
    return F.lit(None).cast(kind)


def run_time() -> Column:
    """A fixed run time, so that results do not change from run to run."""
    return F.lit("2026-01-01 00:00:00").cast("timestamp")


# Pieces of SQL shared by the oracles.
WS = (r"[\s\x0b\x1c-\x1f\x{0085}\x{00A0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}"
      r"\x{202f}\x{205f}\x{3000}]")


def sql_trim(x: str) -> str:
    return f"regexp_replace({x}, '^{WS}+|{WS}+$', '', 'g')"


def sql_squeeze(x: str) -> str:
    return sql_trim(f"regexp_replace({x}, '{WS}+', ' ', 'g')")


def sql_unescape(x: str) -> str:
    for entity, char in [("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'),
                         ("&#39;", "''"), ("&apos;", "''"), ("&ndash;", "–"),
                         ("&copy;", "©"), ("&middot;", "·"), ("&amp;", "&")]:
        x = f"replace({x}, '{entity}', '{char}')"
    return x


def sql_text_of(x: str) -> str:
    return sql_squeeze(sql_unescape(f"regexp_replace({x}, '<[^>]*>', '', 'g')"))


def sql_id(a: str, b: str) -> str:
    h = f"sha256({sql_trim(f'lower({a})')} || '|' || {sql_trim(f'lower({b})')})"
    cuts = [(1, 8), (9, 4), (13, 4), (17, 4), (21, 12)]
    return " || '-' || ".join(f"substr({h}, {s}, {n})" for s, n in cuts)


def sql_quote(x: str) -> str:
    return "'" + x.replace("'", "''") + "'"
