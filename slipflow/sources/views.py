"""SQL text over a registry: its tables as temporary views, and queries with named parameters.

``register_views`` makes every registry table a view of the session; ``run_sql`` runs the caller's
SQL text over them. Values reach the text by named parameter markers (``:name``) only: Spark binds
them as literals after parsing, so a value is never pasted into the text and cannot change it. The
result is an ordinary DataFrame, analysed when ``run_sql`` returns, so later views of the same names
do not change it.
"""

from __future__ import annotations

import datetime as _dt
import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.joins import dimension
from .registry import LARGE_TABLES, Registry

_NAME = re.compile(r"[A-Za-z_][A-Za-z0-9_]*")


def register_views(reg: Registry, prefix: str = "") -> dict[str, str]:
    """Every table of ``reg`` as a temporary view ``{prefix}{table}``; returns view name by table.

    Lookup tables carry a broadcast hint after the size check that the operators use
    (``joins.dimension``), so SQL text gets the same joins. Views of the same names are replaced:
    give the registries of one session different prefixes.
    """
    if not _NAME.fullmatch(prefix + "x"):
        raise ValueError(f"{prefix!r} cannot begin a view's name")
    names = {}
    for name in Registry.table_names():
        df = reg.table(name)
        names[name] = prefix + name
        (df if name in LARGE_TABLES else dimension(df)).createOrReplaceTempView(names[name])
    return names


def bound(value):
    """A parameter's value as Spark binds it: lists become arrays; datetimes become ISO text, which
    the SQL casts (``CAST(:since AS TIMESTAMP_NTZ)``), since a bound datetime would take the
    session's time zone; anything else must be a plain value or a literal column."""
    if isinstance(value, _dt.datetime):
        if value.tzinfo is not None:
            raise ValueError("the registry's datetimes have no time zone")
        return value.isoformat(sep=" ")
    if isinstance(value, (list, tuple)):
        if not value:
            raise ValueError("a list needs a value: an empty array has no type")
        return F.array(*[F.lit(bound(v)) for v in value])
    if value is None or isinstance(value, (bool, int, float, str, bytes, bytearray, _dt.date, Column)):
        return value
    raise TypeError(f"cannot bind a {type(value).__name__}")


def run_sql(spark: SparkSession, text: str, params: dict | None = None, *,
            registry: Registry | None = None, prefix: str = "") -> DataFrame:
    """The result of SQL ``text`` with its named parameters bound to ``params``; with ``registry``
    its tables are registered as views first (``register_views``). A marker without a value and a
    value without a marker are errors."""
    given = {k: bound(v) for k, v in (params or {}).items()}
    unused = sorted(k for k in given if not re.search(rf":{re.escape(k)}\b", text))
    if unused:
        raise ValueError(f"no marker in the text for {unused}")
    if registry is not None:
        register_views(registry, prefix)
    return spark.sql(text, args=given) if given else spark.sql(text)


def parse_param(text: str):
    """``name=value`` of a command line: an integer, a date, a list in brackets (``[a,b]``), else
    text."""
    name, sign, value = text.partition("=")
    if not sign or not _NAME.fullmatch(name):
        raise ValueError(f"{text!r} is not name=value")
    return name, _parsed(value)


def _parsed(value: str):
    if len(value) > 1 and value[0] == "[" and value[-1] == "]":
        return [_parsed(v.strip()) for v in value[1:-1].split(",")]
    if re.fullmatch(r"-?[0-9]{1,18}", value):
        return int(value)
    if re.fullmatch(r"[0-9]{4}-[0-9]{2}-[0-9]{2}", value):
        return _dt.date.fromisoformat(value)
    return value
