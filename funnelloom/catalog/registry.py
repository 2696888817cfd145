"""Registration of queries and composition of oracle SQL."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from funnelloom.sources.testdata import BINDINGS, Tables, oracle_view

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}
# Oracle-side helper views on top of the bindings, by name without the v_ prefix.
VIEWS: dict[str, str] = {}


class StoredStates(str):
    """Oracle SQL to be run on the table of current states instead of the log's last rows."""


def compose(body: str) -> str:
    """Put the views that ``body`` names (``v_<name>``) in front of it, each once and
    after the views it needs itself."""
    done: dict[str, str] = {}

    def need(text: str) -> None:
        for name in re.findall(r"\bv_([a-z0-9_]+)\b", text):
            if name in done:
                continue
            stored = isinstance(body, StoredStates) and name.startswith("current_")
            sql = VIEWS.get(name.replace("current", "stored", 1) if stored else name) or (oracle_view(name) if name in BINDINGS else None)
            if sql is None:
                raise KeyError(f"unknown view v_{name}")
            need(sql)
            done[name] = sql

    need(body)
    if not done:
        return body
    head = ",\n".join(f"v_{name} AS ({sql})" for name, sql in done.items())
    stripped = body.strip()
    if re.match(r"(?i)with\s", stripped):
        return f"WITH {head},\n{stripped[4:].strip()}"
    return f"WITH {head}\n{stripped}"


def query(key: str, oracle: str | None = None):
    """Register ``fn(tables) -> DataFrame`` under ``key``."""

    def wrap(fn: Callable[[Tables], DataFrame]):
        if key in QUERIES:
            raise KeyError(f"{key} registered twice")
        QUERIES[key] = lambda spark, folder: fn(Tables(spark, folder))
        if oracle is not None:
            ORACLES[key] = oracle
        return fn

    return wrap


def board(key: str, oracle: str):
    """Register ``fn(tables, current) -> DataFrame`` for both inputs of its contract.

    ``<key>`` rebuilds each deal's state from the whole log; ``<key>_from_states`` is
    given the table of current states and reads only the log rows that decide a date.
    """

    def wrap(fn):
        query(key, oracle)(lambda t: fn(t, None))
        query(f"{key}_from_states", StoredStates(oracle))(lambda t: fn(t, t.deal_states))
        return fn

    return wrap


# --- SQL text shared by many oracles ------------------------------------------------
def sql_bucket(day: str, grain: str) -> str:
    return {
        "D": f"CAST({day} AS DATE)",
        "W": f"CAST(date_trunc('week', {day}) AS DATE)",
        "C": f"CAST({day} AS DATE) - CAST((isodow({day}) + 4) % 7 AS INT)",
        "M": f"CAST(date_trunc('month', {day}) AS DATE)",
        "Q": f"CAST(date_trunc('quarter', {day}) AS DATE)",
        "Y": f"CAST(date_trunc('year', {day}) AS DATE)",
    }[grain]


def sql_grain_start(day: str, grain: str = "g") -> str:
    arms = " ".join(f"WHEN '{g}' THEN {sql_bucket(day, g)}" for g in "DWCMQY")
    return f"CASE {grain} {arms} END"


def sql_grain_label(start: str, grain: str = "g") -> str:
    return (
        f"CASE {grain} WHEN 'M' THEN strftime({start}, '%Y-%m') "
        f"WHEN 'Q' THEN concat(year({start}), '-Q', quarter({start})) "
        f"WHEN 'Y' THEN CAST(year({start}) AS STRING) ELSE CAST({start} AS STRING) END"
    )


SQL_GRAINS = "(VALUES ('D'),('W'),('C'),('M'),('Q'),('Y')) AS gr(g)"
