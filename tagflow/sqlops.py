"""Operators over named DataFrames, and how queries bind them to tables.

An ``Operator`` is one SQL statement: ``{name}`` is an input, ``$name`` a parameter. ``operator``
makes one of a function: its arguments without a default are inputs, the others parameters. Called
with DataFrames by name, either gives a lazy DataFrame, so Catalyst sees one plan. Marks stand for
what Spark and other engines spell differently in the views that both read: ``@sha[x]`` (SHA-256 in
hex), ``@list[x|order]`` (comma-joined text in an order), ``@floor5[ts]`` and ``@anti``.
"""

from __future__ import annotations

import inspect
import re
from collections import Counter

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tagflow.tables import materialize, measured

_SPARK = {
    "anti": "LEFT ANTI JOIN",
    "sha": r"sha2(\1, 256)",
    "list": r"listagg(\1, ',') WITHIN GROUP (ORDER BY \2)",
    "floor5": r"(\1 - make_dt_interval(0, 0, minute(\1) % 5, date_part('SECOND', \1)))",
}
_DUCK = {"anti": "ANTI JOIN", "sha": r"sha256(\1)", "list": r"string_agg(\1, ',' ORDER BY \2)", "floor5": r"time_bucket(INTERVAL '5 minutes', \1)"}


def render(sql: str, dialect: dict[str, str]) -> str:
    sql = re.sub(r"@list\[([^\]|]*)\|([^\]]*)\]", dialect["list"], sql)
    sql = sql.replace("@anti", dialect["anti"])
    sql = re.sub(r"@floor5\[([^\]]*)\]", dialect["floor5"], sql)
    if dialect is _DUCK:
        sql = sql.replace("timestamp_ntz", "timestamp")
    return re.sub(r"@sha\[([^\]]*)\]", dialect["sha"], sql)


class Operator:
    def __init__(self, sql: str, doc: str = "", **params):
        self.sql, self.params, self.__doc__ = sql.strip(), params, doc

    def text(self, **given) -> str:
        params = {**self.params, **{k: v for k, v in given.items() if k in self.params}}
        return re.sub(r"\$(\w+)", lambda m: str(params[m[1]]), self.sql)

    def inputs(self) -> list[str]:
        return sorted(set(re.findall(r"\{(\w+)\}", self.sql)))

    def __call__(self, **given) -> DataFrame:
        frames = {k: given[k] for k in self.inputs()}
        spark = next(iter(frames.values())).sparkSession
        parts = re.split(r"(\{\w+\})", self.text(**given))  # braces around anything but an input are text
        text = "".join(x if k % 2 else x.replace("{", "{{").replace("}", "}}") for k, x in enumerate(parts))
        return spark.sql(render(text, _SPARK), **frames)

    def duck(self) -> str:
        """The statement for DuckDB, its inputs by name; for views that both engines read."""
        return re.sub(r"\{(\w+)\}", lambda m: f"{{{m[1]}}}", render(self.text(), _DUCK))


class Plan(Operator):
    """An operator whose plan a function builds."""

    def __init__(self, plan):
        self.plan, self.__doc__ = plan, plan.__doc__
        given = inspect.signature(plan).parameters
        self.names = [k for k, p in given.items() if p.default is p.empty]
        self.params = {k: p.default for k, p in given.items() if p.default is not p.empty}

    def inputs(self) -> list[str]:
        return self.names

    def __call__(self, **given) -> DataFrame:
        return self.plan(**{k: given[k] for k in self.names}, **{k: given.get(k, v) for k, v in self.params.items()})


def operator(plan) -> Plan:
    return Plan(plan)


def flat(df: DataFrame) -> DataFrame:
    """Lists of texts as comma-joined text, for results that are compared by value."""
    joined = {f.name: F.array_join(F.col(f.name), ",") for f in df.schema.fields if isinstance(f.dataType, T.ArrayType)}
    return df.withColumns(joined) if joined else df


class Graph:
    """Named nodes, each an operator bound to base tables or other nodes.

    A node named in ``shared`` that several nodes of one query read is written once and read by each
    of them, rather than computed for each; joins shuffle it, whatever its files' size. It is written while the query's DataFrame is built, so
    ``frame`` runs jobs; one who wants a plan only takes a graph without ``shared``.
    """

    def __init__(self, tables: tuple[str, ...], shared: tuple[str, ...] = ()):
        self.tables, self.shared, self.nodes = tables, shared, {}

    def add(self, name: str, op: Operator, /, **bind) -> None:
        self.nodes[name] = (op, {k: bind.get(k, k) for k in op.inputs()})

    def readers(self, name: str) -> Counter:
        """How many nodes of the query ``name`` read each node."""
        seen, open_, found = set(), [name], Counter()
        while open_:
            n = open_.pop()
            if n not in seen and n in self.nodes:
                seen.add(n)
                read = set(self.nodes[n][1].values())
                found.update(read)
                open_ += read
        return found

    def frame(self, spark, sf_dir: str, name: str) -> DataFrame:
        """The node's DataFrame."""
        made: dict[str, DataFrame] = {}
        readers = self.readers(name)

        def need(n: str) -> DataFrame:
            if n not in made:
                if n in self.tables:
                    made[n] = spark.read.parquet(f"{sf_dir}/{n}.parquet")
                else:
                    op, bind = self.nodes[n]
                    made[n] = op(**{k: need(v) for k, v in bind.items()})
                    if n in self.shared and readers[n] > 1:
                        made[n] = measured(materialize(made[n], n))
            return made[n]

        return need(name)


def with_views(sql: str, known: dict[str, str], tables: tuple[str, ...]) -> str:
    """``sql`` after CTEs of all that it names of ``known`` (name to SQL), and of all that those name."""
    parts: dict[str, str] = {}

    def need(text: str, but: str = "") -> None:
        for n in re.findall(r"\b\w+\b", text):
            if n in known and n != but and n not in parts and n not in tables:
                need(known[n], n)
                parts[n] = known[n]

    need(sql)
    if not parts:
        return sql
    head = ",\n".join(f"{n} AS ({q})" for n, q in parts.items())
    return f"WITH RECURSIVE {head}\n" + (", " + sql.strip()[4:].strip() if sql.strip().startswith("WITH ") else "\n" + sql)
