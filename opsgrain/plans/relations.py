"""Filters and grouping over the model's relationships.

The model is a graph of tables.  A filter on a dimension reaches the facts that
point to it, and on along chains; ``both`` lets named edges carry filters back
from facts to dimensions (CROSSFILTER), and ``treatas`` adds an edge between
any two columns for one evaluation.  A table's rows are reduced by semi-joins
on the distinct keys of its reduced neighbours, each reached along a path that
does not turn back: the full reduction of an acyclic graph.  Edges that close a
cycle are rejected.  Key sets are joined by shuffle or by Spark's own choice of
a broadcast; no filter list passes through the driver.

Grouping columns are a table's own (``"Status"``, for every table that has it)
or a named table's (``"containers.Status"``, column ``containers_Status``).  A
named one reaches the facts that point to its table, and a fact row whose key
has several values there counts in each.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from opsgrain.functions.frames import beside


class Edge(NamedTuple):
    """Many rows of ``fact`` point to one value of ``dim``; the keys are SQL
    expressions over the tables' columns."""

    fact: str
    fact_key: str
    dim: str
    dim_key: str


# The model's relationships between its business tables.
RELATIONSHIPS = (
    Edge("inventory", "ContainerPrimaryKey", "containers", "PrimaryKey"),
    Edge("inventory", "UnitOfMeasurePrimaryKey", "units_of_measure", "PrimaryKey"),
    Edge("containers", "TemplatePrimaryKey", "container_templates", "PrimaryKey"),
    Edge("units_of_measure", "ProductPrimaryKey", "products", "PrimaryKey"),
    Edge("compartment_barcodes", "ContainerPrimaryKey", "containers", "PrimaryKey"),
    Edge("putaway_lines", "PutAwayContainerPrimaryKey", "putaway_containers", "PrimaryKey"),
    Edge("fulfillment_lines", "FulfillmentOrderPrimaryKey", "fulfillment_orders", "PrimaryKey"),
    Edge("tasks_cyclecount", "InventoryTaskPrimaryKey", "inventory_tasks", "PrimaryKey"),
    Edge("tasks_putaway", "InventoryTaskPrimaryKey", "inventory_tasks", "PrimaryKey"),
    Edge("task_actions", "InventoryTaskPrimaryKey", "inventory_tasks", "PrimaryKey"),
    Edge("tasks_putaway", "PutAwayContainerPrimaryKey", "putaway_containers", "PrimaryKey"),
)


class Slice:
    """A model under a caller's filters and grouping."""

    def __init__(self, model, by: Sequence[str] = (), where: dict[str, Column | str] | None = None,
                 both: Sequence[tuple[str, str]] = (), treatas: Sequence[Edge] = ()):
        self._model, self._where = model, dict(where or {})
        self._both, self._edges = {frozenset(p) for p in both}, (*RELATIONSHIPS, *treatas)
        self._treatas = {frozenset((e.fact, e.dim)) for e in treatas}
        self._named = [tuple(c.split(".")) for c in by if "." in c]
        self.by = [c.replace(".", "_") for c in by]
        self._tables: dict[str, DataFrame] = {}
        unknown = self._both - {frozenset((e.fact, e.dim)) for e in self._edges}
        if unknown:
            raise ValueError(f"no relationship between {sorted(map(sorted, unknown))}")
        part: dict[str, frozenset] = {}
        for e in self._edges:  # connected tables so far
            a, b = (part.get(x, frozenset([x])) for x in (e.fact, e.dim))
            if a == b:
                raise ValueError(f"{e.fact} and {e.dim} are already connected")
            part |= dict.fromkeys(a | b, a | b)

    def all(self):
        """The model without filters and grouping."""
        return self._model

    def _into(self, name: str, came: frozenset) -> list[tuple[str, str, str]]:
        """Neighbours whose filters reach ``name``: (key here, neighbour, its key)."""
        out = [(e.fact_key, e.dim, e.dim_key) for e in self._edges if e.fact == name and e.dim not in came]
        out += [(e.dim_key, e.fact, e.fact_key) for e in self._edges if e.dim == name and e.fact not in came
                and frozenset((e.fact, e.dim)) in self._both | self._treatas]
        return out

    def _is_filtered(self, name: str, came: frozenset = frozenset()) -> bool:
        return name in self._where or any(self._is_filtered(n, came | {name}) for _, n, _ in self._into(name, came | {name}))

    def _reduced(self, name: str, came: frozenset = frozenset()) -> DataFrame:
        df = getattr(self._model, name)
        if name in self._where:
            df = df.filter(self._where[name])
        for key, near, near_key in self._into(name, came | {name}):
            if self._is_filtered(near, came | {name}):
                keys = self._reduced(near, came | {name}).select(F.expr(near_key).alias("_key")).dropna().distinct()
                df = df.withColumn("_key", F.expr(key)).join(keys, "_key", "left_semi").drop("_key")
        return df

    def _with_column(self, df: DataFrame, name: str, table: str, column: str, came: frozenset = frozenset()) -> DataFrame | None:
        """``df``, rows of ``name``, with a column of ``table``, or None where no path leads there."""
        if name == table:
            return df.withColumn(f"{table}_{column}", F.col(column))
        for e in self._edges:
            if e.fact == name and e.dim not in came:
                dim = self._with_column(self._reduced(e.dim), e.dim, table, column, came | {name})
                if dim is not None:
                    values = dim.select(F.expr(e.dim_key).alias("_key"), f"{table}_{column}").dropna(subset=["_key"]).distinct()
                    return df.withColumn("_key", F.expr(e.fact_key)).join(values, "_key", "left").drop("_key")
        return None

    def __getattr__(self, name):
        if name.startswith("_"):
            raise AttributeError(name)
        if name in self._tables:
            return self._tables[name]
        df = getattr(self._model, name)
        if not isinstance(df, DataFrame):
            return df
        df = self._reduced(name)
        for table, column in self._named:
            more = self._with_column(df, name, table, column)
            df = df if more is None else more
        self._tables[name] = df
        return df


def slices(m, df: DataFrame) -> list[str]:
    """The model's grouping columns that ``df`` has."""
    return [c for c in m.by if c in df.columns]


def reached(m, *dfs: DataFrame) -> None:
    """An error for grouping columns that none of a measure's tables has."""
    lost = [c for c in m.by if not any(c in df.columns for df in dfs)]
    if lost:
        raise ValueError(f"{lost} cannot group this measure")


def keys_of(m, df: DataFrame, column: str, alias: str) -> DataFrame:
    """Distinct known keys, for each slice that ``df`` has."""
    return df.select(F.col(column).alias(alias), *slices(m, df)).dropna(subset=[alias]).dropDuplicates()


def within(m, df: DataFrame, keys: DataFrame, *on: str) -> DataFrame:
    """Rows of ``df`` with a key in ``keys``: slice by slice where both are
    sliced alike, and in each slice of ``keys`` that ``df`` does not have."""
    own, other = slices(m, df), slices(m, keys)
    both = [c for c in other if c in own]
    if not [c for c in other if c not in own]:
        known = keys.select(*on, *both).distinct()
        same = [F.col(f"l.{c}").eqNullSafe(F.col(f"r.{c}")) for c in both]
        return df.alias("l").join(known.alias("r"), [*(F.col(f"l.{c}") == F.col(f"r.{c}") for c in on), *same], "left_semi")
    return df.join(keys, [*on, *both])


def pair(m, a: DataFrame, b: DataFrame) -> DataFrame:
    """Two results side by side: slice by slice (a missing slice counts 0), or
    a one-row result beside every row of the other."""
    left, right = slices(m, a), slices(m, b)
    keys = [c for c in left if c in right]
    if left and right and (len(keys) < len(left) and len(keys) < len(right)):
        raise ValueError(f"{left} and {right} belong to unrelated tables")
    if keys:
        x, y = a.alias("x"), b.alias("y")
        j = x.join(y, [F.col(f"x.{c}").eqNullSafe(F.col(f"y.{c}")) for c in keys], "full")
        values = [F.coalesce(F.col(f"{s}.`{c}`"), F.lit(0)).alias(c) for s, d in (("x", a), ("y", b)) for c in d.columns if c not in left + right]
        more = [F.col(f"{'x' if c in left else 'y'}.{c}").alias(c) for c in m.by if (c in left) != (c in right)]
        return j.select(*(F.coalesce(F.col(f"x.{c}"), F.col(f"y.{c}")).alias(c) for c in keys), *more, *values)
    return beside(b, a) if right else beside(a, b)
