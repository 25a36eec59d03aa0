"""What deleting rows does to the tables that refer to them, over any number of levels.

Rows are nodes (table, key). From the rows asked for, a frontier walks along the cascading references, table by table: only children of
tables that the frontier holds are read, and each link is written once. Then two rules are applied until nothing
changes: a row with a child that must stay, and every ancestor that would have removed it, is blocked; a row that was only reached from
blocked ones stays. A restricting child lets its parent go if it goes itself in the same request, so a request may name
parents and children at once, as a clean-up in the order of the tables does.

Every step is a join on (table, key), the lineage is cut by reliable checkpoints, and the number of steps follows the depth of the
references, not the rows. The driver holds table names and counts only.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from weirgate.operators.keys import one_per_key
from weirgate.session import cut_lineage


@dataclass(frozen=True)
class Reference:
    """Rows of ``child`` hold the key of a row of ``parent`` in ``column``; ``action`` is ``cascade`` or ``restrict``."""

    child: str
    column: str
    parent: str
    action: str

    def __post_init__(self) -> None:
        if self.action not in ("cascade", "restrict"):
            raise ValueError(f"unknown action {self.action!r}")


NODE = ["table", "key"]


def _node(table: str, key: Column) -> list[Column]:
    return [F.lit(table).alias("table"), key.cast("string").alias("key")]


def _links(tables: dict[str, tuple[DataFrame, str]], references: list[Reference], nodes: DataFrame, action: str,
           names: set[str]) -> DataFrame | None:
    """Children of ``nodes`` by references of this action: the parent as ``table, key``, the child as ``c_table, c_key``."""
    out = None
    for one in references:
        if one.action != action or one.parent not in names:
            continue
        rows, key = tables[one.child]
        child = rows.where(F.col(one.column).isNotNull()).select(
            F.col(one.column).cast("string").alias("key"), F.lit(one.child).alias("c_table"), F.col(key).cast("string").alias("c_key"))
        found = child.join(nodes.where(F.col("table") == one.parent).select("key"), "key", "left_semi").select(
            F.lit(one.parent).alias("table"), "key", "c_table", "c_key")
        out = found if out is None else out.unionByName(found)
    return out


def _tables_of(nodes: DataFrame) -> set[str]:
    return {row.table for row in nodes.select("table").distinct().collect()}


def delete_closure(tables: dict[str, tuple[DataFrame, str]], references: list[Reference],
                   asked: dict[str, DataFrame]) -> DataFrame:
    """``table, key, asked, outcome`` for every row that a request reaches.

    ``tables`` has each table with its key column (keys are unique), ``asked`` the rows to delete, with the key column. ``outcome`` is
    ``deleted``, ``blocked`` (something that must stay hangs on the row, or below it) or ``kept`` (only reached from blocked
    rows). References may form cycles.
    """
    seeds = None
    for name, rows in asked.items():
        key = tables[name][1]
        there = rows.select(key).join(tables[name][0].select(key), key, "left_semi").select(*_node(name, F.col(key))).distinct()
        seeds = there if seeds is None else seeds.unionByName(there)
    seeds = cut_lineage(seeds)
    nodes = frontier = seeds
    links: DataFrame | None = None
    names = _tables_of(frontier)
    while names:
        found = _links(tables, references, frontier, "cascade", names)
        if found is None:
            break
        found = cut_lineage(found)
        links = found if links is None else links.unionByName(found)
        fresh = found.select(F.col("c_table").alias("table"), F.col("c_key").alias("key")).distinct()
        frontier = cut_lineage(fresh.join(nodes, NODE, "left_anti"))
        names = _tables_of(frontier)
        if names:
            nodes = nodes.unionByName(frontier)
    nodes = cut_lineage(nodes)
    guards = _links(tables, references, nodes, "restrict", _tables_of(nodes))
    guards = cut_lineage(guards) if guards is not None else None
    return _decided(seeds, nodes, links, guards)


def _of_child(links: DataFrame, children: DataFrame, how: str) -> DataFrame:
    """The parents of links whose child is (``left_semi``) or is not (``left_anti``) among ``children``."""
    keyed = children.select(F.col("table").alias("c_table"), F.col("key").alias("c_key"))
    return links.join(keyed, ["c_table", "c_key"], how).select(*NODE)


def _decided(seeds: DataFrame, nodes: DataFrame, links: DataFrame | None, guards: DataFrame | None) -> DataFrame:
    """Largest set of rows that can go: rows drop out until every rule holds."""
    going, blocked = nodes, None
    count = going.count()
    while count:
        # Blocked from below: by children that stay, then up along the cascades.
        bad = _of_child(guards, going, "left_anti") if guards is not None else None
        if links is not None:
            upward = _of_child(links, going, "left_anti")
            bad = upward if bad is None else bad.unionByName(upward)
        if bad is not None:
            bad = cut_lineage(bad.join(going, NODE, "left_semi").distinct())
            blocked = bad if blocked is None else cut_lineage(blocked.unionByName(bad).distinct())
            going = going.join(bad, NODE, "left_anti")
        # Reached from rows that still go: the asked ones first, then down along the cascades.
        alive = front = cut_lineage(going.join(seeds, NODE, "left_semi"))
        while links is not None and not front.isEmpty():
            below = links.join(front, NODE, "left_semi").select(F.col("c_table").alias("table"), F.col("c_key").alias("key")).distinct()
            front = cut_lineage(below.join(going, NODE, "left_semi").join(alive, NODE, "left_anti"))
            alive = alive.unionByName(front)
        going = cut_lineage(alive)
        left = going.count()
        if left == count:
            break
        count = left
    marks = [seeds.withColumn("asked", F.lit(True)), going.withColumn("_goes", F.lit(True))]
    out = nodes
    for mark in marks:
        out = out.join(mark, NODE, "left")
    if blocked is not None:
        out = out.join(blocked.withColumn("_blocked", F.lit(True)), NODE, "left")
    else:
        out = out.withColumn("_blocked", F.lit(None).cast("boolean"))
    outcome = F.when(F.col("_goes"), "deleted").when(F.col("_blocked"), "blocked").otherwise("kept")
    return out.select(*NODE, F.coalesce("asked", F.lit(False)).alias("asked"), outcome.alias("outcome"))


def closure_summary(closure: DataFrame) -> DataFrame:
    """Rows by table and outcome."""
    return closure.groupBy("table", "outcome").agg(F.count(F.lit(1)).alias("rows"), F.count_if("asked").alias("asked"))


def remaining(rows: DataFrame, table: str, key: str, closure: DataFrame) -> DataFrame:
    """The rows of a table that a request leaves."""
    gone = closure.where((F.col("table") == table) & (F.col("outcome") == "deleted")).select("key")
    return rows.withColumn("_key", F.col(key).cast("string")).join(
        one_per_key(gone, ["key"]).withColumnRenamed("key", "_key"), "_key", "left_anti").drop("_key")
