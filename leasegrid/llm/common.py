"""Helpers the operators of this folder share."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterable, Iterator
from functools import wraps

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leasegrid.session import cut_lineage

#: Rows up to which a table of a few numbers per row may be broadcast; beyond it joins shuffle.
BROADCAST_ROWS = 500_000


def fresh(taken: Iterable[str], stem: str) -> str:
    """A column name that clashes with none of ``taken`` (names compare without case)."""
    used = {c.lower() for c in taken}
    name = stem
    while name.lower() in used:
        name += "_"
    return name


def give_back() -> None:
    """Memory that this Python process has freed goes back to the machine, where the C library can do that."""
    pa.default_memory_pool().release_unused()
    if hasattr(libc := ctypes.CDLL(None), "malloc_trim"):
        libc.malloc_trim(0)


def giving_back(run: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """``run``, which turns a task's batches into others, with what it held given back when the task ends.

    Python workers outlive their tasks. Without this the largest batch and cache
    of any task so far stays with each worker, beside the heap of the executor.
    """

    @wraps(run)
    def whole(batches):
        try:
            yield from run(batches)
        finally:
            give_back()

    return whole


def broadcast_if_small(frozen: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """Broadcast hint for a narrow, frozen table whose counted size allows it; else as it is."""
    return F.broadcast(frozen) if frozen.count() <= rows else frozen


def side_key(col: str) -> Column:
    """Second grouping key that depends on the first.

    A table aggregated by (key, side key) is not yet laid out by the key alone,
    so a later join on the key exchanges both sides and adaptive execution can
    split a hot key.
    """
    return F.pmod(F.xxhash64(col), F.lit(64)).alias("side")


def components(edges: DataFrame) -> DataFrame:
    """Connected components of the links ``(a, b)`` of long ids: rows ``(node, component)``.

    Alternating large-star and small-star rounds until nothing changes; the
    component is the smallest id. Nodes that are their own component, loops and
    links with a null end give no row. Every round is frozen in the shared folder.
    """
    a, b = F.col("a"), F.col("b")
    state = cut_lineage(
        edges.where(a != b).select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct()
    )
    seen = None
    while True:
        now = state.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if not now[0] or now == seen:
            return state.select(F.col("u").alias("node"), F.col("v").alias("component"))
        seen = now
        both = state.union(state.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u", side_key("u")).agg(F.min("v").alias("m"))
        least = least.select(F.col("u").alias("w"), F.least("u", "m").alias("m"))
        large = both.join(least, F.col("u") == F.col("w")).where(F.col("v") > F.col("u"))
        large = large.select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        low = large.groupBy("u", side_key("u")).agg(F.min("v").alias("m"))
        low = low.select(F.col("u").alias("w"), "m")
        small = large.join(low, F.col("u") == F.col("w")).select(F.col("v").alias("u"), F.col("m").alias("v"))
        small = small.where(F.col("u") != F.col("v")).union(low.select("w", "m"))
        state = cut_lineage(small.distinct())
