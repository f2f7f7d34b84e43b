"""Prefix scans along units, as a tree of bounded steps.

What one chunk of a unit does to whatever came before it is a small function, and two such
functions in a row are one again. So chunks are combined ``FAN_IN`` at a time on the way up, and
on the way down each group hands its children the state that they begin with. A unit with
n chunks takes log(n) rounds; no task meets more than ``FAN_IN`` of them at once, however many
rows one unit has.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logforge.operators.joins import join_on
from logforge.session import staged

FAN_IN = 32


def sweep_up(
    leaves: DataFrame, unit: list[str], combine: Callable[[Column], Column], fan_in: int | None = None
) -> tuple[list[DataFrame], int]:
    """The rounds of the tree, lowest first, and the lowest chunk number.

    ``leaves`` has ``unit``, ``_chunk`` (a whole number) and ``_f``, the chunk's function; it
    is read several times. A round has a row per unit and parent with its ``_children``
    (``_node`` and ``_f``, in order). ``combine`` maps an array of functions to one.
    """
    fan_in = fan_in or FAN_IN
    first = leaves.agg(F.min("_chunk"), F.max("_chunk")).first()
    low, width = (first[0] or 0), (first[1] or 0) - (first[0] or 0)
    nodes = leaves.select(*unit, (F.col("_chunk") - low).alias("_node"), "_f")
    rounds: list[DataFrame] = []
    while True:
        child = F.struct("_node", "_f")
        parents = nodes.groupBy(*unit, F.floor(F.col("_node") / fan_in).alias("_parent"))
        parents = parents.agg(F.array_sort(F.collect_list(child)).alias("_children"))
        width //= fan_in
        # The last round is read once, the others on both ways.
        rounds.append(staged(parents, "round") if width else parents)
        if not width:
            return rounds, low
        nodes = rounds[-1].select(*unit, F.col("_parent").alias("_node"), combine(F.col("_children._f")).alias("_f"))


def prefix_scan(
    leaves: DataFrame,
    unit: list[str],
    combine: Callable[[Column], Column],
    start: Callable[[Column], Column],
    hand_down: Callable[[Column, Column], Column],
    fan_in: int | None = None,
) -> DataFrame:
    """``unit, _chunk, _state``: the state each chunk begins with.

    ``start`` gives the first state of a unit from the function of its first chunks,
    ``hand_down(functions, state)`` the array of states before each of some consecutive ones.
    """
    rounds, low = sweep_up(leaves, unit, combine, fan_in)
    states = rounds[-1].withColumn("_state", start(F.get("_children._f", F.lit(0))))
    for lower in [*reversed(rounds[:-1]), None]:
        handed = F.arrays_zip(
            F.col("_children._node").alias("_node"),
            hand_down(F.col("_children._f"), F.col("_state")).alias("_state"))
        states = states.select(*unit, F.inline(handed))
        if lower is not None:
            states = join_on(lower, states.withColumnRenamed("_node", "_parent"), [*unit, "_parent"])
    return states.select(*unit, (F.col("_node") + low).alias("_chunk"), "_state")
