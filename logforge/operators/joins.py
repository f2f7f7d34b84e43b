"""Join helper shared by the operators."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame


def join_on(left: DataFrame, right: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """Equi-join by name where NULL keys meet each other, so no row is lost.

    No broadcast hint: Spark broadcasts a side only below its own size threshold, or after
    measuring it (adaptive execution), and splits skewed partitions otherwise.
    """
    renamed = right.select(*[
        right[c].alias(f"_r_{c}") if c in keys else right[c] for c in right.columns
    ])
    condition = reduce(
        lambda a, b: a & b, [left[k].eqNullSafe(renamed[f"_r_{k}"]) for k in keys]
    )
    return left.join(renamed, condition, how).drop(*[f"_r_{k}" for k in keys])
