"""Small helpers of the operators: column names, null texts, UDFs over texts, fresh exchanges."""

from __future__ import annotations

import sys
from collections.abc import Callable
from types import ModuleType

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def free(df: DataFrame, name: str) -> str:
    """``name``, with underscores until no column of ``df`` is called so (in any case)."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def whole_text(name: str = "text") -> Column:
    """The text column; null counts as empty."""
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def fresh_key(col: Column) -> Column:
    """The same long value as an expression the planner cannot see through.

    A join side that was just aggregated by its key keeps that exchange, and adaptive
    execution cannot split a hot key above an aggregate. A fresh key makes the join deal
    both sides out itself, so that hot keys are split.
    """
    return col.bitwiseXOR(F.lit(0).cast("long"))


def process_cache(name: str) -> dict:
    """A dictionary that lives as long as this Python process.

    Functions travel inside tasks with the globals they use; what is kept here stays behind.
    """
    holder = sys.modules.setdefault("_logforge_process_cache", ModuleType("_logforge_process_cache"))
    return holder.__dict__.setdefault(name, {})


def text_udf(kind, per_batch: Callable[[list[str]], pa.Array]):
    """A column function of one text column; ``per_batch`` maps texts to an Arrow array."""

    @F.arrow_udf(kind)
    def apply(texts: pa.Array) -> pa.Array:
        return per_batch([t or "" for t in texts.to_pylist()])

    return apply
