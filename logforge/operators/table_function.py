"""User transforms as a table function, to be called from SQL with a table as argument."""

from __future__ import annotations

import importlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from datetime import timezone
from typing import Any

from pyspark.sql import SparkSession
from pyspark.sql import types as T
from pyspark.sql.udtf import AnalyzeArgument, AnalyzeResult

from logforge.operators.transform import record_runner

NAME = "transform_logs"


def named_function(name: str) -> Callable[[Any], list]:
    """The function that ``module:name`` stands for."""
    module, _, attribute = name.partition(":")
    return getattr(importlib.import_module(module), attribute)


def result_schema(functions: dict, table: AnalyzeArgument, fn: AnalyzeArgument, **options: AnalyzeArgument) -> T.StructType:
    """The table's columns and those of the results; ValueError for a call that cannot work."""
    if not table.isTable:
        raise ValueError("the first argument must be a table: TABLE(name) or TABLE(query)")
    unknown = set(options) - {"log", "on_error"}
    if unknown:
        raise ValueError(f"unknown argument {sorted(unknown)[0]!r}")
    log = options["log"].value if "log" in options else "log"
    if log not in table.dataType.names or not isinstance(table.dataType[log].dataType, T.StringType):
        raise ValueError(f"the table has no text column {log!r}")
    for name in ("transform_seq", "transform_error"):
        if name in table.dataType.names:
            raise ValueError(f"the table has a column {name!r} already")
    if not isinstance(fn.value, str) or (":" not in fn.value and fn.value not in functions):
        raise ValueError(f"fn names no function: {fn.value!r}")
    return T.StructType([
        *table.dataType.fields, T.StructField("transform_seq", T.IntegerType()),
        T.StructField("transform_error", T.StringType())])


@dataclass
class Analyzed(AnalyzeResult):
    """Also the types of the table's columns."""

    kinds: list[T.DataType] | None = None


def _zoned(kind: T.DataType) -> Callable[[Any], Any] | None:
    """Gives the instants in a value of this type their zone, if it can hold any.

    Rows come and go as local times, and Spark cannot tell the second of two equal hours by its own.
    """
    if isinstance(kind, T.TimestampType):
        return lambda v: None if v is None else v.astimezone(timezone.utc)
    if isinstance(kind, T.ArrayType) and (item := _zoned(kind.elementType)):
        return lambda v: None if v is None else [item(x) for x in v]
    if isinstance(kind, T.MapType) and (_zoned(kind.keyType) or _zoned(kind.valueType)):
        key, value = (_zoned(k) or (lambda x: x) for k in (kind.keyType, kind.valueType))
        return lambda v: None if v is None else {key(a): value(b) for a, b in v.items()}
    if isinstance(kind, T.StructType) and any(_zoned(f.dataType) for f in kind):
        fields = [_zoned(f.dataType) or (lambda x: x) for f in kind]
        return lambda v: None if v is None else tuple(field(x) for field, x in zip(fields, v))
    return None


def transform_function(functions: dict[str, Callable[[Any], list]]) -> type:
    """The class of the table function, which knows ``functions`` by their names."""

    class TransformLogs:
        """``transform_logs(TABLE(…), fn => …, log => 'log', on_error => 'passthrough')``.

        The result has the columns of its table, whatever they are, and ``transform_seq`` and
        ``transform_error``: the schema is found from the argument when the query is analysed.
        """

        @staticmethod
        def analyze(table: AnalyzeArgument, fn: AnalyzeArgument, **options: AnalyzeArgument) -> AnalyzeResult:
            schema = result_schema(functions, table, fn, **options)
            return Analyzed(schema, kinds=[f.dataType for f in table.dataType])

        def __init__(self, analyze_result: Analyzed) -> None:
            self.run: Callable[[str], tuple[list[str], str | None]] | None = None
            self.zoned = [(i, use) for i, kind in enumerate(analyze_result.kinds) if (use := _zoned(kind))]

        def eval(self, table, fn: str, log: str = "log", on_error: str = "passthrough") -> Iterator[tuple]:
            if self.run is None:
                self.run = record_runner(functions.get(fn) or named_function(fn), on_error)
                self.at = table.__fields__.index(log)
            record = table[self.at]
            results, error = self.run(record) if record is not None else ([None], None)
            row = [*table, 0, error]
            for i, use in self.zoned:
                row[i] = use(row[i])
            for seq, text in enumerate(results):
                row[self.at], row[-2] = text, seq
                yield tuple(row)

    return TransformLogs


def register_transforms(spark: SparkSession, name: str = NAME, **functions: Callable[[Any], list]) -> str:
    """Make the table function known to SQL under ``name``, with user functions by their names.

    Functions of importable modules need no registration: ``fn => 'module:function'``.
    """
    from pyspark.sql.functions import udtf

    # Rows come in pickled batches: with Arrow each row's results would be a table of their own.
    spark.udtf.register(name, udtf(transform_function(functions), useArrow=False))
    return name
