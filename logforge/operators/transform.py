"""User transforms: a Python function per record, and the common ones as native columns."""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator
from typing import Any

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from logforge.functions.naming import java_pattern
from logforge.functions.text import json_at, json_quote, variant_text, with_json
from logforge.operators.rows import unfold


def _parse(log: str) -> Any:
    def not_json(name: str):
        raise ValueError(name)

    def finite(text: str) -> float:
        number = float(text)
        if number in (float("inf"), float("-inf")):
            raise ValueError(text)
        return number

    try:
        value = json.loads(log, parse_constant=not_json, parse_float=finite)
        if "\\u" in log:
            # Only an escape can bring in a lone surrogate, which has no UTF-8 form.
            json.dumps(value, ensure_ascii=False).encode()
        return value
    except (ValueError, RecursionError):
        return log


def _check_keys(value: Any) -> None:
    if isinstance(value, dict):
        for key, item in value.items():
            if not isinstance(key, str):
                raise TypeError(f"object key must be a string, got {key!r}")
            _check_keys(item)
    elif isinstance(value, list):
        for item in value:
            _check_keys(item)


def _render(item: Any) -> str:
    if isinstance(item, str):
        return item
    _check_keys(item)
    return json.dumps(item, ensure_ascii=False, separators=(",", ":"), allow_nan=False)


def record_runner(fn: Callable[[Any], list], on_error: str = "passthrough") -> Callable[[str], tuple[list[str], str | None]]:
    """Record → its results as texts, and the error if the call failed."""

    def run(record: str) -> tuple[list[str], str | None]:
        try:
            result = fn(_parse(record))
            if not isinstance(result, list):
                raise TypeError(f"got {type(result).__name__}, expected a list")
            texts = [_render(item) for item in result]
            for text in texts:
                # A lone surrogate has no UTF-8 form: that is this record's error, not the job's.
                text.encode()
            return texts, None
        except Exception as error:
            if on_error == "fail":
                raise
            return [record], f"{type(error).__name__}: {error}"

    return run


def transform_records(
    df: DataFrame,
    fn: Callable[[Any], list] | None,
    log: str = "log",
    on_error: str = "passthrough",
) -> DataFrame:
    """Flat-map each record through ``fn(event) -> list``.

    ``event`` is the parsed JSON value, or the text if it is none. Strings in the result
    are used verbatim, other values as JSON text. A record whose call raises or returns no
    list passes unchanged, with ``transform_error`` set (or fails the job with
    ``on_error="fail"``). ``transform_seq`` numbers the results of one record. Other
    columns are repeated for every result. An unusable ``fn`` leaves all records as they
    are. ``print`` inside ``fn`` goes to the executor's log.
    """
    if not callable(fn):
        if on_error == "fail":
            raise TypeError("fn is not callable")
        return df.withColumn("transform_seq", F.lit(0)).withColumn("transform_error", F.lit("fn is not callable"))
    run = record_runner(fn, on_error)

    def batches(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in source:
            rows, logs, seqs, errors = [], [], [], []
            for i, record in enumerate(batch.column(log).to_numpy(zero_copy_only=False).tolist()):
                results, error = run(record) if record is not None else ([None], None)
                rows += [i] * len(results)
                logs += results
                seqs += range(len(results))
                errors += [error] * len(results)
            picked = batch.take(pa.array(rows, pa.int64()))
            columns = {name: picked.column(name) for name in picked.schema.names}
            columns[log] = pa.array(logs, pa.string())
            columns["transform_seq"] = pa.array(seqs, pa.int32())
            columns["transform_error"] = pa.array(errors, pa.string())
            yield pa.RecordBatch.from_pydict(columns)

    schema = T.StructType([
        *df.schema.fields,
        T.StructField("transform_seq", T.IntegerType()),
        T.StructField("transform_error", T.StringType()),
    ])
    return df.mapInArrow(batches, schema)


# Native forms. They need no Python worker and stay in generated code.


def unnest(df: DataFrame, path: str = ".logs", log: str = "log", drop: Callable[[Column], Column] | None = None) -> DataFrame:
    """Replace a record by the elements of its array at ``path``; a record without an array
    there passes whole. ``drop(element)`` removes single elements (a VARIANT test)."""
    df = with_json(df, log)
    items = F.try_variant_get(F.col("_json"), "$[0]" + path, "array<variant>")
    if drop is not None:
        items = F.filter(items, lambda v: ~F.coalesce(drop(v), F.lit(False)))
    texts = F.coalesce(F.transform(items, lambda v: variant_text(v, False)), F.array(F.col(log)))
    rest = [c for c in df.columns if c not in (log, "_json", "transform_seq")]
    return unfold(df.withColumn("_texts", texts), rest, "_texts", "_text", "transform_seq").withColumnRenamed("_text", log)


def drop_where(df: DataFrame, path: str, value: str, log: str = "log") -> DataFrame:
    """Drop records whose JSON string at ``path`` equals ``value``."""
    df = with_json(df, log)
    found = json_at(F.col("_json"), path)
    is_text = F.schema_of_variant(found) == "STRING"
    hit = F.coalesce(is_text & (found.cast("string") == value), F.lit(False))
    # Kept records as arrays: a filter would be pushed below and parse the text again.
    rest = [c for c in df.columns if c not in (log, "_json")]
    kept = df.withColumn("_kept", F.when(~hit, F.array(F.col(log))))
    return unfold(kept, rest, "_kept", "_text").drop("_pos").withColumnRenamed("_text", log)


def add_fields(df: DataFrame, fields: dict[str, Any], where: Column | None = None, log: str = "log") -> DataFrame:
    """Set constant fields on records that are JSON objects; others pass unchanged.

    ``where`` may use the column ``_json`` (see ``json_at``) to pick records.
    """
    df = with_json(df, log)
    extra = json.dumps(fields, ensure_ascii=False)
    members = F.try_variant_get(F.col("_json"), "$[0]", "map<string,variant>")
    added = F.lit(extra)
    merged = F.map_concat(members, F.parse_json(added).cast("map<string,variant>"))
    ready = members.isNotNull() if where is None else members.isNotNull() & F.coalesce(where, F.lit(False))
    return df.withColumn(log, F.when(ready, F.to_json(merged)).otherwise(F.col(log))).drop("_json")


def redact(df: DataFrame, pattern: str, replacement: str, log: str = "log", field: str | None = None) -> DataFrame:
    """Replace all matches, in the whole text or in one string field of JSON objects.

    ``$1`` refers to a group and ``$$`` is a dollar sign.
    """
    replacement = replacement.replace("\\", "\\\\").replace("$$", "\\$")
    pattern = java_pattern(pattern)
    if field is None:
        return df.withColumn(log, F.regexp_replace(log, pattern, replacement))
    df = with_json(df, log)
    members = F.try_variant_get(F.col("_json"), "$[0]", "map<string,variant>")
    value = F.try_element_at(members, F.lit(field))
    is_text = F.coalesce(F.schema_of_variant(value) == "STRING", F.lit(False))
    clean = F.regexp_replace(value.cast("string"), pattern, replacement)
    merged = F.map_concat(members, F.create_map(F.lit(field), F.parse_json(json_quote(clean))))
    return df.withColumn(log, F.when(is_text, F.to_json(merged)).otherwise(F.col(log))).drop("_json")
