"""What the vector searches share: valid vectors, chunk keys, and keeping the best k."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def valid_vectors(table: DataFrame, nonzero: bool = False, copies: int = 1) -> DataFrame:
    """(vec_id, v array<double>, times) of rows with an id and finite components only.

    Rows that share an id but not the vector stay apart. Equal rows are one with ``times``,
    their number up to ``copies``: no more of them can be among that many best.
    """
    v = F.col("embedding").cast("array<double>")
    odd = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    rows = table.select(F.col("vec_id").cast("long").alias("vec_id"), v.alias("v"), odd.alias("odd"))
    rows = rows.filter("vec_id is not null and v is not null and not odd")
    if nonzero:
        rows = rows.filter(F.exists("v", lambda x: x != 0))
    counted = rows.groupBy("vec_id", "v").agg(F.count(F.lit(1)).alias("n"))
    return counted.select("vec_id", "v", F.least("n", F.lit(copies)).cast("int").alias("times"))


def each_time(df: DataFrame) -> DataFrame:
    """Rows once for each of their ``times``."""
    rest = [c for c in df.columns if c != "times"]
    return df.select(*rest, F.explode(F.sequence(F.lit(1), F.col("times"))).alias("_time")).drop("_time")


def spread(df: DataFrame, name: str, parts: int) -> DataFrame:
    """``df`` once for each of 0 .. parts - 1 in column ``name``."""
    return df.withColumn(name, F.explode(F.sequence(F.lit(0), F.lit(parts - 1))))


def slot(key: Column, parts: int) -> Column:
    """One of 0 .. parts - 1 by a hash of ``key``."""
    return F.pmod(F.xxhash64(key), F.lit(parts)).cast("int")


def matrix(lists: pa.ChunkedArray, width: int, kind=np.float64) -> np.ndarray:
    """Rows of equal length as a matrix."""
    flat = lists.combine_chunks().flatten().to_numpy(zero_copy_only=False)
    return flat.astype(kind, copy=False).reshape(-1, width) if width else np.zeros((len(lists), 0), kind)


def best_k(
    queries: np.ndarray, scores: np.ndarray, ids: np.ndarray, k: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The k highest scores of each query, ties to smaller ids, ordered by query."""
    order = np.lexsort((ids, -scores, queries))
    queries, scores, ids = queries[order], scores[order], ids[order]
    fresh = np.concatenate([[True], queries[1:] != queries[:-1]]) if len(queries) else np.zeros(0, bool)
    starts = np.flatnonzero(fresh)
    rank = np.arange(len(queries)) - np.repeat(starts, np.diff(np.append(starts, len(queries))))
    keep = rank < k
    return queries[keep], scores[keep], ids[keep]


def ranked(found: DataFrame, k: int) -> DataFrame:
    """query_id, rank (from 1), vec_id, score: the k best rows of each query."""
    place = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", place).filter(F.col("rank") <= k).select(
        "query_id", "rank", "vec_id", "score")
