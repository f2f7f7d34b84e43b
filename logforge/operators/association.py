"""Tags for metric points: join points to a resource inventory by their dimensions."""

from __future__ import annotations

import re
import warnings
from collections.abc import Iterable

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from logforge.operators.joins import join_on
from logforge.operators.rows import unfold
from logforge.session import staged

REGISTRY_SCHEMA = pa.schema([
    ("namespace", pa.string()),
    ("resource_types", pa.list_(pa.string())),
    ("patterns", pa.list_(pa.struct([
        ("idx", pa.int32()),
        ("regex", pa.string()),
        ("groups", pa.list_(pa.int32())),
        ("dims", pa.list_(pa.string())),
        ("strip", pa.list_(pa.string())),
    ]))),
])

INVENTORY_PAGE_SCHEMA = """ResourceTagMappingList array<struct<ResourceARN string,
    Tags array<struct<Key string, Value string>>>>"""

# Broker metrics carry a node number that resource names do not have.
VALUE_SUFFIXES = {("AWS/AmazonMQ", "Broker"): "-[0-9]+$"}


def whole_arn(service: str, resource: str) -> str:
    """A pattern of complete ARNs (arn:partition:service:region:account:resource)."""
    return rf"^arn:[a-z0-9-]+:{service}:[a-z0-9-]*:[0-9]*:{resource}$"


def default_registry() -> list[dict]:
    """Entries for four namespaces, by the documented form of their resources' ARNs."""
    documented = [
        ("AWS/EC2", "ec2", "ec2:instance", "instance/(?P<InstanceId>i-[0-9a-z]+)"),
        ("AWS/SQS", "sqs", "sqs", "(?P<QueueName>[A-Za-z0-9_.-]+)"),
        ("AWS/Lambda", "lambda", "lambda:function", "function:(?P<FunctionName>[A-Za-z0-9_-]+)"),
        ("AWS/AmazonMQ", "mq", "mq", "broker:(?P<Broker>[A-Za-z0-9_-]+):[A-Za-z0-9-]+"),
    ]
    return [
        {"namespace": namespace, "resource_types": [kind], "arn_patterns": [whole_arn(service, resource)]}
        for namespace, service, kind, resource in documented
    ]


def load_registry(spark: SparkSession, entries: Iterable[dict] | None = None) -> DataFrame:
    """Registry rows from ``{namespace, resource_types, arn_patterns}`` entries (by default
    ``default_registry``). ``whole_arn`` helps to write patterns that cannot match by accident.

    It has one row per namespace. Patterns are checked here: a bad one is skipped with a
    warning, and so is one without named groups, which could match nothing. Group names are
    the dimension names, ``_`` standing for a blank.
    """
    rows = []
    for entry in default_registry() if entries is None else entries:
        patterns = []
        for text in entry.get("arn_patterns") or []:
            try:
                compiled = re.compile(text)
            except re.error as error:
                warnings.warn(f"{entry['namespace']}: skipping pattern {text!r}: {error}", stacklevel=2)
                continue
            if not compiled.groupindex:
                continue
            dims = [name.replace("_", " ") for name in compiled.groupindex]
            strip = [VALUE_SUFFIXES.get((entry["namespace"], d)) for d in dims]
            plain = re.sub(r"\(\?P<[A-Za-z_][A-Za-z0-9_]*>", "(", text)
            groups = list(compiled.groupindex.values())
            patterns.append({"idx": len(patterns), "regex": plain, "groups": groups, "dims": dims, "strip": strip})
        rows.append({
            "namespace": entry["namespace"],
            "resource_types": list(entry.get("resource_types") or []),
            "patterns": patterns,
        })
    # A local relation: Spark knows its size, and so when it may broadcast it.
    return spark.createDataFrame(pa.Table.from_pylist(rows, schema=REGISTRY_SCHEMA))


def load_inventory(pages: DataFrame, resource_types: list[str] | None = None, page: str = "page") -> DataFrame:
    """Exported inventory pages (JSON text, ``page_no``) → ``arn, resource_type, tags, pos``.

    ``pos`` orders resources as listed, page by page.
    """
    items = F.from_json(F.col(page), INVENTORY_PAGE_SCHEMA).getField("ResourceTagMappingList")
    df = unfold(pages, ["page_no"], items, "_r", "_i")
    arn = F.coalesce(F.col("_r.ResourceARN"), F.lit(""))
    service = F.split_part(arn, F.lit(":"), F.lit(3))
    kind = F.regexp_extract(arn, r"^(?:[^:]*:){5}([^:/]+)[:/]", 1)
    df = df.select(
        arn.alias("arn"),
        F.when(kind == "", service).otherwise(F.concat(service, F.lit(":"), kind)).alias("resource_type"),
        F.transform("_r.Tags", lambda t: F.struct(t["Key"].alias("key"), t["Value"].alias("value"))).alias("tags"),
        # A page is one array, which has fewer than 2 ** 31 elements.
        (F.shiftleft(F.col("page_no").cast("bigint"), 31) + F.col("_i")).alias("pos"),
    )
    if resource_types is not None:
        df = df.filter(F.exists(_type_names(), lambda t: t.isin(resource_types)))
    return df


def _type_names() -> Column:
    """A resource is named by its full type or by its service alone."""
    return F.array_distinct(F.array(F.col("resource_type"), F.split_part("resource_type", F.lit(":"), F.lit(1))))


def pick_snapshot(
    inventory: DataFrame, now: Column, ttl_seconds: int = 3600, allow_stale: bool = False, key: str = "namespace"
) -> DataFrame:
    """Rows of the latest snapshot of each ``key``, if it is younger than the time to live
    (or in any case with ``allow_stale``, for when no newer one could be had)."""
    latest = inventory.groupBy(key).agg(F.max("fetched_at").alias("fetched_at"))
    if not allow_stale:
        age = F.unix_micros(now) - F.unix_micros("fetched_at")
        latest = latest.filter(age < ttl_seconds * 1_000_000)
    return inventory.join(latest, [key, "fetched_at"], "left_semi")


def build_associations(resources: DataFrame, registry: DataFrame) -> DataFrame:
    """``resources(arn, resource_type, tags, pos)`` → index rows
    ``namespace, pattern_idx, key, arn, tags``.

    A resource goes to the first pattern of a namespace that matches its ARN; of several
    resources with the same key the last listed one stays.
    """
    wanted = registry.select("namespace", "patterns", F.explode("resource_types").alias("_type"))
    named = resources.withColumn("_type", F.explode(_type_names()))
    df = named.join(wanted, "_type").drop("_type")
    arn = F.col("arn")
    matching = F.slice(F.filter("patterns", lambda p: F.rlike(arn, p["regex"])), 1, 1)

    def index_key(pattern: Column) -> Column:
        return F.transform(pattern["groups"], lambda g: F.call_function("regexp_extract", arn, pattern["regex"], g))

    first = F.transform(matching, lambda p: F.struct(p["idx"].alias("pattern_idx"), index_key(p).alias("key")))
    df = unfold(df, ["namespace", "arn", "tags", "pos"], first, "_p", "_n")
    df = df.select("namespace", "_p.pattern_idx", "_p.key", "arn", "tags", "pos")
    kept = F.max_by(F.struct("arn", "tags"), F.struct("pos", "arn"))
    return df.groupBy("namespace", "pattern_idx", "key").agg(kept.alias("_r")).select(
        "namespace", "pattern_idx", "key", "_r.arn", "_r.tags"
    )


def with_sets(points: DataFrame) -> DataFrame:
    """Points with ``_set``, a hash of their dimension set, for ``associate_tags``."""
    return points.withColumn("_set", F.xxhash64("namespace", "dims"))


def associate_tags(points: DataFrame, index: DataFrame, registry: DataFrame) -> DataFrame:
    """Add ``arn`` and ``tags`` of the resource each point (``namespace``, ``dims``) belongs to.

    Patterns with more dimensions come first, then registry order; all dimensions of a
    pattern must be there, with exactly the values in the index. Points repeat few distinct
    dimension sets, so those are reduced first, matched by equi-joins, and joined back.

    Points are read twice and so written out once, here unless they come ``with_sets`` and were written out as
    such. A hash of a set goes before its values wherever sets are grouped or joined: rows are then sorted by a
    number, and values are compared only where it is the same.
    """
    if "_set" not in points.columns:
        points = staged(with_sets(points), "points")
    one = ["_set", "namespace", "dims"]
    sets = points.select(*one).distinct()
    def value(dim: Column, strip: Column) -> Column:
        found = F.filter("dims", lambda d: d["key"] == dim)
        text = F.try_element_at(found, F.lit(-1))["value"]
        return F.when(strip.isNotNull(), F.regexp_replace(text, strip, F.lit(""))).otherwise(text)

    def attempt(pattern: Column) -> Column:
        return F.struct(
            pattern["idx"].alias("pattern_idx"),
            (-F.size(pattern["dims"])).alias("rank"),
            F.zip_with(pattern["dims"], pattern["strip"], value).alias("key"),
        )

    present = F.filter(
        "patterns", lambda p: F.forall(p["dims"], lambda d: F.exists("dims", lambda m: m["key"] == d))
    )
    tries = sets.join(registry.select("namespace", "patterns"), "namespace")
    tries = unfold(tries, one, F.transform(present, attempt), "_try", "_n")
    tries = tries.select(*one, "_try.pattern_idx", F.col("_try.rank").alias("_rank"), "_try.key")
    hits = tries.join(index, ["namespace", "pattern_idx", "key"])
    best = F.min_by(F.struct("arn", "tags"), F.struct("_rank", "pattern_idx"))
    found = hits.groupBy(*one).agg(best.alias("_r"))
    found = found.select(*one, "_r.arn", "_r.tags")
    return join_on(points, found, one, "left").drop("_set")


def require_inventory(points: DataFrame, inventory: DataFrame, registry: DataFrame, policy: str = "skip") -> DataFrame:
    """``fail`` raises when points have a namespace with patterns but no inventory rows;
    ``skip`` lets them go on without tags."""
    if policy == "skip":
        return points
    if policy != "fail":
        raise ValueError(f"unknown policy {policy!r}")
    needed = registry.filter((F.size("resource_types") > 0) & (F.size("patterns") > 0)).select("namespace")
    known = inventory.select("namespace").distinct()
    missing = needed.join(known, "namespace", "left_anti").withColumn("_missing", F.lit(True))
    df = join_on(points, missing, ["namespace"], "left")
    message = F.concat(F.lit("no inventory for namespace "), F.col("namespace"))
    return df.filter(F.when(F.col("_missing"), F.raise_error(message).cast("boolean")).otherwise(True)).drop("_missing")
