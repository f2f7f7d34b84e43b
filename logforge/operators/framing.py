"""Framing: one text or payload per row → log records.

Every function adds ``records ARRAY<STRING>`` to the object's row; ``explode_records``
blocks, samples and unfolds them. All of it is narrow: an object never leaves its task.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logforge.functions.naming import java_pattern
from logforge.functions.text import json_quote, not_blank, variant_text, with_json
from logforge.operators.rows import unfold


def split_records(text: Column, pattern: str) -> Column:
    """Pieces between matches; a match at the very start gives no empty first piece."""
    pattern = java_pattern(pattern)
    pieces = F.split(text, pattern, -1)
    leading = text.rlike(rf"\A(?:{pattern})") & (F.get(pieces, F.lit(0)) == "")
    return F.when(leading, F.slice(pieces, F.lit(2), F.size(pieces))).otherwise(pieces)


def frame_lines(df: DataFrame, pattern: str = r"\n", text: str = "text") -> DataFrame:
    """Split each object by a regex (look-ahead allowed, for multi-line records)."""
    return df.withColumn("records", split_records(F.col(text), pattern or r"\n"))


def frame_delimited(
    df: DataFrame,
    delimiter: str = ",",
    header: str | None = None,
    header_regex: str | None = None,
    text: str = "text",
) -> DataFrame:
    """Delimited text with a header line → one JSON object per row.

    No quoting rules. ``header`` (same delimiter) replaces the first line. A ``#Version``
    first line means the extended log format: names are on line 2 after a directive word,
    rows follow. Cells that parse as 32-bit integers become numbers, all else strings;
    missing trailing cells are ``""``, surplus ones are ignored.
    """
    delimiter = "\t" if delimiter == "\\t" else delimiter
    df = df.withColumn("_lines", split_records(F.col(text), r"\n"))
    lines = F.col("_lines")
    first = F.get(lines, F.lit(0))
    extended = first.startswith("#Version")
    names = header_names(first, F.get(lines, F.lit(1)), delimiter, header, header_regex)
    rows = F.slice(lines, F.when(extended, 3).otherwise(2), F.size(lines))
    df = df.withColumn("_names", names).withColumn("_rows", F.filter(rows, not_blank)).drop("_lines")
    df = df.withColumn("_heads", json_heads(F.col("_names")))
    # The second mention of _heads keeps Spark from computing it anew for every row.
    ready = F.size("_heads") > 0
    cells = F.transform(F.col("_rows"), lambda row: row_json(F.col("_heads"), row, re.escape(delimiter)))
    return df.withColumn("records", F.when(ready, cells)).drop("_names", "_rows", "_heads")


def header_names(
    first: Column, second: Column, delimiter: str, header: str | None = None, header_regex: str | None = None
) -> Column:
    """Names of the cells, from the first two lines of an object."""
    if header:
        plain = F.array(*[F.lit(name) for name in header.split(delimiter)])
    elif header_regex:
        plain = split_records(first, header_regex)
    else:
        plain = F.split(first, re.escape(delimiter), -1)
    directive = F.split(second, " ", -1)
    extended = first.startswith("#Version")
    return F.when(extended, F.slice(directive, F.lit(2), F.size(directive))).otherwise(plain)


def json_heads(names: Column) -> Column:
    """``"name":`` for each cell; a repeated name keeps its last cell, the others have NULL."""
    return F.zip_with(
        names,
        F.sequence(F.lit(2), F.size(names) + 1),
        lambda n, after: F.when(
            ~F.array_contains(F.slice(names, after, F.size(names)), n), F.concat(json_quote(n), F.lit(":"))
        ),
    )


def row_json(heads: Column, row: Column, cut: str) -> Column:
    """The JSON object of a row; NULL heads drop a cell."""
    parts = F.zip_with(
        heads,
        F.split(row, cut, -1),
        lambda head, cell: F.concat(head, typed_cell(F.coalesce(cell, F.lit("")))),
    )
    return F.concat(F.lit("{"), F.array_join(parts, ","), F.lit("}"))


def typed_cell(value: Column) -> Column:
    """JSON text of a cell. Spark's cast would trim blanks, hence the patterns.

    A cast that fails makes an exception, also where it is only tried, and costs twenty times one that does
    not: what has more digits than a 32-bit integer is left out first, and ten digits are compared.
    """
    large = value.rlike(r"^[+-]?0*[1-9][0-9]{9}$") & value.try_cast("bigint").between(-(1 << 31), (1 << 31) - 1)
    number = F.when(value.rlike(r"^[+-]?0*[0-9]{1,9}$") | large, value.try_cast("int")).cast("string")
    return F.coalesce(number, json_quote(value))


def frame_vpc_flow(df: DataFrame, text: str = "text") -> DataFrame:
    """Flow logs: names separated by any white space, cells by one blank."""
    return frame_delimited(df, delimiter=" ", header_regex=r"\s+", text=text)


def frame_cloudfront(df: DataFrame, text: str = "text") -> DataFrame:
    """Distribution logs: extended log format with tabs."""
    return frame_delimited(df, delimiter="\t", text=text)


def frame_json_array(df: DataFrame, path: str = ".Records", text: str = "text") -> DataFrame:
    """Elements of the JSON array at ``path`` as JSON text; anything else gives no rows."""
    df = with_json(df, text, "_object")
    items = F.try_variant_get(F.col("_object"), "$[0]" + path, "array<variant>")
    return df.withColumn("records", F.transform(items, lambda v: variant_text(v, True))).drop("_object")


def frame_cloudwatch(df: DataFrame, stream_filter: str | None = None) -> DataFrame:
    """Messages of a subscription ``payload``; its names are added to ``meta``.

    The stream filter runs first, before anything is unfolded.
    """
    if stream_filter and stream_filter.strip():
        df = df.filter(F.col("payload.logStream").rlike(java_pattern(stream_filter)))
    meta = F.create_map(
        F.lit("cw.log.group"), F.col("payload.logGroup"),
        F.lit("cw.log.stream"), F.col("payload.logStream"),
        F.lit("cw.owner"), F.col("payload.owner"),
    )
    if "meta" in df.columns:
        meta = F.map_concat(F.coalesce(F.col("meta"), F.create_map().cast("map<string,string>")), meta)
    return (
        df.withColumn("meta", meta)
        .withColumn("records", F.col("payload.logEvents.message"))
        .drop("payload")
    )


def frame_scan_findings(df: DataFrame) -> DataFrame:
    """Image-scan results → one JSON record per finding, then one of severity counts.

    Columns: ``repository``, ``image_digest``, ``image_tags``, ``findings`` (array of
    ``name, uri, severity, attributes[key, value]``), ``severity_counts`` (map). Findings
    without attributes are dropped; so is the summary where there are no counts.
    """

    def attribute(item: Column, name: str, default: str) -> Column:
        # The first value that is not itself the default text decides.
        values = F.transform(
            F.filter(item["attributes"], lambda a: a["key"] == name), lambda a: F.coalesce(a["value"], F.lit(default))
        )
        return F.coalesce(F.get(F.filter(values, lambda v: v != default), F.lit(0)), F.lit(default))

    def text(col: Column) -> Column:
        return F.coalesce(col, F.lit(""))

    metadata = F.struct(
        text(F.col("repository")).alias("repository"),
        F.struct(text(F.col("image_digest")).alias("image_digest")).alias("image_id"),
        F.coalesce(F.col("image_tags"), F.array().cast("array<string>")).alias("image_tags"),
    )

    def finding(item: Column) -> Column:
        name = attribute(item, "package_name", "NO_PACKAGE")
        version = attribute(item, "package_version", "NO_VERSION")
        attributes = F.transform(
            item["attributes"], lambda a: F.struct(a["key"].alias("key"), text(a["value"]).alias("value"))
        )
        return F.to_json(
            F.struct(
                metadata.alias("metadata"),
                F.struct(
                    F.struct(
                        F.concat(name, F.lit(":"), version).alias("package"),
                        name.alias("name"),
                        version.alias("version"),
                    ).alias("package"),
                    F.struct(
                        text(item["name"]).alias("name"),
                        text(item["uri"]).alias("uri"),
                        text(item["severity"]).alias("severity"),
                        attributes.alias("attributes"),
                    ).alias("details"),
                ).alias("findings"),
            )
        )

    counts = F.transform(
        F.map_entries("severity_counts"),
        lambda e: F.concat(F.initcap(e["key"]), F.lit(": "), e["value"].cast("string")),
    )
    summary = F.to_json(
        F.struct(
            metadata.alias("metadata"),
            F.struct(counts.alias("finding_severity_counts")).alias("ecr_scan_summary"),
        )
    )
    found = F.transform(F.filter("findings", lambda f: f["attributes"].isNotNull()), finding)
    tail = F.when(F.col("severity_counts").isNotNull(), F.array(summary)).otherwise(
        F.array().cast("array<string>")
    )
    return df.withColumn("records", F.concat(found, tail)).drop(
        "repository", "image_digest", "image_tags", "findings", "severity_counts"
    )


def kept_records(block: str | None = None, sample: int = 1) -> Column:
    """``records`` without those matching ``block``, then every ``sample``-th of the rest
    (counted within the object, blank records included)."""
    records = F.col("records")
    if block:
        records = F.filter(records, lambda r: ~r.rlike(java_pattern(block)))
    if sample > 1:
        records = F.filter(records, lambda r, i: i % sample == 0)
    return records


def explode_records(df: DataFrame, block: str | None = None, sample: int = 1) -> DataFrame:
    """Unfold ``kept_records``: ``pos``, ``log``. A ``pos`` that was there is ``record`` now."""
    rest = [c for c in df.columns if c not in ("records", "pos", "log")]
    if "pos" in df.columns:
        rest.append(F.col("pos").alias("record"))
    return unfold(df, rest, kept_records(block, sample), "log", "pos")
