"""Framing of objects that are read line by line, by many tasks.

Lines come as ``unit, block, seq, log`` (``read_lines``, ``read_paths``): ``block`` numbers the file's
splits in order, ``seq`` the lines of one.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from logforge.functions.text import not_blank
from logforge.operators.framing import header_names, json_heads, row_json
from logforge.operators.joins import join_on
from logforge.operators.ordering import SPAN
from logforge.operators.rows import unfold
from logforge.session import staged

#: Characters around the edges of a block whose separators are settled with both sides at hand.
REACH = 1 << 12
#: Characters scanned at a time.
STEP = 1 << 20


def delimited_lines(
    df: DataFrame, delimiter: str = ",", header: str | None = None, header_regex: str | None = None
) -> DataFrame:
    """Lines of delimited objects → one JSON object per row, as ``frame_delimited`` does for whole ones.

    The first lines of each object, at most three, give its names; a table with a row per
    object takes these back to the lines, which stay where they are. Rows keep ``block`` and ``seq``.
    """
    delimiter = "\t" if delimiter == "\\t" else delimiter
    # Of each task at most three lines of an object get through to the shuffle.
    place = F.row_number().over(Window.partitionBy("unit").orderBy("block", "seq"))
    top = df.select("unit", "block", "seq", "log").withColumn("_place", place).filter("_place <= 3")
    at = F.struct("_place", "block", "seq", "log")
    top = top.groupBy("unit").agg(F.array_sort(F.collect_list(at)).alias("_top"))
    # An empty first line is no line where others follow, as for whole objects.
    skip = F.when((F.get("_top.log", F.lit(0)) == "") & (F.size("_top") > 1), 1).otherwise(0)
    top = top.withColumn("_lines", F.slice("_top", skip + 1, F.size("_top")))
    one, two = F.get("_lines.log", F.lit(0)), F.get("_lines.log", F.lit(1))
    extended = one.startswith("#Version")
    names = header_names(one, two, delimiter, header, header_regex)
    last = F.get("_lines", F.when(extended, 1).otherwise(0))
    last = F.coalesce(last, F.element_at("_lines", -1))
    heads = top.select(
        "unit", json_heads(names).alias("_heads"), last["block"].alias("_block"), last["seq"].alias("_seq"))
    columns = [c for c in df.columns if c != "log"]
    rows = join_on(df, heads, ["unit"])
    body = (F.col("block") > F.col("_block")) | ((F.col("block") == F.col("_block")) & (F.col("seq") > F.col("_seq")))
    rows = rows.filter(body & not_blank(F.col("log")) & (F.size("_heads") > 0))
    return rows.select(*columns, row_json(F.col("_heads"), F.col("log"), re.escape(delimiter)).alias("log"))


class Scanner:
    """Finds the records of one block's text as its lines come in.

    Separators near the edges may reach into a neighbour: all text up to the first separator that
    begins ``reach`` characters into the block is its ``head``, all text behind the last one that ends
    ``reach`` characters before its end its ``tail``. Between them lie whole records. A block without
    such separators is one ``whole`` piece.
    """

    def __init__(self, pattern, reach: int, step: int):
        self.pattern, self.reach, self.step = pattern, reach, step
        self.text, self.begin, self.looked = "", 0, 0
        self.parts: list[str] = []
        self.size = 0
        self.head: tuple[str, str] | None = None
        self.bytes = 0

    def add(self, line: str) -> list[str]:
        """The records that this line completes."""
        self.parts.append(line if self.bytes == 0 else "\n" + line)
        self.bytes += len(line.encode()) + 1
        self.size += len(line) + 1
        return self.scan(self.reach) if self.size >= self.step else []

    def scan(self, margin: int) -> list[str]:
        """Records up to the last separator that ends ``margin`` characters before the end."""
        self.text += "".join(self.parts)
        self.parts, self.size, found = [], 0, []
        limit, next_look = len(self.text) - margin, len(self.text) - 2 * margin
        for match in self.pattern.finditer(self.text, self.looked):
            if match.end() > limit:
                next_look = match.start()
                break
            self.looked = match.end()
            if self.head is not None:
                found.append(self.text[self.begin : match.start()])
                self.begin = match.end()
            elif match.start() >= self.reach:
                # With what follows, so that the separator can be found again.
                self.head = self.text[: match.end()], self.text[match.end() : match.end() + self.reach]
                self.begin = match.end()
        # Nothing in between is looked at again.
        self.looked = max(self.looked, next_look)
        if self.head is not None:
            drop = max(0, self.begin - self.reach)
            self.text, self.begin, self.looked = self.text[drop:], self.begin - drop, self.looked - drop
        return found

    def end(self) -> tuple[list[str], list[tuple[str, str, str, str]]]:
        """The last records, and the edges: kind, text, the characters before and behind it."""
        found = self.scan(self.reach)
        if self.head is None:
            return found, [("whole", self.text, "", "")]
        text, after = self.head
        before = self.text[max(0, self.begin - self.reach) : self.begin]
        return found, [("head", text, "", after), ("tail", self.text[self.begin :], before, "")]


def split_region(pattern, edges: list[dict], first: bool, newline: bool) -> list[str]:
    """Records of the text between the settled parts of two blocks, from their edges."""
    before, after = edges[0]["before"], edges[-1]["after"]
    text = "\n".join(e["log"] for e in edges) + ("\n" if newline else "")
    closed = edges[-1]["kind"] == "head"
    whole, begin, found = before + text + after, len(before), []
    end = len(before) + len(text)
    for match in pattern.finditer(whole, begin):
        if match.end() > end:
            break
        if not (first and not found and match.start() == 0 and match.end() > 0 and begin == 0):
            found.append(whole[begin : match.start()])
        else:
            first = False
        begin = match.end()
    if not closed or begin < end:
        found.append(whole[begin:end])
    return found


def multiline_records(df: DataFrame, pattern: str, reach: int = REACH, step: int = STEP) -> DataFrame:
    """Lines → records between matches of ``pattern``, which may span lines: ``unit, block, seq, log``
    (and ``meta``), the same records as from whole objects.

    Each task scans its own blocks as streams. Only the edges of a block, up to the first and
    from the last separator that no neighbour can change, are brought together and split with both
    sides at hand; a record may cover any number of blocks. ``seq`` is the record's number in
    its object. A separator and what it looks at must lie within ``reach`` characters. Lines must
    come as they were read, and ``size`` (of the file), if there, tells whether the last one is ended.
    """
    import regex

    compiled = regex.compile(pattern)
    if compiled.search("") is not None:
        raise ValueError("a separator pattern must not match the empty text")
    extra = [c for c in ("meta",) if c in df.columns]
    size = F.col("size").cast("bigint") if "size" in df.columns else F.lit(None).cast("bigint")
    lines = df.select("unit", "block", "seq", "log", size.alias("size"), *extra)
    fields = {f.name: f for f in lines.schema.fields}
    schema = T.StructType([
        fields["unit"], T.StructField("block", T.LongType()), T.StructField("kind", T.StringType()),
        T.StructField("n", T.LongType()), T.StructField("log", T.StringType()),
        T.StructField("before", T.StringType()), T.StructField("after", T.StringType()),
        T.StructField("bytes", T.LongType()), T.StructField("size", T.LongType()), *[fields[c] for c in extra]])

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner, key, count, last, row = None, None, 0, None, None

        def out(records: list[tuple], batch: pa.RecordBatch, at: int) -> pa.RecordBatch:
            place = pa.array([at] * len(records), pa.int64())
            kinds = [pa.string(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.int64()]
            columns = [pa.array(list(c), k) for c, k in zip(zip(*records), kinds)]
            return pa.RecordBatch.from_arrays([
                batch.column("unit").take(place), pa.array([key[1]] * len(records), pa.int64()), *columns,
                batch.column("size").take(place), *[batch.column(c).take(place) for c in extra]], schema.names)

        def numbered(found: list[str]) -> list[tuple]:
            nonlocal count
            rows = [("inner", count + i, text, None, None, None) for i, text in enumerate(found)]
            count += len(found)
            return rows

        def finish() -> pa.RecordBatch:
            found, edges = scanner.end()
            rows = numbered(found)
            rows += [(kind, count, text, before, after, scanner.bytes if kind != "tail" else 0)
                     for kind, text, before, after in edges]
            return out(rows, *row)

        for batch in batches:
            units, blocks = batch.column("unit").to_pylist(), batch.column("block").to_pylist()
            seqs, logs = batch.column("seq").to_pylist(), batch.column("log").to_pylist()
            for at, (unit, block, seq, log) in enumerate(zip(units, blocks, seqs, logs)):
                if (unit, block) != key:
                    if scanner is not None:
                        yield finish()
                    scanner, key, count, last = Scanner(compiled, reach, step), (unit, block), 0, None
                if last is not None and seq <= last:
                    raise ValueError("lines are out of order; frame them as they were read")
                last, row = seq, (batch, at)
                found = scanner.add(log or "")
                if found:
                    yield out(numbered(found), *row)
        if scanner is not None:
            yield finish()

    pieces = staged(lines.mapInArrow(scan, schema), "pieces")
    # From here on a row per edge, two per block at most, until the records come back.
    order = F.when(F.col("kind") == "tail", 1).otherwise(0)
    along = Window.partitionBy("unit").orderBy("block", "_order")
    edges = pieces.filter("kind <> 'inner'").withColumn("_order", order)
    edges = edges.withColumn("_g", F.sum("_order").over(along))
    edge = F.struct("block", "_order", "kind", "log", "before", "after", "n")
    regions = edges.groupBy("unit", "_g").agg(
        F.array_sort(F.collect_list(edge)).alias("_edges"), F.sum("bytes").alias("_bytes"), F.max("size").alias("_size"),
        *[F.first(c).alias(c) for c in extra])
    whole = Window.partitionBy("unit")
    regions = regions.withColumns({
        "_newline": F.coalesce(F.sum("_bytes").over(whole) == F.col("_size"), F.lit(False))
        & (F.col("_g") == F.max("_g").over(whole))})

    @F.arrow_udf(T.ArrayType(T.StringType()))
    def records(groups: pa.Array, firsts: pa.Array, newlines: pa.Array) -> pa.Array:
        columns = groups.to_pylist(), firsts.to_pylist(), newlines.to_pylist()
        return pa.array([split_region(compiled, *x) for x in zip(*columns)], pa.list_(pa.string()))

    regions = regions.withColumn("_records", records("_edges", F.col("_g") == 0, "_newline"))
    last_edge = F.element_at("_edges", -1)
    inner = F.when(last_edge["kind"] == "head", last_edge["n"]).otherwise(0)
    regions = regions.select(
        "unit", "_g", "_records", *extra, last_edge["block"].alias("block"), inner.alias("_inner"))
    total = F.size("_records") + F.col("_inner")
    offset = F.sum(total).over(Window.partitionBy("unit").orderBy("_g")) - total
    regions = staged(regions.withColumn("_offset", offset.cast("bigint")), "regions")
    joined = unfold(regions, ["unit", "_offset", *extra], "_records", "log")
    joined = joined.select("unit", (F.col("_offset") + F.col("_pos")).alias("seq"), "log", *extra)
    starts = regions.filter("_inner > 0").select("unit", "block", (F.col("_offset") + F.size("_records")).alias("_start"))
    between = join_on(pieces.filter("kind = 'inner'"), starts, ["unit", "block"])
    between = between.select("unit", (F.col("_start") + F.col("n")).alias("seq"), "log", *extra)
    chunk: Column = F.floor(F.col("seq") / SPAN).cast("bigint").alias("block")
    return joined.unionByName(between).select("unit", chunk, "seq", "log", *extra)
