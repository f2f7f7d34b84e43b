"""Objects read by the tasks that were given their paths, line by line and in bounded steps."""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator
from typing import BinaryIO

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from logforge.operators.ordering import SPAN

#: Bytes read, or inflated, at a time; a batch of lines has about four times as many.
STEP = 1 << 20
MOST_LINES = 1 << 13
GZIP_MAGIC = b"\x1f\x8b"
# Other names for one kind of store.
SCHEMES = {"s3a": "s3", "s3n": "s3"}


def open_path(path: str) -> BinaryIO:
    """The bytes at an address (``scheme://…`` or a local path), as a stream."""
    from pyarrow import fs

    scheme, _, rest = path.partition(":")
    if path.startswith("/"):
        system, inner = fs.LocalFileSystem(), path
    elif scheme == "file":
        system, inner = fs.LocalFileSystem(), "/" + rest.lstrip("/")
    else:
        system, inner = fs.FileSystem.from_uri(f"{SCHEMES.get(scheme, scheme)}:{rest}")
    return system.open_input_stream(inner, compression=None)


def object_address(bucket: Column, key: Column, form: str = "s3a://{bucket}/{key}") -> Column:
    """Where the object of a notification lies."""
    before, _, rest = form.partition("{bucket}")
    between, _, after = rest.partition("{key}")
    return F.concat(F.lit(before), bucket, F.lit(between), key, F.lit(after))


def read_steps(source: BinaryIO, step: int) -> Iterator[bytes]:
    while data := source.read(step):
        yield data


def inflated(opened: Callable[[], BinaryIO], step: int = STEP) -> Iterator[bytes]:
    """The content of all gzip members, at most ``step`` bytes at a time.

    A broken or cut member gives all that can be decoded before the fault, and ends the
    object. To find that last good part the member is read once more, up to the fault.
    """
    member, begin, read = zlib.decompressobj(wbits=31), 0, 0
    with opened() as source:
        for data in read_steps(source, step):
            read += len(data)
            while data:
                try:
                    out = member.decompress(data, step)
                except zlib.error:
                    yield from _good_part(opened, begin, read - len(data), len(data), step)
                    return
                if out:
                    yield out
                data = member.unconsumed_tail
                if member.eof:
                    data = member.unused_data
                    member, begin = zlib.decompressobj(wbits=31), read - len(data)
    if read > begin:
        try:
            if out := member.flush():
                yield out
        except zlib.error:
            pass


def _good_part(opened: Callable[[], BinaryIO], begin: int, fault: int, length: int, step: int) -> Iterator[bytes]:
    """What the member that begins at ``begin`` gives for the ``length`` bytes from ``fault`` on before
    it fails: they are fed to it one by one."""
    member, at = zlib.decompressobj(wbits=31), 0
    with opened() as source:
        while at < begin and (data := source.read(min(step, begin - at))):
            at += len(data)
        while at < fault and (data := source.read(min(step, fault - at))):
            at += len(data)
            while data:
                member.decompress(data, step)
                data = member.unconsumed_tail
        out = bytearray()
        data = source.read(length)
    try:
        for i in range(len(data)):
            rest = data[i : i + 1]
            while rest:
                out += member.decompress(rest, step)
                rest = member.unconsumed_tail
                if len(out) >= step:
                    yield bytes(out)
                    out.clear()
    except zlib.error:
        pass
    if out:
        yield bytes(out)


def content_of(opened: Callable[[], BinaryIO], compressed: bool | None, step: int = STEP) -> Iterator[bytes]:
    """The bytes of an object; None looks whether it is compressed, and keeps it as it is if
    nothing can be decoded. ValueError if that is the case where compression is certain."""
    if compressed is None:
        with opened() as source:
            compressed = source.read(2) == GZIP_MAGIC or None
        if compressed is None:
            compressed = False
        else:
            parts = inflated(opened, step)
            first = next(parts, None)
            if first is not None:
                yield first
                yield from parts
                return
            compressed = False
    if not compressed:
        with opened() as source:
            yield from read_steps(source, step)
        return
    some = False
    for data in inflated(opened, step):
        some = True
        yield data
    if not some:
        with opened() as source:
            if source.read(1):
                raise ValueError("nothing could be decompressed")


def split_lines(parts: Iterator[bytes], separator: bytes) -> Iterator[list[bytes]]:
    """Pieces between separators, some at a time; all that is held besides is the open piece.

    As with whole objects, a separator at the very start gives no empty first piece.
    """
    held, looked, first = bytearray(), 0, True
    for data in parts:
        held += data
        found, begin = [], 0
        while (at := held.find(separator, max(begin, looked))) >= 0:
            if not (first and at == 0):
                found.append(bytes(held[begin:at]))
            first, begin = False, at + len(separator)
            if len(found) >= MOST_LINES:
                yield found
                found = []
        del held[:begin]
        looked = max(0, len(held) - len(separator) + 1)
        if found:
            yield found
    yield [bytes(held)]


def read_paths(
    paths: DataFrame,
    path: str = "path",
    compression: str = "auto_ext",
    separator: str = "\n",
    opener: Callable[[str], BinaryIO] = open_path,
    tasks: int | None = None,
    step: int = STEP,
) -> DataFrame:
    """Lines of the objects that a table of paths names: its columns and ``unit`` (the path, unless there
    is one), ``block``, ``seq``, ``log``, ``error``.

    The table is spread over ``tasks`` tasks, and each opens its own objects: no list of files
    is made on the driver. An object is a stream: compressed (``auto_ext``: named .gz;
    ``gzip``: always; ``sniff``: found out by looking; ``none``) or not, it is inflated and
    split in steps of ``step`` bytes, so memory does not grow with it. ``seq`` counts its lines
    and ``block`` numbers runs of them, for ``chunk`` and ``order`` of the ordered operators.

    An object that cannot be read or decompressed is a row with ``error`` and no ``log``, and a
    cut one keeps its good part. A line that is not UTF-8 has ``error`` and no ``log``, too.
    ``opener`` maps a path to a binary stream, for stores that pyarrow does not know.
    """
    if compression not in ("auto_ext", "gzip", "sniff", "none"):
        raise ValueError(f"unknown compression {compression!r}")
    taken = [c for c in paths.columns if c not in ("block", "seq", "log", "error")]
    rows = paths.select(*taken)
    if "unit" not in taken:
        rows = rows.withColumn("unit", F.col(path))
    kept = rows.schema
    schema = T.StructType([*kept.fields, *[
        T.StructField(n, k) for n, k in (
            ("block", T.LongType()), ("seq", T.LongType()), ("log", T.StringType()), ("error", T.StringType()))]])

    def texts(lines: list[bytes]) -> tuple[list[str | None], list[str | None]]:
        out, errors = [], []
        for line in lines:
            try:
                out.append(line.decode())
                errors.append(None)
            except UnicodeDecodeError:
                out.append(None)
                errors.append("not UTF-8")
        return out, errors

    def object_lines(address: str | None) -> Iterator[tuple[list, list, list]]:
        """(numbers, texts, errors), a bounded number of bytes at a time."""
        seq = 0
        if address is None:
            yield [None], [None], ["no path"]
            return
        compressed = {"auto_ext": address.endswith(".gz"), "gzip": True, "none": False}.get(compression)
        try:
            for lines in split_lines(content_of(lambda: opener(address), compressed, step), separator.encode()):
                yield range(seq, seq + len(lines)), *texts(lines)
                seq += len(lines)
        except Exception as fault:  # noqa: BLE001 - whatever a store raises is that object's error
            known = isinstance(fault, ValueError)
            yield [None], [None], [str(fault) if known else f"cannot be read: {type(fault).__name__}: {fault}"[:500]]

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            addresses = batch.column(path).to_pylist()
            # Short objects share a batch: one for each would cost more than to read it.
            places, numbers, logs, errors, held = [], [], [], [], 0

            def lines() -> pa.RecordBatch:
                place = pa.array(places, pa.int64())
                return pa.RecordBatch.from_arrays([
                    *[c.take(place) for c in batch.columns],
                    pa.array([None if n is None else n // SPAN for n in numbers], pa.int64()),
                    pa.array(numbers, pa.int64()), pa.array(logs, pa.string()),
                    pa.array(errors, pa.string())], schema.names)

            for at, address in enumerate(addresses):
                for seq, texts_, faults in object_lines(address):
                    places += [at] * len(texts_)
                    numbers += seq
                    logs += texts_
                    errors += faults
                    held += sum(len(t) for t in texts_ if t)
                    if held >= step or len(places) >= MOST_LINES:
                        yield lines()
                        places, numbers, logs, errors, held = [], [], [], [], 0
            if places:
                yield lines()

    spark = paths.sparkSession
    return rows.repartition(tasks or 4 * spark.sparkContext.defaultParallelism).mapInArrow(read, schema)
