"""Text and byte columns: JSON tests and quoting, base64, gzip, UTF-8, key decoding."""

from __future__ import annotations

import zlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Canonical padded base64, and "has a character that is not white space"
# in the Unicode sense (SQL trim only knows the blank).
BASE64_PATTERN = r"^(?:[A-Za-z0-9+/]{4})*(?:[A-Za-z0-9+/]{2}==|[A-Za-z0-9+/]{3}=)?$"
NOT_BLANK_PATTERN = r"(?U)\S"
JSON_START_PATTERN = r'^\s*[\[{"\-0-9tfn]'


def not_blank(col: Column) -> Column:
    return col.rlike(NOT_BLANK_PATTERN)


def json_quote(col: Column) -> Column:
    """The JSON text of a string."""
    boxed = F.to_json(F.struct(col.alias("v")))
    quoted = F.substr(boxed, F.lit(6), F.length(boxed) - 6)
    return F.when(col.rlike(r'["\\\x00-\x1f\x7f]'), quoted).otherwise(
        F.concat(F.lit('"'), col, F.lit('"'))
    )


def with_json(df: DataFrame, text: str = "log", out: str = "_json") -> DataFrame:
    """Add ``out``: a one-element VARIANT array holding the parsed text, NULL if the
    *whole* text is not exactly one JSON value.

    ``try_parse_json`` ignores trailing text, so the text is parsed inside brackets and
    must yield one element; a text with its own ``]`` could close the bracket early and
    is parsed once more inside an object, where that cannot work.
    """
    col = F.col(text)
    boxed = F.try_parse_json(F.concat(F.lit("["), col, F.lit("]")))
    df = df.withColumn(out, F.when(col.rlike(JSON_START_PATTERN), boxed))
    one = F.try_variant_get(F.col(out), "$[0]", "variant").isNotNull()
    two = F.try_variant_get(F.col(out), "$[1]", "variant").isNotNull()
    closed = ~F.contains(col, F.lit("]")) | F.try_parse_json(
        F.concat(F.lit('{"e":'), col, F.lit("}"))
    ).isNotNull()
    return df.withColumn(out, F.when(one & ~two & closed & ~_beyond_json(col), F.col(out)))


# A high surrogate escape without its low one, or a low one without its high
# one; numbers that may be beyond a double; the start of an object, in what is known to be JSON; a string.
LONE_SURROGATE = (
    r"(?<!\\)(?:\\\\)*(?:\\u[dD][89abAB][0-9a-fA-F]{2}(?!\\u[dD][c-fC-F][0-9a-fA-F]{2})"
    r"|(?<!\\u[dD][89abAB][0-9a-fA-F]{2})\\u[dD][c-fC-F][0-9a-fA-F]{2})")
LARGE_EXPONENT, MANY_DIGITS = r"[0-9][eE]\+?0*[1-9][0-9]{2}", r"[0-9]{300}"
JSON_OBJECT_START = r"^\s*\{"
JSON_STRING = r'"(?:[^"\\]|\\.)*"'
JSON_NUMBER = r"-?[0-9]+(?:\.[0-9]+)?(?:[eE][+-]?[0-9]+)?"


def _beyond_json(text: Column) -> Column:
    """What a strict parser refuses and Spark's does not: lone surrogates, infinite numbers.

    Each is looked for only in texts that hold a mark of it: an escape, an exponent, or digits enough.
    """
    numbers = F.regexp_extract_all(
        F.regexp_replace(text, JSON_STRING, '""'), F.lit(JSON_NUMBER), F.lit(0))
    infinite = F.exists(numbers, lambda n: F.abs(n.cast("double")) == float("inf"))
    escaped = F.contains(text, F.lit("\\u")) | F.contains(text, F.lit("\\U"))
    lone = F.when(escaped, text.rlike(LONE_SURROGATE)).otherwise(False)
    # Two patterns: one with both as its branches takes twice as long as they do.
    long_number = text.rlike(LARGE_EXPONENT) | ((F.length(text) >= 300) & text.rlike(MANY_DIGITS))
    huge = F.when(long_number, infinite).otherwise(False)
    return F.coalesce(lone | huge, F.lit(False))


def strict_object(text: Column) -> Column:
    """Whether the whole text is one JSON object."""
    boxed = F.try_parse_json(F.concat(F.lit("["), text, F.lit("]")))
    one = F.try_variant_get(boxed, "$[0]", "variant").isNotNull()
    two = F.try_variant_get(boxed, "$[1]", "variant").isNotNull()
    closed = F.try_parse_json(F.concat(F.lit('{"e":'), text, F.lit("}"))).isNotNull()
    return F.coalesce(text.rlike(JSON_OBJECT_START) & one & ~two & closed & ~_beyond_json(text), F.lit(False))


def whole_object(text: Column) -> Column:
    """``strict_object`` for texts that are parsed elsewhere: they are only read through here, as the one
    element of an array and the one member of an object, not made into a VARIANT. Reading through lets pass
    single quotes and control characters, so texts with any of these are parsed after all.
    """
    one = F.json_array_length(F.concat(F.lit("["), text, F.lit("]"))) == 1
    closed = F.size(F.json_object_keys(F.concat(F.lit('{"e":'), text, F.lit("}")))) == 1
    read = F.coalesce(text.rlike(JSON_OBJECT_START) & one & closed & ~_beyond_json(text), F.lit(False))
    return F.when(text.rlike(r"['\x00-\x1f]"), strict_object(text)).otherwise(read)


def json_at(json: Column, path: str = "") -> Column:
    """VARIANT at ``path`` (such as ``.logs``) of a value made by ``with_json``."""
    return F.try_variant_get(json, "$[0]" + path, "variant")


def variant_text(value: Column, quote_strings: bool) -> Column:
    """JSON text of a VARIANT; strings come out verbatim unless ``quote_strings``."""
    text = F.to_json(value)
    if not quote_strings:
        text = F.when(F.schema_of_variant(value) == "STRING", value.cast("string")).otherwise(text)
    return F.coalesce(text, F.lit("null"))


def base64_or_raw(value: Column) -> Column:
    """Bytes of a record value: decoded if it is strict base64, else the text itself.

    Spark's own decoder accepts unpadded and spaced input, hence the pattern.
    """
    return F.when(value.rlike(BASE64_PATTERN), base64_bytes(value)).otherwise(
        F.encode(value, "UTF-8")
    )


def base64_bytes(value: Column) -> Column:
    """Decoded base64; NULL, not a failed job, for text that is none."""
    return F.try_to_binary(value, F.lit("base64"))


def utf8_or_null(data: Column) -> Column:
    """Text of valid UTF-8 bytes, NULL otherwise."""
    return F.try_validate_utf8(data.cast("string"))


def object_key(key: Column) -> Column:
    """Decode an object key of a notification: ``+`` is a blank, then percent-decoding."""
    return F.coalesce(F.try_url_decode(key), F.translate(key, "+", " "))


def key_level(key: Column, level: int) -> Column:
    """The ``level``-th (1-based) folder of an object key."""
    return F.get(F.split(key, "/"), F.lit(level - 1))


# Compressed bytes inflated at once: a step gives a thousand times as much at most, and a broken one is done again.
STEP = 1 << 13


def _gunzip(data: bytes | memoryview, out: bytearray | None = None) -> bytes | None:
    """Inflate all gzip members; a broken tail keeps what was decoded before it.

    With ``out`` the bytes go behind those that it holds, and nothing of them is returned but whether there are any.
    """
    whole, out = out is None, bytearray() if out is None else out
    if not len(data):
        return b""
    view, pos, start = memoryview(data), 0, len(out)
    while pos < len(view):
        member = zlib.decompressobj(wbits=31)
        try:
            while pos < len(view) and not member.eof:
                chunk = view[pos : pos + STEP]
                before = member.copy()
                out += member.decompress(chunk)
                pos += len(chunk)
        except zlib.error:
            # Again byte by byte, to keep what the step gave before its error.
            try:
                for at in range(len(chunk)):
                    out += before.decompress(chunk[at : at + 1])
            except zlib.error:
                pass
            break
        pos -= len(member.unused_data)
    if len(out) == start:
        return None
    return bytes(out) if whole else b""


@F.arrow_udf(T.BinaryType())
def gunzip(data: pa.Array) -> pa.Array:
    """Tolerant gunzip; NULL when nothing could be decoded, empty for empty input."""
    # What a batch inflates to goes into one buffer, which is the array's.
    out, ends, there = bytearray(), [0], []
    for cell in data:
        there.append(cell.is_valid and _gunzip(memoryview(cell.as_buffer()), out) is not None)
        ends.append(len(out))
    valid, kind = pa.array(there, pa.bool_()).buffers()[1], pa.binary() if len(out) < 1 << 31 else pa.large_binary()
    offsets = pa.array(ends, pa.int32() if kind == pa.binary() else pa.int64()).buffers()[1]
    return pa.Array.from_buffers(kind, len(data), [valid, offsets, pa.py_buffer(out)])


@F.arrow_udf(T.BinaryType())
def gzip(data: pa.Array) -> pa.Array:
    """Compress each value as one gzip member (for writing payloads back)."""

    def pack(raw: bytes) -> bytes:
        deflate = zlib.compressobj(wbits=31)
        return deflate.compress(raw) + deflate.flush()

    return pa.array([None if d is None else pack(d) for d in data.to_pylist()], pa.binary())


def gunzip_or_raw(data: Column) -> Column:
    """Inflate when the bytes carry the gzip magic and decode, else keep them."""
    is_gzip = F.substr(data, F.lit(1), F.lit(2)) == F.unhex(F.lit("1F8B"))
    return F.coalesce(gunzip(F.when(is_gzip, data)), data)
