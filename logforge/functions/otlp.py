"""Metric messages: small Arrow helpers between wire bytes and nested columns.

Only what the operators touch is decoded (names, units, attributes, count and sum). The
other fields of each level travel along untouched as ``rest`` bytes, and attribute values
that are more than scalars or flat lists of them as ``raw`` bytes, so writing a message back
loses nothing.
"""

from __future__ import annotations

import json
import struct
from typing import Any

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import from_arrow_type

_scalar = [
    ("stringValue", pa.string()),
    ("boolValue", pa.bool_()),
    ("intValue", pa.int64()),
    ("doubleValue", pa.float64()),
]
SCALAR = pa.struct(_scalar)
HELD = pa.struct([*_scalar, ("raw", pa.binary())])
VALUE = pa.struct([
    *_scalar,
    ("arrayValue", pa.struct([("values", pa.list_(SCALAR))])),
    ("kvlistValue", pa.struct([("values", pa.list_(pa.struct([("key", pa.string()), ("value", HELD)])))])),
    # Wire bytes of a value that the fields above do not hold whole: bytes, deeper lists.
    ("raw", pa.binary()),
])
ATTRIBUTES = pa.list_(pa.struct([("key", pa.string()), ("value", VALUE)]))
POINT = pa.struct([
    ("attributes", ATTRIBUTES), ("count", pa.int64()), ("sum", pa.float64()), ("rest", pa.binary()),
])
METRIC = pa.struct([
    ("name", pa.string()), ("unit", pa.string()), ("kind", pa.string()),
    ("data_points", pa.list_(POINT)), ("data_rest", pa.binary()), ("rest", pa.binary()),
])
SCOPE = pa.struct([("metrics", pa.list_(METRIC)), ("rest", pa.binary())])
RESOURCE = pa.struct([("scope_metrics", pa.list_(SCOPE)), ("rest", pa.binary())])
RESOURCES = pa.list_(RESOURCE)

# Fixed values (public OTLP message numbers): data field of a metric, attribute field of
# its data points.
KINDS = {
    "gauge": (5, 7),
    "sum": (7, 7),
    "histogram": (9, 9),
    "exponential_histogram": (10, 1),
    "summary": (11, 7),
}
KIND_OF = {field: kind for kind, (field, _) in KINDS.items()}


def read_varint(data: bytes, at: int) -> tuple[int, int]:
    value = shift = 0
    while True:
        if at >= len(data) or shift > 63:
            raise ValueError("bad varint")
        byte = data[at]
        at += 1
        value |= (byte & 0x7F) << shift
        if byte < 0x80:
            return value, at
        shift += 7


def varint(value: int) -> bytes:
    out = bytearray()
    while value > 0x7F:
        out.append(value & 0x7F | 0x80)
        value >>= 7
    out.append(value)
    return bytes(out)


SHORT = [varint(n) for n in range(128)]


def _block(number: int, data: bytes) -> bytes:
    size = len(data)
    return SHORT[number << 3 | 2] + (SHORT[size] if size < 128 else varint(size)) + data


def _fields(data: bytes) -> list[tuple[int, Any, int, int]]:
    """(number, value, start, end) of each field of a message."""
    out = []
    at, end = 0, len(data)
    while at < end:
        start = at
        tag, at = read_varint(data, at) if data[at] & 0x80 else (data[at], at + 1)
        wire = tag & 7
        if wire == 2:
            if at >= end:
                raise ValueError("short message")
            size, at = read_varint(data, at) if data[at] & 0x80 else (data[at], at + 1)
            value = data[at : at + size]
            at += size
        elif wire == 0:
            value, at = read_varint(data, at)
        elif wire in (1, 5):
            size = 8 if wire == 1 else 4
            value = data[at : at + size]
            at += size
        else:
            raise ValueError(f"bad wire type {wire}")
        if at > end:
            raise ValueError("short message")
        out.append((tag >> 3, value, start, at))
    return out


# Messages are decoded into one flat list per column and level, and encoded from them, so
# no nested Python objects are made per message.


class _Columns:
    """Growing lists, one per column of a level; ``mark`` and ``undo`` drop a bad message."""

    def __init__(self, *names: str):
        self.lists: dict[str, list] = {name: [] for name in names}

    def __getitem__(self, name: str) -> list:
        return self.lists[name]

    def mark(self) -> dict[str, int]:
        return {name: len(column) for name, column in self.lists.items()}

    def undo(self, mark: dict[str, int]) -> None:
        for name, size in mark.items():
            del self.lists[name][size:]


def _add_scalar(columns: _Columns, prefix: str, data: bytes) -> tuple[int, bytes] | None:
    """Append one value; a value that is no scalar is returned (field, bytes)."""
    text = flag = number = real = held = None
    for field, value, _, _ in _fields(data):
        text = flag = number = real = held = None
        if field == 1:
            text = value.decode()
        elif field == 2:
            flag = bool(value)
        elif field == 3:
            number = value - (1 << 64) if value >> 63 else value
        elif field == 4:
            real = struct.unpack("<d", value)[0]
        else:
            held = (field, value)
    columns[prefix + "text"].append(text)
    columns[prefix + "flag"].append(flag)
    columns[prefix + "number"].append(number)
    columns[prefix + "real"].append(real)
    return held


def _add_pair(columns: _Columns, data: bytes) -> None:
    key, raw = b"", b""
    for field, value, _, _ in _fields(data):
        if field == 1:
            key = value
        elif field == 2:
            raw = value
    columns["key"].append(key.decode())
    held = _add_scalar(columns, "v_", raw)
    columns["is_list"].append(held is not None and held[0] == 5)
    columns["is_pairs"].append(held is not None and held[0] == 6)
    deep = held is not None and held[0] not in (5, 6)
    if held is not None and not deep:
        for field, item, _, _ in _fields(held[1]):
            if field == 1 and held[0] == 5:
                deep |= _add_scalar(columns, "i_", item) is not None
            elif field == 1:
                inner = {number: value for number, value, _, _ in _fields(item)}
                columns["p_key"].append(inner.get(1, b"").decode())
                below = _add_scalar(columns, "p_", inner.get(2, b"")) is not None
                columns["p_raw"].append(inner[2] if below else None)
                deep |= below
            else:
                deep = True
    columns["raw"].append(raw if deep else None)
    columns["list_end"].append(len(columns["i_text"]))
    columns["pairs_end"].append(len(columns["p_key"]))


def _add_point(columns: _Columns, kind: str, data: bytes) -> None:
    attributes = KINDS[kind][1]
    has_totals = kind in ("histogram", "exponential_histogram", "summary")
    count, total, rest = (0 if has_totals else None), None, []
    for field, value, start, end in _fields(data):
        if field == attributes:
            _add_pair(columns, value)
            continue
        rest.append(data[start:end])
        if has_totals and field == 4:
            count = struct.unpack("<q", value)[0]
        elif has_totals and field == 5:
            total = struct.unpack("<d", value)[0]
    columns["attributes_end"].append(len(columns["key"]))
    columns["count"].append(count)
    columns["sum"].append(total)
    columns["point_rest"].append(b"".join(rest))


def _add_metric(columns: _Columns, data: bytes) -> None:
    name = unit = ""
    kind, data_rest, rest = None, b"", []
    for field, value, start, end in _fields(data):
        if field == 1:
            name = value.decode()
        elif field == 3:
            unit = value.decode()
        elif field in KIND_OF:
            kind, kept = KIND_OF[field], []
            for inner, point, low, high in _fields(value):
                if inner == 1:
                    _add_point(columns, kind, point)
                else:
                    kept.append(value[low:high])
            data_rest = b"".join(kept)
        else:
            rest.append(data[start:end])
    columns["points_end"].append(len(columns["count"]))
    columns["name"].append(name)
    columns["unit"].append(unit)
    columns["kind"].append(kind)
    columns["data_rest"].append(data_rest)
    columns["metric_rest"].append(b"".join(rest))


def _add_scope(columns: _Columns, data: bytes) -> None:
    rest = []
    for field, value, start, end in _fields(data):
        if field == 2:
            _add_metric(columns, value)
        else:
            rest.append(data[start:end])
    columns["metrics_end"].append(len(columns["name"]))
    columns["scope_rest"].append(b"".join(rest))


def _add_resource(columns: _Columns, data: bytes) -> None:
    rest = []
    for field, value, start, end in _fields(data):
        if field == 2:
            _add_scope(columns, value)
        else:
            rest.append(data[start:end])
    columns["scopes_end"].append(len(columns["scope_rest"]))
    columns["resource_rest"].append(b"".join(rest))


SCALARS = [f"{prefix}{kind}" for prefix in ("v_", "i_", "p_") for kind in ("text", "flag", "number", "real")]


def _decode_singly(messages: pa.Array) -> pa.Array:
    """One message after the other: slow, and the rule for all that is unusual."""
    columns = _Columns(
        *SCALARS, "key", "is_list", "is_pairs", "raw", "p_key", "p_raw", "list_end", "pairs_end",
        "attributes_end", "count", "sum", "point_rest",
        "points_end", "name", "unit", "kind", "data_rest", "metric_rest",
        "metrics_end", "scope_rest", "scopes_end", "resource_rest",
    )
    ends, good = [], []
    for message in _values(messages):
        mark = columns.mark()
        try:
            for field, value, _, _ in _fields(message) if message is not None else []:
                if field == 1:
                    _add_resource(columns, value)
            good.append(message is not None)
        except (ValueError, struct.error, AttributeError, TypeError):
            # A field of the wrong wire type has a value of the wrong Python type.
            columns.undo(mark)
            good.append(False)
        ends.append(len(columns["resource_rest"]))

    def lists(name_or_ends, items: pa.Array, kind: pa.DataType, mask: pa.Array | None = None) -> pa.Array:
        stops = columns[name_or_ends] if isinstance(name_or_ends, str) else name_or_ends
        return pa.ListArray.from_arrays(pa.array([0, *stops], pa.int32()), items, type=kind, mask=mask)

    def structs(kind: pa.DataType, arrays: list, mask: pa.Array | None = None) -> pa.Array:
        typed = [a if isinstance(a, pa.Array) else pa.array(a, f.type) for a, f in zip(arrays, kind)]
        return pa.StructArray.from_arrays(typed, fields=list(kind), mask=mask)

    def scalars(prefix: str) -> list:
        return [columns[prefix + kind] for kind in ("text", "flag", "number", "real")]

    def absent(name: str) -> pa.Array:
        return pa.array([not found for found in columns[name]], pa.bool_())

    held, pairs = VALUE.field("arrayValue").type, VALUE.field("kvlistValue").type
    pair = pairs.field("values").type.value_type
    items = lists("list_end", structs(SCALAR, scalars("i_")), held.field("values").type)
    inner = structs(pair, [columns["p_key"], structs(HELD, [*scalars("p_"), columns["p_raw"]])])
    inner = lists("pairs_end", inner, pairs.field("values").type)
    value = structs(VALUE, [
        *scalars("v_"), structs(held, [items], absent("is_list")), structs(pairs, [inner], absent("is_pairs")),
        columns["raw"],
    ])
    attributes = lists("attributes_end", structs(ATTRIBUTES.value_type, [columns["key"], value]), ATTRIBUTES)
    points = structs(POINT, [attributes, columns["count"], columns["sum"], columns["point_rest"]])
    points = lists("points_end", points, METRIC.field("data_points").type)
    metrics = structs(METRIC, [
        columns["name"], columns["unit"], columns["kind"], points, columns["data_rest"], columns["metric_rest"],
    ])
    scopes = structs(SCOPE, [lists("metrics_end", metrics, SCOPE.field("metrics").type), columns["scope_rest"]])
    resources = structs(RESOURCE, [
        lists("scopes_end", scopes, RESOURCE.field("scope_metrics").type), columns["resource_rest"],
    ])
    return lists(ends, resources, RESOURCES, pa.array([not ok for ok in good], pa.bool_()))


# The messages of a batch are read together, level by level: all first fields at once, then all
# second ones. What is unusual (broken, of another wire type than expected, repeated where one is
# meant) makes its message ``odd``, and that is left to ``_decode_singly``.

#: Past this many fields, fewer messages than ``FEW`` on a level are no longer worth whole columns.
MANY, FEW = 1000, 4


def _varints(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Numbers, and where they end; one without end has a place beyond the data."""
    byte = data[at]
    value, after = (byte & 0x7F).astype(np.uint64), at + 1
    left = np.flatnonzero(byte & 0x80)
    for turn in range(1, 10):
        if not len(left):
            return value, after
        byte = data[at[left] + turn]
        value[left] |= (byte & 0x7F).astype(np.uint64) << np.uint64(7 * turn)
        after[left] += 1
        left = left[(byte & 0x80) != 0]
    after[left] = len(data)
    return value, after


class _Level:
    """All fields of the messages ``low`` to ``high`` of ``data``, message by message."""

    def __init__(self, data: np.ndarray, low: np.ndarray, high: np.ndarray, root: np.ndarray, odd: np.ndarray):
        self.data, self.size, self.odd = data, len(low), odd
        owners = np.flatnonzero(low < high)
        at, rows, turn = low[owners], [], 0
        while len(owners):
            if turn > MANY and len(owners) < FEW:
                odd[root[owners]] = True
                break
            turn, stop = turn + 1, high[owners]
            tag, begin = _varints(data, at)
            wire = (tag & np.uint64(7)).astype(np.int64)
            # A broken tag may end anywhere.
            value, after = _varints(data, np.minimum(begin, len(data) - 16))
            size = np.where(wire == 2, np.minimum(value, np.uint64(len(data))).astype(np.int64), np.where(wire == 1, 8, 4))
            begin = np.where(wire == 2, after, begin)
            end = np.where(wire == 0, after, begin + size)
            good = (end <= stop) & np.isin(wire, (0, 1, 2, 5))
            odd[root[owners[~good]]] = True
            number = np.minimum(tag >> np.uint64(3), np.uint64(1 << 40)).astype(np.int64)
            rows.append([x[good] for x in (owners, number, wire, value, at, begin, end)])
            more = good & (end < stop)
            owners, at = owners[more], end[more]
        if rows:
            columns = [np.concatenate(x) for x in zip(*rows)]
            order = np.argsort(columns[0], kind="stable")
            columns = [x[order] for x in columns]
        else:
            columns = [np.zeros(0, np.uint64 if i == 3 else np.int64) for i in range(7)]
        self.owner, self.number, self.wire, self.value, self.first, self.low, self.high = columns
        self.root = root[self.owner]

    def held(self, found: np.ndarray, wire: int = 2) -> np.ndarray:
        """Rows of the fields ``found``, which should have this wire type."""
        self.odd[self.root[found & (self.wire != wire)]] = True
        return np.flatnonzero(found & (self.wire == wire))

    def below(self, rows: np.ndarray) -> _Level:
        return _Level(self.data, self.low[rows], self.high[rows], self.root[rows], self.odd)

    def ends(self, rows: np.ndarray) -> pa.Array:
        """Offsets of lists of these rows by message."""
        counts = np.bincount(self.owner[rows], minlength=self.size)
        return pa.array(np.concatenate([[0], np.cumsum(counts)]), pa.int32())

    def last(self, rows: np.ndarray) -> np.ndarray:
        """The last of these rows of each message, or -1."""
        out = np.full(self.size, -1)
        out[self.owner[rows]] = rows
        return out

    def spans(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where the values of these rows lie; nowhere for -1."""
        low, high = np.zeros(len(at), np.int64), np.zeros(len(at), np.int64)
        low[at >= 0], high[at >= 0] = self.low[at[at >= 0]], self.high[at[at >= 0]]
        return low, high

    def rest(self, found: np.ndarray) -> pa.Array:
        """The fields ``found`` of each message, joined."""
        sizes = np.bincount(self.owner[found], weights=self.high[found] - self.first[found], minlength=self.size)
        return _bytes(self.data, self.first[found], self.high[found], sizes)


def _bytes(data: np.ndarray, low: np.ndarray, high: np.ndarray, sizes: np.ndarray | None = None) -> pa.Array:
    """These parts of ``data``, one after the other, as cells of their own or of ``sizes``."""
    lengths = high - low
    before = np.cumsum(lengths) - lengths
    held = data[np.repeat(low - before, lengths) + np.arange(lengths.sum())]
    offsets = np.concatenate([[0], np.cumsum(lengths if sizes is None else sizes)]).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(offsets) - 1, [None, pa.py_buffer(offsets), pa.py_buffer(held)])


def _where(there: np.ndarray, values: pa.Array) -> pa.Array:
    return pc.if_else(pa.array(there), values, pa.scalar(None, values.type))


def _wide(level: _Level, at: np.ndarray, kind: str) -> np.ndarray:
    """Numbers of eight bytes."""
    low, _ = level.spans(at)
    return level.data[low[:, None] + np.arange(8)].view(kind)[:, 0]


def _scalar_columns(level: _Level) -> tuple[list[pa.Array], np.ndarray]:
    """Scalars of values, one field each at most, and the rows of those that are no scalar."""
    repeated = np.flatnonzero(level.owner[1:] == level.owner[:-1])
    level.odd[level.root[repeated]] = True
    text, flag, number, real = [
        level.last(level.held(level.number == n, wire)) for n, wire in ((1, 2), (2, 0), (3, 0), (4, 1))]
    values = np.append(level.value, np.uint64(0))
    columns = [
        _where(text >= 0, _bytes(level.data, *level.spans(text)).cast(pa.string())),
        _where(flag >= 0, pa.array(values[flag] != 0)),
        _where(number >= 0, pa.array(values[number].view(np.int64))),
        _where(real >= 0, pa.array(_wide(level, real, "<f8"))),
    ]
    return columns, level.last(np.flatnonzero((level.number < 1) | (level.number > 4)))


def _decode_together(data: np.ndarray, low: np.ndarray, high: np.ndarray, odd: np.ndarray) -> pa.Array:
    def lists(ends: pa.Array, items: pa.Array, kind: pa.DataType) -> pa.Array:
        return pa.ListArray.from_arrays(ends, items, type=kind)

    def structs(kind: pa.DataType, arrays: list, there: np.ndarray | None = None) -> pa.Array:
        return pa.StructArray.from_arrays(arrays, fields=list(kind), mask=None if there is None else pa.array(~there))

    request = _Level(data, low, high, np.arange(len(low)), odd)
    resource_rows = request.held(request.number == 1)
    resource = request.below(resource_rows)
    scope_rows = resource.held(resource.number == 2)
    scope = resource.below(scope_rows)
    metric_rows = scope.held(scope.number == 2)
    metric = scope.below(metric_rows)
    with_data = np.isin(metric.number, list(KIND_OF))
    data_rows = metric.held(with_data)
    odd[metric.root[data_rows][1:][metric.owner[data_rows][1:] == metric.owner[data_rows][:-1]]] = True
    body = metric.below(data_rows)
    point_rows = body.held(body.number == 1)
    point = body.below(point_rows)
    # By point: the field of its kind.
    field = metric.number[data_rows][body.owner[point_rows]]
    attribute = np.where(field == 9, 9, np.where(field == 10, 1, 7))
    totals = np.isin(field, (9, 10, 11))
    is_pair = point.number == attribute[point.owner]
    pair_rows = point.held(is_pair)
    pair = point.below(pair_rows)
    key = pair.last(pair.held(pair.number == 1))
    raw = pair.spans(pair.last(pair.held(pair.number == 2)))
    roots = point.root[pair_rows]
    value = _Level(data, *raw, roots, odd)
    scalars, other = _scalar_columns(value)
    numbers = np.append(value.number, 0)[other]
    is_list, is_pairs = numbers == 5, numbers == 6
    inside = np.flatnonzero(is_list | is_pairs)
    value.held(np.isin(value.number, (5, 6)))
    deep = (other >= 0) & ~is_list & ~is_pairs
    held = _Level(data, *value.spans(other[inside]), roots[inside], odd)
    listed = is_list[inside][held.owner]
    deep[inside[held.owner[held.number != 1]]] = True
    item_rows, inner_rows = held.held((held.number == 1) & listed), held.held((held.number == 1) & ~listed)
    item = held.below(item_rows)
    items, nested = _scalar_columns(item)
    deep[inside[held.owner[item_rows[nested >= 0]]]] = True
    inner = held.below(inner_rows)
    inner_key = inner.last(inner.held(inner.number == 1))
    inner_raw = inner.spans(inner.last(inner.held(inner.number == 2)))
    inner_scalars, nested = _scalar_columns(_Level(data, *inner_raw, held.root[inner_rows], odd))
    deep[inside[held.owner[inner_rows[nested >= 0]]]] = True

    def by_pair(rows: np.ndarray) -> pa.Array:
        counts = np.bincount(inside[held.owner[rows]], minlength=len(pair_rows))
        return pa.array(np.concatenate([[0], np.cumsum(counts)]), pa.int32())

    def text(level: _Level, at: np.ndarray) -> pa.Array:
        return _bytes(data, *level.spans(at)).cast(pa.string())

    array, pairs = VALUE.field("arrayValue").type, VALUE.field("kvlistValue").type
    inner_pairs = structs(pairs.field("values").type.value_type, [
        text(inner, inner_key), structs(HELD, [*inner_scalars, _where(nested >= 0, _bytes(data, *inner_raw))])])
    values = structs(VALUE, [
        *scalars,
        structs(array, [lists(by_pair(item_rows), structs(SCALAR, items), array.field("values").type)], is_list),
        structs(pairs, [lists(by_pair(inner_rows), inner_pairs, pairs.field("values").type)], is_pairs),
        _where(deep, _bytes(data, *raw)),
    ])
    attributes = lists(point.ends(pair_rows), structs(ATTRIBUTES.value_type, [text(pair, key), values]), ATTRIBUTES)
    has_totals = totals[point.owner]
    count = point.last(point.held(has_totals & ~is_pair & (point.number == 4), 1))
    total = point.last(point.held(has_totals & ~is_pair & (point.number == 5), 1))
    points = structs(POINT, [
        attributes, _where(totals, pa.array(np.where(count >= 0, _wide(point, count, "<i8"), 0))),
        _where(total >= 0, pa.array(_wide(point, total, "<f8"))), point.rest(~is_pair),
    ])
    points = lists(body.ends(point_rows), points, METRIC.field("data_points").type)
    # By metric: its data, if there is any; the last place of the lists stands for none.
    at = np.full(metric.size, -1)
    at[metric.owner[data_rows]] = np.arange(len(data_rows))
    there = at >= 0
    empty = pa.array([[]], points.type)
    points = pa.concat_arrays([points, empty]).take(pa.array(np.where(there, at, len(points))))
    data_rest = pa.concat_arrays([body.rest(body.number != 1), pa.array([b""], pa.binary())])
    data_rest = data_rest.take(pa.array(np.where(there, at, len(data_rest) - 1)))
    kinds = np.append(metric.number[data_rows], 0)[at]
    names = pa.array([KIND_OF.get(n) for n in range(12)], pa.string())
    known = np.isin(metric.number, (1, 3)) | with_data
    metrics = structs(METRIC, [
        text(metric, metric.last(metric.held(metric.number == 1))),
        text(metric, metric.last(metric.held(metric.number == 3))),
        names.take(pa.array(np.where(there, kinds, 0))), points, data_rest, metric.rest(~known),
    ])
    scopes = structs(SCOPE, [
        lists(scope.ends(metric_rows), metrics, SCOPE.field("metrics").type), scope.rest(scope.number != 2)])
    resources = structs(RESOURCE, [
        lists(resource.ends(scope_rows), scopes, RESOURCE.field("scope_metrics").type), resource.rest(resource.number != 2)])
    return lists(request.ends(resource_rows), resources, RESOURCES)


def _decode(messages: pa.Array) -> pa.Array:
    messages = messages.cast(pa.binary())
    if not len(messages):
        return pa.array([], RESOURCES)
    offsets = np.frombuffer(messages.buffers()[1], np.int32)[messages.offset : messages.offset + len(messages) + 1]
    low, high = offsets[:-1].astype(np.int64), offsets[1:].astype(np.int64)
    held = messages.buffers()[2]
    data = np.concatenate([np.frombuffer(held, np.uint8) if held else np.zeros(0, np.uint8), np.zeros(32, np.uint8)])
    there = messages.is_valid().to_numpy(zero_copy_only=False)
    odd = ~there
    try:
        while True:
            # Odd messages count as empty; once more without those that were found on the way.
            before, high = odd.copy(), np.where(odd, low, high)
            decoded = _decode_together(data, low, high, odd)
            if (odd == before).all():
                break
    except pa.ArrowInvalid:
        # Bad text in some message.
        return _decode_singly(messages)
    if not odd.any():
        return decoded
    rows = np.arange(len(messages))
    rows[odd] = len(messages) + np.arange(odd.sum())
    return pa.concat_arrays([decoded, _decode_singly(messages.filter(pa.array(odd)))]).take(pa.array(rows))


def _values(array: pa.Array) -> list:
    """Python values of a flat array; the detour over numpy is much faster than by item."""
    if array.null_count == len(array):
        return [None] * len(array)
    if array.null_count and not (pa.types.is_string(array.type) or pa.types.is_binary(array.type)):
        return array.to_pylist()
    return array.to_numpy(zero_copy_only=False).tolist()


def _children(array: pa.StructArray) -> dict[str, pa.Array]:
    # Spark sends an empty list without any offset, and Arrow reads the first one all the same.
    parts = zip(array.type, array.flatten())
    return {field.name: child if len(child) else pa.array([], child.type) for field, child in parts}


# Encoding on Arrow arrays: the cells of a level are joined as a whole, from the innermost one outwards.


def _cells(data: np.ndarray, sizes: np.ndarray) -> pa.Array:
    """Bytes that lie one after the other, as cells of these sizes."""
    offsets = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
    held = pa.py_buffer(np.ascontiguousarray(data, np.uint8))
    return pa.Array.from_buffers(pa.binary(), len(sizes), [None, pa.py_buffer(offsets), held])


def _varint_cells(numbers: np.ndarray) -> pa.Array:
    """``varint`` of each number (unsigned)."""
    most = int(numbers.max(initial=0))
    groups = numbers[:, None] >> np.arange(0, max(most.bit_length(), 1), 7, dtype=np.uint64)
    there = groups != 0
    there[:, 0] = True
    more = np.zeros_like(there)
    more[:, :-1] = there[:, 1:]
    data = (groups & np.uint64(0x7F)).astype(np.uint8) | (more * np.uint8(0x80))
    return _cells(data[there], there.sum(axis=1))


def _glued(*parts: pa.Array | bytes) -> pa.Array:
    return pc.binary_join_element_wise(*parts, b"")


def _blocks(tag: pa.Array | bytes, data: pa.Array) -> pa.Array:
    """A length-prefixed field for each cell; NULL for NULL."""
    sizes = np.asarray(pc.fill_null(pc.binary_length(data), 0)).astype(np.uint64)
    return _glued(tag, _varint_cells(sizes), data)


def _there(data: pa.Array) -> pa.Array:
    """Bytes of texts or bytes, none for NULL."""
    return pc.fill_null(data.cast(pa.binary()), b"")


def _counts(lists: pa.ListArray) -> np.ndarray:
    return np.asarray(pc.fill_null(pc.list_value_length(lists), 0))


def _joined(lists: pa.ListArray, items: pa.Array) -> pa.Array:
    """The bytes of each list, none for NULL; ``items`` belong to the values of all lists."""
    ends = np.concatenate([[0], np.cumsum(_counts(lists))]).astype(np.int32)
    return pc.binary_join(pa.ListArray.from_arrays(pa.array(ends), items), pa.scalar(b"", pa.binary()))


def _encode_scalars(parts: dict[str, pa.Array]) -> pa.Array:
    text, flag, number, real = (parts[name] for name in ("stringValue", "boolValue", "intValue", "doubleValue"))
    found = []
    if text.null_count < len(text):
        found.append(_blocks(b"\x0a", text.cast(pa.binary())))
    if flag.null_count < len(flag):
        found.append(pc.if_else(flag, pa.scalar(b"\x10\x01", pa.binary()), pa.scalar(b"\x10\x00", pa.binary())))
    if number.null_count < len(number):
        bits = np.asarray(pc.fill_null(number, 0)).view(np.uint64)
        found.append(_where(np.asarray(number.is_valid()), _glued(b"\x18", _varint_cells(bits))))
    if real.null_count < len(real):
        data = np.full((len(real), 9), 0x21, np.uint8)
        data[:, 1:] = np.asarray(pc.fill_null(real, 0.0)).astype("<f8").view(np.uint8).reshape(-1, 8)
        found.append(_where(np.asarray(real.is_valid()), _cells(data.reshape(-1), np.full(len(real), 9))))
    return pc.coalesce(*found, pa.scalar(b"", pa.binary())) if found else _cells(np.zeros(0), np.zeros(len(text), int))


def _encode_values(array: pa.StructArray) -> pa.Array:
    parts = _children(array)
    out = _encode_scalars(parts)
    for tag, name in ((b"\x2a", "arrayValue"), (b"\x32", "kvlistValue")):
        held = parts.get(name)
        if held is None or held.null_count == len(held):
            continue
        lists = held.flatten()[0]
        inner = _encode_values(lists.flatten()) if name == "arrayValue" else _encode_pairs(lists.flatten())
        out = pc.if_else(held.is_valid(), _blocks(tag, _joined(lists, _blocks(b"\x0a", inner))), out)
    return pc.coalesce(parts["raw"].cast(pa.binary()), out) if "raw" in parts else out


def _encode_pairs(array: pa.StructArray) -> pa.Array:
    parts = _children(array)
    return _glued(_blocks(b"\x0a", _there(parts["key"])), _blocks(b"\x12", _encode_values(parts["value"])))


def _tags(fields: list[int], at: np.ndarray) -> pa.Array:
    return pa.array([bytes([field << 3 | 2]) for field in fields], pa.binary()).take(pa.array(at))


def _encode_metrics(array: pa.StructArray) -> pa.Array:
    parts = _children(array)
    kinds, points = parts["kind"], parts["data_points"]
    at = np.asarray(pc.fill_null(pc.index_in(kinds, pa.array(list(KINDS), kinds.type)), -1))
    unknown = (at < 0) & np.asarray(kinds.is_valid())
    if unknown.any():
        raise ValueError(f"unknown kind of metric: {kinds[int(unknown.argmax())]}")
    point = _children(points.flatten())
    pairs = point["attributes"]
    of_pair = np.repeat(np.repeat(at, _counts(points)), _counts(pairs))
    # What has no kind has no field for its data either.
    blocks = _blocks(_tags([f for _, f in KINDS.values()], np.maximum(of_pair, 0)), _encode_pairs(pairs.flatten()))
    held = _glued(_there(point["rest"]), _joined(pairs, blocks))
    body = _glued(_joined(points, _blocks(b"\x0a", held)), _there(parts["data_rest"]))
    data = _blocks(_tags([f for f, _ in KINDS.values()], np.maximum(at, 0)), body)
    unit = _there(parts["unit"])
    none = pa.scalar(b"", pa.binary())
    return _glued(
        _blocks(b"\x0a", _there(parts["name"])),
        pc.if_else(pc.greater(pc.binary_length(unit), 0), _blocks(b"\x1a", unit), none),
        pc.if_else(pa.array(at >= 0), data, none), _there(parts["rest"]))


def _encode(resources: pa.ListArray) -> pa.Array:
    if not len(resources):
        return pa.array([], pa.binary())
    resource = _children(resources.flatten())
    scope = _children(resource["scope_metrics"].flatten())
    metrics = _blocks(b"\x12", _encode_metrics(scope["metrics"].flatten()))
    scopes = _blocks(b"\x12", _glued(_joined(scope["metrics"], metrics), _there(scope["rest"])))
    items = _blocks(b"\x0a", _glued(_joined(resource["scope_metrics"], scopes), _there(resource["rest"])))
    return _where(np.asarray(resources.is_valid()), _joined(resources, items))


# A point as ``explode_points`` gives it; positions and what belongs to a level come first, so rows sort by them.
FLAT = pa.schema([
    ("rm_idx", pa.int32()), ("rm_rest", pa.binary()), ("sm_idx", pa.int32()), ("sm_rest", pa.binary()),
    ("m_idx", pa.int32()), ("name", pa.string()), ("metric_unit", pa.string()), ("kind", pa.string()),
    ("data_rest", pa.binary()), ("m_rest", pa.binary()), ("dp_idx", pa.int32()),
    ("attributes", ATTRIBUTES), ("count", pa.int64()), ("sum", pa.float64()), ("dp_rest", pa.binary())])


def _changes(column: pa.Array) -> np.ndarray:
    """Whether a cell is another one than that before it, for all but the first."""
    there, (now, before) = np.asarray(column.is_valid()), (column[1:], column[:-1])
    return (there[1:] != there[:-1]) | np.asarray(pc.fill_null(pc.not_equal(now, before), False))


def _regroup(messages: pa.ListArray) -> pa.Array:
    """Lists of sorted points (``FLAT``) → the resources of each message."""
    if not len(messages):
        return pa.array([], RESOURCES)
    rows, counts = messages.flatten(), _counts(messages)
    flat, size = _children(rows), len(rows)
    # By level: whether a row begins an item of it, and which one that is.
    begins, owner = np.ones(size, bool), np.repeat(np.arange(len(messages)), counts)
    begins[1:] = owner[1:] != owner[:-1]
    levels = []
    for index, held in (
        ("rm_idx", ["rm_rest"]), ("sm_idx", ["sm_rest"]),
        ("m_idx", ["name", "metric_unit", "kind", "data_rest", "m_rest"]), ("dp_idx", [])):
        there = np.asarray(flat[index].is_valid())
        if index == "dp_idx":
            begins = np.ones(size, bool)
        else:
            for name in (index, *held):
                begins[1:] |= _changes(flat[name])
        levels.append((np.flatnonzero(begins & there), owner))
        owner, begins = np.cumsum(begins & there) - 1, begins.copy()

    def structs(of: pa.DataType, at: np.ndarray, held: dict[str, pa.Array], **columns: str) -> pa.Array:
        arrays = held | {name: flat[column].take(pa.array(at)) for name, column in columns.items()}
        return pa.StructArray.from_arrays([arrays[f.name].cast(f.type) for f in of], fields=list(of))

    def lists(level: int, above: int, items: pa.Array) -> pa.Array:
        at, of = levels[level]
        ends = np.concatenate([[0], np.cumsum(np.bincount(of[at], minlength=above))]).astype(np.int32)
        return pa.ListArray.from_arrays(pa.array(ends), items)

    resource, scope, metric, point = (at for at, _ in levels)
    points = structs(POINT, point, {}, attributes="attributes", count="count", sum="sum", rest="dp_rest")
    metrics = structs(
        METRIC, metric, {"data_points": lists(3, len(metric), points)}, name="name", unit="metric_unit", kind="kind",
        data_rest="data_rest", rest="m_rest")
    scopes = structs(SCOPE, scope, {"metrics": lists(2, len(scope), metrics)}, rest="sm_rest")
    resources = structs(RESOURCE, resource, {"scope_metrics": lists(1, len(resource), scopes)}, rest="rm_rest")
    return lists(0, len(messages), resources).cast(RESOURCES)


def regroup_together(rows: Column) -> Column:
    """Sorted points of a message, in a list, → ``array<resource>``."""

    @F.arrow_udf(from_arrow_type(RESOURCES))
    def regroup(messages: pa.Array) -> pa.Array:
        return _regroup(messages)

    return regroup(rows)


def encode_together(resources: Column) -> Column:
    """``encode_request`` on Arrow arrays. Fast where Arrow batches are bounded by rows: while they are
    bounded by bytes, Spark sizes some forty vectors anew for every row."""

    @F.arrow_udf(T.BinaryType())
    def encode(messages: pa.Array) -> pa.Array:
        return _encode(messages)

    return encode(resources)


def decode_request(message: Column) -> Column:
    """Wire bytes of a metrics message → ``array<resource>``; NULL if malformed."""

    @F.arrow_udf(from_arrow_type(RESOURCES))
    def decode(messages: pa.Array) -> pa.Array:
        return _decode(messages)

    return decode(message)


# Encoding as columns. Nested rows cross to Python slowly: to bound a batch by bytes, every row
# makes Spark size each of its some forty Arrow vectors anew. Bytes are put together as strings, which
# arrays can join: a cast between both looks at nothing and changes nothing, whatever the bytes are.


def _wire(data: Column) -> Column:
    """Bytes as a string of the same bytes."""
    return data.cast("string")


def _literal(data: bytes) -> Column:
    return F.lit(data).cast("string")


def _wire_hex(digits: Column) -> Column:
    return _wire(F.unhex(digits))


def _wire_varint(number: Column) -> Column:
    """Of a BIGINT taken as unsigned."""

    def byte(value: Column) -> Column:
        return F.lpad(F.hex(value), 2, "0")

    # Seven bits each, the lowest first; the last one has no flag.
    def group(at: int, more: bool) -> Column:
        bits = F.shiftrightunsigned(number, 7 * at).bitwiseAND(F.lit(127).cast("bigint"))
        return byte(bits.bitwiseOR(F.lit(128).cast("bigint")) if more else bits)

    def longer(at: int) -> Column:
        if at == 9:
            return group(at, False)
        rest = F.shiftrightunsigned(number, 7 * (at + 1)) == 0
        return F.when(rest, group(at, False)).otherwise(F.concat(group(at, True), longer(at + 1)))

    return _wire_hex(longer(0))


def _wire_size(size: Column) -> Column:
    """``_wire_varint`` of a number of bytes, in fewer steps: it is wanted everywhere."""

    def longer(at: int) -> Column:
        # Below 128 a size is one byte, and the character of that number.
        last = F.char(F.shiftright(size, 7 * at) if at else size)
        if at == 4:
            return last
        low = F.shiftright(size, 7 * at).bitwiseAND(F.lit(127)).bitwiseOR(F.lit(128))
        return F.when(size < 1 << 7 * (at + 1), last).otherwise(F.concat(_wire_hex(F.hex(low)), longer(at + 1)))

    return longer(0)


def _wire_field(number: int | Column, data: Column) -> Column:
    """A length-prefixed field of a number, or with a tag; ``data`` should be a plain column,
    as it is named twice."""
    tag = _literal(bytes([number << 3 | 2])) if isinstance(number, int) else number
    return F.concat(tag, _wire_size(F.octet_length(data)), data)


def _wire_fields(number: int | Column, items: Column) -> Column:
    return F.array_join(F.transform(items, lambda held: _wire_field(number, held)), "")


def _bound(value: Column, use) -> Column:
    """``use(value)`` with the value worked out once."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _wire_text(text: Column) -> Column:
    return F.concat(_wire_size(F.octet_length(text)), text)


def _wire_scalar(value: Column) -> Column:
    bits = F.call_function("java_method", F.lit("java.lang.Double"), F.lit("doubleToRawLongBits"), value["doubleValue"])
    real = F.lpad(F.hex(bits.cast("bigint")), 16, "0")
    turned = _wire_hex(F.concat(*[F.substring(real, at, 2) for at in range(15, 0, -2)]))
    return (
        F.when(value["stringValue"].isNotNull(), F.concat(_literal(b"\x0a"), _wire_text(value["stringValue"])))
        .when(value["boolValue"].isNotNull(), F.when(value["boolValue"], _literal(b"\x10\x01")).otherwise(_literal(b"\x10\x00")))
        .when(value["intValue"].isNotNull(), F.concat(_literal(b"\x18"), _wire_varint(value["intValue"])))
        .when(value["doubleValue"].isNotNull(), F.concat(_literal(b"\x21"), turned))
        .otherwise("")
    )


def _wire_held(value: Column) -> Column:
    return F.when(value["raw"].isNotNull(), _wire(value["raw"])).otherwise(_wire_scalar(value))


def _wire_value(value: Column) -> Column:
    pairs, items = value["kvlistValue"], value["arrayValue"]
    listed = _wire_fields(1, F.transform(items["values"], _wire_scalar))
    paired = _wire_fields(1, _wire_pairs(pairs["values"], _wire_held))
    return (
        F.when(value["raw"].isNotNull(), _wire(value["raw"]))
        .when(pairs.isNotNull(), _bound(F.coalesce(paired, F.lit("")), lambda held: _wire_field(6, held)))
        .when(items.isNotNull(), _bound(F.coalesce(listed, F.lit("")), lambda held: _wire_field(5, held)))
        .otherwise(_wire_scalar(value))
    )


def _wire_pairs(pairs: Column, value) -> Column:
    key = lambda pair: F.concat(_literal(b"\x0a"), _wire_text(F.coalesce(pair["key"], F.lit(""))))
    parts = F.transform(pairs, lambda pair: F.struct(key(pair).alias("key"), value(pair["value"]).alias("value")))
    return F.transform(parts, lambda part: F.concat(part["key"], _wire_field(2, part["value"])))


def _wire_metric(metric: Column) -> Column:
    def rest(value: Column) -> Column:
        return F.coalesce(_wire(value), F.lit(""))

    def tag(which: int) -> Column:
        chosen = _literal(b"\x3a")
        for name, fields in KINDS.items():
            chosen = F.when(kind == name, _literal(bytes([fields[which] << 3 | 2]))).otherwise(chosen)
        return chosen

    kind, none = metric["kind"], F.lit("")
    points = _bound(tag(1), lambda pair: F.transform(metric["data_points"], lambda point: F.concat(
        rest(point["rest"]), F.coalesce(_wire_fields(pair, _wire_pairs(point["attributes"], _wire_value)), none))))
    whole = F.concat(F.coalesce(_wire_fields(1, points), none), rest(metric["data_rest"]))
    known = _bound(whole, lambda held: _wire_field(tag(0), held))
    unknown = F.raise_error(F.concat(F.lit("unknown kind of metric: "), kind)).cast("string")
    unit = F.when(metric["unit"] != "", F.concat(_literal(b"\x1a"), _wire_text(metric["unit"])))
    return F.concat(
        _literal(b"\x0a"), _wire_text(F.coalesce(metric["name"], F.lit(""))), F.coalesce(unit, F.lit("")),
        F.when(kind.isNull(), "").when(kind.isin(*KINDS), known).otherwise(unknown), rest(metric["rest"]))


def encode_request(resources: Column) -> Column:
    """``array<resource>`` → wire bytes."""
    none = F.lit("")

    def scope(held: Column) -> Column:
        metrics = _wire_fields(2, F.transform(held["metrics"], _wire_metric))
        return F.concat(F.coalesce(metrics, none), F.coalesce(_wire(held["rest"]), none))

    def resource(held: Column) -> Column:
        scopes = _wire_fields(2, F.transform(held["scope_metrics"], scope))
        return F.concat(F.coalesce(scopes, none), F.coalesce(_wire(held["rest"]), none))

    return _wire_fields(1, F.transform(resources, resource)).cast("binary")


def split_delimited(data: Column) -> Column:
    """Length-prefixed messages of a record; NULL if a prefix is bad or data is short."""

    @F.arrow_udf(T.ArrayType(T.BinaryType()))
    def split(records: pa.Array) -> pa.Array:
        def one(record: bytes | None):
            if record is None:
                return None
            found, at = [], 0
            try:
                while at < len(record):
                    size, at = read_varint(record, at)
                    if size > len(record) - at:
                        return None
                    found.append(record[at : at + size])
                    at += size
            except ValueError:
                return None
            return found

        return pa.array([one(r) for r in _values(records)], pa.list_(pa.binary()))

    return split(data)


def join_delimited(messages: Column) -> Column:
    """Inverse of ``split_delimited``."""

    def prefixed(message: Column) -> Column:
        return F.concat(_wire_size(F.octet_length(message)), _wire(message))

    return F.array_join(F.transform(messages, prefixed), "").cast("binary")


def _any_json(value: Any) -> dict:
    if value is None:
        return {"stringValue": "null"}
    if isinstance(value, bool):
        return {"boolValue": value}
    if isinstance(value, str):
        return {"stringValue": value}
    if isinstance(value, int):
        if -(1 << 63) <= value < 1 << 63:
            return {"intValue": str(value)}
        return {"stringValue": str(value)} if 0 <= value < 1 << 64 else {"doubleValue": float(value)}
    if isinstance(value, float):
        return {"doubleValue": value}
    if isinstance(value, list):
        return {"arrayValue": {"values": [_any_json(v) for v in value]}}
    return {"kvlistValue": {"values": [{"key": k, "value": _any_json(v)} for k, v in value.items()]}}


def to_any_value(body: Column) -> Column:
    """JSON text → typed value, as OTLP JSON text.

    Strings and plain small integers are handled by column expressions; only other values
    go through Python.
    """

    def one(text: str) -> str:
        # A body that has no typed form (infinite number, lone surrogate, too deep) is text.
        try:
            value = json.dumps(
                _any_json(json.loads(text)), ensure_ascii=False, separators=(",", ":"), allow_nan=False)
            value.encode()
            return value
        except (ValueError, RecursionError):
            return json.dumps({"stringValue": text}, ensure_ascii=False, separators=(",", ":"))

    @F.arrow_udf(T.StringType())
    def convert(bodies: pa.Array) -> pa.Array:
        return pa.array([None if b is None else one(b) for b in bodies.to_pylist()], pa.string())

    is_text = F.startswith(body, F.lit('"'))
    is_int = body.rlike(r"^(?:0|-?[1-9][0-9]{0,17})$")
    return (
        F.when(is_text, F.concat(F.lit('{"stringValue":'), body, F.lit("}")))
        .when(is_int, F.concat(F.lit('{"intValue":"'), body, F.lit('"}')))
        .otherwise(convert(F.when(~is_text & ~is_int, body)))
    )
