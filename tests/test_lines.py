"""Objects beyond one cell: streams by path, split files, delimited and multi-line records."""

import gzip
import io
import os
import random
import tracemalloc
import zlib

import pytest
import regex
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from logforge.operators.framing import explode_records, frame_lines
from logforge.operators.lines import Scanner, multiline_records, split_region
from logforge.plans.config import LogConfig
from logforge.plans.ship import failed_rows, ship_logs
from logforge.sources.objects import decode_objects, read_lines, read_objects
from logforge.sources.paths import content_of, inflated, read_paths, split_lines


def joined(data, compressed=True, step=7):
    return b"".join(content_of(lambda: io.BytesIO(data), compressed, step))


@settings(max_examples=60, deadline=None)
@given(st.lists(st.binary(max_size=300), min_size=1, max_size=4), st.integers(1, 60))
def test_members_in_steps(members, step):
    packed = b"".join(map(gzip.compress, members))
    parts = list(inflated(lambda: io.BytesIO(packed), step))
    assert b"".join(parts) == b"".join(members)
    assert all(len(p) <= max(step, 300) for p in parts)


@pytest.mark.parametrize("step", [1, 13, 1 << 16])
def test_the_good_part_of_a_broken_object(step):
    text = bytes(random.Random(1).choices(b"abcdefgh \n", k=20_000))
    packed = gzip.compress(b"first member\n") + gzip.compress(text)
    for cut in (len(packed) - 5, len(packed) // 2, 45):
        good = joined(packed[:cut], step=step)
        assert (b"first member\n" + text).startswith(good) and len(good) >= 13
    broken = bytearray(packed)
    broken[len(packed) // 2] ^= 0xFF
    assert joined(bytes(broken), step=step).startswith(b"first member\n")
    with pytest.raises(ValueError):
        joined(b"\x1f\x8b\x08\x00no gzip at all", step=step)
    assert joined(b"\x1f\x8b no gzip", None, step) == b"\x1f\x8b no gzip"
    assert joined(packed, None, step) == b"first member\n" + text
    assert joined(b"", True, step) == b""


@settings(max_examples=200, deadline=None)
@given(st.text("ab\n|", max_size=60), st.integers(1, 9), st.sampled_from(["\n", "||", "a|"]))
def test_lines_as_whole_objects(text, step, separator):
    data = text.encode()
    parts = [data[i : i + step] for i in range(0, len(data), step)]
    want = text.split(separator)
    want = want[1:] if want[0] == "" and len(want) > 1 else want
    assert [x.decode() for ls in split_lines(iter(parts), separator.encode()) for x in ls] == want


def test_a_large_object_needs_little_memory():
    line = b"x" * 99 + b"\n"
    packed = zlib.compressobj(wbits=31)
    data = b"".join(packed.compress(line * 10_000) for _ in range(200)) + packed.flush()
    tracemalloc.start()
    count = sum(len(ls) for ls in split_lines(inflated(lambda: io.BytesIO(data), 1 << 16), b"\n"))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    # 200 MB of text, far more than one Arrow batch may hold.
    assert count == 2_000_001 and peak < 8 << 20


def test_reading_by_path(spark, tmp_path):
    objects = {
        "a.log": b"one\ntwo\n", "b b.gz": gzip.compress(b"three\nfour"), "bad.gz": b"not gzip at all",
        "cut.gz": gzip.compress(os.urandom(50_000).hex().encode())[:30_000], "text": b"fine\n\xff\xfe\nmore", "empty": b""}
    for name, content in objects.items():
        (tmp_path / name).write_bytes(content)
    names = [(i, f"file://{tmp_path}/{name}") for i, name in enumerate([*objects, "missing"])] + [(9, None)]
    paths = spark.createDataFrame(names, "n int, path string").withColumn("log", F.lit("clash"))
    rows = read_paths(paths, tasks=3, step=1000).orderBy("n", "seq").collect()
    got = {}
    for r in rows:
        got.setdefault(r["n"], []).append((r["seq"], r["log"], r["error"]))
    assert got[0] == [(0, "one", None), (1, "two", None), (2, "", None)]
    assert [x[1] for x in got[1]] == ["three", "four"]
    assert got[2][0][2] == "nothing could be decompressed" and got[2][0][1] is None
    assert len(got[3]) == 1 and len(got[3][0][1]) > 10_000
    assert [x[1] for x in got[4]] == ["fine", None, "more"] and got[4][1][2] == "not UTF-8"
    assert got[5] == [(0, "", None)]
    assert "FileNotFound" in got[6][0][2] and got[9][0][2] == "no path"
    shipped = ship_logs(read_paths(paths, tasks=2), LogConfig("S3"))
    assert {r["log"] for r in shipped.filter("n < 2").collect()} == {"one", "two", "three", "four"}
    assert failed_rows(read_paths(paths, tasks=2), LogConfig("S3")).count() == 4


PATTERNS = [r"[.!?]\n+", r"\n(?=\d)", r"\n\n+", r"(?<=;)\n", r"x", r"\r?\n"]


def brute(text, pattern):
    pieces = regex.split(pattern, text)
    first = regex.match(pattern, text)
    return pieces[1:] if first and pieces[0] == "" and len(pieces) > 1 else pieces


@settings(max_examples=300, deadline=None)
@given(st.text("a1.;x\n\r", max_size=120), st.sampled_from(PATTERNS), st.integers(1, 6), st.integers(1, 30))
def test_blocks_of_any_size(text, pattern, per_block, step):
    reach, compiled = 24, regex.compile(pattern)
    lines = text.split("\n")
    records, edges, g = {}, {}, 0
    for block in range(0, len(lines), per_block):
        scanner, found = Scanner(compiled, reach, step), []
        for line in lines[block : block + per_block]:
            found += scanner.add(line)
        last, own = scanner.end()
        for kind, piece, before, after in own:
            g += kind == "tail"
            edges.setdefault(g, []).append({"kind": kind, "log": piece, "before": before, "after": after})
            if kind == "head":
                records[g] = found + last
    out = []
    for i in sorted(edges):
        out += split_region(compiled, edges[i], i == 0, False) + records.get(i, [])
    assert out == brute(text, pattern)


def test_multiline_records_of_split_files(spark, tmp_path):
    rng = random.Random(4)
    files = {}
    for name in ("a.log", "b.log", "c.log", "one.log"):
        records = [f"{2020 + i} " + "\n".join("w" * rng.randint(0, 40) for _ in range(rng.randint(1, 6)))
                   for i in range(1 if name == "one.log" else 400)]
        files[name] = "\n".join(records) + ("\n" if name != "b.log" else "")
        (tmp_path / name).write_text(files[name])
    pattern = r"\n+(?=\d{4} )"
    kept = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "3000")
        spark.conf.set("spark.sql.files.openCostInBytes", "10")
        lines = read_lines(spark, str(tmp_path))
        assert lines.select("unit", "block").distinct().count() > 20
        rows = multiline_records(lines, pattern, reach=200, step=500).collect()
        cfg = LogConfig("S3", newline_pattern=pattern, sample=2)
        shipped = {(r["unit"], r["pos"], r["log"]) for r in ship_logs(read_lines(spark, str(tmp_path)), cfg).collect()}
    finally:
        for k, v in kept.items():
            spark.conf.set(k, v)
    got = {}
    for r in rows:
        got.setdefault(r["unit"].rsplit("/", 1)[1], {})[r["seq"]] = r["log"]
    for name, text in files.items():
        want = brute(text, pattern)
        assert [got[name][i] for i in range(len(want))] == want and len(got[name]) == len(want)
    assert {x[1] % 2 for x in shipped} == {0}
    whole = frame_lines(decode_objects(read_objects(spark, str(tmp_path))), pattern).select("unit", "records")
    assert explode_records(whole).count() == len(rows)


def test_out_of_order_lines_are_refused(spark):
    df = spark.createDataFrame([("u", 0, 2, "a"), ("u", 0, 1, "b")], "unit string, block long, seq long, log string")
    with pytest.raises(Exception, match="out of order"):
        multiline_records(df.coalesce(1), "x").collect()
    with pytest.raises(ValueError):
        multiline_records(df, "x*")


@pytest.mark.parametrize("kind", ["S3Csv", "CloudFront", "VpcFlow"])
def test_delimited_lines_ship_as_objects_do(spark, tmp_path, kind):
    cut = {"S3Csv": ",", "CloudFront": "\t", "VpcFlow": " "}[kind]
    for k in range(6):
        head = cut.join(["id", "name", f"col{k}", "id"])
        rows = [cut.join([str(i), f"n{i % 7}", '"q', str(i * 2)]) for i in range(200)] + ["", cut.join(["7"])]
        lines = {0: [head, *rows], 1: ["", head, *rows], 2: ["#Version: 1.0", "#Fields: " + " ".join(["a", "b"]), *rows],
                 3: [head], 4: ["#Version: 1.0"], 5: [""]}[k]
        (tmp_path / f"f{k}.csv").write_text("\n".join(lines))
    cfg = LogConfig(kind, block="n3", batch_target=3000)
    whole = ship_logs(decode_objects(read_objects(spark, str(tmp_path))), cfg)
    by_line = ship_logs(read_lines(spark, str(tmp_path)), cfg)
    name = F.regexp_extract("unit", r"[^/]+$", 0).alias("name")
    columns = [name, "batch_id", "log", "application", "subsystem", "severity"]
    a, b = (sorted(map(tuple, df.select(*columns).collect())) for df in (whole, by_line))
    assert a == b and len(a) > 400


def test_compression_follows_the_integration():
    assert LogConfig("VpcFlow").compression == LogConfig("CloudTrail").compression == "gzip"
    assert LogConfig("S3").compression == LogConfig("S3Csv").compression == "auto_ext"
