"""Fill-in-middle: documents as piece tables that are cut, rearranged and restored.

A piece table is an array of descriptors (buffer, start, length) in code points. Buffer 0 is
an immutable text, buffer k the k-th sentinel. No text is copied to cut, to rearrange or to
hash one; it is rendered once, as the sample itself.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from logforge.llm.common import whole_text

#: Sentinels of prefix, suffix and middle.
SENTINELS = ("<P>", "<S>", "<M>")
PREFIX, MIDDLE, SUFFIX = 0, 1, 2
#: Descriptors 0 to 2 are the parts of a document, 3 to 5 the sentinels that announce
#: prefix, middle and suffix: a form is the order in which the six come.
FORMS = {
    "psm": (3, PREFIX, 5, SUFFIX, 4, MIDDLE),
    "spm": (5, SUFFIX, 3, PREFIX, 4, MIDDLE),
}
PIECES = "array<struct<buffer: int, start: bigint, length: bigint>>"
#: Code points looked at, or hashed, at a time.
BLOCK = 1 << 20


def piece(buffer, start, length) -> Column:
    """One descriptor."""
    as_col = [c if isinstance(c, Column) else F.lit(c) for c in (buffer, start, length)]
    return F.struct(
        as_col[0].cast("int").alias("buffer"), as_col[1].cast("bigint").alias("start"),
        as_col[2].cast("bigint").alias("length"))


def split_piece(whole: Column, at: Column) -> tuple[Column, Column]:
    """The descriptors before and from place ``at`` of its buffer."""
    end = whole["start"] + whole["length"]
    return (
        piece(whole["buffer"], whole["start"], at - whole["start"]),
        piece(whole["buffer"], at, end - at))


def inverse(order: tuple[int, ...]) -> tuple[int, ...]:
    """The permutation that undoes ``order``."""
    return tuple(order.index(i) for i in range(len(order)))


def arranged(pieces: Column, order: tuple[int, ...]) -> Column:
    """The descriptors in another order."""
    return F.array(*[F.get(pieces, F.lit(i)) for i in order])


def unit_offsets(text: str, first: int, second: int) -> tuple[int, int, int]:
    """n, the number of units (letter runs, or one other character), and the places where the
    prefix ends and the middle ends: behind the smaller and the larger of first and second % (n + 1)
    units.

    Where units begin is kept as one bit for each character.
    """
    flags, counts, before = [], [], False
    for at in range(0, len(text), BLOCK):
        points = np.frombuffer(text[at : at + BLOCK].encode("utf-32-le"), np.uint32)
        letter = ((points | 32) - np.uint32(97)) < 26
        begins = ~letter
        begins[1:] |= ~letter[:-1]
        begins[0] |= not before
        before = bool(letter[-1])
        flags.append(np.packbits(begins))
        counts.append(int(np.count_nonzero(begins)))
    done = np.concatenate([[0], np.cumsum(counts, dtype=np.int64)])
    n, places = int(done[-1]), []
    for unit in sorted((first % (n + 1), second % (n + 1))):
        if unit == n:
            places.append(len(text))
        else:
            block = int(np.searchsorted(done, unit, side="right")) - 1
            inside = np.flatnonzero(np.unpackbits(flags[block]))
            places.append(block * BLOCK + int(inside[unit - done[block]]))
    return n, places[0], places[1]


CUT = T.StructType([T.StructField(c, T.LongType()) for c in ("n", "low", "high")])


@F.arrow_udf(CUT)
def _cuts(texts: pa.Array, first: pa.Array, second: pa.Array) -> pa.Array:
    out = [
        dict(zip(CUT.names, unit_offsets(text.as_py(), a, b)))
        for text, a, b in zip(texts, first.to_pylist(), second.to_pylist())]
    return pa.array(out, pa.struct([(c, pa.int64()) for c in CUT.names]))


def stream_sha256(text: Column, pieces: Column, sentinels: tuple[str, ...] = SENTINELS) -> Column:
    """Lower-case hex SHA-256 of what a piece table stands for, descriptor by descriptor."""

    @F.arrow_udf("string")
    def digest(texts: pa.Array, tables: pa.Array) -> pa.Array:
        out = []
        for text, table in zip(texts, tables):
            buffers, known = (text.as_py(), *sentinels), hashlib.sha256()
            for d in table.as_py():
                end = d["start"] + d["length"]
                for at in range(d["start"], end, BLOCK):
                    known.update(buffers[d["buffer"]][at : min(at + BLOCK, end)].encode())
            out.append(known.hexdigest())
        return pa.array(out, pa.string())

    return digest(text, pieces)


def rendered(text: Column, pieces: Column, sentinels: tuple[str, ...] = SENTINELS) -> Column:
    """The text that a piece table stands for."""

    @F.arrow_udf("string")
    def render(texts: pa.Array, tables: pa.Array) -> pa.Array:
        out = []
        for text, table in zip(texts, tables):
            buffers = (text.as_py(), *sentinels)
            out.append("".join([
                buffers[d["buffer"]][d["start"] : d["start"] + d["length"]] for d in table.as_py()]))
        return pa.array(out, pa.string())

    return render(text, pieces)


def draws(key: Column, seed: int) -> list[Column]:
    """Four numbers below 2**32 from a document's key; a null key counts as empty."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit(""))), 256)
    return [F.conv(F.substring(digest, 8 * i + 1, 8), 16, 10).cast("bigint") for i in range(4)]


def fill_in_middle(
    docs: DataFrame,
    seed: int = 1,
    percent: int = 90,
    spm_percent: int = 20,
    sentinels: tuple[str, ...] = SENTINELS,
) -> DataFrame:
    """One row per document: doc_id, text, n (units), form, prefix_chars, middle_chars, pieces, output.

    A document is cut at two units drawn by the hash of its id. ``percent`` of the documents are
    rearranged, of these ``spm_percent`` with the suffix first; the others are plain, as are
    those without text and those that contain a sentinel (their pieces are the whole text, the
    counts null). ``pieces`` is the table of ``output`` over ``text``. Null texts count as
    empty, a null id as an empty one; rows that repeat (or share an id) are each handled, and
    alike. Other columns are ignored; an empty table gives no rows. Each row is handled where it
    lies.
    """
    text, (h1, h2, h3, h4) = whole_text(), draws(F.col("doc_id"), seed)
    rows = docs.select("doc_id", text.alias("text"), *[
        h.alias(f"h{i}") for i, h in enumerate((h1, h2, h3, h4), 1)])
    plain = (F.col("text") == "") | (F.col("h3") % 100 >= percent)
    for mark in sentinels:
        plain = plain | F.contains("text", F.lit(mark))
    form = F.when(plain, "plain").when(F.col("h4") % 100 < spm_percent, "spm").otherwise("psm")
    rows = rows.withColumns({"form": form, "cut": _cuts("text", "h1", "h2")})
    whole = piece(0, 0, F.char_length("text"))
    prefix, rest = split_piece(whole, F.col("cut.low"))
    middle, suffix = split_piece(rest, F.col("cut.high"))
    # The sentinel in buffer k announces: 1 the prefix, 2 the suffix, 3 the middle.
    marks = [piece(b, 0, len(sentinels[b - 1])) for b in (1, 3, 2)]
    parts = F.array(prefix, middle, suffix, *marks)
    pieces = F.when(F.col("form") == "plain", F.array(whole))
    for name, order in FORMS.items():
        pieces = pieces.when(F.col("form") == name, arranged(parts, order))
    cut = F.col("form") != "plain"
    return rows.withColumn("pieces", pieces).select(
        "doc_id", "text", F.col("cut.n").alias("n"), "form",
        F.when(cut, F.col("cut.low")).alias("prefix_chars"),
        F.when(cut, F.col("cut.high") - F.col("cut.low")).alias("middle_chars"),
        "pieces", rendered(F.col("text"), F.col("pieces"), sentinels).alias("output"))


def restoring_pieces(output: Column, form: Column, sentinels: tuple[str, ...] = SENTINELS) -> Column:
    """The piece table, over an output, of the text it was made from.

    The sentinels of an output show its six descriptors; the inverse of its form puts them
    back in order, and the sentinels' own are left off.
    """
    width = F.char_length(output)
    table = F.when(form == "plain", F.array(piece(0, 0, width)))
    places = [F.locate(mark, output) - 1 for mark in sentinels]
    announces = {3: 0, 4: 2, 5: 1}
    for name, order in FORMS.items():
        marks = [announces[i] for i in order if i in announces]
        ends = [*[places[m] for m in marks[1:]], width]
        found = []
        for mark, end in zip(marks, ends):
            begin = places[mark] + len(sentinels[mark])
            found += [piece(0, places[mark], len(sentinels[mark])), piece(0, begin, end - begin)]
        back = arranged(F.array(*found), inverse(order))
        table = table.when(form == name, F.slice(back, 1, 3))
    return table


def restore(samples: DataFrame, sentinels: tuple[str, ...] = SENTINELS) -> DataFrame:
    """``samples`` (with output and form) with ``restored``, the text before rearrangement."""
    output = F.col("output")
    return samples.withColumn(
        "restored", rendered(output, restoring_pieces(output, F.col("form"), sentinels), sentinels))
