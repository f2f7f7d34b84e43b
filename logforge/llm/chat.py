"""Chat formatting: one encoding of a whole conversation, and loss masks aligned by offsets."""

from __future__ import annotations

import hashlib
import os
import re
from collections.abc import Iterator
from urllib.parse import quote, unquote

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logforge.llm.common import process_cache

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.json"
#: How a turn of each role begins; another role is quoted in a header of its own.
HEADERS = {"user": "[INST] ", "assistant": "[/INST] ", "system": "[SYS] "}
OTHER = "[ROLE:"
END = "</s>"
CONTROL = re.compile(r"(\\*)(\[/?INST\]|\[SYS\]|\[ROLE:|</?s>|\Z)")
ESCAPED = re.compile(r"(\\+)(\[/?INST\]|\[SYS\]|\[ROLE:|</?s>|\Z)")
TURN = re.compile(r"(\[/?INST\] |\[SYS\] |\[ROLE:[^\]]*\] )")
CLOSE = re.compile(r"(\\*)</s>")


def escape(text: str) -> str:
    """Text in which no control string stands after an even number of backslashes.

    Backslashes right before a control string or the end are doubled, and one more goes
    before a control string; other backslashes and all other text stay as they are.
    """
    return CONTROL.sub(
        lambda m: m[1] * 2 + ("\\" + m[2] if m[2] else ""), text)


def unescape(text: str) -> str:
    return ESCAPED.sub(lambda m: "\\" * (len(m[1]) // 2) + m[2], text)


def render(turns: list[tuple[str, str]]) -> tuple[str, list[tuple[int, int]]]:
    """The formatted conversation, and the span of each assistant turn's escaped text."""
    parts, spans, at = [], [], 0
    for role, text in turns:
        header = HEADERS.get(role) or f"{OTHER}{quote(role, safe='')}] "
        body = escape(text)
        begin = at + len(header)
        if role == "assistant":
            spans.append((begin, begin + len(body)))
        parts += [header, body, END]
        at = begin + len(body) + len(END)
    return "".join(parts), spans


def parse(formatted: str) -> list[tuple[str, str]]:
    """The turns that ``render`` was given."""
    names = {header: role for role, header in HEADERS.items()}
    turns, at = [], 0
    while at < len(formatted):
        head = TURN.match(formatted, at)
        role = names.get(head[1])
        if role is None:
            role = unquote(head[1][len(OTHER) : -2])
        begin = head.end()
        for close in CLOSE.finditer(formatted, begin):
            if len(close[1]) % 2 == 0:
                break
        turns.append((role, unescape(formatted[begin : close.end() - len(END)])))
        at = close.end()
    return turns


def _tokenizer(path: str):
    known = process_cache("tokenizers")
    if path not in known:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, processors

        known[path] = Tokenizer.from_file(path)
        known[path].encode_special_tokens = True
        # Offsets are to cover the blanks too.
        known[path].post_processor = processors.ByteLevel(trim_offsets=False)
    return known[path]


def masked(
    offsets: np.ndarray, spans: list[tuple[int, int]]
) -> tuple[np.ndarray, list[tuple[int, int]]]:
    """The loss mask of the tokens, and the pieces of text under it.

    ``offsets`` (begin, end) ascend, as do ``spans``. For each span the first token that ends
    behind its begin and the last one that begins before its end are found by binary search;
    their offsets, cut to the span, are joined to pieces. Tokens of one character's bytes
    share their offsets, so pieces are unions.
    """
    mask, pieces = np.zeros(len(offsets), bool), []
    for begin, end in spans:
        first = int(np.searchsorted(offsets[:, 1], begin, side="right"))
        last = int(np.searchsorted(offsets[:, 0], end, side="left"))
        if first >= last:
            continue
        mask[first:last] = True
        low = np.maximum(offsets[first:last, 0], begin)
        high = np.minimum(offsets[first:last, 1], end)
        reach = np.maximum.accumulate(high)
        gaps = np.flatnonzero(low[1:] > reach[:-1]) + 1
        for a, b in zip(np.append(0, gaps), np.append(gaps, len(low))):
            if reach[b - 1] > low[a]:
                pieces.append((int(low[a]), int(reach[b - 1])))
    return mask, pieces


FORMATTED = (
    "conv_id long, formatted string, tokens array<int>, mask array<boolean>, "
    "loss array<struct<begin: long, end: long>>")


def format_conversations(conversations: DataFrame, vocabulary: str = VOCABULARY) -> DataFrame:
    """One row per conversation: conv_id, formatted, tokens, mask (per token), loss.

    ``loss`` lists the spans of ``formatted`` (code points) under the mask: the escaped texts
    of the assistant's turns. Turns come by turn, ties by role, then text; rows that repeat
    are turns of their own. Null texts and roles count as empty, null turns come first, rows
    without conv_id form a conversation without id. Other columns are ignored; an empty table
    gives no rows. Rows are sorted by key inside each partition and read as a stream, so a
    task holds one conversation at a time; that is one training sample and cannot be split.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    role = F.coalesce(F.col("role").cast("string"), F.lit(""))
    rows = conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"), "turn", role.alias("role"), text.alias("text"))
    rows = rows.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer, waiting, size = _tokenizer(vocabulary), [], 0

        def done() -> pa.RecordBatch:
            rendered = [render(turns) for _, turns in waiting]
            encoded = tokenizer.encode_batch([r[0] for r in rendered], add_special_tokens=False)
            masks, losses = [], []
            for (_, spans), code in zip(rendered, encoded):
                mask, pieces = masked(np.array(code.offsets, np.int64).reshape(-1, 2), spans)
                masks.append(mask)
                losses.append([{"begin": a, "end": b} for a, b in pieces])
            loss = pa.list_(pa.struct([("begin", pa.int64()), ("end", pa.int64())]))
            return pa.RecordBatch.from_arrays([
                pa.array([key for key, _ in waiting], pa.int64()),
                pa.array([r[0] for r in rendered], pa.string()),
                pa.array([code.ids for code in encoded], pa.list_(pa.int32())),
                pa.array(masks, pa.list_(pa.bool_())), pa.array(losses, loss),
            ], ["conv_id", "formatted", "tokens", "mask", "loss"])

        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in ("conv_id", "role", "text")]
            for key, who, said in zip(*columns):
                if not waiting or waiting[-1][0] != key:
                    if size > 1 << 20:
                        yield done()
                        waiting, size = [], 0
                    waiting.append((key, []))
                waiting[-1][1].append((who, said))
                size += len(said)
        if waiting:
            yield done()

    return rows.select("conv_id", "role", "text").mapInArrow(encode, FORMATTED)


DIGESTS = (
    "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, "
    "formatted_chars long, n_tokens long, loss_tokens long")


def read_back(formatted: DataFrame) -> DataFrame:
    """Counts and digests of formatted conversations, from the formatted text and mask alone."""

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for row in batch.to_pylist():
                text = row["formatted"]
                turns = parse(text)
                whole = "".join(f"{role}\n{said}\n" for role, said in turns)
                loss = "".join(unescape(text[p["begin"] : p["end"]]) for p in row["loss"])
                out.append((
                    row["conv_id"], len(turns), hashlib.sha256(whole.encode()).hexdigest(),
                    len(loss), hashlib.sha256(loss.encode()).hexdigest(), len(text),
                    len(row["tokens"]), sum(row["mask"])))
            kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), *[pa.int64()] * 3]
            names = [part.split()[0] for part in DIGESTS.split(", ")]
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(c), k) for c, k in zip(zip(*out) if out else [()] * 8, kinds)], names)

    return formatted.mapInArrow(digest, DIGESTS)
