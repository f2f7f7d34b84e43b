"""Packing: optimal length buckets and token-budget batches."""

from __future__ import annotations

import base64
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from logforge.llm.common import process_cache, text_udf, whole_text
from logforge.operators.ordering import ordered_position
from logforge.session import staged

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
# Fixed value: the pre-tokenizer pattern that belongs to this vocabulary.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: A blank after white space: there the text is not cut at single blanks.
TWO_BLANKS = re.compile(r"\s ")
CACHED = 1 << 20
#: Rows of a bucket numbered together.
CHUNK = 1 << 16


def _encoder(path: str):
    """The encoding function of a vocabulary file, and token counts of pieces seen."""
    known = process_cache("encoders")
    if path not in known:
        import tiktoken

        with open(path, "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        encoding = tiktoken.Encoding(
            "corpus", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        known[path] = encoding.encode_ordinary, {}
    return known[path]


def count_tokens(text: str, path: str = VOCABULARY) -> int:
    """Tokens of the whole text.

    No token spans the place before a single blank, so the text is counted piece by piece
    between those, and the counts of CACHED pieces are remembered by each Python worker.
    """
    encode, known = _encoder(path)
    if TWO_BLANKS.search(text):
        return len(encode(text))
    first, *others = text.split(" ")
    counts = list(map(known.get, others))
    total = len(encode(first))
    if None in counts:
        for i, count in enumerate(counts):
            if count is None:
                counts[i] = len(encode(" " + others[i]))
                if len(known) < CACHED and len(others[i]) < 64:
                    known[others[i]] = counts[i]
    return total + sum(counts)


def token_count(text: Column, path: str = VOCABULARY) -> Column:
    """Number of tokens as a column; the vocabulary file lies at ``path`` on every executor."""
    def per_batch(texts: list[str]) -> pa.Array:
        return pa.array([count_tokens(t, path) for t in texts], pa.int64())

    return text_udf(T.LongType(), per_batch)(text)


def best_boundaries(histogram: dict[int, int], buckets: int) -> list[int]:
    """Upper boundaries of at most ``buckets`` length buckets with the least padding.

    ``histogram`` maps a length to its count. Padding all sequences of a bucket to its
    boundary costs boundary * count in tokens, so with C the cumulative counts
    least[k][j] = min over i of least[k - 1][i] + length[j] * (C[j] - C[i]). The boundaries are
    lengths that occur. Ties go to fewer tokens in the longest buckets' favour: the smallest i.
    """
    lengths = np.array(sorted(histogram), np.int64)
    if not len(lengths):
        return []
    totals = np.concatenate([[0], np.cumsum([histogram[int(n)] for n in lengths])])
    n, far = len(lengths), np.iinfo(np.int64).max // 4
    least = np.full(n + 1, far, np.int64)
    least[0] = 0
    choices = []
    for _ in range(min(buckets, n)):
        nextly, came = np.full(n + 1, far, np.int64), np.zeros(n + 1, np.int64)
        for j in range(1, n + 1):
            costs = least[:j] + lengths[j - 1] * (totals[j] - totals[:j])
            came[j] = int(costs.argmin())
            nextly[j] = costs[came[j]]
        choices.append(came)
        least = nextly
    bounds, j = [], n
    for came in reversed(choices):
        if j == 0:
            break
        bounds.append(int(lengths[j - 1]))
        j = int(came[j])
    return bounds[::-1]


def pack(
    docs: DataFrame,
    budget: int = 65_536,
    max_length: int = 4_096,
    buckets: int = 12,
    align: int = 8,
    vocabulary: str = VOCABULARY,
) -> DataFrame:
    """Batches of at most ``budget`` padded tokens: one row per sequence.

    A document is cut into sequences of at most ``max_length`` tokens (a multiple of
    ``align``), so nothing is dropped and the histogram has at most max_length / align + 1
    entries; it counts every sequence of the corpus. Boundaries are multiples of ``align``.
    Within a bucket sequences come in the order of a hash, and each run of
    budget // boundary of them is a batch, so a bucket has one batch at most that is not full.

    Columns: doc_id, piece (from 0), start, length (tokens), bucket (padded length), batch
    (from 0 in its bucket), slot (from 0 in its batch). Null and empty texts have one row of
    length 0 without bucket, batch and slot. Rows that repeat are packed each. Other columns
    are ignored; an empty table gives no rows.
    """
    if max_length % align or budget < max_length:
        raise ValueError("max_length must be a multiple of align and fit the budget")
    tokens = token_count(whole_text(), vocabulary)
    rows = docs.select("doc_id", F.xxhash64("doc_id", whole_text()).alias("mix"), tokens.alias("n"))
    pieces = F.greatest(F.ceil(F.col("n") / max_length), F.lit(1)).cast("int")
    cut = rows.select("doc_id", "mix", "n", F.explode(F.sequence(F.lit(0), pieces - 1)).alias("piece"))
    start = F.col("piece").cast("long") * max_length
    cut = staged(cut.select(
        "doc_id", "piece", start.alias("start"),
        F.least(F.col("n") - start, F.lit(max_length)).alias("length"),
        F.xxhash64("mix", "piece").alias("mix")), "sequences")
    padded = (F.ceil(F.col("length") / align) * align).cast("long")
    histogram = {
        r["p"]: r["count"]
        for r in cut.filter("length > 0").groupBy(padded.alias("p")).count().collect()}
    bounds = best_boundaries(histogram, buckets)
    sizes = dict.fromkeys(bounds, 0)
    for length, count in histogram.items():
        sizes[next(b for b in bounds if b >= length)] += count
    if not bounds:
        return cut.select("doc_id", "piece", "start", "length", *[
            F.lit(None).cast("long").alias(c) for c in ("bucket", "batch", "slot")])
    bucket, chunks = F.lit(None).cast("long"), F.lit(1)
    for bound in reversed(bounds):
        fits = padded <= bound
        bucket = F.when(fits, F.lit(bound).cast("long")).otherwise(bucket)
        chunks = F.when(fits, F.lit(sizes[bound] // CHUNK + 1)).otherwise(chunks)
    # The hash, as a number from 0 to 1, cuts a bucket into chunks of about CHUNK rows.
    share = F.shiftrightunsigned("mix", 11) / float(1 << 53)
    full = cut.filter("length > 0").withColumns({
        "bucket": bucket, "chunk": F.floor(share * chunks),
        "order": F.shiftrightunsigned("mix", 1)})
    full = ordered_position(
        full, ["bucket"], ["order", "mix", "doc_id", "piece"], chunk="chunk", out="at")
    room = F.floor(F.lit(budget) / F.col("bucket"))
    done = full.select(
        "doc_id", "piece", "start", "length", "bucket",
        F.floor(F.col("at") / room).alias("batch"), (F.col("at") % room).alias("slot"))
    none = F.lit(None).cast("long")
    empty = cut.filter("length = 0").select(
        "doc_id", "piece", "start", "length", none.alias("bucket"), none.alias("batch"),
        none.alias("slot"))
    return done.union(empty)
