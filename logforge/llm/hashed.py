"""Hashed text features, computed with numpy over many texts at once.

Lexical features are whole words and the character 4-, 5- and 6-grams inside words, with a
word's edges as characters of their own; words and each size of grams have a quarter of the buckets. Shape features are 1- to 4-grams over character
classes (runs of letters or digits count once) and the share of words that repeat the word
before them. A feature is its bucket; equal buckets are one feature.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

from logforge.llm.common import process_cache

LEXICAL_BITS = 20
SHAPE_BITS = 14
LEXICAL = 1 << LEXICAL_BITS
SHAPES = 1 << SHAPE_BITS
GRAMS = (4, 5, 6)
SEGMENT = 1 << 19
#: Texts are scored together up to this many characters: some ten arrays of them are held at once.
GROUP = 1 << 17

#: Odd multipliers: of the rolling hash (with its inverse modulo 2**64) and of the buckets.
_P = 0x9E3779B97F4A7C15
_Q = 0xD6E8FEB86659FD93


def _power(base: int, n: int) -> np.ndarray:
    """1, base, base**2, ... modulo 2**64."""
    known = process_cache("powers")
    have = known.get(base)
    if have is None or len(have) < n:
        steps = np.full(max(n, SEGMENT + 64), base & (2**64 - 1), np.uint64)
        steps[0] = 1
        have = known[base] = np.cumprod(steps, dtype=np.uint64)
    return have[:n]


def _bucket(hashes: np.ndarray, salt: int, bits: int) -> np.ndarray:
    mixed = (hashes + np.uint64(salt)) * np.uint64(_Q)
    mixed ^= mixed >> np.uint64(29)
    mixed *= np.uint64(_P)
    return (mixed >> np.uint64(64 - bits)).astype(np.int32)


def groups(texts: list[str]) -> Iterator[tuple[int, int]]:
    """Bounds of consecutive texts of about GROUP characters; a longer text is alone."""
    begin = size = 0
    for i, text in enumerate(texts):
        if i > begin and size + len(text) > GROUP:
            yield begin, i
            begin, size = i, 0
        size += len(text)
    if texts:
        yield begin, len(texts)


def segments(texts: list[str]) -> Iterator[tuple[np.ndarray, list[str]]]:
    """Runs of (row of each piece, pieces): at most about SEGMENT characters a run.

    A longer text is cut after white space (or anywhere, in a piece without any), so the
    features of its pieces are those of the text but for grams across a hard cut.
    """
    rows, parts, size = [], [], 0
    for i, text in enumerate(texts):
        begin = 0
        while begin < len(text) or begin == 0:
            end = min(len(text), begin + SEGMENT)
            if end < len(text):
                blank = max(text.rfind(" ", begin, end), text.rfind("\n", begin, end))
                end = blank + 1 if blank > begin else end
            if parts and size + end - begin > SEGMENT:
                yield np.array(rows), parts
                rows, parts, size = [], [], 0
            rows.append(i)
            parts.append(text[begin:end])
            size += end - begin
            begin = max(end, 1)
    if parts:
        yield np.array(rows), parts


def _codes(parts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Code points with a line feed around each piece, and the piece of each position."""
    joined = "\n" + "\n".join(parts) + "\n"
    codes = np.frombuffer(joined.encode("utf-32-le"), np.uint32)
    lengths = np.fromiter(map(len, parts), np.int64, len(parts)) + 1
    lengths[-1] += 1
    return codes, np.repeat(np.arange(len(parts), dtype=np.int32), lengths)


def _letters(codes: np.ndarray) -> np.ndarray:
    """ASCII letters and everything beyond Latin-1 symbols and general punctuation."""
    low = codes | 32
    return ((low >= 97) & (low <= 122)) | (
        (codes >= 0xC0) & ~((codes >= 0x2000) & (codes < 0x2070)))


def _words(codes: np.ndarray, letter: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and hash of every word."""
    edge = np.diff(letter.astype(np.int8))
    starts, ends = np.flatnonzero(edge == 1) + 1, np.flatnonzero(edge == -1) + 1
    sums = np.zeros(len(codes) + 1, np.uint64)
    np.cumsum(codes.astype(np.uint64) * _power(_P, len(codes)), dtype=np.uint64, out=sums[1:])
    inverse = _power(pow(_P, -1, 2**64), len(codes) + 1)
    return starts, (sums[ends] - sums[starts]) * inverse[starts]


def lexical(texts: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(rows, buckets) in pieces; a feature comes as often as it occurs."""
    for rows, parts in segments(texts):
        codes, piece = _codes([p.lower() for p in parts])
        letter = _letters(codes)
        owner = rows.astype(np.int32)[piece]
        starts, hashes = _words(codes, letter)
        yield owner[starts], _bucket(hashes, 1, LEXICAL_BITS - 2)
        chars = np.where(letter, codes, 0).astype(np.uint64)
        edges = np.concatenate([[0], np.cumsum(~letter)])
        rolled = chars
        for size in range(2, max(GRAMS) + 1):
            if len(chars) < size:
                break
            rolled = rolled[: len(chars) - size + 1] * np.uint64(_P) + chars[size - 1 :]
            if size in GRAMS:
                n = len(rolled)
                inner = edges[size - 1 : size - 1 + n] == edges[1 : n + 1]
                at = np.flatnonzero(inner)
                kind = np.int32((size - GRAMS[0] + 1) << (LEXICAL_BITS - 2))
                yield owner[at], _bucket(rolled[at], size, LEXICAL_BITS - 2) + kind


def word_bucket(word: str) -> int:
    """The bucket of a whole word."""
    _, buckets = next(lexical([word]))
    return int(buckets[0])


def word_buckets(texts: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(rows, buckets of 64-bit word hashes) of whole words only."""
    for rows, parts in segments(texts):
        codes, piece = _codes([p.lower() for p in parts])
        starts, hashes = _words(codes, _letters(codes))
        yield rows[piece[starts]], hashes


def shapes(texts: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(rows, buckets, counts) of shape features; bucket 0 counts all positions, bucket 1
    words equal to the word before."""
    for rows, parts in segments(texts):
        codes, piece = _codes(parts)
        letter = _letters(codes)
        upper = (codes >= 65) & (codes <= 90)
        digit = (codes >= 48) & (codes <= 57)
        kind = np.where(letter, np.uint32(97), codes)
        kind = np.where(upper, np.uint32(65), np.where(digit, np.uint32(48), kind))
        keep = np.ones(len(kind), bool)
        keep[1:] = (kind[1:] != kind[:-1]) | ~(letter | digit)[1:]
        # The line feed behind the last piece is not of it: features are the same whatever texts stand beside.
        keep[-1] = False
        kind, where = kind[keep].astype(np.uint64), piece[keep]
        owner, found = rows[where], []
        rolled = kind
        for size in range(1, 5):
            if size > 1:
                if len(kind) < size:
                    break
                rolled = rolled[: len(kind) - size + 1] * np.uint64(_P) + kind[size - 1 :]
            inside = where[: len(rolled)] == where[size - 1 :]
            found.append((owner[: len(rolled)][inside], _bucket(rolled[inside], size, SHAPE_BITS)))
        found.append((owner, np.zeros(len(owner), np.int32)))
        starts, hashes = _words(codes, letter)
        same = (hashes[1:] == hashes[:-1]) & (piece[starts[1:]] == piece[starts[:-1]])
        again = rows[piece[starts[1:][same]]]
        found.append((again, np.ones(len(again), np.int32)))
        keys = np.concatenate([r.astype(np.int64) * SHAPES + b for r, b in found])
        keys, counts = np.unique(keys, return_counts=True)
        yield keys // SHAPES, keys % SHAPES, counts
