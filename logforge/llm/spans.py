"""Substring dedup: repeated runs of consecutive sentences are removed but for the first."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logforge.llm.common import whole_text
from logforge.llm.hashed import _P, _Q, _codes, _power, segments
from logforge.session import staged

#: Runs are the shortest ones from or up to a sentence with so many sentences and words.
SENTENCES = 3
WORDS = 24
#: A sentence ends after one in CUT words, too, chosen by the hash of the word and the one before
#: it, and after the word of the least hash among any NEAR words.
CUT = 4
NEAR = 6
_BASES = (_P, _Q)
#: Texts hashed at once, in characters.
BATCH = 1 << 20


def _blank(codes: np.ndarray) -> np.ndarray:
    return (codes <= 32) | (codes == 0x85) | (codes == 0xA0) | (codes == 0x3000) | (
        (codes >= 0x2000) & (codes <= 0x200A)) | (codes == 0x2028) | (codes == 0x2029)


def _alone(codes: np.ndarray) -> np.ndarray:
    """Characters of scripts without blanks (Thai to Khmer, kana, ideographs): words of their own."""
    out = np.zeros(len(codes), bool)
    for low, high in (
            (0xE00, 0xEFF), (0x1000, 0x109F), (0x1780, 0x17FF), (0x3001, 0x30FF), (0x31F0, 0x31FF),
            (0x3400, 0x4DBF), (0x4E00, 0x9FFF), (0xF900, 0xFAFF), (0xFF01, 0xFF9F), (0x20000, 0x3FFFF)):
        out |= (codes >= low) & (codes <= high)
    return out


class Runs:
    """Sentences and runs of a batch of texts, as arrays.

    Sentences end after a word that ends in ``. ! ?`` or before a line feed. They are
    cut further by the hashes of nearby words alone (see CUT, NEAR), so that copies of a passage
    agree on every cut NEAR words or more inside it, wherever it begins, no piece has more than
    NEAR words, and any 50 words that two documents share hold a run of both. Characters of
    scripts without blanks are words. White space between words does not count.
    """

    def __init__(self, texts: list[str]):
        found, done = [], np.zeros(len(texts), np.int64)
        for rows, parts in segments(texts):
            codes, piece = _codes(parts)
            blank, alone = _blank(codes), _alone(codes)
            edge = (blank[1:] != blank[:-1]) | alone[1:] | alone[:-1]
            starts = np.flatnonzero(edge & ~blank[1:]) + 1
            ends = np.flatnonzero(edge & ~blank[:-1]) + 1
            sums = np.zeros(len(codes) + 1, np.uint64)
            np.cumsum(codes.astype(np.uint64) * _power(_P, len(codes)), dtype=np.uint64, out=sums[1:])
            inverse = _power(pow(_P, -1, 2**64), len(codes) + 1)
            word = (sums[ends] - sums[starts]) * inverse[starts]
            word = (word ^ (word >> np.uint64(31))) * np.uint64(_Q)
            word ^= word >> np.uint64(29)
            last = codes[ends - 1]
            lines = np.concatenate([[0], np.cumsum(codes == 10)])
            after = np.append(starts[1:], len(codes))
            stop = (last == 46) | (last == 33) | (last == 63) | (lines[after] > lines[ends])
            sizes = np.fromiter(map(len, parts), np.int64, len(parts))
            before = np.zeros(len(parts), np.int64)
            for i, row in enumerate(rows):
                before[i], done[row] = done[row], done[row] + sizes[i]
            shift = (before - np.concatenate([[1], 1 + np.cumsum(sizes[:-1] + 1)]))[piece[starts]]
            # The line feed that _codes puts between pieces of one text ends no sentence.
            inner = np.append(rows[piece[starts[1:]]] == rows[piece[starts[:-1]]], False)
            crossing = inner & np.append(piece[starts[1:]] != piece[starts[:-1]], False)
            stop &= ~crossing | (last == 46) | (last == 33) | (last == 63)
            found.append((rows[piece[starts]], starts + shift, word, stop))
        self.row, self.start, self.word, stop = (
            np.concatenate([f[i] for f in found]) if found else np.zeros(0, np.int64) for i in range(4))
        n = len(self.row)
        if not n:
            self.first = self.ends = self.owner = self.begin = self.stop = np.zeros(0, np.int64)
            self.hashes = np.zeros((0, 2), np.int64)
            return
        stop = stop.astype(bool) | np.append(self.row[1:] != self.row[:-1], True)
        stop |= self._cuts()
        self.first = np.flatnonzero(np.append(True, stop[:-1]))
        self.ends = np.append(self.first[1:], n)
        self.owner = self.row[self.first]
        count = len(self.first)
        at = np.arange(count)
        reach = np.searchsorted(self.ends, self.first + WORDS, side="left") + 1
        after = np.maximum(at + SENTENCES, reach)
        since = np.minimum(
            at + 1 - SENTENCES, np.searchsorted(self.first, self.ends - WORDS, side="right") - 1)
        begin, stop = np.concatenate([at, since]), np.concatenate([after, at + 1])
        real = (begin >= 0) & (stop <= count)
        begin, stop = begin[real], stop[real]
        same = self.owner[begin] == self.owner[stop - 1]
        runs = np.unique(begin[same] * (count + 1) + stop[same])
        #: Sentences of each run (end exclusive), by begin.
        self.begin, self.stop = runs // (count + 1), runs % (count + 1)
        low, high = self.first[self.begin], self.ends[self.stop - 1]
        self.hashes = np.empty((len(runs), 2), np.int64)
        for i, base in enumerate(_BASES):
            sums = np.zeros(n + 1, np.uint64)
            np.cumsum(self.word * _power(base, n), dtype=np.uint64, out=sums[1:])
            value = (sums[high] - sums[low]) * _power(pow(base, -1, 2**64), n + 1)[low]
            value = (value ^ (value >> np.uint64(32))) * np.uint64(_BASES[1 - i])
            self.hashes[:, i] = (value ^ (value >> np.uint64(29))).view(np.int64)

    def _cuts(self) -> np.ndarray:
        """Words picked by the hashes of words nearby in their text."""
        before = np.append(np.uint64(0), self.word[:-1])
        before[np.append(True, self.row[1:] != self.row[:-1])] = 0
        key = before * np.uint64(_P) + self.word
        key = (key ^ (key >> np.uint64(32))) * np.uint64(_Q)
        key ^= key >> np.uint64(29)
        cut = key < np.uint64(2**64 // CUT)
        if len(key) >= NEAR:
            near = np.lib.stride_tricks.sliding_window_view(key, NEAR)
            # The last of equal ones.
            at = NEAR - 1 - near[:, ::-1].argmin(axis=1)
            whole = self.row[NEAR - 1 :] == self.row[: len(near)]
            cut[(np.arange(len(near)) + at)[whole]] = True
        return cut

    def distinct(self) -> tuple[np.ndarray, np.ndarray]:
        """(row, hashes) of the runs, each once per text."""
        keys = np.column_stack([self.owner[self.begin], self.hashes])
        keys = np.unique(keys, axis=0) if len(keys) else keys.reshape(0, 3)
        return keys[:, 0], keys[:, 1:]

    def covered(self, row_keys: list[set]) -> np.ndarray:
        """Sentences inside a run that is repeated: within its text, or by ``row_keys``."""
        change = np.zeros(len(self.first) + 1, np.int64)
        seen: set = set()
        now = -1
        owners, hashes = self.owner[self.begin].tolist(), self.hashes.tolist()
        for row, key, begin, stop in zip(owners, hashes, self.begin.tolist(), self.stop.tolist()):
            if row != now:
                seen, now = set(), row
            key = tuple(key)
            if key in seen or key in row_keys[row]:
                change[begin] += 1
                change[stop] -= 1
            seen.add(key)
        return np.cumsum(change[:-1]) > 0


def _batches(texts: list[str]) -> Iterator[tuple[int, int]]:
    begin, size = 0, 0
    for i, text in enumerate(texts):
        if i > begin and size + len(text) > BATCH:
            yield begin, i
            begin, size = i, 0
        size += len(text)
    if begin < len(texts):
        yield begin, len(texts)


def run_hashes(docs: DataFrame) -> DataFrame:
    """(h1, h2, doc): the hash of every run of every text, once per row."""

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, ids = batch.column("text").to_pylist(), batch.column("doc").to_numpy()
            for begin, end in _batches(texts):
                rows, keys = Runs(texts[begin:end]).distinct()
                yield pa.RecordBatch.from_arrays(
                    [pa.array(keys[:, 0]), pa.array(keys[:, 1]), pa.array(ids[begin:end][rows])],
                    ["h1", "h2", "doc"])

    return docs.mapInArrow(emit, "h1 long, h2 long, doc long")


FOUND = "h1 long, h2 long, doc long, keeper long, part int, first boolean, last boolean"


def later_occurrences(runs: DataFrame) -> DataFrame:
    """(h1, h2, doc, keeper) of the runs that an earlier document has, too; keeper is the earliest.

    The rows are sorted by (h1, h2, doc) across all partitions, and each is shuffled once. As doc
    is part of the order, a run of many documents is dealt over several partitions. Each finds
    the first document of its groups; of its first and last group it also says so, and one
    short row per partition settles who is first in a group that goes on from one to the next.
    """
    ordered = runs.repartitionByRange("h1", "h2", "doc").sortWithinPartitions("h1", "h2", "doc")

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, key, keeper, group = TaskContext.get().partitionId(), None, 0, -1
        kinds = [pa.int64()] * 4 + [pa.int32(), pa.bool_(), pa.bool_()]
        names = [p.split()[0] for p in FOUND.split(", ")]

        def rows(h1, h2, doc, keeper, first, last) -> pa.RecordBatch:
            columns = [h1, h2, doc, keeper, np.full(len(h1), part), first, last]
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names)

        for batch in batches:
            if not batch.num_rows:
                continue
            h1, h2, doc = (c.to_numpy() for c in batch.columns)
            new = np.append(True, (h1[1:] != h1[:-1]) | (h2[1:] != h2[:-1]))
            new[0] = key != (h1[0], h2[0])
            starts = np.flatnonzero(new)
            if key is None:
                # What the partition begins with: a row of its own, that marks nothing.
                yield rows(h1[:1], h2[:1], doc[:1], doc[:1], [True], [False])
            keepers = np.concatenate([[keeper], doc[starts]])[np.cumsum(new)]
            groups = group + np.cumsum(new)
            later = doc > keepers
            yield rows(
                h1[later], h2[later], doc[later], keepers[later], groups[later] == 0, np.zeros(later.sum(), bool))
            key, keeper, group = (h1[-1], h2[-1]), int(keepers[-1]), int(groups[-1])
        if key is not None:
            one = [np.array([x], np.int64) for x in (*key, keeper, keeper)]
            yield rows(*one, [group == 0], [True])

    found = staged(ordered.mapInArrow(find, FOUND), "later")
    # Two rows per partition: its first key with its first document, and its last with its keeper.
    edges = found.filter("doc = keeper").select("part", "h1", "h2", "keeper", "first", "last")
    begin = edges.filter("not last").select("part", "h1", "h2", F.col("keeper").alias("doc"))
    end = edges.filter("last").select("part", "h1", "h2", "keeper", F.col("first").alias("alone"))
    starts = {r["part"]: r for r in begin.collect()}
    ends = {r["part"]: r for r in end.collect()}
    carried, open_key, open_keeper = [], None, None
    for part in sorted(starts):
        r = starts[part]
        if open_key == (r["h1"], r["h2"]):
            carried.append((part, r["h1"], r["h2"], r["doc"], open_keeper))
        r = ends[part]
        if open_key != (r["h1"], r["h2"]):
            open_key, open_keeper = (r["h1"], r["h2"]), r["keeper"]
    settled = found.sparkSession.createDataFrame(carried, "part int, h1 long, h2 long, doc long, carried long")
    marks = found.filter("doc > keeper").join(
        settled.select("part", "carried").withColumn("first", F.lit(True)), ["part", "first"], "left")
    marks = marks.select("h1", "h2", "doc", F.coalesce("carried", "keeper").alias("keeper"))
    return marks.union(settled.filter("doc > carried").select("h1", "h2", "doc", F.col("carried").alias("keeper")))


CLEANED = "doc_id long, text string, n_sentences long, n_removed long, removed string, copied_from array<long>"


def remove_repeats(docs: DataFrame) -> DataFrame:
    """Every text without the sentences of repeated runs.

    Each run of consecutive sentences (see SENTENCES, WORDS and ``Runs``) of all texts is
    hashed and joined globally. The first occurrence is the earliest one in the text of the
    smallest doc_id; every sentence in any other occurrence is removed, with the white space
    behind it. Columns: doc_id, text (what is left), n_sentences, n_removed, removed
    (begin:end of the removed stretches in code points, comma-joined) and copied_from (sorted ids
    of the documents that keep what was removed here).

    Null texts count as empty. Rows that repeat a doc_id count as one document: what they
    share with each other stays. Rows without an id count as one document too, after all
    others. Other columns are ignored; an empty table gives no rows. Only hashes of whole
    runs are shuffled, once, and texts once to meet their marks.
    """
    last = (1 << 63) - 1
    texts = docs.select(
        F.coalesce(F.col("doc_id").cast("long"), F.lit(last)).alias("doc"), whole_text().alias("text"))
    marks = later_occurrences(run_hashes(texts)).groupBy(F.col("doc").alias("marked")).agg(
        F.collect_set(F.struct("h1", "h2")).alias("runs"), F.sort_array(F.collect_set("keeper")).alias("copied_from"))
    marks = staged(marks, "marks")
    met = texts.join(marks, texts["doc"] == marks["marked"], "left").select(
        "doc", "text", "runs", "copied_from")

    def clean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, lists = batch.column("text").to_pylist(), batch.column("runs")
            left, total, gone, spans = [], [], [], []
            for begin, end in _batches(texts):
                some = Runs(texts[begin:end])
                keys = [
                    set(zip(x.values.field("h1").to_pylist(), x.values.field("h2").to_pylist())) if x.is_valid else set()
                    for x in lists.slice(begin, end - begin)]
                covered = some.covered(keys)
                bounds = np.searchsorted(some.owner, np.arange(end - begin + 1))
                for i in range(end - begin):
                    text, a, b = texts[begin + i], bounds[i], bounds[i + 1]
                    starts = np.append(some.start[some.first[a:b]], len(text))
                    cuts: list[list[int]] = []
                    for j in np.flatnonzero(covered[a:b]).tolist():
                        if cuts and cuts[-1][1] == starts[j]:
                            cuts[-1][1] = int(starts[j + 1])
                        else:
                            cuts.append([int(starts[j]), int(starts[j + 1])])
                    kept, at = [], 0
                    for low, high in cuts:
                        kept.append(text[at:low])
                        at = high
                    left.append("".join(kept) + text[at:])
                    total.append(int(b - a))
                    gone.append(int(covered[a:b].sum()))
                    spans.append(",".join(f"{low}:{high}" for low, high in cuts))
            ids = batch.column("doc").to_pylist()
            yield pa.RecordBatch.from_arrays([
                pa.array([None if d == last else d for d in ids], pa.int64()),
                pa.array(left, pa.string()), pa.array(total, pa.int64()), pa.array(gone, pa.int64()),
                pa.array(spans, pa.string()), batch.column("copied_from")], [
                part.split()[0] for part in CLEANED.split(", ")])

    return met.mapInArrow(clean, CLEANED)
