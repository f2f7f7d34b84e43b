"""BPE by a table of distinct words, and decoding through a table of pieces.

Documents are split into words where they lie. A chunk of documents is kept as places in its own
list of words, the commonest first, a row for some documents. The lists are cut up and dealt out by
word, so that each distinct word meets all its places once: it is encoded once, and its ids go back
to these places. So nothing is shuffled per word that occurs, only per word that is new to a chunk.

Chunks and their tables are written bucketed by chunk; putting them together moves neither.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
import unicodedata
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from logforge.llm.common import process_cache, whole_text
from logforge.session import work_dir

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.json"
# Fixed value: the pattern of words that byte-level BPE tokenizers of this kind share.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Characters of a chunk; a longer text is a chunk of its own.
CHUNK = 1 << 25
#: Words of the documents that one row of a chunk holds.
PART = 1 << 19
#: Shares that the distinct words are dealt into; a task holds one of them at a time.
SHARES = 1 << 12
#: A blank after white space: there a text is not cut at single blanks.
TWO_BLANKS = re.compile(r"\s ")
#: Words whose ids are put together at a time, or kept before they go back to their chunks.
BLOCK = 1 << 18
#: Pieces between blanks that are remembered with their words; the rest are split each time.
REMEMBERED = 1 << 17
ENTRIES = T.ArrayType(T.StructType([T.StructField(c, T.BinaryType()) for c in ("places", "sizes", "ids")]))


def _tokenizer(path: str):
    known = process_cache("bpe")
    if path not in known:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        known[path] = Tokenizer.from_file(path)
        known[path].no_truncation()
        known[path].no_padding()
    return known[path]


def _young():
    """Matches letters, digits and blanks that are younger than Unicode 3.2: whether they count
    as such is up to the tables that the tokenizer was built with."""
    known = process_cache("young")
    if "pattern" not in known:
        import regex

        kinds = regex.compile(r"[\p{L}\p{N}\s]")
        young = [
            c for c in range(0x80, 0x110000)
            if unicodedata.ucd_3_2_0.category(chr(c)) == "Cn" and kinds.match(chr(c))]
        runs, begin = [], None
        for c, after in zip(young, [*young[1:], None]):
            begin = c if begin is None else begin
            if after != c + 1:
                runs.append(f"{chr(begin)}-{chr(c)}")
                begin = None
        known["pattern"] = re.compile("[" + "".join(runs) + "]")
    return known["pattern"]


class Splitter:
    """Splits texts into the words that a vocabulary file's tokenizer would encode apart."""

    def __init__(self, path: str):
        import regex

        self.tokenizer = _tokenizer(path)
        with open(path, encoding="utf-8") as file:
            content = json.load(file)
        step = content["pre_tokenizer"] or {}
        plain = step.get("type") == "ByteLevel" and step.get("use_regex") and not step.get("add_prefix_space")
        added = [a["content"] for a in content["added_tokens"]]
        flags = any(a["single_word"] or a["lstrip"] or a["rstrip"] for a in content["added_tokens"])
        if not plain or content["normalizer"] or content["post_processor"] or flags:
            raise ValueError(f"{path}: not a plain byte-level vocabulary")
        self.added = re.compile("(" + "|".join(map(re.escape, sorted(added, key=len, reverse=True))) + ")") if added else None
        self.words, self.young = regex.compile(PATTERN), _young()

    def part(self, text: str) -> list[str]:
        """Words of a text without added tokens."""
        if not text.isascii() and self.young.search(text):
            spans = self.tokenizer.pre_tokenizer.pre_tokenize_str(text)
            return [text[a:b] for _, (a, b) in spans]
        return self.words.findall(text)

    def parts(self, text: str) -> list[tuple[str, bool]]:
        """The text between added tokens, and these (True)."""
        if self.added is None or not self.added.search(text):
            return [(text, False)]
        return [(t, i % 2 == 1) for i, t in enumerate(self.added.split(text)) if t]


def table_part(places: np.ndarray, ids: np.ndarray) -> tuple[bytes, bytes, bytes]:
    """Ascending places and the ids of each (an array of arrays), packed."""
    sizes = np.array([len(i) for i in ids], np.uint32)
    flat = np.concatenate([*ids, np.zeros(0, np.int32)]).astype(np.int32)
    return packed(np.diff(places, prepend=0)), packed(sizes), packed(flat)


def table_of(entries: list[dict]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(begin, size) by place, and the ids they mean, from all parts of a table."""
    places = np.concatenate([np.zeros(0, np.int64), *[np.cumsum(unpacked(e["places"]).astype(np.int64)) for e in entries]])
    sizes = np.concatenate([np.zeros(0, np.int64), *[unpacked(e["sizes"]).astype(np.int64) for e in entries]])
    flat = np.concatenate([np.zeros(0, np.int32), *[unpacked(e["ids"]).view(np.int32) for e in entries]])
    begin, length = np.empty(len(places), np.int64), np.empty(len(places), np.int64)
    begin[places], length[places] = np.cumsum(sizes) - sizes, sizes
    return begin, length, flat


@F.arrow_udf(T.ArrayType(T.IntegerType()))
def _distinct_ids(tables: pa.Array) -> pa.Array:
    return pa.array([np.unique(table_of(t.as_py())[2]) for t in tables], pa.list_(pa.int32()))


class Coder:
    """Numbers the words of a chunk of documents."""

    def __init__(self, splitter: Splitter):
        self.splitter, self.code, self.seen = splitter, {}, {}
        self.keys, self.codes, self.size = [], [], 0

    def numbered(self, words: list[str]) -> tuple[int, ...]:
        code = self.code
        return tuple([code.setdefault(w, len(code)) for w in words])

    def add(self, key, text: str) -> None:
        """One document.

        No word spans the place before a single blank, so what lies between those is split
        by itself, and the first REMEMBERED ones of a chunk only once.
        """
        out: list[int] = []
        for part, whole in self.splitter.parts(text):
            if whole:
                out += self.numbered([part])
            elif TWO_BLANKS.search(part):
                out += self.numbered(self.splitter.part(part))
            else:
                first, *others = part.split(" ")
                out += self.numbered(self.splitter.part(first))
                for other in others:
                    codes = self.seen.get(other)
                    if codes is None:
                        codes = self.numbered(self.splitter.part(" " + other))
                        if len(self.seen) < REMEMBERED:
                            self.seen[other] = codes
                    out += codes
        self.keys.append(key)
        self.codes.append(np.array(out, np.uint32))
        self.size += len(text)

    def rows(self) -> tuple[list[tuple[list, list[int], bytes]], list[str]]:
        """Keys, words per document and places, some documents at a time; and the words, the
        commonest first."""
        counts = np.array([len(c) for c in self.codes], np.int64)
        codes = np.concatenate([np.zeros(0, np.uint32), *self.codes])
        self.codes, self.seen = [], {}
        order = np.argsort(-np.bincount(codes, minlength=len(self.code)), kind="stable")
        place = np.empty(len(order), np.uint32)
        place[order] = np.arange(len(order))
        words = list(self.code)
        self.code = {}
        np.take(place, codes, out=codes)
        parts = []
        for low, high, begin, end in parted(counts):
            parts.append((self.keys[low:high], counts[low:high].tolist(), packed(codes[begin:end])))
        return parts, [words[i] for i in order]


def parted(counts: np.ndarray) -> Iterator[tuple[int, int, int, int]]:
    """Documents (low, high) and their words (begin, end) of parts of about PART words."""
    ends, low = np.cumsum(counts), 0
    while low < len(ends):
        begin = int(ends[low - 1]) if low else 0
        high = max(int(np.searchsorted(ends, begin + PART, side="right")), low + 1)
        yield low, high, begin, int(ends[high - 1])
        low = high


def packed(places: np.ndarray) -> bytes:
    """Numbers as all first bytes, all second bytes, and so on: small ones compress well."""
    return places.astype("<u4", copy=False).view(np.uint8).reshape(-1, 4).T.tobytes()


def unpacked(data) -> np.ndarray:
    """The numbers of ``packed``, from bytes or a buffer of them."""
    return np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(4, -1).T).view("<u4").ravel()


def bucketed(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the scratch folder in buckets of column chunk, and read back.

    Joins and groups by chunk then need no shuffle. The catalog entry goes, the files stay.
    """
    spark = df.sparkSession
    table = f"logforge_{name}_{uuid.uuid4().hex}"
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    writer = df.write.format("parquet").option("compression", "zstd").option("path", work_dir(spark, name))
    writer.bucketBy(buckets, "chunk").saveAsTable(table)
    out = spark.table(table)
    spark.sql(f"DROP TABLE {table}")
    return out


@dataclass
class Encoded:
    """Documents in token ids: ``chunks`` (chunk, keys, counts, places) hold places in the lists of
    ``tables`` (chunk, entries: some places, how many ids each has, and these, packed)."""

    chunks: DataFrame
    tables: DataFrame
    key: str
    kind: T.DataType

    def ids(self) -> DataFrame:
        """The document's key and ``ids`` (array<int>): one row per document."""
        schema = T.StructType([
            T.StructField(self.key, self.kind), T.StructField("ids", T.ArrayType(T.IntegerType()))])

        def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for keys, ids, _ in documents(batches):
                yield pa.RecordBatch.from_arrays(
                    [keys, pa.array(ids, pa.list_(pa.int32()))], [schema[0].name, "ids"])

        return self.chunks.join(self.tables, "chunk", "left").mapInArrow(rows, schema)

    def with_pieces(self, vocabulary: str = VOCABULARY) -> DataFrame:
        """Chunks with their tables and the pieces of the ids that occur in them."""
        ids = F.explode(_distinct_ids("entries")).alias("id")
        known = piece_table(self.tables.sparkSession, vocabulary)
        pieces = self.tables.select("chunk", ids).join(F.broadcast(known), "id")
        pieces = pieces.groupBy("chunk").agg(F.collect_list(F.struct("id", "piece")).alias("pieces"))
        return self.chunks.join(self.tables, "chunk", "left").join(pieces, "chunk", "left")


def piece_table(spark: SparkSession, vocabulary: str = VOCABULARY) -> DataFrame:
    """(id, piece binary): the bytes of every id. As long as the vocabulary, whatever the data."""
    with open(vocabulary, encoding="utf-8") as file:
        content = json.load(file)
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    other = [b for b in range(256) if b not in plain]
    # Byte-level vocabularies write a byte as its own character where that is printable, and
    # the others as those from U+0100.
    byte_of = {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(other)}
    rows = {i: bytes(byte_of[c] for c in word) for word, i in content["model"]["vocab"].items()}
    rows |= {a["id"]: a["content"].encode() for a in content["added_tokens"]}
    return spark.createDataFrame(
        pa.table({"id": pa.array(list(rows), pa.int32()), "piece": pa.array(list(rows.values()), pa.binary())}))


def split_chunks(docs: DataFrame, key: str, vocabulary: str, size: int) -> DataFrame:
    """(chunk, keys, counts, places, words): chunks of about ``size`` characters of documents, of
    several rows, the first of which has the words."""
    kind = docs.schema[key].dataType
    schema = T.StructType([
        T.StructField("chunk", T.LongType()), T.StructField("keys", T.ArrayType(kind)),
        T.StructField("counts", T.ArrayType(T.IntegerType())), T.StructField("places", T.BinaryType()),
        T.StructField("words", T.ArrayType(T.StringType()))])

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        splitter, chunk = Splitter(vocabulary), TaskContext.get().partitionId() << 32
        coder = Coder(splitter)

        def done() -> Iterator[pa.RecordBatch]:
            parts, words = coder.rows()
            for i, (keys, counts, places) in enumerate(parts):
                yield pa.RecordBatch.from_arrays([
                    pa.array([chunk], pa.int64()), pa.array([keys], pa.list_(key_kind)),
                    pa.array([counts], pa.list_(pa.int32())), pa.array([places], pa.binary()),
                    pa.array([words if i == 0 else None], pa.list_(pa.string()))], schema.names)

        for batch in batches:
            keys, texts = batch.columns
            key_kind = keys.type
            for at in range(batch.num_rows):
                coder.add(keys[at], texts[at].as_py())
                if coder.size >= size:
                    yield from done()
                    coder, chunk = Coder(splitter), chunk + 1
        if coder.keys:
            yield from done()

    return docs.select(key, whole_text().alias("text")).mapInArrow(split, schema)


def dealt_words(chunks: DataFrame) -> DataFrame:
    """(share, chunk, lengths, words, places): each chunk's words in SHARES lists by their hash, so that
    equal words of all chunks have one share."""
    schema = T.StructType([
        T.StructField("share", T.IntegerType()), T.StructField("chunk", T.LongType()),
        *[T.StructField(c, T.BinaryType()) for c in ("lengths", "words", "places")]])

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(batch.num_rows):
                words = batch.column("words")[at].as_py()
                shares = np.array([zlib.crc32(w.encode()) % SHARES for w in words], np.int32)
                order = np.argsort(shares, kind="stable")
                own, begin = np.unique(shares[order], return_index=True)
                rows = []
                for places in np.split(order, begin[1:]) if len(words) else []:
                    held = [words[i] for i in places]
                    rows.append((packed(np.array([len(w) for w in held])), "".join(held).encode(), packed(places)))
                columns = zip(*rows) if rows else ((), (), ())
                yield pa.RecordBatch.from_arrays([
                    pa.array(own, pa.int32()), pa.array([batch.column("chunk")[at].as_py()] * len(rows), pa.int64()),
                    *[pa.array(list(c), pa.binary()) for c in columns]], schema.names)

    return chunks.filter("words is not null").select("chunk", "words").mapInArrow(deal, schema)


def encode(docs: DataFrame, key: str = "doc_id", vocabulary: str = VOCABULARY, size: int = CHUNK) -> Encoded:
    """Whole texts in ids, as the tokenizer of the vocabulary file gives them for the text
    alone, without the tokens that templates add.

    Null texts count as empty and have no ids. A document is a row: those that repeat, share
    a key or have none are each encoded. Other columns are ignored; an empty table gives an
    empty one. ``vocabulary`` is a byte-level BPE file that every executor has; other kinds
    raise ValueError. A chunk holds whole documents, so its list of words is bounded by
    ``size`` or by one text.
    """
    chunks = bucketed(split_chunks(docs, key, vocabulary, size), "words")
    by_word = dealt_words(chunks).repartition("share").sortWithinPartitions("share")
    schema = T.StructType([T.StructField("chunk", T.LongType()), *ENTRIES.elementType.fields])

    def back(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer, share, known = _tokenizer(vocabulary), None, {}
        waiting, count = [], 0

        def done() -> pa.RecordBatch:
            chunk, place, ids = (np.concatenate([w[i] for w in waiting]) for i in range(3))
            order = np.lexsort((place, chunk))
            chunk, place, ids = chunk[order], place[order], ids[order]
            cuts = np.flatnonzero(np.concatenate([[True], chunk[1:] != chunk[:-1]]))
            packs = [table_part(*x) for x in zip(np.split(place, cuts[1:]), np.split(ids, cuts[1:]))]
            return pa.RecordBatch.from_arrays(
                [pa.array(chunk[cuts], pa.int64()), *[pa.array(c, pa.binary()) for c in zip(*packs)]], schema.names)

        for batch in batches:
            for own, chunk, lengths, text, places in zip(*[c.to_pylist() for c in batch.columns]):
                if own != share:
                    share, known = own, {}
                ends = np.cumsum(unpacked(lengths).astype(np.int64)).tolist()
                text = text.decode()
                words = [text[a:b] for a, b in zip([0, *ends], ends)]
                new = [w for w in words if w not in known]
                for word, e in zip(new, tokenizer.encode_batch_fast(new, add_special_tokens=False)):
                    known[word] = np.array(e.ids, np.int32)
                ids = np.empty(len(words), object)
                for i, word in enumerate(words):
                    ids[i] = known[word]
                waiting.append((np.full(len(words), chunk, np.int64), unpacked(places).astype(np.int64), ids))
                count += len(words)
                if count >= BLOCK:
                    yield done()
                    waiting, count = [], 0
        if count:
            yield done()

    packs = by_word.mapInArrow(back, schema)
    tables = packs.groupBy("chunk").agg(F.collect_list(F.struct("places", "sizes", "ids")).alias("entries"))
    kind = docs.schema[key].dataType
    return Encoded(chunks.drop("words"), bucketed(tables, "ids"), key, kind)


def encoded_ids(table: DataFrame, key: str = "doc_id", size: int = CHUNK) -> Encoded:
    """``Encoded`` from rows with their own ``ids`` (array<int>), say of a model, to be decoded.

    A null list counts as empty; null and unknown ids stand for no text.
    """
    kind = table.schema[key].dataType
    schema = T.StructType([
        T.StructField("chunk", T.LongType()), T.StructField("keys", T.ArrayType(kind)),
        T.StructField("counts", T.ArrayType(T.IntegerType())), T.StructField("places", T.BinaryType()),
        T.StructField("entries", ENTRIES)])

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunk, waiting, length = TaskContext.get().partitionId() << 32, [], 0

        def done() -> Iterator[pa.RecordBatch]:
            known, places = np.unique(np.concatenate([i for _, i in waiting]), return_inverse=True)
            own = np.empty(len(known), object)
            for i, known_id in enumerate(known):
                own[i] = np.array([known_id])
            part = dict(zip(ENTRIES.elementType.names, table_part(np.arange(len(known)), own)))
            entry_kind = pa.list_(pa.struct([(c, pa.binary()) for c in part]))
            counts = np.array([len(i) for _, i in waiting], np.int64)
            for low, high, begin, end in parted(counts):
                yield pa.RecordBatch.from_arrays([
                    pa.array([chunk], pa.int64()), pa.array([[k for k, _ in waiting[low:high]]], pa.list_(key_kind)),
                    pa.array([counts[low:high]], pa.list_(pa.int32())), pa.array([packed(places[begin:end])], pa.binary()),
                    pa.array([[part] if low == 0 else None], entry_kind)], schema.names)

        for batch in batches:
            keys, lists = batch.columns
            key_kind = keys.type
            for at in range(batch.num_rows):
                values = lists[at].values
                waiting.append((keys[at], np.zeros(0, np.int32) if values is None else values.fill_null(-1).to_numpy()))
                length += len(waiting[-1][1])
                if length >= size:
                    yield from done()
                    waiting, length, chunk = [], 0, chunk + 1
        if waiting:
            yield from done()

    chunks = bucketed(table.select(key, "ids").mapInArrow(split, schema), "given")
    tables = chunks.filter("entries is not null").select("chunk", "entries")
    return Encoded(chunks.drop("entries"), tables, key, kind)


def documents(
    batches: Iterator[pa.RecordBatch],
) -> Iterator[tuple[pa.Array, list[np.ndarray], dict[int, bytes] | None]]:
    """Keys and ids of documents, some at a time, from chunks with their tables; pieces by id,
    if the chunks have them."""
    for batch in batches:
        for at in range(batch.num_rows):
            pieces = None
            if "pieces" in batch.schema.names:
                found = batch.column("pieces")[at].values
                pieces = {} if found is None else dict(zip(
                    found.field("id").to_pylist(), found.field("piece").to_pylist()))
            begin, length, flat = table_of(batch.column("entries")[at].as_py() or [])
            keys, places = batch.column("keys")[at].values, unpacked(batch.column("places")[at].as_buffer())
            ends = np.cumsum(batch.column("counts")[at].values.to_numpy())
            low = 0
            while low < len(ends):
                start = int(ends[low - 1]) if low else 0
                high = max(int(np.searchsorted(ends, start + BLOCK, side="right")), low + 1)
                own = places[start : int(ends[high - 1])]
                sizes = length[own]
                tops = np.cumsum(sizes)
                ids = flat[np.repeat(begin[own] - (tops - sizes), sizes) + np.arange(sizes.sum())]
                cuts = np.concatenate([[0], tops])[ends[low : high - 1] - start]
                yield keys[low:high], np.split(ids, cuts), pieces
                low = high


def joined_pieces(ids: np.ndarray, pieces: dict[int, bytes]) -> str:
    """The text of ids; bytes that are no UTF-8 become replacement characters, ids that the vocabulary
    lacks nothing."""
    return b"".join([pieces.get(i, b"") for i in ids.tolist()]).decode("utf-8", "replace")


def decode(encoded: Encoded, vocabulary: str = VOCABULARY) -> DataFrame:
    """The document's key and ``text``, from its ids through the table of pieces.

    The join is per id that is new to a chunk, not per id that occurs. Tokens that the vocabulary
    calls special keep their text; unknown ids give none. Without ids a text is empty.
    """
    schema = T.StructType([T.StructField(encoded.key, encoded.kind), T.StructField("text", T.StringType())])

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for keys, ids, pieces in documents(batches):
            texts = [joined_pieces(i, pieces) for i in ids]
            yield pa.RecordBatch.from_arrays([keys, pa.array(texts, pa.string())], [schema[0].name, "text"])

    return encoded.with_pieces(vocabulary).mapInArrow(rows, schema)


def digests(encoded: Encoded, vocabulary: str = VOCABULARY) -> DataFrame:
    """Per document: key, n_tokens, ids_sha256 (decimal ids, comma-joined) and decoded_sha256, both
    operators' results in one pass."""
    schema = T.StructType([
        T.StructField(encoded.key, encoded.kind), T.StructField("n_tokens", T.LongType()),
        T.StructField("ids_sha256", T.StringType()), T.StructField("decoded_sha256", T.StringType())])

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decimal: dict[int, str] = {}
        for keys, ids, pieces in documents(batches):
            decimal.update((i, str(i)) for i in pieces if i not in decimal)
            listed = [",".join([decimal[i] for i in own.tolist()]) for own in ids]
            texts = [joined_pieces(own, pieces) for own in ids]
            sha = [[hashlib.sha256(t.encode()).hexdigest() for t in column] for column in (listed, texts)]
            yield pa.RecordBatch.from_arrays([
                keys, pa.array([len(own) for own in ids], pa.int64()),
                *[pa.array(column, pa.string()) for column in sha]], schema.names)

    return encoded.with_pieces(vocabulary).mapInArrow(rows, schema)
