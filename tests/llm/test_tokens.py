"""Fill-in-middle and BPE: exact round trips, and the tokenizers library as the other way."""

import hashlib
import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from logforge.llm import bpe, fim, queries
from tests_llm_data import prose

UNIT = re.compile("[A-Za-z]+|[^A-Za-z]")


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def sample(key, text):
    """The contract of fill-in-middle, by lists of units."""
    h = [int(sha(f"1:{'' if key is None else key}")[8 * i : 8 * i + 8], 16) for i in range(4)]
    units = UNIT.findall(text)
    n = len(units)
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    prefix, middle, suffix = ("".join(u) for u in (units[:a], units[a:b], units[b:]))
    if not text or any(m in text for m in fim.SENTINELS) or h[2] % 100 >= 90:
        return n, "plain", None, None, text
    if h[3] % 100 < 20:
        return n, "spm", len(prefix), len(middle), f"<S>{suffix}<P>{prefix}<M>{middle}"
    return n, "psm", len(prefix), len(middle), f"<P>{prefix}<S>{suffix}<M>{middle}"


@settings(max_examples=200, deadline=None)
@given(st.text(), st.integers(0, 2**32 - 1), st.integers(0, 2**32 - 1), st.integers(1, 9))
def test_units_in_blocks(text, first, second, block):
    text = text.replace("\ud800", "")
    units = UNIT.findall(text)
    n = len(units)
    a, b = sorted((first % (n + 1), second % (n + 1)))
    kept, fim.BLOCK = fim.BLOCK, block
    try:
        found = fim.unit_offsets(text, first, second)
    finally:
        fim.BLOCK = kept
    assert found == (n, len("".join(units[:a])), len("".join(units[:b])))


def test_inverse_permutations():
    for order in fim.FORMS.values():
        assert [order[i] for i in fim.inverse(order)] == list(range(6))


def test_fill_in_middle_as_contract(spark, odd_docs):
    extra = [(1000 + i, prose(i) + (" <M>" if i % 7 == 0 else " 数字 😀 é")) for i in range(150)]
    docs = odd_docs.select("doc_id", "text").union(spark.createDataFrame(extra, "doc_id long, text string"))
    got = fim.restore(fim.fill_in_middle(docs)).collect()
    want = [(r["doc_id"], r["text"] or "") for r in docs.collect()]
    assert sorted((repr(r["doc_id"]), r["restored"]) for r in got) == sorted((repr(k), t) for k, t in want)
    assert sorted(map(repr, ((r["doc_id"], r["n"], r["form"], r["prefix_chars"], r["middle_chars"], r["output"])
                             for r in got))) == sorted(repr((k, *sample(k, t))) for k, t in want)
    assert {r["form"] for r in got} == {"plain", "psm", "spm"}
    streamed = fim.fill_in_middle(docs).select(
        "output", fim.stream_sha256(F.col("text"), F.col("pieces")).alias("sha")).collect()
    assert all(r["sha"] == sha(r["output"]) for r in streamed)


def test_fill_in_middle_of_odd_tables(spark, odd_docs, no_docs, tmp_path):
    assert fim.fill_in_middle(no_docs).count() == 0
    assert fim.fill_in_middle(odd_docs).count() == odd_docs.count()
    odd_docs.write.parquet(str(tmp_path / "documents.parquet"))
    rows = queries.QUERIES["op11_fill_in_middle"](spark, str(tmp_path)).collect()
    assert sorted(r["restored_sha256"] for r in rows) == sorted(sha(r["text"] or "") for r in odd_docs.collect())


def test_other_sentinels_and_shares(spark):
    docs = spark.createDataFrame([(i, prose(i)) for i in range(40)], "doc_id long, text string")
    marks = ("[pre]", "[suf]", "[mid]")
    made = fim.fill_in_middle(docs, seed=5, percent=100, spm_percent=100, sentinels=marks)
    rows = fim.restore(made, marks).collect()
    assert all(r["form"] == "spm" and r["output"].startswith("[suf]") and r["restored"] == r["text"] for r in rows)


STRANGE = [
    "", " ", "  ", "\n \n", "a  b", "a \n b", "tab\t x", "it's we'll 'Tis ''s", "<|endoftext|>",
    " <|endoftext|> x<|endoftext|>", "<|endoftext|", "x <|endoftext|>  ", "中文没有空格123", "é́ ñ ü ß", "😀 👩‍👩‍👧 !",
    "¼ ½ ² ٣ Ⅷ", " x　y z", "\x1c \x1f\x85 .", "՘x ꟎y ౜1 ⃁ \U00031350 a",
    "a" * 5000, "!" * 3000, " " * 3000, "x" * 20_000 + " y", "\U0001e4d0\U0001e4f0 new", "�﻿",
]


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(bpe.VOCABULARY)


@pytest.mark.parametrize("part", [3, bpe.PART])
def test_ids_as_the_library(spark, library, monkeypatch, part):
    monkeypatch.setattr(bpe, "PART", part)
    texts = STRANGE + [prose(i) for i in range(30)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    for size in (100, bpe.CHUNK):
        encoded = bpe.encode(docs, size=size)
        got = {r["doc_id"]: r["ids"] for r in encoded.ids().collect()}
        want = [library.encode(t, add_special_tokens=False).ids for t in texts]
        assert [got[i] for i in range(len(texts))] == want
        back = {r["doc_id"]: r["text"] for r in bpe.decode(encoded).collect()}
        assert [back[i] for i in range(len(texts))] == [
            library.decode(ids, skip_special_tokens=False) for ids in want]


SPLITTER = bpe.Splitter(bpe.VOCABULARY)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from([*"ab1 \n\t'!é中՘　", "'s", "  ", "<|endoftext|>", "😀"]), max_size=12))
def test_words_as_the_library(parts):
    text = "".join(parts)
    from tokenizers import Tokenizer

    known = bpe._tokenizer(bpe.VOCABULARY)
    assert isinstance(known, Tokenizer)
    coder = bpe.Coder(SPLITTER)
    coder.add(0, text)
    parts, words = coder.rows()
    listed = [words[i] for _, _, places in parts for i in bpe.unpacked(places)]
    assert "".join(listed) == text
    ids = [i for w in listed for i in known.encode(w, add_special_tokens=False).ids]
    assert ids == known.encode(text, add_special_tokens=False).ids


def test_digests_of_odd_documents(spark, odd_docs, no_docs, library, tmp_path):
    odd_docs.write.parquet(str(tmp_path / "documents.parquet"))
    rows = queries.QUERIES["op13_bpe"](spark, str(tmp_path)).collect()
    want = []
    for r in odd_docs.collect():
        ids = library.encode(r["text"] or "", add_special_tokens=False).ids
        want.append((r["doc_id"], len(ids), sha(",".join(map(str, ids))), sha(r["text"] or "")))
    assert sorted(map(repr, map(tuple, rows))) == sorted(map(repr, want))
    empty = bpe.encode(no_docs)
    assert empty.ids().count() == bpe.decode(empty).count() == bpe.digests(empty).count() == 0


def test_decoding_given_ids(spark, library):
    lists = [[], None, [220, 50256, 11], [159], [161, 47], [50256] * 3, [7, 7, 999_999, 8], [50257], [7, -1, 8], [7, None, 8]]
    table = spark.createDataFrame(list(enumerate(lists)), "doc_id long, ids array<int>")
    for size in (1, bpe.CHUNK):
        got = {r["doc_id"]: r["text"] for r in bpe.decode(bpe.encoded_ids(table, size=size)).collect()}
        for i, ids in enumerate(lists):
            known = [i for i in ids or [] if i is not None and i >= 0]
            assert got[i] == library.decode(known, skip_special_tokens=False)


def test_other_vocabularies_are_refused():
    with pytest.raises(ValueError):
        bpe.Splitter("/opt/tokenizers/word_bpe_49k.json")


def test_nothing_is_shuffled_by_document(spark):
    docs = spark.createDataFrame([(i, prose(i)) for i in range(20)], "doc_id long, text string")
    encoded = bpe.encode(docs)
    plan = encoded.ids()._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan.replace("BroadcastExchange", "")
