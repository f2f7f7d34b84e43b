"""Secret scan: fixed patterns, and guess costs of values in a credential context."""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from logforge.llm.common import free, process_cache, text_udf, whole_text

KINDS = ("assign", "access", "hex", "guess")
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    re.IGNORECASE | re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
HEX = re.compile(r"[0-9a-f]{24,}")
#: Words that announce a credential; the value may hold any signs but blanks and quotes.
CONTEXT_WORDS = (
    "password", "passwd", "passphrase", "passcode", "pwd", "secret", "token", "apikey", "api_key",
    "api-key", "credential", "private_key", "access_key", "auth_key", "bearer")
#: Any of these is in a text that holds an announcement.
MARKS = ("pass", "pwd", "secret", "token", "api", "credential", "_key", "bearer", "phrase", "mnemonic")
_NAMES = "(?:" + "|".join(CONTEXT_WORDS) + "|(?<![A-Za-z])pass(?![A-Za-z]))"
# Names may go on (client_secret_key, credentials) and be quoted.
_NAMED = _NAMES + r"(?:[_-]?(?:keys?|pass|value|string|text|hash))*s?[\"'`]?"
_SIGN = r"(?:[\x20\t]*(?:=>|->|:=|[:=\uff1a])[\x20\t]*)"
# A blank alone announces a value after bearer, unless another announcement follows.
CONTEXT = re.compile(
    _NAMED + "(?:" + _SIGN + r"|[\x20\t]+is[\x20\t]+"
    r"|(?<=bearer)[\x20\t]+(?!" + _NAMED + "(?:" + _SIGN + r"|[\x20\t]+is[\x20\t])))[\"'`]?"
    r"([^\s\"'`<>,;]+)", re.IGNORECASE | re.ASCII)
#: A phrase: what stands in quotes, or up to PHRASE_WORDS words that fill the rest of a line.
PHRASE_WORDS = 8
PHRASE = re.compile(
    r"(?:pass[_-]?phrase|mnemonic|seed[_-]phrase)s?[\"'`]?" + _SIGN + r"""(?:"([^"\n]+)"|'([^'\n]+)'|`([^`\n]+)`"""
    rf"""|([^\s"'`]+(?:[\x20\t]+[^\s"'`]+){{1,{PHRASE_WORDS - 1}}})(?=[\x20\t]*(?:\r?\n|$)))""", re.IGNORECASE | re.ASCII)
#: Words of the language of the documents: the WORDS most frequent ones in WORD_DOCS documents or more.
WORDS = 100_000
WORD_DOCS = 3
SHORTEST, LONGEST = 4, 20
#: A value that takes at least 10 to this power guesses is a secret.
STRONG = 9.0
REMEMBERED = 1 << 14

# Frequent words in passwords, most frequent first, and the rows of a keyboard.
COMMON = (
    "password pass love admin qwerty welcome monkey dragon master letmein login princess sunshine "
    "shadow hello football baseball superman batman trust secret summer winter spring autumn "
    "flower freedom whatever michael jordan george charlie thomas robert daniel andrew joshua "
    "hunter soccer hockey killer pepper ginger cookie cheese banana orange purple silver golden "
    "diamond computer internet server database user root test guest default changeme example "
    "sample token key access private public demo temp manager service system").split()
ROWS = ("`1234567890-=", "qwertyuiop[]", "asdfghjkl;'", "zxcvbnm,./")
LEET = str.maketrans("01345$@7!", "oleassati")

RANK = {word: i + 1 for i, word in enumerate(COMMON)}
SPOT = {key: (y, x) for y, row in enumerate(ROWS) for x, key in enumerate(row)}
DATE = re.compile(
    r"(?:19|20)\d\d(?:([-/._]?)(?:0[1-9]|1[0-2])\1(?:0[1-9]|[12]\d|3[01]))?"
    r"|(?:0[1-9]|[12]\d|3[01])([-/._]?)(?:0[1-9]|1[0-2])\2(?:(?:19|20)\d\d)")
RUN = re.compile(r"(.{1,16}?)\1+", re.DOTALL)
LETTERS = re.compile(r"[^\W\d_]{4,}")
NO_WORDS: frozenset[str] = frozenset()


def _brute(text: str) -> float:
    """Log10 guesses of one sign at a time, by the alphabet that the text draws from."""
    if re.fullmatch(r"[0-9a-f]+|[0-9A-F]+", text):
        size = 10 if text.isdigit() else 16
    else:
        size = 10 * any(c.isdigit() for c in text) + 26 * any(c.islower() for c in text)
        size += 26 * any(c.isupper() for c in text) + 33 * any(not c.isalnum() for c in text)
    return math.log10(max(size, 2))


def _near(a: str, b: str) -> bool:
    p, q = SPOT.get(a), SPOT.get(b)
    return bool(p and q and p != q and abs(p[0] - q[0]) <= 1 and abs(p[1] - q[1]) <= 1)


def _word_cost(text: str, words: frozenset[str]) -> float | None:
    """Log10 guesses of a listed word in one of its usual cases; None for other texts."""
    usual = text in (text.lower(), text.upper(), text.title())
    return math.log10(WORDS) if usual and text.lower() in words else None


def _candidates(value: str, words: frozenset[str] = NO_WORDS) -> list[tuple[int, int, float]]:
    """Segments (begin, end, log10 guesses) other than brute force."""
    low, out = value.lower(), []
    plain = low.translate(LEET)
    for word, rank in RANK.items():
        if len(word) < 3:
            continue
        for shown, extra in ((low, 0.0), (plain, 0.7)):
            at = shown.find(word)
            while at >= 0:
                part = value[at : at + len(word)]
                cased = 0.0 if part in (part.lower(), part.upper(), part.title()) else 1.0
                out.append((at, at + len(word), math.log10(rank + 1) + extra + cased))
                at = shown.find(word, at + 1)
    for found in DATE.finditer(value):
        begin, end = found.span()
        out.append((begin, end, 2.1 if end - begin == 4 else 4.7))
    for found in LETTERS.finditer(value) if words else ():
        for begin in range(found.start(), found.end() - SHORTEST + 1):
            for end in range(begin + SHORTEST, min(begin + LONGEST, found.end()) + 1):
                cost = _word_cost(value[begin:end], words)
                if cost is not None:
                    out.append((begin, end, cost))
    for found in RUN.finditer(value):
        begin, end = found.span()
        unit = found.group(1)
        if end - begin >= 3:
            cost = _brute(unit) * len(unit)
            listed = _word_cost(unit, words)
            cost = cost if listed is None else min(cost, listed)
            out.append((begin, end, cost + math.log10((end - begin) / len(unit))))
    begin = 0
    for i in range(1, len(low) + 1):
        if i == len(low) or not _near(low[i - 1], low[i]):
            if i - begin >= 3:
                turns = sum(
                    (SPOT[low[k]][0] - SPOT[low[k - 1]][0], SPOT[low[k]][1] - SPOT[low[k - 1]][1])
                    != (SPOT[low[k - 1]][0] - SPOT[low[k - 2]][0],
                        SPOT[low[k - 1]][1] - SPOT[low[k - 2]][1])
                    for k in range(begin + 2, i))
                out.append((begin, i, math.log10(47 * (i - begin)) + 0.9 * (turns + 1)))
            begin = i
    return out


def guesses(value: str, words: frozenset[str] = NO_WORDS) -> float:
    """Log10 of the guesses for the cheapest segmentation of ``value``.

    best[j] is the least cost of value[:j]: it ends in a word (a frequent one of passwords, or
    one of ``words``), a date, a repeat or a keyboard walk, or in one more sign of brute force. Each segment that is not brute force costs
    log10(2) more, for the choice among kinds. The search is linear in the value's length
    and in the number of segments. Costs of values seen are remembered by the process.
    """
    cache = process_cache("guesses")
    if cache.get("words") is not words:
        cache.clear()
        cache.update(words=words, known={})
    known = cache["known"]
    if value in known:
        return known[value]
    ending: dict[int, list[tuple[int, float]]] = {}
    for begin, end, cost in _candidates(value, words):
        ending.setdefault(end, []).append((begin, cost + 0.3))
    sign = _brute(value) if value else 0.0
    best = [0.0]
    for j in range(1, len(value) + 1):
        least = best[j - 1] + sign
        for begin, cost in ending.get(j, ()):
            least = min(least, best[begin] + cost)
        best.append(least)
    if len(known) < REMEMBERED and len(value) < 256:
        known[value] = best[-1]
    return best[-1]


Span = tuple[int, int, int]


def _base(text: str, low: str) -> list[Span]:
    """(start, kind, end) of the fixed patterns, by start, then kind."""
    spans = []
    if any(k in low for k in ("passw", "secret", "token", "api")):
        for m in ASSIGN.finditer(text):
            if m.end(2) - m.start(2) >= 6:
                spans.append((m.start(), 0, m.end()))
    if "AKIA" in text:
        spans += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text)]
    spans += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(spans)


def scan(text: str, words: frozenset[str] = NO_WORDS) -> tuple[list[Span], list[Span], float]:
    """Base spans; guessed spans that no base span contains; the highest guess cost."""
    low = text.lower()
    base, found, most = _base(text, low), [], 0.0
    if any(k in low for k in MARKS):
        found = [m.span(1) for m in CONTEXT.finditer(text)]
        if "phrase" in low or "mnemonic" in low:
            phrases = [m.span(m.lastindex) for m in PHRASE.finditer(text)]
            # A phrase takes the place of its first word.
            found = sorted(phrases + [f for f in found if not any(b <= f[0] and f[1] <= e for b, e in phrases)])
    more = []
    for begin, end in found:
        cost = guesses(text[begin:end], words)
        most = max(most, cost)
        if cost >= STRONG and not any(s <= begin and end <= e for s, _, e in base):
            more.append((begin, 3, end))
    return base, more, most


def _text(spans: list[Span]) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in spans)


FOUND = T.StructType([
    T.StructField("n_assign", T.LongType()), T.StructField("n_access", T.LongType()),
    T.StructField("n_hex", T.LongType()), T.StructField("n_guess", T.LongType()),
    T.StructField("base_sha256", T.StringType()), T.StructField("spans", T.StringType()),
    T.StructField("log10_guesses", T.DoubleType())])


def _found(texts: list[str], words: frozenset[str]) -> pa.Array:
    columns = [[] for _ in FOUND.fields]
    for text in texts:
        base, more, most = scan(text, words)
        counts = [sum(k == kind for _, k, _ in base) for kind in range(3)]
        digest = hashlib.sha256(_text(base).encode()).hexdigest()
        row = [*counts, len(more), digest, _text(sorted(base + more)), most]
        for column, value in zip(columns, row):
            column.append(value)
    kinds = [pa.int64()] * 4 + [pa.string()] * 2 + [pa.float64()]
    return pa.StructArray.from_arrays(
        [pa.array(c, k) for c, k in zip(columns, kinds)], FOUND.fieldNames())


def _redacted(texts: list[str], words: frozenset[str]) -> pa.Array:
    out = []
    for text in texts:
        base, more, _ = scan(text, words)
        parts, at = [], 0
        for begin, _, end in sorted(base + more):
            if end <= at:
                continue
            if begin >= at:
                parts += [text[at:begin], "[SECRET]"]
            at = end
        out.append("".join(parts) + text[at:])
    return pa.array(out, pa.string())


def words_of(text: str) -> set[str]:
    """Words of a text in one of their usual cases, as lower case, without values of credentials."""
    low = text.lower()
    if any(k in low for k in MARKS):
        text = CONTEXT.sub(" ", text)
    return {
        w.lower() for w in set(LETTERS.findall(text))
        if len(w) <= LONGEST and w in (w.lower(), w.upper(), w.title())}


def frequent_words(docs: DataFrame) -> frozenset[str]:
    """The WORDS words in most documents of all ``docs``, of those in WORD_DOCS or more."""

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter[str] = Counter()

        def table() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())],
                ["word", "n"])

        for batch in batches:
            for text in batch.column("text").to_pylist():
                counts.update(words_of(text))
                if len(counts) > REMEMBERED:
                    yield table()
                    counts.clear()
        yield table()

    counted = docs.select(whole_text().alias("text")).mapInArrow(emit, "word string, n long")
    top = counted.groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= WORD_DOCS)
    found = top.orderBy(F.desc("n"), "word").limit(WORDS).select("word").toArrow()
    return frozenset(found.column("word").to_pylist())


def _with_words(docs: DataFrame, per_batch: Callable[[list[str], frozenset[str]], pa.Array]):
    """``per_batch`` as a function of texts alone, with the frequent words of ``docs``."""
    shared = docs.sparkSession.sparkContext.broadcast(frequent_words(docs))
    return lambda texts: per_batch(texts, shared.value)


def find_secrets(docs: DataFrame) -> DataFrame:
    """doc_id and what was found in each whole text, a row for every row of ``docs``.

    Spans are code points of the text, end exclusive: of the whole match for the fixed
    patterns, of the value for ``guess``. Null texts count as empty and have no spans; rows
    that repeat are each scanned; other columns are ignored; an empty table gives no rows.
    """
    found = free(docs, "found")
    return docs.select("doc_id", text_udf(FOUND, _with_words(docs, _found))(whole_text()).alias(found)).select(
        "doc_id", f"{found}.*")


def redact(docs: DataFrame) -> DataFrame:
    """``docs`` with every span in ``text`` replaced by ``[SECRET]`` and n_chars, where there
    is such a column, counted anew. Overlapping spans give one mark. Null texts stay null."""
    clean = F.when(F.col("text").isNotNull(), text_udf(T.StringType(), _with_words(docs, _redacted))(whole_text()))
    columns = ["text" if c == "text" else c for c in docs.columns]
    if "n_chars" in columns:
        kind = docs.schema["n_chars"].dataType
        name = free(docs, "clean")
        docs = docs.select("*", clean.alias(name))
        return docs.select(*[
            F.col(name).alias("text") if c == "text"
            else F.coalesce(F.length(name), F.lit(0)).cast(kind).alias("n_chars") if c == "n_chars"
            else F.col(f"`{c}`") for c in columns])
    return docs.withColumn("text", clean)
