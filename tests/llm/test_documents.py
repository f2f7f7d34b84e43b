"""Document operators: odd inputs, and results against plain Python."""

import random
import re
from itertools import combinations

import duckdb
import numpy as np
import pytest
import xxhash

from logforge.llm import (
    hashed, mixing, packing, quality, secret_scan, simhash, spans, toxicity)
from logforge.llm.components import connected_components
from tests_llm_data import prose, sentence

COUNT = 12


def rows_of(df):
    return [r.asDict() for r in df.collect()]


# ---- odd inputs ------------------------------------------------------------------------------

def test_odd_simhash(odd_docs, no_docs):
    rows = rows_of(simhash.near_duplicates(odd_docs))
    assert len(rows) == COUNT
    by_id = {r["doc_id"]: r for r in rows if r["doc_id"] is not None}
    assert by_id[2]["component_id"] == 1 and by_id[3]["fp"] == by_id[4]["fp"] == 0
    assert by_id[5]["component_id"] == 3
    assert simhash.near_duplicates(no_docs).count() == 0
    kept = rows_of(simhash.keep_one(odd_docs))
    assert sorted(r["doc_id"] or 0 for r in kept) == [0, 1, 3, 6, 7, 8, 9]
    assert set(kept[0]) == set(odd_docs.columns)
    assert simhash.keep_one(no_docs).count() == 0


def test_odd_packing(odd_docs, no_docs):
    rows = rows_of(packing.pack(odd_docs, budget=8192, max_length=1024))
    lengths = {}
    for r in rows:
        lengths.setdefault(r["doc_id"], []).append(r["length"])
    assert lengths[3] == [0] and lengths[4] == [0]
    assert sum(lengths[8]) == packing.count_tokens(("long " + prose(9) + "\n") * 3000)
    assert len(lengths[6]) == 2
    assert packing.pack(no_docs).count() == 0


def test_odd_secrets(odd_docs, no_docs):
    assert secret_scan.find_secrets(odd_docs).count() == COUNT
    clean = secret_scan.redact(odd_docs)
    assert clean.columns == odd_docs.columns and clean.dtypes == odd_docs.dtypes
    assert sorted((r["doc_id"] or 0, r["text"] or "") for r in rows_of(clean)) == sorted(
        (r["doc_id"] or 0, r["text"] or "") for r in rows_of(odd_docs))
    assert secret_scan.find_secrets(no_docs).count() == secret_scan.redact(no_docs).count() == 0


@pytest.mark.parametrize("labelled", [True, False])
def test_odd_quality(odd_docs, no_docs, odd_labels, no_labels, labelled):
    ratings = quality.grades_of(odd_labels if labelled else no_labels)
    rows = rows_of(quality.rate(odd_docs, ratings))
    assert len(rows) == COUNT and all(0 <= r["tail_probability"] <= 1 for r in rows)
    assert quality.rate(no_docs, ratings).count() == 0


@pytest.mark.parametrize("labelled", [True, False])
def test_odd_toxicity(odd_docs, no_docs, odd_labels, no_labels, labelled):
    labels = odd_labels if labelled else no_labels
    rows = rows_of(toxicity.score(odd_docs, labels))
    assert len(rows) == COUNT and all(0 <= r["score"] <= 1 for r in rows)
    assert all(r["predicted"] == (r["score"] >= 0.7) for r in rows)
    assert toxicity.score(no_docs, labels).count() == 0


def test_odd_mixing(odd_docs, no_docs):
    rows = rows_of(mixing.mix(odd_docs))
    assert len(rows) == COUNT and all(0 <= r["weight"] <= 1 for r in rows)
    assert {r["topic"] for r in rows if r["doc_id"] in (3, 4, 5)} == {-1}
    assert mixing.mix(no_docs).count() == 0


def test_odd_spans(odd_docs, no_docs):
    rows = rows_of(spans.remove_repeats(odd_docs))
    assert len(rows) == COUNT
    by_id = {r["doc_id"]: r for r in rows if r["doc_id"]}
    assert by_id[2]["text"] == "" and by_id[2]["copied_from"] == [1]
    assert by_id[1]["text"] == prose(1) and by_id[9]["text"] == "x" * 700_000
    assert by_id[3]["text"] == "" and by_id[8]["n_removed"] > 1000
    assert spans.remove_repeats(no_docs).count() == 0


# ---- SimHash ---------------------------------------------------------------------------------

def plain_fingerprint(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text)
    words = re.findall(r"[^\x20\x09-\x0D]+", low)
    parts = [words[i : i + 3] for i in range(len(words) - 2)] or ([words] if words else [])
    hashes = [xxhash.xxh64_intdigest(" ".join(p).encode(), 42) for p in parts]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_fingerprints():
    for text in [prose(4), "É À one two three\x0bfour", "a", "a b", "", "A B a b A b", prose(8) * 40]:
        assert simhash.fingerprint_of(text) % 2**64 == plain_fingerprint(text)


@pytest.mark.parametrize("crowded", [512, 1])
def test_links_against_all_pairs(spark, monkeypatch, crowded):
    monkeypatch.setattr(simhash, "CROWDED", crowded)
    rng = random.Random(5)
    values = {0, -1, 1, 3, 7}
    for _ in range(60):
        base = rng.getrandbits(64)
        for _ in range(4):
            values.add((base ^ sum(1 << b for b in rng.sample(range(64), rng.randint(0, 3)))) - 2**63)
    values = [v for v in values if -(2**63) <= v < 2**63]
    wanted = {
        frozenset(p) for p in combinations(values, 2) if bin((p[0] ^ p[1]) % 2**64).count("1") <= 2}
    links = simhash._links(spark.createDataFrame([(v, 0) for v in values], "fp long, least_id long"))
    assert {frozenset((r["u"], r["v"])) for r in links.collect()} == wanted


def test_components_of_paths_and_stars(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 30)] + [(7, 7), (60, 50)]
    found = {r["node"]: r["root"] for r in connected_components(
        spark.createDataFrame(edges, "u long, v long")).collect()}
    assert found == {**{i: 0 for i in range(1, 41)}, **{100 + i: 100 for i in range(1, 30)}, 60: 50}


# ---- packing ---------------------------------------------------------------------------------

def padding(histogram, bounds):
    return sum(n * (min(b for b in bounds if b >= length) - length) for length, n in histogram.items())


def test_boundaries_against_all_choices():
    rng = random.Random(1)
    for _ in range(30):
        histogram = {rng.randint(1, 40): rng.randint(1, 9) for _ in range(rng.randint(1, 9))}
        k = rng.randint(1, 5)
        lengths = sorted(histogram)
        best = min(
            padding(histogram, [*some, lengths[-1]])
            for n in range(min(k, len(lengths))) for some in combinations(lengths[:-1], n))
        bounds = packing.best_boundaries(histogram, k)
        assert len(bounds) <= k and padding(histogram, bounds) == best


def test_batches_keep_the_budget(spark, monkeypatch):
    monkeypatch.setattr(packing, "CHUNK", 7)
    docs = spark.createDataFrame([(i, prose(i, 1 + i % 40)) for i in range(200)], "doc_id long, text string")
    rows = rows_of(packing.pack(docs, budget=1024, max_length=256, buckets=4))
    batches = {}
    for r in rows:
        assert r["length"] <= r["bucket"]
        batches.setdefault((r["bucket"], r["batch"]), []).append(r["slot"])
    sizes = {}
    for (bucket, batch), slots in batches.items():
        assert sorted(slots) == list(range(len(slots))) and bucket * len(slots) <= 1024
        sizes.setdefault(bucket, {})[batch] = len(slots)
    for bucket, found in sizes.items():
        assert sorted(found) == list(range(len(found)))
        assert all(found[b] == 1024 // bucket for b in range(len(found) - 1))
    total = {}
    for r in rows:
        total[r["doc_id"]] = total.get(r["doc_id"], 0) + r["length"]
    assert total == {i: packing.count_tokens(prose(i, 1 + i % 40)) for i in range(200)}


def test_token_counts():
    encode = packing._encoder(packing.VOCABULARY)[0]
    for text in ["", " ", "a  b", "x \n\n y\t z", "it's we'll", prose(2), "é  ü 日本 語", "  a b"]:
        assert packing.count_tokens(text) == len(encode(text))


# ---- secrets ---------------------------------------------------------------------------------

def test_base_spans():
    text = ('Token="abc_def" passwd = short api-key: x token: 12345 apikey:abcdef '
            + "AKIA" + "B" * 16 + " AKIASHORT " + "a" * 23 + " " + "0f" * 12)
    base, more, _ = secret_scan.scan(text)
    assert [(secret_scan.KINDS[k], text[s:e]) for s, k, e in base] == [
        ("assign", 'Token="abc_def'), ("assign", "apikey:abcdef"), ("access", "AKIA" + "B" * 16),
        ("hex", "0f" * 12)]
    assert secret_scan.scan("toKen = abcdefgh")[0] == []


def test_guess_costs():
    cost = secret_scan.guesses
    assert cost("password") < cost("password1999") < cost("password1999x$") < cost("kV7#pQz2!mRw")
    assert cost("qwertyuiop") < 5 and cost("aaaaaaaaaaaa") < 4 and cost("2021-03-04") < 6
    assert cost("kV7#pQz2!mRw") > secret_scan.STRONG > cost("changeme123")
    base, more, _ = secret_scan.scan("passphrase: kV7#pQz2!mRw and password: letmein")
    assert [k for _, k, _ in more] == [3] and len(base) == 1
    # Minimum over all segmentations, by recursion.
    for value in ["p@ssword12", "dragon1999qwe", "zzzab12"]:
        parts, sign = secret_scan._candidates(value), secret_scan._brute(value)

        def least(end):
            return 0.0 if end == 0 else min(
                [least(end - 1) + sign, *[least(b) + c + 0.3 for b, e, c in parts if e == end]])

        assert cost(value) == pytest.approx(least(len(value)))


def test_random_letters_are_secrets(spark):
    values = {
        "pwd=XkTrQwPzLmNvBhJd": 1, "passphrase: XkTrQwPz42": 1, "pwd:          kV7#pQz2!mRw": 1,
        "pwd          =          kV7#pQz2!mRw": 1, "Authorization: Bearer kV7#pQz2!mRw": 1,
        "bearer passcode: kV7#pQz2!mRw": 1, "pwd: XkTrQwPzXkTrQwPz": 1,
        "passphrase is responsibility": 0, "passphrase: responsibility1999": 0}
    prose = ["all the responsibility we have"] * 3
    docs = spark.createDataFrame(
        [(i, t) for i, t in enumerate([*values, *prose])], "doc_id long, text string")
    found = {r["doc_id"]: r["n_guess"] for r in rows_of(secret_scan.find_secrets(docs))}
    assert [found[i] for i in range(len(values))] == list(values.values())
    # Copies of a secret do not make a word of it.
    copies = spark.createDataFrame([(i, "pwd=xktrqwpzlmnvbhjd") for i in range(9)], "doc_id long, text string")
    assert {r["text"] for r in rows_of(secret_scan.redact(copies))} == {"pwd=[SECRET]"}


def test_redaction(spark):
    docs = spark.createDataFrame(
        [(1, 'a token = "0123456789abcdef0123456789abcdef" b', 5)], "doc_id long, text string, n_chars int")
    row = secret_scan.redact(docs).first()
    assert row["text"] == 'a [SECRET]" b' and row["n_chars"] == len(row["text"])


# ---- spans -----------------------------------------------------------------------------------

def test_passages_go_but_for_the_first(spark):
    passage = " ".join(sentence(900 + k, 11) for k in range(6))
    assert len(passage.split()) > 50
    docs = [(i, f"{prose(200 + i, 6)} {passage if i % 3 == 0 else ''}\n{prose(300 + i, 4)}") for i in range(12)]
    rows = {r["doc_id"]: r for r in rows_of(spans.remove_repeats(
        spark.createDataFrame(docs, "doc_id long, text string")))}
    left = {}
    for i, text in docs:
        if i % 3 == 0 and i:
            left[i] = len(set(sentence(900 + k, 11) for k in range(6) if sentence(900 + k, 11) in rows[i]["text"]))
            assert 0 in rows[i]["copied_from"]
    assert passage in rows[0]["text"] and all(n <= 1 for n in left.values())


@pytest.mark.parametrize("join", [" ", ""])
def test_any_shared_passage_holds_a_common_run(join):
    rng = random.Random(11)

    def words(n):
        return [f"w{rng.randrange(3000)}" if join else chr(0x4E00 + rng.randrange(3000)) for _ in range(n)]

    for _ in range(300):
        passage = words(51)
        texts = [join.join(words(rng.randint(5, 30)) + passage + words(9)) for _ in range(2)]
        one, two = ({tuple(h) for h in spans.Runs([t]).hashes.tolist()} for t in texts)
        assert one & two


def test_runs_do_not_depend_on_batches():
    texts = [prose(i, 15) + ("\n" if i % 2 else "") for i in range(9)] + ["", " \n", "word"]
    whole = spans.Runs(texts)
    for i, text in enumerate(texts):
        alone, mine = spans.Runs([text]), whole.owner[whole.begin] == i
        assert (whole.hashes[mine] == alone.hashes).all()
        assert (whole.start[whole.row == i] == alone.start).all()
        assert (alone.ends[alone.stop - 1] - alone.first[alone.begin] >= spans.WORDS).all()
        assert (alone.stop - alone.begin >= spans.SENTENCES).all()
        if len(alone.word) >= spans.WORDS and len(alone.first) >= spans.SENTENCES:
            assert alone.begin.min() == 0 and alone.stop.max() == len(alone.first)
    long = prose(1, 40) + " "
    many = spans.Runs([long * 400])
    assert len(many.word) == 400 * len(long.split())


# ---- models ----------------------------------------------------------------------------------

def test_ordinal_thresholds_and_accuracy():
    rng = np.random.default_rng(0)
    n, width = 3000, 12
    x = rng.random((n, width)) < 0.4
    truth = rng.normal(size=width)
    latent = x @ truth + rng.logistic(size=n) * 0.3
    grades = np.digitize(latent, np.quantile(latent, [0.3, 0.6, 0.9]))
    rows, columns = np.nonzero(x)
    weights, cuts = quality.fit_cumulative_link(
        rows, columns, np.ones(len(rows)), grades, 4, width)
    assert (np.diff(cuts) > 0).all()
    assert np.corrcoef(weights, truth)[0, 1] > 0.98
    assert (np.digitize(x @ weights, cuts) == grades).mean() > 0.7


def test_ordinal_gradient():
    rng = np.random.default_rng(3)
    x, grades = rng.normal(size=(40, 3)), rng.integers(0, 3, 40)
    rows, columns = np.nonzero(np.ones_like(x))
    weights, cuts = quality.fit_cumulative_link(
        rows, columns, x.ravel(), grades, 3, 3, penalty=0.01, steps=4000)

    def loss(w, c):
        edges = np.concatenate([[-np.inf], c, [np.inf]])
        z = x @ w
        low, high = edges[grades] - z, edges[grades + 1] - z
        return -np.log(1 / (1 + np.exp(-high)) - 1 / (1 + np.exp(-low))).mean() + 0.005 * w @ w

    best = loss(weights.astype(float), cuts)
    for _ in range(200):
        assert loss(weights + rng.normal(size=3) * 0.02, cuts + rng.normal(size=2) * 0.02) > best - 1e-6


def test_label_model_and_correlated_voters():
    rng = np.random.default_rng(2)
    n = 40_000
    y = rng.random(n) < 0.15
    bits = np.zeros((n, toxicity.VOTERS), bool)
    for v in range(6):
        bits[:, v] = np.where(y, rng.random(n) < 0.8, rng.random(n) < 0.05)
    bits[:, 6] = bits[:, 7] = bits[:, 8] = np.where(y, rng.random(n) < 0.6, rng.random(n) < 0.1)
    words = bits @ (1 << np.arange(toxicity.VOTERS))
    patterns, back = np.unique(words, return_inverse=True)
    counts = np.bincount(back)
    anchors = np.zeros((len(patterns), 2))
    np.add.at(anchors, (back[:1000], y[:1000].astype(int)), 1)
    model = toxicity.LabelModel(patterns, counts, anchors)
    assert [6, 7, 8] in model.cliques
    posterior = model.posterior[back]
    assert ((posterior >= 0.5) == y).mean() > 0.97
    for low, high in ((0.1, 0.4), (0.6, 0.9)):
        some = (posterior > low) & (posterior < high)
        if some.sum() > 200:
            assert abs(posterior[some].mean() - y[some].mean()) < 0.12


def test_hashed_features_do_not_depend_on_batches():
    texts = [prose(i, 5) for i in range(6)] + ["", "!?", "A1 b2", "Ünï côdé" * 3]
    together = {}
    for rows, buckets in hashed.lexical(texts):
        for row, bucket in zip(rows.tolist(), buckets.tolist()):
            together.setdefault(row, []).append(bucket)
    for i, text in enumerate(texts):
        alone = [b for _, buckets in hashed.lexical([text]) for b in buckets.tolist()]
        assert sorted(alone) == sorted(together.get(i, []))
    assert hashed.word_bucket("Sea") == hashed.word_bucket("sea") != hashed.word_bucket("seas")


# ---- mixing ----------------------------------------------------------------------------------

def test_raking_meets_margins():
    rng = np.random.default_rng(1)
    cells = rng.integers(50, 100, (4, 3, 2)).astype(float)
    targets = [np.array([1, 1, 1, 1]), np.array([2, 1, 1]), np.array([1, 2])]
    weights = mixing.rake(cells, targets, 0.4 * cells.sum())
    assert (weights <= cells + 1e-9).all()
    for axis, share in enumerate(targets):
        others = tuple(a for a in range(3) if a != axis)
        assert weights.sum(axis=others) / weights.sum() == pytest.approx(share / share.sum(), abs=1e-6)
    # An empty margin has no share; a full cell stays full.
    cells[0] = 0
    cells[1] = 1
    weights = mixing.rake(cells, targets, 0.5 * cells.sum())
    assert weights[0].sum() == 0 and weights[1].sum() <= 6 + 1e-9


def test_sample_follows_weights(spark):
    docs = spark.createDataFrame(
        [(i, prose(i % 50, 3), "en" if i % 4 else "fr", "big" if i % 3 else "small") for i in range(4000)],
        "doc_id long, text string, lang string, source string")
    rows = rows_of(mixing.mix(docs, source_targets={"big": 0.5, "small": 0.5}))
    tokens = {s: sum(r["tokens"] for r in rows if r["kept"] and r["source"] == s) for s in ("big", "small")}
    assert tokens["small"] / sum(tokens.values()) == pytest.approx(0.5, abs=0.04)
    wanted = sum(r["tokens"] * r["weight"] for r in rows)
    assert wanted == pytest.approx(0.5 * sum(r["tokens"] for r in rows), rel=0.02)
    assert sum(tokens.values()) == pytest.approx(wanted, rel=0.05)
    again = {r["doc_id"]: r["kept"] for r in rows_of(mixing.mix(docs.repartition(7), source_targets={
        "big": 0.5, "small": 0.5}))}
    assert again == {r["doc_id"]: r["kept"] for r in rows}


def many_sources(spark):
    rows = [(i, prose(i, 3), "en", f"s{i % 200:03d}") for i in range(1000)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")


def test_every_source_is_a_margin(spark):
    rows = rows_of(mixing.mix(many_sources(spark), topic_power=1.0))
    assert len({r["source"] for r in rows}) == 200
    by_source = {}
    for r in rows:
        a = by_source.setdefault(r["source"], [0, 0])
        a[0] += r["tokens"] * r["weight"]
        a[1] += r["tokens"]
    shares = [a / b for a, b in by_source.values()]
    assert min(shares) > 0.4 and max(shares) < 0.6


def test_target_of_any_source(spark):
    targets = {f"s{i:03d}": 1.0 for i in range(100, 200)}
    rows = rows_of(mixing.mix(many_sources(spark), keep=0.2, source_targets=targets))
    wanted = {r["source"] for r in rows if r["weight"] > 0}
    assert wanted == set(targets)
    with pytest.raises(ValueError, match="nowhere"):
        mixing.mix(many_sources(spark), source_targets={"s001": 1.0, "nowhere": 1.0})


def test_topics_rest_on_all_documents(spark):
    # Six texts in all; five of them are rare beside thousands of copies of the first.
    kinds = [" ".join(f"{w}{k}" for w in prose(k).split()) for k in range(6)]
    rows = [(i, kinds[max(i - 5000, 0)], "en", "s") for i in range(5006)]
    found = rows_of(mixing.mix(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")))
    topics = {r["text"]: r["topic"] for r in found}
    assert len(topics) == 6 and len(set(topics.values())) == 6


def test_raking_by_spark_and_by_the_driver(spark, monkeypatch):
    monkeypatch.setattr(mixing, "SWEEPS", 3)
    docs = many_sources(spark).limit(300)
    here = {r["doc_id"]: r["weight"] for r in rows_of(mixing.mix(docs, source_targets={"s001": 2.0, "s007": 1.0, "s009": 1.0}, keep=0.01))}
    monkeypatch.setattr(mixing, "DRIVER_CELLS", 0)
    there = {r["doc_id"]: r["weight"] for r in rows_of(mixing.mix(docs, source_targets={"s001": 2.0, "s007": 1.0, "s009": 1.0}, keep=0.01))}
    assert here == pytest.approx(there, abs=1e-9) and max(here.values()) > 0


# ---- the given tables ------------------------------------------------------------------------

FOLDER = "/root/testdata/sf0.01"


def test_held_out_accuracy(spark):
    from logforge.llm.queries import QUERIES

    labels = duckdb.sql(f"SELECT * FROM '{FOLDER}/labels.parquet'").df()
    rated = QUERIES["op9_quality"](spark, FOLDER).toPandas().merge(labels, on="doc_id")
    rated = rated[rated.held_out]
    assert ((rated.tail_probability >= 0.5) == (rated.quality == 1)).mean() > 0.93
    toxic = QUERIES["op4_toxicity"](spark, FOLDER).toPandas().merge(labels, on="doc_id")
    toxic = toxic[toxic.held_out]
    assert ((toxic.predicted == 1) == (toxic.toxic == 1)).mean() > 0.9


def test_later_occurrences_across_partitions(spark):
    """Groups that lie in one partition, go on in the next, or fill several."""
    import random

    rng = random.Random(6)
    rows = {(0, 5, d) for d in range(2000)} | {(7, 1, d) for d in range(300, 900)}
    rows |= {(rng.randint(-40, 40), rng.randint(0, 2), rng.randint(0, 50)) for _ in range(2500)}
    df = spark.createDataFrame(sorted(rows, key=lambda r: rng.random()), "h1 long, h2 long, doc long")
    first = {}
    for h1, h2, doc in rows:
        first[h1, h2] = min(doc, first.get((h1, h2), doc))
    want = sorted((h1, h2, doc, first[h1, h2]) for h1, h2, doc in rows if doc > first[h1, h2])
    kept = spark.conf.get("spark.sql.shuffle.partitions"), spark.conf.get("spark.sql.adaptive.enabled")
    try:
        for parts, adaptive in (("1", "true"), ("8", "true"), ("60", "false"), ("60", "true")):
            spark.conf.set("spark.sql.shuffle.partitions", parts)
            spark.conf.set("spark.sql.adaptive.enabled", adaptive)
            got = spans.later_occurrences(df).select("h1", "h2", "doc", "keeper").collect()
            assert sorted(map(tuple, got)) == want
            assert spans.later_occurrences(df.limit(0)).count() == 0
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", kept[0])
        spark.conf.set("spark.sql.adaptive.enabled", kept[1])


STRONG_VALUE = "Qx7kV9pZ2mRw4Tb"


@pytest.mark.parametrize("text, secret", [
    (f"pwd:\t{STRONG_VALUE}", STRONG_VALUE), (f"api-key\t=\t{STRONG_VALUE}", STRONG_VALUE),
    (f"client_secret_key = {STRONG_VALUE}", STRONG_VALUE), (f"secretkey={STRONG_VALUE}", STRONG_VALUE),
    (f"DB_PASS={STRONG_VALUE}", STRONG_VALUE), (f"password=>{STRONG_VALUE}", STRONG_VALUE),
    (f"credential -> {STRONG_VALUE}", STRONG_VALUE), (f"pwd\uff1a{STRONG_VALUE}", STRONG_VALUE),
    (f"credentials := '{STRONG_VALUE}'", STRONG_VALUE),
    ("passphrase: correct-horse battery staple", "correct-horse battery staple"),
    ('x passphrase = "tulip Anvil 93 orbit" y', "tulip Anvil 93 orbit"),
    ("mnemonic: zebra quilt oxygen jumble\nnext line", "zebra quilt oxygen jumble")])
def test_contexts_of_credentials(text, secret):
    base, more, _ = secret_scan.scan(text)
    assert any(text[s:e] == secret or secret in text[s:e] for s, _, e in base + more)
    assert secret not in secret_scan._redacted([text], frozenset()).to_pylist()[0]
    for word in secret.split():
        assert word not in secret_scan._redacted([text], frozenset()).to_pylist()[0]


@pytest.mark.parametrize("text", [
    "they pass: ten of twelve", "a long passage of text, and then some more of it", "the passphrase is kept in a safe place",
    "passphrase: see the page on how to choose one that nobody else would ever think of", "surpass -> everything"])
def test_prose_is_no_credential(text):
    base, more, _ = secret_scan.scan(text, frozenset(text.lower().split()) | {"everything"})
    assert not base and not more
