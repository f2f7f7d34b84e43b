"""Toxicity by weak supervision: voters, a generative label model, a linear classifier."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from logforge.llm import hashed
from logforge.llm.common import free, text_udf, whole_text
from logforge.llm.quality import held_out, lexical_counts, rated_sample
from logforge.session import staged

#: Labelled documents that lexicons are mined from and the label model is anchored by.
LABELLED = 12_000
#: Documents with posterior labels that the classifier is fitted on, of each kind.
LIKELY, UNLIKELY = 6_000, 8_000
TOXIC = 0.7
SEEN = 0.5

# Words that insult, degrade or threaten, and words that address someone.
INSULTS = (
    "idiot idiots moron morons stupid dumb dumbass imbecile fool loser losers clown jerk scum "
    "trash garbage bastard bitch asshole dickhead creep freak coward scumbag bigot pig rat swine")
DEGRADING = (
    "worthless pathetic disgusting useless filthy vile repulsive ugly despicable contemptible "
    "subhuman inferior laughable brainless spineless hideous revolting miserable rotten wretched")
THREATS = (
    "kill die hang shoot stab burn beat rape destroy exterminate eradicate slaughter lynch "
    "hurt punish smash crush choke strangle suffer")
ELSEWHERE = (
    "connard connasse salope abruti débile crétin ordure minable pourriture "
    "arschloch dummkopf trottel abschaum widerlich wertlos schwachkopf hurensohn drecksau "
    "estúpido estúpida imbécil basura asqueroso inútil cabrón gilipollas pendejo escoria")
SECOND_PERSON = "you your youre u ur tu vous toi du ihr dich sie tú usted ustedes vosotros eres"

HAND = (INSULTS, DEGRADING, THREATS, ELSEWHERE)
#: Words, and 4-, 5- and 6-grams: each kind of feature has its own quarter of the buckets.
KINDS = 1 + len(hashed.GRAMS)
VOTERS = 2 * KINDS + len(HAND) + 1
#: Bits of the vote word: mined strict and loose lexicons by kind, lists, attack pattern.
STRICT, LOOSE, LISTS, ATTACK = 0, KINDS, 2 * KINDS, 2 * KINDS + len(HAND)
SECOND = 15
LOOSE_HITS = 2


def surprise(sizes: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Log likelihood ratio of each feature's toxic share against the common share, in nats;
    negative where the feature is rarer in toxic documents than elsewhere."""
    n, toxic = counts.sum(axis=1), counts[:, 1]
    common = (sizes[1] + 0.5) / (sizes.sum() + 1)
    share = (toxic + 0.01) / (n + 0.02)
    gain = toxic * np.log(share / common) + (n - toxic) * np.log((1 - share) / (1 - common))
    return np.where(share >= common, gain, -gain)


def candidates(sample: DataFrame, least: float, share: float) -> np.ndarray:
    """Features of ``sample`` (text, grade) that are clearly commoner in toxic documents."""
    sizes, counts = lexical_counts(sample, 2)
    toxic = counts[:, 1] / np.maximum(counts.sum(axis=1), 1)
    return (surprise(sizes, counts) >= least) & (toxic >= share)


def present(sample: DataFrame, kept: np.ndarray, columns: str = "grade int") -> pa.Table:
    """The given columns of ``sample`` and ``buckets``, the kept features of each text."""
    names = [part.split()[0] for part in columns.split(", ")]

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text").to_pylist()
            rows, buckets = presence(texts, kept)
            offsets = np.searchsorted(rows, np.arange(len(texts) + 1)).astype(np.int32)
            lists = pa.ListArray.from_arrays(offsets, pa.array(buckets.astype(np.int32)))
            yield pa.RecordBatch.from_arrays([*[batch.column(n) for n in names], lists], [*names, "buckets"])

    return sample.select(*names, "text").mapInArrow(emit, columns + ", buckets array<int>").toArrow()


def flat(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """(rows, buckets) of the list column."""
    lists = table.column("buckets").combine_chunks()
    return np.repeat(np.arange(len(lists)), np.diff(lists.offsets.to_numpy())), lists.flatten().to_numpy()


def covering(rows: np.ndarray, buckets: np.ndarray, toxic: np.ndarray, times: int, least: float) -> np.ndarray:
    """Features chosen one by one: the most surprising one among toxic documents that are not
    yet covered ``times`` times by those chosen before.

    Copies of one toxic document share all its words; once its toxic ones cover them, its
    other words explain nothing more and are left out.
    """
    names, at = np.unique(buckets, return_inverse=True)
    clean = np.bincount(at, ~toxic[rows], len(names))
    sizes = np.array([(~toxic).sum(), toxic.sum()], float)
    left, chosen = np.where(toxic, times, 0), []
    by_feature = np.argsort(at, kind="stable")
    begins = np.searchsorted(at[by_feature], np.arange(len(names) + 1))
    open_ = np.ones(len(names), bool)
    while len(names):
        hits = np.bincount(at, left[rows] > 0, len(names))
        gain = np.where(open_, surprise(sizes, np.stack([clean, hits], 1)), -1.0)
        best = int(gain.argmax())
        if gain[best] < least:
            break
        chosen.append(names[best])
        open_[best] = False
        left[rows[by_feature[begins[best] : begins[best + 1]]]] -= 1
    return np.array(chosen, np.int64)


def mined_lexicons(sample: DataFrame) -> np.ndarray:
    """Bit masks over buckets: the lexicons of all voters.

    For each kind of feature two lexicons are mined from the labelled sample, by ``covering``:
    a strict one, whose features no chance among all buckets explains, and a loose one.
    """
    masks = np.zeros(hashed.LEXICAL, np.uint16)
    table = present(sample, candidates(sample, 8, 0.5))
    toxic = table.column("grade").to_numpy() == 1
    rows, buckets = flat(table)
    for k in range(KINDS):
        mine = buckets >> (hashed.LEXICAL_BITS - 2) == k
        masks[covering(rows[mine], buckets[mine], toxic, 5, 14)] |= np.uint16(1 << (STRICT + k))
        masks[covering(rows[mine], buckets[mine], toxic, 8, 10)] |= np.uint16(1 << (LOOSE + k))
    for i, words in enumerate(HAND):
        for word in words.split():
            masks[hashed.word_bucket(word)] |= np.uint16(1 << (LISTS + i))
    for word in SECOND_PERSON.split():
        masks[hashed.word_bucket(word)] |= np.uint16(1 << SECOND)
    return masks


def votes(texts: list[str], masks: np.ndarray) -> np.ndarray:
    """One word of votes per text: a bit for each voter that calls it toxic."""
    out = np.zeros(len(texts), np.uint16)
    loose = np.zeros((KINDS, len(texts)), np.int64)
    hand = np.uint16(sum(1 << (LISTS + i) for i in range(3)))
    loose_bits = np.uint16(((1 << KINDS) - 1) << LOOSE)
    for rows, buckets in hashed.lexical(texts):
        bits = masks[buckets]
        hit = np.flatnonzero(bits)
        rows, bits = rows[hit], bits[hit]
        np.bitwise_or.at(out, rows, bits & ~loose_bits & np.uint16((1 << SECOND) - 1))
        for kind in range(KINDS):
            loose[kind] += np.bincount(rows[(bits >> (LOOSE + kind)) & 1 > 0], minlength=len(texts))
        # An address at most four words before an insult or threat.
        for step in range(1, 5):
            near = (rows[step:] == rows[:-step]) & (hit[step:] - hit[:-step] <= 4)
            attack = near & (bits[:-step] >> SECOND > 0) & (bits[step:] & hand > 0)
            out[rows[step:][attack]] |= np.uint16(1 << ATTACK)
    for kind in range(KINDS):
        out[loose[kind] >= LOOSE_HITS] |= np.uint16(1 << (LOOSE + kind))
    return out


class LabelModel:
    """Generative model of votes: P(y), and a table P(votes of a clique | y) per clique.

    Voters that stay correlated given the label are put into one clique (of four at most)
    with a joint table, so agreeing for a common reason does not count twice; a clique of
    one voter has its plain accuracies. Parameters come from expectation maximisation over
    all documents' vote patterns, anchored by the patterns of the labelled sample.
    """

    def __init__(self, patterns: np.ndarray, counts: np.ndarray, anchors: np.ndarray):
        """``anchors``: (patterns, 2) labelled documents per pattern and label."""
        self.bits = (patterns[:, None] >> np.arange(VOTERS)) & 1
        self.counts = counts.astype(float)
        known = anchors.sum()
        # Labelled documents weigh half as much as all documents together.
        self.anchors = anchors * (0.5 * counts.sum() / known if known else 0.0)
        self.cliques = [[v] for v in range(VOTERS)]
        toxic = np.clip((anchors[:, 1] + 0.05) / (anchors.sum(axis=1) + 1.0), 0.001, 0.999)
        hits = self.bits[:, : ATTACK + 1].sum(axis=1)
        start = np.where(anchors.sum(axis=1) > 0, toxic, 1 / (1 + np.exp(3.0 - 1.5 * hits)))
        self.posterior = self._iterate(start)
        self.cliques = self._correlated()
        self.posterior = self._iterate(self.posterior)

    def _iterate(self, toxic: np.ndarray, rounds: int = 50) -> np.ndarray:
        for _ in range(rounds):
            mass = np.stack([self.counts * (1 - toxic), self.counts * toxic], 1) + self.anchors
            share = (mass.sum(axis=0) + 1) / (mass.sum() + 2)
            log = np.log(share)[None, :].repeat(len(toxic), 0)
            for clique in self.cliques:
                state = self.bits[:, clique] @ (1 << np.arange(len(clique)))
                size = 1 << len(clique)
                for y in range(2):
                    seen = np.bincount(state, mass[:, y], size)
                    log[:, y] += np.log((seen + 0.5 / size) / (seen.sum() + 0.5))[state]
            after = 1 / (1 + np.exp(np.clip(log[:, 0] - log[:, 1], -40, 40)))
            if np.abs(after - toxic).max(initial=0) < 1e-6:
                break
            toxic = after
        return toxic

    def _correlated(self, least: float = 0.1, most: int = 4) -> list[list[int]]:
        """Cliques by the strongest correlations given the label, largest first."""
        strength = np.zeros((VOTERS, VOTERS))
        for weight in (self.counts * (1 - self.posterior), self.counts * self.posterior):
            total = max(weight.sum(), 1e-9)
            off = self.bits - (weight @ self.bits) / total
            cov = (off * weight[:, None]).T @ off / total
            spread = np.sqrt(np.maximum(np.diag(cov), 1e-12))
            corr = np.abs(cov / np.outer(spread, spread)) * (np.minimum.outer(spread, spread) > 1e-3)
            strength = np.maximum(strength, corr)
        group = list(range(VOTERS))
        pairs = [(strength[i, j], i, j) for i in range(VOTERS) for j in range(i)]
        for value, i, j in sorted(pairs, reverse=True):
            if value < least:
                break
            merged = [v for v in range(VOTERS) if group[v] in (group[i], group[j])]
            if group[i] != group[j] and len(merged) <= most:
                for v in merged:
                    group[v] = min(merged)
        return [[v for v in range(VOTERS) if group[v] == g] for g in sorted(set(group))]


def fit_logistic(rows, columns, targets, weights, width: int, penalty=3e-6, steps: int = 400):
    """Weights of present features and a bias for soft targets, by gradient steps (Adam).

    Each step sees a random share SEEN of the features of each document, so that a document
    that has one of them alone is told too.
    """
    rng = np.random.default_rng(4)
    n = len(targets)
    used, at = np.unique(columns, return_inverse=True)
    weights = weights / max(weights.sum(), 1e-9)
    base = float(np.clip(weights @ targets, 1e-6, 1 - 1e-6)) if n else 0.1
    theta = np.zeros(len(used) + 1)
    theta[-1] = np.log(base / (1 - base))
    first, second = np.zeros_like(theta), np.zeros_like(theta)
    for step in range(1, steps + 1):
        seen = rng.random(len(rows)) < SEEN
        z = np.bincount(rows, theta[at] * seen, n) + theta[-1]
        pull = weights * (1 / (1 + np.exp(-np.clip(z, -40, 40))) - targets)
        slope = np.append(np.bincount(at, pull[rows] * seen, len(used)) + penalty * theta[:-1], pull.sum())
        first = 0.9 * first + 0.1 * slope
        second = 0.999 * second + 0.001 * slope**2
        rate = 0.1 * min(1.0, 2 * (1 - step / (steps + 1)))
        theta -= rate * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.999**step)) + 1e-10)
    out = np.zeros(width, np.float32)
    out[used] = theta[:-1]
    return out, float(theta[-1])


def presence(texts: list[str], kept: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(rows, buckets) of the kept features, each once per text."""
    keys = [np.zeros(0, np.int64)]
    for rows, buckets in hashed.lexical(texts):
        hit = kept[buckets]
        keys.append(np.unique(rows[hit].astype(np.int64) * hashed.LEXICAL + buckets[hit]))
    whole = np.unique(np.concatenate(keys))
    return whole // hashed.LEXICAL, whole % hashed.LEXICAL


def score(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``docs`` with held_out, score (0 to 1, higher: more likely toxic) and predicted.

    ``labels`` has doc_id and toxic (0 or 1); held-out ids are never learned from. Scores
    depend on the text alone. Vote patterns are counted over all documents; lexicons, anchors
    and the classifier use bounded samples (LABELLED, LIKELY, UNLIKELY) chosen by hashes of
    ids. Null and empty texts have no features and get the base score. Columns named as the
    added ones are replaced; rows that repeat get equal scores; an empty table gives no rows.
    """
    spark = docs.sparkSession
    ratings = labels.select("doc_id", F.col("toxic").cast("int").alias("grade"))
    sample = rated_sample(docs, ratings.filter("grade in (0, 1)"), LABELLED)
    masks = spark.sparkContext.broadcast(mined_lexicons(sample))

    def vote(texts: list[str]) -> pa.Array:
        out = np.zeros(len(texts), np.int32)
        for at in range(0, len(texts), 256):
            out[at : at + 256] = votes(texts[at : at + 256], masks.value)
        return pa.array(out)

    voted = text_udf(T.IntegerType(), vote)
    cast = staged(docs.select(
        "doc_id", F.xxhash64("doc_id", F.lit(4)).alias("mix"), voted(whole_text()).alias("votes")), "votes")
    # At most 2 ** VOTERS patterns, whatever the data.
    counted = cast.groupBy("votes").count().toArrow().sort_by("votes")
    patterns = counted.column("votes").to_numpy().astype(np.int64)
    counts = counted.column("count").to_numpy().astype(float)
    anchors = np.zeros((len(patterns), 2))
    for row in sample.select(voted("text").alias("votes"), "grade").groupBy("votes", "grade").count().collect():
        at = np.searchsorted(patterns, row["votes"])
        if at < len(patterns) and patterns[at] == row["votes"]:
            anchors[at, row["grade"]] += row["count"]
    model = LabelModel(patterns, counts, anchors)

    table = spark.createDataFrame(
        [(int(p), float(y)) for p, y in zip(patterns, model.posterior)], "of int, toxic double")
    judged = cast.filter(~held_out(F.col("doc_id")) & F.col("doc_id").isNotNull()).join(
        F.broadcast(table), F.col("votes") == F.col("of"))

    def some(which, size: int) -> DataFrame:
        ids = judged.filter(which).groupBy("doc_id").agg(F.max("mix").alias("mix"), F.max("toxic").alias("toxic"))
        total = ids.count()
        weight = max(total / size, 1.0)
        return ids.orderBy("mix", "doc_id").limit(size).select("doc_id", "toxic", F.lit(weight).alias("w"))

    chosen = staged(some(F.col("toxic") >= 0.5, LIKELY).union(some(F.col("toxic") < 0.5, UNLIKELY)), "chosen")
    chosen = chosen.groupBy(F.col("doc_id").alias("chosen_id")).agg(
        F.max("toxic").alias("toxic"), F.max("w").alias("w"))
    # At most LIKELY + UNLIKELY ids.
    texts = docs.select("doc_id", whole_text().alias("text")).join(
        F.broadcast(chosen), F.col("doc_id") == F.col("chosen_id"))
    texts = staged(texts.groupBy("doc_id", "toxic", "w").agg(F.min("text").alias("text")), "chosen_texts")
    marked = texts.select("text", "toxic", "w", (F.col("toxic") >= 0.5).cast("int").alias("grade"))
    fitted = present(marked, candidates(marked, 8, 0.6), "toxic double, w double")
    targets = fitted.column("toxic").to_numpy()
    rows, buckets = flat(fitted)
    used = np.isin(buckets, covering(rows, buckets, targets >= 0.5, 12, 10))
    weights, bias = fit_logistic(
        rows[used], buckets[used], targets, fitted.column("w").to_numpy(), hashed.LEXICAL)
    linear = spark.sparkContext.broadcast(weights)

    def rate(texts: list[str]) -> pa.Array:
        out = np.zeros(len(texts))
        used = linear.value != 0
        for at in range(0, len(texts), 256):
            rows, buckets = presence(texts[at : at + 256], used)
            out[at : at + 256] = np.bincount(rows, linear.value[buckets], len(texts[at : at + 256]))
        return pa.array(1 / (1 + np.exp(-np.clip(out + bias, -40, 40))))

    name = free(docs, "rated")
    rated = docs.select("*", text_udf(T.DoubleType(), rate)(whole_text()).alias(name))
    return rated.withColumns({
        "held_out": held_out(F.col("doc_id")), "score": F.col(name),
        "predicted": F.when(F.col(name) >= TOXIC, 1).otherwise(0)}).drop(name)
