"""The registered queries of this package and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from logforge.llm import (
    ann,
    bpe,
    chat,
    exact_topk,
    fim,
    mixing,
    packing,
    quality,
    secret_scan,
    simhash,
    spans,
    toxicity,
    whitening,
)
from logforge.session import configure

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(table: str, sql: str | None = None):
    """Register a function of one table (a DataFrame) and the folder."""

    def add(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            configure(spark)
            return fn(spark.read.parquet(f"{sf_dir}/{table}.parquet"), sf_dir)

        run.__doc__ = fn.__doc__
        QUERIES[fn.__name__] = run
        if sql is not None:
            ORACLES[fn.__name__] = sql
        return fn

    return add


@query("documents")
def op10_simhash(docs: DataFrame, sf_dir: str) -> DataFrame:
    """Fingerprint and component of every document."""
    found = simhash.near_duplicates(docs)
    return found.select(
        "doc_id", simhash.fingerprint_text(F.col("fp")).alias("fingerprint"), "component_id")


def beside(sf_dir: str, table: str) -> DataFrame:
    """Another table of the same folder."""
    return SparkSession.active().read.parquet(f"{sf_dir}/{table}.parquet")


@query("documents")
def op1_packing(docs: DataFrame, sf_dir: str) -> DataFrame:
    """Length buckets and token-budget batches over all documents."""
    return packing.pack(docs)


@query("documents")
def op6_secret_scan(docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets in every whole text."""
    return secret_scan.find_secrets(docs).select(
        "doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans", "n_guess",
        "log10_guesses")


@query("documents")
def op9_quality(docs: DataFrame, sf_dir: str) -> DataFrame:
    """Expected grade and tail probabilities of every document."""
    ratings = quality.grades_of(beside(sf_dir, "labels"))
    return quality.rate(docs.select("doc_id", "text"), ratings).select(
        "doc_id", quality.held_out(F.col("doc_id")).alias("held_out"), "expected_grade",
        "tail_probability", "top_probability", "keep")


@query("documents")
def op5_mixing(docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cell, calibrated probability and decision of every document."""
    return mixing.mix(docs.select("doc_id", "text", "lang", "source")).select(
        "doc_id", "source", "lang", "topic", "tokens", "weight", "kept")


@query("embeddings", sql="""
WITH flat AS (
  SELECT vec_id, [CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT) for x in embedding] AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len([x for x in embedding if x IS NULL OR NOT isfinite(x)]) = 0
),
pairs AS (
  SELECT q.vec_id AS query_id, c.vec_id,
         CAST(list_dot_product(CAST(q.v AS DOUBLE[]), CAST(c.v AS DOUBLE[])) AS BIGINT) AS score
  FROM flat q JOIN flat c ON q.vec_id % 100 = 0 AND c.vec_id <> q.vec_id
),
placed AS (
  SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)
         AS INTEGER) AS rank, vec_id, score
  FROM pairs
)
SELECT * FROM placed WHERE rank <= 10
""")
def op3_exact_topk(table: DataFrame, sf_dir: str) -> DataFrame:
    """The ten highest integer inner products of every hundredth vector."""
    return exact_topk.exact_top_k(table, every=100, k=10)


CONTROLS = "</s>[INST] ok [/INST]"


@query("conversations")
def op7_chat_format(table: DataFrame, sf_dir: str) -> DataFrame:
    """Digests of all formatted conversations and of one, -1, full of control strings."""
    own = table.sparkSession.range(2).select(
        F.lit(-1).cast("long").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit(CONTROLS).alias("text"))
    rows = table.select(
        F.col("conv_id").cast("long"), F.col("turn").cast("long"), "role", "text").unionByName(own)
    return chat.read_back(chat.format_conversations(rows))


@query("embeddings")
def op8_ann(table: DataFrame, sf_dir: str) -> DataFrame:
    """The twenty nearest found for every twentieth vector."""
    return ann.nearest(table, every=20, k=20)


@query("documents")
def op4_toxicity(docs: DataFrame, sf_dir: str) -> DataFrame:
    """Toxicity score and decision of every document."""
    return toxicity.score(docs.select("doc_id", "text"), beside(sf_dir, "labels")).select(
        "doc_id", "held_out", "score", "predicted")


@query("documents")
def op2_sentence_spans(docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document without repeated runs of sentences."""
    return spans.remove_repeats(docs)


@query("documents", sql="""
WITH cut AS (
  SELECT doc_id, coalesce(text, '') AS t,
         regexp_extract_all(coalesce(text, ''), '[A-Za-z]+|[^A-Za-z]') AS u,
         sha256('1:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h
  FROM documents
),
drawn AS (
  SELECT doc_id, t, u, CAST(len(u) AS BIGINT) AS n,
         [CAST('0x' || substr(h, 8 * i + 1, 8) AS BIGINT) for i in [0, 1, 2, 3]] AS d
  FROM cut
),
parts AS (
  SELECT doc_id, t, n,
         CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>')
                   OR d[3] % 100 >= 90 THEN 'plain'
              WHEN d[4] % 100 < 20 THEN 'spm' ELSE 'psm' END AS form,
         array_to_string(u[1 : least(d[1] % (n + 1), d[2] % (n + 1))], '') AS p,
         array_to_string(u[least(d[1] % (n + 1), d[2] % (n + 1)) + 1
                           : greatest(d[1] % (n + 1), d[2] % (n + 1))], '') AS m,
         array_to_string(u[greatest(d[1] % (n + 1), d[2] % (n + 1)) + 1 : n], '') AS s
  FROM drawn
)
SELECT doc_id, n, form,
       CASE WHEN form <> 'plain' THEN CAST(length(p) AS BIGINT) END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN CAST(length(m) AS BIGINT) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN t
                        WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m
                        ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256,
       sha256(t) AS restored_sha256
FROM parts
""")
def op11_fill_in_middle(docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as a fill-in-middle sample, and as restored from the sample."""
    made = fim.fill_in_middle(docs)
    back = fim.restoring_pieces(F.col("output"), F.col("form"))
    return made.select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars",
        fim.stream_sha256(F.col("text"), F.col("pieces")).alias("output_sha256"),
        fim.stream_sha256(F.col("output"), back).alias("restored_sha256"))


@query("embeddings")
def op12_whitening(table: DataFrame, sf_dir: str) -> DataFrame:
    """The four largest whitened components of every vector."""
    return whitening.whiten(table).select(
        "vec_id", "component", "n", F.col("deviation").try_cast("bigint").alias("deviation"), "whitened",
        "explained", "identity_error")


@query("documents")
def op13_bpe(docs: DataFrame, sf_dir: str) -> DataFrame:
    """Digests of every document's token ids and of the text decoded from them."""
    return bpe.digests(bpe.encode(docs))
