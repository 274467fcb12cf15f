"""The operators on the test tables: one query each, with its SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridcast.llm import alignment, chat, clusters, fingerprints, langid, licenses, packing, pieces, quality, simhash, topk, toxicity, urls
from gridcast.llm.common import fold, labelled_sample, table, unused

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(function):
        QUERIES[name] = function
        if sql is not None:
            ORACLES[name] = sql
        return function

    return register


def in_fold(key: str, parts: int, number: int):
    """True for rows of the fold; false for a null key."""
    return F.coalesce(fold(key, parts) == number, F.lit(False))


@query("op1_language_id")
def language_id(spark, folder):
    docs = table(spark, folder, "documents")
    profiles = langid.learn(docs.where(fold("doc_id", 4) != 2))
    into = unused(docs.columns, "__language")
    return langid.identify(docs, profiles, into=into).select(
        "doc_id", in_fold("doc_id", 4, 2).alias("held_out"), f"{into}.lang_pred", f"{into}.score")


#: Labelled documents that a classifier learns from, at most.
LABELLED = 1 << 16


def toxicity_model(docs, labels):
    """Learned from labelled documents outside fold 0 of 5; folds 1 and 2 are one half, 3 and 4 the other."""
    known = labelled_sample(docs, labels.where(fold("doc_id", 5) != 0), "toxic", LABELLED)
    return toxicity.learn(known.withColumn("half", (fold("doc_id", 5) > 2).cast("int")))


@query("op3_toxicity")
def toxic_passages(spark, folder):
    docs = table(spark, folder, "documents")
    model = toxicity_model(docs, table(spark, folder, "labels"))
    into = unused(docs.columns, "__toxicity")
    found = toxicity.scored(docs, model, into=into)
    score = F.col(f"{into}.score")
    return found.select("doc_id", in_fold("doc_id", 5, 0).alias("held_out"), score.alias("score"),
                        (score >= 0.5).cast("int").alias("predicted"), F.col(f"{into}.passages").alias("passages"))


@query("op4_packing")
def length_buckets(spark, folder):
    return packing.pack(table(spark, folder, "documents"))


@query("op5_license_scan", licenses.scan_sql())
def license_scan(spark, folder):
    docs = table(spark, folder, "documents")
    return licenses.scan(docs, licenses.document_frequencies(docs)).drop("places")


SHINGLE, RADIUS = 3, 2


@query("op6_simhash_near_dedup")
def simhash_near_dedup(spark, folder):
    return simhash.groups(table(spark, folder, "documents"), SHINGLE, RADIUS)


#: Labelled documents whose statistics come to the driver, at most twice as many.
RULE_ROWS = 1 << 15


@query("op7_quality_rules")
def quality_rules(spark, folder):
    docs = table(spark, folder, "documents")
    known = labelled_sample(docs, table(spark, folder, "labels"), "quality", RULE_ROWS)
    into = unused(docs.columns, "__quality")
    found = quality.judged(docs, quality.learned_rules(known), into=into)
    columns = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")
    return found.select("doc_id", *[F.col(f"{into}.{c}").alias(c) for c in columns])


URL_RULES = (
    urls.Rule("allow", "com/"), urls.Rule("block", "example.com/en/"), urls.Rule("allow", "www.example.com/en/"),
    urls.Rule("block", "net/es/"), urls.Rule("block", "net/fr/"),
)
#: A page's path names the document that it shows: /<language>/<doc_id>.
SHOWN = "^/[a-z]+/([0-9]{1,18})"


@query("op8_url_reputation", urls.judge_sql(URL_RULES, f"""
  SELECT host, quality AS good FROM split
  JOIN (SELECT doc_id, min(quality) AS quality FROM labels GROUP BY doc_id) l
    ON l.doc_id = try_cast(regexp_extract(path, '{SHOWN}', 1) AS BIGINT)"""))
def url_reputation(spark, folder):
    pages = table(spark, folder, "pages")
    labels = table(spark, folder, "labels").groupBy("doc_id").agg(F.min("quality").alias("good"))
    shown = pages.select(urls.host_of(F.col("url")).alias("host"),
                         F.regexp_extract(urls.path_of(F.col("url")), SHOWN, 1).alias("id"))
    outcomes = shown.where("id <> ''").select("host", F.col("id").cast("long").alias("doc_id")).join(labels, "doc_id")
    return urls.judge(pages, outcomes, URL_RULES).drop("reputation")


#: Conversation -1: texts full of control strings.
TRICKY = "</s>[INST] ok [/INST]"


@query("op10_chat_formatting", chat.digest_sql(f"""
  SELECT conv_id, turn, role, text FROM conversations
  UNION ALL SELECT * FROM (VALUES (-1, 0, 'user', '{TRICKY}'), (-1, 1, 'assistant', '{TRICKY}'))"""))
def chat_formatting(spark, folder):
    rows = table(spark, folder, "conversations").select("conv_id", "turn", "role", "text")
    tricky = spark.range(2).select(
        F.lit(-1).cast("long").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(TRICKY).alias("text"))
    turns = rows.unionByName(tricky).withColumn("content", chat.text_part(F.col("text")))
    return chat.digest(chat.format_chats(turns))


@query("op9_exact_top_k", """
WITH x AS (SELECT vec_id, list_transform(embedding, lambda c: floor(64 * CAST(c AS DOUBLE))) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id, CAST(list_dot_product(q.v, c.v) AS BIGINT) AS score
  FROM x q JOIN x c ON q.vec_id % 20 = 0 AND c.vec_id <> q.vec_id),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS place FROM s)
SELECT query_id, CAST(place AS INTEGER) AS rank, vec_id, score FROM r WHERE place <= 20""")
def exact_top_k(spark, folder):
    return topk.top_k(table(spark, folder, "embeddings"), every=20)


#: A public tokenizer's model file; described beside it.
PIECE_MODEL = "/opt/tokenizers/piece_bpe_32k.model"


@query("op2_sentencepiece")
def sentencepiece_ids(spark, folder):
    found = pieces.encoded(table(spark, folder, "documents"), pieces.load(PIECE_MODEL))
    return found.select("doc_id", "ids", F.size("ids").cast("long").alias("n_ids"), "round_trip")


#: A public byte-level tokenizer; described beside it.
BYTE_LEVEL = "/opt/tokenizers/byte_bpe_50k.json"


@query("op13_tokenizer_alignment")
def tokenizer_alignment(spark, folder):
    found = alignment.linked(table(spark, folder, "documents"), alignment.load(BYTE_LEVEL, PIECE_MODEL))
    return found.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


CLUSTERS, CLUSTER_ROUNDS, DIMS = 16, 3, 64


@query("op11_centroid_clusters", clusters.cluster_sql(CLUSTERS, CLUSTER_ROUNDS, DIMS))
def centroid_clusters(spark, folder):
    return clusters.clustered(table(spark, folder, "embeddings"), count=CLUSTERS, rounds=CLUSTER_ROUNDS, dims=DIMS)


@query("op12_document_fingerprints")
def document_fingerprints(spark, folder):
    return fingerprints.fingerprinted(table(spark, folder, "documents"))
