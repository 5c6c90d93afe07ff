"""The queries of this folder: name -> function of (session, folder of tables)."""

from __future__ import annotations

import zlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pagewright.llm import chat, decontaminate, jaccard, licenses, mixing, quality, runs, search, sharding, simhash, tokens, urls, warc
from pagewright.llm.common import by_value, split_words, table
from pagewright.sources.storage import scratch_path

RULES = [
    urls.host_rule("block", "net/"),
    urls.host_rule("allow", "example.net/en/"),
    urls.host_rule("block", "example.com/de/"),
    urls.host_rule("allow", "org/fr/"),
    urls.Rule("block", "||spam-farm.*^"),
    urls.Rule("block", "||cheap-pills.*^"),
    urls.Rule("block", "*/casino/*"),
    urls.Rule("block", "*adserver*"),
    urls.Rule("allow", "*/about/*"),
]
WEIGHTS = {"good": 0.9, "low": 0.07, "toxic": 0.03}


def op1_vector_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in 40 shards by vector bin packing; sizes near equal (law ``bytes``). Nulls, ties and repeats as in :mod:`sharding`."""
    placed = sharding.assign(table(spark, sf_dir, "documents"), 40)
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op2_simhash_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and component of every document. Nulls, ties and repeats as in :mod:`simhash`."""
    found = simhash.simhash_components(table(spark, sf_dir, "documents"), size=3, radius=2)
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op3_quality_cascade(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Facts and verdict of every document. Nulls, ties and repeats as in :mod:`quality`."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    text, words = F.col("text"), F.col("words")

    def with_facts(rows: DataFrame) -> DataFrame:
        return rows.withColumn("words", split_words(text)).select(
            "doc_id", "text", "words",
            F.size(words).cast("long").alias("n_words"),
            quality.word_chars(words).alias("word_chars"),
            quality.n_symbols(text).alias("n_symbols"),
            quality.n_dup_lines(text).alias("n_dup_lines"),
            quality.n_repeat_words(words).alias("n_repeat_words"),
        )

    known = {c: F.col(c) for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")}
    beyond = {name: rule for name, rule in quality.default_rules(text, words, known).items() if name not in ("words", "repeats")}
    order = [m["rule"] for m in quality.plan_cascade(docs, beyond, prepare=with_facts)]
    facts = with_facts(docs)
    failed = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    facts = facts.withColumn("base_failed", failed)
    kept = F.when(F.col("base_failed"), False).otherwise(quality.verdict(beyond, order).isNull())
    return facts.withColumn("kept", kept).drop("text", "words")


def op4_snapshot_collapse(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The maximal conversations, rendered. Nulls, ties and repeats as in :mod:`chat`."""
    return chat.format_chats(table(spark, sf_dir, "conversations"))


def op5_trie_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Unigram token counts of every document. Nulls, ties and repeats as in :mod:`tokens`."""
    return tokens.count_tokens(table(spark, sf_dir, "documents"))


def op6_rarest_token(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Host, path, rule and verdict of every page. Nulls, ties and repeats as in :mod:`urls`."""
    return urls.judge(table(spark, sf_dir, "pages"), RULES)


def op7_soft_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Domain posteriors, rate and copies of every document. Nulls, ties and repeats as in :mod:`mixing`."""
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    found = mixing.mixed(docs, labels, WEIGHTS, anchor="good")
    chances = [F.get("p", F.lit(i)).alias(f"p_{name}") for i, name in enumerate(WEIGHTS)]
    return found.select("doc_id", "tokens", *chances, "rate", "copies")


def op8_warc_salvage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pages as read back from archives. Nulls, ties and repeats as in :mod:`warc`."""
    path = scratch_path(spark, "warc")
    warc.write_archives(table(spark, sf_dir, "pages"), path)
    found = warc.read_archives(spark, path, payloads=False).filter("kind = 'record'")
    return found.select(
        warc.page_of(F.col("record_id")).alias("page_id"), "payload_bytes", F.col("digest").alias("payload_digest"),
        F.col("type").alias("record_type"), warc.page_of(F.col("refers_to")).alias("refers_to"),
    )


def op9_latent_leaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item. Nulls, ties and repeats as in :mod:`decontaminate`."""
    return decontaminate.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op10_license_diagonals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """License phrases and labels of every document. Nulls, ties and repeats as in :mod:`licenses`."""
    return licenses.scan(table(spark, sf_dir, "documents"))


def op11_shared_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 50 best documents of every benchmark item."""
    return search.search(table(spark, sf_dir, "benchmark"), table(spark, sf_dir, "documents"), 50)


def op12_matrix_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Classes of documents with a Jaccard similarity of 0.8 or more on five-word shingles."""
    return jaccard.jaccard_components(table(spark, sf_dir, "documents"), size=5, percent=80)


def repeat_some(key: int | None, words: list[bytes]) -> list[bytes]:
    """The words, in a tenth of the documents with a part that repeats; a NULL key is never among them."""
    n, h = len(words), zlib.crc32(str(key).encode())
    if key is None or h % 10 or not n:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + [words[a + (i - a) % p] for i in range(a, n)]


def op13_block_convolution(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs of every document, those of :func:`repeat_some` included."""
    found = runs.collapse_runs(table(spark, sf_dir, "documents"), rewrite=repeat_some)
    found = found.withColumn("best", runs.strongest(F.col("runs")))
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    return found.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), "best.start", "best.length", "best.period",
        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


QUERIES = {
    f.__name__: f
    for f in (
        op1_vector_packing, op2_simhash_trie, op3_quality_cascade, op4_snapshot_collapse, op5_trie_tokens,
        op6_rarest_token, op7_soft_mixing, op8_warc_salvage, op9_latent_leaks, op10_license_diagonals,
        op11_shared_search, op12_matrix_join, op13_block_convolution,
    )
}

by_value(__name__)
