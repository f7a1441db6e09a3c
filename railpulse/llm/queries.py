"""Registered queries of the operators on training text, over whole tables."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps
from pathlib import Path

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from railpulse.llm import quality
from railpulse.llm.decontaminate import contaminated
from railpulse.llm.licenses import scan_licenses
from railpulse.llm.lmscore import word_cross_entropy_difference
from railpulse.llm.mixing import mix, word_count
from railpulse.llm.ranked import ranked_search
from railpulse.llm.repeats import without_repeats
from railpulse.llm.runs import periodic_runs
from railpulse.llm.secrets import find_secrets
from railpulse.llm.simhash import near_duplicates
from railpulse.llm.tokens import encoded
from railpulse.llm.topk import top_k
from railpulse.llm.toxicity import THRESHOLD, held_out, scored, train
from railpulse.sinks.tables import stored

#: Rows of a batch that goes to a Python worker.
BATCH_ROWS = 1000
#: Vocabulary of the token shards, a file of the installed public tokenizers.
TOKENIZER = "word_bpe_49k.json"

#: Most ids that are sent to every task, 8 bytes each, so that texts need not be shuffled.
SENT_IDS = 1 << 20

REGISTRY: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


#: Folder that holds the package; Python workers look for its modules there too.
_ROOT = str(Path(__file__).resolve().parents[2])


def importable(spark: SparkSession) -> None:
    """Let Python workers that share this machine's folders import the package without
    an installation; elsewhere it is installed or sent with ``--py-files``.

    Texts are long rows, so a batch of them is kept to fewer rows than Spark's default;
    a worker's memory follows the size of a batch.
    """
    spark.sparkContext.environment.setdefault("PYTHONPATH", _ROOT)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)


def registered(build: Callable[[SparkSession, str], DataFrame]):
    @wraps(build)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        importable(spark)
        return build(spark, sf_dir)

    REGISTRY[build.__name__] = run
    return run


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@registered
def op5_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and near-duplicate group of every document."""
    found = near_duplicates(table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


@registered
def op1_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts and digests of the secrets in every document."""
    found = find_secrets(table(spark, sf_dir, "documents"))

    def joined(spans: Column) -> Column:
        return F.array_join(
            F.transform(
                spans,
                lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string")),
            ),
            ",",
        )

    def number(kind: str) -> Column:
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("bigint")

    base = F.filter("spans", lambda s: s["kind"] != "literal")
    return found.select(
        "doc_id",
        number("assign").alias("n_assign"),
        number("access").alias("n_access"),
        number("hex").alias("n_hex"),
        F.sha2(joined(base), 256).alias("base_sha256"),
        joined(F.col("spans")).alias("spans"),
    )


@registered
def op2_token_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Place, length and checksum of every document's token ids, read from the shards."""
    return encoded(table(spark, sf_dir, "documents"), public_tokenizers.path(TOKENIZER))


@registered
def op3_systematic_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of every document that the mix of sources takes."""
    sized = table(spark, sf_dir, "documents").select(
        "doc_id", "source", word_count("text").alias("size")
    )
    return mix(stored(sized, "sized")).select(
        "doc_id",
        "size",
        "source_size",
        "target",
        (F.col("size") * F.col("copies")).cast("bigint").alias("taken"),
    )


@registered
def op4_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every benchmark item that a document contains, with its edit distance."""
    return contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@registered
def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document, and whether its label could have been learnt from."""
    docs = table(spark, sf_dir, "documents")
    model = train(docs, table(spark, sf_dir, "labels"))
    return scored(docs.select("doc_id", "text"), model).select(
        "doc_id",
        held_out("doc_id").alias("held_out"),
        "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
    )


@registered
def op6_maxscore_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five vectors of highest inner product with every fiftieth vector."""
    return top_k(table(spark, sf_dir, "embeddings"))


@registered
def op8_repeated_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of every document that lie in repeated passages, and a digest of the rest."""
    found = without_repeats(table(spark, sf_dir, "documents"), digest=True)
    return found.withColumnRenamed("kept", "kept_sha256")


@registered
def op9_co_trained_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of every document, and whether it would be kept."""
    features = quality.featured(table(spark, sf_dir, "documents"))
    views = quality.train(features, table(spark, sf_dir, "labels"))
    return quality.scored(features, views).select(
        "doc_id",
        held_out("doc_id").alias("held_out"),
        "score",
        (F.col("score") >= quality.THRESHOLD).alias("keep"),
    )


@registered
def op10_cross_entropy_difference(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How much nearer every document is to the documents of good quality than to all."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    good = (
        table(spark, sf_dir, "labels")
        .where("quality = 1")
        .select(F.col("doc_id").alias("_good"))
        .distinct()
    )
    if good.count() <= SENT_IDS:  # else a join that deals out both sides
        good = F.broadcast(good)
    marked = docs.join(good, F.col("doc_id") == F.col("_good"), "left")
    return word_cross_entropy_difference(marked, F.col("_good").isNotNull())


def _with_planted_runs(docs: DataFrame) -> DataFrame:
    """Documents (doc_id, text) in which every tenth, by the checksum of its id, repeats a
    stretch of its words to its end. Only those texts are cut into words here."""
    h = F.crc32(F.col("doc_id").cast("string"))
    words = F.array_remove(F.split(F.col("text"), r"[\x20\x09-\x0D]+"), "")
    g = F.floor(h / 10)
    cut = docs.select(
        "doc_id", "text", F.when(h % 10 == 0, words).alias("w"), g.cast("bigint").alias("g")
    ).withColumn("n", F.size("w"))
    a = F.expr("cast(g % n as int)")
    placed = cut.withColumn("a", F.when(F.col("n") > 0, a)).withColumn(
        "p", F.expr("cast(1 + (n - a) div (3 + g % 8) as int)")
    )
    planted = F.expr(
        "array_join(concat(slice(w, 1, a), slice(flatten(array_repeat(slice(w, a + 1, p),"
        " cast(ceil((n - a) / p) as int))), 1, n - a)), ' ')"
    )
    return placed.select("doc_id", F.when(F.col("n") > 0, planted).otherwise(F.col("text")).alias("text"))


@registered
def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Periodic runs of words of every document, some of them planted, and digests of the
    runs and of the text without the repeats."""
    found = periodic_runs(_with_planted_runs(table(spark, sf_dir, "documents")))
    lines = F.transform(
        "runs", lambda r: F.format_string("%d,%d,%d\n", r["start"], r["length"], r["period"])
    )
    longest = F.array_max(
        F.transform(
            "runs",
            lambda r: F.struct(
                r["length"].alias("length"), (-r["start"]).alias("start"), (-r["period"]).alias("period")
            ),
        )
    )
    return found.withColumn("longest", longest).select(
        "doc_id",
        F.size("runs").cast("bigint").alias("n_runs"),
        (-F.col("longest.start")).alias("start"),
        F.col("longest.length").alias("length"),
        (-F.col("longest.period")).alias("period"),
        F.expr("longest.length * 1000 div -longest.period").alias("exponent_milli"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


@registered
def op13_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten documents that score highest for every benchmark item."""
    return ranked_search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@registered
def op12_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licenses that every document names, and where the base phrases stand."""
    found = scan_licenses(table(spark, sf_dir, "documents"))
    base = F.filter("places", lambda p: p["base"])
    starts = F.transform(base, lambda p: p["start"])

    def labels(places: Column) -> Column:
        return F.array_join(F.array_sort(F.array_distinct(F.transform(places, lambda p: p["label"]))), ",")

    return found.select(
        "doc_id",
        "n_words",
        F.size(base).cast("bigint").alias("n_base"),
        F.array_min(starts).alias("first_word"),
        F.array_max(starts).alias("last_word"),
        labels(base).alias("base_labels"),
        labels(F.col("places")).alias("labels"),
        F.coalesce(F.array_max(F.transform("places", lambda p: p["confidence"])), F.lit(0.0)).alias("score"),
    )
