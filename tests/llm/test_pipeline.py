"""SQL checks of this subpackage's queries, and the pipeline stage by stage."""

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from railpulse.llm.checks import SQL
from railpulse.llm.decontaminate import normal
from railpulse.llm.queries import REGISTRY
from railpulse.llm.simhash import fingerprint
from railpulse.sinks.tables import stored
from tests.compare import compare, database

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_against_sql(spark, name):
    assert compare(spark, database(SF), SF, name, REGISTRY[name], SQL[name]) is None


def test_every_operator_is_registered():
    assert sorted(int(n[2:].split("_")[0]) for n in REGISTRY) == list(range(1, 14))


def test_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    names = docs.columns
    kept = [{r.doc_id: r.text for r in docs.collect()}]
    benchmark = [normal(r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stored(stage(spark, docs, SF), name)
        assert docs.columns == names
        rows = {r.doc_id: r.text for r in docs.collect()}
        assert rows.items() <= kept[-1].items()
        kept.append(rows)
    _, _, unique, clean, mixed = kept
    # One document of each group of all pairs within the bit distance.
    prints = {d: fingerprint((t or "").encode(), corpus_pipeline.SHINGLE_WORDS)[0] for d, t in kept[1].items()}
    group = {d: d for d in prints}
    for a in sorted(prints):
        for b in sorted(prints):
            if a < b and (prints[a] ^ prints[b]).bit_count() <= corpus_pipeline.BITS_APART and group[a] != group[b]:
                low, high = sorted((group[a], group[b]))
                group = {d: low if g == high else g for d, g in group.items()}
    assert sorted(group[d] for d in unique) == sorted(set(group.values())) and len(unique) < len(group)
    assert set(clean) == {d for d, t in unique.items() if not any(b in normal(t) for b in benchmark)}
    assert mixed
    last = corpus_pipeline.STAGES[-1][1](spark, docs, SF)
    assert sorted(r.doc_id for r in last.collect()) == sorted(r.doc_id for r in docs.collect())


def test_clashing_columns_are_kept(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    names = [f"{n}{i}" for n in ("row", "score", "many", "copy") for i in (0, 1)] + ["__row", "ROW2"]
    docs = docs.withColumns({n: F.concat(F.lit(n), F.col("doc_id").cast("string")) for n in names})
    for name, stage in corpus_pipeline.STAGES[:-1]:
        got = stage(spark, docs, SF)
        assert got.columns == docs.columns
        assert got.where(" or ".join(f"{n} is null or {n} <> concat('{n}', doc_id)" for n in names)).isEmpty(), name


def test_empty_table(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, SF).count() == 0
