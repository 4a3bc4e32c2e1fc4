"""The corpus pipeline: order of its stages, what each decides, and odd, repeated, empty and clashing input."""

import random

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from cases import DOCS, none, odd_documents, sentence
from bulkapply.llm import decontaminate, lang_kernel, mixing, near_dups, quality_knn

SMALL = "/root/testdata/sf0.001"
SIZES = "doc_id size source_size target taken".split()


def written(spark, folder, docs, benchmark=None, labels=None):
    docs.write.parquet(f"{folder}/documents.parquet")
    (benchmark or spark.read.parquet(f"{SMALL}/benchmark.parquet")).write.parquet(f"{folder}/benchmark.parquet")
    (labels or spark.read.parquet(f"{SMALL}/labels.parquet")).write.parquet(f"{folder}/labels.parquet")
    return folder


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_stages_are_the_ones_asked_for_in_their_order():
    assert [stage.__name__ for _, stage in corpus_pipeline.STAGES] == ["quality", "language", "near_duplicates", "decontamination", "mixture"]
    assert corpus_pipeline.ORACLE_SQL is None


def test_each_stage_works_on_what_the_one_before_kept(spark):
    """Every stage is compared with its operator's own verdicts on its input."""
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    columns, labels = docs.columns, spark.read.parquet(f"{SMALL}/labels.parquet")
    benchmark = spark.read.parquet(f"{SMALL}/benchmark.parquet")
    quality, language, near, clean, mixed = (stage for _, stage in corpus_pipeline.STAGES)

    kept = quality(spark, docs, SMALL)
    good = {r.doc_id for r in quality_knn.classify(docs, labels).where("predicted = 1").collect()}
    assert kept.columns == columns and {r.doc_id for r in kept.select("doc_id").collect()} == good

    known = language(spark, kept, SMALL)
    said = {r.doc_id for r in lang_kernel.classify(kept).where("lang_pred <> 'und'").collect()}
    assert known.columns == columns and {r.doc_id for r in known.select("doc_id").collect()} <= said

    one_each = near(spark, known, SMALL)
    first = {r.doc_id for r in near_dups.near_duplicates(known).where("kept").collect()}
    assert one_each.columns == columns and {r.doc_id for r in one_each.select("doc_id").collect()} == first

    apart = clean(spark, one_each, SMALL)
    leaked = {r.doc_id for r in decontaminate.find(one_each, benchmark).collect()}
    assert apart.columns == columns and {r.doc_id for r in apart.select("doc_id").collect()} == first - leaked

    out = mixed(spark, apart, SMALL)
    assert rows(out.select(*SIZES)) == rows(mixing.mix(apart).select(*SIZES))
    assert rows(corpus_pipeline.run(spark, SMALL).select(*SIZES)) == rows(out.select(*SIZES))


def test_planted_cases(spark, folder):
    """Copies, near copies and benchmark passages go; the originals and clean texts stay."""
    base = spark.read.parquet(f"{SMALL}/documents.parquet")
    kept = corpus_pipeline.quality(spark, base, SMALL)
    kept = corpus_pipeline.language(spark, kept, SMALL).where(F.length("text") > 600).orderBy("doc_id").limit(4).collect()
    passage = " ".join(f"benchmark{i} passage{i}" for i in range(30))
    rng = random.Random(3)
    planted = [
        (10_001, kept[0].text), (10_002, kept[1].text + " and one more word"), (10_003, f"{kept[2].text} {passage} {kept[3].text}"),
    ]
    extra = spark.createDataFrame([(i, t, "en", "planted", len(t)) for i, t in planted], base.select("doc_id", "text", "lang", "source", "n_chars").schema)
    benchmark = spark.createDataFrame([(1, passage), (2, sentence(rng, 40))], "item_id long, text string")
    docs = base.join(spark.createDataFrame([(r.doc_id,) for r in kept], "doc_id long"), "doc_id", "left_semi").unionByName(extra)
    out = {r.doc_id for r in _after(spark, written(spark, folder, docs, benchmark), skip=2).collect()}
    assert out == {r.doc_id for r in kept}


def _after(spark, folder, skip):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[skip:]:
        docs = stage(spark, docs, folder)
    return docs


def test_odd_rows_and_clashing_columns(spark, folder):
    odd = odd_documents(spark)
    real = spark.read.parquet(f"{SMALL}/documents.parquet").limit(80)
    for name in ("score", "kept", "size", "words"):
        real = real.withColumn(name, F.lit(None).cast(odd.schema[name].dataType))
    clashing = ["predicted", "lang_pred", "component_id", "text_hash", "taken", "_words", "shingles", "window", "fingerprint", "target"]
    docs = odd.unionByName(real.select(*odd.columns)).withColumns({c: F.lit(c) for c in clashing})
    folder = written(spark, folder, docs)
    given = spark.read.parquet(f"{folder}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        kept = stage(spark, given, folder)
        assert kept.columns == docs.columns and kept.exceptAll(given).isEmpty()
    first, second = (rows(corpus_pipeline.run(spark, folder)) for _ in range(2))
    assert first == second and first


@pytest.mark.parametrize("empty", ["documents", "benchmark", "labels"])
def test_empty_tables(spark, folder, empty):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").limit(30)
    tables = {
        "docs": none(spark) if empty == "documents" else docs,
        "benchmark": spark.read.parquet(f"{SMALL}/benchmark.parquet").limit(0) if empty == "benchmark" else None,
        "labels": spark.read.parquet(f"{SMALL}/labels.parquet").limit(0) if empty == "labels" else None,
    }
    out = corpus_pipeline.run(spark, written(spark, folder, **tables)).select(*SIZES)
    assert out.columns == SIZES
    if empty == "documents":
        assert out.count() == 0 and DOCS.startswith("doc_id")
    else:
        assert out.count() <= 30
