"""The pipeline's stages on small inputs, its registration, and what its decisions keep."""

import brute
import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
import corpus_pipeline
from tierwell.llm import pipeline

RNG = np.random.default_rng(21)


def _texts():
    rows = [(i, "\n".join(brute.sentence(RNG, 30) for _ in range(3)), "en", f"src{i % 4}") for i in range(60)]
    rows += [(60 + i, rows[i][1] + " end", "en", "src1") for i in range(5)]
    shared = brute.sentence(RNG, 15)
    rows += [(70 + i, brute.sentence(RNG, 25) + "\n" + shared, "en", "src2") for i in range(4)]
    return [*rows, (80, None, "en", "src0"), (81, "", None, None), (82, "123 456 !!!", "en", "src0"), (None, "no id here", "en", "src0")]


TEXTS = _texts()


@pytest.fixture(scope="module")
def documents(spark):
    return spark.createDataFrame(TEXTS, "doc_id long, text string, lang string, source string").selectExpr("*", "CAST(length(text) AS BIGINT) AS n_chars").cache()


def test_stages_are_in_order_and_registered():
    assert [name for name, _ in corpus_pipeline.STAGES] == ["language_id", "line_dedup", "jaccard_join", "source_mixing", "cutting_stock_packing"]
    assert {f"op{n}_" for n in range(1, 14)} == {x.split("_")[0] + "_" for x in entry.queries() if x.startswith("op")}
    assert "pipeline" in entry.queries() and corpus_pipeline.ORACLE_SQL is None


def test_language_stage_drops_what_has_no_language(spark, documents):
    kept = pipeline.drop_unknown_languages(spark, documents, "")
    assert kept.columns == documents.columns
    assert {r.doc_id for r in kept.collect()} == {r[0] for r in TEXTS if r[0] is not None and r[0] < 80}


def test_line_stage_drops_later_lines_only(spark, documents):
    given = documents.where("doc_id IS NOT NULL")
    rows = {r.doc_id: r for r in pipeline.drop_repeated_lines(spark, given, "").collect()}
    plain = {r[0]: r[1] for r in TEXTS if r[0] is not None}
    gone = brute.removed_lines(plain, 5, 80)
    assert len(rows) == given.count() and gone
    for doc, text in plain.items():
        kept = None if text is None else "\n".join(x for i, x in enumerate(text.split("\n")) if (doc, i) not in gone)
        assert rows[doc].text == kept and rows[doc].n_chars == (None if kept is None else len(kept))


def test_join_stage_keeps_one_of_each_group(spark, documents):
    given = documents.where("doc_id IS NOT NULL")
    kept = {r.doc_id for r in pipeline.drop_near_copies(spark, given, "").collect()}
    found = brute.jaccard_components({r[0]: r[1] for r in TEXTS if r[0] is not None}, 5, 80)
    assert kept == {i for i, (_, component) in found.items() if component == i}


def test_run_packs_what_the_stages_keep(spark, tmp_path, documents):
    documents.write.parquet(str(tmp_path / "documents.parquet"))
    rows = corpus_pipeline.run(spark, str(tmp_path)).collect()
    # Later copies lose all their lines first, and what is left of them is packed as an empty text.
    assert {r.doc_id for r in rows if r.doc_tokens > 1} <= set(range(60)) | set(range(70, 74))
    assert len({(r.sequence_id, r.offset) for r in rows}) == len(rows)


def test_empty_documents(spark, documents):
    docs = documents.limit(0)
    for _, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, "")
        assert out.collect() == []


def test_language_stage_compiles_with_many_languages(spark, documents):
    """With a compiled method beyond 64 KB, Spark holds a huge class on the driver and goes on without compiled code."""
    languages = ("en", "fr", "de", "es")
    docs = documents.withColumn("lang", F.element_at(F.array(*[F.lit(x) for x in languages]), (F.col("doc_id") % 4 + 1).cast("int")))
    spark.conf.set("spark.sql.codegen.fallback", "false")
    try:
        assert pipeline.drop_unknown_languages(spark, docs, "").columns == docs.columns
    finally:
        spark.conf.unset("spark.sql.codegen.fallback")
