"""Stages of the corpus pipeline, each around one operator of this package.

Each takes (spark, docs, sf_dir). All but the last return the columns they were given. Rows without an id are dropped
by the first stage, as no later decision could name them.
"""

import public_tokenizers
from pyspark.sql import DataFrame, functions as F

from tierwell.llm.common import stored
from tierwell.llm.jaccard_join import link_components
from tierwell.llm.language_id import from_documents, identify
from tierwell.llm.line_dedup import dedup_lines
from tierwell.llm.mixing import mix
from tierwell.llm.packing import pack


def drop_unknown_languages(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is unknown or unsure go, and those without letters."""
    # Rows that share an id are judged each: a row goes by its id and hashes of all that its verdict depends on.
    def row(declared, host):
        parts = {"text": F.col("text"), "declared": declared, "host": host}
        return F.struct("doc_id", *[F.xxhash64(F.coalesce(x.cast("string"), F.lit(""))).alias(name) for name, x in parts.items()])

    judged = from_documents(docs).withColumn("_row", row(F.col("declared"), F.col("host")))
    # A filter right on the verdicts would be pushed into the joins with all their expressions, too many for one method.
    verdicts = stored(identify(judged, "_row").select("_row", "kept"), "verdicts")
    rejected = stored(verdicts.where("NOT kept").select("_row").distinct(), "rejected")
    rows = docs.where("doc_id IS NOT NULL").withColumn("_row", row(F.lower("lang"), F.col("source")))
    return rows.join(rejected, "_row", "left_anti").select(docs.columns)


def drop_repeated_lines(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that an earlier line resembles go, those of under five words if they are the same words.

    Documents stay, with ``n_chars`` of what is left of their text.
    """
    fewer = dedup_lines(docs)
    if "n_chars" in docs.columns:
        fewer = fewer.withColumn("n_chars", F.when(F.col("n_removed") > 0, F.length("text")).otherwise(F.col("n_chars")))
    return fewer.select(docs.columns)


def drop_near_copies(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of similar texts stays: the one of the smallest id.

    Documents without words are in no group and stay. Rows that repeat an id stay with it, one for each different text.
    """
    groups = link_components(docs.select("doc_id", "text"), k=5, percent=80)
    later = stored(groups.where("component_id != doc_id").select("doc_id"), "later")
    kept = docs.join(later, "doc_id", "left_anti").select(docs.columns)
    ids = stored(docs.groupBy("doc_id").count().where("count > 1").select("doc_id"), "repeated")
    if ids.isEmpty():
        return kept
    others = [c for c in docs.columns if c not in ("doc_id", "text")]
    again = kept.join(ids, "doc_id", "left_semi").groupBy("doc_id", "text").agg(F.min(F.struct(F.lit(0).alias("_"), *others)).alias("_rest"))
    one_each = again.select("doc_id", "text", *[F.col("_rest")[c].alias(c) for c in others]).select(docs.columns)
    return kept.join(ids, "doc_id", "left_anti").select(docs.columns).unionByName(one_each)


def mix_sources(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mixture in its target weights; a document of a second epoch is a row of its own."""
    return mix(docs).select(docs.columns)


def pack_sequences(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of sequences of 2048 tokens."""
    return pack(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("language_id", drop_unknown_languages),
    ("line_dedup", drop_repeated_lines),
    ("jaccard_join", drop_near_copies),
    ("source_mixing", mix_sources),
    ("cutting_stock_packing", pack_sequences),
]
