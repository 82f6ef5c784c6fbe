"""The registered queries of this package, with production parameters, over whole tables."""

from functools import wraps

from pyspark.sql import DataFrame, SparkSession

from tierwell.llm import oracles
from tierwell.llm.common import ship, table

QUERIES = {}
ORACLES = {}


def query(name: str, sql: str | None = None):
    """Register ``fn(spark, sf_dir) -> DataFrame`` and, where SQL can say it, its oracle."""

    def register(fn):
        @wraps(fn)
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            ship(spark)
            return fn(spark, sf_dir)

        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return run

    return register


@query("op8_jaccard_join", oracles.OP8)
def op8_jaccard_join(spark, sf_dir):
    """Shingles of four words, Jaccard of 0.85 or more: class of every document."""
    from tierwell.llm.jaccard_join import link_components

    return link_components(table(spark, sf_dir, "documents"), k=4, percent=85)


@query("op4_cutting_stock_packing")
def op4_cutting_stock_packing(spark, sf_dir):
    """Sequences of 2048 tokens of the word tokenizer."""
    import public_tokenizers

    from tierwell.llm.packing import pack

    return pack(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


@query("op3_source_mixing", oracles.OP3)
def op3_source_mixing(spark, sf_dir):
    """The mixture of all documents: budget of all tokens, two epochs at most."""
    from tierwell.llm.mixing import mix

    return mix(table(spark, sf_dir, "documents")).selectExpr(
        "doc_id", "_epoch AS epoch", "_tokens AS n_tokens", "_domain AS domain", "_lang AS language", "_source AS leaf_source"
    )


@query("op10_language_id")
def op10_language_id(spark, sf_dir):
    """Language of every document, and whether it is kept."""
    from tierwell.llm.language_id import from_documents, identify

    return identify(from_documents(table(spark, sf_dir, "documents")), "doc_id")


@query("language_id_of_pages")
def language_id_of_pages(spark, sf_dir):
    """The same operator over web pages, with the html tag's language, address suffix, domain and host."""
    from tierwell.llm.language_id import from_pages, identify

    return identify(from_pages(table(spark, sf_dir, "pages")), "page_id")


@query("op1_kneser_ney_quality")
def op1_kneser_ney_quality(spark, sf_dir):
    """Perplexity of every document and whether it is kept."""
    from tierwell.llm.quality_model import classify

    return classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query("op2_line_dedup", oracles.OP2)
def op2_line_dedup(spark, sf_dir):
    """Lines removed from every document: shingles of five words, Jaccard of 0.8 or more."""
    from tierwell.llm.line_dedup import dedup_lines

    return dedup_lines(table(spark, sf_dir, "documents")).selectExpr(
        "doc_id", "CAST(n_lines AS BIGINT) AS n_lines", "CAST(n_removed AS BIGINT) AS n_removed",
        "sha2(text, 256) AS kept_sha256",
    )


@query("op5_suffix_array_dedup", oracles.OP5)
def op5_suffix_array_dedup(spark, sf_dir):
    """Bytes of every document that an earlier occurrence of 100 bytes covers."""
    from tierwell.llm.suffix_array import dedup_substrings

    return dedup_substrings(table(spark, sf_dir, "documents"), length=100).selectExpr(
        "doc_id", "n_bytes", "n_removed", "n_spans", "sha2(kept, 256) AS kept_sha256"
    )


@query("op6_suffix_tree_dedup", oracles.OP6)
def op6_suffix_tree_dedup(spark, sf_dir):
    """Words of every document that a window of 13 words of an earlier document covers."""
    from tierwell.llm.suffix_tree import dedup_words

    return dedup_words(table(spark, sf_dir, "documents"), length=13).selectExpr(
        "doc_id", "n_words", "n_removed", "sha2(kept, 256) AS kept_sha256"
    )


@query("op7_va_file_search", oracles.OP7)
def op7_va_file_search(spark, sf_dir):
    """The ten best of every hundredth vector, against all others."""
    from tierwell.llm.va_file import top_k

    return top_k(table(spark, sf_dir, "embeddings"), "vec_id % 100 = 0", k=10, scale=1024)


@query("op9_collision_near_dedup", oracles.OP9)
def op9_collision_near_dedup(spark, sf_dir):
    """Vectors of one label whose cosine is 0.98 or more."""
    from tierwell.llm.collision_dedup import near_duplicates

    return near_duplicates(table(spark, sf_dir, "embeddings"), cosine=0.98)


@query("op13_source_divergence", oracles.OP13)
def op13_source_divergence(spark, sf_dir):
    """Every source against the others of its language, and its 200 most excessive terms."""
    from tierwell.llm.divergence import audit

    return audit(table(spark, sf_dir, "documents"), min_docs=3, top=200)


@query("op12_tokenizer_alignment")
def op12_tokenizer_alignment(spark, sf_dir):
    """Groups and links between the byte-level and the piece tokenizer, per document."""
    import public_tokenizers

    from tierwell.llm.alignment import align_tokenizers

    return align_tokenizers(
        table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
    )


@query("op11_secret_scan")
def op11_secret_scan(spark, sf_dir):
    """Spans of secrets in every document: the fixed patterns, and values that are hard to guess."""
    from pyspark.sql import functions as F

    from tierwell.llm.secrets import count_of, listed, scan

    return scan(table(spark, sf_dir, "documents")).select(
        "doc_id", *[count_of(kind).alias(f"n_{kind}") for kind in ("assign", "access", "hex")],
        F.sha2(listed("base"), 256).alias("base_sha256"), listed("findings").alias("spans"),
    )
