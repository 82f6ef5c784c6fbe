"""Mixing sources to target weights (operator 3): hierarchical budgets and seeded epochs.

Documents are leaves' members in a tree domain -> language -> source. A budget of tokens runs down the tree: every node
splits its budget among its children by weight. A child can hold at most what its documents give in ``max_epochs``
passes; what it cannot hold goes to its siblings first, by weight again, and only when all of them are full does it
remain to be shared by the siblings of the parent. As a node's capacity is the sum of its children's, one split per
level from the root downwards does both: a parent is never given more than its subtree can hold.

A leaf with T tokens of budget over S tokens of documents takes every document T div S times and, of one further
epoch, the longest prefix that fits into the rest, in an order drawn from seed, epoch and id.

Everything is DataFrame code. Token sums per leaf are stored once, so documents are read twice; they and those per
slice of the order are combined before the shuffle, splits run over nodes, not documents, and a leaf that holds a
third of all documents is ordered in 256 slices.

Cases: null language or source is the node named ""; null or empty text has 0 tokens and takes part; weights of 0 (or
null) take nothing, and if all weights are 0 nothing is chosen; rows that repeat an id are members of their own; an
empty table gives no rows. Columns of the input are kept; the operator's own start with an underscore, and input columns
of the same names are replaced.
"""

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.window import Window

from tierwell.llm.common import running, stored

#: Words as in the other operators: runs of other characters than the six ASCII white space ones.
WORDS = r"[^ \t-\r]+"

LEVELS = ("_domain", "_lang", "_source")

LANGUAGE_WEIGHTS = {"en": 5, "de": 2, "fr": 2, "es": 1}
DOMAIN_WEIGHTS = {"domain0": 4, "domain1": 3, "domain2": 2, "domain3": 1}


def weighted(column: str, weights: dict[str, int], other: int = 1) -> Column:
    chosen = F.lit(other)
    for name, weight in weights.items():
        chosen = F.when(F.col(column) == name, weight).otherwise(chosen)
    return chosen.cast("long")


def domain_of(source: str = "source") -> Column:
    """Domain of a source: its number modulo four; names without a number are the domain "other"."""
    number = F.regexp_extract(source, r"(\d+)$", 1)
    return F.when(number != "", F.concat(F.lit("domain"), F.pmod(number.cast("decimal(38,0)"), F.lit(4)).cast("string"))).otherwise("other")


def split(children: DataFrame, parent: list[str], child: str) -> DataFrame:
    """``_budget`` of a parent dealt to its children by ``_weight``, at most ``_capacity`` each, in whole tokens.

    Children are ordered by capacity per weight. One is full if its share of what the fuller ones before it leave
    is at least its capacity; those are a prefix. The others share the rest by weight.
    """
    group = Window.partitionBy(*parent)
    ordered = group.orderBy("_ratio", child)
    earlier = ordered.rowsBetween(Window.unboundedPreceding, -1)
    big = lambda c: F.col(c).cast("decimal(38,0)")
    left = big("_budget") - F.coalesce(F.sum(big("_capacity")).over(earlier), F.lit(0))
    weight = F.sum(big("_weight")).over(group) - F.coalesce(F.sum(big("_weight")).over(earlier), F.lit(0))
    marked = (
        children.where("_weight > 0").withColumn("_ratio", F.col("_capacity") / F.col("_weight"))
        .withColumn("_left", left.cast("decimal(38,0)")).withColumn("_of", weight.cast("decimal(38,0)"))
        .withColumn("_full", F.expr("CAST(_capacity AS DECIMAL(19,0)) * CAST(_of AS DECIMAL(19,0)) <= CAST(_left AS DECIMAL(19,0)) * CAST(_weight AS DECIMAL(19,0))"))
        .withColumn("_open_left", F.col("_budget") - F.coalesce(F.sum(F.when(F.col("_full"), F.col("_capacity"))).over(group), F.lit(0)))
        .withColumn("_open_of", F.sum(F.when(~F.col("_full"), F.col("_weight"))).over(group))
    )
    share = F.expr("CAST(CAST(CAST(_open_left AS DECIMAL(19,0)) * CAST(_weight AS DECIMAL(19,0)) AS DECIMAL(38,0)) div CAST(_open_of AS DECIMAL(38,0)) AS BIGINT)")
    return marked.withColumn("_given", F.when(F.col("_full"), F.col("_capacity")).otherwise(share)).drop(
        "_ratio", "_left", "_of", "_full", "_open_left", "_open_of", "_budget"
    ).withColumnRenamed("_given", "_budget")


def budgets(leaves: DataFrame, max_epochs: int, share: float, weights: dict[str, Column]) -> DataFrame:
    """Leaves (domain, language, source, _tokens) with the ``_budget`` of each."""
    nodes = leaves.withColumn("_capacity", F.col("_tokens") * max_epochs)
    given = nodes.agg(F.floor(F.sum("_tokens") * F.lit(share)).cast("long").alias("_budget")).withColumn("_root", F.lit(0))
    path: list[str] = ["_root"]
    nodes = nodes.withColumn("_root", F.lit(0))
    for level in LEVELS:
        children = nodes.groupBy(*path, level).agg(F.sum("_capacity").alias("_capacity"), F.sum("_tokens").alias("_tokens"))
        children = children.join(given.select(*path, "_budget"), path).withColumn("_weight", weights[level])
        given = split(children, path, level)
        path = [*path, level]
    return given.select(*LEVELS, "_tokens", "_budget")


def mix(
    docs: DataFrame, max_epochs: int = 2, share: float = 1.0, seed: int = 17, domain: Column | None = None,
    weights: dict[str, Column] | None = None,
) -> DataFrame:
    """The chosen documents with all their columns, one row per epoch (``_epoch`` from 0), in the mixture's proportions.

    ``share``: budget as a share of all tokens. ``weights``: an integer column per level over the level's name.
    """
    weights = {
        "_domain": weighted("_domain", DOMAIN_WEIGHTS), "_lang": weighted("_lang", LANGUAGE_WEIGHTS),
        "_source": F.lit(1).cast("long"),
    } | (weights or {})
    own = [*LEVELS, "_n", "_full", "_rest", "_digest", "_before", "_epoch", "_tokens", "_budget"]
    kept = [c for c in docs.columns if c not in own]
    placed = docs.select(
        *kept,
        F.coalesce(domain_of() if domain is None else domain, F.lit("")).alias("_domain"),
        F.coalesce(F.col("lang").cast("string"), F.lit("")).alias("_lang"),
        F.coalesce(F.col("source").cast("string"), F.lit("")).alias("_source"),
        F.coalesce(F.regexp_count("text", F.lit(WORDS)), F.lit(0)).cast("long").alias("_n"),
    )
    leaves = stored(placed.groupBy(*LEVELS).agg(F.sum("_n").alias("_tokens")), "leaves")
    # Stored, so that Spark knows its size before it plans the join with the documents: small, it is sent to them,
    # and their text is shuffled once, into the slices of the order.
    plan = stored(budgets(leaves, max_epochs, share, weights).select(
        *LEVELS,
        F.expr("if(_tokens > 0, _budget div _tokens, 0)").cast("long").alias("_full"),
        F.expr("if(_tokens > 0, _budget % _tokens, 0)").cast("long").alias("_rest"),
    ), "plan")
    drawn = placed.join(plan, list(LEVELS)).withColumn(
        "_digest", F.md5(F.concat_ws(":", F.lit(str(seed)), F.col("_full").cast("string"), F.col("doc_id").cast("string")))
    )
    ordered = running(drawn, list(LEVELS), ["_digest", "doc_id", "_n"], F.col("_n"), "_before")
    copies = F.col("_full") + F.when(F.col("_before") + F.col("_n") <= F.col("_rest"), 1).otherwise(0)
    chosen = ordered.where(copies > 0).withColumn("_epoch", F.explode(F.sequence(F.lit(0).cast("long"), copies.cast("long") - 1)))
    return chosen.select(*kept, *LEVELS, "_epoch", F.col("_n").alias("_tokens"))
