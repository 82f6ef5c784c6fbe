"""Divergence between the sources of a language: which sources differ, and by which terms.

Every (lang, source) has a smoothed share of 10**9 for each term its language keeps; two sources are compared term by
term, and a source with its whole language. All arithmetic is on integers.

Method: a pair task per shard of terms and pair of blocks of sources. A shard holds some terms of one language, as one
sorted (term id, count) array per source; a task has the arrays of two blocks of sources, and intersects the two arrays
of every unordered pair by galloping. The overlap, the terms of one side only and those of neither are priced both ways.

No group grows with a hot source: it adds one entry per term and source, counted per task before the shuffle, and the
number of shards follows the number of entries of the language.

Hard cases: null text, lang or source is ''; rows that share an id are documents of their own; a language without kept
terms has pairs of value 0 and no term rows; an empty table gives no rows; other columns are ignored; ties go to the
smaller item in UTF-8 order.
"""

from functools import partial

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window, functions as F

from tierwell.llm.common import stored
from tierwell.llm.terms import group_counts

UNIT = 1_000_000_000
#: Entries (source, term) of a shard, and sources of a block.
SHARD_ENTRIES = 250_000
BLOCK_SOURCES = 32
#: Languages up to which their table of one short row each is broadcast; with more, rows are dealt out again after the join.
FEW_LANGS = 100_000


def share(count: np.ndarray, weight: np.ndarray | int) -> np.ndarray:
    """1 + floor(10**9 * (count + 1) / weight), three digits at a time.

    Exact while ``weight`` (the counts of a group and its terms) is below 9 * 10**15.
    """
    whole, rest = np.zeros_like(count), count + 1
    for _ in range(3):
        rest = rest * 1000
        whole = whole * 1000 + rest // weight
        rest = rest % weight
    return whole + 1


def _share_sql(count: str, weight: str) -> str:
    """The same as ``share``, as a SQL expression."""
    whole, rest = "0L", f"({count} + 1)"
    for _ in range(3):
        whole, rest = f"({whole} * 1000 + ({rest} * 1000) div {weight})", f"(({rest} * 1000) % {weight})"
    return f"({whole} + 1)"


def distance(p, q):
    return (p - q) * (p - q) // q


def gallop(short: np.ndarray, long: np.ndarray) -> np.ndarray:
    """The first place in sorted ``long`` that is not below each key of sorted ``short``.

    Every 64th key is placed by binary search; the others start from there and double their steps until they are past
    the key, all at once, and halve the bracket that is left.
    """
    low = np.repeat(np.searchsorted(long, short[::64]), 64)[: len(short)]
    high, step = low.copy(), 1
    open_ = np.flatnonzero(low < len(long))
    open_ = open_[long[low[open_]] < short[open_]]
    while len(open_):
        low[open_] = high[open_] + 1
        high[open_] = np.minimum(low[open_] + step, len(long))
        step *= 2
        open_ = open_[high[open_] < len(long)]
        open_ = open_[long[high[open_]] < short[open_]]
    open_ = np.flatnonzero(low < high)
    while len(open_):
        middle = (low[open_] + high[open_]) // 2
        below = long[middle] < short[open_]
        low[open_] = np.where(below, middle + 1, low[open_])
        high[open_] = np.where(below, high[open_], middle)
        open_ = open_[low[open_] < high[open_]]
    return low


def price(a, b, n_terms: int) -> tuple[int, int]:
    """Summed distances of a against b and of b against a over the ``n_terms`` terms of a shard.

    Each side is (sorted ids, shares, share of an absent term).
    """
    (ids_a, p_a, none_a), (ids_b, p_b, none_b) = a, b
    if len(ids_a) > len(ids_b):
        return price(b, a, n_terms)[::-1]
    place = gallop(ids_a, ids_b)
    hit = place < len(ids_b)
    hit[hit] = ids_b[place[hit]] == ids_a[hit]
    place = place[hit]
    rest_b = np.delete(p_b, place)
    absent = n_terms - len(ids_a) - len(rest_b)
    both_a, both_b, only_a = p_a[hit], p_b[place], p_a[~hit]
    forth = distance(both_a, both_b).sum() + distance(only_a, none_b).sum() + distance(none_a, rest_b).sum()
    back = distance(both_b, both_a).sum() + distance(none_b, only_a).sum() + distance(rest_b, none_a).sum()
    return int(forth) + absent * distance(none_a, none_b), int(back) + absent * distance(none_b, none_a)


def _arrays(rows: pd.DataFrame) -> pd.DataFrame:
    """One row per source of a shard: the ids its terms have in this shard, sorted, and their counts."""
    ids, _ = pd.factorize(rows["term"])
    order = np.lexsort((ids, rows["source"].to_numpy(dtype=object)))
    sources, counts, ids = rows["source"].to_numpy(dtype=object)[order], rows["n"].to_numpy()[order], ids[order]
    first = np.flatnonzero(np.r_[True, sources[1:] != sources[:-1]])
    ends = np.r_[first[1:], len(sources)]
    return pd.DataFrame({
        "lang": rows["lang"].iloc[0], "shard": rows["shard"].iloc[0], "source": sources[first],
        "ids": [ids[a:b].astype("<i4").tobytes() for a, b in zip(first, ends)],
        "counts": [counts[a:b].astype("<i8").tobytes() for a, b in zip(first, ends)],
    })


def _pairs(rows: pd.DataFrame) -> pd.DataFrame:
    """Both directions of every unordered pair of sources of this task's two blocks."""
    rows = rows.sort_values("source")
    n_terms, lang = int(rows["n_terms"].iloc[0]), rows["lang"].iloc[0]
    sides: dict[int, list] = {}
    for row in rows.itertuples():
        counts = np.frombuffer(row.counts or b"", dtype="<i8")
        side = (np.frombuffer(row.ids or b"", dtype="<i4"), share(counts, row.weight),
                int(share(np.zeros(1, dtype=np.int64), row.weight)[0]))
        sides.setdefault(row.block, []).append((row.source, side))
    lo, hi = sides.get(rows["lo"].iloc[0], []), sides.get(rows["hi"].iloc[0], [])
    out = []
    for i, (a, side_a) in enumerate(lo):
        for b, side_b in (lo[i + 1 :] if rows["lo"].iloc[0] == rows["hi"].iloc[0] else hi):
            forth, back = price(side_a, side_b, n_terms)
            out += [(lang, a, b, forth), (lang, b, a, back)]
    return pd.DataFrame(out, columns=["lang", "source", "item", "value"])


def kept_terms(docs: DataFrame, min_docs: int) -> DataFrame:
    """(lang, source, term, n, n_lang, first): occurrences of each kept term in the source and in the language.

    ``first`` marks one row of each (lang, term). One shuffle by language and term serves the sums and the window.
    """
    named = docs.select(*[F.coalesce(F.col(name).cast("string"), F.lit("")).alias(name) for name in ("lang", "source", "text")])
    counted = named.mapInArrow(
        partial(group_counts, groups=["lang", "source"]), "lang string, source string, term string, n long, n_docs long"
    )
    sums = counted.repartition("lang", "term").groupBy("lang", "source", "term").agg(
        F.sum("n").alias("n"), F.sum("n_docs").alias("n_docs")
    )
    term = Window.partitionBy("lang", "term")
    return sums.select(
        "lang", "source", "term", "n", F.sum("n").over(term).alias("n_lang"), F.sum("n_docs").over(term).alias("_docs"),
        (F.row_number().over(term.orderBy("source")) == 1).alias("first"),
    ).where(F.col("_docs") >= min_docs).drop("_docs")


def audit(docs: DataFrame, min_docs: int = 3, top: int = 200) -> DataFrame:
    """(lang, source, part, item, value, rank).

    Part ``pair``: every other source of the language, by the summed distance of the source's shares from the other's.
    Part ``term``: the ``top`` terms the source has a larger share of than its language has.
    """
    kept = stored(kept_terms(docs, min_docs), "divergence-terms")
    sources = docs.groupBy(*[F.coalesce(F.col(name).cast("string"), F.lit("")).alias(name) for name in ("lang", "source")]).agg(
        F.lit(1).alias("_one")
    ).drop("_one")
    langs = stored(kept.groupBy("lang").agg(
        F.count_if("first").alias("v"), F.sum("n").alias("total"),
        F.ceil(F.count("*") / SHARD_ENTRIES).cast("long").alias("shards"),
    ), "divergence-langs")
    blocks = sources.groupBy("lang").agg(F.ceil(F.count("*") / BLOCK_SOURCES).cast("long").alias("blocks"))
    sums = kept.groupBy("lang", "source").agg(F.sum("n").alias("_n"))
    groups = stored(
        sources.join(langs, "lang", "left").join(blocks, "lang").join(sums, ["lang", "source"], "left").select(
            "lang", "source", "v", "shards", "blocks", (F.coalesce("_n", F.lit(0)) + F.col("v")).alias("weight"),
            (F.col("total") + F.col("v")).alias("lang_weight"),
            F.expr("pmod(xxhash64(source), blocks)").alias("block"),
        ), "divergence-groups",
    )

    # Without the broadcast a join by language would leave all shards of a language in one task.
    langs = langs.select("lang", "shards")
    few = langs.count() <= FEW_LANGS
    dealt = kept.join(F.broadcast(langs) if few else langs, "lang").withColumn("shard", F.expr("pmod(xxhash64(term), shards)"))
    if not few:
        dealt = dealt.repartition("lang", "shard")
    arrays = dealt.select("lang", "shard", "source", "term", "n").groupBy("lang", "shard").applyInPandas(
        _arrays, "lang string, shard long, source string, ids binary, counts binary"
    )
    shards = dealt.where("first").groupBy("lang", "shard").agg(F.count("*").alias("n_terms"))
    # A source without a term of the shard is priced by its absent terms.
    grid = groups.where("v IS NOT NULL").join(shards, "lang").repartition("lang", "shard", "source").join(
        arrays, ["lang", "shard", "source"], "left"
    )
    tasks = grid.select(
        "lang", "shard", "n_terms", "source", "block", "weight", "ids", "counts",
        F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("_other"),
    ).withColumns({"lo": F.least("block", "_other"), "hi": F.greatest("block", "_other")}).drop("_other")
    priced = tasks.groupBy("lang", "shard", "lo", "hi").applyInPandas(
        _pairs, "lang string, source string, item string, value long"
    ).groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))
    bare = groups.where("v IS NULL").select("lang", "source")
    unpriced = bare.join(bare.withColumnRenamed("source", "item"), "lang").where("source != item")
    pair = priced.unionByName(unpriced.withColumn("value", F.lit(0).cast("long")))

    shares = kept.join(groups.select("lang", "source", "weight", "lang_weight"), ["lang", "source"]).selectExpr(
        "lang", "source", "term AS item", f"{_share_sql('n', 'weight')} AS p", f"{_share_sql('n_lang', 'lang_weight')} AS q"
    )
    term = shares.where("p > q").selectExpr("lang", "source", "item", "((p - q) * (p - q)) div q AS value")
    ranking = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")

    def ranked(rows: DataFrame, part: str) -> DataFrame:
        return rows.select(
            "lang", "source", F.lit(part).alias("part"), "item", F.col("value").cast("long").alias("value"),
            F.row_number().over(ranking).alias("rank"),
        )

    return ranked(pair, "pair").unionByName(ranked(term, "term").where(F.col("rank") <= top))
