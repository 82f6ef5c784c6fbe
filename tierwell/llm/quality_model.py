"""Quality classifier (operator 1): perplexity under an interpolated modified Kneser-Ney model of trusted text.

The model's units are bytes as they are, its order is 6: the n-grams are as many as the texts hold (256**6 are possible).
Training text are the documents labelled as good and not toxic.

* Shards: an n-gram belongs to the shard of the third and second last of its units. All that it is judged by from order 3
  up (its suffixes, their contexts, the other n-grams of those contexts) lies in the same shard.
* Counts: every task counts the n-grams of its trusted documents, and the counts meet in their shard. There each lower
  order has continuation counts (in how many different contexts an n-gram occurs), per context the total and the number of
  n-grams that occur once, twice and more often. The three discounts of an order (Chen and Goodman 1998) come from counts
  of counts over all shards. Each order is interpolated with the next lower one, the lowest with the uniform distribution.
* The driver gets four counts of counts per order and the counts of the orders 1 and 2, which have 256**2 cells at most;
  orders 3 to 6 stay in their shards.
* Scoring: documents are dealt into blocks. A block asks each shard once for its distinct n-grams, and the shard answers
  with their log probabilities, those it has not seen by their longest known suffix. The perplexity of a document is a
  mean over its whole text. Questions and answers grow with the corpus; no task holds the model or all questions.
* A document is kept if its perplexity is at most the threshold of its language. Thresholds come from trusted documents that
  the model which judges them has not seen: an eighth of them (by hash, at least one) is scored by a model of the others,
  while the model of all scores the corpus. A threshold is the given quantile of those of the language, from counts
  in bins of 1/1000 of log perplexity, drawn towards the quantile of all languages by their number n (weights n and
  ``enough``), times a tolerance. A language without any uses the quantile of all.

Cases: null or empty text has no perplexity (null) and is not kept; texts of one sign are scored with the padding
before it; null languages are the language ""; labels may be null or repeat (any good, non-toxic label makes a document
trusted unless another one contradicts it); without trusted documents the model is uniform and every text is kept;
rows that repeat an id are judged each; an empty table gives no rows. Extra columns are ignored.
"""

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.window import Window

from tierwell.llm import textscan
from tierwell.llm.common import id_filter, only_near, stored

SIGNS, ORDER = 256, 6
SHARDS = 256

#: Bytes of text in a block, the least number of blocks, and n-grams that a task holds before it passes them on.
BLOCK, BLOCKS, HELD = 1 << 23, 64, 1 << 21

#: One of so many trusted documents is held out of the model that thresholds are taken from.
FOLDS = 8

_FOLD = np.arange(256, dtype=np.int64)  # every byte is a unit of its own
_BITS = 8
_LOW = 1 << (2 * _BITS)  # cells of order 2

_COUNTS = pa.schema([("shard", pa.int32()), ("grams", pa.binary()), ("counts", pa.binary())])
_COUNTS_SQL = "shard int, grams binary, counts binary"
_ASKED = pa.schema([("shard", pa.int32()), ("block", pa.int64()), ("grams", pa.binary())])
_ANSWERS = pa.schema([("block", pa.int64()), ("shard", pa.int32()), ("p", pa.binary())])
_SCORES = pa.schema([("doc_id", pa.int64()), ("language", pa.string()), ("log_perplexity", pa.float64())])


def codes(buffer: np.ndarray, offsets: np.ndarray):
    """n-gram of each byte with those before it; what lies before a text's start counts as 0."""
    sign = _FOLD[buffer]
    place = np.arange(len(buffer)) - np.repeat(offsets[:-1], np.diff(offsets))
    code = sign.copy()
    for back in range(1, ORDER):
        before = np.zeros_like(sign)
        before[back:] = sign[:-back]
        before[place < back] = 0
        code |= before << (_BITS * back)
    return code


def _shard(grams: np.ndarray) -> np.ndarray:
    pair = (grams >> _BITS) & (_LOW - 1)
    return (textscan.mixed(pair.astype(np.uint64)) % np.uint64(SHARDS)).astype(np.int32)


def _packed(values: np.ndarray) -> bytes:
    """Bytes of the same weight lie together, which is shorter."""
    return zlib.compress(values.view(np.uint8).reshape(-1, values.itemsize).T.tobytes(), 1)


def _unpacked(raw: bytes, kind) -> np.ndarray:
    size = np.dtype(kind).itemsize
    return np.frombuffer(np.ascontiguousarray(np.frombuffer(zlib.decompress(raw), np.uint8).reshape(size, -1).T).tobytes(), kind)


def _pack_grams(grams: np.ndarray) -> bytes:
    return _packed(np.diff(grams, prepend=0))


def _unpack_grams(raw: bytes) -> np.ndarray:
    return np.cumsum(_unpacked(raw, np.int64))


def _add(grams: list, counts: list) -> tuple[np.ndarray, np.ndarray]:
    """Distinct n-grams in order, with the sums of their counts."""
    if not grams:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    grams, counts = np.concatenate(grams), np.concatenate(counts)
    order = np.argsort(grams, kind="stable")
    grams, counts = grams[order], counts[order]
    first = np.flatnonzero(np.diff(grams, prepend=-1))
    return grams[first], np.add.reduceat(counts, first) if len(first) else counts


def _by_shard(grams: np.ndarray):
    """(shard, places) of sorted n-grams; places are in order."""
    shard = _shard(grams)
    order = np.argsort(shard, kind="stable")
    found, first = np.unique(shard[order], return_index=True)
    return zip(found.tolist(), np.split(order, first[1:]))


def gram_counts(texts: DataFrame) -> DataFrame:
    """(shard, grams, counts) of the texts (doc_id, text): how often each n-gram occurs, packed, a row per shard."""

    def rows(grams, counts):
        out = [(shard, _pack_grams(grams[at]), _packed(counts[at])) for shard, at in _by_shard(grams)]
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(zip(*out), _COUNTS)], schema=_COUNTS)

    def tasks(batches):
        grams, counts, held = [], [], 0
        for batch in batches:
            for _, buffer, offsets in textscan.chunks(batch.column(0), batch.column(1)):
                g, c = np.unique(codes(buffer, offsets), return_counts=True)
                grams.append(g)
                counts.append(c.astype(np.int64))
                held += len(g)
                if held > HELD:
                    g, c = _add(grams, counts)
                    if len(g) > HELD // 2:
                        yield from rows(g, c)
                        grams, counts, held = [], [], 0
                    else:
                        grams, counts, held = [g], [c], len(g)
        yield from rows(*_add(grams, counts))

    return added_counts(texts.mapInArrow(tasks, _COUNTS_SQL))


def added_counts(parts: DataFrame) -> DataFrame:
    """One row per shard of any number of rows of counts."""

    def meet(parts: pa.Table) -> pa.Table:
        grams, counts = _add(
            [_unpack_grams(x) for x in parts.column("grams").to_pylist()], [_unpacked(x, np.int64) for x in parts.column("counts").to_pylist()]
        )
        return pa.table([parts.column("shard").slice(0, 1), [_pack_grams(grams)], [_packed(counts)]], schema=_COUNTS)

    return parts.groupBy("shard").applyInArrow(meet, _COUNTS_SQL)


def _orders(grams: np.ndarray, counts: np.ndarray) -> dict:
    """order -> (n-grams, counts) of a shard: continuation counts below the highest order."""
    out = {ORDER: (grams, counts)}
    for order in range(ORDER - 1, 2, -1):
        grams, counts = np.unique(grams & ((1 << (_BITS * order)) - 1), return_counts=True)
        out[order] = grams, counts
    return out


def _discounts(n: list) -> list:
    """Discounts of n-grams that occur once, twice and more often, from how many occur 1, 2, 3 and 4 times."""
    y = n[0] / (n[0] + 2 * n[1]) if n[0] + n[1] else 0.5
    return [min(max(i - (i + 1) * y * n[i] / n[i - 1], 0.05), i - 0.05) if n[i - 1] and n[i] else 0.5 for i in (1, 2, 3)]


def _interpolated(grams, counts, discounts):
    """(n-grams, discounted share of each; contexts, what each leaves to the lower order)."""
    cut = np.asarray(discounts)[np.minimum(counts, 3) - 1]
    contexts, first = np.unique(grams >> _BITS, return_index=True)
    if not len(first):
        return grams, np.zeros(0), contexts, np.zeros(0)
    total = np.add.reduceat(counts.astype(np.float64), first)
    left = np.add.reduceat(cut, first) / total
    share = (counts - cut) / np.repeat(total, np.diff(first, append=len(grams)))
    return grams, share, contexts, left


def _found(keys: np.ndarray, values: np.ndarray, wanted: np.ndarray, missing: float) -> np.ndarray:
    if not len(keys):
        return np.full(len(wanted), missing)
    at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    return np.where(keys[at] == wanted, values[at], missing)


def _probabilities(grams: np.ndarray, order: int, model: tuple, lower: np.ndarray) -> np.ndarray:
    """Probabilities in one order of n-grams that have ``lower`` in the one below; unknown contexts leave all to it."""
    known, share, contexts, left = model
    suffix = grams & ((1 << (_BITS * order)) - 1)
    return _found(known, share, suffix, 0.0) + _found(contexts, left, suffix >> _BITS, 1.0) * lower


def kneser_ney(counts: DataFrame) -> tuple[dict, np.ndarray]:
    """Discounts of the orders from 3 up, and the probabilities of all n-grams of order 2."""
    schema = pa.schema([("kind", pa.int32()), ("cell", pa.int32()), ("n", pa.int64())])

    def summaries(batches):
        """Counts of counts (kind is the order) and counts of order 2 (kind 2)."""
        for batch in batches:
            for grams, many in zip(batch.column("grams").to_pylist(), batch.column("counts").to_pylist()):
                orders = _orders(_unpack_grams(grams), _unpacked(many, np.int64))
                out = [(k, i, int((c == i).sum())) for k, (_, c) in orders.items() for i in (1, 2, 3, 4)]
                pairs, times = np.unique(orders[3][0] & (_LOW - 1), return_counts=True)
                out += [(2, cell, n) for cell, n in zip(pairs.tolist(), times.tolist())]
                yield pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(zip(*out), schema)], schema=schema)

    found = counts.mapInArrow(summaries, "kind int, cell int, n long").groupBy("kind", "cell").agg(F.sum("n").alias("n")).toPandas()
    n = {k: {c: x for c, x in zip(rows["cell"], rows["n"])} for k, rows in found.groupby("kind")}
    discounts = {k: _discounts([float(n.get(k, {}).get(i, 0)) for i in (1, 2, 3, 4)]) for k in range(3, ORDER + 1)}
    pairs = np.array(sorted(n.get(2, {})), dtype=np.int64)
    times = np.array([n[2][x] for x in pairs.tolist()], dtype=np.int64)
    below = np.full(_LOW, 1.0 / SIGNS)
    singles, contexts = np.unique(pairs & (SIGNS - 1), return_counts=True)
    for order, grams, many in ((1, singles, contexts), (2, pairs, times)):
        own = _discounts([float((many == i).sum()) for i in (1, 2, 3, 4)])
        below = _probabilities(np.arange(_LOW), order, _interpolated(grams, many, own), below)
    return discounts, below


def perplexities(texts: DataFrame, counts: DataFrame, discounts: dict, low: np.ndarray) -> DataFrame:
    """doc_id, language, log_perplexity (null without text) of rows (doc_id, text, language).

    The blocks of documents are shuffled once and read twice: for the questions and for the scores.
    """
    shared = texts.sparkSession.sparkContext.broadcast(low)
    size = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = max(BLOCKS, -(-size // BLOCK))
    dealt = texts.select(
        "doc_id", "text", "language", F.pmod(F.xxhash64("doc_id", "text"), F.lit(blocks)).cast("long").alias("block")
    ).repartition("block")

    def distinct(docs: pa.Table) -> np.ndarray:
        grams, held, rest = np.zeros(0, np.int64), [], 0
        for _, buffer, offsets in textscan.chunks(pa.array(np.arange(docs.num_rows)), docs.column("text")):
            held.append(np.unique(codes(buffer, offsets)))
            rest += len(held[-1])
            if rest > HELD:
                grams, held, rest = np.unique(np.concatenate([grams, *held])), [], 0
        return np.unique(np.concatenate([grams, *held]))

    def ask(docs: pa.Table) -> pa.Table:
        grams, block = distinct(docs), docs.column("block")[0].as_py()
        out = [(shard, block, _pack_grams(grams[at])) for shard, at in _by_shard(grams)]
        return pa.Table.from_pydict(dict(zip(_ASKED.names, zip(*out))) if out else {n: [] for n in _ASKED.names}, schema=_ASKED)

    def answer(asked: pa.Table, known: pa.Table) -> pa.Table:
        models = {}
        if asked.num_rows and known.num_rows:
            grams = _unpack_grams(known.column("grams")[0].as_py())
            for order, (g, c) in _orders(grams, _unpacked(known.column("counts")[0].as_py(), np.int64)).items():
                models[order] = _interpolated(g, c, discounts[order])
        out = []
        for raw in asked.column("grams").to_pylist():
            grams = _unpack_grams(raw)
            p = shared.value[grams & (_LOW - 1)]
            for order in sorted(models):
                p = _probabilities(grams, order, models[order], p)
            out.append(_packed(np.log(p).astype(np.float32)))
        return pa.table([asked.column("block"), asked.column("shard"), pa.array(out, pa.binary())], schema=_ANSWERS)

    def score(docs: pa.Table, answers: pa.Table) -> pa.Table:
        mean = np.full(docs.num_rows, np.nan)
        grams = distinct(docs)
        p = np.full(len(grams), np.nan, np.float32)
        given = dict(zip(answers.column("shard").to_pylist(), answers.column("p").to_pylist()))
        for shard, at in _by_shard(grams):
            p[at] = _unpacked(given[shard], np.float32)
        for places, buffer, offsets in textscan.chunks(pa.array(np.arange(docs.num_rows)), docs.column("text")):
            filled = np.diff(offsets) > 0
            if filled.any():
                here, at = np.unique(codes(buffer, offsets), return_inverse=True)
                total = np.add.reduceat(p[np.searchsorted(grams, here)][at], offsets[:-1][filled], dtype=np.float64)
                mean[places[filled]] = -total / np.diff(offsets)[filled]
        return pa.table([docs.column("doc_id"), docs.column("language"), pa.array(mean, mask=np.isnan(mean))], schema=_SCORES)

    asked = dealt.groupBy("block").applyInArrow(ask, "shard int, block long, grams binary")
    answers = asked.groupBy("shard").cogroup(counts.groupBy("shard")).applyInArrow(answer, "block long, shard int, p binary")
    return dealt.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(
        score, "doc_id long, language string, log_perplexity double"
    )


def classify(
    docs: DataFrame, labels: DataFrame, quantile: float = 0.995, tolerance: float = 1.05, enough: int = 100
) -> DataFrame:
    """doc_id, language, perplexity, threshold, kept."""
    texts = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"),
        F.coalesce(F.col("lang").cast("string"), F.lit("")).alias("language"),
    )
    judged = labels.groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(
        F.min(F.when((F.col("quality") == 1) & (F.coalesce(F.col("toxic"), F.lit(0)) == 0), 1).otherwise(0)).alias("good")
    )
    dealt = F.pmod(F.xxhash64("doc_id", F.lit("held out")), F.lit(1 << 40))
    good = judged.where("good = 1").select("doc_id", dealt.alias("dealt"))
    first = good.agg(F.min("dealt").alias("least")).select("least").scalar()
    trusted = stored(good.select("doc_id", ((F.col("dealt") % FOLDS == 0) | (F.col("dealt") == first)).alias("held")), "trusted")
    training = only_near(texts.where("doc_id IS NOT NULL"), id_filter(trusted)).join(trusted, "doc_id")
    held = training.where("held").select("doc_id", "text", "language")
    most = stored(gram_counts(training.where("NOT held").select("doc_id", "text")), "counts_of_most")
    counts = stored(added_counts(most.unionByName(gram_counts(held.select("doc_id", "text")))), "counts")
    judges = stored(perplexities(held, most, *kneser_ney(most)), "held_out")
    scored = stored(perplexities(texts, counts, *kneser_ney(counts)), "perplexities")

    bins = judges.where("log_perplexity IS NOT NULL").groupBy(
        "language", F.floor(F.col("log_perplexity") * 1000).alias("bin")
    ).agg(F.count("*").alias("n"))
    both = bins.unionByName(bins.groupBy(F.lit(None).cast("string").alias("language"), "bin").agg(F.sum("n").alias("n")))
    upto = Window.partitionBy("language").orderBy("bin")
    whole = Window.partitionBy("language")
    limits = both.withColumn("upto", F.sum("n").over(upto)).withColumn("all", F.sum("n").over(whole)).where(
        F.col("upto") >= F.ceil(F.col("all") * quantile)
    ).groupBy("language").agg(F.max("all").alias("all"), ((F.min("bin") + 1) / 1000.0).alias("at"))
    limits = stored(limits, "thresholds")
    general = limits.where("language IS NULL").select("at").first()
    everywhere = F.lit(general[0] if general else float("inf"))
    drawn = (F.col("all") * F.col("at") + F.lit(enough) * everywhere) / (F.col("all") + F.lit(enough))
    own = limits.where(F.col("language").isNotNull()).select("language", (F.exp(drawn) * tolerance).alias("threshold"))
    perplexity = F.exp("log_perplexity")
    return scored.join(own, "language", "left").select(
        "doc_id", "language", perplexity.alias("perplexity"),
        F.coalesce("threshold", F.exp(everywhere) * tolerance).alias("threshold"),
    ).withColumn("kept", F.coalesce(F.col("perplexity") <= F.col("threshold"), F.lit(False)))
