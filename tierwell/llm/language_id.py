"""Language ID (operator 10): Bayesian fusion of text, declared language, address suffix and host.

Languages are those that rows declare: every declared value with at least ``LEAST_ROWS`` rows and one in ``LEAST_SHARE`` of all
that declare any, so there are ``LEAST_SHARE`` at most. For every language l, log posterior = log P(l | host) + log P(declared | l) + log P(suffix | l) + text likelihood.

* Text: trigrams of folded bytes (lower case, other signs as blanks), a naive Bayes model counted over all rows that
  declare a language, each tempered to a third, as every sign is in three trigrams. A class "und" stands for everything
  else: half uniform trigrams, half the square roots of the trigram counts of all text. The first is likelier for signs without
  order, the second for words of a language that resembles a known one.
* Declared language and address suffix: their frequencies given the language that the text alone says, by grouped
  aggregation over all rows, smoothed (the declared one towards itself).
* Host: P(l | host) is smoothed towards the domain, that towards the suffix, and that towards all rows, each level from
  grouped counts without the row's own vote.

A row is rejected if it has no letters, if "und" is likeliest, or if the likeliest language stays under ``confidence``.

Cases: null or empty text has no likelihood and is rejected; null declared language, suffix or host is the value "",
smoothed like any other; rows that repeat an id are judged each by itself; extra columns are ignored; an empty table
gives no rows, a table in which no language is declared often enough rejects all. Counts are bounded by languages x 64**3 cells;
only grouped tables and short rows are shuffled.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tierwell.llm import textscan
from tierwell.llm.common import stored

NONE = "und"
CELLS = 64**3
LEAST_ROWS, LEAST_SHARE = 5, 2000

# Folding of bytes: letters without case, lead bytes, continuation bytes by their low bits, all else a blank.
_FOLD = np.zeros(256, dtype=np.int32)
_FOLD[97:123] = _FOLD[65:91] = np.arange(1, 27)
_FOLD[0x80:0xC0] = 28 + np.arange(64) % 32
_FOLD[0xC0:0x100] = np.where(np.arange(0xC0, 0x100) < 0xE0, 27, 60 + np.arange(0xC0, 0x100) % 4)


def trigrams(buffer: np.ndarray, offsets: np.ndarray):
    """(codes, row) of trigrams that hold a letter; none crosses a row."""
    if len(buffer) < 3:
        return np.zeros(0, dtype=np.int32), np.zeros(0, dtype=np.int64)
    sign = _FOLD[buffer]
    codes = (sign[:-2] << 12) | (sign[1:-1] << 6) | sign[2:]
    row = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    good = (codes > 0) & (row[:-2] == row[2:])
    return codes[good], row[:-2][good]


def declared_languages(rows: DataFrame) -> tuple[str, ...]:
    """The declared values with enough rows, in order of their names."""
    named = rows.where(~F.col("declared").isin("", NONE)).groupBy("declared").agg(F.count("*").alias("n"))
    total = named.agg(F.coalesce(F.sum("n"), F.lit(0))).scalar()
    enough = named.where(F.col("n") >= LEAST_ROWS + total / LEAST_SHARE)
    return tuple(sorted(r.declared for r in enough.select("declared").collect()))


def model(rows: DataFrame, languages: tuple[str, ...]) -> np.ndarray:
    """Log probabilities of trigrams: one line per language, the last for "und".

    Tasks count into one array a language, which they emit when 16 are open; sums are combined before the shuffle.
    """
    number = {name: i for i, name in enumerate(languages)}

    def filled(state):
        for line, cells in state.items():
            codes = np.flatnonzero(cells)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(codes), line, dtype=np.int32)), pa.array(codes.astype(np.int32)), pa.array(cells[codes])], ["line", "code", "n"]
            )

    def count(batches):
        state = {}
        for batch in batches:
            declared = np.array([number.get(x, -1) for x in batch.column(1).to_pylist()], dtype=np.int64)
            for places, buffer, offsets in textscan.chunks(pa.array(np.arange(batch.num_rows)), batch.column(0)):
                codes, row = trigrams(buffer, offsets)
                lines = declared[places][row]
                for line in np.unique(declared[places]):
                    if line >= 0:
                        found = np.bincount(codes[lines == line], minlength=CELLS)
                        state[int(line)] = state[int(line)] + found if int(line) in state else found
                if len(state) >= 16:
                    yield from filled(state)
                    state = {}
        yield from filled(state)

    counted = rows.select("text", "declared").mapInArrow(count, "line int, code int, n long").groupBy("line", "code").agg(F.sum("n").alias("n")).toArrow()
    counts = np.zeros((len(languages), CELLS))
    counts[counted.column("line").to_numpy(), counted.column("code").to_numpy()] = counted.column("n").to_numpy()
    smoothed = counts + 0.1
    known = np.log(smoothed / smoothed.sum(axis=1, keepdims=True))
    flat = np.sqrt(smoothed.sum(axis=0)) if languages else np.ones(CELLS)
    other = np.log(0.5 / CELLS + 0.5 * flat / flat.sum())
    return np.vstack([known, other[None, :]]).astype(np.float32)


def _scored(rows: DataFrame, table: np.ndarray) -> DataFrame:
    shared = rows.sparkSession.sparkContext.broadcast(table)
    names = [f"ll_{i}" for i in range(len(table))]
    given = [f for f in rows.schema if f.name != "text"]

    def score(batches):
        for batch in batches:
            likelihood = np.zeros((len(names), batch.num_rows))
            seen = np.zeros(batch.num_rows, dtype=np.int64)
            for places, buffer, offsets in textscan.chunks(pa.array(np.arange(batch.num_rows)), batch.column("text")):
                codes, row = trigrams(buffer, offsets)
                here = np.bincount(row, minlength=len(places))
                filled = here > 0
                starts = (np.cumsum(here) - here)[filled]
                seen[places] = here
                for i, line in enumerate(shared.value):
                    if len(starts):
                        likelihood[i, places[filled]] = np.add.reduceat(line[codes], starts, dtype=np.float64) / 3
            kept = batch.select([f.name for f in given])
            yield pa.RecordBatch.from_arrays(
                [*kept.columns, pa.array(seen), *map(pa.array, likelihood)], [*kept.schema.names, "_trigrams", *names]
            )

    kinds = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in given] + ["_trigrams long"] + [f"{n} double" for n in names])
    return rows.select(*[f.name for f in given], "text").mapInArrow(score, kinds)


def _largest(names: dict[str, F.Column]):
    if len(names) == 1:
        return F.struct(*[(v.alias("value"), F.lit(n).alias("name")) for n, v in names.items()][0])
    return F.greatest(*[F.struct(value.alias("value"), F.lit(name).alias("name")) for name, value in names.items()])


def identify(
    rows: DataFrame, id_column: str, languages: tuple[str, ...] | None = None, confidence: float = 0.6, strength: float = 20.0
) -> DataFrame:
    """id, language, confidence, kept for rows (id, text, declared, host, domain, suffix).

    ``languages``: the ones to tell apart; by default those that rows declare often enough.
    """
    evidence = ("declared", "host", "domain", "suffix")
    rows = rows.select(
        F.col(id_column).alias("_id"), F.col("text").cast("string").alias("text"),
        *[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in evidence],
    )
    if languages is None:
        languages = declared_languages(rows)
    every = (*languages, NONE)
    scored = stored(_scored(rows, model(rows, languages)), "likelihoods").withColumn(
        "said", F.when(F.col("_trigrams") > 0, _largest({x: F.col(f"ll_{i}") for i, x in enumerate(every)})["name"]).otherwise(NONE)
    )
    votes = [F.sum(F.when(F.col("said") == x, 1).otherwise(0)).alias(f"n_{i}") for i, x in enumerate(every)]

    def counted(by: list[str], prefix: str) -> DataFrame:
        found = scored.groupBy(*by).agg(F.count("*").alias("n"), *votes)
        return found.select(*by, F.col("n").alias(f"{prefix}_n"), *[F.col(f"n_{i}").alias(f"{prefix}_{i}") for i in range(len(every))])

    # Counts of the host, the domain, the suffix and all rows, and of the declared language.
    joined = scored
    for by, prefix in ((["suffix", "domain", "host"], "h"), (["suffix", "domain"], "d"), (["suffix"], "s"), (["declared"], "c")):
        joined = joined.join(counted(by, prefix), by)
    totals = stored(scored.agg(*votes), "votes")
    total = [float(v or 0) for v in totals.first()]
    every_row = sum(total)

    posterior = {}
    for i, x in enumerate(every):
        own = F.when(F.col("said") == x, 1.0).otherwise(0.0)
        prior = F.lit((total[i] + 1.0) / (every_row + len(every)))
        for prefix in "sdh":
            around = F.col(f"{prefix}_n") - 1.0
            prior = (F.col(f"{prefix}_{i}") - own + F.lit(strength) * prior) / (around + F.lit(strength))
        of_language = F.lit(total[i]) - own
        towards = F.when(F.col("declared") == x, 0.9).otherwise(0.1 / len(every))
        declares = (F.col(f"c_{i}") - own + F.lit(strength) * towards) / (of_language + F.lit(strength))
        ends = (F.col(f"s_{i}") - own + F.lit(strength) * 0.1) / (of_language + F.lit(strength))
        tiny = F.lit(1e-12)
        posterior[i] = F.log(F.greatest(prior, tiny)) + F.log(F.greatest(declares, tiny)) + F.log(F.greatest(ends, tiny)) + F.col(f"ll_{i}")
    fused = joined.select("_id", "_trigrams", *[value.alias(f"p_{i}") for i, value in posterior.items()])
    fused = fused.withColumn("_best", _largest({x: F.col(f"p_{i}") for i, x in enumerate(every)}))
    spread = sum((F.exp(F.col(f"p_{i}") - F.col("_best.value")) for i in range(len(every))), F.lit(0.0))
    sure = F.round(1.0 / spread, 9)
    return fused.select(
        F.col("_id").alias(id_column),
        F.when(F.col("_trigrams") > 0, F.col("_best.name")).otherwise(NONE).alias("language"), sure.alias("confidence"),
        ((F.col("_trigrams") > 0) & (F.col("_best.name") != NONE) & (sure >= confidence)).alias("kept"),
    )


def from_documents(docs: DataFrame) -> DataFrame:
    """Documents declare their language; the source is their host. They have no address."""
    none = F.lit("")
    return docs.select("doc_id", "text", F.lower("lang").alias("declared"), F.col("source").alias("host"), none.alias("domain"), none.alias("suffix"))


def from_pages(pages: DataFrame) -> DataFrame:
    """Pages: declared language of the html tag, host, domain and suffix of the address, text without markup."""
    host = F.lower(F.regexp_extract("url", r"^[a-zA-Z][a-zA-Z0-9+.-]*://([^/:?#]*)", 1))
    labels = F.split(host, r"\.")
    text = F.regexp_replace("html", r"(?is)<(script|style)\b.*?</\1\s*>|<!--.*?-->|<[^>]*>", " ")
    return pages.select(
        "page_id", F.regexp_replace(text, r"&#?\w+;", " ").alias("text"),
        F.lower(F.regexp_extract("html", r"(?is)<html\b[^>]*\blang\s*=\s*[\"']?([a-z]{2})", 1)).alias("declared"),
        host.alias("host"), F.array_join(F.slice(labels, F.greatest(F.lit(1), F.size(labels) - 1), F.lit(2)), ".").alias("domain"),
        F.element_at(labels, -1).alias("suffix"),
    )
