"""Line dedup (operator 2): an exact set-similarity join of lines, in built-in functions only.

A line's tokens are its distinct shingles of k words; with fewer words, but one at least, its whole word sequence is its
one token. Lines without words take no part and stay. A line is removed if an earlier one (smaller doc_id, or same document, earlier line) has a Jaccard similarity of ``percent`` or more. Lines
are judged on the input, not on what is left.

* Rarity: how often each cell of a hashed table of fixed size is hit by any line's shingles. It orders tokens; any order
  is right, and rare tokens first keep the lists short.
* Lines with the same tokens are one set, known by its first occurrence; every later one is removed at once.
* The prefix of a set of n tokens, its n - ceil(percent n / 100) + 1 rarest ones, holds a token of each partner's prefix.
  Sets meet in the list of a token, if sizes, positions and 64 parity bits leave room for the overlap that is needed.
* No list emits all pairs: first each set meets the earliest one of its list and those right before it. Just those that
  this does not remove meet all earlier ones. Jaccard is verified on whole token sets, of the lines that are in pairs only.
* Documents that lose no line pass by without a shuffle of their text; a bitmap of fixed size tells most of them.

Cases: null text stays null with 0 lines; empty text is one empty line; lines end at line feeds only; rows that repeat an
id are dropped down to equal treatment, as one document's lines (a line counts as its own first occurrence in each of
them); extra columns are kept, except ``n_lines`` and ``n_removed``, which are replaced; an empty table gives no rows.
"""

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.window import Window

from tierwell.llm.common import stored

#: Members of a list right before one that it meets besides the list's first one.
NEARBY = 3

#: Cells of the rarity table, and 64-bit words of the bitmap of documents.
CELLS, BITMAP = 1 << 18, 1 << 17

#: Columns that the cells of the rarity table are counted in, side by side.
LANES = 4

_BLANKS = "\t\x0b\f\r"


def _clean(line: Column) -> Column:
    """The line with each blank as a space; a line without words is then blank, which costs no hashing to tell."""
    for blank in _BLANKS:
        line = F.replace(line, F.lit(blank), F.lit(" "))
    return line


def _hashes(line: Column) -> Column:
    """Hashes of the words of a clean line, which are hashed once each."""
    return F.transform(F.array_remove(F.split(line, " "), ""), lambda x: F.xxhash64(x))


def _firsts(hashes: Column, k: int) -> Column:
    """The words that start a k-word shingle; with fewer than k words there is one of all words."""
    return F.slice(hashes, F.lit(1), F.greatest(F.size(hashes) - (k - 1), F.lit(1)))


def _shingle(first: Column, hashes: Column, at: Column, k: int) -> Column:
    """Of the word ``first`` at ``at`` and those after it; ``xxhash64`` leaves out the nulls beyond a short line's end."""
    return F.xxhash64(first, *[F.get(hashes, at + j) for j in range(1, k)])


def _shingles(line: Column, k: int) -> Column:
    """Hashes of the k-word shingles of a clean line that has words, in one array."""
    return F.transform(F.array(_hashes(line)), lambda h: F.transform(_firsts(h, k), lambda x, i: _shingle(x, h, i, k)))[0]


def _hits(lines: DataFrame, k: int) -> DataFrame:
    """(cell, value): how many shingles of ``lines`` (words) fall on a cell.

    Shingles are rows here, which compiled code makes; of functions over arrays the lambdas are interpreted. The cells are
    counted as ``LANES`` columns of fewer groups, which fit the compiled aggregate's first map.
    """
    hashed = lines.select(_hashes(F.col("words")).alias("h"))
    starts = hashed.select("h", F.posexplode(_firsts(F.col("h"), k)).alias("at", "first"))
    shingles = starts.select(_shingle(F.col("first"), F.col("h"), F.col("at"), k).alias("t"))
    groups = CELLS // LANES
    low, lane = F.col("t").bitwiseAND(groups - 1), F.col("t").bitwiseAND(CELLS - groups)
    counted = shingles.groupBy(low.alias("low")).agg(*[F.count(F.when(lane == i * groups, 1)).alias(f"n{i}") for i in range(LANES)])
    return counted.select("low", F.posexplode(F.array(*[f"n{i}" for i in range(LANES)])).alias("lane", "value")).select(
        (F.col("lane") * groups + F.col("low")).alias("cell"), "value"
    )


def _tokens(line: Column, k: int) -> Column:
    return F.array_distinct(_shingles(line, k))


def _dense(rows: DataFrame, size: int, name: str) -> DataFrame:
    """(cell, value) as one array of ``size`` values, 0 where nothing is; a table of one row."""
    filled = rows.unionByName(rows.sparkSession.range(size).select(F.col("id").alias("cell"), F.lit(0).cast("long").alias("value")))
    cells = filled.groupBy("cell").agg(F.sum("value").alias("value"))
    packed = cells.groupBy().agg(F.sort_array(F.collect_list(F.struct("cell", "value"))).alias("cells"))
    return stored(packed.select(F.col("cells.value").alias(name)), name)


def _marked(ids: DataFrame) -> DataFrame:
    """A bitmap of hashed ids."""
    bit = F.pmod(F.xxhash64("doc_id"), F.lit(64 * BITMAP))
    words = ids.select(F.floor(bit / 64).alias("cell"), F.expr("shiftleft(1L, CAST(pmod(xxhash64(doc_id), 64) AS INT))").alias("bit"))
    return _dense(words.groupBy("cell").agg(F.bit_or("bit").alias("value")), BITMAP, "bitmap")


def _is_marked(bitmap: DataFrame) -> Column:
    place = F.floor(F.pmod(F.xxhash64("doc_id"), F.lit(64 * BITMAP)) / 64).cast("int")
    word = F.get(bitmap.scalar(), place)
    return F.coalesce(word.bitwiseAND(F.expr("shiftleft(1L, CAST(pmod(xxhash64(doc_id), 64) AS INT))")) != 0, F.lit(False))


def _prefix(n, percent: int):
    return n - F.ceil(n * F.lit(percent) / 100) + 1


def _parity(keys: Column) -> Column:
    """Bit i tells whether an odd number of keys falls on i: two sets differ in at least as many tokens as in bits."""
    return F.aggregate(keys, F.lit(0).cast("long"), lambda bits, t: bits.bitwiseXOR(
        F.call_function("shiftleft", F.lit(1).cast("long"), t.bitwiseAND(63).cast("int"))))


def _room(x: str, y: str, percent: int) -> Column:
    """Whether x and y may have the overlap that is needed, if the token of this list is the first one that they share.

    By sizes, by what is left from the token on, and by parity bits. Partners meet in the list of their first shared
    token at least, so lists of later ones need not bring them together again.
    """
    a, b = F.col(f"{x}.n"), F.col(f"{y}.n")
    need = F.ceil(F.lit(percent) * (a + b) / (100 + percent) - 1e-9)
    left = F.least(a - F.col(f"{x}.pos"), b - F.col(f"{y}.pos"))
    differ = F.bit_count(F.col(f"{x}.parity").bitwiseXOR(F.col(f"{y}.parity")))
    return (100 * F.least(a, b) >= percent * F.greatest(a, b)) & (left >= need) & (a + b - differ >= 2 * need)


def _before(y: str, x: str) -> Column:
    return F.struct(F.col(f"{y}.doc_id"), F.col(f"{y}.line")) < F.struct(F.col(f"{x}.doc_id"), F.col(f"{x}.line"))


def _lines(docs: DataFrame) -> DataFrame:
    """doc_id, line, words (clean) of the lines that have words."""
    lines = docs.select("doc_id", F.posexplode(F.split("text", "\n")).alias("line", "words"))
    return lines.withColumn("words", _clean(F.col("words"))).where(F.trim("words") != "")


def _similar(docs: DataFrame, pairs: DataFrame, k: int, percent: int) -> DataFrame:
    """Of ``pairs`` (later, earlier: structs of doc_id and line) those with enough tokens in common."""
    both = pairs.select(F.col("later").alias("at")).union(pairs.select("earlier")).distinct()
    wanted = stored(both.groupBy("at.doc_id").agg(F.collect_set("at.line").alias("wanted")), "wanted")
    near = docs.select("doc_id", "text").where(_is_marked(_marked(wanted)))
    # Only the wanted lines leave the row of a document; ``all`` is split once and copied to none of them.
    picked = F.transform(F.array(F.split("text", "\n")), lambda all: F.transform(
        "wanted", lambda line: F.struct(line.alias("line"), F.get(all, line).alias("words"))))[0]
    found = near.join(wanted, "doc_id").select("doc_id", F.inline(picked)).select(
        F.struct("doc_id", "line").alias("at"), _clean(F.col("words")).alias("words")
    ).where(F.trim("words") != "")
    # One shuffle by ``at`` serves both joins; rows that repeat an id count by the least of their token sets.
    tokens = found.select("at", _tokens(F.col("words"), k).alias("tokens")).groupBy("at").agg(F.min("tokens").alias("tokens"))
    joined = pairs.join(tokens.select(F.col("at").alias("later"), F.col("tokens").alias("x")), "later").join(
        tokens.select(F.col("at").alias("earlier"), F.col("tokens").alias("y")), "earlier"
    )
    shared = F.size(F.array_intersect("x", "y"))
    return joined.where(100 * shared >= percent * (F.size("x") + F.size("y") - shared)).select("later", "earlier")


def removed_lines(docs: DataFrame, k: int = 5, percent: int = 80) -> DataFrame:
    """doc_id, line (from 0) of the lines that have an earlier match."""
    docs = docs.select("doc_id", "text").where("doc_id IS NOT NULL")
    lines = _lines(docs)
    # Logarithms in 12 bits go before 51 bits of the hash: one number is a token and its place in the order.
    rarity = _dense(_hits(lines, k).withColumn("value", F.shiftleft(F.floor(F.log1p("value") * 90), 51)), CELLS, "rarity")
    # The column ``rarity`` is named once, in an expression that is evaluated once: no row gets a copy of the table.
    keyed = F.sort_array(F.transform(_tokens(F.col("words"), k), lambda t: F.coalesce(
        F.get(F.col("rarity"), t.bitwiseAND(CELLS - 1).cast("int")), F.lit(0).cast("long")
    ).bitwiseOR(F.shiftrightunsigned(t, 13))))
    described = lines.withColumn("rarity", rarity.scalar()).select("doc_id", "line", keyed.alias("keys")).select(
        "doc_id", "line", F.size("keys").alias("n"), F.xxhash64("keys").alias("s1"), F.xxhash64("keys", F.lit(7)).alias("s2"),
        F.slice("keys", F.lit(1), _prefix(F.size("keys"), percent).cast("int")).alias("prefix"), _parity(F.col("keys")).alias("parity"),
    )
    occurrences = stored(described, "lines")
    firsts = occurrences.groupBy("s1", "s2").agg(F.min(F.struct("doc_id", "line")).alias("first"))
    sets = stored(occurrences.select("s1", "s2", "doc_id", "line").join(firsts, ["s1", "s2"]).select(
        "doc_id", "line", "first", (F.struct("doc_id", "line") == F.col("first")).alias("is_first")
    ), "sets")
    repeated = sets.where("NOT is_first").select("doc_id", "line")

    # Lists of prefix tokens over first occurrences, in their order; lists of one member end here.
    leaders = sets.where("is_first").select("doc_id", "line").distinct()
    lists = occurrences.join(leaders, ["doc_id", "line"], "left_semi").select(
        "doc_id", "line", "n", "parity", F.posexplode("prefix").alias("pos", "token")
    ).repartition("token")
    order = Window.partitionBy("token").orderBy("doc_id", "line")
    # Lists of one member, which are most, end before the wider window.
    several = lists.withColumn("rank", F.row_number().over(order)).withColumn(
        "followed", F.lead("line").over(order).isNotNull()
    ).where("rank > 1 OR followed")
    members = several.select("token", "doc_id", "line", "rank", F.struct("doc_id", "line", "n", "pos", "parity").alias("x"))
    shared = stored(members.select(
        "token", "x", "rank", F.first("x").over(order).alias("head"), *[F.lag("x", i).over(order).alias(f"back{i}") for i in range(1, NEARBY + 1)]
    ), "lists")
    at = lambda c: F.struct(F.col(f"{c}.doc_id").alias("doc_id"), F.col(f"{c}.line").alias("line"))
    met = shared.where("rank > 1").select("x", F.explode(F.array("head", *[f"back{i}" for i in range(1, NEARBY + 1)])).alias("y"))
    near = met.where(F.col("y").isNotNull() & _before("y", "x") & _room("x", "y", percent))
    pairs = stored(near.select(at("x").alias("later"), at("y").alias("earlier")).distinct(), "pairs")
    first = stored(_similar(docs, pairs, k, percent).select("later").distinct(), "matched")

    # What these do not remove meets all other earlier members.
    open_ones = shared.where(F.col("rank") > NEARBY + 2).withColumn("later", at("x")).join(first, "later", "left_anti").select("token", "later", "x", "rank")
    others = shared.where("rank > 1").select(F.col("token").alias("token2"), F.col("x").alias("y"), F.col("rank").alias("rank2"))
    crossed = open_ones.join(
        others,
        (F.col("token") == F.col("token2")) & (F.col("rank2") < F.col("rank") - NEARBY) & _before("y", "x") & _room("x", "y", percent),
    ).select("later", at("y").alias("earlier")).distinct()
    more = stored(crossed, "pairs")
    second = _similar(docs, more, k, percent).select("later").distinct()
    matched = first.union(second).select("later.doc_id", "later.line")
    return repeated.union(matched).distinct()


def dedup_lines(docs: DataFrame, k: int = 5, percent: int = 80) -> DataFrame:
    """The documents without removed lines, with ``n_lines`` (before) and ``n_removed``; all other columns stay."""
    gone = stored(removed_lines(docs, k, percent).groupBy("doc_id").agg(F.collect_set("line").alias("_gone")), "removed")
    kept = [c for c in docs.columns if c not in ("n_lines", "n_removed", "_gone")]
    lines = F.coalesce(F.size(F.split("text", "\n")), F.lit(0))
    count = F.when(F.col("text").isNull(), 0).otherwise(lines).alias("n_lines")
    bitmap = _marked(gone)
    untouched = docs.where(~_is_marked(bitmap)).select(*kept, count, F.lit(0).alias("n_removed"))
    touched = docs.select(*kept).where(_is_marked(bitmap)).join(gone, "doc_id", "left")
    text = F.when(F.col("_gone").isNull(), F.col("text")).otherwise(
        F.array_join(F.filter(F.split("text", "\n"), lambda x, i: ~F.array_contains("_gone", i)), "\n")
    )
    fewer = touched.select(
        *[text.alias("text") if c == "text" else F.col(c) for c in kept], count,
        F.coalesce(F.when(F.col("text").isNotNull(), F.size("_gone")), F.lit(0)).alias("n_removed"),
    )
    return untouched.unionByName(fewer)
