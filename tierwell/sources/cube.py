"""Cube documents (json-stat 2) to long rows, as column expressions.

A document lists its dimensions in order, the number of members of each, and one flat value
vector in which the last dimension varies fastest.  The member of a dimension at position p is
``(p div stride) mod size``.

The vector is brought to a dense array and cut into chunks of consecutive cells *before* it is
expanded.  Only chunks travel: a document with millions of cells is expanded by many tasks, and
no row ever carries the whole vector next to a single cell.

Functions take documents as text, or already parsed (``parse``) with ``text=None``: a caller that needs a document's
outline, its members and its cells stores the parsed documents and reads the fields each of them needs.
"""

from pyspark.sql import Column, DataFrame, functions as F

from tierwell.functions import scalars as S

# ``index`` and ``value`` are a list or an object; as STRING fields they keep their JSON text.
DOCUMENT = (
    "id array<string>, size array<int>, value string, "
    "dimension map<string, struct<category: struct<index: string, label: map<string, string>>>>"
)
CHUNK_CELLS = 50_000
TASK_CHUNKS = 8
STRICT = {"mode": "FAILFAST"}


def _is_list(text: Column) -> Column:
    return F.ltrim(text).startswith("[")


def member_codes(index: Column) -> Column:
    """Codes in position order, from a list or from an object of code -> position."""
    by_position = F.sort_array(F.transform(
        F.map_entries(F.from_json(index, "map<string, int>")),
        lambda entry: F.struct(entry["value"].alias("position"), entry["key"].alias("code")),
    ))
    ordered = F.transform(by_position, lambda entry: entry["code"])
    return F.when(_is_list(index), F.from_json(index, "array<string>")).otherwise(ordered)


def _sparse_entries(value: Column) -> Column:
    """Present cells of an object-form vector, sorted by position."""
    cells = F.map_entries(F.from_json(value, "map<string, string>"))
    return F.sort_array(F.transform(
        cells, lambda cell: F.struct(cell["key"].cast("bigint").alias("position"), cell["value"].alias("text"))
    ))


def _filled(entries: Column, cells: Column) -> Column:
    """Dense array from sorted sparse entries: each entry preceded by the gap in front of it.

    Linear in the number of cells; looking every position up in the map would be quadratic.
    """
    positions = F.transform(entries, lambda entry: entry["position"])
    before = F.slice(F.concat(F.array(F.lit(-1).cast("bigint")), positions), F.lit(1), F.size(entries))
    nothing = F.lit(None).cast("string")
    runs = F.zip_with(entries, before, lambda entry, previous: F.concat(
        F.array_repeat(nothing, (entry["position"] - previous - 1).cast("int")), F.array(entry["text"])
    ))
    last = F.coalesce(F.array_max(positions), F.lit(-1).cast("bigint"))
    return F.concat(F.flatten(runs), F.array_repeat(nothing, (cells - last - 1).cast("int")))


def _labels_of(codes: Column, label_map: Column) -> Column:
    return F.transform(codes, lambda code: F.try_element_at(label_map, code))


def parse(documents: DataFrame, text: str | None = "value", schema: str = DOCUMENT) -> DataFrame:
    """Replaces the text column by the parsed document ``doc``; malformed JSON fails the job."""
    if text is None:
        return documents
    kept = [c for c in documents.columns if c != text]
    return documents.select(*kept, F.from_json(text, schema, STRICT).alias("doc"))


def members(documents: DataFrame, dimension: str, text: str | None = "value") -> DataFrame:
    """Codes of one dimension, as listed in metadata or data documents; ``Tid`` gives the published periods."""
    index = F.col("doc.dimension")[dimension]["category"]["index"]
    return parse(documents, text).select(F.explode(member_codes(index)).alias("code")).distinct()


def outline(documents: DataFrame, text: str | None = "value") -> DataFrame:
    """Per document, without its values: its dimensions in name order and the cells its sizes declare."""
    parsed = parse(documents, text, "id array<string>, size array<int>")
    lineage = [c for c in parsed.columns if c != "doc"]
    return parsed.select(
        *lineage, F.sort_array("doc.id").alias("dimensions"), S.product("doc.size").alias("declared_cells")
    )


def unexpected_dimensions(outlines: DataFrame, dimensions) -> DataFrame:
    """Documents whose dimensions are not exactly the given ones, in any order."""
    wanted = F.array(*[F.lit(name) for name in sorted(dimensions)])
    return outlines.where(S.differs(F.col("dimensions"), wanted))


def wrong_members(documents: DataFrame, dimensions, labelled=(), text: str | None = "value") -> DataFrame:
    """Per document and dimension whose members do not fit: their number next to the declared one, and the gaps.

    Cells are placed by the declared sizes, so a member too few or too many would shift or drop codes without
    changing the number of rows.  Codes must be there, once each, and labelled dimensions need a label for each.
    """
    parsed = parse(documents, text, DOCUMENT.replace("value string, ", ""))
    lineage = [c for c in parsed.columns if c != "doc"]

    def report(name: str) -> Column:
        category = F.col("doc.dimension")[name]["category"]
        codes = F.coalesce(member_codes(category["index"]), F.array().cast("array<string>"))
        unlabelled = F.size(F.filter(_labels_of(codes, category["label"]), lambda label: label.isNull()))
        return F.struct(
            F.lit(name).alias("dimension"),
            F.get("doc.size", F.array_position("doc.id", name).cast("int") - 1).alias("declared_members"),
            F.size(codes).alias("members"),
            F.size(F.array_distinct(F.filter(codes, lambda code: code.isNotNull()))).alias("distinct_codes"),
            (F.coalesce(unlabelled, F.size(codes)) if name in labelled else F.lit(0)).alias("unlabelled"),
        )

    reports = parsed.select(*lineage, F.explode(F.array(*[report(name) for name in dimensions])).alias("report"))
    fits = (
        F.col("declared_members").eqNullSafe(F.col("members")) & (F.col("members") == F.col("distinct_codes"))
        & (F.col("unlabelled") == 0)
    )
    return reports.select(*lineage, "report.*").where(~fits)


def size_report(outlines: DataFrame, rows: DataFrame, file: str = "_source_file") -> DataFrame:
    """Per file: declared cells next to the rows that came out of it."""
    actual = rows.groupBy(file).agg(F.count("*").alias("actual_cells"))
    return outlines.select(file, "declared_cells").join(actual, file, "full").select(
        file, "declared_cells", F.coalesce("actual_cells", F.lit(0).cast("bigint")).alias("actual_cells")
    )


def _vector_chunks(parsed: DataFrame, chunk_cells: int) -> DataFrame:
    """One row per chunk: its first position and its cells."""
    kept = [c for c in parsed.columns if c != "doc"]
    cells = S.product("doc.size")
    vectors = parsed.select(
        *kept, "doc.id", "doc.size", "doc.dimension", cells.alias("_cells"),
        F.when(_is_list(F.col("doc.value")), F.from_json("doc.value", "array<string>")).alias("_dense"),
        F.when(~_is_list(F.col("doc.value")), _sparse_entries(F.col("doc.value"))).alias("_sparse"),
    )
    dense = F.coalesce("_dense", _filled(F.col("_sparse"), F.col("_cells")))
    full = vectors.select(*kept, "id", "size", "dimension", dense.alias("_vector"))
    # The starts are expanded and the vector is cut in one generated loop: one chunk exists at a time.
    chunk_count = F.ceil(F.size("_vector") / F.lit(chunk_cells)).cast("int")
    starts = F.when(F.size("_vector") > 0, F.sequence(F.lit(0), chunk_count - 1))
    return full.select("*", F.explode(starts).alias("_chunk")).select(
        *kept, "id", "size", "dimension", (F.col("_chunk").cast("bigint") * chunk_cells).alias("start"),
        F.slice("_vector", F.col("_chunk") * F.lit(chunk_cells) + 1, F.lit(chunk_cells)).alias("cells"),
    )


def chunks(documents: DataFrame, text: str | None = "value", chunk_cells: int = CHUNK_CELLS) -> DataFrame:
    """Lineage, outline, first position and cells: one row for at most ``chunk_cells`` consecutive cells."""
    return _vector_chunks(parse(documents, text), chunk_cells)


def spread(pieces: DataFrame, per_task: int = TASK_CHUNKS) -> DataFrame:
    """Stored chunks, dealt to tasks by their number: a chunk's bytes say little about the rows that come out of it."""
    outline_columns = ("id", "size", "dimension", "cells")
    tasks = -(-pieces.count() // per_task)  # counted from the files' footers
    return pieces.repartition(max(tasks, 1), *[c for c in pieces.columns if c not in outline_columns])


def flatten(documents: DataFrame, dimensions, labelled=(), text: str | None = "value",
            chunk_cells: int = CHUNK_CELLS) -> DataFrame:
    """One row per cell: code (and label, where asked for) of each dimension, and the value as text.

    Columns of ``documents`` other than the text are carried along as lineage.  Dimensions are
    looked up by name, so the order inside a document is free.
    """
    pieces = chunks(documents, text, chunk_cells)
    lineage = [c for c in documents.columns if c not in (text, "doc")]
    return expand(pieces.hint("rebalance", *lineage, "start"), dimensions, labelled)


def expand(pieces: DataFrame, dimensions, labelled=()) -> DataFrame:
    """One row per cell of ``chunks``."""
    lineage = [c for c in pieces.columns if c not in ("id", "size", "dimension", "start", "cells")]
    labelled = [name for name in dimensions if name in labelled]

    axes = pieces
    for name in dimensions:
        place = F.array_position("id", name).cast("int")
        category = F.col("dimension")[name]["category"]
        inner = F.slice("size", place + 1, F.size("size"))
        axes = axes.withColumns({
            f"_codes_{name}": member_codes(category["index"]),
            f"_labels_{name}": category["label"],
            f"_stride_{name}": S.product(inner),
            f"_size_{name}": F.get("size", place - 1),
        })
    for name in labelled:
        axes = axes.withColumn(f"_labels_{name}", _labels_of(F.col(f"_codes_{name}"), F.col(f"_labels_{name}")))

    # Exploding and picking members compile to one generated loop, so the member arrays are read
    # from the chunk's row and not copied to every cell.
    cells = axes.select("*", F.posexplode("cells").alias("_offset", "value"))
    position = F.col("start") + F.col("_offset")
    picked = []
    for name in dimensions:
        member = (F.floor(position / F.col(f"_stride_{name}")) % F.col(f"_size_{name}")).cast("int")
        picked.append(F.get(f"_codes_{name}", member).alias(name))
        if name in labelled:
            picked.append(F.get(f"_labels_{name}", member).alias(f"{name}_label"))
    return cells.select(*lineage, *picked, "value")
