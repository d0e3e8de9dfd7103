"""Report-layout normalization.

Extracted report tables arrive as one long table of cell rows::

    file_name, doc_index, table_index, row_index, cells array<string>

A *layout* says which cells of a row hold which measures.  Instead of one
code branch per layout, layouts are data (:class:`Layout`) turned into a small
rule table that is broadcast-joined on the layout id.  Each layout lists
*cell groups*; a group is one or more adjacent cells whose text is joined
with blanks and split on blanks into the group's token names (a cell holding
``"1,000 2,000"`` is a group of one cell with two names; two cells whose
numbers are spread unevenly are one group of two cells).  The canonical
measures are read from the tokens and cleaned with F6.

All of it is column expressions over the row plus one small aggregate per
document (table count, anchor row, last non-empty row of each position), so
documents are processed in parallel and no row is shuffled by document.
"""

from __future__ import annotations

from collections.abc import Sequence
from itertools import combinations
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (ArrayType, BooleanType, IntegerType, MapType, StringType, StructField,
                               StructType)

from daybook.functions.numbers import grouped_digits, grouped_digits_reject
from daybook.operators.joins import bounded_broadcast, small_derived_side
from daybook.sources.sinks import handoff, write_parquet


# --------------------------------------------------------------------------- P10

def drop_empty_positions(long_df: DataFrame, doc_keys: Sequence[str], pos_col: str,
                         value_col: str) -> DataFrame:
    """P10 in long form: drop every (document, position) whose values are all null.

    One grouped count per (document, position) and a semi join; the table keeps
    its shape (no schema change per document).
    """
    keys = list(doc_keys) + [pos_col]
    kept = (long_df.groupBy(*keys).agg(F.count(value_col).alias("_n"))
            .where(F.col("_n") > 0).drop("_n"))
    return long_df.join(kept, keys, "left_semi")


# --------------------------------------------------------------------------- layouts as data

@dataclass(frozen=True)
class Layout:
    """Cell layout of one family of report tables.

    ``region_cell``   0-based cell holding the region name.
    ``groups``        token names of each cell group, in cell order after the
                      region cell; ``None`` marks a cell to ignore.
    ``group_cells``   number of cells joined into each group (default 1 each).
    ``sums``          derived measures: target -> sources, summed after cleaning.
    ``drop_null_rows``drop rows with a null in any used cell (before splitting).
    ``strip_region_digits`` remove digits from the region cell (F5).
    ``renames``       region names replaced in this layout only.
    ``row_copies``    ``(dst, src)`` body rows: dst takes src's numbers (P16).
    ``row_drops``     body rows removed (P16).
    """

    name: str
    groups: tuple
    group_cells: tuple = ()
    region_cell: int = 1
    sums: tuple = ()
    drop_null_rows: bool = False
    strip_region_digits: bool = False
    renames: tuple = ()
    row_copies: tuple = ()
    row_drops: tuple = ()

    def cells_per_group(self) -> list[int]:
        return list(self.group_cells) if self.group_cells else [1] * len(self.groups)


_NULL_MARK = "\u0000"


@dataclass(frozen=True)
class _Slot:
    """Where one measure (or one term of a derived measure) sits in a layout."""

    start: int      # 0-based first cell of the group
    width: int      # cells joined into the group
    token: int      # 1-based token inside the group; 0 = the whole cell, not split
    names: int      # token names of the group
    flat: int = 0   # 1-based token among all tokens of a regular row (_regular_rows)


def _layout_slots(lay: Layout, measures: Sequence[str]) -> tuple[dict, int]:
    """Per measure, the list of slots summed into it; and the end of the used cells."""
    where: dict[str, _Slot] = {}
    pos = lay.region_cell + 1
    used_end, flat = pos, 0
    for grp, width in zip(lay.groups, lay.cells_per_group()):
        if grp is not None:
            whole = len(grp) == 1 and width == 1
            for k, name in enumerate(grp):
                where[name] = _Slot(pos, width, 0 if whole else k + 1, len(grp), flat + k + 1)
            flat += len(grp)
            used_end = pos + width
        pos += width
    sums = dict(lay.sums)
    slots = {}
    for m in measures:
        sources = sums.get(m, (m,))
        slots[m] = [where[s] for s in sources if s in where]
    return slots, used_end


_SLOT = StructType([StructField(f, IntegerType(), False) for f in ("start", "width", "token", "names", "flat")])
#: Between two cells and between two numbers of one cell, in the pattern of a row.
_CELL, _BLANK = "|", " "
MAX_PATTERNS = 64
#: Digits and commas of a number that may not fit 64 bits.
LONG_NUMBER = "[0-9,]{19}"
REJECTED = "array<struct<measure:string,cell:int,text:string>>"


def _regular_rows(lay: Layout) -> tuple[int, int, list[str]]:
    """First cell and number of cells from the first used group to the last, and what
    is left of these cells, joined with ``|``, without digits and commas in a regular
    row: every group holds as many numbers as names.  Where a group of several cells
    breaks is open, so there may be several patterns; none where a cell in between is
    ignored or there would be too many."""
    groups = list(zip(lay.groups, lay.cells_per_group()))
    first = lay.region_cell + 1
    while groups and groups[0][0] is None:
        first += groups.pop(0)[1]
    while groups and groups[-1][0] is None:
        groups.pop()
    patterns = [""] if groups and all(g is not None for g, _ in groups) else []
    for k, (names, width) in enumerate(groups if patterns else ()):
        breaks = [set(c) for c in combinations(range(len(names) - 1), width - 1)]
        inside = ["".join(_CELL if i in at else _BLANK for i in range(len(names) - 1)) for at in breaks]
        patterns = [p + (_CELL if k else "") + x for p in patterns for x in inside]
        if len(patterns) > MAX_PATTERNS:
            patterns = []
            break
    return first, sum(w for _, w in groups), patterns


def layout_table(spark, layouts: Sequence[Layout],
                 measures: Sequence[str]) -> tuple[DataFrame, list[int]]:
    """The rule table: one row per layout with an array of slots that place every
    measure term (first cell, cell count, token index, token count), the
    region cell, and the row-drop and rename rules.

    Built on the driver from the layout list, so its size is the number of
    layouts (a code-sized bound); returned with the number of term slots of
    each measure (the most terms any layout sums into it).  A slot of no width
    stands where a layout has fewer terms.
    """
    plans = [(lay, *_layout_slots(lay, measures)) for lay in layouts]
    n_slots = [max((len(slots[m]) for _, slots, _ in plans), default=0) for m in measures]
    fields = [StructField("layout", StringType(), False),
              StructField("_region_cell", IntegerType(), False),
              StructField("_strip_digits", BooleanType(), False),
              StructField("_drop_end", IntegerType(), False),
              StructField("_renames", MapType(StringType(), StringType()), False),
              StructField("_slots", ArrayType(_SLOT, False), False),
              StructField("_first", IntegerType(), False), StructField("_width", IntegerType(), False),
              StructField("_patterns", ArrayType(StringType(), False), False)]
    rows = []
    for lay, slots, used_end in plans:
        placed = [slots[m][j] if j < len(slots[m]) else _Slot(0, 0, 0, 0)
                  for i, m in enumerate(measures) for j in range(n_slots[i])]
        rows.append((lay.name, lay.region_cell, lay.strip_region_digits,
                     used_end if lay.drop_null_rows else 0, dict(lay.renames),
                     [(p.start, p.width, p.token, p.names, p.flat) for p in placed], *_regular_rows(lay)))
    return spark.createDataFrame(rows, StructType(fields)), n_slots


def _slot_values(cells: Column) -> Column:
    """``_slots`` -> an array of ``(value, bad)``: one expression for all slots,
    whatever their number, so the generated code stays small."""
    def group(s):
        joined = F.array_join(F.slice(cells, s["start"] + 1, s["width"]), " ", _NULL_MARK)
        there = (s["width"] > 0) & (F.size(cells) >= s["start"] + s["width"]) & (F.instr(joined, _NULL_MARK) == 0)
        return F.struct(F.when(there, F.when(s["token"] == 0, F.array(joined)).otherwise(F.split(joined, " ")))
                        .alias("parts"), F.greatest(s["token"], F.lit(1)).alias("token"),
                        F.when(s["token"] > 0, s["names"]).alias("names"))

    def chosen(g):
        return F.struct(F.try_element_at(g["parts"], g["token"]).alias("text"),
                        F.coalesce(F.size(g["parts"]) > g["names"], F.lit(False)).alias("many"))

    def parsed(t):
        bad = t["many"] | F.coalesce(grouped_digits_reject(t["text"]), F.lit(False))
        return F.struct(grouped_digits(t["text"]).alias("value"), bad.alias("bad"))
    return F.transform(F.transform(F.transform("_slots", group), chosen), parsed)


def normalize_rows(rows: DataFrame, layouts: Sequence[Layout], measures: Sequence[str],
                   layout_col: str = "layout", cells_col: str = "cells",
                   keep: Sequence[str] = (), rejected: bool = False) -> DataFrame:
    """Apply each row's layout: region text plus cleaned ``measures``.

    The rule table (:func:`layout_table`) is broadcast-joined on the layout
    id -- its size is the number of layouts, known on the driver.  A *regular*
    row (only digits, commas and the layout's own separators in its cells) is
    split once into all its numbers, and each slot takes its place among them.
    Every other row runs one expression over the array of its layout's slots:
    join the slot's cells with blanks (null if any is null), split on blanks,
    take the token, clean it with F6.  Both give the same values (a test
    compares them); a measure is the sum of its slots.  The expressions don't
    grow with the number of layouts.

    Output: ``keep``, ``region``, every measure (bigint) and ``rejects``
    (measure tokens that were not numbers, plus tokens taken from a group
    holding more numbers than names).  ``rejected=True`` adds ``rejected``, an
    array of ``(measure, cell, text)`` with the original text of each of them
    and the place of its first cell.  Rows whose layout is unknown are
    dropped; layouts with ``drop_null_rows`` drop rows with a null used cell.
    """
    rules, n_slots = layout_table(rows.sparkSession, layouts, measures)
    j = rows.withColumnRenamed(layout_col, "layout").join(F.broadcast(rules), "layout")
    cells = F.col(cells_col)

    region = F.try_element_at(cells, F.col("_region_cell") + 1)
    region = F.when(F.col("_strip_digits"), F.regexp_replace(region, r"\d+", "")).otherwise(region)
    region = F.coalesce(F.try_element_at(F.col("_renames"), region), region)
    used = F.array_join(F.slice(cells, 1, F.col("_drop_end")), " ", _NULL_MARK)
    drop = (F.col("_drop_end") > 0) & ((F.size(cells) < F.col("_drop_end"))
                                        | (F.instr(used, _NULL_MARK) > 0))
    joined = F.array_join(F.slice(cells, F.col("_first") + 1, F.col("_width")), _CELL, _NULL_MARK)
    # a number that may be beyond 64 bits is left to the other rows' way
    regular = (F.array_contains("_patterns", F.translate("_joined", "0123456789,", ""))
               & ~F.col("_joined").rlike(LONG_NUMBER))
    j = (j.where(~drop).withColumn("_joined", F.coalesce(joined, F.lit(_NULL_MARK)))
         .select("*", regular.alias("_regular")))
    read = j.select(*keep, region.alias("region"), "_slots", "_regular",
                    F.translate("_joined", _CELL + ",", _BLANK).alias("_numbers"),
                    F.when(~F.col("_regular"), _slot_values(cells)).alias("_read"),
                    *([cells.alias("_cells")] if rejected else []))
    read = read.withColumn("_numbers", F.when(F.col("_regular"), F.split("_numbers", _BLANK)))

    measure_cols, names, at = [], [], 0
    for m, n in zip(measures, n_slots):
        total = F.lit(0).cast("bigint")
        for k in range(at, at + n):
            number = F.get("_numbers", F.col("_slots")[k]["flat"] - 1).try_cast("bigint")
            total = total + F.coalesce(F.when(F.col("_regular"), number).otherwise(F.col("_read")[k]["value"]),
                                       F.lit(0))
        measure_cols.append(total.alias(m))
        names += [m] * n
        at += n
    # a regular row has no reject
    rejects = F.when(F.col("_regular"), 0).otherwise(F.size(F.filter("_read", lambda r: r["bad"])))
    out = [*keep, "region", *measure_cols, rejects.cast("int").alias("rejects")]
    if rejected:
        named = F.array(*[F.lit(m) for m in names])
        # the values are read once a row: the slots beside them hold only what is cheap to repeat
        found = F.transform(F.arrays_zip("_slots", "_read"), lambda z, i: F.struct(
            F.get(named, i).alias("measure"), z["_slots"]["start"].alias("cell"),
            F.when(z["_read"]["bad"], F.array_join(F.slice("_cells", z["_slots"]["start"] + 1, z["_slots"]["width"]), " "))
            .alias("text")))
        out.append(F.when(F.col("_regular"), F.array().cast(REJECTED)).otherwise(
            F.filter(found, lambda x: x["text"].isNotNull())).alias("rejected"))
    return read.select(*out)


# --------------------------------------------------------------------------- dispatch rules

def position_case(col: Column, rules: Sequence[tuple], default=None) -> Column:
    """Compile ordered ``(condition, value)`` rules on an integer column into
    one ``CASE`` expression; the first matching rule wins.

    A condition is a tuple of alternatives; each alternative is an ``int``
    (equality), a ``(lo, hi)`` pair (inclusive range; ``None`` = open end).
    """
    out = None
    for cond, value in rules:
        same = [alt for alt in cond if not isinstance(alt, tuple)]
        test = col.isin(*same) if same else None          # one test for all: the generated code stays small
        for lo, hi in (alt for alt in cond if isinstance(alt, tuple)):
            t = F.lit(True)
            if lo is not None:
                t = t & (col >= lo)
            if hi is not None:
                t = t & (col <= hi)
            test = t if test is None else (test | t)
        out = F.when(test, F.lit(value)) if out is None else out.when(test, F.lit(value))
    if out is None:
        return F.lit(default)
    return out.otherwise(F.lit(default))


@dataclass(frozen=True)
class TrimRules:
    """Which rows of a document form its body.

    ``single_table_skip``  rows skipped when a document has only one table.
    ``body_table``         ordered rules -> table index of the body (default 1).
    ``skip``               ordered rules -> rows to skip from the top.
    ``anchor``             ordered rules -> cell index of the anchor text; the
                           body starts at the last row whose cell equals
                           ``anchor_text`` (all rows when there is none).
    ``default_skip``       rows skipped when no rule matches.
    """

    single_table_skip: int = 5
    body_table: tuple = ()
    default_body_table: int = 1
    skip: tuple = ()
    anchor: tuple = ()
    anchor_text: str = ""
    default_skip: int = 1


#: Narrow facts of a cell row: a mark for each position that isn't null, and a
#: mark for each that holds the anchor text (null when none does).
FILLED, ANCHORED = "_filled", "_anchored"


def cell_store(cells: DataFrame, anchor_text: str = "", path: str | None = None,
               doc_col: str = "doc_index") -> DataFrame:
    """The cell rows written once, with their narrow facts beside them.

    What a document's trimming needs (its tables, its anchor row, its empty
    columns) follows from the facts alone, so later steps read the few bytes of
    the facts of every row and the cells just once, and the cells are never
    shuffled: rows of a huge document stay in as many files as they came from.

    Without ``path`` the store is a hand-off in the shared checkpoint folder.
    With one it is a lasting table, clustered by (document, table, row) in
    ranges of rows: a document's rows are in few files, a huge document's in
    several, and the files' own statistics skip other documents.
    """
    def marks(test):
        return F.array_join(F.transform("cells", lambda c: F.when(test(c), "1").otherwise("0")), "")
    filled = F.coalesce(marks(lambda c: c.isNotNull()), F.lit(""))
    anchored = F.when(F.array_contains("cells", anchor_text), marks(lambda c: c == F.lit(anchor_text)))
    store = cells.drop(FILLED, ANCHORED).withColumns({FILLED: filled, ANCHORED: anchored})
    store = store.withMetadata(ANCHORED, {"anchor_text": anchor_text})
    if path is None:
        return handoff(store, "cells")
    order = [doc_col, "table_index", "row_index"]
    write_parquet(store.repartitionByRange(*order).sortWithinPartitions(*order), path)
    return cells.sparkSession.read.parquet(path)


def is_cell_store(cells: DataFrame, anchor_text: str) -> bool:
    """Whether ``cells`` carries the facts for this anchor text."""
    return FILLED in cells.columns and any(
        f.name == ANCHORED and f.metadata.get("anchor_text") == anchor_text for f in cells.schema.fields)


def document_bodies(cells: DataFrame, trim: TrimRules, doc_col: str = "doc_index",
                    max_docs: int = 1_000_000) -> DataFrame:
    """Pick each document's body (P14, P15, P18) and drop its empty columns (P10).

    The body of a document is a suffix of one of its tables, so every
    per-document fact follows from the narrow facts of :func:`cell_store`
    (``cells`` is written as one, unless it is one), aggregated first by
    (document, table, marks) -- a table has few different patterns of marks --
    and then by position:

    * the number of tables of the document,
    * the last row holding the anchor text in the anchor cell,
    * the last row where each position is not null -- a position is empty
      in the body exactly when that row lies before the body's first row.

    The aggregate is tiny (documents x tables x columns); it is computed once,
    written to the shared checkpoint folder and broadcast after a size check,
    so the cell rows are never shuffled by document, however large one
    document is, and are read once.  Adds ``rel_row``
    (0-based row inside the body); ``cells`` keeps only non-empty positions.
    """
    if not is_cell_store(cells, trim.anchor_text):
        cells = cell_store(cells, trim.anchor_text, doc_col=doc_col)
    doc = F.col(doc_col)
    anchor_cell = position_case(doc, trim.anchor, None).cast("int")
    patterns = (cells.groupBy(doc_col, "table_index", FILLED, ANCHORED)
                .agg(F.max("row_index").alias("_last")))
    marks = F.when(F.length(FILLED) > 0, F.split(FILLED, ""))
    hit = F.substring(ANCHORED, anchor_cell + 1, F.lit(1)) == "1"
    per_pos = (patterns.select(doc_col, "table_index", "_last", F.when(hit, F.col("_last")).alias("_hit"),
                               F.posexplode_outer(marks).alias("_pos", "_mark"))
               .groupBy(doc_col, "table_index", "_pos")
               .agg(F.max(F.when(F.col("_mark") == "1", F.col("_last"))).alias("_last_value"),
                    F.max("_hit").alias("_anchor")))
    per_table = per_pos.groupBy(doc_col, "table_index").agg(
        F.max("_anchor").alias("_anchor"),
        F.collect_list(F.struct("_pos", "_last_value")).alias("_positions"))
    tables_per_doc = per_table.groupBy(doc_col).agg(F.count(F.lit(1)).alias("_n_tables"))
    t = per_table.join(tables_per_doc, doc_col)
    single_skip = trim.single_table_skip
    single = F.col("_n_tables") == 1
    body_table = position_case(doc, trim.body_table, trim.default_body_table)
    t = t.where(F.when(single, F.lit(True)).otherwise(F.col("table_index") == body_table))
    offset = F.when(single, F.lit(single_skip)).otherwise(F.lit(0))
    # in a single table an anchor among the skipped rows doesn't count
    anchor_row = F.when(F.col("_anchor") >= offset, F.col("_anchor") - offset)
    skip = position_case(doc, trim.skip, None).cast("int")
    start = (F.when(skip.isNotNull(), skip)
             .when(anchor_cell.isNotNull(), F.coalesce(anchor_row, F.lit(0)))
             .otherwise(F.lit(trim.default_skip)))
    t = t.withColumn("_start_raw", start + offset)
    keep = F.array_sort(F.transform(
        F.filter("_positions", lambda p: p["_last_value"] >= F.col("_start_raw")),
        lambda p: p["_pos"]))
    # a table without an empty position keeps its cells as they are
    whole = F.size(keep) == F.size("_positions")
    stats = t.select(doc_col, "table_index", "_start_raw",
                     F.when(whole, F.lit(None)).otherwise(keep).alias("_keep"))
    stats = small_derived_side(stats, max_docs)
    body = (cells.drop(FILLED, ANCHORED).join(stats, [doc_col, "table_index"])
            .where(F.col("row_index") >= F.col("_start_raw")))
    there = F.filter("_keep", lambda i: i < F.size("cells"))
    kept = F.when(F.col("_keep").isNull(), F.col("cells")).otherwise(
        F.when(F.col("cells").isNotNull(), F.transform(there, lambda i: F.get("cells", i))))
    return (body.withColumn("cells", kept)
            .withColumn("rel_row", F.col("row_index") - F.col("_start_raw"))
            .drop("_start_raw", "_keep"))


def apply_row_patches(rows: DataFrame, layouts: Sequence[Layout], doc_col: str = "doc_index",
                      layout_col: str = "layout", cells_col: str = "cells",
                      dispatch: Sequence[tuple] = ()) -> DataFrame:
    """Per-layout positional row copies and drops inside a document.

    A copy ``(dst, src)`` gives row ``dst`` the cells of row ``src`` after the
    region cell; a drop removes a body row.  Only layouts that declare
    patches pay for the lookup: the source rows (one per document of the
    layout) are broadcast after a size check, and the body rows stay in place.
    With ``dispatch``, the source rows' documents are also filtered by position,
    a condition that reaches the scan.
    """
    patched = [lay for lay in layouts if lay.row_copies or lay.row_drops]
    out = rows
    for lay in patched:
        in_layout = F.col(layout_col) == lay.name
        possible = [(cond, True) for cond, name in dispatch if name == lay.name]
        for dst, src in lay.row_copies:
            found = out.where(position_case(F.col(doc_col), possible, False)) if possible else out
            src_rows = (found.where(in_layout & (F.col("rel_row") == src))
                        .select(F.col(doc_col).alias("_doc"), F.col(cells_col).alias("_src_cells")))
            out = out.join(bounded_broadcast(src_rows), (F.col(doc_col) == F.col("_doc"))
                           & in_layout & (F.col("rel_row") == dst), "left")
            head = F.slice(F.col(cells_col), 1, lay.region_cell + 1)
            tail = F.slice(F.col("_src_cells"), lay.region_cell + 2, F.size("_src_cells"))
            out = out.withColumn(cells_col, F.when(F.col("_src_cells").isNotNull(),
                                                   F.concat(head, tail))
                                 .otherwise(F.col(cells_col))).drop("_doc", "_src_cells")
        if lay.row_drops:
            out = out.where(~(in_layout & F.col("rel_row").isin(*lay.row_drops)))
    return out


def normalize_reports(cells: DataFrame, layouts: Sequence[Layout], dispatch: Sequence[tuple],
                      trim: TrimRules, measures: Sequence[str], header_marker: str | None = None,
                      doc_col: str = "doc_index", rejected: bool = False) -> DataFrame:
    """Extracted report cells (or a :func:`cell_store` of them) -> one row per report
    row with cleaned measures.

    ``dispatch``: ordered ``(condition, layout name)`` rules on the document
    position.  Steps: trim (body table, skipped rows, anchor), drop columns
    empty in the whole document, row patches, header-row removal (P11), then
    the layout's cell groups.  Output: ``day`` (from the file name, S7),
    ``doc_index``, ``rel_row``, ``region``, measures, ``rejects``; with
    ``rejected=True`` also ``file_name``, ``row_index`` and the rejected cells
    (see :func:`normalize_rows` and :func:`rejected_cells`).
    """
    body = document_bodies(cells, trim, doc_col)
    body = body.withColumn("layout", position_case(F.col(doc_col), dispatch, None))
    body = apply_row_patches(body, layouts, doc_col, dispatch=dispatch)
    if header_marker is not None:
        body = body.where(~F.coalesce(F.array_contains("cells", header_marker), F.lit(False)))
    body = body.withColumn("day", F.try_to_date(F.substring("file_name", 1, 10), "yyyy-MM-dd"))
    keep = ["day", doc_col, "rel_row"] + (["file_name", "row_index"] if rejected else [])
    return normalize_rows(body, layouts, measures, keep=keep, rejected=rejected)


def rejected_documents(cells: DataFrame, dispatch: Sequence[tuple], trim: TrimRules,
                       doc_col: str = "doc_index") -> DataFrame:
    """Documents that :func:`normalize_reports` can't place: ``doc_col, reason, n_rows``.

    ``no layout``: no dispatch rule fits the position (or it is null);
    ``no body table``: several tables, but not the one that holds the body.
    One partial aggregate by document.
    """
    doc = F.col(doc_col)
    body_table = position_case(doc, trim.body_table, trim.default_body_table)
    per_doc = cells.groupBy(doc_col).agg(
        F.count(F.lit(1)).alias("n_rows"), F.min("table_index").alias("_first"),
        F.max("table_index").alias("_last"),
        F.max(F.col("table_index") == body_table).alias("_has_body"))
    reason = (F.when(doc.isNull() | position_case(doc, dispatch, None).isNull(), "no layout")
              .when((F.col("_first") != F.col("_last")) & ~F.col("_has_body"), "no body table"))
    return (per_doc.withColumn("reason", reason).where(F.col("reason").isNotNull())
            .select(doc_col, "reason", "n_rows"))


def rejected_rows(normalized: DataFrame) -> DataFrame:
    """The reject table of §2.12: normalized report rows with at least one cell
    that was not a number or a cell group with more numbers than names.

    Those cells count as 0 in the measures (decision D6); this table lets a
    user see and fix them.  It is a filter over the same rows, no extra pass.
    """
    return normalized.where(F.col("rejects") > 0)


def rejected_cells(normalized: DataFrame, keep: Sequence[str] = ("file_name", "doc_index", "row_index", "region")
                   ) -> DataFrame:
    """One row per cell that counted as 0 though it held text (D6), with the
    measure it was read for, the place of its (group's first) cell in the row
    without empty columns, and the original text.

    ``normalized`` comes from :func:`normalize_reports` with ``rejected=True``.
    """
    return (normalized.where(F.size("rejected") > 0)
            .select(*keep, F.explode("rejected").alias("_r")).select(*keep, "_r.measure", "_r.cell", "_r.text"))
