"""The 18 report layouts of §2.12 over the whole of ``lineitem``, with their SQL.

Every line item is printed into a document (position 0 to 588) in the layout
that the dispatch rules give that position, around it the things the trim rules
must remove: title rows, repeated header rows, several tables, an earlier
anchor row, empty columns, null and unreadable cells, documents without a
layout or without their body table.  The SQL never prints or parses: it says
from the line item's own columns what must come out.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from daybook.operators.layouts import normalize_reports, position_case, rejected_cells, rejected_documents
from daybook.plans import stages
from daybook.plans.report_rules import (REFERENCE_DISPATCH, REFERENCE_LAYOUTS, REFERENCE_MEASURES,
                                        REFERENCE_TRIM)
from daybook.plans.tables import table

DOCUMENTS = 589
FRONT_ROWS = 13          # rows above the line items of a document
FIRST_LINE = 20          # row index from which line items are numbered
ANCHOR_ROW = 8
NAMES = ["Punjab*", "Chhattisgarh*", "Haveli", "Dadra & Nagar", "Daman & Diu", "Jammu & Kashmir", None,
         "Kerala", "Goa", "Dadra & Nagar Haveli", "Arunachal\rPradesh", "Dadra & Nagar\rHaveli"]

# The cells of each layout; blanks join several numbers in one cell.
PRINTED = {
    "L01": "no|region|mark|mark|d1|d2|total",
    "L02": "no|region|d1|d2",
    "L03": "coded|d1 d2|total",
    "L04": "no|region|d1|d2 total|t1",
    "L05": "no|region|d1|d2|total",
    "L06": "no|region|d1|d2|total|t1",
    "L07": "no|region|d1 d2|t1 k1|pa|total",
    "L08": "no|region|d1 d2 t1|pa|total",
    "L09": "no|region|d1|d2|t1|pa|total",
    "L10": "no|region|d1|d2|t1|t2|pa|total",
    "L11": "no|region|d1 d2 t1|t2|pa|total",
    "L12": "no|region|d1|d2|t1|t2|k1|pa|total",
    "L13": "no|region|d1 d2|t1 t2 k1|pa|total",
    "L14": "no|region|d1|d2 t1 t2|k1|pa|total",
    "L15": "no|region|d1 d2|t1 t2 k1 k2 pa|pb|total",
    "L16": "no|region|d1|d2|t1|t2|k1|k2|pa|pb|total",
    "L17": "no|region|d1 d2|t1 t2 k1 k2|pa pb|total",
    "L18": "no|region|d1|d2|t1|t2|k1|k2|pa|pb|total",
}

def _fields() -> dict:
    """What a cell can hold, as text."""
    numbers = ("d1", "d2", "t1", "t2", "k1", "k2", "pa", "pb", "total")
    return {"no": F.col("row_index").cast("string"), "region": F.col("region"),
            "coded": F.concat(F.lit("12"), F.col("region")), "mark": F.lit("x"), **{n: F.col(n) for n in numbers}}


def _lines(spark: SparkSession, sf: str) -> DataFrame:
    li = table(spark, sf, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice",
        "l_discount", "l_tax")
    q, ln = F.col("l_quantity").cast("bigint"), F.col("l_linenumber").cast("bigint")
    d1 = F.when((q == 50) & (ln == 1), F.lit(5250505)).when((q == 49) & (ln == 1), F.lit(5789969)).otherwise(q)
    d2 = F.floor("l_extendedprice").cast("bigint")
    names = F.array(*[F.lit(n) for n in NAMES])
    return li.select(
        F.when(F.col("l_orderkey") % 1000 != 999, F.col("l_orderkey") % DOCUMENTS).cast("int").alias("doc_index"),
        (F.lit(FIRST_LINE) + F.col("l_orderkey") * 8 + ln).alias("row_index"), F.lit("line").alias("kind"),
        F.element_at(names, (F.col("l_suppkey") % len(NAMES) + 1).cast("int")).alias("region"),
        F.when((q == 13) & (ln == 6), "n.a.").otherwise(F.format_number(d1, 0)).alias("d1"),
        F.format_number(d2, 0).alias("d2"), F.round(F.col("l_discount") * 100).cast("int").cast("string").alias("t1"),
        ln.cast("string").alias("t2"), F.round(F.col("l_tax") * 100).cast("int").cast("string").alias("k1"),
        F.format_number("l_partkey", 0).alias("k2"), F.format_number("l_suppkey", 0).alias("pa"),
        (ln + 1).cast("string").alias("pb"),
        F.when((q != 7) | (ln != 5), F.format_number(d1 + d2, 0)).alias("total"))


def _doc_facts() -> dict:
    doc = F.col("doc_index")
    single = doc % 11 == 3
    anchored = (doc == 12) | (doc >= 328)
    bare = (doc >= 328) & (doc % 13 == 0)                       # an anchor is due but missing
    plain = (F.when(doc.isin(3, 204), 3).when(doc.isin(255, 312, 313, 314, 315, 317), 2)
             .when(doc.isin(316, 318, 319), 4).when(doc.between(320, 327), 3).otherwise(1))
    first = F.when(single, 5).otherwise(0)
    start = (F.when(bare, first).when(anchored, F.lit(ANCHOR_ROW)).otherwise(plain + first))
    return {"single": single, "anchored": anchored & ~bare, "start": start}


def _front(lines: DataFrame) -> DataFrame:
    """Title, header and anchor rows of every document."""
    facts = _doc_facts()
    r, doc = F.col("row_index"), F.col("doc_index")
    docs = lines.where("doc_index IS NOT NULL").select("doc_index").distinct()
    numbers = F.sequence(F.lit(0).cast("bigint"), F.lit(FRONT_ROWS - 1).cast("bigint"))
    rows = docs.select("doc_index", F.explode(numbers).alias("row_index"))
    anchor = facts["anchored"] & r.isin(4, ANCHOR_ROW)
    patched = (doc == 339) & r.isin(10, 11, 12)
    text = {"d1": r, "d2": r + 1000, "t1": F.lit(1), "t2": F.lit(2), "k1": F.lit(3), "k2": F.lit(4), "pa": F.lit(5),
            "pb": F.lit(6), "total": r + 2000}
    return rows.select(
        "doc_index", "row_index",
        F.when(anchor | patched, "line").when(r < facts["start"], "title").otherwise("header").alias("kind"),
        F.when(anchor, "A & N Islands").when(r == 10, "Arunachal").otherwise(F.concat(F.lit("row "), r.cast("string")))
        .alias("region"),
        *[c.cast("string").alias(n) for n, c in text.items()])


def reference_cells(spark: SparkSession, sf: str) -> DataFrame:
    """The report cells: ``file_name, doc_index, table_index, row_index, cells``."""
    lines = _lines(spark, sf)
    rows = lines.unionByName(_front(lines))
    doc = F.col("doc_index")
    c = F.col
    layout = position_case(doc, REFERENCE_DISPATCH, None)
    empty_at = (F.when(doc.isin(12, 389) | ((doc < 328) & (doc % 5 == 0)), 2)     # an empty column comes in here
                .when((doc >= 328) & (doc % 5 == 2), 3).otherwise(12))
    facts = _doc_facts()
    read = rows.select("doc_index", "row_index", "kind", *[f.alias(f"v_{n}") for n, f in _fields().items()],
                       layout.alias("layout"), empty_at.alias("empty_at"), F.when(facts["single"], 0)
                       .when(doc == 12, 2).when(doc == 100, 3).otherwise(1).alias("table_index"))
    # the layouts are data: were each one's cells an expression of its own, the generated method would be
    # too long for the JVM to compile
    fields = list(_fields())
    places = F.create_map(*[x for lay, text in PRINTED.items() for x in (F.lit(lay), F.array(*[
        F.array(*[F.lit(fields.index(n)) for n in cell.split()]) for cell in text.split("|")]))])

    def printed(values):
        return F.transform(places[c("layout")], lambda cell: F.when(F.size(cell) == 1, F.get(values, cell[0])).otherwise(
            F.array_join(F.transform(cell, lambda i: F.get(values, i)), " ")))
    body = F.transform(F.array(F.array(*[c(f"v_{n}") for n in fields])), printed)[0]
    cells = (F.when(c("kind") == "title", F.array_repeat(F.lit("title"), 12))
             .when(c("kind") == "header", F.array(F.lit("1st Dose")))
             .when(c("layout").isNotNull(), F.array_insert(body, c("empty_at"), F.lit(None).cast("string"))))
    found = read.select("doc_index", "table_index", "row_index", cells.alias("cells"))
    other = (lines.where(~facts["single"]).select("doc_index").distinct()
             .select("doc_index", F.lit(0).alias("table_index"), F.lit(50).cast("bigint").alias("row_index"),
                     F.array(F.lit("another"), F.lit("A & N Islands")).alias("cells")))
    named = F.coalesce(F.concat(F.date_format(F.date_add(F.lit("2021-01-01").cast("date"), doc), "yyyy-MM-dd"),
                                F.lit(".csv")), F.lit("undated.csv"))
    return found.unionByName(other).select(named.alias("file_name"), "doc_index", "table_index", "row_index", "cells")


def q38_reference_layouts(spark: SparkSession, sf: str) -> DataFrame:
    """§2.12, P10, P11, P14-P16, P18: rows of all 18 layouts under the reference's own rules."""
    return normalize_reports(reference_cells(spark, sf), REFERENCE_LAYOUTS, REFERENCE_DISPATCH, REFERENCE_TRIM,
                             REFERENCE_MEASURES, header_marker=stages.HEADER_MARKER)


def q39_reference_vaccination(spark: SparkSession, sf: str) -> DataFrame:
    """T2 with the reference's own cleaning sequence, over the rows of q38."""
    return stages.vaccination_by_region(q38_reference_layouts(spark, sf))


def q57_rejected_documents(spark: SparkSession, sf: str) -> DataFrame:
    """§2.12 rejects: documents without a layout or without their body table."""
    return rejected_documents(reference_cells(spark, sf), REFERENCE_DISPATCH, REFERENCE_TRIM)


def q58_rejected_cells(spark: SparkSession, sf: str) -> DataFrame:
    """§2.12, F6 rejects: every unreadable cell of q38 with its original text and place."""
    rows = normalize_reports(reference_cells(spark, sf), REFERENCE_LAYOUTS, REFERENCE_DISPATCH, REFERENCE_TRIM,
                             REFERENCE_MEASURES, header_marker=stages.HEADER_MARKER, rejected=True)
    return rejected_cells(rows)


# --------------------------------------------------------------------------- SQL

_LINES = """
    ln AS (
        SELECT CASE WHEN l_orderkey % 1000 <> 999 THEN CAST(l_orderkey % 589 AS INTEGER) END AS doc,
               CAST(20 + l_orderkey * 8 + l_linenumber AS BIGINT) AS r,
               CASE l_suppkey % 12 WHEN 0 THEN 'Punjab*' WHEN 1 THEN 'Chhattisgarh*' WHEN 2 THEN 'Haveli'
                 WHEN 3 THEN 'Dadra & Nagar' WHEN 4 THEN 'Daman & Diu' WHEN 5 THEN 'Jammu & Kashmir'
                 WHEN 7 THEN 'Kerala' WHEN 8 THEN 'Goa' WHEN 9 THEN 'Dadra & Nagar Haveli'
                 WHEN 10 THEN 'Arunachal' || chr(13) || 'Pradesh'
                 WHEN 11 THEN 'Dadra & Nagar' || chr(13) || 'Haveli' END AS region,
               CAST(CASE WHEN l_quantity = 50 AND l_linenumber = 1 THEN 5250505
                 WHEN l_quantity = 49 AND l_linenumber = 1 THEN 5789969 ELSE l_quantity END AS BIGINT) AS d1,
               l_quantity = 13 AND l_linenumber = 6 AS bad, l_quantity = 7 AND l_linenumber = 5 AS untotalled,
               CAST(floor(l_extendedprice) AS BIGINT) AS d2, CAST(round(l_discount * 100) AS BIGINT) AS t1,
               CAST(l_linenumber AS BIGINT) AS t2, CAST(round(l_tax * 100) AS BIGINT) AS k1,
               CAST(l_partkey AS BIGINT) AS k2, CAST(l_suppkey AS BIGINT) AS pa,
               CAST(l_linenumber + 1 AS BIGINT) AS pb
        FROM lineitem)
"""

_ROWS = _LINES + """,
    docs AS (SELECT DISTINCT doc FROM ln WHERE doc IS NOT NULL),
    bodies AS (
        SELECT doc, r, region, CASE WHEN bad THEN 0 ELSE d1 END AS d1, d2, t1, t2, k1, k2, pa, pb,
               CASE WHEN NOT untotalled THEN d1 + d2 END AS total, bad
        FROM ln WHERE doc IS NOT NULL AND doc <> 100
        UNION ALL
        SELECT doc, 8, 'A & N Islands', 8, 1008, 1, 2, 3, 4, 5, 6, 2008, false FROM docs
        WHERE doc = 12 OR (doc >= 328 AND doc % 13 <> 0)
        UNION ALL
        SELECT doc, 10, 'Arunachal Pradesh', 11, 1011, 1, 2, 3, 4, 5, 6, 2011, false FROM docs WHERE doc = 339),
    laid AS (
        SELECT *, CASE WHEN doc = 0 THEN 1 WHEN doc = 164 THEN 2 WHEN doc = 196 THEN 3 WHEN doc = 316 THEN 4
                 WHEN doc <= 310 THEN 5 WHEN doc <= 317 THEN 6 WHEN doc = 339 THEN 7
                 WHEN doc <= 330 OR doc IN (332, 333, 337) THEN 8 WHEN doc <= 338 THEN 9
                 WHEN doc IN (340, 341, 344, 345, 353, 355, 361, 363, 365, 366, 371, 374, 380, 382) THEN 10
                 WHEN doc <= 383 THEN 11 WHEN doc = 389 THEN 12 WHEN doc BETWEEN 409 AND 411 THEN 13
                 WHEN doc <= 408 THEN 14
                 WHEN doc IN (527, 528, 532, 538, 570, 573, 578, 579, 583) OR doc BETWEEN 546 AND 556 THEN 15
                 WHEN doc >= 529 THEN 16 WHEN doc IN (439, 522) THEN 17 ELSE 18 END AS lay,
               CASE WHEN doc >= 328 AND doc % 13 = 0 THEN CASE WHEN doc % 11 = 3 THEN 5 ELSE 0 END
                 WHEN doc = 12 OR doc >= 328 THEN 8
                 ELSE CASE WHEN doc IN (3, 204) THEN 3 WHEN doc IN (255, 312, 313, 314, 315, 317) THEN 2
                   WHEN doc IN (316, 318, 319) THEN 4 WHEN doc BETWEEN 320 AND 327 THEN 3 ELSE 1 END
                   + CASE WHEN doc % 11 = 3 THEN 5 ELSE 0 END END AS start
        FROM bodies),
    ref_rows AS (
        SELECT CAST(DATE '2021-01-01' + doc AS DATE) AS day, doc AS doc_index,
               CAST(r - start AS BIGINT) AS rel_row, region, d1 AS dose_1, d2 AS dose_2,
               CASE WHEN lay IN (1, 2, 3, 5) THEN 0 ELSE t1 END AS "15_18_years_dose_1",
               CASE WHEN lay >= 10 THEN t2 ELSE 0 END AS "15_18_years_dose_2",
               CASE WHEN lay >= 12 THEN k1 ELSE 0 END AS "12_14_years_dose_1",
               CASE WHEN lay >= 15 THEN k2 ELSE 0 END AS "12_14_years_dose_2",
               CASE WHEN lay >= 15 THEN pa + pb WHEN lay >= 7 THEN pa ELSE 0 END AS precaution_dose,
               CASE WHEN lay = 2 THEN d1 + d2 WHEN lay IN (4, 6) THEN coalesce(total, 0) + t1
                 ELSE coalesce(total, 0) END AS total_doses,
               CAST(CASE WHEN NOT bad THEN 0 WHEN lay = 2 THEN 2 ELSE 1 END AS INTEGER) AS rejects
        FROM laid WHERE lay NOT IN (15, 16) OR (region IS NOT NULL AND total IS NOT NULL))
"""

_SUMS = ", ".join(f'CAST(sum("{m}") AS BIGINT) AS "{m}"' for m in REFERENCE_MEASURES)

REFERENCE_ORACLE = {
    "q38_reference_layouts": "WITH " + _ROWS
    + " SELECT * REPLACE (strftime(day, '%Y-%m-%d') AS day) FROM ref_rows",
    "q39_reference_vaccination": "WITH " + _ROWS + """,
        named AS (
            SELECT * REPLACE (CASE region WHEN 'A & N Islands' THEN 'Andaman and Nicobar Islands'
                WHEN 'Punjab*' THEN 'Punjab' WHEN 'Chhattisgarh*' THEN 'Chhattisgarh'
                WHEN 'Arunachal' || chr(13) || 'Pradesh' THEN 'Arunachal Pradesh'
                WHEN 'Dadra & Nagar' || chr(13) || 'Haveli' THEN 'Dadra & Nagar Haveli' ELSE region END AS region)
            FROM ref_rows),
        patched AS (
            SELECT * REPLACE (CASE dose_1 WHEN 5250505 THEN 'Himachal Pradesh' WHEN 5789969 THEN 'Jammu & Kashmir'
                ELSE region END AS region)
            FROM named WHERE region IS DISTINCT FROM 'Haveli'),
        merged AS (
            SELECT * REPLACE (CASE WHEN region IS NULL OR region IN ('Dadra & Nagar Haveli', 'Daman & Diu')
                THEN 'Dadra and Nagar Haveli and Daman and Diu' WHEN region = 'Jammu & Kashmir'
                THEN 'Jammu and Kashmir' ELSE region END AS region)
            FROM patched
            WHERE NOT (day = DATE '2021-04-02' AND dose_1 = 0)
              AND NOT (coalesce(region, '') = 'Dadra & Nagar' AND dose_1 = 0))
        SELECT strftime(day, '%Y-%m-%d') AS day, region, """ + _SUMS + " FROM merged GROUP BY 1, 2",
    "q58_rejected_cells": "WITH " + _ROWS + """,
        cells AS (
            SELECT strftime(DATE '2021-01-01' + doc, '%Y-%m-%d') || '.csv' AS file_name, doc AS doc_index,
                   r AS row_index, region, unnest(CASE WHEN lay = 2 THEN ['dose_1', 'total_doses'] ELSE ['dose_1'] END)
                   AS measure, CAST(CASE lay WHEN 1 THEN 4 WHEN 3 THEN 1 ELSE 2 END AS INTEGER) AS cell,
                   'n.a.' || CASE WHEN lay IN (3, 7, 8, 11, 13, 14, 15, 17) THEN ' ' || format('{:,}', d2) ELSE '' END
                   || CASE WHEN lay IN (8, 11, 13, 14) THEN ' ' || t1 ELSE '' END
                   || CASE WHEN lay IN (11, 13, 14) THEN ' ' || t2 ELSE '' END
                   || CASE WHEN lay = 13 THEN ' ' || k1 ELSE '' END AS text
            FROM laid WHERE bad AND (lay NOT IN (15, 16) OR (region IS NOT NULL AND total IS NOT NULL)))
        SELECT * FROM cells""",
    # a document holds its line items, 13 front rows and, if it has several tables, a row of another one
    "q57_rejected_documents": "WITH " + _LINES + """
        SELECT doc AS doc_index, CASE WHEN doc IS NULL THEN 'no layout' ELSE 'no body table' END AS reason,
               CAST(count(*) + CASE WHEN doc IS NULL THEN 0 ELSE 14 END AS BIGINT) AS n_rows
        FROM ln WHERE doc IS NULL OR doc = 100 GROUP BY doc""",
}
