"""Report-layout normalization with the reference's rules, on hand-made documents."""

import datetime as dt
import re

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from daybook.operators.layouts import Layout, TrimRules, normalize_reports, normalize_rows, position_case
from daybook.plans import stages
from daybook.plans.report_rules import (REFERENCE_DISPATCH, REFERENCE_LAYOUTS, REFERENCE_MEASURES,
                                        REFERENCE_TRIM)
from daybook.schemas import REPORT_CELLS
from tests.conftest import SF_SMALL, rows

M = REFERENCE_MEASURES


def normalize(spark, cells):
    df = spark.createDataFrame(cells, REPORT_CELLS)
    out = normalize_reports(df, REFERENCE_LAYOUTS, REFERENCE_DISPATCH, REFERENCE_TRIM, M,
                            header_marker="1st Dose")
    return {(r["doc_index"], r["rel_row"]): r.asDict() for r in out.collect()}


def measures(row):
    return [row[m] for m in M]


def test_l01_default_skip_and_session_columns(spark):
    f = "2021-01-16.pdf"
    got = normalize(spark, [
        (f, 0, 0, 0, ["title"]),
        (f, 0, 1, 0, ["S", "State", "Planned", "Done", "D1", "D2", "Total"]),
        (f, 0, 1, 1, ["1", "Goa", "10", "9", "1,000", "0", "1,000"]),
    ])
    r = got[(0, 0)]
    assert r["day"] == dt.date(2021, 1, 16) and r["region"] == "Goa"
    assert measures(r) == [1000, 0, 0, 0, 0, 0, 0, 1000]


def test_single_table_document_skips_five_rows(spark):
    f = "2021-03-01.pdf"
    cells = [(f, 50, 0, i, ["junk", "junk", "junk"]) for i in range(5)]
    cells += [(f, 50, 0, 5, ["S", "State", "x"]),            # header: default skip 1
              (f, 50, 0, 6, ["1", "Kerala", "7"])]
    layout_cells = [(a, b, c, d, e + ["8", "15"]) for a, b, c, d, e in cells]
    got = normalize(spark, layout_cells)
    assert list(got) == [(50, 0)]
    assert measures(got[(50, 0)])[:2] == [7, 8] and got[(50, 0)]["total_doses"] == 15


def test_doc_12_body_table_2_anchor_cell_2_and_empty_column(spark):
    f = "2021-01-28.pdf"
    got = normalize(spark, [
        (f, 12, 0, 0, ["t"]), (f, 12, 1, 0, ["t"]),
        (f, 12, 2, 0, ["S", None, "State", "D1", "D2", "Total"]),
        (f, 12, 2, 1, ["0", None, "A & N Islands", "1", "1", "2"]),
        (f, 12, 2, 2, ["1", None, "A & N Islands", "5", "6", "11"]),
        (f, 12, 2, 3, ["2", None, "Goa", "1,234", "0", "1,234"]),
    ])
    assert sorted(got) == [(12, 0), (12, 1)]
    assert got[(12, 0)]["region"] == "A & N Islands"
    assert measures(got[(12, 1)]) == [1234, 0, 0, 0, 0, 0, 0, 1234]


def test_l07_row_patch_and_rename(spark):
    f = "2022-01-20.pdf"
    body = [["1", "A & N Islands", "1 2", "3 0", "4", "10"],
            ["2", "Andhra", "5 6", "7 0", "8", "26"],
            ["3", "Arunachal", None, None, None, None],
            ["", "Pradesh", "9 10", "11 0", "12", "42"],
            ["", "x", "0 0", "0 0", "0", "0"],
            ["6", "Assam", "1 1", "1 0", "1", "4"]]
    got = normalize(spark, [(f, 339, 0, 0, ["t"])] +
                    [(f, 339, 1, i, c) for i, c in enumerate(body)])
    assert sorted(got) == [(339, 0), (339, 1), (339, 2), (339, 5)]
    r = got[(339, 2)]
    assert r["region"] == "Arunachal Pradesh"
    assert [r["dose_1"], r["dose_2"], r["15_18_years_dose_1"], r["precaution_dose"],
            r["total_doses"]] == [9, 10, 11, 12, 42]


def test_l08_three_numbers_in_one_cell_and_header_rows(spark):
    f = "2022-01-13.pdf"
    got = normalize(spark, [(f, 322, 0, 0, ["t"])] + [
        (f, 322, 1, 0, ["h"] * 5), (f, 322, 1, 1, ["h"] * 5), (f, 322, 1, 2, ["h"] * 5),
        (f, 322, 1, 3, ["S", "State", "1st Dose", "p", "t"]),
        (f, 322, 1, 4, ["1", "Kerala", "1,000 2,000 30", "40", "3,070"])])
    assert list(got) == [(322, 1)]
    assert measures(got[(322, 1)]) == [1000, 2000, 30, 0, 0, 0, 40, 3070]


def test_l11_cells_joined_before_split(spark):
    f = "2022-02-01.pdf"
    got = normalize(spark, [(f, 350, 0, 0, ["t"]),
                            (f, 350, 1, 0, ["1", "A & N Islands", "1,000", "2,000 30 40", "50",
                                            "3,120"])])
    assert measures(got[(350, 0)]) == [1000, 2000, 30, 40, 0, 0, 50, 3120]


def test_l15_drops_rows_with_nulls_and_sums_precaution(spark):
    f = "2022-06-01.pdf"
    got = normalize(spark, [(f, 527, 0, 0, ["t"]),
                            (f, 527, 1, 0, ["1", "A & N Islands", "1 2", "3 4 5", "6 7 8", "99"]),
                            (f, 527, 1, 1, ["2", "Goa", "1 2", None, "6 7 8", "99"])])
    assert list(got) == [(527, 0)]
    assert measures(got[(527, 0)]) == [1, 2, 3, 4, 5, 6, 15, 99]


def test_l16_junk_columns_do_not_drop_rows(spark):
    f = "2022-06-03.pdf"
    full = ["1", "A & N Islands", "1", "2", "3", "4", "5", "6", "7", "8", "9"]
    got = normalize(spark, [(f, 529, 0, 0, ["t"]),
                            (f, 529, 1, 0, full + ["j", "j"]),
                            (f, 529, 1, 1, ["2", "Goa", None] + full[3:] + ["j", "j"]),
                            (f, 529, 1, 2, ["3", "Kerala"] + full[2:] + [None, "j"])])
    assert sorted(got) == [(529, 0), (529, 2)]
    assert measures(got[(529, 0)]) == [1, 2, 3, 4, 5, 6, 15, 9]


def test_l03_digits_stripped_and_no_serial(spark):
    f = "2021-08-01.pdf"
    got = normalize(spark, [(f, 196, 0, 0, ["t"]), (f, 196, 1, 0, ["hdr", "x", "y"]),
                            (f, 196, 1, 1, ["12Kerala", "7 8", "15"])])
    r = got[(196, 0)]
    assert r["region"] == "Kerala" and measures(r)[:2] == [7, 8] and r["total_doses"] == 15


def test_l04_total_adds_teen_doses(spark):
    f = "2022-01-08.pdf"
    got = normalize(spark, [(f, 316, 0, 0, ["t"])] +
                    [(f, 316, 1, i, ["h"] * 5) for i in range(4)] +
                    [(f, 316, 1, 4, ["1", "Goa", "10", "20 30", "5"])])
    assert measures(got[(316, 0)]) == [10, 20, 5, 0, 0, 0, 0, 35]


def test_rejects_are_counted(spark):
    lay = Layout("X", groups=(("dose_1",), ("dose_2", "total_doses")))
    df = spark.createDataFrame([(["s", "Goa", "12.5", "1 2 3"], "X")], "cells array<string>, layout string")
    r = normalize_rows(df, [lay], M).collect()[0]
    assert r["dose_1"] == 0 and r["dose_2"] == 1 and r["total_doses"] == 2
    assert r["rejects"] == 3  # '12.5' and two tokens of a group with one number too many


def test_trim_rules_other_than_reference(spark):
    lay = Layout("Y", groups=(("dose_1",),))
    trim = TrimRules(single_table_skip=0, default_skip=0)
    df = spark.createDataFrame([("2020-01-01.pdf", 1, 0, 0, ["1", "Goa", None]),
                                ("2020-01-01.pdf", 1, 0, 1, ["2", "Goa", None])], REPORT_CELLS)
    # the third position is empty in the whole document and disappears
    out = normalize_reports(df, [lay], [((1,), "Y")], trim, ["dose_1"])
    assert rows(out, "rel_row", "dose_1") == [(0, 0), (1, 0)]


def test_reference_cleaning_sequence(spark):
    d = dt.date(2021, 4, 2)
    e = dt.date(2021, 4, 3)
    data = [
        (e, "Punjab*", 1, 1), (e, "A & N Islands", 2, 2), (e, "Haveli", 3, 3),
        (e, "Wrong", 5250505, 1), (e, "Jammu & Kashmir", 7, 7),
        (d, "Goa", 0, 9), (d, "Goa", 4, 4),
        (e, None, 10, 10), (e, "Dadra & Nagar", 0, 5), (e, "Dadra & Nagar Haveli", 1, 1),
        (e, "Daman & Diu", 2, 2),
    ]
    df = spark.createDataFrame(data, "day date, region string, dose_1 bigint, total_doses bigint")
    for m in M:
        if m not in df.columns:
            df = df.withColumn(m, F.lit(0).cast("bigint"))
    out = stages.vaccination_by_region(df)
    got = {(r["day"], r["region"]): (r["dose_1"], r["total_doses"]) for r in out.collect()}
    assert got == {
        (e, "Punjab"): (1, 1),
        (e, "Andaman and Nicobar Islands"): (2, 2),
        (e, "Himachal Pradesh"): (5250505, 1),
        (e, "Jammu and Kashmir"): (7, 7),
        (d, "Goa"): (4, 4),
        (e, "Dadra and Nagar Haveli and Daman and Diu"): (13, 13),
    }


@st.composite
def layout_and_rows(draw):
    count = draw(st.integers(1, len(M)))
    names = draw(st.permutations(M))[:count]
    groups, widths, i = [], [], 0
    while i < len(names):
        size = draw(st.integers(1, min(3, len(names) - i)))
        groups.append(tuple(names[i:i + size]))
        widths.append(draw(st.integers(1, 2)) if size > 1 else 1)
        i += size
    splits = [draw(st.integers(1, len(g) - 1)) if w == 2 else 0 for g, w in zip(groups, widths)]
    values = draw(st.lists(st.lists(st.integers(0, 10**9), min_size=len(names),
                                    max_size=len(names)), min_size=1, max_size=5))
    return groups, widths, splits, names, values


@settings(max_examples=25, deadline=None)
@given(layout_and_rows())
def test_any_layout_recovers_the_numbers(spark, case):
    groups, widths, splits, names, values = case
    lay = Layout("R", groups=tuple(groups), group_cells=tuple(widths))
    data = []
    for r, vals in enumerate(values):
        by_name = dict(zip(names, vals))
        cells = [str(r), "Region"]
        for grp, width, k in zip(groups, widths, splits):
            toks = [f"{by_name[n]:,}" for n in grp]
            cells += [" ".join(toks)] if width == 1 else [" ".join(toks[:k]), " ".join(toks[k:])]
        data.append((cells, "R", r))
    df = spark.createDataFrame(data, "cells array<string>, layout string, r int")
    out = {row["r"]: row for row in normalize_rows(df, [lay], M, keep=["r"]).collect()}
    assert len(out) == len(values)
    for r, vals in enumerate(values):
        by_name = dict(zip(names, vals))
        assert [out[r][m] for m in M] == [by_name.get(m, 0) for m in M]
        assert out[r]["rejects"] == 0 and out[r]["region"] == "Region"


CELL = st.one_of(st.none(), st.sampled_from(["", "nan", "n.a.", "1 2", "3,000 4", " 5", "6 ", "12.5", "1  2",
                                             "99999999999999999999", "7 8 9", "-3", "1 2 3 4"]),
                 st.integers(0, 10 ** 7).map(lambda n: f"{n:,}"))


@settings(max_examples=20, deadline=None)
@given(data=st.lists(st.tuples(st.sampled_from(REFERENCE_LAYOUTS), st.lists(CELL, min_size=0, max_size=12)),
                     min_size=1, max_size=40))
def test_regular_rows_read_as_all_others(spark, data):
    """Rows split once into their numbers give what the general expression gives."""
    from daybook.operators import layouts as lib
    df = spark.createDataFrame([(i, lay.name, ["1", "Goa", *cells]) for i, (lay, cells) in enumerate(data)],
                               "r int, layout string, cells array<string>")
    fast = rows(normalize_rows(df, REFERENCE_LAYOUTS, M, keep=["r"], rejected=True))
    kept = lib._regular_rows
    lib._regular_rows = lambda lay: (0, 0, [])
    try:
        assert rows(normalize_rows(df, REFERENCE_LAYOUTS, M, keep=["r"], rejected=True)) == fast
    finally:
        lib._regular_rows = kept


def test_patterns_of_regular_rows():
    from daybook.operators.layouts import _regular_rows
    by_name = {lay.name: _regular_rows(lay) for lay in REFERENCE_LAYOUTS}
    assert by_name["L01"] == (4, 3, ["||"])
    assert by_name["L08"] == (2, 3, ["  ||"])
    assert sorted(by_name["L11"][2]) == sorted(["|  ||", " | ||", "  |||"])
    assert _regular_rows(Layout("X", groups=(("a",), None, ("b",)))) == (2, 3, [])
    assert _regular_rows(Layout("X", groups=(None,)))[2] == []
    assert all(patterns for _, _, patterns in by_name.values())


def test_rejected_cells_hold_the_original_text(spark):
    from daybook.operators.layouts import rejected_cells
    f = "2022-03-01.pdf"
    cells = [(f, 340, 1, 1, ["1", "Goa", "1,5x", "2", "3", "4", "5", "6"]),
             (f, 340, 1, 2, ["2", "Kerala", "1", "2", "99999999999999999999", "4", "5", None]),
             (f, 340, 1, 3, ["3", "Punjab", "1", "2", "3", "4", "5", "6"]), (f, 340, 0, 0, ["t"])]
    df = spark.createDataFrame(cells, REPORT_CELLS)
    out = normalize_reports(df, REFERENCE_LAYOUTS, REFERENCE_DISPATCH, REFERENCE_TRIM, M, rejected=True)
    assert rows(rejected_cells(out), "row_index", "region", "measure", "cell", "text") == [
        (1, "Goa", "dose_1", 2, "1,5x"), (2, "Kerala", "15_18_years_dose_1", 4, "99999999999999999999")]


def test_cell_store_on_a_path_is_read_like_the_cells(spark, tmp_path):
    from daybook.operators.layouts import cell_store, is_cell_store
    f = "2021-03-01.pdf"
    cells = [(f, 400 + d, t, r, ["x", "A & N Islands" if r == 30 else f"R{r}", None, str(r), str(t)])
             for d in range(3) for t in range(2) for r in range(60)] + [(f, 500, 0, 0, None), (None, None, 0, 0, ["a"])]
    df = spark.createDataFrame(cells, REPORT_CELLS).repartition(5)
    store = cell_store(df, REFERENCE_TRIM.anchor_text, str(tmp_path / "cells"))
    assert is_cell_store(store, REFERENCE_TRIM.anchor_text) and not is_cell_store(store, "another")
    run = lambda c: rows(normalize_reports(c, REFERENCE_LAYOUTS, REFERENCE_DISPATCH, REFERENCE_TRIM, M))
    assert run(store) == run(df) and len(run(df)) == 3 * 30


def test_cells_are_read_once(spark):
    """The statistics read narrow facts only; the cells column is in one scan."""
    f = "2021-03-01.pdf"
    df = spark.createDataFrame([(f, 420, 1, r, ["x", "A & N Islands", str(r)]) for r in range(9)], REPORT_CELLS)
    lay = [lay for lay in REFERENCE_LAYOUTS if not lay.row_copies]
    out = normalize_reports(df, lay, [(cond, n) for cond, n in REFERENCE_DISPATCH if n != "L07"], REFERENCE_TRIM, M)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("cells:array<string>") == 1


def test_rejected_cells_read_a_row_once(spark):
    """The reading of a row's slots stays out of the expression over each slot."""
    from daybook.plans.reference_reports import q58_rejected_cells
    plan = q58_rejected_cells(spark, SF_SMALL)._jdf.queryExecution().optimizedPlan().toString()
    assert "transform(" in plan
    assert "END[lambda" not in plan and "get(CASE" not in plan


def test_cleaning_reads_a_row_once(spark):
    """The cells are read before the cleaning, so none of its conditions holds the reading."""
    from daybook.plans.reference_reports import q39_reference_vaccination
    plan = q39_reference_vaccination(spark, SF_SMALL)._jdf.queryExecution().optimizedPlan().toString()
    assert "Aggregate" in plan and "transform(" not in plan and "_slots" not in plan


def test_printing_is_short_enough_to_compile(spark, capsys):
    """The JVM never compiles a method of more than 8000 bytes."""
    from daybook.plans.reference_reports import reference_cells
    adaptive = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", False)       # its plans show no generated code
    try:
        reference_cells(spark, SF_SMALL).explain("codegen")
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", adaptive)
    sizes = [int(n) for n in re.findall(r"maxMethodCodeSize:(\d+)", capsys.readouterr().out)]
    assert sizes and max(sizes) <= 8000


def test_position_case_with_several_alternatives(spark):
    rules = [((3, (5, 6), 9), "a"), ((4, (None, 1)), "b"), (((9, None), 2, 3), "c")]
    df = spark.createDataFrame([(v,) for v in (None, *range(12))], "v int")
    got = dict(rows(df.select("v", position_case(F.col("v"), rules, "none").alias("x"))))
    assert got == {None: "none", 0: "b", 1: "b", 2: "c", 3: "a", 4: "b", 5: "a", 6: "a", 7: "none", 8: "none",
                   9: "a", 10: "c", 11: "c"}
