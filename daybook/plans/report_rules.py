"""The reference's vaccination report layouts, as data.

Documents are addressed by their 0-based position in the date-sorted list of
report files; rules are tested in order and the first match wins.
"""

from __future__ import annotations

from daybook.operators.layouts import Layout, TrimRules
from daybook.schemas import DOSE_MEASURES

# --------------------------------------------------------------------------- fixed values
# Measure names used in the layouts.
D1, D2 = "dose_1", "dose_2"
T1, T2 = "15_18_years_dose_1", "15_18_years_dose_2"
K1, K2 = "12_14_years_dose_1", "12_14_years_dose_2"
PREC, TOTAL = "precaution_dose", "total_doses"
PA, PB = "precaution_dose_18_59", "precaution_dose_60_plus"
TOTAL_CELL = "_total_cell"   # printed total before adding the 15-18 first doses
IGNORED = "_ignored"         # split off, not kept

# The 18 layouts.  Groups list the token names of each cell (or of
# several cells joined, see group_cells) after the region cell; None = skipped cell.
REFERENCE_LAYOUTS = [
    Layout("L01", groups=(None, None, (D1,), (D2,), (TOTAL,))),
    Layout("L02", groups=((D1,), (D2,)), sums=((TOTAL, (D1, D2)),)),
    Layout("L03", groups=((D1, D2), (TOTAL,)), region_cell=0, strip_region_digits=True),
    Layout("L04", groups=((D1,), (D2, TOTAL_CELL), (T1,)), sums=((TOTAL, (TOTAL_CELL, T1)),)),
    Layout("L05", groups=((D1,), (D2,), (TOTAL,))),
    Layout("L06", groups=((D1,), (D2,), (TOTAL_CELL,), (T1,)),
           sums=((TOTAL, (TOTAL_CELL, T1)),)),
    Layout("L07", groups=((D1, D2), (T1, IGNORED), (PREC,), (TOTAL,)),
           renames=(("Arunachal", "Arunachal Pradesh"),), row_copies=((2, 3),),
           row_drops=(3, 4)),
    Layout("L08", groups=((D1, D2, T1), (PREC,), (TOTAL,))),
    Layout("L09", groups=((D1,), (D2,), (T1,), (PREC,), (TOTAL,))),
    Layout("L10", groups=((D1,), (D2,), (T1,), (T2,), (PREC,), (TOTAL,))),
    Layout("L11", groups=((D1, D2, T1, T2), (PREC,), (TOTAL,)), group_cells=(2, 1, 1)),
    Layout("L12", groups=((D1,), (D2,), (T1,), (T2,), (K1,), (PREC,), (TOTAL,))),
    Layout("L13", groups=((D1, D2, T1, T2, K1), (PREC,), (TOTAL,)), group_cells=(2, 1, 1)),
    Layout("L14", groups=((D1, D2, T1, T2), (K1,), (PREC,), (TOTAL,)),
           group_cells=(2, 1, 1, 1)),
    Layout("L15", groups=((D1, D2), (T1, T2, K1, K2, PA, PB), (TOTAL,)),
           group_cells=(1, 2, 1), sums=((PREC, (PA, PB)),), drop_null_rows=True),
    Layout("L16", groups=((D1,), (D2,), (T1,), (T2,), (K1,), (K2,), (PA,), (PB,), (TOTAL,)),
           sums=((PREC, (PA, PB)),), drop_null_rows=True),
    Layout("L17", groups=((D1, D2), (T1, T2, K1, K2), (PA, PB), (TOTAL,)),
           sums=((PREC, (PA, PB)),)),
    Layout("L18", groups=((D1,), (D2,), (T1,), (T2,), (K1,), (K2,), (PA,), (PB,), (TOTAL,)),
           sums=((PREC, (PA, PB)),)),
]

# Document position -> layout, tested in this order.
REFERENCE_DISPATCH = [
    ((0,), "L01"),
    ((164,), "L02"),
    ((196,), "L03"),
    ((316,), "L04"),
    (((None, 310),), "L05"),
    (((None, 317),), "L06"),
    ((339,), "L07"),
    (((318, 330), 332, 333, 337), "L08"),
    ((331, 334, 335, 336, 338), "L09"),
    ((340, 341, 344, 345, 353, 355, 361, 363, 365, 366, 371, 374, 380, 382), "L10"),
    ((342, 343, 346, 347, 348, 349, 350, 351, 352, 354, 356, 357, 358, 359, 360, 362, 364,
      367, 368, 369, 370, 372, 373, 375, 376, 377, 378, 379, 381, 383), "L11"),
    ((389,), "L12"),
    (((409, 411),), "L13"),
    (((384, 408),), "L14"),
    ((527, 528, 532, 538, 570, 573, 578, 579, 583, (546, 556)), "L15"),
    ((529, 530, 531, 533, 534, 535, 536, 537, (539, 545), (557, 569), (571, None)), "L16"),
    ((439, 522), "L17"),
    (((412, None),), "L18"),
]

# Which rows of each document are its body.
REFERENCE_TRIM = TrimRules(
    single_table_skip=5,
    body_table=(((12,), 2),),
    default_body_table=1,
    skip=(((3, 204), 3), ((255, 312, 313, 314, 315, 317), 2), ((316, 318, 319), 4),
          (((320, 327),), 3)),
    anchor=(((389, 12), 2), (((328, None),), 1)),
    anchor_text="A & N Islands",
    default_skip=1,
)

REFERENCE_MEASURES = list(DOSE_MEASURES)
