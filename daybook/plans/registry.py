"""All registered queries and their SQL oracles, in one place.

Registered queries are deliverables: their ``date`` columns are rendered as
``yyyy-MM-dd`` text at the edge (:func:`daybook.sources.sinks.render_dates`);
the oracles do the same with ``strftime``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from daybook.plans.oracle import ORACLE
from daybook.plans.queries import OPERATOR_QUERIES
from daybook.plans.reference_reports import (REFERENCE_ORACLE, q38_reference_layouts,
                                             q39_reference_vaccination, q57_rejected_documents,
                                             q58_rejected_cells)
from daybook.plans.shapes import SHAPE_QUERIES
from daybook.sources.sinks import render_dates


def _deliverable(fn: Callable[[SparkSession, str], DataFrame]):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return render_dates(fn(spark, sf_dir))
    run.__name__ = fn.__name__
    run.__doc__ = fn.__doc__
    return run


REFERENCE_QUERIES = {f.__name__: f for f in (q38_reference_layouts, q39_reference_vaccination,
                                             q57_rejected_documents, q58_rejected_cells)}
ALL_QUERIES = {k: _deliverable(v) for k, v in
               sorted({**OPERATOR_QUERIES, **SHAPE_QUERIES, **REFERENCE_QUERIES}.items())}
ALL_ORACLE = {k: v for k, v in {**ORACLE, **REFERENCE_ORACLE}.items() if k in ALL_QUERIES}

FLAGSHIP = "q48_country_closes"
