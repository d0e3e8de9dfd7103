"""Training-data operators: packing, filters, scans, classifiers, mixing,
near and substring duplicates, token counts and nearest neighbours.

Each module holds one operator on DataFrames; :mod:`daybook.llm.queries` has
the registered ``opN_<name>`` queries.  Nothing else in the library imports
this package.
"""
