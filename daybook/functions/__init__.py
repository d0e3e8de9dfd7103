"""Column-level helpers: every function returns a Spark ``Column`` made of built-ins."""

from daybook.functions import dates, numbers, text  # noqa: F401
