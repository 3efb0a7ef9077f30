"""Importing this module registers all queries of the package."""

from wattmill.llm import queries, queries_models, queries_tables, queries_text  # noqa: F401
