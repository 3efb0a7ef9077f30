"""Importing this package registers every query."""

from wattmill.plans.catalog import chat, cleaning, features, layers, learning, models, text  # noqa: F401
