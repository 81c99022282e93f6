"""Operators of a training-data pipeline, each over whole tables (see ``wattloom.llm.queries``).

Nothing else in the library imports this package.
"""
