"""Fixture tables, registered queries and end-to-end pipelines."""
