"""Whole jobs, and the registered queries over the test tables."""


def all_queries():
    """(name -> query, name -> SQL); importing the modules registers them."""
    from . import calendars, cleaning, columns_and_rows, extraction, matching, streams, tickets  # noqa: F401
    from .catalog import ORACLES, QUERIES

    return QUERIES, ORACLES
