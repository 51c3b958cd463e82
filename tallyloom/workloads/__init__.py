"""Queries over the star-schema test tables, each with an independent SQL statement.

``data`` projects the test tables into the raw shapes of the pipeline; the other
modules run the library on them.
"""

from __future__ import annotations


def catalog() -> dict[str, tuple]:
    """Query name to (callable, SQL or None)."""
    from tallyloom.workloads import files, live, models, operators

    return {**models.QUERIES, **operators.QUERIES, **files.QUERIES, **live.QUERIES}
