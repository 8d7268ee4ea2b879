"""All registered queries and their SQL."""

from catalodge.queries.registry import ORACLE, QUERIES


def all_queries():
    """(name -> callable, name -> SQL); importing the binding modules registers them."""
    from catalodge.queries import extraction, merges, relational, reports, scalars, sequences, streams  # noqa: F401

    return dict(QUERIES), dict(ORACLE)
