"""Runnable queries over the given tables, one or more per operator."""

from orebed.catalog.registry import ORACLES, QUERIES


def all_queries():
    _load()
    return dict(QUERIES)


def all_oracles():
    _load()
    return dict(ORACLES)


def _load():
    from orebed.catalog import q_basic, q_mining, q_profile  # noqa: F401
