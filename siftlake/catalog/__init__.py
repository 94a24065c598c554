"""Registered queries over the shared tables and their SQL counterparts."""

from ..session import tune
from . import flow_oracles, flows, oracles, queries


def _tuned(query):
    def run(spark, sf_dir):
        return query(tune(spark), sf_dir)

    return run


QUERIES = {**queries.QUERIES, **{name: _tuned(query) for name, query in flows.QUERIES.items()}}
ORACLES = {**oracles.build(), **flow_oracles.build()}
