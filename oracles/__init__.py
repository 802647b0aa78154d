"""SQL statements of the registered queries, for an independent engine over the given tables."""

from oracles.queries import QUERIES


def oracle_queries() -> dict[str, str]:
    return dict(QUERIES)
