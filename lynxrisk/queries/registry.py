"""The list of registered queries, each with its SQL twin."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from lynxrisk.queries.feed_sql import with_feeds
from lynxrisk.queries.feeds import Feeds

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register a function of ``Feeds`` as a query; ``sql`` is what it must equal."""

    def register(function: Callable[[Feeds], DataFrame]):
        QUERIES[name] = lambda spark, folder: function(Feeds(spark, folder))
        if sql is not None:
            ORACLES[name] = with_feeds(sql)
        return function

    return register
