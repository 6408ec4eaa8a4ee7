"""All registered queries and the SQL that checks them."""

from __future__ import annotations

from functools import wraps

from clickflow.plans import clicks, stores, streams

PARTS = (clicks, stores, streams)


def _utc(query):
    """Runs a query with the calendar in UTC, which the SQL side uses."""
    @wraps(query)
    def run(spark, folder):
        spark.conf.set("spark.sql.session.timeZone", "UTC")
        return query(spark, folder)
    return run


def all_queries():
    return {name: _utc(query) for part in PARTS for name, query in part.QUERIES.items()}


def all_oracles():
    return {name: sql for part in PARTS for name, sql in part.ORACLES.items()}
