"""All registered queries with their comparison SQL, by topic."""

from __future__ import annotations

from functools import wraps
from importlib import import_module

_TOPICS = ("threshold", "intake", "epochs", "report", "state", "lake", "monitoring", "sealed")


def _topics():
    return [import_module(f"veilcount.catalog.{topic}") for topic in _TOPICS]


def _in_utc(query):
    """Epochs and dates are in UTC, whatever the session was started with."""

    @wraps(query)
    def run(spark, sf_dir):
        spark.conf.set("spark.sql.session.timeZone", "UTC")
        return query(spark, sf_dir)

    return run


def queries() -> dict:
    found: dict = {}
    for topic in _topics():
        found.update({name: _in_utc(query) for name, query in topic.QUERIES.items()})
    return found


def oracle_sql() -> dict[str, str]:
    found: dict[str, str] = {}
    for topic in _topics():
        found.update(topic.ORACLES)
    return found
