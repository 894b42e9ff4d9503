"""Report rows as JSON texts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def measurement_fields(chain: Column, total: Column, date_field: str, date: Column) -> Column:
    """MAP<STRING, VARIANT> of one measurement.

    ``chain`` is an array of (name, value). A later layer wins over an earlier one of the same name, and ``total`` and
    the date field win over both. Values are strings, ``total`` is a number.
    """
    names = F.transform(chain, lambda c: c["name"])
    reserved = F.array(F.lit("total"), F.lit(date_field))
    last_of_name = F.filter(
        F.transform(chain, lambda c, at: F.struct(c["name"].alias("name"), c["value"].alias("value"), at.alias("at"))),
        lambda c: (F.array_position(F.reverse(names), c["name"]) == F.size(names) - c["at"])
        & ~F.array_contains(reserved, c["name"]),
    )
    metrics = F.map_from_entries(
        F.transform(last_of_name, lambda c: F.struct(c["name"], c["value"].cast("variant")))
    )
    # A date field named "total" keeps the date, which is written last.
    own = [F.lit(date_field), date.cast("variant")]
    if date_field != "total":
        own = [F.lit("total"), total.cast("variant")] + own
    return F.map_concat(metrics, F.create_map(*own))


def measurement_json(chain: Column, total: Column, date_field: str, date: Column) -> Column:
    return F.to_json(measurement_fields(chain, total, date_field, date))
