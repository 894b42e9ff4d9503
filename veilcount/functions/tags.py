"""Tags that stand for a measurement prefix."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

TAG_BYTES = 20


def _next(above: Column, layer: Column) -> Column:
    """Hex tag of a prefix from the hex tag of the prefix above it, which has a fixed length."""
    return F.substring(F.sha2(F.concat(above, F.lit("/"), layer), 256), 1, 2 * TAG_BYTES)


def _root(epoch: Column, secret: str) -> Column:
    return F.concat(F.lit(f"{secret}/"), epoch.cast("string"))


def prefix_tag(epoch: Column, prefix: Column, secret: str = "") -> Column:
    """20 bytes that are equal for equal (secret, epoch, prefix): SHA-256 values chained along the layers."""
    return F.unhex(F.aggregate(prefix, _root(epoch, secret), _next))


def tag_path(epoch: Column, layers: Column, secret: str = "") -> Column:
    """The tags of all prefixes of ``layers``, shortest first, with one hash per layer."""
    above = lambda tags: F.coalesce(F.try_element_at(tags, F.lit(-1)), _root(epoch, secret))
    tags = F.aggregate(
        layers, F.array().cast("array<string>"), lambda done, layer: F.array_append(done, _next(above(done), layer))
    )
    return F.transform(tags, F.unhex)
