"""Small tables for tests."""

from veilcount.operators import state

RECOVERED = (
    "epoch SMALLINT, tag BINARY, parent_tag BINARY, name STRING, value STRING, path ARRAY<BINARY>, "
    "chain ARRAY<STRUCT<name: STRING, value: STRING>>, key BINARY, count BIGINT, has_children BOOLEAN"
)


def tag(number: int) -> bytes:
    return bytes([number]) * 20


def recovered(spark, rows):
    """rows: (tag, epoch, name, value, parent or None, count, has_children), parents before children."""
    paths, made = {}, []
    for number, epoch, name, value, parent, count, has_children in rows:
        path, chain = paths.get((epoch, parent), ([], []))
        path, chain = path + [tag(number)], chain + [(name, value)]
        paths[epoch, number] = (path, chain)
        parent_tag = None if parent is None else tag(parent)
        made.append((epoch, tag(number), parent_tag, name, value, path, chain, b"k" * 32, count, has_children))
    return spark.createDataFrame(made, RECOVERED)


def messages(spark, rows):
    """rows: (epoch, layers, threshold, how many)."""
    listed = [(e, layers, t) for e, layers, t, n in rows for _ in range(n)]
    return spark.createDataFrame(listed, "epoch SMALLINT, layers ARRAY<STRING>, threshold INT")


def as_changes(recovered_rows):
    return recovered_rows.withColumnRenamed("count", "change").select(
        "epoch", "tag", "parent_tag", "name", "value", "path", "chain", "key", "change", "has_children"
    )


__all__ = ["tag", "recovered", "messages", "as_changes", "state"]
