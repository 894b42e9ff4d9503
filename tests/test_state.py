"""State tables and look-ups."""

from pyspark.sql import functions as F

from rows import as_changes, recovered, tag
from veilcount.operators import incremental, state
from veilcount.session import new_work_folder

ROWS = [(5, 8, "browser", "lynx", None, 6, True), (6, 8, "browser", "w3m", None, 31, False), (5, 9, "browser", "lynx", None, 14, True)]


def tables(spark):
    return state.StateTables(spark, new_work_folder(spark, "state"), incremental.PENDING)


def counts(frame):
    return {(r.epoch, bytes(r.tag)): r["count"] for r in frame.collect()}


def put(store, batch, changes, **commit):
    store.write("recovered", batch, changes)
    store.write_nothing("pending", batch)
    store.commit(batch, **commit)


def test_saved_rows_are_found_by_epoch_and_tag(spark):
    store = tables(spark)
    assert store.progress().last == -1 and store.recovered().count() == 0
    put(store, 0, as_changes(recovered(spark, ROWS)))
    wanted = spark.createDataFrame([(8, tag(5)), (9, tag(5)), (9, tag(6)), (10, tag(5))], "epoch SMALLINT, tag BINARY")
    found = state.lookup_recovered(wanted, store.recovered())
    assert counts(found) == {(8, tag(5)): 6, (9, tag(5)): 14}
    row = found.filter("epoch = 9").first()
    assert (row.name, row.value, bytes(row.key), row.has_children) == ("browser", "lynx", b"k" * 32, True)


def test_updates_keep_epochs_apart(spark):
    store = tables(spark)
    put(store, 0, as_changes(recovered(spark, [(60, 3, "a", "1", None, 20, True), (60, 4, "a", "1", None, 40, True)])))
    put(store, 1, as_changes(recovered(spark, [(60, 3, "a", "1", None, 5, True), (60, 4, "a", "1", None, 5, True)])))
    assert counts(store.recovered()) == {(3, tag(60)): 25, (4, tag(60)): 45}


def test_uncommitted_batch_is_invisible_and_overwritten(spark):
    store = tables(spark)
    put(store, 0, as_changes(recovered(spark, ROWS)))
    store.write("recovered", 1, as_changes(recovered(spark, [(5, 8, "browser", "lynx", None, 100, True)])))
    assert counts(store.recovered())[8, tag(5)] == 6
    put(store, 1, as_changes(recovered(spark, [(5, 8, "browser", "lynx", None, 1, True)])), next_offsets={0: 7})
    assert counts(store.recovered())[8, tag(5)] == 7
    assert store.progress().next_offsets == {0: 7}


def test_purge_and_compaction(spark):
    store = tables(spark)
    put(store, 0, as_changes(recovered(spark, ROWS)), next_offsets={0: 3, 1: 4})
    store.purge([8])
    assert counts(store.recovered()) == {(9, tag(5)): 14}
    put(store, 2, as_changes(recovered(spark, [(5, 8, "browser", "lynx", None, 4, True)])), next_offsets={1: 9})
    before = counts(store.recovered())
    assert before == {(9, tag(5)): 14, (8, tag(5)): 4}
    store.compact()
    assert store.progress().batches == [3]
    assert counts(store.recovered()) == before
    assert store.progress().next_offsets == {0: 3, 1: 9}


def test_children_by_parent(spark):
    rows = recovered(
        spark, [(51, 2, "a", "1", None, 3, True), (52, 2, "b", "1", 51, 3, True), (53, 2, "c", "1", 52, 3, False)]
    )
    got = {r.parent_tag and bytes(r.parent_tag): bytes(r.tag) for r in state.children(rows).collect()}
    assert got == {None: tag(51), tag(51): tag(52), tag(52): tag(53)}


def test_one_row_per_tag_with_the_smallest_parent(spark):
    first = recovered(spark, [(9, 1, "a", "1", None, 1, True), (7, 1, "b", "1", 9, 2, False)])
    other = recovered(spark, [(8, 1, "a", "2", None, 1, True), (7, 1, "b", "1", 8, 3, True)])
    both = state.current_recovered(as_changes(first).unionByName(as_changes(other)))
    row = both.filter(F.col("tag") == F.lit(tag(7))).collect()
    assert len(row) == 1 and bytes(row[0].parent_tag) == tag(8) and row[0]["count"] == 5 and row[0].has_children


def test_first_batch_fixes_children_on_request(spark):
    leaf = as_changes(recovered(spark, [(7, 1, "a", "1", None, 2, False)])).withColumn("batch", F.lit(0).cast("bigint"))
    inner = as_changes(recovered(spark, [(7, 1, "a", "1", None, 2, True)])).withColumn("batch", F.lit(1).cast("bigint"))
    both = leaf.unionByName(inner)
    assert state.current_recovered(both, fixed_children=True).first().has_children is False
    assert state.current_recovered(both).first().has_children is True


def test_fixed_children_survive_reports_and_compaction(spark):
    """A row that only takes a reported count away has no say, neither before nor after a compaction."""
    store = tables(spark)
    leaf = as_changes(recovered(spark, [(7, 1, "a", "1", None, 4, False)]))
    taken = leaf.select("epoch", "tag", F.lit(-4).cast("bigint").alias("change"))
    put(store, 0, leaf.unionByName(taken, allowMissingColumns=True))
    put(store, 1, as_changes(recovered(spark, [(7, 1, "a", "1", None, 2, True)])))
    row = store.recovered(fixed_children=True).first()
    assert (row["count"], row.has_children) == (2, False)
    store.compact(fixed_children=True)
    row = store.recovered(fixed_children=True).first()
    assert (row["count"], row.has_children) == (2, False)


def stored(store, table="recovered"):
    return {(r.batch, r.epoch, bytes(r.tag)) for r in store.stored(table).select("batch", "epoch", "tag").collect()}


def test_vacuum_deletes_purged_epochs_only(spark):
    store = tables(spark)
    assert store.vacuum() == 0 and store.stored("recovered").count() == 0
    put(store, 0, as_changes(recovered(spark, ROWS)), next_offsets={0: 3})
    store.purge([8])
    put(store, 2, as_changes(recovered(spark, [(5, 8, "browser", "lynx", None, 4, True)])))
    before = counts(store.recovered())
    assert stored(store) == {(0, 8, tag(5)), (0, 8, tag(6)), (0, 9, tag(5)), (2, 8, tag(5))}
    assert store.vacuum(grace_seconds=3600) == 0 and len(stored(store)) == 4  # readers that started earlier can finish
    assert store.vacuum() == 1 and store.vacuum() == 0
    assert stored(store) == {(0, 9, tag(5)), (2, 8, tag(5))}
    assert counts(store.recovered()) == before and store.progress().next_offsets == {0: 3}


def test_vacuum_keeps_the_base_and_uncommitted_batches(spark):
    store = tables(spark)
    put(store, 0, as_changes(recovered(spark, ROWS)))
    put(store, 1, as_changes(recovered(spark, [(5, 9, "browser", "lynx", None, 1, True)])))
    base = store.compact()
    reader = store.recovered()  # named by the base before anything is deleted
    store.write("recovered", base + 1, as_changes(recovered(spark, [(6, 9, "browser", "w3m", None, 2, False)])))
    before = counts(store.recovered())
    assert store.vacuum() == 4  # two tables, two batches
    assert {batch for batch, *_ in stored(store)} == {base, base + 1}
    assert counts(reader) == counts(store.recovered()) == before
    store.write_nothing("pending", base + 1)
    store.commit(base + 1)
    assert counts(store.recovered())[9, tag(6)] == 2


def test_compaction_and_vacuum_delete_opened_messages(spark):
    store = tables(spark)
    rows = [(8, tag(5), ["a|1"], 1, 20, 3), (8, tag(7), ["a|2"], 1, 20, 2), (9, tag(5), ["a|1"], 1, 20, 1)]
    names = {"epoch": "SMALLINT", "tag": "BINARY", "layers": "ARRAY<STRING>", "depth": "INT", "threshold": "INT", "n": "BIGINT"}
    waiting = spark.createDataFrame(rows, ", ".join(map(" ".join, names.items()))).to(store.read("pending").drop("batch").schema)
    store.write("pending", 0, waiting)
    store.write("recovered", 0, as_changes(recovered(spark, [])))
    store.commit(0)
    put(store, 1, as_changes(recovered(spark, [(5, 8, "a", "1", None, 3, False)])))
    assert stored(store, "pending") == {(0, 8, tag(5)), (0, 8, tag(7)), (0, 9, tag(5))}
    base = store.compact()
    store.vacuum()
    assert stored(store, "pending") == {(base, 8, tag(7)), (base, 9, tag(5))}
