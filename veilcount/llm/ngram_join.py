"""N-gram Jaccard join: near duplicates by rare-first prefix filtering on word shingles.

A document's set holds the hashes of its distinct shingles; equal sets are one entry from the start. The shingles of all
documents are counted in a table of fixed size, and every set is put in the order rarest first. Two sets that are similar
enough share a shingle among the first few of this order, so only these few are shuffled, by shingle. Where several sets
meet at a shingle, candidate pairs must pass

- the length filter: the smaller set is large enough for the larger one,
- the positional filter: the places of the shared shingle leave enough shingles behind it,
- the suffix filter, once the sets are there: both are cut at fixed hash values, and the parts' smaller sizes must add up,

and are then verified, each pair once, on the whole sets.

Pairs are not listed within large meetings. In a round a meeting whose unconnected pairs are few, for its size, lists
them and is done; a larger one names a few pivots by a hash, and its sets are paired with these only. Sets that end up in
one component need no further link between them, so the next round looks at meetings of sets from different components,
with other pivots. After the last round all pairs that are left are listed. So every pair of similar sets is verified or
already connected: components are exact, and a group of copies costs a few pairs for each of its members.

Shingles and sets are told apart by 64-bit hashes.
"""

from __future__ import annotations

from collections import OrderedDict

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from veilcount.llm.components import components
from veilcount.llm.texts import blank_words, small_batches, utf8
from veilcount.session import new_work_folder

WORDS = 5
PERCENT = 80
#: Counters of the table of shingle counts: two million, one byte each when they are sent around as levels.
SLOT_BITS = 21
#: Pivots of a meeting in one round; pairs for each of its sets up to which it lists them all.
PIVOTS = 8
#: Rounds with pivots, after which what is left is listed.
ROUNDS = 2
#: Bits of the map of candidate sets, which only spares work: what passes it by chance finds no pair.
CANDIDATE_BITS = 25
#: Word hashes that a worker remembers.
_REMEMBERED = 200_000

_ODD = np.uint64(0x9E3779B97F4A7C15)  # fixed value: odd multipliers that spread hashes
_ODD2 = np.uint64(0xBF58476D1CE4E5B9)


class _WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) >= _REMEMBERED:
            self.clear()
        found = self[word] = xxhash.xxh3_64_intdigest(word)
        return found


def shingle_set(text: bytes | None, hashes: dict, words: int = WORDS) -> np.ndarray:
    """The sorted distinct shingle hashes of a text; a shorter text is one shingle, one without words none."""
    found = blank_words(text)
    if not found:
        return np.zeros(0, np.uint64)
    values = np.fromiter(map(hashes.__getitem__, found), np.uint64, len(found))
    size = min(words, len(values))
    count = len(values) - size + 1
    total = np.full(count, size, np.uint64)
    for offset in range(size):
        total = (total ^ values[offset : offset + count]) * _ODD
        total ^= total >> np.uint64(32)
    return np.unique(total * _ODD2)


def set_id(shingles: np.ndarray) -> int:
    """A signed 64-bit name of a set."""
    return xxhash.xxh3_64_intdigest(shingles.tobytes()) - (1 << 63)


def needed(size: np.ndarray, other: np.ndarray, percent: int) -> np.ndarray:
    """The overlap from which on two sets of these sizes are similar: (100 + p) * overlap >= p * (size + other)."""
    return -(-percent * (size + other) // (100 + percent))


def prefix_size(size, percent: int):
    """How many of the first shingles must be looked at: a partner holds at least p percent of the set."""
    return size - -(-percent * size // 100) + 1


# -- first pass: sizes, names and counts ---------------------------------------------------------------------------

_SIZES = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("size", T.LongType()),
        T.StructField("set_id", T.LongType()),
        T.StructField("counts", T.BinaryType()),
    ]
)


def _measure(words: int):
    def run(batches):
        hashes, counts = _WordHashes(), np.zeros(1 << SLOT_BITS, np.uint32)
        for batch in small_batches(batches):
            sizes, names, parts = [], [], []
            for text in utf8(batch, "text"):
                shingles = shingle_set(text, hashes, words)
                sizes.append(len(shingles))
                names.append(set_id(shingles) if len(shingles) else None)
                parts.append(shingles)
            slots = (np.concatenate(parts) >> np.uint64(64 - SLOT_BITS)).astype(np.int64) if parts else []
            np.add.at(counts, slots, 1)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(batch.schema.get_field_index("doc_id")),
                    pa.array(sizes, pa.int64()),
                    pa.array(names, pa.int64()),
                    pa.nulls(len(sizes), pa.binary()),
                ],
                ["doc_id", "size", "set_id", "counts"],
            )
        if counts.any():
            packed = zstandard.ZstdCompressor(level=1).compress(counts.tobytes())
            none = pa.array([None], pa.int64())
            yield pa.RecordBatch.from_arrays([none, none, none, pa.array([packed])], ["doc_id", "size", "set_id", "counts"])

    return run


def _merged(frame: DataFrame, column: str, merge) -> np.ndarray | None:
    """The packed arrays of a column, merged in a tree of tasks; one array of fixed size reaches the driver."""

    def unpacked(packed: bytes) -> np.ndarray:
        return np.frombuffer(zstandard.ZstdDecompressor().decompress(packed), np.uint32).copy()

    def packed(values: np.ndarray) -> bytes:
        return zstandard.ZstdCompressor(level=1).compress(values.tobytes())

    def one(rows):
        total = None
        for row in rows:
            total = unpacked(row[0]) if total is None else merge(total, unpacked(row[0]))
        return [] if total is None else [packed(total)]

    def two(left, right):  # the driver receives several of these at once
        return right if left is None else left if right is None else packed(merge(unpacked(left), unpacked(right)))

    found = frame.where(F.col(column).isNotNull()).select(column).rdd.mapPartitions(one).treeAggregate(None, two, two, depth=3)
    return None if found is None else unpacked(found)


# -- second pass: the rare-first prefixes --------------------------------------------------------------------------

_PREFIX = "shingle long, set_id long, size int, place int"


def _prefixes(levels: np.ndarray, words: int, percent: int):
    def run(batches):
        hashes, seen = _WordHashes(), set()
        for batch in small_batches(batches):
            columns = [[], [], [], []]
            for text in utf8(batch, "text"):
                shingles = shingle_set(text, hashes, words)
                if not len(shingles) or (name := set_id(shingles)) in seen:
                    continue
                seen.add(name)
                level = levels[(shingles >> np.uint64(64 - SLOT_BITS)).astype(np.int64)]
                count = prefix_size(len(shingles), percent)
                first = shingles[np.argsort(level, kind="stable")[:count]]  # by level, then by hash
                columns[0].append(first.view(np.int64))
                columns[1].append(np.full(count, name, np.int64))
                columns[2].append(np.full(count, len(shingles), np.int32))
                columns[3].append(np.arange(count, dtype=np.int32))
            if columns[0]:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(column)) for column in columns], ["shingle", "set_id", "size", "place"]
                )

    return run


# -- meetings: pairs, and the rows of meetings that are not done -----------------------------------------------------

_MET = "pair boolean, shingle long, a long, b long, size int, place int"


def _salt(turn: int) -> np.int64:
    """Names are hashes, so their order after an exclusive or with this is another one in each round."""
    return (np.full(1, turn + 1, np.uint64) * _ODD2).view(np.int64)[0]


def _passes(size_a, place_a, size_b, place_b, percent: int):
    """Length and positional filter: if this is the first shared shingle, enough must be left from here on."""
    left = np.minimum(size_a - place_a, size_b - place_b)
    shorter, longer = np.minimum(size_a, size_b), np.maximum(size_a, size_b)
    return (100 * shorter >= percent * longer) & (left >= needed(size_a, size_b, percent))


def _pairs_of(names, sizes, places, groups, turn: int, percent: int):
    """Pairs (i, j) of one meeting, and whether it is done with them. groups: the sets' components."""
    count = len(names)
    _, of_group = np.unique(groups, return_counts=True)
    done = (count * count - int((of_group * of_group).sum())) // 2 <= PIVOTS * count
    if done:
        i, j = np.triu_indices(count, 1)
    else:
        pivots = np.argsort(names ^ _salt(turn))[:PIVOTS]
        i, j = (found.ravel() for found in np.meshgrid(np.arange(count), pivots))
    good = (groups[i] != groups[j]) & _passes(sizes[i], places[i], sizes[j], places[j], percent)
    return i[good], j[good], done


def _meet(percent: int, turn: int):
    """From rows shingle, set_id, size, place and component, sorted by shingle and set."""

    def meetings(shingle, name, size, place, group):
        new = np.ones(len(shingle), bool)
        new[1:] = (shingle[1:] != shingle[:-1]) | (name[1:] != name[:-1])  # copies from several partitions
        shingle, name, size, place, group = (column[new] for column in (shingle, name, size, place, group))
        starts = np.flatnonzero(np.r_[True, shingle[1:] != shingle[:-1]])
        ends = np.r_[starts[1:], len(shingle)]
        # Most meetings are of two sets: one pair each, all at once.
        i = starts[ends - starts == 2]
        j = i + 1
        i = i[(group[i] != group[j]) & _passes(size[i], place[i], size[j], place[j], percent)]
        j = i + 1
        nothing = np.zeros(len(i), np.int32)
        low, high = np.minimum(name[i], name[j]), np.maximum(name[i], name[j])
        found = [(np.ones(len(i), bool), nothing.astype(np.int64), low, high, nothing, nothing)] if len(i) else []
        larger = ends - starts > 2
        for start, end in zip(starts[larger], ends[larger]):
            names, sizes, places = name[start:end], size[start:end], place[start:end]
            i, j, done = _pairs_of(names, sizes, places, group[start:end], turn, percent)
            if len(i):
                nothing = np.zeros(len(i), np.int32)
                low, high = np.minimum(names[i], names[j]), np.maximum(names[i], names[j])
                found.append((np.ones(len(i), bool), nothing.astype(np.int64), low, high, nothing, nothing))
            if not done:
                found.append((np.zeros(end - start, bool), shingle[start:end], names, names, sizes, places))
        return [np.concatenate(column) for column in zip(*found)] if found else None

    def run(batches):
        kept = None
        names = ["pair", "shingle", "a", "b", "size", "place"]

        def out(rows):
            found = meetings(*rows)
            if found is not None:
                yield pa.RecordBatch.from_arrays([pa.array(column) for column in found], names)

        for batch in batches:
            rows = [batch.column(at).to_numpy() for at in range(5)]
            if kept is not None:
                rows = [np.concatenate(pair) for pair in zip(kept, rows)]
            last = np.searchsorted(rows[0], rows[0][-1]) if len(rows[0]) else 0  # the last shingle may go on
            if last:
                yield from out([column[:last] for column in rows])
            kept = [column[last:] for column in rows]
        if kept is not None and len(kept[0]):
            yield from out(kept)

    return run


def _met(rows: DataFrame, percent: int, turn: int) -> DataFrame:
    wanted = rows.select("shingle", "set_id", "size", "place", "component")
    return wanted.repartition("shingle").sortWithinPartitions("shingle", "set_id").mapInArrow(_meet(percent, turn), _MET)


# -- candidate sets and verification ---------------------------------------------------------------------------------


def _marks(batches):
    bits = np.zeros(1 << (CANDIDATE_BITS - 5), np.uint32)
    for batch in batches:
        place = (batch.column(0).to_numpy().view(np.uint64) * _ODD) >> np.uint64(64 - CANDIDATE_BITS)
        np.bitwise_or.at(bits, (place >> np.uint64(5)).astype(np.int64), np.uint32(1) << (place & np.uint64(31)).astype(np.uint32))
    if bits.any():
        yield pa.RecordBatch.from_arrays([pa.array([zstandard.ZstdCompressor(level=1).compress(bits.tobytes())])], ["bits"])


_SETS = "set_id long, packed binary"


def _candidate_sets(bits: np.ndarray, words: int):
    def run(batches):
        hashes, seen, pack = _WordHashes(), set(), zstandard.ZstdCompressor(level=3).compress
        for batch in small_batches(batches):
            names, sets = [], []
            for text in utf8(batch, "text"):
                shingles = shingle_set(text, hashes, words)
                if not len(shingles) or (name := set_id(shingles)) in seen:
                    continue
                place = int((np.array([name], np.int64).view(np.uint64) * _ODD)[0] >> np.uint64(64 - CANDIDATE_BITS))
                if int(bits[place >> 5]) >> (place & 31) & 1:
                    seen.add(name)
                    names.append(name)
                    sets.append(pack(b" ".join(blank_words(text))))  # a third of the size of the hashes
            if names:
                yield pa.RecordBatch.from_arrays([pa.array(names, pa.int64()), pa.array(sets, pa.binary())], ["set_id", "packed"])

    return run


_CUTS = (np.arange(1, 32, dtype=np.uint64) << np.uint64(59)).astype(np.uint64)


def similar(one: np.ndarray, other: np.ndarray, percent: int) -> bool:
    """Suffix filter, then the exact overlap of two sorted sets."""
    least = needed(len(one), len(other), percent)
    parts = [np.diff(np.r_[0, np.searchsorted(found, _CUTS), len(found)]) for found in (one, other)]
    if np.minimum(*parts).sum() < least:
        return False
    at = np.searchsorted(other, one)
    at[at == len(other)] = 0
    return int((other[at] == one).sum()) >= least


class _Unpacked(OrderedDict):
    """Sets of packed words; the latest few are kept, as pairs of one set come one after another."""

    def __init__(self, words: int):
        super().__init__()
        self.words, self.hashes, self.unpack = words, _WordHashes(), zstandard.ZstdDecompressor().decompress

    def of(self, name: int, packed: bytes) -> np.ndarray:
        if name not in self:
            self[name] = shingle_set(self.unpack(packed), self.hashes, self.words)
            if len(self) > 64:
                self.popitem(last=False)
        return self[name]


def _verify(words: int, percent: int):
    def run(batches):
        sets = _Unpacked(words)
        for batch in small_batches(batches, 256):
            rows = zip(*(batch.column(at).to_pylist() for at in range(4)))
            good = [similar(sets.of(a, of_a), sets.of(b, of_b), percent) for a, b, of_a, of_b in rows]
            yield pa.RecordBatch.from_arrays(
                [column.filter(pa.array(good, pa.bool_())) for column in (batch.column(0), batch.column(1))], ["a", "b"]
            )

    return run


def _verified(pairs: DataFrame, sets: DataFrame, words: int, percent: int) -> DataFrame:
    """The pairs (a, b) whose whole sets are similar."""
    left = sets.select(F.col("set_id").alias("a"), F.col("packed").alias("of_a"))
    right = sets.select(F.col("set_id").alias("b"), F.col("packed").alias("of_b"))
    both = pairs.join(right, "b").join(left, "a").select("a", "b", "of_a", "of_b")
    return both.mapInArrow(_verify(words, percent), "a long, b long")


def _stars(links: DataFrame, turn: int) -> DataFrame:
    """Links with the same components, about one for each set: a set keeps the link to the first of its partners that stand
    before it in the order of pivots, and that one is linked once with each of the others.

    The sets of a meeting are linked with its pivots, which stand before them, so what is left are the sets' links with one
    pivot and the links among pivots.
    """
    order = lambda name: F.col(name).bitwiseXOR(F.lit(int(_salt(turn))))
    swap = order("a") < order("b")
    towards = links.select(F.when(swap, F.col("b")).otherwise(F.col("a")).alias("of"), F.when(swap, F.col("a")).otherwise(F.col("b")).alias("to"))
    first = towards.groupBy("of").agg(F.min_by("to", order("to")).alias("star"))
    among = towards.join(first, "of").where("to != star").select(F.least("star", "to").alias("a"), F.greatest("star", "to").alias("b"))
    kept = first.select(F.least("of", "star").alias("a"), F.greatest("of", "star").alias("b"))
    return kept.union(among).distinct()


# -- the operator ----------------------------------------------------------------------------------------------------


def similar_groups(documents: DataFrame, words: int = WORDS, percent: int = PERCENT) -> tuple[DataFrame, DataFrame]:
    """Written tables: doc_id, size and set_id of every row of `documents`, and set_id and component_id of every set.

    component_id is the smallest doc_id reachable by links from a set, its own documents included.
    """
    spark = documents.sparkSession
    folder = new_work_folder(spark, "ngram-join")
    texts = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text")

    def written(frame: DataFrame, name: str) -> DataFrame:
        frame.write.parquet(f"{folder}/{name}")
        return spark.read.parquet(f"{folder}/{name}")

    measured = written(texts.mapInArrow(_measure(words), _SIZES), "measured")
    rows = measured.where(F.col("counts").isNull()).select("doc_id", "size", "set_id")
    named = rows.where(F.col("doc_id").isNotNull() & F.col("set_id").isNotNull())
    smallest = named.groupBy("set_id").agg(F.min("doc_id").alias("doc_id"))
    counts = _merged(measured, "counts", lambda left, right: np.add(left, right, out=left))
    if counts is None:
        return rows, smallest.select("set_id", F.col("doc_id").alias("component_id"))
    levels = np.round(8 * np.log2(counts.astype(np.float32) + 1)).astype(np.uint8)  # rare-first: an eighth of an octave

    known = texts.where(F.col("doc_id").isNotNull())
    prefixes = known.mapInArrow(_prefixes(levels, words, percent), _PREFIX).withColumn("component", F.col("set_id"))
    met = written(_met(prefixes, percent, 0), "met0")
    pairs = written(met.where("pair").select("a", "b").distinct(), "pairs0")
    waiting = met.where(~F.col("pair")).select("shingle", F.col("a").alias("set_id"), "size", "place")
    candidates = pairs.select("a").union(pairs.select("b")).union(waiting.select("set_id")).distinct()
    bits = _merged(candidates.mapInArrow(_marks, "bits binary"), "bits", lambda left, right: np.bitwise_or(left, right, out=left))
    if bits is None:
        return rows, smallest.select("set_id", F.col("doc_id").alias("component_id"))
    sets = written(known.mapInArrow(_candidate_sets(bits, words), _SETS).dropDuplicates(["set_id"]), "sets")
    links = written(_verified(pairs, sets, words, percent), "links0")
    links = written(_stars(links, 0), "stars0")
    joined, seen = components(links), pairs
    for turn in range(1, ROUNDS + 2):
        labelled = waiting.join(joined, waiting.set_id == joined.node, "left").select(
            "shingle", "set_id", "size", "place", F.coalesce("component", "set_id").alias("component")
        )
        labelled = written(labelled, f"labelled{turn}")
        apart = labelled.groupBy("shingle").agg(F.min("component").alias("low"), F.max("component").alias("high")).where("low != high")
        left = labelled.join(apart.select("shingle"), "shingle", "left_semi")
        if turn <= ROUNDS:
            met = written(_met(left, percent, turn), f"met{turn}")
            found = met.where("pair").select("a", "b")
            waiting = met.where(~F.col("pair")).select("shingle", F.col("a").alias("set_id"), "size", "place")
        else:
            found = _all_pairs(left, percent)
        pairs = written(found.distinct().join(seen, ["a", "b"], "left_anti"), f"pairs{turn}")
        more = written(_verified(pairs, sets, words, percent), f"links{turn}")
        if not more.isEmpty():
            links = links.union(written(_stars(more, turn), f"stars{turn}"))
            joined = components(links)
        seen = seen.union(pairs)
        if turn <= ROUNDS and waiting.isEmpty():
            break
    group = smallest.join(joined, smallest.set_id == joined.node, "left").select(
        "set_id", "doc_id", F.coalesce("component", "set_id").alias("component")
    )
    group = written(group, "groups")
    least = group.groupBy("component").agg(F.min("doc_id").alias("component_id"))
    return rows, group.join(least, "component").select("set_id", "component_id")


def _all_pairs(rows: DataFrame, percent: int) -> DataFrame:
    """Every pair of different components at its first shingle here that passes the length and the positional filter.

    A pair that also shares a shingle whose meeting is done was listed there, so the first one left is enough.
    """
    in_order = F.array_sort(F.collect_list(F.struct("place", "shingle")))
    lists = rows.groupBy("set_id").agg(F.transform(in_order, lambda item: item["shingle"]).alias("open"))
    listed = rows.join(lists, "set_id")
    one, other = listed.alias("x"), listed.alias("y")
    left = F.least(F.col("x.size") - F.col("x.place"), F.col("y.size") - F.col("y.place"))
    on = (
        (F.col("x.shingle") == F.col("y.shingle"))
        & (F.col("x.set_id") < F.col("y.set_id"))
        & (F.col("x.component") != F.col("y.component"))
        & (100 * F.least("x.size", "y.size") >= percent * F.greatest("x.size", "y.size"))
        & ((100 + percent) * left >= percent * (F.col("x.size") + F.col("y.size")))
        & (F.get(F.array_intersect("x.open", "y.open"), F.lit(0)) == F.col("x.shingle"))
    )
    return one.join(other, on).select(F.col("x.set_id").alias("a"), F.col("y.set_id").alias("b"))


def report(documents: DataFrame, words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """doc_id, n_shingles and component_id of every row of `documents` (doc_id, text; other columns are ignored).

    Null and empty texts have no shingles and are linked with nothing: their component is their own doc_id. A row with a
    null doc_id takes no part in links, its component is null. Repeated rows and equal texts are in one component.
    """
    rows, groups = similar_groups(documents, words, percent)
    joined = rows.join(groups, "set_id", "left")
    own = F.when(F.col("doc_id").isNotNull() & (F.col("size") > 0), F.col("component_id")).otherwise(F.col("doc_id"))
    return joined.select("doc_id", F.col("size").alias("n_shingles"), own.alias("component_id"))


def one_of_each_group(documents: DataFrame, words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """`documents` without near duplicates: of each component the row whose doc_id is the component's stays.

    All columns stay as they are. Rows without shingles or without doc_id all stay; of repeated rows of one doc_id and set
    one stays.
    """
    rows, groups = similar_groups(documents, words, percent)
    decided = rows.where("doc_id is not null and size > 0").join(groups, "set_id")
    gone = decided.where("doc_id != component_id").select("doc_id", "set_id").distinct()
    repeated = decided.groupBy("doc_id", "set_id").count().where("count > 1")
    name = "_set_id"
    while name in documents.columns:
        name += "_"
    tagged = T.StructType([*documents.schema.fields, T.StructField(name, T.LongType())])

    def tag(batches):
        hashes = _WordHashes()
        for batch in small_batches(batches):
            sets = [shingle_set(text, hashes, words) for text in utf8(batch, "text")]
            names = pa.array([set_id(found) if len(found) else None for found in sets], pa.int64())
            yield pa.RecordBatch.from_arrays([*batch.columns, names], [*batch.schema.names, name])

    frame = documents.mapInArrow(tag, tagged)
    same = (frame["doc_id"] == gone["doc_id"]) & (frame[name] == gone["set_id"])
    kept = frame.join(gone, same, "left_anti")
    if not repeated.isEmpty():
        nameable = F.col("doc_id").isNotNull() & F.col(name).isNotNull()
        kept = kept.where(nameable).dropDuplicates(["doc_id", name]).union(kept.where(~nameable))
    return kept.drop(name)
