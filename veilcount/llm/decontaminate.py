"""Benchmark decontamination: a broadcast hash set of normalised test n-grams against every window of every document.

The test items become windows of ten words (a shorter item is one window). Their words get small numbers, their windows a
64-bit rolling hash; both go to the workers as one broadcast whose size is checked. A document's words are looked up in
that vocabulary, all its windows are hashed at once, windows found in the hash set are compared word by word, and the
words inside true hits are marked. Documents are read once and never shuffled.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from veilcount.llm.texts import plain_words, small_batches, utf8

#: Words of a window.
WIDTH = 10
#: Most bytes of benchmark text that are sent to the workers.
MOST_BENCHMARK_BYTES = 256 << 20

_ODD = np.uint64(0x9E3779B97F4A7C15)  # fixed value: an odd multiplier for the rolling hash
_SLOT_BITS = 20


@dataclass
class TestWindows:
    """The windows of all items, by their number of words."""

    vocabulary: dict[bytes, int]
    codes: np.ndarray
    by_width: dict[int, tuple]
    item_ids: list[str]


def _hash_windows(values: np.ndarray, width: int) -> np.ndarray:
    count = len(values) - width + 1
    total = np.zeros(max(count, 0), np.uint64)
    if count > 0:
        for offset in range(width):
            total = total * _ODD + values[offset : offset + count]
        total ^= total >> np.uint64(29)
    return total


def build_windows(items: list[tuple], width: int = WIDTH) -> TestWindows:
    """items: (item_id, text) pairs; texts that are null or without words give no window."""
    vocabulary: dict[bytes, int] = {}
    names = sorted({str(item) for item, _ in items})
    number = {name: at for at, name in enumerate(names)}
    owners: dict[int, dict[tuple, set[int]]] = {}
    for item, text in items:
        ids = [vocabulary.setdefault(word, len(vocabulary) + 1) for word in plain_words(text.encode() if text else None)]
        size = min(width, len(ids))
        for start in range(len(ids) - size + 1 if size else 0):
            owners.setdefault(size, {}).setdefault(tuple(ids[start : start + size]), set()).add(number[str(item)])
    for seed in range(1, 100):
        codes = np.random.default_rng(seed).integers(1, 2**63, len(vocabulary) + 1, dtype=np.uint64)
        by_width = {}
        for size, found in owners.items():
            rows = np.array(list(found), np.int64).reshape(len(found), size)
            hashes = np.array([_hash_windows(codes[row], size)[0] for row in rows], np.uint64)
            order = np.argsort(hashes)
            slots = np.zeros(1 << _SLOT_BITS, bool)
            slots[hashes >> np.uint64(64 - _SLOT_BITS)] = True
            by_width[size] = (hashes[order], rows[order], [sorted(found[tuple(rows[at].tolist())]) for at in order], slots)
        if all(len(np.unique(hashes)) == len(hashes) for hashes, *_ in by_width.values()):
            break  # no two test windows share a hash
    return TestWindows(vocabulary, codes, by_width, names)


def find_hits(words_of: list[list[bytes]], windows: TestWindows):
    """For each list of words: the mask of hit words, and the sorted numbers of the items found."""
    ends = np.cumsum([0] + [len(words) for words in words_of])
    look = windows.vocabulary.get
    ids = np.fromiter((look(word, 0) for words in words_of for word in words), np.int64, int(ends[-1]))
    values = windows.codes[ids]
    change = np.zeros(len(ids) + 1, np.int64)
    items: list[set[int]] = [set() for _ in words_of]
    for width, (hashes, rows, owners, slots) in windows.by_width.items():
        found = _hash_windows(values, width)
        maybe = np.flatnonzero(slots[found >> np.uint64(64 - _SLOT_BITS)])
        at = np.minimum(np.searchsorted(hashes, found[maybe]), len(hashes) - 1)
        same = hashes[at] == found[maybe]
        maybe, at = maybe[same], at[same]
        document = np.searchsorted(ends, maybe, "right") - 1
        true = maybe + width <= ends[document + 1]
        maybe, at, document = maybe[true], at[true], document[true]
        true = np.ones(len(maybe), bool)
        for offset in range(width):
            true &= ids[maybe + offset] == rows[at, offset]
        maybe, at, document = maybe[true], at[true], document[true]
        np.add.at(change, maybe, 1)
        np.add.at(change, maybe + width, -1)
        for row, window in np.unique(np.stack([document, at], 1), axis=0) if len(at) else ():
            items[row].update(owners[window])
    mask = np.cumsum(change)[: len(ids)] > 0
    return [mask[start:end] for start, end in zip(ends, ends[1:])], [sorted(found) for found in items]


def _bounded_windows(benchmark: DataFrame, width: int) -> TestWindows:
    """Spark broadcasts a function's data to the workers when it is large."""
    size = benchmark.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    if size > MOST_BENCHMARK_BYTES:
        raise ValueError(f"the benchmark holds {size} bytes; split it into parts of at most {MOST_BENCHMARK_BYTES}")
    items = [(row.item_id, row.text) for row in benchmark.select("item_id", "text").collect()]
    return build_windows(items, width)


REPORT = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("n_words", T.LongType()),
        T.StructField("n_hit", T.LongType()),
        T.StructField("items", T.ArrayType(T.StringType())),
    ]
)


def contamination(documents: DataFrame, benchmark: DataFrame, width: int = WIDTH) -> DataFrame:
    """One row per row of `documents`: its words, its words inside benchmark windows, and the items found.

    documents: doc_id, text; benchmark: item_id, text; other columns are ignored. A null or empty text has no words and
    no hits; a null doc_id stays null; repeated rows are reported each; an empty benchmark hits nothing. Items that share
    an item_id count as one; a null item_id is named None.
    """
    windows = _bounded_windows(benchmark, width)

    def scan(batches):
        for batch in small_batches(batches):
            words_of = [plain_words(text) for text in utf8(batch, "text")]
            masks, found = find_hits(words_of, windows)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(batch.schema.get_field_index("doc_id")),
                    pa.array([len(words) for words in words_of], pa.int64()),
                    pa.array([int(mask.sum()) for mask in masks], pa.int64()),
                    pa.array([[windows.item_ids[item] for item in items] for items in found], pa.list_(pa.string())),
                ],
                ["doc_id", "n_words", "n_hit", "items"],
            )

    return documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(scan, REPORT)


def clean(documents: DataFrame, benchmark: DataFrame, width: int = WIDTH) -> DataFrame:
    """The rows of `documents` that hold no benchmark window, with all their columns; the others go as a whole.

    Rows with a null or empty text are clean and stay; repeated rows stay as often as they were.
    """
    windows = _bounded_windows(benchmark, width)

    def scan(batches):
        for batch in small_batches(batches):
            masks, _ = find_hits([plain_words(text) for text in utf8(batch, "text")], windows)
            yield batch.filter(pa.array([not mask.any() for mask in masks], pa.bool_()))

    return documents.mapInArrow(scan, documents.schema)


def without_spans(documents: DataFrame, benchmark: DataFrame, width: int = WIDTH) -> DataFrame:
    """All rows of `documents`, with the hit words cut out of the text; a hit text becomes its other words, one blank apart."""
    windows = _bounded_windows(benchmark, width)

    def scan(batches):
        for batch in small_batches(batches):
            at = batch.schema.get_field_index("text")
            texts = utf8(batch, "text")
            words_of = [plain_words(text) for text in texts]
            masks, _ = find_hits(words_of, windows)
            cut = [
                (b" ".join(word for word, hit in zip(words, mask) if not hit) if mask.any() else text)
                for text, words, mask in zip(texts, words_of, masks)
            ]
            kept = pa.array([None if text is None else text.decode() for text in cut], batch.schema.field(at).type)
            yield batch.set_column(at, batch.schema.field(at), kept)

    return documents.mapInArrow(scan, documents.schema)


def report(documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    """`contamination` with the items as a count and a digest, and the verdict."""
    return contamination(documents, benchmark).select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", F.array_sort("items")), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


def reference_counts(text: str | None, items: list[tuple], width: int = WIDTH) -> tuple[int, int, str]:
    """The same by comparing every window with every place, for tests."""
    words = plain_words(text.encode() if text else None)
    hit, found = set(), set()
    for item, item_text in items:
        wanted = plain_words(item_text.encode() if item_text else None)
        size = min(width, len(wanted))
        for start in range(len(wanted) - size + 1 if size else 0):
            for place in range(len(words) - size + 1):
                if words[place : place + size] == wanted[start : start + size]:
                    hit.update(range(place, place + size))
                    found.add(str(item))
    return len(words), len(hit), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
