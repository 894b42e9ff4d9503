"""Cross-tokenizer alignment: links between the tokens of two tokenizers over the same bytes, by sparse matrix products.

The tokens of a block of documents are the rows of incidence matrices over bytes, in compressed sparse rows (CSR). The
product A * B' (Gustavson: row by row, each stored entry adds a whole row of the other matrix) holds how many bytes each
pair of tokens shares: the overlap links. Where the last link of an A token ends at the same byte as the token, both
tokenizers cut, and a group ends. The matrices (document, A id) by group and group by B id multiply to the shared-group
links: how many occurrence pairs each pair of ids has in each document. Products are made in slices of rows, so that a
group of any size takes bounded memory, and occurrence pairs are counted, never listed.

How many documents hold a pair of ids linked is summed over the corpus in Spark. The counts come back to the blocks that
need them by a join on the pair, one row for each block and distinct pair.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterable
from dataclasses import dataclass
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from veilcount.llm.texts import byte_batches, small_batches
from veilcount.session import new_work_folder

#: Where the vocabulary files lie, and their names.
FOLDER, BYTE_BPE, PIECES = "/opt/tokenizers", "byte_bpe_50k.json", "piece_bpe_32k.model"
#: Entries a product makes at once.
SLICE = 1 << 18
#: Bytes of text after which a block of documents ends. A longer text is a block of its own.
BLOCK_BYTES = 4 << 20
#: Characters of text whose tokens are held at once: a block is aligned part by part. A longer text is a part of its own.
PART_CHARS = 512 << 10
#: Entries of the lists of a written row. Spark reads some thousand rows at once, whatever they hold.
ENTRIES = 1 << 10


@dataclass
class Csr:
    """Stored entries row by row: those of row i are at places starts[i] to starts[i + 1]."""

    starts: np.ndarray
    columns: np.ndarray
    values: np.ndarray


def _counted(keys: np.ndarray, weights: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct keys and how often each occurs, or the sum of its weights."""
    if not len(keys):
        return keys, np.zeros(0, np.int64)
    in_order = bool((keys[1:] >= keys[:-1]).all())
    if weights is not None:
        if not in_order:
            order = np.argsort(keys, kind="stable")
            keys, weights = keys[order], weights[order]
    elif not in_order:
        keys = np.sort(keys)
    first = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1])))
    if weights is None:
        return keys[first], np.diff(np.append(first, len(keys)))
    return keys[first], np.add.reduceat(weights, first)


def _summed(keys: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """As `_counted` with weights; the weights of one, which are nearly all, are sorted without them."""
    one = weights == 1
    if one.all():
        return _counted(keys)
    plain, rest = _counted(keys[one]), _counted(keys[~one], weights[~one])
    return _counted(np.concatenate((plain[0], rest[0])), np.concatenate((plain[1], rest[1])))


def product(left: Csr, right: Csr, n_columns: int) -> Csr:
    """left * right by Gustavson's rule, in slices of rows whose entries are bounded.

    A single row's slice has at most as many entries as the sum of the right rows it names.
    """
    widths = np.diff(right.starts)[left.columns]
    made = np.concatenate(([0], np.cumsum(widths)))  # entries before each stored entry of the left matrix
    before_row = made[left.starts]
    starts, columns, values = [np.zeros(1, np.int64)], [], []
    row, n_rows = 0, len(left.starts) - 1
    while row < n_rows:
        stop = max(row + 1, int(np.searchsorted(before_row, before_row[row] + SLICE, "right")) - 1)
        at = slice(left.starts[row], left.starts[stop])
        wide = widths[at]
        own = np.repeat(np.arange(row, stop), np.diff(left.starts[row : stop + 1]))
        place = np.arange(before_row[stop] - before_row[row]) - np.repeat(made[:-1][at] - before_row[row], wide)
        place += np.repeat(right.starts[left.columns[at]], wide)
        keys, sums = _summed(
            np.repeat(own, wide) * n_columns + right.columns[place], np.repeat(left.values[at], wide) * right.values[place]
        )
        starts.append(np.searchsorted(keys, np.arange(row + 1, stop + 1, dtype=np.int64) * n_columns) + starts[-1][-1])
        columns.append(keys % n_columns)
        values.append(sums)
        row = stop
    empty = [np.zeros(0, np.int64)]
    return Csr(np.concatenate(starts), np.concatenate(columns or empty), np.concatenate(values or empty))


class Tokenizers:
    """Both tokenizers with the bytes of each of their tokens.

    byte_json: a byte-level BPE in the tokenizers library's format, of which the vocabulary is used; ids are ranks.
    piece_model: a sentencepiece model with byte fallback that adds a space in front.
    """

    #: Fixed value: the split pattern of a byte-level pre-tokenizer that uses its regular expression.
    PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

    def __init__(self, byte_json: bytes, piece_model: bytes):
        import sentencepiece
        import tiktoken

        described = json.loads(byte_json)
        plain = {chr(code): code for code in (*range(33, 127), *range(161, 173), *range(174, 256))}
        shifted = (code for code in range(256) if chr(code) not in plain)
        byte_of = plain | {chr(256 + place): code for place, code in enumerate(shifted)}
        special = {token["id"] for token in described["added_tokens"]}
        ranks = {
            bytes(byte_of[c] for c in token): number for token, number in described["model"]["vocab"].items() if number not in special
        }
        self.a = tiktoken.Encoding("a", pat_str=self.PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.b = sentencepiece.SentencePieceProcessor(model_proto=piece_model)
        self.a_bytes = [b""] * (max(ranks.values()) + 1)
        for token, number in ranks.items():
            self.a_bytes[number] = token
        self.b_bytes = [
            bytes([int(piece[3:5], 16)]) if self.b.is_byte(number) else piece.replace("▁", " ").encode()
            for number, piece in enumerate(self.b.id_to_piece(list(range(self.b.vocab_size()))))
        ]
        self.a_widths = np.array([len(token) for token in self.a_bytes])
        self.b_widths = np.array([len(token) for token in self.b_bytes])
        #: Every id as text with the mark behind it: A ids with `,` and `|`, then B ids with `,` and `;`.
        sides = ((len(self.a_bytes), "|"), (len(self.b_bytes), ";"))
        self.id_texts = [f"{i}{mark}".encode() for n, last in sides for mark in (",", last) for i in range(n)]

    def encode(self, text: str | None) -> tuple[np.ndarray, np.ndarray]:
        """Ids of both; none for a null or empty text, or if the bytes of either side are not those of space and text."""
        none = np.zeros(0, np.int64), np.zeros(0, np.int64)
        if not text:
            return none
        spaced = " " + text
        a, b = self.a.encode_ordinary(spaced), self.b.encode(text, num_threads=1)
        wanted = spaced.encode()
        if b"".join([self.a_bytes[i] for i in a]) != wanted or b"".join([self.b_bytes[i] for i in b]) != wanted:
            return none
        return np.array(a, np.int64), np.array(b, np.int64)


def _sums(values: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Sums of the ranges between starts."""
    before = np.concatenate(([0], np.cumsum(values)))
    return before[starts[1:]] - before[starts[:-1]]


def _starts(widths) -> np.ndarray:
    return np.concatenate((np.zeros(1, np.int64), np.cumsum(widths, dtype=np.int64)))


def overlap_links(a_starts: np.ndarray, b_starts: np.ndarray) -> Csr:
    """How many bytes the tokens of both sides share, from the byte offsets at which tokens start, and the end.

    A's incidence rows are multiplied in slices of so many bytes; a slice needs only the bytes' rows of B'.
    """
    starts, columns, values = [np.zeros(1, np.int64)], [], []
    token, n_tokens, n_b = 0, len(a_starts) - 1, max(1, len(b_starts) - 1)
    while token < n_tokens:
        first = a_starts[token]
        stop = max(token + 1, int(np.searchsorted(a_starts, first + SLICE, "right")) - 1)
        places = np.arange(a_starts[stop] - first)
        ones = np.ones(len(places), np.int64)
        a_by_byte = Csr(a_starts[token : stop + 1] - first, places, ones)
        meets = slice(*np.searchsorted(b_starts, (first, a_starts[stop]), "right") - np.array((1, 0)))
        borders = np.clip(b_starts[meets.start : meets.stop + 1], first, a_starts[stop])
        b_of_byte = np.repeat(np.arange(meets.start, meets.start + len(borders) - 1), np.diff(borders))
        byte_by_b = Csr(np.arange(len(places) + 1), b_of_byte, ones)
        part = product(a_by_byte, byte_by_b, n_b)
        starts.append(part.starts[1:] + starts[-1][-1])
        columns.append(part.columns)
        values.append(part.values)
        token = stop
    empty = [np.zeros(0, np.int64)]
    return Csr(np.concatenate(starts), np.concatenate(columns or empty), np.concatenate(values or empty))


@dataclass
class Block:
    """What a block of documents holds: figures for each document, and its links by pair of ids (A id above bit 32)."""

    n_a: np.ndarray
    n_b: np.ndarray
    n_groups: np.ndarray
    n_overlaps: np.ndarray
    n_links: np.ndarray
    groups: list[bytes]
    link_starts: np.ndarray  # where each document's pairs start
    pairs: np.ndarray
    times: np.ndarray


def align_block(encoded: list[tuple[np.ndarray, np.ndarray]], tokenizers: Tokenizers) -> Block:
    """Groups and links of the documents of a block, from the ids of both sides."""
    documents, n_a_ids, n_b_ids = len(encoded), len(tokenizers.a_bytes), len(tokenizers.b_bytes)
    n_a, n_b = (np.array([len(ids[side]) for ids in encoded], np.int64) for side in (0, 1))
    a, b = (np.concatenate([np.zeros(0, np.int64), *(ids[side] for ids in encoded)]) for side in (0, 1))
    a_of, b_of = _starts(n_a), _starts(n_b)
    a_document = np.repeat(np.arange(documents), n_a)
    # Both sides hold the same bytes, one document after the other.
    a_starts, b_starts = _starts(tokenizers.a_widths[a]), _starts(tokenizers.b_widths[b])
    overlaps = overlap_links(a_starts, b_starts)

    last_link = overlaps.columns[overlaps.starts[1:] - 1]
    cuts = a_starts[1:] == b_starts[1:][last_link]
    b_cuts = np.zeros(len(b), bool)
    b_cuts[last_link[cuts]] = True
    a_group, b_group = np.cumsum(cuts) - cuts, np.cumsum(b_cuts) - b_cuts
    n_groups = int(cuts.sum())

    # Rows are the pairs (document, A id) that occur, columns groups; one sort orders and counts the entries.
    size = max(1, n_groups)
    keys, counts = _counted((a_document * n_a_ids + a) * size + a_group)
    owners, columns = np.divmod(keys, size)
    heads = np.flatnonzero(np.diff(owners, prepend=-1))
    owners = owners[heads]
    by_group = Csr(np.append(heads, len(keys)), columns, counts)
    keys, counts = _counted(b_group * n_b_ids + b)
    group_by_b = Csr(np.searchsorted(keys, np.arange(n_groups + 1) * n_b_ids), keys % n_b_ids, counts)
    links = product(by_group, group_by_b, n_b_ids)

    owner = np.repeat(owners, np.diff(links.starts))
    link_starts = links.starts[np.searchsorted(owners, np.arange(documents + 1) * n_a_ids)]
    return Block(
        n_a=n_a,
        n_b=n_b,
        n_groups=_sums(cuts, a_of),
        n_overlaps=_sums(np.diff(overlaps.starts), a_of),
        n_links=_sums(links.values, link_starts),
        groups=_written_groups(tokenizers.id_texts, (a, a_group, cuts, n_a_ids), (b, b_group, b_cuts, n_b_ids), a_of + b_of),
        link_starts=link_starts,
        pairs=((owner % n_a_ids) << 32) | links.columns,
        times=links.values,
    )


def _written_groups(table: list[bytes], a_side, b_side, document_starts: np.ndarray) -> list[bytes]:
    """Each document's groups as `a1,a2|b1;a3|b2,b3`, empty without tokens. A side: ids, groups, cuts, number of ids."""
    (a, a_group, a_cuts, n_a_ids), (b, b_group, b_cuts, n_b_ids) = a_side, b_side
    a_before, b_before = (_starts(np.bincount(group)) for group in (a_group, b_group))
    mixed = np.empty(len(a) + len(b), np.int64)  # each group's A tokens, then its B tokens
    mixed[np.arange(len(a)) + b_before[a_group]] = a + n_a_ids * a_cuts
    mixed[np.arange(len(b)) + a_before[b_group + 1]] = b + n_b_ids * b_cuts + 2 * n_a_ids
    starts = document_starts.tolist()
    return [b"".join([table[i] for i in mixed[x:y].tolist()])[:-1] for x, y in zip(starts, starts[1:])]


def _joined(parts: list[Block]) -> Block:
    """One block of the documents of its parts, in order."""
    ends = np.cumsum([0, *(len(part.pairs) for part in parts)])
    starts = [part.link_starts[:-1] + end for part, end in zip(parts, ends)]
    arrays = {name: np.concatenate([getattr(part, name) for part in parts]) for name in (*_FIGURES, "pairs", "times")}
    groups = [text for part in parts for text in part.groups]
    return Block(groups=groups, link_starts=np.concatenate([*starts, ends[-1:]]), **arrays)


def _aligned_parts(texts: Iterable[str | None], tokenizers: Tokenizers, hashed: bool) -> Block:
    """The block of the texts, aligned in parts of few characters; what is kept of a part is its figures, pairs and groups.

    `hashed` keeps the sha256 of groups in their place.
    """
    parts, encoded, held = [], [], 0

    def end_part():
        part = align_block(encoded, tokenizers)
        part.groups = [hashlib.sha256(g).hexdigest().encode() if g and hashed else g for g in part.groups]
        parts.append(part)

    for text in texts:
        encoded.append(tokenizers.encode(text))
        held += len(text or "")
        if held >= PART_CHARS:
            end_part()
            encoded, held = [], 0
    if encoded or not parts:
        end_part()
    return _joined(parts)


_FIGURES = ("n_a", "n_b", "n_groups", "n_overlaps", "n_links")
#: A block's rows: of each document one or more, the first with its figures and groups, with entries of its links; without
#: `document`, distinct pairs of the block and how many of its documents hold them.
_SCHEMA = pa.schema(
    {
        "block": pa.int64(),
        "document": pa.int32(),
        "doc_id": pa.int64(),
        **dict.fromkeys(_FIGURES, pa.int64()),
        "groups": pa.string(),
        "places": pa.list_(pa.int32()),
        "times": pa.list_(pa.int64()),
        "pairs": pa.list_(pa.int64()),
        "holders": pa.list_(pa.int64()),
    }
)
_BLOCKS = "block long, document int, doc_id long, " + "".join(f"{name} long, " for name in _FIGURES)
_BLOCKS += "groups string, places array<int>, times array<long>, pairs array<long>, holders array<long>"


def _pieces(starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ranges of entries cut into pieces of at most ENTRIES, at least one each: where pieces start, and whose they are."""
    numbers = np.maximum(1, -(-np.diff(starts) // ENTRIES))
    owners = np.repeat(np.arange(len(numbers)), numbers)
    nth = np.arange(len(owners)) - np.repeat(_starts(numbers)[:-1], numbers)
    return np.append(starts[owners] + nth * ENTRIES, starts[-1]), owners


def _rows(count: int, **columns: pa.Array) -> pa.RecordBatch:
    """So many rows of a block, null in the columns that are not given."""
    arrays = [columns[field.name] if field.name in columns else pa.nulls(count, field.type) for field in _SCHEMA]
    return pa.RecordBatch.from_arrays(arrays, schema=_SCHEMA)


def _lists(starts: np.ndarray, values: np.ndarray, kind: pa.DataType) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(starts, pa.int32()), pa.array(values, kind))


def _block_rows(number: int, doc_ids: pa.Array, made: Block) -> Iterable[pa.RecordBatch]:
    """The rows of a block in batches of a few megabytes."""
    pairs, places, holders = np.unique(made.pairs, return_inverse=True, return_counts=True)
    starts, owners = _pieces(made.link_starts)
    later = np.concatenate(([False], owners[1:] == owners[:-1]))
    figures = {name: pa.array(getattr(made, name)[owners], pa.int64(), mask=later) for name in _FIGURES}
    documents = _rows(
        len(owners),
        block=pa.array(np.full(len(owners), number), pa.int64()),
        document=pa.array(owners, pa.int32()),
        doc_id=doc_ids.take(pa.array(owners)),
        groups=pa.array([None if again else made.groups[at].decode() for at, again in zip(owners.tolist(), later.tolist())], pa.string()),
        places=_lists(starts, places, pa.int32()),
        times=_lists(starts, made.times, pa.int64()),
        **figures,
    )
    starts, owners = _pieces(np.array((0, len(pairs))))
    distinct = _rows(
        len(owners),
        block=pa.array(np.full(len(owners), number), pa.int64()),
        pairs=_lists(starts, pairs, pa.int64()),
        holders=_lists(starts, holders, pa.int64()),
    )
    yield from small_batches((documents, distinct))


def align_documents(documents: DataFrame, folder: str = FOLDER, hashed: bool = False) -> tuple[DataFrame, DataFrame]:
    """Figures of each document, and the links of the corpus.

    The first has doc_id, n_a, n_b, n_groups, n_overlaps (token pairs that share bytes), n_links, n_best, count_sum and
    groups: the groups as text, or with `hashed` its sha256, empty without tokens. The second has a_id, b_id, documents
    (how many hold the pair linked) and best (whether no pair of the A id is in more). Rows are taken as they are:
    repeated rows and null doc_ids count like others. A null or empty text, and one of which a tokenizer loses bytes,
    has no tokens. No documents give no rows.
    """
    spark = documents.sparkSession
    files = spark.sparkContext.broadcast(tuple((Path(folder) / name).read_bytes() for name in (BYTE_BPE, PIECES)))

    def blocks(batches):
        tokenizers = Tokenizers(*files.value)
        number = TaskContext.get().partitionId() << 33
        for part in byte_batches(batches, "text", BLOCK_BYTES):
            made = _aligned_parts((text.as_py() for text in part.column(1)), tokenizers, hashed)
            yield from _block_rows(number, part.column(0), made)
            number += 1

    work = new_work_folder(spark, "aligned")
    narrow = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    narrow.mapInArrow(blocks, _BLOCKS).write.parquet(f"{work}/blocks")
    written = spark.read.schema(_BLOCKS).parquet(f"{work}/blocks")

    pairs = spark.read.schema(_BLOCKS).parquet(f"{work}/blocks")  # read of its own: the block meets its pairs again below
    listed = F.explode(F.arrays_zip("pairs", "holders")).alias("held")
    held = pairs.filter("document IS NULL").select("block", listed).select("block", "held.*")
    counts = held.groupBy(F.col("pairs").alias("pair")).agg(F.sum("holders").alias("documents"))
    counts.write.parquet(f"{work}/counts")
    counts = spark.read.schema("pair long, documents long").parquet(f"{work}/counts")
    a_id = F.shiftright("pair", 32).alias("a_id")
    highest = counts.groupBy(a_id).agg(F.max("documents").alias("highest"))  # no more rows than A has ids
    links = counts.select("pair", a_id, "documents").join(F.broadcast(highest), "a_id")
    links = links.select("pair", "a_id", "documents", (F.col("documents") == F.col("highest")).alias("best"))

    def finish(block: pa.Table, found: pa.Table) -> pa.Table:
        order = np.argsort(found["pair"].to_numpy())
        documents, best = found["documents"].to_numpy()[order], found["best"].to_numpy()[order]
        places, times = (block[name].combine_chunks() for name in ("places", "times"))
        starts = _starts(pc.list_value_length(places).to_numpy())
        places, times, owners = places.flatten().to_numpy(), times.flatten().to_numpy(), block["document"].to_numpy()
        sums = {}
        for name, weights in (("n_best", best), ("count_sum", documents)):
            sums[name] = np.zeros(owners.max() + 1, np.int64)
            np.add.at(sums[name], owners, _sums(times * weights[places], starts))
        heads = block.filter(pc.is_valid(block["n_a"]))
        owners = heads["document"].to_numpy()
        return pa.table(
            {
                "doc_id": heads["doc_id"],
                **{name: heads[name] for name in _FIGURES},
                **{name: found[owners] for name, found in sums.items()},
                "groups": heads["groups"],
            }
        )

    # Each block meets the counts of its own distinct pairs: rows by block, bounded by the block.
    wanted = held.select("block", F.col("pairs").alias("pair")).join(links, "pair").select("block", "pair", "documents", "best")
    schema = ", ".join(["doc_id long", *(f"{name} long" for name in _FIGURES), "n_best long", "count_sum long", "groups string"])
    documents = written.filter("document IS NOT NULL").drop("pairs", "holders")
    figures = documents.groupBy("block").cogroup(wanted.groupBy("block")).applyInArrow(finish, schema)
    b_id = F.col("pair").bitwiseAND(F.lit((1 << 32) - 1)).alias("b_id")
    return figures, links.select("a_id", b_id, "documents", "best")


def report(documents: DataFrame, folder: str = FOLDER) -> DataFrame:
    """The figures of each document, with the sha256 of its groups."""
    figures, _ = align_documents(documents, folder, hashed=True)
    return figures.withColumnRenamed("groups", "groups_sha256")
