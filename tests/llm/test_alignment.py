"""Cross-tokenizer alignment against plain Python loops over the tokenizers' own libraries."""

import hashlib
import random
from collections import Counter, defaultdict
from pathlib import Path

import numpy as np
import pytest
import sentencepiece
from tokenizers import Tokenizer

from veilcount.llm import alignment

SCHEMA = "doc_id long, text string, n_a string, block long, pair int"


@pytest.fixture(scope="module")
def libraries():
    a = Tokenizer.from_file(f"{alignment.FOLDER}/{alignment.BYTE_BPE}")
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=f"{alignment.FOLDER}/{alignment.PIECES}")


def plain_bytes(code: int) -> str:
    """The letter that stands for a byte in a byte-level vocabulary."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    return chr(code) if code in printable else chr(256 + [c for c in range(256) if c not in printable].index(code))


def plain(texts, libraries):
    """Figures of each text by loops over tokens and bytes."""
    a, b = libraries
    code_of = {plain_bytes(code): code for code in range(256)}
    groups_of = []
    for text in texts:
        groups_of.append([])
        if not text:
            continue
        wanted = (" " + text).encode()
        a_ids = a.encode(" " + text, add_special_tokens=False).ids
        a_parts = [bytes(code_of[c] for c in a.id_to_token(i)) for i in a_ids]
        b_ids = b.encode(text)
        b_parts = [bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode() for i in b_ids]
        if b"".join(a_parts) != wanted or b"".join(b_parts) != wanted:
            continue
        ends = [set(), set()]
        for side, parts in enumerate((a_parts, b_parts)):
            at = 0
            for part in parts:
                at += len(part)
                ends[side].add(at)
        group, at = ([], []), [0, 0]
        todo = [list(zip(a_ids, a_parts)), list(zip(b_ids, b_parts))]
        while todo[0] or todo[1]:
            side = 0 if at[0] <= at[1] and todo[0] else 1
            number, part = todo[side].pop(0)
            at[side] += len(part)
            group[side].append(number)
            if at[0] == at[1] and at[0] in ends[0] & ends[1]:
                groups_of[-1].append(group)
                group = ([], [])
    links = [Counter((x, y) for xs, ys in groups for x in xs for y in ys) for groups in groups_of]
    held = Counter(pair for counted in links for pair in counted)
    highest = defaultdict(int)
    for (x, _), count in held.items():
        highest[x] = max(highest[x], count)
    found = []
    for groups, counted in zip(groups_of, links):
        written = ";".join(f"{','.join(map(str, xs))}|{','.join(map(str, ys))}" for xs, ys in groups)
        found.append(
            (
                sum(len(xs) for xs, _ in groups),
                sum(len(ys) for _, ys in groups),
                len(groups),
                sum(counted.values()),
                sum(times for pair, times in counted.items() if held[pair] == highest[pair[0]]),
                sum(times * held[pair] for pair, times in counted.items()),
                hashlib.sha256(written.encode()).hexdigest() if groups else "",
            )
        )
    return found, held, highest


def edge_texts():
    pick = random.Random(5)
    letters = "abcé漢 \t\n1!'sß😀 ​"
    texts = ["".join(pick.choice(letters) for _ in range(pick.randrange(1, 60))) for _ in range(60)]
    words = ["the", "tokenizer", "naïve", "don't", "2024", "...", "    ", "\n\n", "<|endoftext|>", "<s>", "</s>", "<unk>", "<0x41>"]
    texts += [" ".join(pick.choice(words) for _ in range(pick.randrange(1, 40))) for _ in range(60)]
    texts += [None, "", " ", "▁", "one ▁ two", "\x00", "a\x00b", "x" * 5000, " " * 3000, "漢字" * 800, "the same text"]
    return texts + ["the same text"] * 5


def test_alignment_equals_plain_loops(spark, libraries, monkeypatch):
    monkeypatch.setattr(alignment, "SLICE", 500)  # products in several slices
    monkeypatch.setattr(alignment, "BLOCK_BYTES", 3000)  # and several blocks
    texts = edge_texts()
    numbers = [None if at == 3 else at // 2 for at in range(len(texts))]  # a null and repeated doc_ids
    frame = spark.createDataFrame([(n, t, "x", 1, 2) for n, t in zip(numbers, texts)], SCHEMA).repartition(3)
    expected, held, highest = plain(texts, libraries)
    names = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")
    found = alignment.report(frame).collect()
    assert Counter((row.doc_id, *(row[name] for name in names)) for row in found) == Counter(
        (n, *figures) for n, figures in zip(numbers, expected)
    )
    figures, links = alignment.align_documents(frame)
    written = [row.groups for row in figures.collect()]
    assert Counter(hashlib.sha256(w.encode()).hexdigest() if w else "" for w in written) == Counter(e[-1] for e in expected)
    assert {(row.a_id, row.b_id): (row.documents, row.best) for row in links.collect()} == {
        pair: (count, count == highest[pair[0]]) for pair, count in held.items()
    }
    assert expected[texts.index("one ▁ two")][0] == 0 and sum(e[0] for e in expected) > 2000


def test_blocks_are_aligned_in_parts(monkeypatch):
    folder = Path(alignment.FOLDER)
    tokenizers = alignment.Tokenizers((folder / alignment.BYTE_BPE).read_bytes(), (folder / alignment.PIECES).read_bytes())
    texts = [*edge_texts(), None, ""]
    whole = alignment.align_block([tokenizers.encode(text) for text in texts], tokenizers)
    sizes, one_part = [], alignment.align_block
    monkeypatch.setattr(alignment, "PART_CHARS", 300)
    monkeypatch.setattr(alignment, "align_block", lambda encoded, t: sizes.append(len(encoded)) or one_part(encoded, t))
    made = alignment._aligned_parts(texts, tokenizers, hashed=False)
    assert len(sizes) > 10 and sum(sizes) == len(texts)  # no step holds the tokens of the whole block
    for name in (*alignment._FIGURES, "link_starts", "pairs", "times"):
        assert (getattr(made, name) == getattr(whole, name)).all(), name
    assert made.groups == whole.groups
    hashed = alignment._aligned_parts(texts, tokenizers, hashed=True).groups
    assert hashed == [hashlib.sha256(g).hexdigest().encode() if g else b"" for g in whole.groups]
    assert len(alignment._aligned_parts([], tokenizers, hashed=False).pairs) == 0


def test_written_rows_hold_few_entries(spark, monkeypatch):
    """Spark reads thousands of rows at once, so a row must not grow with the documents of its block, nor with a text."""
    folders, new_folder = [], alignment.new_work_folder
    monkeypatch.setattr(alignment, "new_work_folder", lambda *given: folders.append(new_folder(*given)) or folders[-1])
    pick = random.Random(7)
    long_text = " ".join("".join(pick.choices("abcdefghijklmnopqrstuvwxyz", k=7)) for _ in range(3000))
    texts = [long_text, "the same text", None, " ".join(edge_texts()[:60]), long_text[:9000]]
    figures, _ = alignment.align_documents(spark.createDataFrame([(n, t, "x", 1, 2) for n, t in enumerate(texts)], SCHEMA).coalesce(1))
    found = {row.doc_id: row for row in figures.collect()}
    rows = spark.read.parquet(f"{folders[0]}/blocks").collect()
    lists = [value for row in rows for value in row if isinstance(value, list)]
    assert max(map(len, lists)) <= 1024 and sum(r.doc_id == 0 for r in rows) > 2
    assert len(found) == len(texts) and found[0].n_links == sum(sum(r.times) for r in rows if r.doc_id == 0)
    assert sum(found[at].n_links for at in found) == sum(sum(r.times or ()) for r in rows)


def test_no_documents(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert alignment.report(empty).collect() == []
    assert alignment.report(spark.createDataFrame([(1, None, "", 0, 0)], SCHEMA)).collect()[0].groups_sha256 == ""


@pytest.mark.parametrize("slice_size", [1, 7, 1 << 20])
def test_products_equal_dense_ones(monkeypatch, slice_size):
    monkeypatch.setattr(alignment, "SLICE", slice_size)
    pick = np.random.default_rng(3)
    left, right = pick.integers(0, 3, (13, 9)), pick.integers(0, 3, (9, 11))

    def sparse(dense):
        rows, columns = np.nonzero(dense)
        return alignment.Csr(np.searchsorted(rows, np.arange(len(dense) + 1)), columns, dense[rows, columns])

    made = alignment.product(sparse(left), sparse(right), 11)
    dense = np.zeros((13, 11), int)
    for row in range(13):
        at = slice(made.starts[row], made.starts[row + 1])
        assert (np.diff(made.columns[at]) > 0).all()
        dense[row, made.columns[at]] = made.values[at]
    assert (dense == left @ right).all()


def test_overlaps_hold_every_shared_byte():
    a, b = np.array([0, 3, 4, 9, 12]), np.array([0, 2, 4, 10, 12])
    made = alignment.overlap_links(a, b)
    shared = {
        (x, y): min(a[x + 1], b[y + 1]) - max(a[x], b[y]) for x in range(4) for y in range(4) if min(a[x + 1], b[y + 1]) > max(a[x], b[y])
    }
    rows = np.repeat(np.arange(4), np.diff(made.starts))
    assert {(x, y): v for x, y, v in zip(rows.tolist(), made.columns.tolist(), made.values.tolist())} == shared
