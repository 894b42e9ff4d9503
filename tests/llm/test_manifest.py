"""Merkle manifests against a plain recursion, with blocks of a few nodes and of the usual size."""

import hashlib
import zlib
from collections import Counter, defaultdict

import pytest

from veilcount.llm import manifest

SCHEMA = "doc_id long, source string, lang string, n_chars int, text string, place int, tree string, node string"


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def leaf(doc_id, source, lang, n_chars, text) -> str:
    return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in (doc_id, source, lang, n_chars, text)))


def climb(nodes):
    """The top of a tree, and for each leaf the (before, after) of each level."""
    ways, spots = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        for way, spot in zip(ways, spots):
            run = nodes[spot // 2 * 2 : spot // 2 * 2 + 2]
            way.append(("".join(run[: spot % 2]), "".join(run[spot % 2 + 1 :])))
        spots = [spot // 2 for spot in spots]
        nodes = [sha("".join(nodes[at : at + 2])) for at in range(0, len(nodes), 2)]
    return nodes[0], ways


def plain(rows):
    trees = defaultdict(list)
    for row in rows:
        trees[row[2]].append((row[0] is not None, row[0] or 0, leaf(*row), row))
    names = sorted(trees, key=lambda name: (name is not None, (name or "").encode()))
    tops = {}
    for name in names:
        trees[name].sort(key=lambda entry: entry[:3])
        tops[name] = climb([entry[2] for entry in trees[name]])
    root, upper = climb([tops[name][0] for name in names])
    found = []
    for name, above in zip(names, upper):
        for (*_, own, row), way in zip(trees[name], tops[name][1]):
            folded = own
            if row[0] is not None and zlib.crc32(str(row[0]).encode()) % 7 == 0 and row[3] is not None:
                folded = leaf(*row[:3], row[3] + 1, row[4])
            for before, after in way + above:
                folded = sha(before + folded + after)
            proof = sha("".join(before + after for before, after in way + above))
            found.append((row[0], own, tops[name][0], root, proof, folded, folded == root))
    return Counter(found)


def rows():
    made = [(at - 20, f"s{at % 3}", ("en", "de", "fr")[min(2, at % 9)], at, f"text é {at}") for at in range(150)]
    made += [(None, None, None, None, None), (None, None, None, None, ""), (3, "", "", 0, ""), (5, "s", "en", 1, "x")] * 2
    made += [(900, "漢", "zh", 7, "漢字 " * 2000), (901, "s", "é", None, "y"), (-7, "s", "z", 2, None)]
    return made + [(77, "s", "en", 5, "the same")] * 40


@pytest.mark.parametrize("levels", [1, 2, 10])
def test_manifest_equals_plain_recursion(spark, monkeypatch, levels):
    monkeypatch.setattr(manifest, "LEVELS", levels)
    monkeypatch.setattr(manifest, "BLOCK", 2**levels)
    frame = spark.createDataFrame([(*row, 1, "t", "n") for row in rows()], SCHEMA).repartition(5)
    found = manifest.report(frame).collect()
    assert Counter(map(tuple, found)) == plain(rows())
    assert 0 < sum(not row.verified for row in found) < len(found)


@pytest.mark.parametrize("count", [1, 2, 3])
def test_few_rows(spark, count):
    few = [(at, "s", "en", 1, "x") for at in range(count)]
    frame = spark.createDataFrame([(*row, 1, "t", "n") for row in few], SCHEMA)
    assert Counter(map(tuple, manifest.report(frame).collect())) == plain(few)
    assert manifest.report(frame.where("false")).collect() == []


def test_general_siblings_prove_a_row(spark):
    frame = spark.createDataFrame([(*row, 1, "t", "n") for row in rows()], SCHEMA)
    made = manifest.build(frame, "source", ["doc_id"], manifest.document_leaf(), ["doc_id", "text"])
    assert made.columns == ["doc_id", "text", "leaf", "subroot", "root", "siblings"]
    assert made.where(manifest.fold("leaf") != made.root).isEmpty() and made.select("root").distinct().count() == 1
