"""Licenses, decontamination and toxicity against plain Python, on data and on edge cases."""

import hashlib
import math
import re
import zlib

import numpy as np
import pytest
import zstandard
from pyspark.sql import functions as F

from veilcount.llm import decontaminate, licenses, toxicity

SF = "/root/testdata/sf0.01"
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


EDGES = [
    None, "", " \x00.", "Under the MIT License", "under the mit license under the mit license", "under-the_mit license", "Apache License, Version 2.0",
    "CC BY-NC-SA 4.0 and CC BY 4.0", "Licensed under the GNU General Public License, version 3.", "ÀÉ cc by nc É", "SPDX-License-Identifier: MPL-2.0",
    "all rights reserved " * 50, "cc by " * 500 + "nc",
]


def test_license_base_and_labels(spark):
    frame = spark.createDataFrame([(at, text, 0) for at, text in enumerate(EDGES)] + [(None, "cc by nc", 1)], "doc_id long, text string, score int")
    everything = frame.select("doc_id", "text").union(spark.read.parquet(f"{SF}/documents.parquet").select(F.col("doc_id") + 1000, "text"))
    texts = {row.doc_id: row.text for row in everything.collect()}
    found = licenses.report(frame).collect() + licenses.report(everything.where("doc_id >= 1000")).collect()
    assert len(found) == len(EDGES) + 1 + 1000
    for row in found:
        own, places = words(texts[row.doc_id]), []
        for phrase, label in licenses.BASE:
            wanted = phrase.split()
            places += [(at, label) for at in range(len(own)) if own[at : at + len(wanted)] == wanted]
        starts = [at for at, _ in places]
        assert (row.n_words, row.n_base) == (len(own), len(places))
        assert (row.first_word, row.last_word) == (min(starts, default=None), max(starts, default=None))
        assert row.base_labels == ",".join(sorted({label for _, label in places}))
        assert set(filter(None, row.base_labels.split(","))) <= set(row.labels.split(",")) and 0 <= row.score <= 1
    labels = {row.doc_id: row.labels for row in found}
    assert labels[7] == "cc-by,cc-by-nc,cc-by-nc-sa" and labels[8] == "gpl-3" and labels[10] == "mpl-2"


def test_contained_detections_are_suppressed():
    scanner = licenses.Scanner()
    found = scanner.detections(b"licensed under the mozilla public license version 2 0".split())
    assert [(first, end, rule.label) for first, end, rule in found] == [(0, 9, "mpl-2")]
    assert len(scanner.rules) > 300


def test_gates_never_hide_a_match():
    scanner = licenses.Scanner()
    for text in (text for text in EDGES if text):
        own = [word.encode() for word in words(text)]
        matched = {order for order, rule in enumerate(scanner.rules) if rule.pattern.search(" ".join(words(text)))}
        passed = {order for order, rule in enumerate(scanner.rules) if all(not gate.isdisjoint(own) for gate in rule.gates)}
        assert matched <= passed


ITEMS = [(1, "one two three four five six seven eight nine ten eleven"), (2, "Short item!"), (3, ""), (4, None), (5, "a"), (11, "one two three four five six seven eight nine ten"), (None, "null id here")]


def test_decontamination_equals_all_windows(spark):
    rows = [
        "x One two, three four five six seven eight nine ten eleven y", "two three four five six seven eight nine ten eleven", "short", "SHORT-item short item",
        "a b a", None, "", "one two three four five six seven eight nine", "null id here null id", "é one two three four five six seven eight nine ten " * 40,
    ]
    frame = spark.createDataFrame([(at, text, 7) for at, text in enumerate(rows)] + [(None, "a"), (3, "SHORT-item short item")][:0] , "doc_id long, text string, n_hit int")
    bench = spark.createDataFrame(ITEMS, "item_id long, text string")
    for row in decontaminate.report(frame, bench).collect():
        count, hit, digest = decontaminate.reference_counts(rows[row.doc_id], ITEMS)
        assert (row.n_words, row.n_hit, row.items_sha256, row.contaminated) == (count, hit, digest, hit > 0), row
    assert {row.doc_id for row in decontaminate.clean(frame, bench).collect()} == {2, 5, 6, 7}
    cut = {row.doc_id: row.text for row in decontaminate.without_spans(frame, bench).collect()}
    assert cut[0] == "x y" and cut[4] == "b" and cut[2] == "short" and cut[5] is None


def test_decontamination_on_data(spark):
    documents = spark.read.parquet(f"{SF}/documents.parquet").where("doc_id < 150")
    bench = spark.read.parquet(f"{SF}/benchmark.parquet")
    items = [(row.item_id, row.text) for row in bench.collect()]
    texts = {row.doc_id: row.text for row in documents.collect()}
    for row in decontaminate.report(documents, bench).collect():
        count, hit, digest = decontaminate.reference_counts(texts[row.doc_id], items)
        assert (row.n_words, row.n_hit, row.items_sha256) == (count, hit, digest)


def test_empty_tables(spark):
    documents = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    none, bench = documents.where("false"), spark.createDataFrame([], "item_id long, text string")
    assert decontaminate.report(documents, bench).first().n_hit == 0
    assert decontaminate.report(none, bench).collect() == [] and licenses.report(none).collect() == []
    labels = spark.createDataFrame([], "doc_id long, toxic int")
    assert toxicity.report(none, labels).collect() == []
    assert toxicity.report(documents, labels).first().predicted == 0


@pytest.fixture(scope="module")
def scored(spark):
    documents = spark.read.parquet(f"{SF.replace('0.01', '0.1')}/documents.parquet")
    labels = spark.read.parquet(f"{SF.replace('0.01', '0.1')}/labels.parquet")
    return toxicity.report(documents, labels).join(labels, "doc_id").toPandas()


def test_toxicity_on_held_out_rows(scored):
    assert all(row.held_out == (zlib.crc32(str(row.doc_id).encode()) % 5 == 0) for row in scored.itertuples())
    held = scored[scored.held_out]
    ranks, toxic = held.score.rank(), held.toxic == 1
    area = (ranks[toxic].sum() - toxic.sum() * (toxic.sum() + 1) / 2) / (toxic.sum() * (~toxic).sum())
    assert area > 0.9
    assert (held.predicted == (held.score >= 0.5)).all() and ((held.predicted == 1) == toxic).mean() > 0.9


def test_toxicity_edge_rows(spark):
    toxic = [f"you utter idiot number {at} what a moron and a scum bag" for at in range(80)]
    plain = [f"a quiet walk number {at} along the river on a warm day in may {at % 7}" for at in range(80)]
    model = toxicity.fit(toxic, plain * 2)
    rows = [(1, toxic[0]), (2, plain[0]), (3, None), (4, ""), (None, toxic[1]), (2, plain[0]), (5, (toxic[0] + " ") * 5_000)]
    frame = spark.createDataFrame([(*row, 9) for row in rows], "doc_id long, text string, score int")
    found = toxicity.score_documents(frame, model).collect()
    assert len(found) == len(rows) and all(0 <= row.score <= 1 for row in found)
    scores = {row.doc_id: row.score for row in found}
    assert scores[1] > 0.5 > scores[2] and scores[3] == scores[4] and scores[5] > 0.5
    kept = toxicity.without_toxic(frame, model)
    assert kept.columns == frame.columns and sorted(row.doc_id for row in kept.where("doc_id in (1, 2, 5)").collect()) == [2, 2]


def test_digest_of_no_items():
    assert decontaminate.reference_counts(None, ITEMS)[2] == hashlib.sha256(b"").hexdigest()


def test_stems_of_small_and_full_samples():
    """A word of every toxic row stands out in 20 rows against 20; one of 1.5 % of the rows does in a full sample."""
    texts = lambda count, said: [f"{'moronic' if at < said else 'lovely'} day {at}".encode() for at in range(count)]
    out = lambda toxic, plain: toxicity._standing_out((len(toxic), len(plain)), toxicity._frequent(toxicity.count_stems(toxic, plain)))
    assert out(texts(20, 20), texts(20, 0)) == ["moronic"]
    assert out(texts(40, 8), texts(2500, 0)) == ["moronic"]
    assert out(texts(20, 6), texts(20, 5)) == []
    rows = toxicity.ROWS_PER_CLASS
    assert out(texts(rows, rows * 15 // 1000), texts(rows, 0)) == ["moronic"]


def test_stems_are_counted_by_rows():
    texts = [f"abcdefgh abcd{at % 3} abcdefghijklmnop, x{at} abcdefgh".encode() for at in range(9)] + [b"abc abcdz"]
    expected = {stem: 9 for stem in ("abcde", "abcdef", "abcdefg", "abcdefgh", "abcdefghi", "abcdefghij", "abcdefghijk", "abcdefghijkl")}
    counted = toxicity.count_stems(texts, texts[:2])
    assert toxicity._frequent(counted) == {"abcd": (10, 2), **{stem: (rows, 2) for stem, rows in expected.items()}}


def test_the_fit_in_tasks_equals_the_plain_one(spark):
    """Repeated labels count once; a row labelled both ways teaches both; null labels, texts and doc_ids teach nothing."""
    toxic = [f"you utter idiot number {at} what a moron and a scum bag né" for at in range(60)]
    plain = [f"a quiet walk number {at} along the river on a warm day in may {at % 7}" for at in range(400)]
    rows = [*enumerate(toxic + plain), (None, "idiot"), (700, None), (701, ""), (5, toxic[5])]
    labels = [(at, int(at < 60)) for at in range(460)] * 2 + [(70, 1), (None, 1), (700, 1), (701, 1), (80, None), (9999, 1)]
    documents = spark.createDataFrame([(*row, 1) for row in rows], "doc_id long, text string, toxic int").repartition(3)
    model = toxicity.fit_on(documents, spark.createDataFrame([(*row, 0) for row in labels], "doc_id long, toxic int, quality int"))
    texts, learned = dict(enumerate(toxic + plain)), lambda at: zlib.crc32(str(at).encode()) % 5 != 0
    order = sorted(texts, key=lambda at: hashlib.md5(str(at).encode()).hexdigest())
    sides = [[texts[at] for at in order if learned(at) and (at, side) in labels] for side in (1, 0)]
    expected = toxicity.fit(*sides)
    assert (model.toxic, model.ordinary) == (expected.toxic, expected.ordinary) and b"moron" in model.toxic
    assert np.allclose(model.weights, expected.weights) and np.allclose(model.center, expected.center)
    frame = spark.createDataFrame([(at, text) for at, text in enumerate((toxic[0], plain[0], "", None))], "doc_id long, text string")
    scores = {row.doc_id: row.score for row in toxicity.score_documents(frame, model).collect()}
    for at, text in enumerate((toxic[0], plain[0], "", None)):
        assert abs(scores[at] - plain_score(text, model)) < 1e-9


def plain_score(text, model):
    """A text's score from its windows' compressed lengths, written out."""
    words = (text or "").lower().encode().split()
    windows = [b" ".join(words[at : at + 12]) for at in range(0, len(words), 12)] or [b""]
    lengths = []
    for content in (model.ordinary, model.toxic):
        known = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        lengths.append([len(zstandard.ZstdCompressor(level=9, dict_data=known, write_content_size=False).compress(w)) for w in windows])
    gains = [one - other for one, other in zip(*lengths)]
    above = [max(gain - 1, 0) for gain in gains]
    share = sum(gain >= 3 for gain in gains) / len(gains)
    figures = [sum(gains) / len(gains), sum(above) / len(above), max(gains), share, math.log1p(sum(above)), math.log(len(gains))]
    value = model.weights[-1]
    for figure, center, scale, weight in zip(figures, model.center, model.scale, model.weights):
        value += weight * min(3, max(-3, (figure - center) / scale))
    return 1 / (1 + math.exp(-value))


def test_license_bodies_without_names():
    clauses = {
        "isc": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that",
        "zlib": "2. Altered source versions must be plainly marked as such, and must not be misrepresented",
        "apache-2": "each Contributor hereby grants to You a perpetual, worldwide, non-exclusive, no-charge, royalty-free, irrevocable copyright",
        "gpl-2": "You may copy and distribute verbatim copies of the Program's source code as you receive it, in any medium",
        "mpl-2": 'Covered Software is provided under this License on an "as is" basis, without',
        "cc0": "Affirmer hereby overtly, fully, permanently, irrevocably and unconditionally waives, abandons",
    }
    scanner = licenses.Scanner()
    for label, text in clauses.items():
        found = scanner.detections(licenses.plain_words(text.encode()))
        assert label in {rule.label for _, _, rule in found}, text
