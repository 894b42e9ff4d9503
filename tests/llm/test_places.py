"""Sharding, mixing, the Jaccard join, nearest neighbours and the pipeline against plain Python."""

import math
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from compare import difference, oracle_connection
from veilcount.llm import components, mixing, neighbours, ngram_join, queries, shards, toxicity

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("rows", [1, 2, 3, 7, 64, 1000, 4097])
def test_feistel_is_a_permutation(rows):
    there = shards.permute(np.arange(rows), rows, "seed")
    assert sorted(there) == list(range(rows))
    assert (shards.permute(there, rows, "seed", back=True) == np.arange(rows)).all()


def test_shards(spark):
    rows = [(at % 90 if at % 7 else None, f"text é {at % 50}" if at % 11 else None, at) for at in range(1000)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, slot int").repartition(5)
    found = shards.shard_report(frame).collect()
    assert Counter((row.doc_id, row.size, row.text_crc32) for row in found) == Counter(
        (doc_id, len((text or "").encode()) + 8, zlib.crc32((text or "").encode())) for doc_id, text, _ in rows
    )
    by_shard = defaultdict(list)
    for row in found:
        by_shard[row.shard].append(row.slot)
    assert all(sorted(slots) == list(range(len(slots))) for slots in by_shard.values())
    assert sorted(by_shard) == list(range(24)) and {len(slots) for slots in by_shard.values()} <= {41, 42}
    again = shards.assign_shards(frame.repartition(2), ["doc_id", "text", "slot"]).select("doc_id", "text", "shard")
    assert sorted(map(str, again.collect())) == sorted(map(str, shards.assign_shards(frame, ["doc_id", "text", "slot"]).select("doc_id", "text", "shard").collect()))
    assert shards.shard_report(frame.where("false")).collect() == []


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_equals_sql(spark, name):
    assert difference(queries.QUERIES[name](spark, SF), oracle_connection(SF), queries.ORACLES[name]) is None


MIX = "doc_id long, text string, lang string, source string, n_tokens int, rest int"


def mix_rows():
    rows = [(at, f"word{at} " * (at % 9), "en", "big" if at % 10 else "small", 1, 2) for at in range(3000)]
    return rows + [(5, "word5 " * 5, "en", "big", 1, 2)] * 3 + [(None, None, None, None, None, None), (7, "", None, None, 0, 0), (9, "é " * 3000, None, "one", 0, 0)]


def test_mix_equals_sql_and_keeps_its_budget(spark):
    frame = spark.createDataFrame(mix_rows(), MIX)
    connection = duckdb.connect()
    connection.register("documents", frame.toPandas().astype({"doc_id": "Int64"}))
    assert difference(mixing.report(frame), connection, mixing.ORACLE) is None
    uses = mixing.mix(frame).groupBy("source").agg(F.sum("n_tokens").alias("used")).collect()
    tokens = Counter()
    for _, text, _, source, *_ in mix_rows():
        tokens[source or ""] += len((text or "").split())
    ratios = [row.used / tokens[row.source] for row in uses if tokens[row.source]]
    assert 0.99 <= min(ratios) <= 1 and max(ratios) <= mixing.REPETITION_LIMIT and max(ratios) > 1.9
    kept = mixing.mixed(frame)
    assert kept.columns == frame.columns and kept.select("doc_id").distinct().count() == 3001
    assert mixing.mixed(frame.where("false")).collect() == []


def test_mix_meets_an_entropy(spark):
    totals = spark.createDataFrame([("a", 8000, 80), ("b", 1500, 40), ("c", 500, 10)], "source string, tokens long, rows long")
    weights = [row.weight for row in mixing.plan(totals, entropy=0.9).collect()]
    assert abs(sum(weights) - 1) < 1e-6 and abs(-sum(w * math.log(w) for w in weights) - 0.9) < 1e-4


def shingles(text, size=5):
    words = (text or "").encode().lower().split()
    return {tuple(words[at : at + size]) for at in range(len(words) - size + 1)} or ({tuple(words)} if words else set())


def plain_components(rows):
    """rows: (doc_id, text); the component of each row by comparing all pairs."""
    sets = [shingles(text) for _, text in rows]
    parent = list(range(len(rows)))

    def root(at):
        while parent[at] != at:
            at = parent[at]
        return at

    for one in range(len(rows)):
        for two in range(one):
            a, b = sets[one], sets[two]
            if a and b and 100 * len(a & b) >= 80 * len(a | b):
                parent[root(one)] = root(two)
    least = defaultdict(list)
    for at, (doc_id, _) in enumerate(rows):
        least[root(at)].append(doc_id)
    return [(doc_id, len(sets[at]), min(least[root(at)]) if sets[at] else doc_id) for at, (doc_id, _) in enumerate(rows)]


def near_copies():
    rng = np.random.default_rng(3)
    word = lambda: f"w{rng.integers(0, 400)}"
    rows = []
    for group in range(12):
        base = [word() for _ in range(int(rng.integers(3, 120)))]
        for _ in range(int(rng.integers(1, 25))):
            copy = list(base)
            for _ in range(int(rng.integers(0, 4))):
                copy[int(rng.integers(0, len(copy)))] = word()
            rows.append(" ".join(copy + [word() for _ in range(int(rng.integers(0, 5)))]))
    passage = " ".join(f"p{at}" for at in range(60))
    rows += [passage + " " + " ".join(word() for _ in range(int(rng.integers(1, 30)))) for _ in range(40)]
    chain = [f"c{at}" for at in range(200)]
    rows += [" ".join(chain[at * 4 : at * 4 + 100]) for at in range(20)]  # neighbours are similar, ends are not
    rows += ["", None, "one", "ONE", "one two three", "One two  three\t", "a b c d e", "A B C D E", "a b c d f", " \n"]
    return [(int(doc_id), text) for doc_id, text in zip(rng.permutation(len(rows)), rows)]


@pytest.mark.parametrize("pivots, rounds", [(8, 8), (1, 2)])
def test_join_equals_all_pairs(spark, monkeypatch, pivots, rounds):
    monkeypatch.setattr(ngram_join, "PIVOTS", pivots)
    monkeypatch.setattr(ngram_join, "ROUNDS", rounds)
    rows = near_copies()
    rows += rows[:3]  # repeated rows
    frame = spark.createDataFrame(rows, "doc_id long, text string").withColumn("set_id", F.lit(0)).repartition(4)
    found = sorted(tuple(row) for row in ngram_join.report(frame).collect())
    assert found == sorted(plain_components(rows))


def test_join_on_data(spark):
    documents = spark.read.parquet(f"{SF}/documents.parquet")
    rows = [(row.doc_id, row.text) for row in documents.collect()]
    assert sorted(tuple(row) for row in ngram_join.report(documents).collect()) == sorted(plain_components(rows))


def test_one_of_each_group(spark):
    rows = [(3, "a b c d e f"), (1, "A b c d e f"), (1, "a b c d e f"), (2, "x"), (2, "x"), (None, "x"), (None, "x"), (4, None), (4, None), (5, "")]
    frame = spark.createDataFrame([(*row, 8) for row in rows], "doc_id long, text string, _set_id int")
    kept = ngram_join.one_of_each_group(frame)
    assert kept.columns == frame.columns
    assert sorted((row.doc_id or 0) for row in kept.collect()) == [0, 0, 1, 2, 4, 4, 5]
    assert ngram_join.report(frame.where("false")).collect() == []
    null = ngram_join.report(frame.where("doc_id is null")).collect()
    assert [(row.doc_id, row.component_id) for row in null] == [(None, None)] * 2


def test_components(spark):
    links = [(at, at + 1) for at in range(1, 40)] + [(100, 90), (90, 95), (7, 7)] + [(500, at) for at in range(501, 700)]
    found = {row.node: row.component for row in components.components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert {found[at] for at in range(1, 41)} == {1} and {found[at] for at in (90, 95, 100)} == {90} and found[699] == 500


def exact_nearest(rows, queries, count=5):
    usable = {(i, tuple(v)) for i, v in rows if i is not None and v and all(x is not None and math.isfinite(x) for x in v) and any(v)}
    found = {}
    for query, vector in sorted(usable):
        if query in queries:
            scores = {}
            for other, candidate in usable:
                if other != query and len(candidate) == len(vector):
                    score = math.fsum(a * b for a, b in zip(vector, candidate)) / math.sqrt(math.fsum(a * a for a in vector)) / math.sqrt(math.fsum(b * b for b in candidate))
                    scores[other] = max(scores.get(other, -2), round(score, 12))
            found[query] = sorted(scores.items(), key=lambda hit: (-hit[1], hit[0]))[:count]
    return found


def test_nearest_edge_rows(spark):
    rng = np.random.default_rng(5)
    rows = [(at, [float(x) for x in np.float32(rng.normal(size=8))]) for at in range(60)]
    rows += [(100 + at, rows[0][1]) for at in range(30)] + [(50, rows[50][1])]
    rows += [(200, None), (250, [0.0] * 8), (300, [float("nan")] * 8), (350, [1.0, None] * 4), (None, rows[1][1]), (400, [1.0, 2.0]), (450, [])]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn("score", F.lit(1))
    expected = exact_nearest(rows, {row[0] for row in rows if row[0] is not None and row[0] % 50 == 0})
    found = defaultdict(list)
    for row in neighbours.report(frame).orderBy("query_id", "rank").collect():
        found[row.query_id].append((row.vec_id, round(row.score, 12)))
        assert row["rank"] == len(found[row.query_id])
    assert set(found) == {query for query, hits in expected.items() if hits}
    assert found[0] == expected[0] == [(100 + at, 1.0) for at in range(5)]
    assert neighbours.report(frame.where("false")).collect() == []
    few = frame.where("vec_id in (0, 3, 4)")
    assert [row.vec_id for row in neighbours.report(few).orderBy("rank").collect()] == [hit for hit, _ in exact_nearest([r for r in rows if r[0] in (0, 3, 4)], {0})[0]]


def test_nearest_recall_and_large_buckets(spark, monkeypatch):
    frame = spark.read.parquet(f"{SF}/embeddings.parquet")
    rows = [(row.vec_id, row.embedding) for row in frame.collect()]
    expected = exact_nearest(rows, {row[0] for row in rows if row[0] % 50 == 0})
    for group_rows in (20_000, 3):
        monkeypatch.setattr(neighbours, "GROUP_ROWS", group_rows)
        found = defaultdict(set)
        for row in neighbours.report(frame).collect():
            found[row.query_id].add((row.vec_id, round(row.score, 12)))
        assert sum(len(found[query] & set(hits)) for query, hits in expected.items()) >= 0.9 * 5 * len(expected)


def test_stars_keep_components(spark):
    """A meeting with eight pivots: about one link a member is left, and the same sets are together."""
    pick = np.random.default_rng(4)
    names = np.unique(pick.integers(-(1 << 62), 1 << 62, 400))
    pivots = names[np.argsort(names ^ ngram_join._salt(1))[:8]]
    pairs = {(min(m, p), max(m, p)) for m in names for p in pivots if m != p and pick.random() < 0.9}
    pairs |= {tuple(sorted(pair)) for pair in pick.choice(1000, (300, 2)).tolist() if pair[0] != pair[1]}
    links = spark.createDataFrame([(int(a), int(b)) for a, b in pairs], "a long, b long")
    thin = ngram_join._stars(links, 1)
    whole, left = ({(r.node, r.component) for r in components.components(frame).collect()} for frame in (links, thin))
    assert whole == left and thin.count() < 400 + 8 * 7 + 300


def test_pipeline_equals_stage_by_stage(spark):
    documents = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    model = toxicity.fit_on(documents, labels)
    toxic = {row.doc_id for row in toxicity.score_documents(documents, model).where("score >= 0.5").collect()}
    rows = [(row.doc_id, row.text) for row in documents.collect() if row.doc_id not in toxic]
    rows = [(doc_id, text) for (doc_id, text), (_, size, component) in zip(rows, plain_components(rows)) if not size or doc_id == component]
    from veilcount.llm.decontaminate import reference_counts

    items = [(row.item_id, row.text) for row in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    kept = {doc_id for doc_id, text in rows if not reference_counts(text, items)[1]}
    found = corpus_pipeline.run(spark, SF)
    assert [name for name, _ in corpus_pipeline.STAGES] == ["toxicity", "near_duplicates", "decontaminate", "mix_sources", "shard"]
    assert found.columns == [*documents.columns, "shard", "slot"]
    uses = Counter(row.doc_id for row in found.collect())
    assert set(uses) == kept and max(uses.values()) <= 2
    before = documents.where(F.col("doc_id").isin(sorted(kept)))
    assert uses == Counter(row.doc_id for row in mixing.mixed(before).collect())
    places = {(row["shard"], row["slot"]) for row in found.collect()}
    assert len(places) == sum(uses.values()) and {shard for shard, _ in places} == set(range(24))
