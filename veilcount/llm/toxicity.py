"""Toxicity by compression distance: two zstandard dictionaries, one for toxic and one for ordinary text.

Both dictionaries end in the same part, trained by zstandard on windows of ordinary text. In front of it, at the same
distance, the toxic one holds the word stems that stand out in toxic rows, the ordinary one as many bytes of ordinary text.
So a window's two compressed lengths differ only by what it shares with either front part. Every text is cut into windows
of a few words, each is compressed with both, and the differences over the whole text go through a logistic curve whose
coefficients, and so the threshold, are calibrated on labelled rows.

The fit uses a bounded sample: at most `ROWS_PER_CLASS` labelled rows of each class, those with the smallest hash of the
doc_id among texts of at most `LONGEST_SAMPLE` characters. Scoring reads every whole text once, without a shuffle.
"""

from __future__ import annotations

import math
from collections import Counter
from dataclasses import dataclass
from itertools import islice

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from veilcount.llm.texts import blank_words, byte_batches, small_batches, utf8
from veilcount.session import new_work_folder

WINDOW_WORDS = 12
ROWS_PER_CLASS = 3000
LONGEST_SAMPLE = 20_000
TRAINED_BYTES = 12_288
LEVEL = 9
#: Shortest and longest stem, rows of one class it must occur in, share ratio it must exceed.
STEM, LEAST_ROWS, LEAST_SHARE = (4, 12), 5, 3.0
#: Likelihood ratio it must exceed where both classes have FULL_ROWS rows; see `least_ratio` for fewer.
LEAST_RATIO, FULL_ROWS = 60.0, 300
#: Stems that may stand out by chance alone in a small sample.
FALSE_STEMS = 0.01
MOST_STEMS = 2000
FEATURES = 6
_EDGES = b".,!?;:|*%$#&\"'()[]"


@dataclass
class Model:
    """Everything a worker needs; a few tens of kilobytes."""

    toxic: bytes
    ordinary: bytes
    weights: list[float]
    center: list[float]
    scale: list[float]

    def compressors(self):
        made = []
        for content in (self.toxic, self.ordinary):
            dictionary = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            dictionary.precompute_compress(level=LEVEL)
            made.append(
                zstandard.ZstdCompressor(
                    dict_data=dictionary, level=LEVEL, write_content_size=False, write_checksum=False, write_dict_id=False
                )
            )
        return made


def _windows(words: list[bytes], size: int = WINDOW_WORDS) -> list[bytes]:
    return [b" ".join(words[start : start + size]) for start in range(0, len(words), size)] or [b""]


def _features(text: bytes | None, compressors) -> list[float]:
    """Means and extremes of (ordinary length - toxic length) over all windows of the whole text."""
    toxic, ordinary = compressors
    gains = np.array([len(ordinary.compress(w)) - len(toxic.compress(w)) for w in _windows(blank_words(text))], float)
    above = np.maximum(gains - 1, 0)
    return [
        float(gains.mean()),
        float(above.mean()),
        float(gains.max()),
        float((gains >= 3).mean()),
        math.log1p(above.sum()),
        math.log(len(gains)),
    ]


def _plain_words(text: bytes) -> set[str]:
    return {word.strip(_EDGES).decode(errors="ignore") for word in set(blank_words(text))}


def _stems(text: bytes) -> set[str]:
    """The front parts of a text's words that are no shorter and no longer than a stem."""
    return {word[:size] for word in _plain_words(text) for size in range(STEM[0], min(len(word), STEM[1]) + 1)}


def _frequent(counts: dict[str, tuple[int, int]]) -> dict[str, tuple[int, int]]:
    """Of the stems with their toxic and ordinary rows those that enough toxic rows hold."""
    return {stem: rows for stem, rows in counts.items() if rows[0] >= LEAST_ROWS}


def count_stems(toxic: list[bytes], ordinary: list[bytes]) -> dict[str, tuple[int, int]]:
    """Rows of each stem in toxic and in ordinary texts."""
    found = [Counter(stem for text in texts for stem in _stems(text)) for texts in (toxic, ordinary)]
    return {stem: (found[0][stem], found[1][stem]) for stem in found[0].keys() | found[1].keys()}


def least_ratio(rows: int, stems: int, full: float = LEAST_RATIO) -> float:
    """The likelihood ratio that one of so many frequent stems must exceed, by the rows of the smaller class.

    It is `full` from FULL_ROWS rows on and falls in proportion to the rows below that, but not so far that more than
    FALSE_STEMS of the stems exceed it by chance: it is chi-squared with one degree of freedom, whose chance beyond x is
    below exp(-x / 2).
    """
    return min(full, max(full * rows / FULL_ROWS, 2 * math.log(max(1, stems) / FALSE_STEMS)))


def _standing_out(rows: tuple[int, int], frequent: dict[str, tuple[int, int]], full_ratio: float = LEAST_RATIO) -> list[str]:
    """Frequent stems whose share of toxic rows is higher beyond chance, weakest first. rows: toxic and ordinary texts."""
    least = least_ratio(min(rows), len(frequent), full_ratio)
    ratio = {}
    for stem, counts in frequent.items():
        if counts[0] / rows[0] <= LEAST_SHARE * counts[1] / rows[1]:
            continue
        shared, total = sum(counts) / sum(rows), 0.0
        for seen, of in zip(counts, rows):
            if seen:
                total += seen * math.log(seen / of / shared)
            if of - seen:
                total += (of - seen) * math.log((of - seen) / of / (1 - shared))
        if 2 * total > least:
            ratio[stem] = 2 * total
    # A stem that hardly ever occurs without a longer one of the list adds nothing to it.
    longer: dict[str, int] = {}
    for stem in ratio:
        for size in range(STEM[0], len(stem)):
            longer[stem[:size]] = max(longer.get(stem[:size], 0), frequent[stem][0])
    kept = [stem for stem in ratio if longer.get(stem, 0) < 0.9 * frequent[stem][0]]
    return sorted(kept, key=lambda stem: (ratio[stem], stem))[-MOST_STEMS:]


def _logistic(rows: np.ndarray, labels: np.ndarray) -> np.ndarray:
    """Newton's method with a small ridge; the last weight is the intercept."""
    design = np.hstack([rows, np.ones((len(rows), 1))])
    weights = np.zeros(design.shape[1])
    ridge = np.diag([1e-2] * rows.shape[1] + [1e-6])
    for _ in range(50):
        chance = 1 / (1 + np.exp(-np.clip(design @ weights, -30, 30)))
        slope = design.T @ (labels - chance) - ridge @ weights
        step = np.linalg.solve((design.T * (chance * (1 - chance))) @ design + ridge, slope)
        weights += step
        if np.abs(step).max() < 1e-9:
            break
    return weights


def _design(rows: np.ndarray, model: Model) -> np.ndarray:
    """Standardised features; texts far longer than any of the sample count as long, not as off the scale."""
    return np.clip((rows - model.center) / model.scale, -3, 3)


def fit(toxic: list[str], ordinary: list[str], full_ratio: float = LEAST_RATIO) -> Model:
    """A model from toxic and ordinary texts; without texts of both classes it scores every text 0."""
    samples = [[text.encode() for text in dict.fromkeys(texts) if text] for texts in (toxic, ordinary)]
    return _fitted(samples, _frequent(count_stems(*samples)), full_ratio)


def _fitted(samples: list[list[bytes]], frequent: dict[str, tuple[int, int]], full_ratio: float = LEAST_RATIO) -> Model:
    """A model from the distinct texts of both classes and the stems that enough toxic ones hold."""
    windows = lambda: (window for text in samples[1] for window in _windows(blank_words(text)))
    count = sum(1 for _ in windows())
    if not all(samples) or count < 100:
        return Model(b" " * 8, b" " * 8, [0.0] * FEATURES + [-30.0], [0.0] * FEATURES, [1.0] * FEATURES)
    trained = zstandard.train_dictionary(TRAINED_BYTES, list(islice(windows(), 0, None, max(1, count // 40_000)))).as_bytes()
    front = (" " + " ".join(_standing_out(tuple(map(len, samples)), frequent, full_ratio)) + " ").encode()
    filler = b" ".join(islice(windows(), len(front) // 4 + 1))[: len(front)].ljust(len(front))
    model = Model(front + trained, filler + trained, [], [], [])
    compressors = model.compressors()
    rows = np.array([_features(text, compressors) for texts in samples for text in texts])
    labels = np.array([1.0] * len(samples[0]) + [0.0] * len(samples[1]))
    center, scale = rows.mean(0), rows.std(0)
    scale[scale < 1e-6] = 1  # the same in every sample: nothing to weigh
    model.center, model.scale = center.tolist(), scale.tolist()
    model.weights = _logistic(_design(rows, model), labels).tolist()
    return model


_MODEL = "toxic binary, ordinary binary, weights array<double>, center array<double>, scale array<double>"
_MODEL_ARROW = pa.schema(
    [("toxic", pa.binary()), ("ordinary", pa.binary()), *((name, pa.list_(pa.float64())) for name in ("weights", "center", "scale"))]
)


def held_out() -> F.Column:
    """Whether labels of a row may not be learned from: crc32 of the doc_id as text, mod 5, is 0; false without doc_id."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 5 == 0, F.lit(False))


def fit_on(documents: DataFrame, labels: DataFrame, rows_per_class: int = ROWS_PER_CLASS) -> Model:
    """Fits on labelled rows that are not held out. Rows of `labels` with a null doc_id or label are left out, repeated ones
    count once; a doc_id labelled both ways is in both classes.

    The sample is written. Its stems are counted in Spark; one task learns from the sample, whose size is bounded, and the
    model alone comes back to the driver.
    """
    usable = labels.select("doc_id", "toxic").where(~held_out() & F.col("doc_id").isNotNull())
    spark = documents.sparkSession
    work = new_work_folder(spark, "toxicity")
    order = F.md5(F.col("doc_id").cast("string"))
    texts = documents.select("doc_id", "text").where(F.char_length("text").between(1, LONGEST_SAMPLE))
    for toxic in (1, 0):
        chosen = usable.where(F.col("toxic") == toxic).select("doc_id").distinct().orderBy(order).limit(rows_per_class)
        sample = texts.join(F.broadcast(chosen), "doc_id").orderBy(order, "text").limit(rows_per_class)
        sample.select(F.lit(toxic).alias("toxic"), order.alias("place"), "text").write.mode("append").parquet(f"{work}/sample")
    sample = spark.read.schema("toxic int, place string, text string").parquet(f"{work}/sample")

    def stems(batches):
        for batch in byte_batches(batches, "text", 1 << 18):
            found = [[], []]
            for toxic, text in zip(batch.column(0).to_pylist(), utf8(batch, "text")):
                found[1 - toxic].append(text)
            counted = count_stems(*found)
            columns = [list(counted), *([rows[side] for rows in counted.values()] for side in (0, 1))]
            yield pa.RecordBatch.from_arrays([pa.array(column, kind) for column, kind in zip(columns, (pa.string(), pa.int64(), pa.int64()))], ["stem", "toxic", "ordinary"])

    # Dealt anew, because a sample of few files would be counted by few tasks.
    spread = sample.select("toxic", "text").distinct().repartition(16)
    counted = spread.mapInArrow(stems, "stem string, toxic long, ordinary long").groupBy("stem")
    counted = counted.agg(F.sum("toxic").alias("toxic"), F.sum("ordinary").alias("ordinary")).where(F.col("toxic") >= LEAST_ROWS)

    def learn(texts: pa.Table, stems: pa.Table) -> pa.Table:
        rows = sorted(zip(*(texts[name].to_pylist() for name in ("place", "text", "toxic"))))
        samples = [[text.encode() for text in dict.fromkeys(text for _, text, of in rows if of == toxic)] for toxic in (1, 0)]
        frequent = dict(zip(stems["stem"].to_pylist(), zip(stems["toxic"].to_pylist(), stems["ordinary"].to_pylist())))
        model = _fitted(samples, frequent)
        return pa.Table.from_pylist([model.__dict__], schema=_MODEL_ARROW)

    one = F.lit(0).alias("all")
    learned = sample.withColumn("all", one).groupBy("all").cogroup(counted.withColumn("all", one).groupBy("all"))
    found = learned.applyInArrow(learn, _MODEL).collect()  # one row, or none without a sample
    if not found:
        return fit([], [])
    row = found[0].asDict()
    return Model(bytes(row["toxic"]), bytes(row["ordinary"]), row["weights"], row["center"], row["scale"])


def _scores(model: Model):
    def score(texts: list[bytes | None], compressors) -> np.ndarray:
        rows = np.array([_features(text, compressors) for text in texts]).reshape(-1, FEATURES)
        value = _design(rows, model) @ np.array(model.weights[:-1]) + model.weights[-1]
        return 1 / (1 + np.exp(-np.clip(value, -30, 30)))

    def of(batches):
        compressors = model.compressors()
        for batch in small_batches(batches):
            yield batch, score(utf8(batch, "text"), compressors)

    return of


SCORES = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("score", T.DoubleType())])


def score_documents(documents: DataFrame, model: Model) -> DataFrame:
    """doc_id and score of every row. Null and empty texts are one empty window and get its score; ties are kept."""
    scores = _scores(model)

    def run(batches):
        for batch, score in scores(batches):
            doc_ids = batch.column(batch.schema.get_field_index("doc_id"))
            yield pa.RecordBatch.from_arrays([doc_ids, pa.array(score)], ["doc_id", "score"])

    return documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, SCORES)


def without_toxic(documents: DataFrame, model: Model, threshold: float = 0.5) -> DataFrame:
    """The rows of `documents` that score below the threshold, with all columns, repeated rows as often as they were."""
    scores = _scores(model)

    def run(batches):
        for batch, score in scores(batches):
            yield batch.filter(pa.array(score < threshold, pa.bool_()))

    return documents.mapInArrow(run, documents.schema)


def report(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """Score and verdict of every row, by a model fitted on the labels that are not held out."""
    scored = score_documents(documents, fit_on(documents, labels))
    return scored.select(
        "doc_id", held_out().alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted")
    )
