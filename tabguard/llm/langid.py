"""Language identification: multinomial logistic regression on TF-IDF character n-grams.

Document frequencies are counted over all training documents. The weights are trained by follow-the-regularised-
leader (per-coordinate, with L1 and L2 penalties) on a bounded sample of them, and the scores are calibrated by a
temperature fitted on a part of that sample kept out of training. Every document is then predicted from its
whole text. N-grams are hashed into a fixed number of features, so the model's size does not grow with the data.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabguard.llm.common import keyed, numbered

#: Hashed features, of 1-, 2- and 3-grams.
FEATURES = 1 << 14
ORDERS = (1, 2, 3)
#: Characters handled at once; longer texts are counted piece by piece.
_PIECE = 1 << 20
_MULTIPLIERS = np.array([2654435761, 2246822519, 3266489917], np.uint32)

UNDETERMINED = "und"
#: Score from which a prediction stands for a document's language, whatever its label.
SURE = 0.9


@dataclass(frozen=True)
class Settings:
    """``sample_per_language`` and ``sample_total`` bound the rows that the weights are fitted on; nothing else is sampled."""

    sample_per_language: int = 1500
    sample_total: int = 12_000
    epochs: int = 3
    alpha: float = 0.5
    beta: float = 1.0
    l1: float = 0.02
    l2: float = 0.02
    calibration_share: float = 0.2


@dataclass(frozen=True)
class Model:
    languages: tuple[str, ...]
    idf: np.ndarray
    weights: np.ndarray  # features x languages
    bias: np.ndarray
    temperature: float


def ngram_counts(text: str) -> np.ndarray:
    """How often each hashed n-gram occurs in the lower-cased text."""
    total = np.zeros(FEATURES, np.int64)
    text = text.lower()
    longest = max(ORDERS)
    shift = np.uint32(32 - int(math.log2(FEATURES)))
    for at in range(0, len(text), _PIECE):
        # a piece also sees the next characters, so that n-grams across its end are counted once
        chars = np.frombuffer(text[at : at + _PIECE + longest - 1].encode("utf-32-le", "surrogatepass"), np.uint32)
        own = min(_PIECE, len(text) - at)
        mixed = np.zeros(len(chars), np.uint32)
        for n in ORDERS:
            if len(chars) < n:
                break
            mixed = mixed[: len(chars) - n + 1] + chars[n - 1 :] * _MULTIPLIERS[n - 1]
            hashed = ((mixed[:own] ^ np.uint32(n * 0x9E3779B1 & 0xFFFFFFFF)) * np.uint32(0x85EBCA6B)) >> shift
            total += np.bincount(hashed, minlength=FEATURES)
    return total


def has_letter(text: str | None) -> bool:
    return text is not None and any(map(str.isalpha, text))


def sparse_weights(counts: np.ndarray, idf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places and unit-length TF-IDF values (sublinear term frequency) of one document."""
    place = np.flatnonzero(counts)
    value = (1.0 + np.log(counts[place])) * idf[place]
    norm = math.sqrt(float(value @ value))
    return place, (value / norm if norm > 0 else value)


def softmax(scores: np.ndarray) -> np.ndarray:
    e = np.exp(scores - scores.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


class Ftrl:
    """Per-coordinate follow-the-regularised-leader for a softmax over languages."""

    def __init__(self, features: int, classes: int, s: Settings) -> None:
        self.z = np.zeros((features, classes))
        self.n = np.zeros((features, classes))
        self.s = s

    def weights(self, place) -> np.ndarray:
        z, n, s = self.z[place], self.n[place], self.s
        return np.where(np.abs(z) <= s.l1, 0.0, -(z - np.sign(z) * s.l1) / ((s.beta + np.sqrt(n)) / s.alpha + s.l2))

    def learn(self, place: np.ndarray, value: np.ndarray, target: int) -> None:
        w = self.weights(place)
        p = softmax(value @ w)
        p[target] -= 1.0
        g = value[:, None] * p[None, :]
        n = self.n[place]
        self.z[place] += g - (np.sqrt(n + g * g) - np.sqrt(n)) / self.s.alpha * w
        self.n[place] = n + g * g


def fit_temperature(scores: np.ndarray, target: np.ndarray) -> float:
    """The temperature of least log loss, by golden-section search on its logarithm."""
    if not len(target):
        return 1.0

    def loss(log_t: float) -> float:
        p = softmax(scores / math.exp(log_t))[np.arange(len(target)), target]
        return float(-np.log(np.maximum(p, 1e-12)).mean())

    low, high, ratio = math.log(0.05), math.log(20.0), (math.sqrt(5) - 1) / 2
    for _ in range(60):
        a, b = high - ratio * (high - low), low + ratio * (high - low)
        low, high = (low, b) if loss(a) <= loss(b) else (a, high)
    return math.exp((low + high) / 2)


def held_out(id_col: str) -> Column:
    """Whether crc32 of the id as text leaves 2 when divided by 4."""
    return F.coalesce(F.crc32(F.col(f"`{id_col}`").cast("string")) % 4 == 2, F.lit(False))


def _counted(docs: DataFrame) -> DataFrame:
    """Sparse counts per row of (lang, draw, text): places (16 bits each) and counts (32 bits) as packed bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            places, counts = [], []
            for text in batch.column(2):
                c = ngram_counts(text.as_py())
                nz = np.flatnonzero(c)
                places.append(nz.astype("<u2").tobytes())
                counts.append(np.minimum(c[nz], 2**32 - 1).astype("<u4").tobytes())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(places, pa.binary()), pa.array(counts, pa.binary())],
                ["lang", "draw", "places", "counts"],
            )

    return docs.select("lang", "draw", "text").mapInArrow(run, "lang string, draw double, places binary, counts binary")


def document_frequencies(docs: DataFrame) -> tuple[np.ndarray, int]:
    """In how many documents (column text) each feature occurs, and the number of documents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df, n = np.zeros(FEATURES + 1, np.int64), 0
        for batch in batches:
            for text in batch.column(0):
                df[:FEATURES] += ngram_counts(text.as_py()) > 0
                n += 1
        df[FEATURES] = n
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(FEATURES + 1, dtype=np.int32)), pa.array(df)], ["place", "df"])

    counted = docs.select("text").mapInArrow(run, "place int, df long").groupBy("place").agg(F.sum("df").alias("df"))
    df = np.zeros(FEATURES + 1, np.int64)
    for row in counted.collect():  # one row per feature
        df[row.place] = row.df
    return df[:FEATURES], int(df[FEATURES])


def most_per_language(sizes: Iterable[int], settings: Settings) -> float:
    """The bound on the rows of one language: small languages are taken whole, large ones share what remains of the total."""
    sizes = sorted(min(v, settings.sample_per_language) for v in sizes)
    left = float(settings.sample_total)
    for i, v in enumerate(sizes):
        if v > left / (len(sizes) - i):
            return left / (len(sizes) - i)
        left -= v
    return float(settings.sample_per_language)


def train(docs: DataFrame, settings: Settings = Settings()) -> Model:
    """Fit a model on all rows (doc_id, text, lang) that are given; rows with null text or lang are left out.

    The rows that the weights are fitted on are drawn per language by a hash of id and text, at most about
    ``sample_per_language`` each and ``sample_total`` in all, so the same rows give the same model. Without rows the
    model knows no language.
    """
    rows = docs.where(F.col("text").isNotNull() & F.col("lang").isNotNull())
    per_language = {r.lang: r["count"] for r in rows.groupBy("lang").count().collect()}
    languages = tuple(sorted(per_language))
    idf_of = lambda df, n: np.log((1.0 + n) / (1.0 + df)) + 1.0
    if not languages:
        return Model((), np.ones(FEATURES), np.zeros((FEATURES, 0)), np.zeros(0), 1.0)
    df, n = document_frequencies(rows)
    idf = idf_of(df, n)
    most = most_per_language(per_language.values(), settings)
    shares = docs.sparkSession.createDataFrame(
        [(k, min(1.0, most / v)) for k, v in per_language.items()], "lang string, share double"
    )
    draw = (F.xxhash64("doc_id", "text") / F.lit(2.0**64) + F.lit(0.5)).alias("draw")
    drawn = rows.select("lang", draw, "text").join(F.broadcast(shares), "lang").where(F.col("draw") < F.col("share"))
    number = {k: i for i, k in enumerate(languages)}
    vectors = []
    sample = _counted(drawn).collect()  # bounded by sample_total and FEATURES
    for r in sorted(sample, key=lambda r: (r.draw, bytes(r.places), bytes(r.counts))):
        counts = np.zeros(FEATURES, np.int64)
        counts[np.frombuffer(r.places, "<u2").astype(np.int64)] = np.frombuffer(r.counts, "<u4")
        place, value = sparse_weights(counts, idf)
        vectors.append((place.astype(np.uint16), value.astype(np.float32), number[r.lang]))
    del sample
    aside = max(1, round(1 / settings.calibration_share))
    kept = vectors[::aside] if len(vectors) >= 5 * aside else []
    used = [v for i, v in enumerate(vectors) if i % aside] if kept else vectors
    learner = Ftrl(FEATURES + 1, len(languages), settings)
    order = np.random.default_rng(1)
    for _ in range(settings.epochs):
        for i in order.permutation(len(used)):
            place, value, target = used[i]
            learner.learn(np.append(place.astype(np.int64), FEATURES), np.append(value, 1.0), target)  # the last feature is the bias
    w = learner.weights(slice(None))
    scores = np.array([v @ w[p] + w[FEATURES] for p, v, _ in kept]).reshape(len(kept), len(languages))
    temperature = fit_temperature(scores, np.array([t for _, _, t in kept], np.int64))
    return Model(languages, idf, w[:FEATURES], w[FEATURES], temperature)


class Predictor:
    """Language and score of texts under a model."""

    def __init__(self, model: Model) -> None:
        self.model = model

    def one(self, text: str | None) -> tuple[str, float]:
        m = self.model
        if not m.languages or not has_letter(text):
            return UNDETERMINED, 0.0
        place, value = sparse_weights(ngram_counts(text), m.idf)
        p = softmax((value @ m.weights[place] + m.bias) / m.temperature)
        best = int(p.argmax())
        return m.languages[best], float(p[best])


def identify(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: doc_id, lang_pred (a learned language, ``und`` for null texts and texts without a letter) and score.

    Only the text is looked at. A text of any length is used whole. Repeated ids and rows each give a row, null ids
    stay null, other columns are ignored; an empty input gives an empty result, a model without languages ``und``.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Predictor(shared.value)
        for batch in batches:
            found = [known.one(t.as_py()) for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([x for x, _ in found], pa.string()), pa.array([y for _, y in found], pa.float64())],
                ["doc_id", "lang_pred", "score"],
            )

    source = keyed(docs, doc_id=id_col, text=text_col)
    return source.mapInArrow(run, f"doc_id {source.schema['doc_id'].dataType.simpleString()}, lang_pred string, score double")


def keep_identified(
    docs: DataFrame, model: Model, text_col: str = "text", least_score: float = 0.0, lang_col: str | None = None, sure: float = SURE
) -> DataFrame:
    """The rows of ``docs``, all columns, whose text has a letter and, if given, a language with at least that score.

    With ``lang_col``, a string column, rows whose language is found with a score of ``sure`` or more have it there; the
    others, and labels that the model has not learned, stay as they are. A model without languages gives no scores, so that the letter alone
    decides. Null and empty texts go; nulls in other columns, repeated rows and further columns of any name stay as they
    are. An empty input gives an empty result.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    place, model_knows, learned = docs.columns.index(text_col), bool(model.languages), frozenset(model.languages)
    label = None if lang_col is None else docs.columns.index(lang_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Predictor(shared.value)
        for batch in batches:
            texts = [t.as_py() for t in batch.column(place)]
            if model_knows:
                found = [known.one(t) for t in texts]
                fine = [has_letter(t) and y >= least_score for t, (_, y) in zip(texts, found)]
                if label is not None:
                    field = batch.schema.field(label)
                    given = batch.column(label).to_pylist()
                    langs = [x if y >= sure and (old is None or old in learned) else old for (x, y), old in zip(found, given)]
                    batch = batch.set_column(label, field, pa.array(langs, field.type))
            else:
                fine = [has_letter(t) for t in texts]
            yield batch.filter(pa.array(fine, pa.bool_()))

    rows = numbered(docs)
    return rows.mapInArrow(run, rows.schema).toDF(*docs.columns)


def train_on_documents(docs: DataFrame, settings: Settings = Settings()) -> Model:
    """A model from the documents (doc_id, text, lang) that are not held out."""
    rows = keyed(docs, doc_id="doc_id", text="text", lang="lang")
    return train(rows.where(~held_out("doc_id")), settings)


def predict_documents(docs: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """Train on the documents that are not held out and predict all: doc_id, held_out, lang_pred, score."""
    found = identify(docs, train_on_documents(docs, settings))
    return found.select("doc_id", held_out("doc_id").alias("held_out"), "lang_pred", "score")
