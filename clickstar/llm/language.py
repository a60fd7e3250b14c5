"""Language of a text: averaged embeddings of hashed subwords and a linear softmax.

A text's features are the letter n-grams of its lower-cased words, word ends included, hashed into
buckets. Each bucket has an embedding; a text is the mean of its n-grams' embeddings, and a linear
softmax scores the languages. Both are trained by stochastic gradient descent in numpy, on the
driver, on a sample bounded by ``per_language`` texts a language. A part of the sample is held back:
on it the softmax gets its temperature, and the score below which a text is rejected.

Prediction is linear in the n-grams, so embeddings and softmax are multiplied once into a score per
bucket and language, and a text's scores are the mean over its n-grams. Texts are taken in blocks,
whole, whatever their length.
"""

from __future__ import annotations

import functools
import sys
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clickstar.llm.tables import give_back, texts

UNKNOWN = "und"
SIZES = (2, 3, 4, 5)
#: Code points of a block.
BLOCK = 1 << 17
_PRIME = np.uint64(0x9E3779B97F4A7C15)


@functools.cache
def _letters() -> np.ndarray:
    return np.fromiter((chr(c).isalpha() for c in range(sys.maxunicode + 1)), bool)


def _code_points(text: str) -> np.ndarray:
    """The lower-cased text with 0 for whatever is no letter, and 0 before and after."""
    points = np.frombuffer(text.lower().encode("utf-32-le"), np.uint32)
    framed = np.zeros(len(points) + 2, np.uint32)
    framed[1:-1] = np.where(_letters()[points], points, 0)
    return framed


def _ngrams(points: np.ndarray, buckets: int, last: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each size the places below ``last`` where an n-gram starts, and their buckets: letters,
    with a word's end at either side if it has one there."""
    letter = points != 0
    coded = points.astype(np.uint64)
    inner = None  # all letters from place + 1 to place + size - 2
    value = coded
    for size in range(2, max(SIZES) + 1):
        if len(points) < size:
            return
        n = len(points) - size + 1
        value = value[:n] * _PRIME + coded[size - 1 :]
        if size == 2:
            whole = letter[:-1] | letter[1:]
        else:
            inner = letter[1 : n + 1] if inner is None else inner[:n] & letter[size - 2 : n + size - 2]
            whole = inner
        if size in SIZES:
            at = np.flatnonzero(whole[: min(n, last)])
            mixed = (value[at] ^ (value[at] >> np.uint64(29))) * _PRIME
            yield at, (mixed >> np.uint64(40)).astype(np.int64) % buckets


def _blocks(points: np.ndarray) -> Iterator[tuple[np.ndarray, int]]:
    """The places in blocks that overlap by as much as an n-gram can reach."""
    for start in range(0, len(points), BLOCK):
        yield points[start : start + BLOCK + max(SIZES) - 1], min(BLOCK, len(points) - start)


def text_features(text: str, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """The buckets of a text's n-grams and how many fall in each."""
    counts = np.zeros(buckets, np.int64)
    for block, last in _blocks(_code_points(text)):
        for _, bucket in _ngrams(block, buckets, last):
            counts += np.bincount(bucket, minlength=buckets)
    found = np.flatnonzero(counts)
    return found, counts[found]


@dataclass(frozen=True)
class LanguageModel:
    """Languages in order, their score per bucket, their bias, and what calibration found."""

    languages: list[str]
    scores: np.ndarray
    bias: np.ndarray
    temperature: float = 1.0
    threshold: float = 0.0

    def probabilities(self, logits: np.ndarray) -> np.ndarray:
        scaled = logits / self.temperature
        powers = np.exp(scaled - scaled.max(axis=1, keepdims=True))
        return powers / powers.sum(axis=1, keepdims=True)


def _sum_logits(points: np.ndarray, starts: np.ndarray, model: LanguageModel):
    """For each text, which begin at ``starts`` of the joined points: sums of scores, n-grams."""
    sums = np.zeros((len(starts), len(model.languages)))
    grams = np.zeros(len(starts))
    offset = 0
    for block, last in _blocks(points):
        first = np.searchsorted(starts, offset, "right") - 1
        ends = np.append(starts[first + 1 :], len(points)) - offset
        for at, bucket in _ngrams(block, len(model.scores), last):
            cuts = np.searchsorted(at, np.concatenate([[0], ends]))
            filled = np.flatnonzero(np.diff(cuts))
            if len(filled):
                found = np.add.reduceat(model.scores[bucket], cuts[filled], axis=0)
                sums[first + filled] += found
                grams[first + filled] += np.diff(cuts)[filled]
        offset += last
    return sums, grams


def _grouped(batch_texts: Iterator[str]) -> Iterator[list[np.ndarray]]:
    """Texts as points, as many together as fill a block."""
    group, size = [], 0
    for text in batch_texts:
        group.append(_code_points(text))
        size += len(group[-1])
        if size >= BLOCK:
            yield group
            group, size = [], 0
    if group:
        yield group


def predict_texts(batch_texts: Iterator[str], model: LanguageModel) -> tuple[list[str], list[float]]:
    """Language and score of each text; ``und`` and 0 for a text without letters."""
    languages: list[str] = []
    scores: list[float] = []
    for group in _grouped(batch_texts):
        lengths = np.array([len(points) for points in group])
        starts = np.concatenate([[0], np.cumsum(lengths)[:-1]])
        joined = np.concatenate(group)
        has_letter = np.add.reduceat(joined != 0, starts) > 0
        if not model.languages:
            languages += [UNKNOWN] * len(group)
            scores += [0.0] * len(group)
            continue
        sums, grams = _sum_logits(joined, starts, model)
        logits = sums / np.maximum(grams, 1)[:, None] + model.bias
        chances = model.probabilities(logits)
        best = chances.argmax(axis=1)
        for k, known in enumerate(has_letter):
            languages.append(model.languages[best[k]] if known else UNKNOWN)
            scores.append(float(min(1.0, chances[k, best[k]])) if known else 0.0)
    return languages, scores


# Training ------------------------------------------------------------------------------------


def _descend(rows, labels, n_languages, buckets, dim, epochs, rate, seed):
    rng = np.random.default_rng(seed)
    embedding = rng.uniform(-1 / dim, 1 / dim, (buckets, dim)).astype(np.float32)
    linear = np.zeros((dim, n_languages), np.float32)
    bias = np.zeros(n_languages, np.float32)
    steps, step = epochs * len(rows), 0
    for _ in range(epochs):
        for k in rng.permutation(len(rows)):
            found, counts = rows[k]
            weights = (counts / counts.sum()).astype(np.float32)
            hidden = weights @ embedding[found]
            logits = hidden @ linear + bias
            wrong = np.exp(logits - logits.max())
            wrong /= wrong.sum()
            wrong[labels[k]] -= 1
            now = np.float32(rate * (1 - step / steps))
            back = linear @ wrong
            linear -= now * np.outer(hidden, wrong)
            bias -= now * np.float32(0.1) * wrong
            # Scaled up, as a gradient spread over a whole text's n-grams hardly moves any.
            embedding[found] -= now * np.outer(np.sqrt(weights), back)
            step += 1
    return embedding @ linear, bias


def _calibrated(model: LanguageModel, rows, labels, refused: float) -> LanguageModel:
    """The temperature that fits the held-back rows best, and the score that all but ``refused``
    of those told rightly reach."""
    if not rows:
        return model
    logits = np.stack(
        [(counts / counts.sum()) @ model.scores[found] + model.bias for found, counts in rows]
    )
    truth = np.array(labels)

    def loss(temperature: float) -> float:
        trial = LanguageModel(model.languages, model.scores, model.bias, temperature)
        return -np.log(trial.probabilities(logits)[np.arange(len(truth)), truth] + 1e-12).mean()

    temperature = float(min(np.geomspace(0.05, 20, 121), key=loss))
    fitted = LanguageModel(model.languages, model.scores, model.bias, temperature)
    chances = fitted.probabilities(logits)
    right = chances.argmax(axis=1) == truth
    reached = np.quantile(chances.max(axis=1)[right], refused) if right.any() else 0.0
    # Never above one half: a language that is likelier than all others together is no guess.
    threshold = float(min(0.5, reached))
    return LanguageModel(model.languages, model.scores, model.bias, temperature, threshold)


def train_language_model(
    docs: DataFrame,
    learn: Column,
    id_column: str = "doc_id",
    text_column: str = "text",
    label_column: str = "lang",
    per_language: int = 400,
    buckets: int = 1 << 16,
    dim: int = 16,
    epochs: int = 12,
    rate: float = 4.0,
    refused: float = 0.005,
    seed: int = 7,
) -> LanguageModel:
    """A model of the labelled rows for which ``learn`` holds.

    About ``per_language`` rows a language are drawn by a hash of their id, and their features, at
    most ``buckets`` pairs a text, gathered on the driver; this is the only bound. Rows whose text
    or label is null, or whose text has no letter, teach nothing. With no rows to learn from, the
    model knows no language and every text is unknown.
    """
    rows = docs.where(learn).select(
        F.col(id_column).cast("string").alias("id"),
        F.col(text_column).alias("text"),
        F.col(label_column).alias("label"),
    )
    rows = rows.where(F.col("text").isNotNull() & F.col("label").isNotNull())
    sizes = {r["label"]: r["count"] for r in rows.groupBy("label").count().collect()}
    if not sizes:
        return LanguageModel([], np.zeros((buckets, 0), np.float32), np.zeros(0, np.float32))
    shares = F.create_map(
        *[F.lit(x) for label, n in sizes.items() for x in (label, min(1.0, per_language / n))]
    )
    drawn = F.pmod(F.xxhash64(F.coalesce("id", F.lit("")), F.lit(seed)), F.lit(1 << 30)) / (1 << 30)
    sample = rows.where(drawn < shares[F.col("label")])

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k, text in enumerate(texts(batch.column("text"))):
                found, counts = text_features(text, buckets)
                if len(found):
                    yield pa.RecordBatch.from_arrays(
                        [
                            batch.column("id").slice(k, 1),
                            batch.column("label").slice(k, 1),
                            pa.array([found.astype("<i4").tobytes()], pa.binary()),
                            pa.array([counts.astype("<i4").tobytes()], pa.binary()),
                        ],
                        ["id", "label", "found", "counts"],
                    )

    schema = "id string, label string, found binary, counts binary"
    gathered = sample.mapInArrow(features, schema).collect()
    gathered.sort(key=lambda r: (r["id"] or "", r["label"], bytes(r["found"]), bytes(r["counts"])))
    languages = sorted({r["label"] for r in gathered})
    number = {language: k for k, language in enumerate(languages)}
    parts: dict[bool, tuple[list, list]] = {False: ([], []), True: ([], [])}
    for k, r in enumerate(gathered):
        kept_back = k % 5 == 0 and len(gathered) >= 5 * len(languages)
        pair = (np.frombuffer(r["found"], "<i4"), np.frombuffer(r["counts"], "<i4"))
        parts[kept_back][0].append(pair)
        parts[kept_back][1].append(number[r["label"]])
    scores, bias = _descend(*parts[False], len(languages), buckets, dim, epochs, rate, seed)
    return _calibrated(LanguageModel(languages, scores, bias), *parts[True], refused)


# Over tables ---------------------------------------------------------------------------------


def predict_language(
    docs: DataFrame,
    model: LanguageModel,
    carry: list[str],
    text_column: str = "text",
) -> DataFrame:
    """The columns of ``carry``, ``lang_pred``, ``score`` and ``rejected`` for each row.

    Only the text is read for a prediction. A null or empty text and one without a letter is
    ``und``, with score 0, and rejected, as is a text whose score is below the model's threshold.
    Repeated rows stay repeated; further columns are not read; an empty table gives an empty one.
    """
    rows = docs.select(*carry, F.col(text_column).alias("__text"))

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            languages, scores = predict_texts(texts(batch.column("__text")), model)
            yield pa.RecordBatch.from_arrays(
                [
                    *[batch.column(c) for c in carry],
                    pa.array(languages, pa.string()),
                    pa.array(scores, pa.float64()),
                ],
                [*carry, "lang_pred", "score"],
            )

    kept = T.StructType([rows.schema[c] for c in carry])
    predicted = rows.mapInArrow(predict, kept.add("lang_pred", "string").add("score", "double"))
    rejected = (F.col("lang_pred") == UNKNOWN) | (F.col("score") < model.threshold)
    return predicted.withColumn("rejected", rejected)


def identified(docs: DataFrame, model: LanguageModel, text_column: str = "text") -> DataFrame:
    """The rows, as they are, whose language the model tells and does not reject.

    Texts go to the model and only its verdicts come back, so whole rows stay where they are.
    """

    def verdicts(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for column in columns:
            languages, scores = predict_texts(texts(column), model)
            told = np.array(languages, object) != UNKNOWN
            yield pa.array(told & (np.array(scores) >= model.threshold), pa.bool_())
        give_back()

    return docs.where(F.arrow_udf(verdicts, "boolean")(F.col(text_column)))
