"""Language identification by averaged hashed subword embeddings and a linear softmax.

Subwords are the character 2-, 3- and 4-grams of lower-cased words with their borders, hashed to a fixed number of buckets. A
text is the average of its subwords' embeddings; a linear layer and a softmax give the languages. The model is trained by
stochastic gradient descent in numpy, on a bounded sample of labelled documents (``PER_LANGUAGE`` of each language) whose subword
counts are made by Spark. A part of the sample that isn't trained on sets a temperature, so that a score is the
probability of being right; predictions that are less likely right than wrong are rejected.

For prediction, embeddings and layer are multiplied out once to one number for each bucket and language. Whole texts are
scored, many at a time, by array operations; there is no shuffle.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lynxrisk.llm.common import bound_batches, groups_of, settle, small_join, uniform

BUCKETS = 1 << 16
GRAMS = (2, 3, 4)
DIMENSIONS = 16
#: Bound of the training sample: so many documents of each language.
PER_LANGUAGE = 300
EPOCHS = 12
RATE = 8.0
#: A prediction is rejected if its calibrated probability is below this.
LEAST = 0.5
UNDETERMINED = "und"
#: Texts are scored together up to about so many characters.
GROUP_CHARS = 1 << 18


@dataclass(frozen=True)
class Model:
    languages: tuple[str, ...]
    scores: np.ndarray  # buckets x languages, embeddings and layer multiplied out
    bias: np.ndarray
    temperature: float


_LETTER: list[np.ndarray] = []


def _letters() -> np.ndarray:
    """For each code point whether it is a letter; made once in a process."""
    if not _LETTER:
        _LETTER.append(np.fromiter((chr(i).isalpha() for i in range(0x110000)), dtype=bool, count=0x110000))
    return _LETTER[0]


def subwords(texts: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each gram length: buckets of all subwords of the texts, and which text each belongs to (ascending)."""
    lowered = [t.lower() for t in texts]
    ends = np.cumsum([len(t) + 2 for t in lowered])
    codes = np.frombuffer("".join(f" {t} " for t in lowered).encode("utf-32-le", "surrogatepass"), dtype="<u4")
    letter = _letters()[codes]
    codes = np.where(letter, codes, 0).astype(np.uint32)
    for n in GRAMS:
        count = len(codes) - n + 1
        if count <= 0:
            continue
        inner = letter[1 : 1 + count].copy() if n > 2 else letter[:count] | letter[1 : 1 + count]
        for k in range(2, n - 1):
            inner &= letter[k : k + count]
        at = np.flatnonzero(inner)
        h = np.full(len(at), 2166136261 + n, dtype=np.uint32)
        for k in range(n):
            h = (h ^ codes[at + k]) * np.uint32(16777619)
            h ^= h >> np.uint32(15)
        yield (h * np.uint32(2654435769)) >> np.uint32(16), np.searchsorted(ends, at, side="right")


def _grouped(texts: list[str]) -> Iterator[list[str]]:
    group, chars = [], 0
    for t in texts:
        group.append(t)
        chars += len(t)
        if chars >= GROUP_CHARS:
            yield group
            group, chars = [], 0
    if group:
        yield group


def predict(texts: list[str | None], model: Model) -> tuple[list[str], np.ndarray]:
    """Language and score of each text; `und` with score 0 for null and for texts without a letter."""
    names: list[str] = []
    scores: list[np.ndarray] = []
    for group in _grouped([t or "" for t in texts]):
        total = np.zeros((len(group), len(model.languages)))
        count = np.zeros(len(group))
        for buckets, owner in subwords(group):
            count += np.bincount(owner, minlength=len(group))
            for c in range(len(model.languages)):
                total[:, c] += np.bincount(owner, weights=model.scores[:, c][buckets], minlength=len(group))
        logits = (total / np.maximum(count, 1)[:, None] + model.bias) / model.temperature
        p = np.exp(logits - logits.max(axis=1, keepdims=True))
        p /= p.sum(axis=1, keepdims=True)
        best = p.argmax(axis=1)
        names += [model.languages[b] if n else UNDETERMINED for b, n in zip(best, count, strict=True)]
        scores.append(np.where(count > 0, p.max(axis=1), 0.0))
    return names, np.concatenate(scores) if scores else np.zeros(0)


def train(languages: list[str], labels: np.ndarray, buckets: list[np.ndarray], counts: list[np.ndarray], seed: int = 3) -> Model:
    """Stochastic gradient descent on the documents' average embeddings; every fifth document of a language only calibrates."""
    rng = np.random.default_rng(seed)
    k = len(languages)
    if not k:
        return Model((), np.zeros((BUCKETS, 0), dtype=np.float32), np.zeros(0), 1.0)
    embeddings = rng.uniform(-1 / DIMENSIONS, 1 / DIMENSIONS, (BUCKETS, DIMENSIONS))
    layer, bias = rng.normal(0, 0.5, (DIMENSIONS, k)), np.zeros(k)
    shares = [c / c.sum() for c in counts]
    rank = np.zeros(len(labels), dtype=np.int64)
    for c in range(k):
        rank[labels == c] = np.arange((labels == c).sum())
    held = rank % 5 == 4
    train_on = np.flatnonzero(~held)
    for epoch in range(EPOCHS):
        rate = RATE * (1 - epoch / EPOCHS)
        for i in rng.permutation(train_on):
            at, share = buckets[i], shares[i]
            mean = share @ embeddings[at]
            logits = mean @ layer + bias
            gradient = np.exp(logits - logits.max())
            gradient /= gradient.sum()
            gradient[labels[i]] -= 1
            back = layer @ gradient
            layer -= rate * 0.05 * np.outer(mean, gradient)
            bias -= rate * 0.005 * gradient
            embeddings[at] -= rate * share[:, None] * back
    scores = embeddings @ layer
    check = np.flatnonzero(held) if held.any() else train_on
    logits = np.array([shares[i] @ scores[buckets[i]] + bias for i in check]).reshape(-1, k)

    def loss(t: float) -> float:
        z = logits / t
        z = z - z.max(axis=1, keepdims=True)
        return float(np.mean(np.log(np.exp(z).sum(axis=1)) - z[np.arange(len(check)), labels[check]]))

    temperature = min((2.0**e for e in np.arange(-2, 3.01, 0.25)), key=loss)
    return Model(tuple(languages), scores.astype(np.float32), bias, float(temperature))


def held_out(doc_id: Column) -> Column:
    """Whether a document is for testing only: CRC-32 of its id as text leaves 1 by 3. A null id counts as an empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % 3 == 1


def sample(docs: DataFrame, per_language: int = PER_LANGUAGE) -> DataFrame:
    """(lang, text): of each language the documents with the least hashes, ``per_language`` at most, of those to learn from."""
    labelled = docs.filter("lang IS NOT NULL AND text IS NOT NULL").filter(~held_out(F.col("doc_id"))).select("doc_id", "text", F.col("lang").cast("string").alias("lang"))
    # rows that are equal share their draw, so only different ones count
    different = labelled.groupBy(F.col("lang").alias("of"), F.xxhash64("doc_id", "text").alias("row")).agg(F.count("*").alias("copies"))
    sizes = settle(different.groupBy("of").agg(F.count("*").alias("n")))
    draw = uniform(F.lit(3), F.col("doc_id"), F.col("text"))
    # first a rough draw of about twice as many, so that the exact one ranks few rows for each language
    drawn = small_join(labelled.withColumn("draw", draw), sizes, F.col("lang") == F.col("of")).filter(F.col("draw") * F.col("n") < 2.0 * per_language + 20)
    order = Window.partitionBy("lang").orderBy("draw", "doc_id", "text")
    return drawn.withColumn("at", F.row_number().over(order)).filter(F.col("at") <= per_language).select("lang", "at", "text")


def fit(docs: DataFrame, per_language: int = PER_LANGUAGE) -> Model:
    """Train on the sample. Only subword counts of at most ``per_language`` documents of each language come to the driver."""

    def counted(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for lang, at, text in zip(batch["lang"], batch["at"], batch["text"], strict=True):
                found = [b for b, _ in subwords([text])]
                bucket, n = np.unique(np.concatenate(found), return_counts=True)
                yield pd.DataFrame({"lang": [lang], "at": [at], "bucket": [bucket.astype(np.int32)], "n": [n.astype(np.float32)]})

    rows = sample(docs, per_language).mapInPandas(counted, "lang string, at int, bucket array<int>, n array<float>").toArrow()
    rows = sorted(zip(rows["lang"].to_pylist(), rows["at"].to_pylist(), rows["bucket"].combine_chunks(), rows["n"].combine_chunks(), strict=True), key=lambda r: (r[1], r[0]))
    rows = [(lang, np.asarray(b.values), np.asarray(n.values)) for lang, _, b, n in rows if len(b.values)]
    languages = sorted({r[0] for r in rows})
    labels = np.array([languages.index(r[0]) for r in rows], dtype=np.int64)
    return train(languages, labels, [r[1] for r in rows], [r[2] for r in rows])


def identify(docs: DataFrame, model: Model | None = None, least: float = LEAST) -> DataFrame:
    """All rows and columns, with lang_pred, score (double, 0 to 1) and rejected (boolean).

    The prediction sees the text only. A null text and one without a letter are `und` with score 0, and rejected; so is every
    text if no labelled document is there to learn from. Documents with equal texts get the same answer. Without a
    ``model`` one is trained on ``docs`` (columns doc_id, text, lang), less its held-out documents. Input columns named like the
    new ones are replaced.
    """
    bound_batches(docs.sparkSession)
    model = model or fit(docs)

    @F.arrow_udf("lang_pred string, score double")
    def predicted(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in texts:
            names, scores = [UNDETERMINED] * len(batch), np.zeros(len(batch))
            at = 0
            for part in groups_of(batch) if model.languages else ():
                end = at + len(part)
                names[at:end], scores[at:end] = predict(part, model)
                at = end
            yield pa.StructArray.from_arrays([pa.array(names, pa.string()), pa.array(scores)], names=["lang_pred", "score"])

    kept = [f"`{c}`" for c in docs.columns if c.lower() not in ("lang_pred", "score", "rejected")]
    answered = docs.select(*kept, predicted(F.col("text").cast("string")).alias("_p"))
    rejected = (F.col("_p.lang_pred") == UNDETERMINED) | (F.col("_p.score") < least)
    return answered.select(*kept, "_p.lang_pred", "_p.score", rejected.alias("rejected"))
