"""Language identification: sparse multinomial regression on TF-IDF character n-grams.

Texts are lower-cased, what isn't a letter becomes one space, and n-grams of one to three
characters are counted in hashed buckets.  Document frequencies cover every document that
may teach; the weights are learned by follow-the-regularised-leader with L1 and L2
penalties on a bounded sample of labelled rows (``max_docs`` a language, texts of at most
``max_chars``), and a temperature is fitted on rows of the sample kept apart.  Prediction
reads whole texts, a stretch at a time.

Defined cases: a null text and one without a letter are ``und`` with score 0; with no
labelled row every text is ``und``; rows with a null lang or doc_id teach nothing but the
latter's frequencies; of rows that share doc_id and lang the smallest text teaches; repeated rows and extra
columns pass through, columns named lang_pred and lang_score are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import crc32_mod

BUCKETS = 1 << 15
PARTS = 256  # of each language while its sample is ranked
STRETCH = 1 << 20
UNKNOWN = "und"


@lru_cache(maxsize=1)
def letters() -> np.ndarray:
    return np.array([chr(i).isalpha() for i in range(0x110000)])


def gram_counts(text: str | None) -> np.ndarray | None:
    """Counts by bucket; None for a text without a letter."""
    lowered = (text or "").lower()
    counts = np.zeros(BUCKETS, dtype=np.int64)
    some = False
    for at in range(0, len(lowered), STRETCH):
        piece = lowered[max(0, at - 2) : at + STRETCH]
        points = np.frombuffer(piece.encode("utf-32-le", "replace"), dtype=np.uint32)
        letter = letters()[points]
        some = some or bool(letter.any())
        points = np.where(letter, points, np.uint32(32))
        keep = np.ones(len(points), dtype=bool)
        keep[1:] = letter[1:] | letter[:-1]
        points = points[keep]
        one = points * np.uint32(0x9E3779B1)
        two = (one[:-1] ^ (points[1:] + np.uint32(0x7F4A7C15))) * np.uint32(0x85EBCA6B)
        three = (two[:-1] ^ (points[2:] + np.uint32(0x165667B1))) * np.uint32(0xC2B2AE35)
        for grams in (one, two, three):
            counts += np.bincount(grams >> np.uint32(17), minlength=BUCKETS)
    return counts if some else None


@dataclass
class Model:
    langs: list[str]
    idf: np.ndarray
    weights: np.ndarray = field(default_factory=lambda: np.zeros((0, BUCKETS)))
    bias: np.ndarray = field(default_factory=lambda: np.zeros(0))
    temperature: float = 1.0

    def vector(self, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        at = np.flatnonzero(counts)
        values = np.log1p(counts[at]) * self.idf[at]
        return at.astype(np.int32), (values / max(1e-12, float(np.sqrt(values @ values)))).astype(np.float32)

    def logits(self, counts: np.ndarray) -> np.ndarray:
        at, values = self.vector(counts)
        return self.weights[:, at] @ values + self.bias

    def predict(self, text: str | None) -> tuple[str, float]:
        counts = gram_counts(text)
        if counts is None or not self.langs:
            return UNKNOWN, 0.0
        p = softmax(self.logits(counts) / self.temperature)
        best = int(p.argmax())
        return self.langs[best], float(p[best])


def softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(-1, keepdims=True))
    return e / e.sum(-1, keepdims=True)


def learn(
    texts: list[str],
    langs: list[str],
    idf: np.ndarray,
    alpha: float = 0.5,
    beta: float = 1.0,
    l1: float = 0.02,
    l2: float = 0.02,
    epochs: int = 3,
) -> Model:
    """FTRL-proximal on four fifths of the rows, the temperature on the rest."""
    model = Model(sorted(set(langs)), idf)
    rows = [
        (model.vector(counts), model.langs.index(lang))  # sparse: dense counts would not fit for all rows
        for text, lang in zip(texts, langs)
        if (counts := gram_counts(text)) is not None
    ]
    if not rows:
        return Model([], idf)
    kept = rows[::5] if len(rows) >= 20 else rows
    taught = [r for i, r in enumerate(rows) if i % 5] if len(rows) >= 20 else rows
    classes = len(model.langs)
    z, n = np.zeros((classes, BUCKETS + 1)), np.zeros((classes, BUCKETS + 1))
    rng = np.random.default_rng(0)

    def weights(zs: np.ndarray, ns: np.ndarray) -> np.ndarray:
        shrunk = np.sign(zs) * np.maximum(np.abs(zs) - l1, 0)
        return -shrunk / ((beta + np.sqrt(ns)) / alpha + l2)

    for _ in range(epochs):
        for i in rng.permutation(len(taught)):
            (at, values), y = taught[i]
            at, values = np.append(at, BUCKETS), np.append(values, 1.0)
            w = weights(z[:, at], n[:, at])
            p = softmax(w @ values)
            p[y] -= 1
            g = p[:, None] * values
            step = (np.sqrt(n[:, at] + g * g) - np.sqrt(n[:, at])) / alpha
            z[:, at] += g - step * w
            n[:, at] += g * g
    w = weights(z, n)
    model.weights, model.bias = w[:, :-1].copy(), w[:, -1].copy()
    logits = np.array([model.weights[:, at] @ values + model.bias for (at, values), _ in kept])
    truth = np.array([y for _, y in kept])

    def loss(t: float) -> float:
        return float(-np.log(softmax(logits / t)[np.arange(len(truth)), truth] + 1e-12).mean())

    model.temperature = min(np.geomspace(0.5, 5, 40), key=loss)
    return model


def document_frequencies(docs: DataFrame) -> tuple[np.ndarray, int]:
    """Of each bucket over all ``docs``, and the number of documents with a letter."""

    def partial(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        found, total = np.zeros(BUCKETS, dtype=np.int64), 0
        for batch in batches:
            for text in batch["text"]:
                counts = gram_counts(text)
                if counts is not None:
                    found += counts > 0
                    total += 1
        at = np.flatnonzero(found)
        yield pd.DataFrame({"bucket": np.append(at, -1), "df": np.append(found[at], total)}).astype(
            {"bucket": "int32", "df": "int64"}
        )

    sums = docs.select("text").mapInPandas(partial, "bucket int, df long").groupBy("bucket").agg(F.sum("df").alias("df"))
    out, total = np.zeros(BUCKETS, dtype=np.int64), 0
    for row in sums.collect():  # at most BUCKETS + 1 rows
        if row["bucket"] < 0:
            total = row["df"]
        else:
            out[row["bucket"]] = row["df"]
    return out, total


def train(docs: DataFrame, learn_from: Column, max_docs: int = 600, max_chars: int = 20_000) -> Model:
    from pyspark.sql import Window

    may = docs.filter(learn_from & F.col("lang").isNotNull())
    df, total = document_frequencies(may)
    idf = np.log((1 + total) / (1 + df)) + 0.05
    order = [F.xxhash64("doc_id"), F.col("doc_id")]
    first = F.row_number().over(Window.partitionBy("lang", "_salt").orderBy(*order))  # a hot language in parts
    then = F.row_number().over(Window.partitionBy("lang").orderBy(*order))
    ids = (
        may.filter((F.char_length("text") <= max_chars) & F.col("lang").isNotNull() & F.col("doc_id").isNotNull())
        .select("doc_id", "lang", F.pmod(F.xxhash64(F.lit(1), F.col("doc_id")), F.lit(PARTS)).alias("_salt"))
        .withColumn("_n", first)
        .filter(F.col("_n") <= max(4, 4 * max_docs // PARTS))  # four times a part's share, so that few rows meet below
        .withColumn("_n", then)
        .filter(F.col("_n") <= max_docs)
        .select("doc_id")
        .distinct()
    )
    rows = (
        may.filter((F.char_length("text") <= max_chars) & F.col("lang").isNotNull())
        .select("doc_id", "text", "lang")
        .join(F.broadcast(ids), "doc_id")  # max_docs a language
        .groupBy("doc_id", "lang")
        .agg(F.min("text").alias("text"))
        .orderBy(F.xxhash64("doc_id", "lang"), "doc_id", "lang")
        .toPandas()
    )
    return learn(rows["text"].tolist(), rows["lang"].tolist(), idf)


def identify(
    docs: DataFrame, learn_from: Column | None = None, max_docs: int = 600, model: Model | None = None
) -> DataFrame:
    """``docs`` with lang_pred and lang_score, by ``model`` where one is given."""
    may = F.lit(True) if learn_from is None else learn_from
    model = model or train(docs, may, max_docs)
    shared = docs.sparkSession.sparkContext.broadcast(model)  # languages x BUCKETS weights

    @F.pandas_udf("struct<lang: string, score: double>")
    def predict(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            yield pd.DataFrame([shared.value.predict(t) for t in texts], columns=["lang", "score"])

    named = docs.withColumn("_said", predict("text"))
    return (
        named.withColumn("lang_pred", F.col("_said.lang")).withColumn("lang_score", F.col("_said.score")).drop("_said")
    )


def op10_language_id(docs: DataFrame) -> DataFrame:
    held_out = F.coalesce(crc32_mod(F.col("doc_id"), 4) == 2, F.lit(False))
    found = identify(docs.select("doc_id", "text", "lang"), learn_from=~held_out)
    return found.select("doc_id", held_out.alias("held_out"), "lang_pred", F.col("lang_score").alias("score"))
