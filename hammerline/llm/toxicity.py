"""Toxicity by compression distance: two zstandard dictionaries, one threshold model.

Both dictionaries hold the same stretch of ordinary text.  One goes on with text learned
from toxic documents, the other with as much learned from ordinary ones, so the lengths to
which they compress a window differ only where a window repeats what one class says and
the other does not.  A window is a word between two constant frames that both dictionaries
hold, so that the costs of a block cancel.  What a class says is chosen on a first half of
a bounded sample of labelled rows: words met in many different contexts there (so that
copies of one document don't count) and hardly ever in the other class.  The second half
calibrates: thresholds on the length difference and their weights come from a logistic
fit on windows that the dictionaries have not seen.

``max_toxic``, ``max_ordinary`` and ``max_chars`` bound the sample; the shared stretch takes the same share of
each ordinary text of the first half, from its start, and words of over 60 bytes say nothing of a class; these
bounds are those of the fit, scoring reads whole texts.

Defined cases: null and empty texts have no window and get the calibrated score of that;
labels repeated for a document count once, as toxic if any is; of rows that share a doc_id the smallest text teaches; labels without a document
and null labels teach nothing; without both classes every score is the share of toxic
labels (0 without labels); repeated rows and extra columns pass through, a column named score is replaced;
very long texts take time in proportion to their words.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import crc32_mod

FRAME = b"#" * 12
STEPS = np.arange(2, 9)
LEVEL = 6
MEMO = 200_000


def words_of(text: str | None) -> list[bytes]:
    return (text or "").lower().encode("utf-8", "replace").split()


@dataclass
class Model:
    toxic: bytes
    ordinary: bytes
    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray  # the last is the constant
    floor: float | None = None

    def compressors(self):
        import zstandard

        def own(data: bytes):
            return zstandard.ZstdCompressor(
                level=LEVEL,
                dict_data=zstandard.ZstdCompressionDict(data, dict_type=zstandard.DICT_TYPE_RAWCONTENT),
                write_checksum=False,
                write_content_size=False,
                write_dict_id=False,
            )

        return own(self.ordinary), own(self.toxic)

    def reader(self):
        """A function from a text to its features; it remembers frequent windows."""
        ordinary, toxic = self.compressors()
        memo: dict[bytes, int] = {}

        def difference(word: bytes) -> int:
            found = memo.get(word)
            if found is None:
                window = FRAME + b" " + word + b" " + FRAME
                found = len(ordinary.compress(window)) - len(toxic.compress(window))
                if len(memo) >= MEMO:
                    memo.clear()
                memo[word] = found
            return found

        def features(text: str | None) -> np.ndarray:
            words = words_of(text)
            apart = np.fromiter(map(difference, words), dtype=np.int64, count=len(words))
            reach = (apart[:, None] >= STEPS).sum(0) if len(words) else np.zeros(len(STEPS))
            return np.concatenate((reach / (len(words) + 20) * 20, np.log1p(reach)))

        return features

    def score(self, features: np.ndarray) -> np.ndarray:
        if self.floor is not None:
            return np.full(len(features), self.floor)
        return 1 / (1 + np.exp(-np.clip((features - self.mean) / self.scale @ self.weights[:-1] + self.weights[-1], -30, 30)))


def contexts(texts: list[str]) -> Counter:
    """How many different words precede each word."""
    numbers: dict[bytes, int] = {}
    pairs = [np.zeros(0, dtype=np.int64)]
    for text in texts:
        own = np.array([numbers.setdefault(w, len(numbers)) for w in words_of(text)], dtype=np.int64)
        pairs.append(np.unique((own[:-1] << 32) | own[1:]))
    each = np.bincount(np.unique(np.concatenate(pairs)) & 0xFFFFFFFF, minlength=len(numbers))
    return Counter({word: int(each[i]) for word, i in numbers.items() if each[i]})


def telling(own: Counter, other: Counter, ratio: float = 20, least: int = 3, z: float = 4) -> list[bytes]:
    """Words of one class that the other hardly has, the most telling last."""
    n, m = max(1, sum(own.values())), max(1, sum(other.values()))
    scored = []
    for word, k in own.items():
        if k < least or len(word) > 60:
            continue
        there = other.get(word, 0)
        share = (k + there) / (n + m)
        gap = (k / n - there / m) / np.sqrt(share * (1 - share) * (1 / n + 1 / m))
        if gap >= z and k / n >= ratio * (there + 0.5) / m:
            scored.append((gap, word))
    return [word for _, word in sorted(scored)]


def logistic(x: np.ndarray, y: np.ndarray, penalty: float = 0.5, rounds: int = 40) -> np.ndarray:
    design = np.hstack((x, np.ones((len(x), 1))))
    w = np.zeros(design.shape[1])
    ridge = np.full(len(w), penalty)
    ridge[-1] = 1e-3
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(design @ w, -30, 30)))
        pull = design.T @ (p - y) + ridge * w
        bend = (design * (p * (1 - p))[:, None]).T @ design + np.diag(ridge)
        step = np.linalg.solve(bend, pull)
        w -= step * min(1, 5 / (np.abs(step).max() + 1e-12))
    return w


def fit(toxic: list[str], ordinary: list[str], shared_bytes: int = 180_000, own_bytes: int = 8_192) -> Model:
    """Dictionaries from the even rows of each class, thresholds from the odd ones."""
    total = len(toxic) + len(ordinary)
    if len(toxic) < 2 or len(ordinary) < 2:
        share = len(toxic) / total if total else 0.0
        return Model(b"", b"", np.zeros(0), np.ones(0), np.zeros(1), share)
    bad, good = contexts(toxic[::2]), contexts(ordinary[::2])
    said = b" ".join(telling(bad, good))[-own_bytes:]
    rng = np.random.default_rng(0)
    names = sorted(good)
    plain = b" ".join(names[i] for i in rng.permutation(len(names))[: len(said) // 2 + 1])[: len(said)]
    stretches = [" ".join(words) for text in ordinary[::2] if (words := text.lower().split())]
    pieces, room = [], shared_bytes
    for text in stretches:
        piece = text.encode("utf-8", "replace")[: max(64, shared_bytes // max(1, len(stretches)))]
        pieces.append(piece[:room])
        room -= len(pieces[-1])
        if room <= 0:
            break
    base = b" ".join(pieces)
    model = Model(
        base + b" " + said + b" " + FRAME, base + b" " + plain + b" " + FRAME, np.zeros(1), np.ones(1), np.zeros(1)
    )
    read = model.reader()
    x = np.array([read(t) for t in [*toxic[1::2], *ordinary[1::2]]])
    y = np.array([1.0] * len(toxic[1::2]) + [0.0] * len(ordinary[1::2]))
    model.mean, model.scale = x.mean(0), x.std(0) + 1e-3
    model.weights = logistic((x - model.mean) / model.scale, y)
    return model


def sample(docs: DataFrame, labels: DataFrame, max_toxic: int, max_ordinary: int, max_chars: int) -> Model:
    """A model from at most so many labelled documents, the first by a hash of their ids."""
    known = (
        labels.filter("toxic IS NOT NULL AND doc_id IS NOT NULL")
        .groupBy("doc_id")
        .agg(F.max("toxic").alias("toxic"))
        .withColumn("_h", F.xxhash64("doc_id"))
    )
    ids = (
        known.filter("toxic = 1").orderBy("_h").limit(max_toxic)
        .unionByName(known.filter("toxic = 0").orderBy("_h").limit(max_ordinary))
        .select("doc_id", "toxic")
    )
    rows = (
        docs.filter((F.char_length("text") <= max_chars) & F.col("doc_id").isNotNull())
        .select("doc_id", "text")
        .join(F.broadcast(ids), "doc_id")  # at most max_toxic + max_ordinary ids
        .groupBy("doc_id", "toxic")
        .agg(F.min("text").alias("text"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(max_toxic + max_ordinary)
        .toPandas()
    )
    return fit(rows["text"][rows["toxic"] == 1].tolist(), rows["text"][rows["toxic"] == 0].tolist())


def score_documents(
    docs: DataFrame,
    labels: DataFrame,
    learn_from: Column | None = None,
    max_toxic: int = 2_500,
    max_ordinary: int = 7_500,
    max_chars: int = 20_000,
) -> DataFrame:
    """``docs`` with the column score; ``learn_from`` says which labelled rows may teach."""
    usable = labels if learn_from is None else labels.filter(learn_from)
    model = sample(docs, usable, max_toxic, max_ordinary, max_chars)
    shared = docs.sparkSession.sparkContext.broadcast(model)  # two dictionaries of fixed size

    @F.pandas_udf("double")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        read = shared.value.reader() if shared.value.floor is None else (lambda text: np.zeros(0))
        for texts in batches:
            yield pd.Series(shared.value.score(np.array([read(t) for t in texts])), dtype=float)

    return docs.withColumn("score", score("text"))


def op2_toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    held_out = F.coalesce(crc32_mod(F.col("doc_id"), 5) == 0, F.lit(False))
    scored = score_documents(docs.select("doc_id", "text"), labels, learn_from=~held_out)
    return scored.select(
        "doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted")
    )
