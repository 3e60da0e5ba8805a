"""Packing token sequences by length patterns found with non-negative least squares.

Every document is tokenized whole and cut, if it is longer than a sequence, into a
first piece and full ones.  Only the histogram of piece lengths reaches the driver: one
count for each length up to the sequence length, however large the corpus.  Patterns of
one, two or three lengths that fill a sequence exactly are enumerated, their repeat
counts fitted to the histogram by non-negative least squares, rounded down, and what
remains is packed by best fit, still on the histogram.  A piece then finds its place from
its length and its rank among pieces of that length; ranks are made from salted counts so
that a length that a third of all pieces share is not ranked in one task.

Defined cases: null text is empty; an empty text holds the end token only; rows that repeat, or
share or lack a doc_id, are packed each; a very long text becomes many pieces; which of equally long
pieces gets which place is left open; an empty table gives an empty result; extra columns are left out.
"""

from __future__ import annotations

import base64
import json
import os
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import stage

END_ID = 2
PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken")


@lru_cache(maxsize=2)
def encoder(path: str):
    """The byte-level BPE whose ranks lie at ``path``, with the added tokens of the tokenizers
    form beside it; ids equal those of that form (tests compare the two)."""
    import public_tokenizers
    import tiktoken

    with open(path, "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    added, beside = {}, f"{os.path.splitext(path)[0]}.json"
    if os.path.exists(beside):
        with open(beside, encoding="utf-8") as form:
            added = {t["content"]: t["id"] for t in json.load(form).get("added_tokens", [])}
    return tiktoken.Encoding(
        os.path.basename(path), pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens=added
    )


@lru_cache(maxsize=2)
def plain_form(path: str):
    """The tokenizers form of the vocabulary at ``path``, which lies beside it."""
    from tokenizers import Tokenizer

    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    return Tokenizer.from_file(f"{os.path.splitext(path)[0]}.json")


def token_ids(path: str, text: str) -> list[int]:
    """The ids of a text.  The faster form's pattern gives up on runs of about a million blanks; such a text
    goes to the tokenizers form, whose ids are the same."""
    try:
        return encoder(path).encode(text, allowed_special="all")
    except ValueError:
        return plain_form(path).encode(text, add_special_tokens=False).ids


def cut(length: int, limit: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces: only the first may be shorter than ``limit``."""
    if length <= limit:
        return [(0, length)]
    first = length % limit or limit
    return [(0, first), *((at, limit) for at in range(first, length, limit))]


def tokenize(
    docs: DataFrame, vocabulary: str | None = None, limit: int = 1024, end_id: int = END_ID, keep_ids: bool = False
) -> DataFrame:
    """Pieces of every document; ``keep_ids`` adds their token ids (array<int>)."""
    path = vocabulary or default_vocabulary()

    def pieces(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for doc_id, text in zip(batch["doc_id"], batch["text"]):
                ids = token_ids(path, text or "")
                ids.append(end_id)
                packed = np.array(ids, dtype="<u4")
                for number, (start, length) in enumerate(cut(len(ids), limit)):
                    own = packed[start : start + length]
                    row = (doc_id, number, start, length, zlib.crc32(own.tobytes()))
                    out.append((*row, own.astype("int32")) if keep_ids else row)
            names = [c.split()[0] for c in PIECES.split(", ")] + ["ids"] * keep_ids
            frame = pd.DataFrame(out, columns=names)
            yield frame.astype({"piece": "int32", "doc_id": "Int64"})

    small = docs.select("doc_id", "text")
    return small.mapInPandas(pieces, PIECES + ", ids array<int>" * keep_ids)


def patterns(limit: int) -> np.ndarray:
    """Every way to fill ``limit`` with one, two or three lengths: rows of three, 0 for none."""
    rows = [np.array([[limit, 0, 0]])]
    half = np.arange(1, limit // 2 + 1)
    rows.append(np.stack([limit - half, half, np.zeros_like(half)], 1))
    for third in range(1, limit // 3 + 1):
        second = np.arange(third, (limit - third) // 2 + 1)
        rows.append(np.stack([limit - third - second, second, np.full_like(second, third)], 1))
    return np.concatenate(rows)


def fit(counts: np.ndarray, ways: np.ndarray, rounds: int = 400) -> np.ndarray:
    """min |A x - counts|, x >= 0, by accelerated projected gradient; A has up to three
    ones a column, so both products are gathers and scatters."""
    limit = len(counts) - 1
    goal = counts.astype(float)
    goal[0] = 0

    def forward(x: np.ndarray) -> np.ndarray:
        out = sum(np.bincount(ways[:, j], weights=x, minlength=limit + 1) for j in range(3))
        out[0] = 0
        return out

    def back(r: np.ndarray) -> np.ndarray:
        return r[ways].sum(1)

    probe = np.ones(len(ways))
    for _ in range(30):
        probe = back(forward(probe))
        top = np.linalg.norm(probe)
        probe /= top
    x = momentum = np.zeros(len(ways))
    speed = 1.0
    for _ in range(rounds):
        residual = forward(momentum) - goal
        residual[0] = 0
        ahead = np.maximum(0, momentum - back(residual) / (top * 1.01))
        faster = (1 + np.sqrt(1 + 4 * speed * speed)) / 2
        momentum = ahead + (speed - 1) / faster * (ahead - x)
        x, speed = ahead, faster
    return x


def best_fit(left: np.ndarray, limit: int) -> list[tuple[list[int], int]]:
    """Fills a sequence with the largest lengths that fit and repeats it until one of its
    lengths is used up, so there are at most ``limit`` rounds whatever the counts."""
    chosen = []
    while left.any():
        lengths: list[int] = []
        room, spare = limit, left.copy()
        while room > 0 and len(fitting := np.flatnonzero(spare[: room + 1])):
            lengths.append(int(fitting[-1]))
            spare[fitting[-1]] -= 1
            room -= lengths[-1]
        chosen.append((lengths, take(left, lengths, 2**62)))
    return chosen


def take(left: np.ndarray, lengths: list[int], most: int) -> int:
    """Uses a pattern up to ``most`` times; returns how often."""
    repeats = int(min(most, *(left[v] // lengths.count(v) for v in lengths)))
    for v in lengths:
        left[v] -= repeats
    return repeats


def plan(counts: np.ndarray, limit: int) -> list[tuple[list[int], int]]:
    """(lengths, repeats) that use up the histogram exactly.

    Patterns of up to two and of up to three lengths are fitted, each fit is rounded down
    and completed by best fit; the plan with fewer sequences is taken."""
    full = counts.astype(np.int64).copy()
    full[0] = 0
    plans = []
    every = patterns(limit)[1:]
    for ways in (every[every[:, 2] == 0], every):
        left = full.copy()
        chosen = [([limit], take(left, [limit], 2**62))] if left[limit] else []
        for _ in range(2):
            ways = ways[((left[ways] > 0) | (ways == 0)).all(1)]
            if not len(ways):
                break
            x = fit(left, ways)
            for i in np.argsort(-x, kind="stable")[: int((x >= 1).sum())]:
                lengths = [int(v) for v in ways[i] if v]
                if repeats := take(left, lengths, int(x[i])):
                    chosen.append((lengths, repeats))
        plans.append(chosen + best_fit(left, limit))
    return min(plans, key=lambda p: sum(r for _, r in p))


def slots(chosen: list[tuple[list[int], int]]) -> dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """For each length: first rank, first sequence and offset of each of its places."""
    found: dict[int, list[tuple[int, int, int]]] = {}
    ranks: dict[int, int] = {}
    sequence = 0
    for lengths, repeats in chosen:
        offset = 0
        for length in lengths:
            found.setdefault(length, []).append((ranks.get(length, 0), sequence, offset))
            ranks[length] = ranks.get(length, 0) + repeats
            offset += length
        sequence += repeats
    return {k: tuple(np.array(v, dtype=np.int64).T) for k, v in found.items()}


def pack(pieces: DataFrame, limit: int = 1024) -> DataFrame:
    """Adds sequence_id and offset to ``pieces`` (length and any other columns), which are staged with a number each."""
    from pyspark.sql import Window

    spark = pieces.sparkSession
    pieces = stage(pieces.withColumn("_row", F.monotonically_increasing_id()), "pieces")
    counts = np.zeros(limit + 1, dtype=np.int64)
    for row in pieces.groupBy("length").count().collect():  # at most `limit` rows
        counts[row["length"]] = row["count"]
    places = spark.sparkContext.broadcast(slots(plan(counts, limit)))
    share = max(1000, int(counts.sum()) // 10_000)  # so at most 10,000 salts beyond one a length
    parts = np.maximum(1, -(-counts // share))
    many = [(int(n), int(parts[n])) for n in np.flatnonzero(parts > 1)]
    salts = F.lit(1)
    if many:
        lookup = F.create_map(*[F.lit(v) for pair in many for v in pair])
        salts = F.coalesce(F.try_element_at(lookup, F.col("length").cast("int")), F.lit(1))
    salted = pieces.withColumn("_salt", F.pmod(F.xxhash64("_row"), salts))
    before: dict[int, int] = {}
    starts = {}
    found = salted.groupBy("length", "_salt").count().collect()  # bounded, see share
    for row in sorted(found, key=lambda r: (r["length"], r["_salt"])):
        starts[row["length"], row["_salt"]] = before.get(row["length"], 0)
        before[row["length"]] = before.get(row["length"], 0) + row["count"]
    firsts = spark.sparkContext.broadcast(starts)
    within = F.row_number().over(Window.partitionBy("length", "_salt").orderBy("_row")) - 1

    @F.pandas_udf("struct<sequence_id: long, offset: long>")
    def place(length: pd.Series, salt: pd.Series, rank: pd.Series) -> pd.DataFrame:
        n = length.to_numpy()
        place_in = rank.to_numpy() + np.array(
            [firsts.value[k] for k in zip(n.tolist(), salt.tolist())], dtype=np.int64
        )
        out = np.zeros((len(n), 2), dtype=np.int64)
        for value in np.unique(n):
            rows = np.flatnonzero(n == value)
            rank_from, sequence, offset = places.value[int(value)]
            at = np.searchsorted(rank_from, place_in[rows], side="right") - 1
            out[rows, 0] = sequence[at] + place_in[rows] - rank_from[at]
            out[rows, 1] = offset[at]
        return pd.DataFrame({"sequence_id": out[:, 0], "offset": out[:, 1]})

    ranked = salted.withColumn("_rank", within.cast("long"))
    return (
        ranked.withColumn("_at", place("length", "_salt", "_rank"))
        .withColumn("sequence_id", F.col("_at.sequence_id"))
        .withColumn("offset", F.col("_at.offset"))
        .drop("_row", "_salt", "_rank", "_at")
    )


def pack_documents(
    docs: DataFrame, limit: int = 1024, vocabulary: str | None = None, keep_ids: bool = False
) -> DataFrame:
    return pack(tokenize(docs, vocabulary, limit, keep_ids=keep_ids), limit)


def op3_best_fit_packing(docs: DataFrame) -> DataFrame:
    return pack_documents(docs)
