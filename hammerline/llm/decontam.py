"""Benchmark decontamination by latent semantic retrieval.

Passages are TF-IDF vectors over the words of the benchmark, weighted by inverse document
frequencies over the whole corpus.  A randomised SVD, whose products Spark sums over the
passages, fits the latent space on all passages of the corpus, added up under random signs
in ``passage_sums`` rows (``survey``), and on the passages of the
benchmark, the corpus's together carrying ``corpus_share`` of the weight; the space has far
fewer dimensions than words, and fewer than passages from some 85 items on.  The
benchmark's passages are then folded in.  Every document is cut into overlapping windows,
one size for each class of passage lengths, wide enough that a passage lies whole in one of
them; a window's latent vector comes from running sums, and its product with a passage's
latent direction, against the full norm of the window (words outside the benchmark
included), is the cosine.  A window is a candidate from ``cosine`` on, and also if the product
is a share ``coverage`` of the passage's own norm: where thousands of copies have made the
words of a leaked passage frequent, rarer words around it would drown the cosine.  Candidates
are verified on the words: the longest common subsequence must cover ``overlap`` of the
passage and ``answer`` of its last quarter.

The benchmark is taken in blocks of ``block_items`` passages with a latent space each, and
``pass_items`` passages are searched in one reading of the corpus, after one that counts words
and adds up passages; so what a task holds is bounded however long the benchmark grows.

Defined cases: null and empty texts leak nothing; items without words are never found;
items of fewer than ``SHORT`` words are found only as a whole run of words; items longer than
``passage_words`` are cut into parts of even length, and what a document has of all parts together must
cover ``overlap`` of the item and ``answer`` of its last quarter; rows that repeat a doc_id are judged
each and give one result; a null doc_id gives a result with a null id; very long texts are read in
stretches; an empty corpus or benchmark gives an empty result; other columns are not read.
"""

from __future__ import annotations

import hashlib
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import stage

STEP = 8
CHUNK = 40_000  # words searched at once
FIT_WORDS = 64  # of a passage of the corpus
SHORT = 8  # items of fewer words must stand as they are
SIZES = (16, 24, 32, 48, 64, 96, 128)
RESULT = "doc_id long, item_id long, cosine double, overlap double, answer double"
PART = "doc_id long, text_md5 string, item_id long, item int, part int, cosine double, shared int, kept int, whole int, tail int"


@dataclass
class Part:
    """A passage of the benchmark: an item, or one of the parts of a long one."""

    item_id: int
    words: list[str]
    item: int  # number of the row of the benchmark, as item_id may repeat
    number: int  # of the part
    whole: int  # words of the item
    tail: int  # words of the item's last quarter
    own_tail: int  # of those, the ones in this part


def parts_of(item_id: int, words: list[str], longest: int, item: int = 0) -> list[Part]:
    """Parts of even length of at most ``longest`` words."""
    count, tail = -(-len(words) // longest), max(1, len(words) // 4)
    edges = [len(words) * i // count for i in range(count + 1)] if count else []
    return [
        Part(item_id, words[a:b], item, number, len(words), tail, max(0, b - max(a, len(words) - tail)))
        for number, (a, b) in enumerate(zip(edges, edges[1:]))
    ]


def text_key(text: str | None) -> str:
    """As Spark's md5 of the text."""
    return hashlib.md5((text or "").encode("utf-8", "surrogatepass"), usedforsecurity=False).hexdigest()


def words_of(text: str | None) -> list[str]:
    text = (text or "").lower()
    for mark in ".,;:!?\"()":
        if mark in text:
            text = text.replace(mark, " ")
    return text.split()


def common_length(pattern: dict[str, int], length: int, words: list[str]) -> int:
    """Longest common subsequence, bit-parallel; ``pattern`` maps a word to its places."""
    full = (1 << length) - 1
    state = full
    for word in words:
        places = pattern.get(word)
        if places:
            matched = state & places
            state = ((state + matched) | (state - matched)) & full
    return length - state.bit_count()


def place_bits(words: list[str]) -> dict[str, int]:
    bits: dict[str, int] = {}
    for i, word in enumerate(words):
        bits[word] = bits.get(word, 0) | (1 << i)
    return bits


def survey(docs: DataFrame, vocabulary: frozenset[str], passage_sums: int, task_cells: int) -> tuple[dict[str, int], int, DataFrame]:
    """Documents of the corpus that hold each word of the vocabulary, all documents, and a sketch of all passages of the
    corpus: each passage's words, with a random sign, are added to one of ``passage_sums`` rows (columns words and sums), so that
    for passages x words A and rows S A the products (S A)'(S A) are those of A'A by expectation (count sketch).  Signs and
    rows come from a hash of doc_id, text and place, sums are whole numbers: the same in any order.  A task
    holds ``task_cells`` thousand sums before it passes them on."""
    names = sorted(vocabulary)
    shared = docs.sparkSession.sparkContext.broadcast({w: i for i, w in enumerate(names)})
    width = max(1, len(names))

    def partial(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        places = shared.value
        known = places.keys()
        counts: Counter = Counter()
        cells, sums = np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
        rows: list[int] = []  # of passages that wait: row x width, sign, how many words; and their words
        signs: list[int] = []
        lengths: list[int] = []
        at_words: list[int] = []
        total = 0

        def summed() -> None:
            nonlocal cells, sums
            own = np.array(at_words, dtype=np.int64) + np.repeat(np.array(rows, dtype=np.int64), lengths)
            signed = np.repeat(np.array(signs, dtype=np.int64), lengths)
            cells, back = np.unique(np.concatenate((cells, own)), return_inverse=True)
            sums = np.bincount(back, weights=np.concatenate((sums, signed)), minlength=len(cells)).astype(np.int64)
            for waiting in (rows, signs, lengths, at_words):
                waiting.clear()

        def passed() -> pd.DataFrame:
            cut = np.flatnonzero(np.diff(cells // width, prepend=-1))
            words, values = np.split((cells % width).astype(np.int32), cut[1:]), np.split(sums, cut[1:])
            return pd.DataFrame({"word": None, "n": 0, "row": cells[cut] // width, "words": [w.tobytes() for w in words], "sums": [v.tobytes() for v in values]})

        for batch in batches:
            for doc_id, text in zip(batch["doc_id"], batch["text"]):
                words = words_of(text)
                total += 1
                counts.update(known & set(words))
                first = zlib.crc32((text or "").encode("utf-8", "surrogatepass")) + (0 if pd.isna(doc_id) else int(doc_id)) * 0x27D4EB2F165667C5
                for at in range(0, len(words), FIT_WORDS):
                    own = [places[w] for w in set(words[at : at + FIT_WORDS]) if w in places]
                    if own:
                        h = (first + at * 0x9E3779B97F4A7C15 + 1) & 0xFFFFFFFFFFFFFFFF
                        h = ((h ^ (h >> 31)) * 0xBF58476D1CE4E5B9) & 0xFFFFFFFFFFFFFFFF
                        h = ((h ^ (h >> 29)) * 0x94D049BB133111EB) & 0xFFFFFFFFFFFFFFFF
                        rows.append((h >> 16) % passage_sums * width)
                        signs.append(1 if h >> 63 else -1)
                        lengths.append(len(own))
                        at_words += own
                if len(at_words) >= 500_000:
                    summed()
                    if len(cells) > 1000 * task_cells:
                        yield passed()
                        cells, sums = cells[:0], sums[:0]
        counts[""] = total
        yield pd.DataFrame({"word": list(counts), "n": np.array(list(counts.values()), dtype=np.int64), "row": 0, "words": None, "sums": None})
        summed()
        if len(cells):
            yield passed()

    seen = stage(docs.select("doc_id", "text").mapInPandas(partial, "word string, n long, row long, words binary, sums binary"), "survey")
    totals = seen.filter("word IS NOT NULL").groupBy("word").agg(F.sum("n").alias("n"))
    found = {r["word"]: r["n"] for r in totals.collect()}  # at most one row a word of the vocabulary

    def added(frame: pd.DataFrame) -> pd.DataFrame:
        words, back = np.unique(np.frombuffer(b"".join(frame["words"]), np.int32), return_inverse=True)
        values = np.bincount(back, weights=np.frombuffer(b"".join(frame["sums"]), np.int64)).astype(np.int64)
        return pd.DataFrame({"row": frame["row"].iloc[:1], "words": [words[values != 0].tobytes()], "sums": [values[values != 0].tobytes()]})

    # what tasks have of a row is added in four groups, then these; a task has at most a number a word of it
    sums = "row long, words binary, sums binary"
    each = seen.filter("word IS NULL").select("row", "words", "sums", F.pmod(F.hash("words", "sums"), F.lit(4)).alias("some"))
    whole = each.groupBy("row", "some").applyInPandas(added, sums).groupBy("row").applyInPandas(added, sums)

    def named(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        back = sorted(shared.value)
        for batch in batches:
            words = [[back[i] for i in np.frombuffer(own, np.int32)] for own in batch["words"]]
            yield pd.DataFrame({"words": words, "sums": [np.frombuffer(own, np.int64) for own in batch["sums"]]})

    sketch = whole.select("words", "sums").mapInPandas(named, "words array<string>, sums array<long>")
    return found, found.pop("", 0), stage(sketch, "passages")


def randomised_svd(passages: DataFrame, terms: int, rank: int, seed: int = 0) -> np.ndarray:
    """Orthonormal latent directions (terms x rank) of the sparse rows (at, value).

    Each round Spark sums A'(A M) over the rows, by blocks of terms."""
    spark = passages.sparkSession
    rng = np.random.default_rng(seed)

    def product(matrix: np.ndarray) -> np.ndarray:
        shared = spark.sparkContext.broadcast(matrix)

        def partial(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            total = np.zeros_like(shared.value)
            for batch in batches:
                for at, value in zip(batch["at"], batch["value"]):
                    at, value = np.asarray(at, dtype=np.int64), np.asarray(value)
                    total[at] += value[:, None] * (value @ shared.value[at])[None, :]
            blocks = [(b, total[b : b + 512].tobytes()) for b in range(0, terms, 512)]
            yield pd.DataFrame(blocks, columns=["block", "data"])

        def add(frame: pd.DataFrame) -> pd.DataFrame:
            parts = [np.frombuffer(x) for x in frame["data"]]
            return pd.DataFrame({"block": frame["block"].iloc[:1], "data": [np.sum(parts, axis=0).tobytes()]})

        schema = "block long, data binary"
        sums = passages.mapInPandas(partial, schema).groupBy("block").applyInPandas(add, schema).collect()
        out = np.zeros_like(matrix)
        for row in sums:
            own = np.frombuffer(row["data"]).reshape(-1, matrix.shape[1])
            out[row["block"] : row["block"] + len(own)] = own
        return out

    basis, _ = np.linalg.qr(product(rng.standard_normal((terms, min(terms, rank + 8)))))
    basis, _ = np.linalg.qr(product(basis))
    energy, turn = np.linalg.eigh(basis.T @ product(basis))
    order = np.argsort(-energy)[:rank]
    order = order[energy[order] > 1e-9 * max(energy.max(initial=0), 1e-12)]
    return basis @ turn[:, order]


@dataclass
class Index:
    """A block of passages, ready to be searched."""

    parts: list[Part]
    targets: list[tuple[dict[str, int], int, dict[str, int], int]]  # word places, length; of the last quarter too
    vocabulary: dict[str, int]
    project: np.ndarray  # weight x latent direction of each word, then of one outside and of nothing
    weights: np.ndarray  # squared weights likewise
    classes: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]]  # window size: passages, unit latent vectors, norms

    def find(self, texts: list[str | None], cosine: float, coverage: float, overlap: float, answer: float) -> list[tuple]:
        """(number of the text, item, cosine, overlap, answer) of what is found in the texts of items in one part."""
        every = self.find_parts(texts, cosine, coverage, overlap, answer)
        return [
            (number, self.parts[which].item_id, score, shared / self.parts[which].whole, kept / self.parts[which].tail)
            for number, which, score, shared, kept in every
            if len(self.parts[which].words) == self.parts[which].whole
        ]

    def find_parts(
        self, texts: list[str | None], cosine: float, coverage: float, overlap: float, answer: float
    ) -> list[tuple[int, int, float, int, int]]:
        """(number of the text, passage, cosine, words shared, of these in the item's last quarter): passages that
        are whole items if they are found, parts of longer items whatever they share."""
        found: dict[tuple[int, int], tuple[float, int, int]] = {}
        chunk: list[tuple[int, list[str]]] = []
        held = 0
        for number, text in enumerate(texts):
            words = words_of(text)
            # a long document is read in stretches that overlap by the widest window
            for at in range(0, len(words), CHUNK):
                chunk.append((number, words[at : at + CHUNK + SIZES[-1] + 2 * STEP]))
                held += len(chunk[-1][1])
                if held >= CHUNK:
                    self._search(chunk, found, cosine, coverage, overlap, answer)
                    chunk, held = [], 0
        if chunk:
            self._search(chunk, found, cosine, coverage, overlap, answer)
        return [(*key, *scores) for key, scores in found.items()]

    def _search(
        self, chunk: list[tuple[int, list[str]]], found: dict, cosine: float, coverage: float, overlap: float, answer: float
    ) -> None:
        get, outside = self.vocabulary.get, len(self.vocabulary)
        at = np.array([get(w, outside) for _, words in chunk for w in words], dtype=np.int64)
        lengths = np.array([len(words) for _, words in chunk])
        firsts = np.cumsum(lengths) - lengths
        n_steps = -(-lengths // STEP)
        owner = np.repeat(np.arange(len(chunk)), n_steps)
        step = np.arange(len(owner)) - np.repeat(np.cumsum(n_steps) - n_steps, n_steps)
        last = np.cumsum(n_steps)[owner]
        grid = np.full(len(owner) * STEP, outside + 1)  # a row a step, filled up with nothing
        grid[np.arange(len(at)) + np.repeat((np.cumsum(n_steps) - n_steps) * STEP - firsts, lengths)] = at
        grid = grid.reshape(-1, STEP)
        latent = self.project[grid[:, 0]]
        for column in range(1, STEP):
            latent += self.project[grid[:, column]]
        weight = self.weights[grid]
        total = np.concatenate(([0.0], np.cumsum(weight.sum(1))))
        inside = np.concatenate(([0.0], np.cumsum(np.where(grid < outside, weight, 0).sum(1))))
        runs = np.concatenate((np.zeros((1, latent.shape[1]), np.float32), np.cumsum(latent, axis=0)))
        starts = np.arange(len(owner))
        for size, (passages, units, norms) in self.classes.items():
            ends = np.minimum(starts + size // STEP + 1, last)
            norm = np.sqrt(np.maximum(total[ends] - total[starts], 1e-12))
            least = np.minimum(cosine * norm, coverage * norms.min())  # a window's own length bounds every product
            able = np.flatnonzero(inside[ends] - inside[starts] >= (least * 0.999) ** 2 / (size + STEP))
            window = runs[ends[able]] - runs[able]
            near = np.einsum("ij,ij->i", window, window) >= (least[able] * 0.999) ** 2
            able, window = able[near], window[near]
            if not len(able):
                continue
            close = window @ units.T
            need = np.minimum((cosine * norm[able])[:, None], (coverage * norms)[None, :])
            for w, p in zip(*np.nonzero(close >= need)):
                which, score = int(passages[p]), float(close[w, p] / norm[able[w]])
                number, words = chunk[owner[able[w]]]
                start = int(step[able[w]]) * STEP
                part = words[max(0, start - STEP) : start + size + 2 * STEP]
                bits, length, tail_bits, tail = self.targets[which]
                own = self.parts[which]
                alone = own.whole == length
                if own.whole < SHORT and f" {' '.join(own.words)} " not in f" {' '.join(part)} ":
                    continue
                shared = common_length(bits, length, part)
                if alone and shared / length < overlap:
                    continue
                kept = common_length(tail_bits, tail, part)
                if (not alone or kept / tail >= answer) and (shared, kept) > found.get((number, which), (0.0, 0, 0))[1:]:
                    found[number, which] = (score, shared, kept)


def weigh(sketch: DataFrame, vocabulary: dict[str, int], idf: np.ndarray, share: float) -> DataFrame:
    """The rows of a sketch as sparse rows over the vocabulary, whose squares together are ``share``."""
    shared = sketch.sparkSession.sparkContext.broadcast((vocabulary, idf))

    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        places, idf = shared.value
        for batch in batches:
            out = []
            for words, sums in zip(batch["words"], batch["sums"]):
                own = sorted((places[w], n) for w, n in zip(words, sums) if w in places)
                if own:
                    out.append(([i for i, _ in own], [float(n * idf[i]) for i, n in own]))
            yield pd.DataFrame(out, columns=["at", "value"])

    found = stage(sketch.mapInPandas(rows, "at array<int>, value array<double>"), "weighed")
    squares = F.aggregate("value", F.lit(0.0), lambda total, v: total + v * v)
    whole = found.agg(F.sum(squares)).first()[0] or 1.0
    return found.select("at", F.transform("value", lambda v: v * float(np.sqrt(share / whole))).alias("value"))


def build_index(
    block: list[Part], df: dict[str, int], total: int, sketch: DataFrame, n_rows: int, corpus_share: float, rank_share: float, least_rank: int
) -> Index:
    spark = sketch.sparkSession
    names = sorted({w for p in block for w in p.words})
    vocabulary = {w: i for i, w in enumerate(names)}
    idf = np.log((1 + total) / (1 + np.array([df.get(w, 0) for w in names], dtype=float))) + 0.01
    outside = float(np.log(1 + total)) + 0.01
    rows, norms = [], np.zeros(len(block))
    for number, part in enumerate(block):
        counts = Counter(part.words)
        at = sorted(vocabulary[w] for w in counts)
        value = np.array([counts[names[i]] * float(idf[i]) for i in at])
        norms[number] = np.sqrt(value @ value)
        rows.append((at, value / norms[number]))
    weight = float(np.sqrt((1 - corpus_share) / len(block)))
    own = spark.createDataFrame([(at, (value * weight).tolist()) for at, value in rows], "at array<int>, value array<double>")
    corpus = weigh(sketch, vocabulary, idf, corpus_share) if n_rows else own.limit(0)
    rank = max(least_rank, int(np.ceil(rank_share * len(block))))
    directions = randomised_svd(stage(own.unionByName(corpus), "rows"), len(names), rank)
    project = np.vstack((directions * idf[:, None], np.zeros((2, directions.shape[1])))).astype(np.float32)
    units = np.zeros((len(block), directions.shape[1]), dtype=np.float32)
    for number, (at, value) in enumerate(rows):
        latent = value @ directions[at]
        units[number] = latent / max(1e-12, float(np.sqrt(latent @ latent)))
    sizes = np.array([next((s for s in SIZES if s >= len(p.words)), SIZES[-1]) for p in block])
    classes = {int(s): (np.flatnonzero(sizes == s), units[sizes == s], norms[sizes == s]) for s in np.unique(sizes)}
    weights = np.append(idf, (outside, 0.0)) ** 2
    tails = [p.words[len(p.words) - p.own_tail :] for p in block]
    targets = [(place_bits(p.words), len(p.words), place_bits(t), len(t)) for p, t in zip(block, tails)]
    return Index(block, targets, vocabulary, project, weights, classes)


def find_leaks(docs: DataFrame, benchmark: DataFrame, **settings) -> DataFrame:
    """One row for each document and benchmark item found in it; settings as below."""
    found = find_text_leaks(docs, benchmark, **settings)
    return found.groupBy("doc_id", "item_id").agg(
        F.max("cosine").alias("cosine"), F.max("overlap").alias("overlap"), F.max("answer").alias("answer")
    )


def find_text_leaks(
    docs: DataFrame,
    benchmark: DataFrame,
    cosine: float = 0.2,
    coverage: float = 0.35,
    overlap: float = 0.6,
    answer: float = 0.5,
    rank_share: float = 0.75,
    least_rank: int = 64,
    corpus_share: float = 0.25,
    block_items: int = 256,
    pass_items: int = 4096,
    passage_words: int = 128,
    passage_sums: int = 256,
    task_cells: int = 2048,
) -> DataFrame:
    """The same for each different text of a doc_id, told by text_md5."""
    spark = docs.sparkSession

    def search(own: list[Part]) -> DataFrame:
        df, total, sketch = survey(docs, frozenset(w for p in own for w in p.words), passage_sums, task_cells)
        n_rows = sketch.count()
        blocks = [own[at : at + block_items] for at in range(0, len(own), block_items)]
        indexes = [build_index(block, df, total, sketch, n_rows, corpus_share, rank_share, least_rank) for block in blocks]
        shared = [spark.sparkContext.broadcast(index) for index in indexes]  # each bounded by block_items passages

        def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for batch in batches:
                ids, texts = batch["doc_id"], batch["text"].tolist()
                out = []
                for index in shared:
                    for number, which, *scores in index.value.find_parts(texts, cosine, coverage, overlap, answer):
                        p = index.value.parts[which]
                        row = (text_key(texts[number]), p.item_id, p.item, p.number, *scores, p.whole, p.tail)
                        out.append((ids.iloc[number], *row))
                frame = pd.DataFrame(out, columns=[c.split()[0] for c in PART.split(", ")])
                whole = {c.split()[0]: "int32" for c in PART.split(", ") if c.endswith(" int")}
                yield frame.astype({"doc_id": "Int64", "item_id": "int64", **whole})

        return docs.select("doc_id", "text").mapInPandas(rows, PART)

    found: list[DataFrame] = []
    waiting: list[Part] = []
    items = benchmark.filter(F.col("item_id").isNotNull()).select("item_id", "text").orderBy("item_id", "text")
    for number, row in enumerate(items.toLocalIterator()):  # one pass's passages at a time
        for part in parts_of(row["item_id"], words_of(row["text"]), passage_words, number):
            waiting.append(part)
            if len(waiting) >= pass_items:
                found.append(search(waiting))
                waiting = []
    if waiting:
        found.append(search(waiting))
    if not found:
        return spark.createDataFrame([], RESULT + ", text_md5 string")
    parts = found[0]
    for other in found[1:]:
        parts = parts.unionByName(other)
    item = ["doc_id", "text_md5", "item_id", "item", "whole", "tail"]
    each = parts.groupBy(*item, "part").agg(*[F.max(c).alias(c) for c in ("cosine", "shared", "kept")])  # repeated rows
    sums = each.groupBy(item).agg(
        F.max("cosine").alias("cosine"),
        (F.sum("shared") / F.col("whole")).alias("overlap"),
        (F.sum("kept") / F.col("tail")).alias("answer"),
    )
    kept = sums.filter((F.col("overlap") >= overlap) & (F.col("answer") >= answer))
    return kept.select("doc_id", "item_id", "cosine", "overlap", "answer", "text_md5")


def op8_decontamination(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    return find_leaks(docs, benchmark)
