"""Alignment of two tokenizers' tokens by segment de-duplication.

A text is cut before those runs of white space where both vocabularies verifiably cannot merge
across (``safe_breaks`` checks every entry and the pre-tokenizer), so the tokens of the whole are
those of its segments.  Texts are read once: in blocks of about ``block_chars`` characters a
document becomes a list of numbers of the block's distinct segments.  These segments meet in
sorted runs, in which each distinct one is tokenized by both and aligned once; the alignments go
back to the blocks that hold the segment, where documents are composed and every id pair's
documents counted.  Corpus-wide pair counts go back to the blocks the same way.

What is shuffled is one row for each segment of a block and compressed numbers for documents, never an
occurrence; a segment or pair that every text holds is one row a block.

Groups end where a token of each ends at the same byte.  Links are all pairs of tokens of a group;
they are counted by distinct ids with their multiplicities and not enumerated.

Defined cases: null and empty texts, and those whose joined tokens differ from the space and text
(for instance with U+2581 inside), have no tokens and count for no pair; a text of white space is
cut like any other; rows that repeat, or share or lack a doc_id, count each; a very long text is a block of its own
and a run without a safe break one segment; an empty table gives an empty result; extra columns are left out.
"""

from __future__ import annotations

import hashlib
import os
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .shared import stage

CODED = "block long, doc_id long, n int, codes binary, segments array<string>"
ALIGNED = "block long, code int, groups string"
COMPOSED = (
    "block long, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, groups string, "
    "n_pairs int, pairs binary, times binary, idx int, a int, b int, pair_docs long"
)
RESULT = "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"
BLANKS = " \t\n\r\x0b\x0c"
CHUNK = 4096


def default_vocabularies() -> tuple[str, str]:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


def byte_of_char() -> dict[str, int]:
    """Byte-level vocabularies write a printable byte as itself and the others, in order, from U+0100 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


@lru_cache(maxsize=2)
def byte_level(path: str):
    """The tokenizer and the bytes of each id."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark has a task for each core
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.encode_special_tokens = True
    chars = byte_of_char()
    entries: list[bytes] = [b""] * tokenizer.get_vocab_size()
    for token, number in tokenizer.get_vocab(with_added_tokens=False).items():
        if all(c in chars for c in token):
            entries[number] = bytes(chars[c] for c in token)
    return tokenizer, entries


@lru_cache(maxsize=2)
def pieces(path: str):
    """The processor and the bytes of each id."""
    from sentencepiece import SentencePieceProcessor

    model = SentencePieceProcessor(model_file=path)
    entries = []
    for number in range(model.get_piece_size()):
        piece = model.id_to_piece(number)
        entries.append(bytes([int(piece[3:5], 16)]) if model.is_byte(number) else piece.replace("▁", " ").encode())
    return model, entries


@lru_cache(maxsize=4)
def safe_breaks(path_a: str, path_b: str) -> str:
    """The ASCII blanks before which, after anything but white space, no token of either spans.

    No entry of a vocabulary may hold such a place inside; the byte-level form's pre-tokenizer must
    cut there; and, as the piece model puts a space before what it encodes, no piece may join a space
    to a blank that starts a segment (other than the space itself)."""
    tokenizer, entries_a = byte_level(path_a)
    model, entries_b = pieces(path_b)
    safe = ""
    words_a = [e.decode("utf-8", "replace") for e in entries_a]
    words_b = [e.decode("utf-8", "replace") for n, e in enumerate(entries_b) if not model.is_byte(n)]
    for blank in BLANKS:
        inside = re.compile(rf"\S{re.escape(blank)}")
        if any(map(inside.search, words_a)) or any(map(inside.search, words_b)):
            continue
        if blank != " " and any(w.startswith(" " + blank) for w in words_b):
            continue
        ahead = [left + blank * n + "b" for left in ("a", "é", "1", ".", "_", "中") for n in (1, 2)]
        cuts = [{span[0] for _, span in tokenizer.pre_tokenizer.pre_tokenize_str(s)} for s in ahead]
        if all(1 in c for c in cuts):
            safe += blank
    return safe


def segment_pattern(safe: str) -> re.Pattern:
    """Segments as matches: white space and words, on over blanks that are not safe."""
    if not safe:
        return re.compile(r"[\s\S]+")
    joint = rf"[^\S{re.escape(safe)}]"
    return re.compile(rf"\s*\S+(?:{joint}\s*\S+)*(?:{joint}\s*\Z)?|\s+")


def group_string(a: list[int], b: list[int], size_a: list[int], size_b: list[int]) -> str:
    """`a1,a2|b1;a3|b2,b3` of two id lists that spell the same bytes."""
    out, i, j, x, y, from_a, from_b = [], 0, 0, 0, 0, 0, 0
    while i < len(a):
        x += size_a[a[i]]
        i += 1
        while y < x:
            y += size_b[b[j]]
            j += 1
        if x == y:
            out.append(",".join(map(str, a[from_a:i])) + "|" + ",".join(map(str, b[from_b:j])))
            from_a, from_b = i, j
    return ";".join(out)


def align_segments(segments: list[str], path_a: str, path_b: str) -> list[str | None]:
    """Each segment's groups; None where one side's tokens do not spell it."""
    tokenizer, entries_a = byte_level(path_a)
    model, entries_b = pieces(path_b)
    size_a, size_b = sizes(path_a, path_b)
    encode = getattr(tokenizer, "encode_batch_fast", tokenizer.encode_batch)
    all_a = [e.ids for e in encode(segments, add_special_tokens=False)]
    spaced = [s[0] == " " for s in segments]
    all_b = model.encode([s[1:] if own else s for s, own in zip(segments, spaced)], num_threads=1)
    lone = model.piece_to_id("▁")
    out: list[str | None] = []
    for segment, a, b, own in zip(segments, all_a, all_b, spaced):
        if not own:
            b = b[1:]  # the space that the model puts before
        elif segment == " ":
            b = [lone]  # the model puts none before nothing
        raw = segment.encode()
        same = b"".join([entries_a[t] for t in a]) == raw == b"".join([entries_b[t] for t in b])
        out.append(group_string(a, b, size_a, size_b) if same else None)
    return out


@lru_cache(maxsize=2)
def sizes(path_a: str, path_b: str) -> tuple[list[int], list[int]]:
    return [len(e) for e in byte_level(path_a)[1]], [len(e) for e in pieces(path_b)[1]]


@lru_cache(maxsize=1)
def _squeezers():
    import zstandard

    return zstandard.ZstdCompressor(level=1), zstandard.ZstdDecompressor()


def pack_numbers(numbers: np.ndarray, width: int = 4) -> bytes:
    """Non-negative numbers of ``width`` bytes, compressed with their bytes of equal weight together."""
    planes = np.ascontiguousarray(numbers.astype(f"<u{width}").view(np.uint8).reshape(-1, width).T)
    return _squeezers()[0].compress(planes.tobytes())


def unpack_numbers(data: bytes, n: int, width: int = 4) -> np.ndarray:
    if not n:
        return np.zeros(0, f"<u{width}")
    planes = np.frombuffer(_squeezers()[1].decompress(data, max_output_size=width * n), np.uint8)
    return np.ascontiguousarray(planes.reshape(width, n).T).view(f"<u{width}").ravel()


def code_documents(docs: DataFrame, safe: str, block_chars: int) -> DataFrame:
    """Rows of documents (doc_id, n, codes) and, in chunks, of each block's distinct segments, whose
    numbers are their places."""

    def coded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        find = segment_pattern(safe).findall
        block, chars = TaskContext.get().partitionId() << 33, 0
        numbers: dict[str, int] = {}
        rows: list[tuple] = []

        def flushed() -> Iterator[pa.RecordBatch]:
            names = list(numbers)
            chunks = [names[at : at + CHUNK] for at in range(0, len(names), CHUNK)]
            first = [(block, None, at * CHUNK, None, chunk) for at, chunk in enumerate(chunks)]
            for some in (first, rows):
                for at in range(0, len(some), 500):
                    yield record_batch(some[at : at + 500], CODED_ARROW)

        for batch in batches:
            for doc_id, text in zip(batch["doc_id"].to_pylist(), batch["text"].to_pylist()):
                found = find(" " + text) if text else []
                codes = np.fromiter((numbers.setdefault(s, len(numbers)) for s in found), np.int64, len(found))
                rows.append((block, doc_id, len(codes), pack_numbers(codes), None))
                chars += len(text or "") + 64
                if chars >= block_chars:
                    yield from flushed()
                    numbers, rows, block, chars = {}, [], block + 1, 0
        yield from flushed()

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(coded, CODED)


CODED_ARROW = pa.schema(
    [("block", pa.int64()), ("doc_id", pa.int64()), ("n", pa.int32()), ("codes", pa.binary()), ("segments", pa.list_(pa.string()))]
)
COMPOSED_ARROW = pa.schema(
    [("block", pa.int64()), ("doc_id", pa.int64())]
    + [(n, pa.int64()) for n in ("n_a", "n_b", "n_groups", "n_links")]
    + [("groups_sha256", pa.string()), ("groups", pa.string()), ("n_pairs", pa.int32()), ("pairs", pa.binary()), ("times", pa.binary())]
    + [("idx", pa.int32()), ("a", pa.int32()), ("b", pa.int32()), ("pair_docs", pa.int64())]
)
RESULT_ARROW = pa.schema(
    [(n, pa.int64()) for n in ("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum")] + [("groups_sha256", pa.string())]
)


def record_batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = zip(*rows) if rows else [()] * len(schema)
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)


def align_runs(segments: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """(block, code, groups) of (block, code, segment): sorted by segment, each distinct one is encoded once."""

    def aligned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, last_groups = None, None
        schema = pa.schema([("block", pa.int64()), ("code", pa.int32()), ("groups", pa.string())])
        for batch in batches:
            found = batch["segment"].to_pylist()
            new = [s for s in dict.fromkeys(found) if s != last]
            known = dict(zip(new, align_segments(new, path_a, path_b))) if new else {}
            if last is not None:
                known[last] = last_groups
            groups = pa.array([known[s] for s in found], pa.string())
            if found:
                last, last_groups = found[-1], known[found[-1]]
            yield pa.RecordBatch.from_arrays([batch["block"], batch["code"], groups], schema=schema)

    sorted_runs = segments.repartition("segment").sortWithinPartitions("segment")
    return sorted_runs.select("block", "code", "segment").mapInArrow(aligned, ALIGNED)


def token_table(groups: list[str]) -> tuple[np.ndarray, ...]:
    """The ids of all ``groups`` strings in order, whether each is one of B, its group's number; and for each
    group the number of its string."""
    buffer = np.frombuffer((";".join(groups) + ";").encode(), np.uint8)
    stops = np.flatnonzero((buffer < 48) | (buffer > 57))
    starts = np.concatenate([[0], stops[:-1] + 1])
    width = stops - starts
    value = np.zeros(len(stops), np.int64)
    for k in range(int(width.max())):
        has = np.flatnonzero(width > k)
        value[has] = value[has] * 10 + buffer[starts[has] + k] - 48
    ends_group, ends_a = buffer[stops] == ord(";"), buffer[stops] == ord("|")
    group = np.cumsum(ends_group) - ends_group
    of_b = np.cumsum(ends_a) - ends_a > group
    string_ends = np.cumsum([len(g) + 1 for g in groups]) - 1
    return value, of_b, group, np.searchsorted(string_ends, stops[ends_group])


def linked_ids(value: np.ndarray, of_b: np.ndarray, group: np.ndarray, most: int = 1 << 12) -> tuple[np.ndarray, ...]:
    """(group, a, b, times): the links of each group.  Those of small groups are listed one by one, larger
    groups by their distinct ids and how often they come."""
    n_a, n_b = np.bincount(group[~of_b]), np.bincount(group[of_b])
    ids_a, ids_b = value[~of_b], value[of_b]
    first_a, first_b = np.cumsum(n_a) - n_a, np.cumsum(n_b) - n_b
    links = n_a * n_b
    small = np.flatnonzero(links <= most)
    of = np.repeat(small, links[small])
    within = np.arange(len(of)) - np.repeat(np.cumsum(links[small]) - links[small], links[small])
    found = [(of, ids_a[first_a[of] + within // n_b[of]], ids_b[first_b[of] + within % n_b[of]], np.ones(len(of), np.int64))]
    for g in np.flatnonzero(links > most):
        a, k = np.unique(ids_a[first_a[g] : first_a[g] + n_a[g]], return_counts=True)
        b, m = np.unique(ids_b[first_b[g] : first_b[g] + n_b[g]], return_counts=True)
        times = np.outer(k, m).ravel()
        found.append((np.full(len(times), g), np.repeat(a, len(b)), np.tile(b, len(a)), times))
    return tuple(np.concatenate(x) for x in zip(*found))


def summed(keys: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in order and the sums of their values."""
    order = np.argsort(keys, kind="stable")
    keys, values = keys[order], values[order]
    starts = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, np.int64)
    return keys[starts], np.add.reduceat(values, starts) if len(keys) else values


class Dictionary:
    """A block's segments by number: their groups, counts, and links as pair numbers with multiplicities."""

    def __init__(self, codes: np.ndarray, groups: list[str | None]):
        n = int(codes.max()) + 1 if len(codes) else 0
        self.groups: list[str | None] = [None] * n
        self.counts = np.zeros((4, n), np.int64)
        self.bad = np.zeros(n, bool)
        self.many = np.zeros(n, np.int64)
        self.a = self.b = self.pair = self.times = np.zeros(0, np.int64)
        for code, own in zip(codes.tolist(), groups):
            self.groups[code] = own
        self.bad[[c for c, own in enumerate(self.groups) if own is None]] = True
        good = np.flatnonzero(~self.bad)
        found = []
        for at in range(0, len(good), 1 << 15):  # so that what is needed on the way stays small
            value, of_b, group, string = token_table([self.groups[c] for c in good[at : at + (1 << 15)]])
            code = good[at + string]
            n_a, n_b = np.bincount(group[~of_b]), np.bincount(group[of_b])
            for row, per_group in zip(self.counts, (n_a, n_b, np.ones_like(n_a), n_a * n_b)):
                np.add.at(row, code, per_group)
            of, a, b, times = linked_ids(value, of_b, group)
            found.append((code[of].astype(np.int32), a << 32 | b, times))
        if found:
            pairs, number = np.unique(np.concatenate([x[1] for x in found]), return_inverse=True)
            self.a, self.b = pairs >> 32, pairs & 0xFFFFFFFF
            keys = np.concatenate([x[0] for x in found]).astype(np.int64) * len(pairs) + number
            keys, self.times = summed(keys, np.concatenate([x[2] for x in found]))
            self.pair = keys % len(pairs)
            self.many = np.bincount(keys // len(pairs), minlength=n)
        self.first = np.cumsum(self.many) - self.many

    def links(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The distinct pair numbers of a document and how often each is linked."""
        code, often = np.unique(codes, return_counts=True)
        many = self.many[code]
        at = np.repeat(self.first[code] - np.cumsum(many) + many, many) + np.arange(many.sum())
        return summed(self.pair[at], self.times[at] * np.repeat(often, many))


def compose(docs: DataFrame, aligned: DataFrame, keep_groups: bool) -> DataFrame:
    """Documents of a block with its alignments, and the block's pairs with the number of documents that hold each."""

    def composed(docs: pa.Table, aligned: pa.Table) -> pa.Table:
        known = Dictionary(aligned["code"].to_numpy(), aligned["groups"].to_pylist())
        holders = np.zeros(len(known.a), np.int64)
        block = docs["block"][0].as_py() if docs.num_rows else aligned["block"][0].as_py()
        rows = []
        for doc_id, n, data in zip(docs["doc_id"].to_pylist(), docs["n"].to_pylist(), docs["codes"].to_pylist()):
            codes = unpack_numbers(data, n)
            if not n or known.bad[codes].any():
                rows.append((block, doc_id, 0, 0, 0, 0, "", "", 0, None, None, *[None] * 4))
                continue
            groups = ";".join(map(known.groups.__getitem__, codes.tolist()))
            found, often = known.links(codes)
            holders[found] += 1
            sums = known.counts[:, codes].sum(1).tolist()
            digest = hashlib.sha256(groups.encode()).hexdigest()
            packed = len(found), pack_numbers(found), pack_numbers(often, 8)
            rows.append((block, doc_id, *sums, digest, groups if keep_groups else None, *packed, *[None] * 4))
        idx = np.flatnonzero(holders)
        own = {"block": np.full(len(idx), block), "idx": idx, "a": known.a[idx], "b": known.b[idx], "pair_docs": holders[idx]}
        columns = [pa.array(own[f.name]).cast(f.type) if f.name in own else pa.nulls(len(idx), f.type) for f in COMPOSED_ARROW]
        pairs = pa.RecordBatch.from_arrays(columns, schema=COMPOSED_ARROW)
        return pa.Table.from_batches([record_batch(rows, COMPOSED_ARROW), pairs])

    return docs.groupBy("block").cogroup(aligned.groupBy("block")).applyInArrow(composed, COMPOSED)


def score(docs: DataFrame, values: DataFrame) -> DataFrame:
    """Documents with n_best and count_sum, by the corpus-wide ``values`` of the block's pairs (holder, idx, n, best)."""

    def scored(docs: pa.Table, values: pa.Table) -> pa.Table:
        idx = values["idx"].to_numpy()
        n = np.zeros(int(idx.max()) + 1 if len(idx) else 0, np.int64)
        best = np.zeros(len(n), bool)
        n[idx], best[idx] = values["n"].to_numpy(), values["best"].to_numpy(zero_copy_only=False)
        n_best, count_sum = [], []
        for many, found, often in zip(*[docs[c].to_pylist() for c in ("n_pairs", "pairs", "times")]):
            found, often = unpack_numbers(found, many), unpack_numbers(often, many, 8).astype(np.int64)
            n_best.append(int(often[best[found]].sum()))
            count_sum.append(int((often * n[found]).sum()))
        out = docs.select([f.name for f in RESULT_ARROW if f.name in docs.column_names])
        out = out.append_column("n_best", pa.array(n_best, pa.int64())).append_column("count_sum", pa.array(count_sum, pa.int64()))
        return out.select(RESULT_ARROW.names)

    small = docs.select("block", "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "n_pairs", "pairs", "times")
    return small.groupBy("block").cogroup(values.groupBy("holder")).applyInArrow(scored, RESULT)


class Alignment:
    """The aligned corpus: ``documents`` (their counts, digest and, if kept, groups), ``pairs`` (a, b, the number
    of documents that hold the pair linked, whether that is the highest of its a) and ``scored`` documents."""

    def __init__(self, docs: DataFrame, path_a: str, path_b: str, block_chars: int, keep_groups: bool):
        coded = stage(code_documents(docs, safe_breaks(path_a, path_b), block_chars), "coded")
        place = F.posexplode("segments").alias("place", "segment")
        segments = coded.filter("segments IS NOT NULL").select("block", "n", place)
        segments = segments.select("block", (F.col("n") + F.col("place")).alias("code"), "segment")
        texts = coded.filter("codes IS NOT NULL").select("block", "doc_id", "n", "codes")
        composed = stage(compose(texts, align_runs(segments, path_a, path_b), keep_groups), "composed")
        self._rows = composed.filter("idx IS NULL")
        self._pair = composed.filter("idx IS NOT NULL").select(F.col("block").alias("holder"), "idx", "a", "b", "pair_docs")
        self.documents = self._rows.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "groups")
        totals = self._pair.groupBy("a", "b").agg(F.sum("pair_docs").alias("n"))
        top = F.max("n").over(Window.partitionBy("a"))  # at most as many rows for an id as the other vocabulary has
        self.pairs = totals.withColumn("best", F.col("n") == top)

    @property
    def scored(self) -> DataFrame:
        values = self._pair.join(self.pairs, ["a", "b"]).select("holder", "idx", "n", "best")
        return score(self._rows, values)


def align_documents(
    docs: DataFrame, vocabularies: tuple[str, str] | None = None, block_chars: int = 16 << 20, keep_groups: bool = False
) -> Alignment:
    """Aligns the texts of ``docs`` (doc_id, text) between a byte-level vocabulary (A, a tokenizers file) and a
    piece model (B, a sentencepiece file); see ``Alignment``."""
    path_a, path_b = vocabularies or default_vocabularies()
    return Alignment(docs, path_a, path_b, block_chars, keep_groups)


def op11_token_alignment(docs: DataFrame) -> DataFrame:
    return align_documents(docs).scored
