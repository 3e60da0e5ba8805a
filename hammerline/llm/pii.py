"""Personal data: fixed forms, and identifiers found by bootstrapped contexts.

One pass over the texts finds the base kinds (email, ip, card, phone) and, beside them,
tokens that may be identifiers: those with a digit, those in capitals and those that
follow ``=`` or ``:``.  Each has lexical patterns of three types: the one, two and three
words before it with the marks between, the marks and word after it, and its own make-up
(alphabet, length, capital prefix, form of a number); contexts are case-folded and their
digits are alike.  Tokens of the seed forms are certain, and so is what the base kinds cover behind the name of a
field (as in ``phone: ``); patterns and instances then form a bipartite graph that Spark scores in rounds: a pattern
is as good as the share of its instances that are known, an instance as the best
patterns of each type say together.  Instances over the threshold are personal data wherever
they stand, also those that no seed form describes.

Limits: a candidate has ``LEAST`` characters or more; a context reaches at most ``BEFORE``
characters back and ``AFTER`` ahead; a pattern needs ``support`` different instances.

Defined cases: null and empty texts have no span; repeated rows each get their row; a
candidate inside a base span is none; with no seed in the corpus only base spans remain;
an empty table gives an empty result; a very long text takes time in proportion to its
length; of other columns none is read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import stage

LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
TOKEN = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789_-")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
IP = re.compile(r"(?<![0-9])[0-9]+(?:\.[0-9]+)(?:\.[0-9]+)(?:\.[0-9]+)")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
CODE = re.compile(r"[0-9][A-Za-z0-9_-]*|[=:][\x20\"']{0,3}[A-Za-z][A-Za-z0-9_-]{5,}|[A-Z]{12}[A-Za-z0-9_-]*")
WORD = re.compile(r"\w+")
FIELD = re.compile(r"\w[^\w\s.,;!?]\W*$|\w\s*[=:]\W*$")
NEXT = re.compile(r"\W*\w+")
DIGIT = re.compile("[0-9]")
HEX = re.compile("[0-9]*[a-f][0-9a-f]*|[0-9]*[A-F][0-9A-F]*")
CAPITALS = re.compile("[0-9]*[A-Z][0-9A-Z]*")
NUMBER = re.compile("[0-9_-]+")
KINDS = ("email", "ip", "card", "phone", "secret")
#: Forms that are known to be identifiers: long hexadecimal tokens, access key ids.
SEEDS = (r"[0-9a-f]{40}", r"AKIA[0-9A-Z]{16}")
LEAST = 6
BEFORE, AFTER = 48, 32
DOUBT = 4  # instances of no worth that every pattern is charged with

Span = tuple[int, int]


def emails(text: str) -> list[Span]:
    found, last, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > last and text[start - 1] in LOCAL:
            start -= 1
        match = DOMAIN.match(text, at + 1) if start < at else None
        if match:
            last = match.end()
            found.append((start, last))
            at = text.find("@", last)
        else:
            at = text.find("@", at + 1)
    return found


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        v = ord(c) - 48
        total += v if i % 2 == 0 else (2 * v - 9 if v > 4 else 2 * v)
    return total % 10 == 0


def _digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def base_spans(text: str) -> dict[str, list[Span]]:
    ips = [m.span() for m in IP.finditer(text) if all(len(p.lstrip("0")) <= 3 and int(p[-4:]) <= 255 for p in m[0].split("."))]
    cards = []
    for m in CARD.finditer(text):
        if m.end() - m.start() >= 13:
            own = _digits(m[0])
            if 13 <= len(own) <= 19 and luhn(own):
                cards.append(m.span())
    phones = [m.span() for m in PHONE.finditer(text) if 9 <= len(_digits(m[0])) <= 15]
    return {"email": emails(text), "ip": ips, "card": cards, "phone": phones}


def make_up(token: str) -> list[str]:
    """Patterns of a token's own form, the general one first."""
    if NUMBER.fullmatch(token):
        return ["s:" + DIGIT.sub("0", token)]
    if HEX.fullmatch(token) and DIGIT.search(token):
        return ["s:hex", f"s:hex:{len(token)}"]
    if CAPITALS.fullmatch(token):
        return [f"s:capitals:{token[:4]}:{len(token)}"]
    return [f"s:mixed:{len(token)}"]


def contexts(text: str, start: int, end: int) -> list[str]:
    """Up to three words before, and the marks and word after."""
    left = DIGIT.sub("0", text[max(0, start - BEFORE) : start].lower())
    found = ["l:" + left[m.start() :] for m in list(WORD.finditer(left))[-3:]]
    after = NEXT.match(DIGIT.sub("0", text[end : end + AFTER].lower()))
    return found + (["r:" + after[0]] if after else [])


def candidates(text: str, taken: dict[str, list[Span]]) -> list[tuple[int, int, str, list[str]]]:
    """(start, end, token, patterns) of tokens that may be identifiers; of base spans with the start -1."""
    found, last, reach, at = [], 0, -1, 0
    spans = sorted(s for own in taken.values() for s in own)
    for m in CODE.finditer(text):
        start, end = m.span()
        if text[start] in "=:":
            start = next(i for i in range(start + 1, end) if text[i] in TOKEN)
        if start < last:
            continue
        while start > last and text[start - 1] in TOKEN:
            start -= 1
        last = end
        while at < len(spans) and spans[at][0] <= start:  # both go from left to right
            reach = max(reach, spans[at][1])
            at += 1
        if end - start < LEAST or end <= reach:
            continue
        token = text[start:end]
        found.append((start, end, token, contexts(text, start, end) + make_up(token)))
    for kind, own in taken.items():
        for a, b in own:  # only what looks like a field's name: any word may stand before a number
            named = [c for c in contexts(text, a, b) if c[0] == "l" and FIELD.search(c)]
            if named:
                found.append((-1, -1, f"{kind} {text[a:b]}", named))
    return found


ROW = (
    "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base string, "
    "cands array<struct<start: long, end: long, value: string, patterns: array<string>>>"
)


def scan(docs: DataFrame) -> DataFrame:
    """One row a document: base spans, and candidates with their patterns."""

    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names = ["start", "end", "value", "patterns"]
        for batch in batches:
            out = []
            for doc_id, text in zip(batch["doc_id"], batch["text"]):
                text = text or ""
                base = base_spans(text)
                joined = ",".join(f"{k}:{a}:{b}" for k in KINDS[:4] for a, b in base[k])
                cands = [dict(zip(names, c)) for c in candidates(text, base)]
                out.append((doc_id, *(len(base[k]) for k in KINDS[:4]), joined, cands))
            columns = ["doc_id", "n_email", "n_ip", "n_card", "n_phone", "base", "cands"]
            yield pd.DataFrame(out, columns=columns).astype({"doc_id": "Int64"})

    return docs.select("doc_id", "text").mapInPandas(rows, ROW)


def bootstrap(
    found: DataFrame, seeds: tuple[str, ...] = SEEDS, rounds: int = 3, accept: float = 0.7, support: int = 3
) -> DataFrame:
    """The values (column value) that the pattern-instance graph of ``found`` accepts.

    ``found``: start, value, patterns; start is negative for what is known.  A pattern needs
    ``support`` instances.  With p the sum of its instances' scores over n instances, a
    pattern scores p / (n + DOUBT), so that few instances say little; an instance is missed by all types as their best patterns miss it."""
    each = found.select("value", (F.col("start") < 0).alias("known"), F.explode("patterns").alias("pattern"))
    every = stage(each.groupBy("value", "pattern").agg(F.bool_or("known").alias("known")), "patterns")
    shared = every.groupBy("pattern").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= support)
    edges = stage(every.join(shared, "pattern"), "edges")
    seed = F.col("known")
    for form in seeds:
        seed = seed | F.col("value").rlike(f"^(?:{form})$")
    scores = stage(edges.groupBy("value").agg(F.max(seed.cast("double")).alias("score")), "scores")
    for _ in range(rounds):
        rated = (
            edges.join(scores, "value")
            .groupBy("pattern", "n")
            .agg(F.sum("score").alias("p"))
            .filter(F.col("p") > 0)
            .select("pattern", (F.col("p") / (F.col("n") + DOUBT)).alias("rate"))
        )
        kind = F.substring("pattern", 1, 1)
        best = [F.coalesce(F.max(F.when(kind == k, F.col("rate"))), F.lit(0.0)) for k in "lrs"]
        reached = edges.join(rated, "pattern").groupBy("value").agg((1 - (1 - best[0]) * (1 - best[1]) * (1 - best[2])).alias("heard"))
        scores = stage(
            scores.join(reached, "value", "left").select(
                "value", F.greatest("score", F.coalesce("heard", F.lit(0.0))).alias("score")
            ),
            "scores",
        )
    alone = every.filter(seed).select("value")  # a seed is found without any pattern
    return scores.filter(F.col("score") >= accept).select("value").unionByName(alone).distinct()


def find_personal_data(docs: DataFrame, seeds: tuple[str, ...] = SEEDS, rounds: int = 3) -> DataFrame:
    """doc_id, counts of the base kinds, base (joined base spans) and spans (all, joined)."""
    seen = stage(scan(docs).withColumn("uid", F.expr("uuid()")), "scan")
    each = seen.select("uid", F.explode("cands").alias("c")).select("uid", "c.*")
    accepted = stage(bootstrap(each, seeds, rounds), "accepted")
    extra = (
        each.filter("start >= 0")
        .select("uid", "start", "end", "value")
        .join(accepted, "value")
        .groupBy("uid")
        .agg(F.array_sort(F.collect_set(F.struct("start", "end"))).alias("at"))
        .select(
            "uid",
            F.array_join(
                F.transform("at", lambda s: F.concat_ws(":", F.lit("secret"), s["start"].cast("string"), s["end"].cast("string"))),
                ",",
            ).alias("more"),
        )
    )
    both = F.concat_ws(",", F.nullif(F.col("base"), F.lit("")), "more")
    return seen.drop("cands").join(extra, "uid", "left").withColumn("spans", both).drop("uid", "more")


def op4_personal_data(docs: DataFrame) -> DataFrame:
    return find_personal_data(docs).select(
        "doc_id", "n_email", "n_ip", "n_card", "n_phone", F.sha2("base", 256).alias("base_sha256"), "spans"
    )
