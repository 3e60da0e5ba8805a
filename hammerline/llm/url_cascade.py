"""URL filtering by an exact cascade of Bloom filters, in DataFrame expressions only.

A url's candidate keys are its host and parent domains joined with the start of its
path, for as many labels and characters as listed keys have.  The complete universe of
candidate keys in the corpus is known, so membership can be made exact: level 0 encodes
the listed keys, level 1 those other keys of the universe that level 0 lets through,
level 2 the listed keys that level 1 lets through, and so on until a level has no false
positive.  The first level that rejects a key decides it; no page is joined with anything.

Level 0 is sized so that about as many keys pass it wrongly as are listed, later levels
at one half, so the whole cascade grows with the list and the logarithm of the universe.
``max_filter_bytes`` bounds what a plan carries; a list beyond it is split by key hash
into several cascades, each within the bound, and applied one after another.

Defined cases: a null url or one without ``://`` has an empty host and path and gets the
verdict of the list (allow, as an empty key is never listed); repeated rows each get their
row; an empty table or an empty list works; of rules that fit the longest wins and a block of the same
length is taken first; a very long url has no more candidates than the list asks for; other columns
pass through, those named host, path, rule and verdict are replaced.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .shared import UPPER, stage

RULES = (("net/", "block"), ("example.net/en/", "allow"), ("example.com/de/", "block"), ("org/fr/", "allow"))
#: Hosts that the list itself blocks where no rule speaks.
LISTED_HOSTS = ("spam-farm.example.org", "example.invalid")


@dataclass(frozen=True)
class Level:
    bits: bytes
    size: int
    hashes: int
    number: int

    def position(self, key: Column, i: int) -> Column:
        return F.pmod(F.xxhash64(F.lit(self.number * 64 + i), key), F.lit(self.size))

    def hit(self, key: Column) -> Column:
        def probe(bits: Column) -> Column:
            found = F.lit(True)
            for i in range(self.hashes):
                at = self.position(key, i)
                place = F.shiftright(at, 6) * 8 + 8 - F.shiftright(at.bitwiseAND(F.lit(63)), 3)  # words have their high byte first
                byte = F.conv(F.hex(F.substring(bits, place.cast("int"), F.lit(1))), 16, 10)
                found = found & (F.getbit(byte.cast("long"), (at % 8).cast("int")) == 1)
            return found

        return F.element_at(F.transform(F.array(F.lit(self.bits)), probe), 1)  # the bits stand in the plan once


def build_level(keys: DataFrame, count: int, rate: float, number: int, max_bytes: int) -> Level:
    """One Bloom filter over ``keys`` (column key): Spark ors the bits together by words and joins these
    to blocks of 4 KiB, which come to the driver as bytes."""
    size = max(64, math.ceil(max(1, count) * math.log(1 / rate) / math.log(2) ** 2))
    size = -(-size // 64) * 64
    if size // 8 > max_bytes:
        raise ValueError(f"a filter level of {size // 8} bytes is over the bound of {max_bytes}")
    hashes = min(16, max(1, round(size / max(1, count) * math.log(2))))
    blank = Level(b"", size, hashes, number)
    spots = keys.select(F.explode(F.array(*[blank.position(F.col("key"), i) for i in range(hashes)])).alias("at"))
    bits = spots.select(F.shiftright("at", 6).alias("word"), F.expr("shiftleft(1L, CAST(at % 64 AS int))").alias("bits"))
    zeros = keys.sparkSession.range(size // 64).select(F.col("id").alias("word"), F.lit(0).cast("long").alias("bits"))
    words = bits.unionByName(zeros).groupBy("word").agg(F.bit_or("bits").alias("bits"))
    ordered = F.array_sort(F.collect_list(F.struct("word", "bits")))
    digits = F.array_join(F.transform(ordered, lambda x: F.lpad(F.hex(x["bits"]), 16, "0")), "")
    blocks = words.groupBy(F.shiftright("word", 9).alias("block")).agg(F.unhex(digits).alias("bytes"))
    data = b"".join(bytes(row["bytes"]) for row in blocks.orderBy("block").collect())  # size / 8 bytes, checked above
    return Level(data, size, hashes, number)


@dataclass(frozen=True)
class Cascade:
    levels: tuple[Level, ...]

    def contains(self, key: Column) -> Column:
        """True exactly for the listed keys among the universe's keys."""
        answer = F.lit(len(self.levels) % 2 == 1)
        for level in reversed(self.levels):
            answer = F.when(~level.hit(key), F.lit(level.number % 2 == 1)).otherwise(answer)
        return answer


def build_cascade(listed: DataFrame, universe: DataFrame, max_filter_bytes: int = 64 << 20) -> Cascade:
    """``listed`` and ``universe``: distinct values of the column key.  Both may be large."""
    inside, total = listed.count(), universe.count()
    if not inside:
        return Cascade(())
    rate = min(0.5, max(1e-9, inside * math.sqrt(0.5) / max(1, total - inside)))
    levels = [build_level(listed, inside, rate, 0, max_filter_bytes)]
    encoded = listed
    passed = stage(universe.filter(levels[0].hit(F.col("key"))).join(listed, "key", "left_anti"), "cascade")
    while (left := passed.count()) > 0:
        level = build_level(passed, left, 0.5, len(levels), max_filter_bytes)
        levels.append(level)
        encoded, passed = passed, stage(encoded.filter(level.hit(F.col("key"))), "cascade")
    return Cascade(tuple(levels))


def build_cascades(listed: DataFrame, universe: DataFrame, max_filter_bytes: int = 64 << 20) -> list[Cascade]:
    """As many cascades by key hash as keep each level within the bound."""
    bits = listed.count() * 64
    parts = max(1, -(-bits // (8 * max_filter_bytes)))
    if parts == 1:
        return [build_cascade(listed, universe, max_filter_bytes)]
    share = F.pmod(F.xxhash64(F.lit(-1), F.col("key")), F.lit(parts))
    return [
        build_cascade(listed.filter(share == i), universe.filter(share == i), max_filter_bytes) for i in range(parts)
    ]


def in_any(cascades: list[Cascade], key: Column) -> Column:
    if len(cascades) == 1:
        return cascades[0].contains(key) if cascades[0].levels else F.lit(False)
    share = F.pmod(F.xxhash64(F.lit(-1), key), F.lit(len(cascades)))
    found = F.lit(False)
    for i, cascade in enumerate(cascades):
        if cascade.levels:
            found = found | ((share == i) & cascade.contains(key))
    return found


def split_url(url: Column) -> tuple[Column, Column]:
    rest = F.when(F.instr(url, "://") > 0, F.substring(url, F.instr(url, "://") + 3, F.char_length(url)))
    host = F.translate(F.regexp_extract(rest, r"^[^/?#]*", 0), UPPER, UPPER.lower())
    return F.coalesce(host, F.lit("")), F.coalesce(F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1), F.lit(""))


def candidate_keys(host: Column, path: Column, labels: int, starts: list[int]) -> Column:
    """Host suffixes of at most ``labels`` labels, each with path starts of given lengths."""
    parts = F.split(host, r"\.", -1)
    first = F.greatest(F.lit(1), F.size(parts) - (labels - 1))
    suffixes = F.transform(
        F.sequence(first, F.size(parts)), lambda i: F.array_join(F.slice(parts, i, F.size(parts)), ".")
    )
    fronts = [F.when(F.char_length(path) >= n, F.substring(path, 1, n)) for n in starts]
    pairs = F.flatten(
        F.transform(suffixes, lambda s: F.transform(F.array(*fronts), lambda p: F.concat(s, p)))
    )
    return F.array_distinct(F.filter(pairs, lambda k: k.isNotNull()))


def _keys_of(spark: SparkSession, keys) -> DataFrame:
    """The values as a DataFrame, made in the JVM."""
    values = F.array(*[F.lit(k) for k in keys]).cast("array<string>")
    return spark.range(1).select(F.explode(values).alias("key"))


def filter_urls(
    pages: DataFrame,
    rules: tuple[tuple[str, str], ...] = RULES,
    listed_hosts: tuple[str, ...] | DataFrame = LISTED_HOSTS,
    max_filter_bytes: int = 64 << 20,
) -> DataFrame:
    """``pages`` with host, path, rule and verdict.  ``rules``: (host and path, verdict);
    ``listed_hosts``: hosts to block, as values or as a DataFrame with the column key."""
    spark = pages.sparkSession
    if not isinstance(listed_hosts, DataFrame):
        listed_hosts = _keys_of(spark, listed_hosts)
    listed_hosts = listed_hosts.select("key").distinct()
    deepest = listed_hosts.agg(F.max(F.size(F.split("key", r"\.", -1)))).first()[0] or 1
    labels = max([deepest, *(len(r.split("/", 1)[0].split(".")) for r, _ in rules)])
    starts = sorted({0, *(len(r) - len(r.split("/", 1)[0]) for r, _ in rules)})
    host, path = split_url(F.col("url"))
    parsed = pages.withColumn("host", host).withColumn("path", path)
    keyed = parsed.withColumn("_keys", candidate_keys(F.col("host"), F.col("path"), labels, starts))
    universe = stage(keyed.select(F.explode("_keys").alias("key")).distinct(), "universe")
    kinds = {}
    for verdict in ("block", "allow"):
        own = _keys_of(spark, [r for r, v in rules if v == verdict]).distinct()
        kinds[verdict] = build_cascades(own, universe, max_filter_bytes)
    listed = build_cascades(listed_hosts, universe, max_filter_bytes)
    hits = F.transform(
        F.col("_keys"),
        lambda k: F.struct(
            F.char_length(k).alias("n"),
            k.alias("rule"),
            F.when(in_any(kinds["block"], k), "block").when(in_any(kinds["allow"], k), "allow").alias("verdict"),
        ),
    )
    best = F.array_max(F.filter(hits, lambda x: x["verdict"].isNotNull()))
    method = F.when(F.exists("_keys", lambda k: in_any(listed, k)), "block").otherwise("allow")
    return (
        keyed.withColumn("_best", best)
        .withColumn("rule", F.col("_best.rule"))
        .withColumn("verdict", F.coalesce(F.col("_best.verdict"), method))
        .drop("_best", "_keys")
    )


def op1_url_filter(pages: DataFrame) -> DataFrame:
    return filter_urls(pages.select("page_id", "url")).select("page_id", "host", "path", "rule", "verdict")


OP1_SQL = r"""
WITH cut AS (
  SELECT page_id, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) END AS rest FROM pages
), parsed AS (
  SELECT page_id,
    coalesce(translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') AS host,
    coalesce(regexp_extract(rest, '^[^/?#]*([^?#]*)', 1), '') AS path
  FROM cut
), rules(rhost, rpath, verdict) AS (
  VALUES ('net', '/', 'block'), ('example.net', '/en/', 'allow'), ('example.com', '/de/', 'block'), ('org', '/fr/', 'allow')
), hit AS (
  SELECT page_id, host, path,
    (SELECT max_by(rhost || rpath, length(rhost || rpath)) FROM rules
     WHERE (host = rhost OR ends_with(host, '.' || rhost)) AND starts_with(path, rpath)) AS rule
  FROM parsed
)
SELECT page_id, host, path, rule,
  coalesce((SELECT verdict FROM rules WHERE rhost || rpath = rule),
    CASE WHEN host = 'spam-farm.example.org' OR ends_with(host, '.spam-farm.example.org')
           OR host = 'example.invalid' OR ends_with(host, '.example.invalid') THEN 'block' ELSE 'allow' END) AS verdict
FROM hit
"""
