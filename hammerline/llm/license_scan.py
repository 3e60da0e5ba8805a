"""License detection by ordered signature rules, in DataFrame expressions only.

A text becomes its words.  Words that start some rule are found first; only there the rules of that keyword
whose gate word follows are tried, as regular expressions on the next words.  A detection is suppressed if
its words lie within those of one with a better priority, or within a longer one of the same priority
(of equal ones the earlier rule stays).  As no rule is longer than some forty words, a detection is
compared with those that start at most so many words before it.  All of it is one projection: no
shuffle, no Python.  See ``license_rules`` for the rules.

Defined cases: null and empty texts, and those of punctuation, have no words and no detection; repeated rows get a row
each; a very long text takes time in proportion to its words; of detections with the same words and priority the
earlier rule stays; an empty table gives an empty result; extra columns pass through, those named
n_words and detections are replaced.
"""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .license_rules import BASE, Rule, build_rules, longest
from .shared import ascii_lower

RULES = "map<string, array<struct<rule: int, gate: string, regex: string, label: string, priority: int, weight: double>>>"
#: What stands between words: ASCII but for digits and letters.
BETWEEN = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def bind(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of a value that is computed once."""
    return F.element_at(F.transform(F.array(value), use), 1)


def rule_map(rules: list[Rule]) -> Column:
    """From keyword to its rules: one constant, which keeps the plan small."""
    by_word: dict[str, list[Rule]] = {}
    for rule in rules:
        by_word.setdefault(rule.keyword, []).append(rule)

    def one(rule: Rule) -> dict:
        return {"rule": rule.number, "gate": rule.gate and f"{rule.gate} "} | {n: getattr(rule, n) for n in ("regex", "label", "priority", "weight")}

    return F.from_json(F.lit(json.dumps({word: list(map(one, own)) for word, own in by_word.items()})), RULES)


def found_at(ahead: Column, at: Column, rules: Column) -> Column:
    """The detections of ``rules`` at a word, ``ahead`` being the lower-case words from there on."""

    def tried(rule: Column) -> Column:
        match = F.call_function("regexp_extract", ahead, rule["regex"], F.lit(0))
        n = F.when((rule["gate"] == "") | F.contains(ahead, rule["gate"]), F.char_length(match) - F.char_length(F.replace(match, F.lit(" "))))
        return F.struct(
            at.alias("start"), (at + n).alias("end"), rule["label"].alias("label"), rule["rule"].alias("rule"),
            rule["priority"].alias("priority"), rule["weight"].alias("weight"),
        )

    return F.filter(F.transform(rules, tried), lambda d: d["end"] > d["start"])


def is_suppressed(own: Column, before: Column) -> Column:
    """Whether a detection of ``before`` (arrays by place, up to this one's) holds ``own``."""

    def holds(other: Column) -> Column:
        size, others = own["end"] - own["start"], other["end"] - other["start"]
        same = (other["priority"] == own["priority"]) & ((others > size) | ((others == size) & (other["rule"] < own["rule"])))
        return (other["end"] >= own["end"]) & ((other["priority"] < own["priority"]) | same)

    return (own["priority"] != BASE) & F.exists(before, lambda place: F.exists(place, holds))


def detect(words: Column, lead: Column, rules: list[Rule]) -> Column:
    """All detections in order, with ``kept``; ``lead`` is 1 if an empty word stands first."""
    keywords = sorted({r.keyword for r in rules})
    known, reach = rule_map(rules), longest(rules)

    def at_place(i: Column) -> Column:
        ahead = ascii_lower(F.concat(F.array_join(F.slice(words, i + 1, F.lit(reach)), " "), F.lit(" ")))
        return bind(ahead, lambda a: found_at(a, (i - lead).cast("long"), F.coalesce(F.try_element_at(known, F.substring_index(a, " ", 1)), F.element_at(known, F.lit(keywords[0])))))

    starts = F.array_compact(F.transform(words, lambda w, i: F.when(F.lower(w).isin(keywords), i)))
    places = F.filter(F.transform(starts, at_place), lambda found: F.size(found) > 0)

    def judged(places: Column) -> Column:
        def place(found: Column, k: Column) -> Column:
            before = F.slice(places, F.greatest(F.lit(1), k + 2 - reach), F.least(k + 1, F.lit(reach)))
            return bind(before, lambda b: F.transform(found, lambda d: d.withField("kept", ~is_suppressed(d, b))))

        return F.flatten(F.transform(places, place))

    return bind(places, judged)


def scan_licenses(docs: DataFrame, rules: list[Rule] | None = None) -> DataFrame:
    """``docs`` (text and any columns) with n_words and detections: array of start and end in words,
    label, rule number, priority, weight and whether it is kept."""
    rules = rules or build_rules()
    words = F.split(F.coalesce(F.col("text"), F.lit("")), BETWEEN, -1)

    def scanned(words: Column) -> Column:
        lead = (F.element_at(words, 1) == "").cast("int")
        tail = ((F.size(words) > 1) & (F.element_at(words, -1) == "")).cast("int")
        return F.struct((F.size(words) - lead - tail).cast("long").alias("n_words"), detect(words, lead, rules).alias("detections"))

    kept = [c for c in docs.columns if c not in ("n_words", "detections")]
    own = max(docs.columns, key=len) + "_scan"  # a name that no column has
    return docs.select(*kept, bind(words, scanned).alias(own)).select(*kept, F.col(own)["n_words"].alias("n_words"), F.col(own)["detections"].alias("detections"))


def op12_license_scan(docs: DataFrame) -> DataFrame:
    found = scan_licenses(docs.select("doc_id", "text"))
    base = F.filter("detections", lambda d: d["priority"] == BASE)
    kept = F.filter("detections", lambda d: d["kept"])
    starts = F.transform(base, lambda d: d["start"])

    def joined(own: Column) -> Column:
        return F.array_join(F.array_sort(F.array_distinct(F.transform(own, lambda d: d["label"]))), ",")

    return found.select(
        "doc_id", "n_words", F.size(base).cast("long").alias("n_base"), F.array_min(starts).alias("first_word"), F.array_max(starts).alias("last_word"),
        joined(base).alias("base_labels"), joined(kept).alias("labels"), F.coalesce(F.array_max(F.transform(kept, lambda d: d["weight"])), F.lit(0.0)).alias("score"),
    )


def _sql() -> str:
    rules = build_rules()
    values = ",\n  ".join(f"({r.number}, '{r.keyword}', '{r.gate}', '{r.regex}', '{r.label}', {r.priority}, {r.weight})" for r in rules)
    return f"""
WITH rules(rule, keyword, gate, regex, label, priority, weight) AS (VALUES
  {values}
), split AS (
  SELECT row_number() OVER () AS rid, doc_id, list_filter(regexp_split_to_array(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{BETWEEN}'), lambda x: x <> '') AS w FROM documents
), placed AS (
  SELECT rid, w, unnest(range(len(w))) AS pos, unnest(w) AS word FROM split
), ahead AS (
  SELECT rid, pos, word, array_to_string(w[pos + 1:pos + {longest(rules)}], ' ') || ' ' AS ahead FROM placed WHERE word IN (SELECT keyword FROM rules)
), tried AS (
  SELECT rid, pos, rule, label, priority, weight, regexp_extract(ahead, regex) AS match FROM ahead JOIN rules ON word = keyword
  WHERE gate = '' OR contains(ahead, gate || ' ')
), found AS (
  SELECT *, pos + length(match) - length(replace(match, ' ', '')) AS till FROM tried WHERE match <> ''
), kept AS (
  SELECT * FROM found d WHERE priority = {BASE} OR NOT EXISTS (
    SELECT 1 FROM found o WHERE o.rid = d.rid AND o.pos <= d.pos AND o.till >= d.till AND (o.priority < d.priority OR (o.priority = d.priority
      AND (o.till - o.pos > d.till - d.pos OR (o.till - o.pos = d.till - d.pos AND o.rule < d.rule)))))
), labels AS (
  SELECT rid, string_agg(DISTINCT label, ',' ORDER BY label) AS labels, max(weight) AS score FROM kept GROUP BY rid
), base AS (
  SELECT rid, count(*) AS n_base, min(pos) AS first_word, max(pos) AS last_word, string_agg(DISTINCT label, ',' ORDER BY label) AS base_labels
  FROM found WHERE priority = {BASE} GROUP BY rid
)
SELECT doc_id, len(w) AS n_words, coalesce(n_base, 0) AS n_base, first_word, last_word, coalesce(base_labels, '') AS base_labels,
  coalesce(labels, '') AS labels, CAST(coalesce(score, 0) AS DOUBLE) AS score
FROM split LEFT JOIN labels USING (rid) LEFT JOIN base USING (rid)
"""


OP12_SQL = _sql()
