"""Tokens, ranks and small string helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Normalises the sum of 1/i^2.
ZETA_2 = 1.64493406685
WEIGHT = 0.1


def tokens(text: Column) -> Column:
    """Lower-cased runs of letters and digits of any script."""
    return F.filter(F.split(F.lower(text), r"[^\p{L}\p{N}]+"), lambda t: F.char_length(t) > 0)


def query_terms(query: str) -> list[str]:
    """Distinct words of more than two characters, cut at anything but letters and digits."""
    found: list[str] = []
    for word in query.split():
        if len(word) > 2:
            for part in "".join(c if c.isalnum() else " " for c in word.lower()).split():
                if part not in found:
                    found.append(part)
    return found


def term_rank(words: Column, terms: list[str]) -> Column:
    """Rank of an any-of query: each term adds weight * sum(1/i^2) over its occurrences."""
    total = F.lit(0.0)
    for term in terms:
        n = F.size(F.filter(words, lambda w: w == term))
        total = total + F.when(
            n > 0,
            F.aggregate(F.sequence(F.lit(1), n), F.lit(0.0), lambda acc, i: acc + 1.0 / (i.cast("double") * i.cast("double"))),
        ).otherwise(F.lit(0.0))
    return F.round(total * WEIGHT / ZETA_2 / max(1, len(terms)), 6)


def slugify(title: Column) -> Column:
    return F.substring(F.replace(F.replace(F.lower(title), F.lit(" "), F.lit("-")), F.lit("&"), F.lit("and")), 1, 100)


def last_segment(url: Column) -> Column:
    return F.element_at(F.split(url, "/"), -1)


def absolute_url(src: Column, base: str) -> Column:
    return (
        F.when(src.startswith("//"), F.concat(F.lit("https:"), src))
        .when(src.startswith("/"), F.concat(F.lit(base.rstrip("/")), src) if base else src)
        .otherwise(src)
    )


def natural_number(label: Column) -> Column:
    """The number of an all-digit label, 999999 for others; NULL beyond 32 bits."""
    return F.when(label.rlike("^[0-9]+$"), label.try_cast("int")).otherwise(F.lit(999999))


#: English words that a search leaves out.
STOP_WORDS = frozenset(
    "a about above after again against all am an and any are as at be because been before being below between both but by "
    "can did do does doing don down during each few for from further had has have having he her here hers herself him "
    "himself his how i if in into is it its itself just me more most my myself no nor not now of off on once only or other "
    "our ours ourselves out over own s same she should so some such t than that the their theirs them themselves then there "
    "these they this those through to too under until up very was we were what when where which while who whom why will with "
    "you your yours yourself yourselves".split()
)


#: Fixed values of the published English stemmer (Porter 2): whole words with a stem of their own, words left as
#: they are, at the start and after plurals went, and the endings of its steps with what they become.
STEM_OF = {
    "skis": "ski", "skies": "sky", "dying": "die", "lying": "lie", "tying": "tie", "idly": "idl", "gently": "gentl", "ugly": "ugli",
    "early": "earli", "only": "onli", "singly": "singl",
}
STAYS = frozenset("sky news howe atlas cosmos bias andes".split())
STAYS_SINGULAR = frozenset("inning outing canning herring earring proceed exceed succeed".split())
STEP_2 = {
    "ization": "ize", "ational": "ate", "fulness": "ful", "ousness": "ous", "iveness": "ive", "tional": "tion", "biliti": "ble",
    "lessli": "less", "entli": "ent", "ation": "ate", "alism": "al", "aliti": "al", "ousli": "ous", "iviti": "ive", "fulli": "ful",
    "enci": "ence", "anci": "ance", "abli": "able", "izer": "ize", "ator": "ate", "alli": "al", "bli": "ble", "ogi": "og", "li": "",
}
STEP_3 = {
    "ational": "ate", "tional": "tion", "alize": "al", "icate": "ic", "iciti": "ic", "ative": "", "ical": "ic", "ness": "", "ful": "",
}
STEP_4 = "ement ance ence able ible ment ant ent ism ate iti ous ive ize ion al er ic".split()
VOWELS = frozenset("aeiouy")


def _after_syllable(word: str, start: int) -> int:
    """Where the region after the first consonant behind a vowel begins."""
    for i in range(start + 1, len(word)):
        if word[i] not in VOWELS and word[i - 1] in VOWELS:
            return i + 1
    return len(word)


def _short_end(word: str) -> bool:
    """Ends in a short syllable; a consonant y is written Y."""
    if len(word) == 2:
        return word[0] in VOWELS and word[1] not in VOWELS
    return len(word) > 2 and word[-3] not in VOWELS and word[-2] in VOWELS and word[-1] not in VOWELS and word[-1] not in "wxY"


def stem(word: str) -> str:
    """The stem of an English word in lower case, by the published Porter 2 rules."""
    if len(word) <= 2 or word in STAYS:
        return word
    if word in STEM_OF:
        return STEM_OF[word]
    word = "".join("Y" if c == "y" and (i == 0 or word[i - 1] in VOWELS) else c for i, c in enumerate(word))
    head = next((p for p in ("gener", "commun", "arsen") if word.startswith(p)), "")
    first = len(head) if head else _after_syllable(word, 0)
    second = _after_syllable(word, first)

    if word.endswith("sses"):
        word = word[:-2]
    elif word.endswith(("ied", "ies")):
        word = word[:-2] if len(word) > 4 else word[:-1]
    elif word.endswith("s") and not word.endswith(("us", "ss")) and any(c in VOWELS for c in word[:-2]):
        word = word[:-1]
    if word in STAYS_SINGULAR:
        return word

    ending = next((e for e in ("eedly", "ingly", "edly", "eed", "ing", "ed") if word.endswith(e)), "")
    rest = word[: len(word) - len(ending)]
    if ending.startswith("eed"):
        word = rest + "ee" if len(rest) >= first else word
    elif ending and any(c in VOWELS for c in rest):
        word = rest
        if word.endswith(("at", "bl", "iz")):
            word += "e"
        elif len(word) > 1 and word[-1] == word[-2] and word[-1] in "bdfgmnprt":
            word = word[:-1]
        elif len(word) <= first and _short_end(word):
            word += "e"
    if len(word) > 2 and word[-1] in "yY" and word[-2] not in VOWELS:
        word = word[:-1] + "i"

    ending = next((e for e in STEP_2 if word.endswith(e)), "")
    rest = word[: len(word) - len(ending)]
    fits = {"li": rest[-1:] in tuple("cdeghkmnrt"), "ogi": rest.endswith("l")}.get(ending, True)
    if ending and len(rest) >= first and fits:
        word = rest + STEP_2[ending]
    ending = next((e for e in STEP_3 if word.endswith(e)), "")
    rest = word[: len(word) - len(ending)]
    if ending and len(rest) >= (second if ending == "ative" else first):
        word = rest + STEP_3[ending]
    ending = next((e for e in STEP_4 if word.endswith(e)), "")
    rest = word[: len(word) - len(ending)]
    if ending and len(rest) >= second and (ending != "ion" or rest.endswith(("s", "t"))):
        word = rest
    if word.endswith("e"):
        rest = word[:-1]
        if len(rest) >= second or len(rest) >= first and not _short_end(rest):
            word = rest
    elif word.endswith("ll") and len(word) - 1 >= second:
        word = word[:-1]
    return word.replace("Y", "y")


#: What a reader sees of a page: text without comments, scripts and styles.
UNSEEN = r"(?is)<!--.*?-->|<(script|style|template)\b.*?</\1\s*>"


def page_text(html: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(html, UNSEEN, ""), r"<[^>]*>", "")
