"""Text functions as column expressions: they stay inside generated code and read the ASCII and Latin cases of
business records; :mod:`linkloom.functions.unicode` covers full Unicode folding and romanisation."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

# What counts as missing, raw and folded.
MISSING_RAW = ["", "null", "none", "nan", "na", "n/a", "-", "--", "?"]
MISSING_FOLDED = ["", "null", "none", "nan", "na", "n a", "nil", "unknown", "not available", "not applicable", "no address", "address not available", "not known", "tbd"]
# Word lists of business names and addresses.
LEGAL = ["inc", "incorporated", "corp", "corporation", "co", "company", "llc", "llp", "lp", "lllp", "ltd", "limited", "plc", "pllc", "pc", "pty", "pvt", "private", "opc", "pvtltd", "sarl", "sas", "sasu", "sa", "eurl", "sci", "snc", "scp", "selarl", "sca", "scop", "eirl", "sem", "cie", "com"]
HONORIFIC = ["mr", "mrs", "ms", "dr", "smt", "shri", "sri", "shree", "sree", "messrs", "mme", "mlle", "kumari", "km"]
CONNECTOR = ["and", "et", "the", "und", "of", "de", "du", "des", "la", "le", "les"]
ALIAS = ["dba", "fka", "aka", "formerly"]
ADDRESS_DROP = ["null", "na", "none", "nan", "nil"]
NAME_ABBREVIATIONS = {"intl": "international", "mfg": "manufacturing", "svcs": "services", "svc": "service", "mgmt": "management", "assoc": "associates", "bros": "brothers", "natl": "national", "grp": "group", "engg": "engineering", "hldgs": "holdings"}
ADDRESS_ABBREVIATIONS = {"rd": "road", "str": "street", "ave": "avenue", "av": "avenue", "blvd": "boulevard", "bd": "boulevard", "hwy": "highway", "ln": "lane", "ct": "court", "pl": "place", "sq": "square", "pkwy": "parkway", "cir": "circle", "apt": "apartment", "bldg": "building", "nr": "near", "opp": "opposite", "r": "rue", "fbg": "faubourg", "imp": "impasse", "rte": "route", "chem": "chemin", "first": "1st", "second": "2nd", "third": "3rd", "fourth": "4th", "fifth": "5th", "sixth": "6th", "seventh": "7th", "eighth": "8th", "ninth": "9th", "tenth": "10th"}
# Ordered sound substitutions of the phonetic key.
SOUNDS = [("tch", "C"), ("chh", "C"), ("sch", "s"), ("ch", "C"), ("sh", "s"), ("ph", "f"), ("gh", "g"), ("kh", "k"), ("bh", "b"), ("dh", "d"), ("th", "t"), ("jh", "j"), ("ck", "k"), ("wh", "v"), ("q", "k"), ("x", "ks"), ("w", "v"), ("z", "s")]
APOSTROPHES = "'’‘ʼ`´′"


def let(value: Column, f: Callable[[Column], Column]) -> Column:
    """f(value), with value computed once: what a lambda names is computed anew for each element and wherever it is named."""
    return F.get(F.transform(F.array(value), f), F.lit(0))


def missing_raw(c: Column) -> Column:
    return c.isNull() | F.lower(F.trim(c)).isin(MISSING_RAW)


def missing_folded(c: Column) -> Column:
    return c.isNull() | c.isin(MISSING_FOLDED)


def null_if_empty(c: Column) -> Column:
    return F.when(c != "", c)


def fold(c: Column) -> Column:
    """Lower case, '&' as a word, everything but letters, marks and numbers as one space; null reads as empty."""
    return F.trim(F.regexp_replace(F.lower(F.replace(F.coalesce(c, F.lit("")), F.lit("&"), F.lit(" and "))), r"[^\p{L}\p{M}\p{N}]+", " "))


def fold_name(c: Column) -> Column:
    """Fold with apostrophes deleted and dotted abbreviations ('l.l.c.') joined, for ASCII and Latin text."""
    plain = F.translate(F.lower(c), APOSTROPHES, "")
    joined = F.regexp_replace(F.replace(plain, F.lit("&"), F.lit(" and ")), r"(?<=(?<![\p{L}\p{M}\p{N}_])\p{L})\.(?=\p{L}(?![\p{L}\p{M}\p{N}_]))", "")
    return F.trim(F.regexp_replace(joined, r"[^\p{L}\p{M}\p{N}]+", " "))


def orig(c: Column) -> Column:
    return F.trim(F.regexp_replace(F.lower(c), r"\s+", " "))


def country(c: Column) -> Column:
    return null_if_empty(F.lower(F.trim(c)))


def tokens(folded: Column) -> Column:
    """Words of a folded string; null gives an empty array."""
    return F.array_remove(F.split(F.coalesce(folded, F.lit("")), " "), "")


def numeric_tokens(c: Column) -> Column:
    """Digit runs without leading zeros (runs of 30 digits or more stay as they are)."""
    return F.transform(F.regexp_extract_all(F.coalesce(c, F.lit("")), F.lit(r"([0-9]+)"), 1), lambda x: F.when(F.length(x) >= 30, x).otherwise(F.regexp_replace(x, "^0+(?=.)", "")))


def numeric_compounds(c: Column) -> Column:
    """'12/3a', '4 / 7', '1-2-3' as '12-3a', '4-7', '1-2-3', each once, in order."""
    found = F.regexp_extract_all(F.lower(F.coalesce(c, F.lit(""))), F.lit(r"(?<![\p{L}\p{N}_])([0-9]+[a-z]?(?:\s*[-/]\s*[0-9]+[a-z]?)+)(?![\p{L}\p{N}_])"), 1)
    return F.array_distinct(F.transform(found, lambda x: F.translate(F.regexp_replace(x, r"\s+", ""), "/", "-")))


def char_ngrams(c: Column, n: int = 3) -> Column:
    """Set of the n-grams of the padded text; a short text is one gram."""
    # one pass over the text: substrings by position would each be counted from its beginning
    grams = lambda p: F.when(F.coalesce(F.length(p) <= n, F.lit(True)), F.array(p)).otherwise(F.array_distinct(F.regexp_extract_all(p, F.lit(rf"(?s)(?=(.{{{n}}}))."), 1)))
    return let(F.concat(F.lit(" "), c, F.lit(" ")), grams)


def merge_letters(joined: Column) -> Column:
    """'smith p c' -> 'smith pc': a space goes if both its neighbours are single letters."""
    return F.regexp_replace(joined, r"(?<![^ ])(\p{L}) (?=\p{L}(?![^ ]))", "$1")


def split_glued(joined: Column) -> Column:
    """A digit after a letter starts a new token."""
    return F.regexp_replace(joined, "(?<=[a-z])(?=[0-9])", " ")


def deleet(token: Column) -> Column:
    """Digits that stand for letters, in tokens with at least two letters and more letters than digits."""
    letters, digits = F.length(F.regexp_replace(token, r"[^\p{L}]", "")), F.length(F.regexp_replace(token, "[^0-9]", ""))
    typo = (digits > 0) & (letters >= 2) & (letters > digits) & ~token.rlike("^[0-9]+(st|nd|rd|th)$")
    return F.when(typo, F.translate(token, "013456789", "oleasgtbg")).otherwise(token)


def phonetic_key(token: Column) -> Column:
    """Consonant skeleton of an ASCII word of three letters or more; null for anything else."""
    t = token
    for a, b in SOUNDS:
        t = F.replace(t, F.lit(a), F.lit(b))
    t = F.replace(F.regexp_replace(t, "c(?=[eiy])", "s"), F.lit("c"), F.lit("k"))
    first = lambda t: F.regexp_replace(F.substring(t, 1, 1), "[aeiouy]", "a")
    rest = lambda t: F.regexp_replace(F.substr(t, F.lit(2)), "[aeiouyh]", "")
    key = let(F.lower(t), lambda t: F.regexp_replace(F.concat(first(t), rest(t)), r"(.)\1+", "$1"))
    return F.when(token.rlike("^[a-z]{3,}$"), let(key, lambda k: F.when(F.length(k) >= 2, k)))


def coarse_key(key: Column) -> Column:
    """Sounds that transliterations confuse fall together; a final 'ng' becomes 'n'."""
    merged = F.regexp_replace(F.translate(key, "cqmbj", "kknvg"), r"(.)\1+", "$1")
    return let(merged, lambda t: F.when((F.length(t) > 2) & t.endswith("ng"), F.regexp_replace(t, "g$", "")).otherwise(t))


def is_subsequence(short: Column, long: Column) -> Column:
    """Whether the letters of `short` (letters and digits only) occur in `long` in order."""
    return F.regexp_like(long, F.array_join(F.split(short, ""), ".*"))


def suffix_like(token: Column, hand: list[str] = LEGAL) -> Column:
    """Short, or sounding like a legal word of four letters or more."""
    keys = F.array(*[phonetic_key(F.lit(h)) for h in hand if len(h) >= 4])
    return (F.length(token) <= 3) | F.coalesce(F.array_contains(keys, phonetic_key(token)), F.lit(False))


def mapped(token: Column, table: dict[str, str]) -> Column:
    pairs = F.create_map(*[F.lit(x) for kv in table.items() for x in kv])
    return F.coalesce(F.try_element_at(pairs, token), token)


def core_tokens(toks: Column, legal: list[str] = LEGAL) -> Column:
    """Tokens without connectors, leading honorifics (never the last token) and legal words; never empty."""
    plain = F.filter(toks, lambda t: ~t.isin(CONNECTOR + ALIAS))
    body = F.when(F.size(plain) > 0, plain).otherwise(toks)
    # position of the first token that is no honorific; the last token never counts as one
    keep = F.filter(F.transform(body, lambda t, i: F.when(~t.isin(HONORIFIC) | (i == F.size(body) - 1), i)), lambda i: i.isNotNull())
    rest = F.slice(body, F.coalesce(F.get(keep, F.lit(0)), F.lit(0)) + 1, F.greatest(F.size(body), F.lit(1)))
    core = F.filter(rest, lambda t: ~t.isin(legal))
    return F.when(F.size(core) > 0, core).otherwise(rest)


def legal_tokens(toks: Column, legal: list[str] = LEGAL) -> Column:
    removed = F.filter(toks, lambda t: t.isin(legal))
    return F.when(F.size(F.filter(toks, lambda t: ~t.isin(legal + CONNECTOR + ALIAS))) > 0, removed).otherwise(F.array().cast("array<string>"))


def address_norm(toks: Column) -> Column:
    """Null words dropped, leading zeros stripped, abbreviations written out."""
    kept = F.filter(toks, lambda t: ~t.isin(ADDRESS_DROP))
    return F.transform(kept, lambda t: mapped(F.regexp_replace(t, "^0+(?=[0-9]+$)", ""), ADDRESS_ABBREVIATIONS))


def postal(nums: Column) -> Column:
    """The longest number of five digits or more, the lexicographically greatest of equals."""
    long = F.filter(nums, lambda x: F.length(x) >= 5)
    return F.array_max(F.transform(long, lambda x: F.struct(F.length(x).alias("n"), x.alias("x"))))["x"]


def jaccard(a: Column, b: Column, empty: Column | None = None) -> Column:
    """|a and b| / |a or b| of two sets; `empty` where both (or, by the caller's choice, either) are empty."""
    union = F.size(F.array_union(a, b))
    return F.when(union > 0, F.size(F.array_intersect(a, b)) / union).otherwise(empty if empty is not None else F.lit(0.0))


def overlap(a: Column, b: Column) -> Column:
    least = F.least(F.size(F.array_distinct(a)), F.size(F.array_distinct(b)))
    return F.when(least > 0, F.size(F.array_intersect(a, b)) / least).otherwise(0.0)
