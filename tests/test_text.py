"""Golden values of the text functions."""

import pytest
from pyspark.sql import functions as F

from linkloom.functions import represent as R
from linkloom.functions import text as T
from linkloom.functions import unicode as U
from linkloom.operators import features as X

#: Names and addresses with one thing each that folding has to see to.
FOLDED = [
    ("Blue Heron Tea Co.", "blue heron tea co"), ("R.K.N. Exports", "rkn exports"), ("B.V.", "bv"), ("O'Hara's Diner", "oharas diner"),
    ("Oak & Elm", "oak and elm"), ("Oak&Elm", "oak and elm"), ("Jean-Luc", "jean luc"), (" two \t gaps  here ", "two gaps here"),
    ("No. 7; 2nd Floor", "no 7 2nd floor"), ("(C) Plus+ Ltd", "c plus ltd"),
]
UNICODE_FOLDED = [*FOLDED, ("Zoë’s Garden", "zoes garden"), ("Crème Brûlée", "creme brulee"), ("Bœuf & Frères", "boeuf and freres"), ("GROẞE Gasse", "grosse gasse"), ("Ｔｏｋｙｏ　４２", "tokyo 42"), ("Łódź Ørsted", "lodz orsted"), ("मीना वस्त्र", "मीना वस्त्र"), ("दुकान ४५।", "दुकान 45"), ("न्\u200dय", "न्य"), ("v.1.x", "v 1 x")]
#: Common words and places in nine scripts.
ROMAN = [("दिल्ली", "dilli"), ("भारत", "bharat"), ("मुंबई", "mumbai"), ("नगर", "nagar"), ("विजय", "vijay"), ("सीता", "sita"), ("पुस्तक", "pustak"), ("समय", "samay"), ("बंगला", "bangala"), ("चंपा", "champa"), ("ज़मीन", "zamin"), ("सड़क", "sarak"), ("अमृत", "amrit"), ("चन्द्र", "chandra"), ("ओम", "om"), ("तमिल", "tamil"), ("மதுரை", "maturai"), ("తిరుపతి", "tirupati"), ("ಮೈಸೂರು", "maisuru"), ("കേരളം", "keralam"), ("ঢাকা", "dhaka"), ("ਪੰਜਾਬ", "panjab"), ("સુરત", "surat"), ("ଓଡ଼ିଶା", "orisha"), ("mixed नगर text", "mixed nagar text"), ("only ascii", "only ascii")]
PHONETIC = [("philip", "flp"), ("filip", "flp"), ("quick", None), ("quickly", "kl"), ("schmidt", "smdt"), ("wilson", "vlsn"), ("vilson", "vlsn"), ("cecil", "sl"), ("zebra", "sbr"), ("xavier", "ksvr"), ("otto", "at"), ("io", None), ("a1c", None), ("eau", None)]
CORE = [("harbor lights inc", "harbor lights"), ("the green door llp", "green door"), ("mrs patel sweets pvt ltd", "patel sweets"), ("fish and chips", "fish chips"), ("ltd edition prints", "edition prints"), ("inc", "inc"), ("dr shri", "shri"), ("house of tea aka tea house", "house tea tea house")]


def column(spark, values, f):
    return [r[0] for r in spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string").withColumn("o", f(F.col("v"))).orderBy("i").select("o").collect()]


@pytest.mark.parametrize(("cases", "f"), [
    (FOLDED, T.fold_name), (PHONETIC, T.phonetic_key), (CORE, lambda c: F.array_join(T.core_tokens(T.tokens(c)), " ")),
    ([("jones a b", "jones ab"), ("x y z", "xyz"), ("9 e oak", "9 e oak"), ("t n nagar", "tn nagar")], T.merge_letters),
    ([("unit14", "unit 14"), ("floor2nd", "floor 2nd"), ("77b", "77b"), ("61st", "61st")], T.split_glued),
    ([("m0tors", "motors"), ("8akery", "bakery"), ("4x", "4x"), ("2nd", "2nd"), ("c7", "c7"), ("1999", "1999")], T.deleet),
    ([("bcqj", "vkg"), ("smmng", "sn"), ("mj", "ng")], T.coarse_key),
    ([("Ward 9-21-7, Lake View", "9-21-7"), ("45/6C Hill Rd", "45-6c"), ("Door 8 / 3, Wing 1-A", "8-3"), ("22 Baker Street", ""), ("Rooms 5, 10-12 North", "10-12")], lambda c: F.array_join(T.numeric_compounds(c), " ")),
    ([("0042 or 9", "42 9"), ("00", "0"), (None, "")], lambda c: F.array_join(T.numeric_tokens(c), " ")),
    ([("ab", " ab|ab "), ("", "  ")], lambda c: F.array_join(T.char_ngrams(c), "|")),
])
def test_native(spark, cases, f):
    assert column(spark, [a for a, _ in cases], f) == [b for _, b in cases]


@pytest.mark.parametrize(("raw", "want"), UNICODE_FOLDED)
def test_unicode_fold(raw, want):
    assert U.fold(raw) == want


@pytest.mark.parametrize(("raw", "want"), ROMAN)
def test_romanize(raw, want):
    assert U.romanize(raw) == want


def test_orig_compounds_script():
    assert U.orig("Zoë  Ñandú,  B.V.") == "zoë ñandú, b.v."
    assert U.compounds("मकान ४५/६, 7 - 8a") == ["45-6", "7-8a"]
    assert [U.script(s) for s in ("tea", "चाय", "42", "", "tea चाय की दुकान")] == ["latin", "devanagari", "none", "none", "mixed"]
    assert U.unsupported("中文") and not U.unsupported("abc 1")


def test_missing(spark):
    for raw in ("\t", "None", "nan", "n/a", " N.A ", "--", "??", "TBD", "not known", "No Address", "NIL."):
        assert U.fold(raw) in T.MISSING_FOLDED
    for raw in ("Nile Cafe", "B", "None Such Ltd", "24-7 Gym"):
        assert U.fold(raw) not in T.MISSING_FOLDED
    df = spark.createDataFrame([("N/A",), (None,), ("Acme & Co",)], "v string").select(U.clean("v").alias("c"))
    assert sorted((r.c.missing, r.c.fold) for r in df.collect() if r.c.fold) == [(False, "acme and co")]


def test_features(spark):
    row = spark.createDataFrame([(["b", "a"], ["12", "main", "st"])], "core array<string>, addr array<string>")
    none = F.array().cast("array<string>")
    got = row.select(X.name_features(F.col("core"), none).alias("n"), X.address_features(F.col("addr"), F.array(F.lit("12")), none).alias("a"), X.cross_features(F.col("core"), F.col("addr")).alias("x")).first()
    assert set(got.n) == {"n:a", "n:b", "nb:a|b"}
    assert set(got.a) == {"a:12", "a:main", "a:st", "ab:12|main", "ab:main|st", "#:12"}
    assert got.x == []


def test_represent(spark):
    rows = [("sharma traders pvt ltd", "no238 mg rd 007"), ("शर्मा ट्रेडर्स", None), ("acme corp dba best foods", "null 12"), (None, "r 5"), ("shri balaji", None)]
    got = R.represent(spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "i int, name_fold string, address_fold string")).orderBy("i").collect()
    assert (got[0].name_core, got[0].name_suffix, got[0].name_sorted_key, got[0].name_initials, got[0].name_phon) == ("sharma traders", "pvt ltd", "sharma traders", "st", "srm trdrs")
    assert (got[0].address_tokens_norm, got[0].address_nums) == ("no 238 mg road 7", "238 7")
    assert (got[1].name_script, got[1].name_core, got[1].address_tokens) == ("devanagari", "sharma tredars", None)
    assert (got[2].name_alias, got[2].name_sorted_key, got[2].name_core, got[2].address_tokens_norm) == ("best foods", "acme", "acme best foods", "12")
    assert (got[3].name_core, got[3].address_tokens_norm) == (None, "rue 5")
    assert (got[4].name_prefix, got[4].name_core) == ("shri", "balaji")


def test_profile_fold():
    """Marks go from Latin letters only."""
    assert U.fold_for_profile("Crème À LA Ｃarte") == "creme a la carte" and U.fold_for_profile("Straße") == "strasse"
    assert U.fold_for_profile("की É") == "की e" and U.fold_for_profile("é̂x कि̂") == "ex कि̂"
