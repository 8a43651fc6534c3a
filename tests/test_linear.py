"""Features of long records: one pass over the text, and the same sets as by position."""

import time

from pyspark.sql import functions as F

from linkloom.functions.text import char_ngrams
from linkloom.operators.features import char_features, sorted_pairs


def test_char_ngrams_of_any_text(spark):
    texts = ["", "a", "ab", "abcabc", "x\ny  z", "né\U0001f600\U0001f601z", "\U0001f600", None]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, t string")
    for n in (2, 3, 5):
        got = {r.i: r.g for r in df.select("i", char_ngrams(F.col("t"), n).alias("g")).collect()}
        for i, t in enumerate(texts):
            p = None if t is None else f" {t} "
            want = [p] if p is None or len(p) <= n else list(dict.fromkeys(p[j : j + n] for j in range(len(p) - n + 1)))
            assert got[i] == want


def test_a_long_name_takes_linear_time(spark):
    """200,000 characters: by position each gram copied and counted through the whole text."""
    df = spark.createDataFrame([([f"w{i}" for i in range(30_000)],)], "core array<string>")
    begin = time.monotonic()
    n = df.select(F.size(char_features("cn:", F.array_join("core", ""))).alias("n")).first()["n"]
    joined = f" {''.join(f'w{i}' for i in range(30_000))} "
    assert n == len({joined[i : i + 3] for i in range(len(joined) - 2)}) and time.monotonic() - begin < 15


def test_pairs_of_the_first_six(spark):
    df = spark.createDataFrame([(list("hgfedcbaab"),), ([],)], "x array<string>")
    got = [r.p for r in df.select(sorted_pairs("k:", F.col("x")).alias("p")).collect()]
    assert got == [[f"k:{a}|{b}" for i, a in enumerate("abcdef") for b in "abcdef"[i + 1 :]], []]
