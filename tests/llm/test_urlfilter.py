import math
from collections import Counter

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from linkloom.llm import urlfilter as U


def rule(host, path):
    best = None
    for h, p, say in U.RULES:
        if (host == h or host.endswith("." + h)) and path.startswith(p) and (best is None or len(h + p) > len(best[0])):
            best = (h + p, say)
    return best


def parts(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    end = min([rest.find(c) for c in "/?#" if c in rest] or [len(rest)])
    host, tail = rest[:end], rest[end:]
    stop = min([tail.find(c) for c in "?#" if c in tail] or [len(tail)])
    return "".join(c.lower() if c.isascii() else c for c in host), tail[:stop]


def test_pages(spark, data):
    urls = {r.page_id: r.url for r in spark.read.parquet(f"{data}/pages.parquet").collect()}
    for r in U.op8_url_filter(spark, data).collect():
        host, path = parts(urls[r.page_id])
        assert (r.host, r.path) == (host, path)
        best = rule(host, path)
        assert r.rule == (best[0] if best else None)
        assert r.verdict == best[1] if best else r.verdict in ("allow", "block")


URLS = ["http://A.Example.COM/en/x?q=1#f", "https://www.example.com/en/", "https://x.www.example.com/en/y", "https://example.net/es/", "http://notnet/es/", "nothing", None, "", "http://", "x://h", "ftp://u@h:80?x", "http://a.b/c://d/e", "http://Ä.net/fr/é", "http://example.com", "http://" + "a" * 60_000 + ".org/" + "b" * 60_000]


@pytest.mark.parametrize("keep", [len(URLS), 0])
def test_awkward(spark, keep):
    df = spark.createDataFrame([(i, u, "x") for i, u in enumerate(URLS)][:keep] + ([(0, URLS[0], "x"), (None, URLS[1], "x")] if keep else []), "page_id long, url string, host string")
    got = U.judge(df).collect()
    assert len(got) == (keep + 2 if keep else 0)
    for r in got:
        if r.page_id is not None:
            host, path = parts(URLS[r.page_id])
            assert (r.host, r.path) == (host, path)
            assert r.rule == (rule(host, path) or [None])[0]


def test_model_separates(spark):
    good, bad = [f"http://site{i}.com/article/{i * 7}" for i in range(300)], [f"http://casino{i}.net/es/win-{i}" for i in range(300)]
    new = ["http://site999.org/article/4", "http://casino999.org/win-7"]
    got = {r.page_id: r.verdict for r in U.judge(spark.createDataFrame(list(enumerate(good + bad + new)), "page_id int, url string")).collect()}
    assert got[600] == "allow" and got[601] == "block"


def test_models_do_not_see_what_rules_see(spark):
    rows = [("a.b.example.com", "/en/x/y", "a.b./x/y"), ("example.com", "/en/", "/"), ("com", "/en", "/en"), ("", "", ""), ("x.net", "", ""), ("m.x.net", "/fr/1", "m./1")]
    df = spark.createDataFrame(rows, "host string, path string, want string")
    for r in df.withColumn("got", U.beyond_rules(F.col("host"), F.col("path"))).collect():
        assert r.got == r.want, r


def test_likelihood_against_a_plain_loop():
    """Variable-order estimates by dictionaries of contexts, on few enough URLs that no two share a slot."""
    good, bad = ["abcab/1", "abc/2", "bca"], ["xyz", "xaxa/9"]
    frame = pd.DataFrame({"address": good + bad, "rule_verdict": ["allow"] * len(good) + ["block"] * len(bad)})
    flat = np.zeros(4 * (U.ORDER + 1) * U.SLOTS, dtype=np.float32)
    for part in U._count(iter([frame])):
        flat[part["key"]] += part["n"]
    half = len(flat) // 2
    model = U.UrlModel(flat[:half].reshape(2, U.ORDER + 1, U.SLOTS), flat[half:].reshape(2, U.ORDER + 1, U.SLOTS), 0.0)
    for which, texts in enumerate((good, bad)):
        context, pair = Counter(), Counter()
        for t in texts:
            for i, c in enumerate(t):
                for order in range(U.ORDER + 1):
                    key = (order, ("\0" * U.ORDER + t[:i])[-order:] if order else "")
                    context[key] += 1
                    pair[key, c] += 1
        for t in ("abcab", "xyx/1", "q"):
            total = 0.0
            for i, c in enumerate(t):
                p = 1 / 256
                for order in range(U.ORDER + 1):
                    key = (order, ("\0" * U.ORDER + t[:i])[-order:] if order else "")
                    p = (pair[key, c] + U.LOWER_WEIGHT * p) / (context[key] + U.LOWER_WEIGHT)
                total += math.log(p)
            data = np.frombuffer(t.encode(), dtype=np.uint8)
            assert model.log_likelihood(data, np.array([0, len(data)]), which)[0] == pytest.approx(total, rel=1e-5)
