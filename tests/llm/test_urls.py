from __future__ import annotations

import re

import numpy as np
import pytest

from strataflow.llm import urls, workload

URLS = [
    "http://example.com/en/1", "http://www.example.com/en/1", "http://a.www.example.com/en/", "HTTPS://EXAMPLE.COM/EN/",
    "http://notexample.com/en/1", "http://example.com", "http://x.net/es/a", "http://x.net/fr", "http://net/fr/?q", "//x.net/fr/",
    "nothing", "", None, "http://", "http://x.org?a=/b#c", "http://x.org#f", "ftp://u:p@É.com:80/p?x://y", "a://b://c/d",
    "http://spam.example.org/", "http://spam.example.org/", "http://x\n.net/es/\nb",
]


def _expected(url):
    host, path = "", ""
    if url is not None and "://" in url:
        rest = url.split("://", 1)[1]
        host = re.split(r"[/?#]", rest, maxsplit=1)[0]
        path = re.split(r"[?#]", rest[len(host) :], maxsplit=1)[0]
        host = re.sub("[A-Z]", lambda m: m.group().lower(), host)
    fits = [
        r for r in workload.URL_RULES if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)
    ]
    rule = max(fits, key=lambda r: len(r.text), default=None)
    own = "block" if re.search(workload.BLOCKED_HOSTS, host) else "allow"
    return host, path, rule.text if rule else None, rule.verdict if rule else own


@pytest.mark.parametrize("part_keys", [urls.PART_KEYS, 1])
def test_cases(spark, part_keys):
    df = spark.createDataFrame([(i, u, 1, True) for i, u in enumerate(URLS)], "page_id long, url string, host int, listed boolean")
    rows = urls.judge(df, workload.URL_RULES, lambda h: h.rlike(workload.BLOCKED_HOSTS), part_keys=part_keys).collect()
    assert len(rows) == len(URLS)
    for r in rows:
        assert (r.host, r.path, r.rule, r.verdict) == _expected(URLS[r.page_id]), URLS[r.page_id]


def test_empty_table_and_list(spark):
    df = spark.createDataFrame([(i, u) for i, u in enumerate(URLS)], "page_id long, url string")
    never = lambda h: h == "no such host"
    assert urls.judge(df.limit(0), workload.URL_RULES, never).count() == 0
    assert not any(r.listed for r in urls.judge(df, [], never).collect())
    assert all(r.verdict == "block" for r in urls.judge(df, [], lambda h: h.isNotNull()).collect())


@pytest.mark.parametrize("share", [2, 10, 300])
def test_cascade_is_exact(spark, share):
    """Every key of the universe is told right, although each level makes mistakes."""
    first, second = urls.key_hashes(_key())
    keys = spark.range(0, 20_000).select("id", first.alias("first"), second.alias("second"))
    listed, others = (keys.where(f"id % {share} {op} 0").drop("id") for op in ("=", "<>"))
    levels = urls.cascade(listed, others)
    assert len(levels) > 1
    for df, answer in ((listed, True), (others, False)):
        rows = df.toPandas()
        found = urls.is_listed(levels, rows["first"].to_numpy(np.int64), rows["second"].to_numpy(np.int64))
        assert (found == answer).all()


def _key():
    from pyspark.sql import functions as F

    return F.col("id").cast("string")
