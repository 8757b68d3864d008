from __future__ import annotations

import random

import numpy as np
import pytest

from strataflow.llm import golay, simhash, workload
from strataflow.llm.components import components
from tests.llm import helpers
from tests.llm.helpers import SF_DIR, documents, groups, near_links, odd_documents, with_clashes


def test_code_is_perfect():
    """Every remainder has one pattern of weight 3 or less, and those of weight 3 five more of weight 4."""
    _, _, patterns = golay.tables()
    weights = np.bitwise_count(np.maximum(patterns, 0))
    assert (weights[:, 0] <= 3).all()
    full = weights[:, 0] == 3
    assert (weights[full, 1:] == 4).all() and (patterns[~full, 1:] == -1).all()


def test_words_one_bit_apart_share_a_key():
    rng = np.random.default_rng(1)
    words = rng.integers(0, 1 << 23, 4000)
    keys = golay.codewords(words)
    for bit in range(23):
        others = golay.codewords(words ^ (1 << bit))
        assert ((others >= 0) & (others == keys[:, :1])).any(axis=1).all()


def _spread(rng, n):
    """Fingerprints in chains and crowds of two bits and less, among others far away."""
    prints = set()
    for _ in range(n):
        at = rng.getrandbits(64)
        prints.add(at)
        for _ in range(rng.choice([0, 0, 1, 3, 30])):
            for bit in rng.sample(range(64), rng.choice([1, 2, 2, 3])):
                at ^= 1 << bit
            prints.add(at)
    return sorted(prints)


@pytest.mark.parametrize("crowd", [256, 1])
def test_links_are_complete(spark, crowd):
    prints = _spread(random.Random(3), 60)
    signed = [p - (1 << 64) if p >> 63 else p for p in prints]
    df = spark.createDataFrame([(p,) for p in signed], "fp long")
    links = [(r.a, r.b) for r in simhash.close_links(df, crowd).collect()]
    as_unsigned = [(a % (1 << 64), b % (1 << 64)) for a, b in links]
    assert groups(as_unsigned, prints) == groups(near_links(prints), prints)


def test_crowd_without_pairs(spark):
    """A crowd around one fingerprint is linked by stars: as many rows as places, not as pairs."""
    rng = random.Random(5)
    centre = rng.getrandbits(63)
    prints = sorted({centre} | {centre ^ (1 << a) ^ (1 << b) for a in range(63) for b in range(a)})
    df = spark.createDataFrame([(p,) for p in prints], "fp long")
    links = simhash.close_links(df, 16)
    found = {r.node: r.root for r in components(links).collect()}
    assert set(found) == set(prints) and set(found.values()) == {min(prints)}
    assert links.count() < 65 * len(prints)


def _graph(kind):
    rng = random.Random(2)
    if kind == "path":
        nodes = list(range(200))
        return [(nodes[i], nodes[i + 1]) for i in range(199)]
    if kind == "shuffled path":
        nodes = rng.sample(range(1000), 200)
        return list(zip(nodes, nodes[1:]))
    if kind == "star":
        return [(500, i) for i in range(300)]
    return [(rng.randrange(400), rng.randrange(400)) for _ in range(300)]


@pytest.mark.parametrize("kind", ["path", "shuffled path", "star", "random"])
def test_components(spark, kind):
    links = _graph(kind)
    df = spark.createDataFrame(links + links[:5], "a long, b long")
    nodes = sorted({n for a, b in links if a != b for n in (a, b)})
    assert {r.node: r.root for r in components(df).collect()} == groups([x for x in links if x[0] != x[1]], nodes)


def _expected(rows):
    prints = {helpers.simhash(t) for _, t in rows}
    of = groups(near_links(sorted(prints)), sorted(prints))
    keys: dict = {}
    for key, text in rows:
        if key is not None:
            root = of[helpers.simhash(text)]
            keys[root] = min(key, keys.get(root, key))
    return sorted(((k, f"{helpers.simhash(t):016x}", keys.get(of[helpers.simhash(t)])) for k, t in rows), key=str)


def test_query_by_brute_force(spark):
    rows = [(r.doc_id, r.text) for r in workload.table(spark, SF_DIR, "documents").collect()]
    found = [tuple(r) for r in workload.QUERIES["op2_simhash"](spark, SF_DIR).collect()]
    assert sorted(found, key=str) == _expected(rows)


def test_odd_rows(spark):
    rows = [r[:2] for r in helpers.odd_rows()]
    found = simhash.near_duplicates(with_clashes(odd_documents(spark))).collect()
    assert sorted(map(tuple, found), key=str) == _expected(rows)


def test_pieces_do_not_change_the_fingerprint(monkeypatch):
    text = helpers.LONG[:20_000].encode()
    whole = simhash.text_fingerprint(text)
    monkeypatch.setattr(simhash, "word_pieces", lambda data: __import__("strataflow.llm.common", fromlist=["x"]).word_pieces(data, 7))
    assert simhash.text_fingerprint(text) == whole
    assert whole % (1 << 64) == helpers.simhash(text.decode())


def test_one_document_of_each_group_stays(spark):
    df = with_clashes(odd_documents(spark))
    kept = simhash.without_near_duplicates(df)
    assert kept.columns == df.columns
    keys = [r.doc_id for r in kept.collect()]
    # 1, 2, 2 and 11 are copies; so are all texts without words.
    assert sorted(map(str, keys)) == sorted(map(str, [1, 3, None, 7, 8, 6, 9, 10]))
    assert simhash.without_near_duplicates(df.limit(0)).count() == 0


def test_empty_table(spark):
    assert simhash.near_duplicates(documents(spark, [])).count() == 0
