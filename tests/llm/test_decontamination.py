from __future__ import annotations

import itertools
import random
import unicodedata

import numpy as np
import pytest

from strataflow.llm import decontaminate, workload
from tests.llm.helpers import LONG, PLAIN, SF_DIR, documents, odd_documents, with_clashes


SPACELESS = [
    ("\u0e00", "\u0eff"), ("\u1000", "\u109f"), ("\u1780", "\u17ff"), ("\u3040", "\u30ff"), ("\u3400", "\u4dbf"),
    ("\u4e00", "\u9fff"), ("\uf900", "\ufaff"), ("\uff66", "\uff9d"), ("\U00020000", "\U0003ffff"),
]


def _tokens(text):
    """Runs of letters and digits of a folded text, Han and the like one by one."""
    found, run = [], ""
    for c in unicodedata.normalize("NFC", (text or "").casefold()) + " ":
        alone = any(low <= c <= high for low, high in SPACELESS)
        if run and (alone or not c.isalnum()):
            found.append(run)
            run = ""
        if alone:
            found.append(c)
        elif c.isalnum():
            run += c
    return found


def _held(text, item):
    """Whether an unbroken copy of the item stands in the text."""
    words, sought = _tokens(text), _tokens(item)
    return any(words[i : i + len(sought)] == sought for i in range(len(words) - len(sought) + 1))


def _benchmark(spark, rows):
    return spark.createDataFrame(rows, "item_id long, text string")


def test_query_by_brute_force(spark):
    texts = {r.doc_id: r.text for r in workload.table(spark, SF_DIR, "documents").collect()}
    items = {r.item_id: r.text for r in workload.table(spark, SF_DIR, "benchmark").collect()}
    expected = {(d, i) for d, t in texts.items() for i, q in items.items() if _held(t, q)}
    rows = workload.QUERIES["op3_decontamination"](spark, SF_DIR).collect()
    assert expected and expected <= {(r.doc_id, r.item_id) for r in rows}
    for r in rows:
        at, of = _tokens(texts[r.doc_id])[r.doc_start :][: r.n_tokens], _tokens(items[r.item_id])[r.item_start :][: r.n_tokens]
        assert sum(a == b for a, b in zip(at, of)) == r.n_equal >= decontaminate.MIN_SHARE * r.n_tokens
        assert r.n_tokens >= min(decontaminate.MIN_OVERLAP, len(_tokens(items[r.item_id])))


def test_replaced_words_are_tolerated(spark):
    rng = random.Random(4)
    vocabulary = [f"w{i}" for i in range(500)]
    items = [(i, " ".join(rng.choices(vocabulary, k=30))) for i in range(20)]
    rows, clean = [], []
    for i, text in items:
        words = text.split()
        for at in rng.sample(range(30), 3):
            words[at] = "other"
        rows.append((i, " ".join([*rng.choices(vocabulary, k=40), *words, *rng.choices(vocabulary, k=40)]), "en", "s"))
        clean.append((100 + i, " ".join(rng.choices(vocabulary, k=120)), "en", "s"))
    found = decontaminate.contaminated(documents(spark, rows + clean), _benchmark(spark, items)).collect()
    assert {(r.doc_id, r.item_id) for r in found} == {(i, i) for i in range(20)}
    kept = decontaminate.decontaminated(documents(spark, rows + clean), _benchmark(spark, items)).collect()
    assert {r.doc_id for r in kept} == {c[0] for c in clean}


def test_blocks_give_the_same(spark):
    df, items = (workload.table(spark, SF_DIR, t) for t in ("documents", "benchmark"))
    assert len(list(decontaminate.blocks(items, "item_id", "text", 50))) > 3
    whole = sorted(decontaminate.contaminated(df, items).collect())
    assert sorted(decontaminate.contaminated(df, items, block_tokens=50).collect()) == whole
    kept = sorted(r.doc_id for r in decontaminate.decontaminated(df, items, block_tokens=50).collect())
    assert kept == sorted(set(range(df.count())) - {r.doc_id for r in whole})


def test_odd_rows(spark):
    items = [(1, PLAIN), (1, PLAIN), (2, None), (3, ""), (4, "one"), (5, "next line last 文字 ünïcödé fin"), (None, LONG[:500])]
    items += [(6, "fin next line last and then word0x0")]
    df = with_clashes(odd_documents(spark))
    found = {(r.doc_id, r.item_id) for r in decontaminate.contaminated(df, _benchmark(spark, items)).collect()}
    assert found == {(1, 1), (2, 1), (11, 1), (None, 1), (7, None), (10, 4)}
    kept = decontaminate.decontaminated(df, _benchmark(spark, items))
    assert kept.columns == df.columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted(map(str, [3, 4, 5, 6, None, 8, 9]))


def test_short_items_and_empty_tables(spark):
    df = documents(spark, [(1, "say: Alpha, beta gamma DELTA epsilon. now", "en", "s"), (2, "alpha beta x delta epsilon", "en", "s")])
    items = _benchmark(spark, [(9, "alpha beta gamma delta epsilon")])
    assert [(r.doc_id, r.doc_start, r.n_tokens) for r in decontaminate.contaminated(df, items).orderBy("doc_id").collect()] == [(1, 1, 5), (2, 0, 5)]
    assert decontaminate.contaminated(df, items.limit(0)).count() == 0
    assert decontaminate.contaminated(df.limit(0), items).count() == 0
    assert decontaminate.decontaminated(df, items.limit(0)).count() == 2


TALK = "Dies ist \u201eein langer Satz\u201c \u2013 und er h\u00f6rt \u00dcberall gro\u00df auf"
ITEMS = [
    "\u8bf7\u95ee\u5728\u4e2d\u56fd\u5386\u53f2\u4e0a\u54ea\u4e00\u4f4d\u7687\u5e1d\u9996\u5148\u7edf\u4e00\u4e86\u516d\u56fd",
    "\u30a2\u30eb\u30d7\u30b9\u306e\u6700\u9ad8\u5cf0\u306f\u4f55\u3067\u3059\u304b",
    "\u0e40\u0e21\u0e37\u0e2d\u0e07\u0e2b\u0e25\u0e27\u0e07\u0e02\u0e2d\u0e07\u0e44\u0e17\u0e22\u0e04\u0e37\u0e2d\u0e2d\u0e30\u0e44\u0e23",
    "\u041a\u0422\u041e \u041d\u0410\u041f\u0418\u0421\u0410\u041b \u0412\u041e\u0419\u041d\u0423 \u0418 \u041c\u0418\u0420", TALK, TALK.upper(), "GR\u00d6SSE ZEIGT \u00c9COLE", "caf\u0065\u0301 noir", "x1", "\u00e9", "two words", "a b c d",
    *(" ".join(f"k{n}i{i}" for i in range(n)) for n in range(1, 12)),
]


@pytest.mark.parametrize("change", [str, str.upper, str.title, lambda t: t.replace(" ", " \u2014 "), lambda t: unicodedata.normalize("NFD", t)])
def test_every_item_is_found_in_its_own_text(spark, change):
    """Any script, case, punctuation and length."""
    rows = [(i, f"Intro: {change(t)}! End.", "en", "s") for i, t in enumerate(ITEMS)]
    found = decontaminate.contaminated(documents(spark, rows), _benchmark(spark, list(enumerate(ITEMS)))).collect()
    found = {(r.doc_id, r.item_id) for r in found}
    expected = {(d, i) for d, text, *_ in rows for i, t in enumerate(ITEMS) if _held(text, t)}
    assert {(i, i) for i in range(len(ITEMS))} <= expected <= found
    short = {i for i, t in enumerate(ITEMS) if len(_tokens(t)) < 5}
    assert {p for p in found if p[1] in short} == {p for p in expected if p[1] in short}


def test_replaced_characters_of_a_script_without_spaces(spark):
    item = ITEMS[0]
    copy = "".join("\u4e0d" if i % 7 == 3 else c for i, c in enumerate(item))
    other = "".join("\u4e0d" if i % 3 == 0 else c for i, c in enumerate(item))
    df = documents(spark, [(1, f"\u524d{copy}\u540e", "zh", "s"), (2, other, "zh", "s")])
    assert [r.doc_id for r in decontaminate.contaminated(df, _benchmark(spark, [(1, item)])).collect()] == [1]


def test_long_texts_of_other_scripts(monkeypatch):
    text = " ".join([TALK, *ITEMS]) * 5
    whole = decontaminate.tokens(text.encode())
    monkeypatch.setattr(decontaminate, "CHUNK_CHARS", 10)
    assert (decontaminate.tokens(text.encode()) == whole).all() and len(whole) == len(_tokens(text))
    ascii_text = "It's a Test_case, No. 5!"
    assert (decontaminate.tokens(ascii_text.encode()) == decontaminate.tokens((ascii_text + " \u2014").encode())).all()


def _longest_by_brute_force(found, item, offset):
    """Length and most equal tokens of the longest run that passes, before replaced ends go."""
    equal = [0 <= i + offset < len(found) and bool(found[i + offset] == t) for i, t in enumerate(item)]
    inside = [i for i in range(len(item)) if 0 <= i + offset < len(found)]
    runs = [
        (j + 1 - i, sum(equal[i : j + 1]))
        for i in inside
        for j in inside
        if j + 1 - i >= min(decontaminate.MIN_OVERLAP, len(item)) and 5 * sum(equal[i : j + 1]) >= 4 * (j + 1 - i)
    ]
    return max(runs, default=None)


def test_runs_by_brute_force():
    rng = np.random.default_rng(5)
    for n in range(12, 61):
        for share in (0.8, 0.85, 0.9, 0.95):
            item = rng.integers(1, 1 << 60, n).astype(np.uint64)
            copy = item.copy()
            replaced = rng.choice(n, int(n * (1 - share) + 1e-9), replace=False)
            copy[replaced] = 0
            found = np.concatenate([np.full(3, 7, np.uint64), copy, np.full(5, 7, np.uint64)])
            block = decontaminate.Block([1], [item])
            assert decontaminate.overlap(found, item, 3)[3] == n - len(replaced)
            for offset, text in ((3, found), (-2, copy[2:]), (0, copy[: n // 2])):
                longest = _longest_by_brute_force(text, item, offset)
                run = decontaminate.overlap(text, item, offset)
                assert (run is None) == (longest is None)
                passes = block.passing(text, np.array([[0, offset]]))
                assert run is None or (len(passes) == 1 and run[3] == longest[1])


def test_a_dense_stretch_does_not_hide_the_whole(spark):
    words = [f"w{i}" for i in range(15)]
    copy = ["other" if i in (2, 12) else w for i, w in enumerate(words)]
    df = documents(spark, [(1, " ".join(["so", *copy, "and"]), "en", "s")])
    (row,) = decontaminate.contaminated(df, _benchmark(spark, [(7, " ".join(words))])).collect()
    assert (row.item_id, row.doc_start, row.n_tokens, row.n_equal) == (7, 1, 15, 13)


def test_masks_fit_between_all_replacements():
    for n in range(5, 26):
        places = [int(m[::-1], 2) << at for m in decontaminate.masks_of(n) for at in range(n - len(m) + 1)]
        for replaced in itertools.combinations(range(n), n // 5):
            gaps = sum(1 << at for at in replaced)
            assert any(not gaps & place for place in places), (n, replaced)


def test_short_items_with_replaced_words(spark):
    rng = random.Random(6)
    items, rows = [], []
    for n in range(5, 26):
        words = [f"w{n}x{i}" for i in range(n)]
        items.append((n, " ".join(words)))
        for _ in range(10):
            replaced = set(rng.sample(range(n), n // 5))
            copy = ["other" if i in replaced else w for i, w in enumerate(words)]
            rows.append((n, " ".join(["so", "it", *copy, "goes"]), "en", "s"))
    # One replaced word too many.
    clean = [(100 + n, " ".join(["other"] * (n // 5 + 1) + text.split()[n // 5 + 1 :]), "en", "s") for n, text in items if n < 12]
    found = decontaminate.contaminated(documents(spark, rows + clean), _benchmark(spark, items)).collect()
    assert sorted((r.doc_id, r.item_id) for r in found) == sorted((r[0], r[0]) for r in rows)
    assert {(r.doc_start, r.item_start) for r in found if r.n_tokens == r.item_id} <= {(2, 0)}
    kept = decontaminate.decontaminated(documents(spark, rows + clean), _benchmark(spark, items)).collect()
    assert sorted(r.doc_id for r in kept) == [c[0] for c in clean]


def test_hits_in_parts_give_the_same(monkeypatch):
    rng = random.Random(8)
    items = [np.array(rng.choices(range(1, 4), k=k), np.uint64) for k in (5, 6, 9, 14, 40)]
    text = " ".join(rng.choices(["a", "b", "c"], k=400)).encode()
    at = decontaminate.tokens(b"a b c")
    block = decontaminate.Block(list(range(5)), [at[(i - np.uint64(1)).astype(int)] for i in items])
    together = list(block.overlaps(text))
    monkeypatch.setattr(decontaminate, "HITS", 7)
    monkeypatch.setattr(decontaminate, "CELLS", 50)
    assert together and list(block.overlaps(text)) == together
