from __future__ import annotations

from pyspark.sql import functions as F

from strataflow.llm import langid, secret_scan, workload
from tests.llm.helpers import documents, odd_documents, with_clashes

KEY = "AKIA" + "QWERTY12UIOP34AS"
HEX = "0123456789abcdef0123456789abcdef01234567"
WORDS = "plain words of a text that says nothing in particular "


def _rows(n):
    """Documents with a secret, with a long word, and with a long number, in turn."""
    rows = []
    for i in range(n):
        hexed = f"{i * 7919 + 12345:08x}" * 5
        kinds = [f'token = "{hexed}" and', f"password={hexed[:18]} then", f"AKIA{hexed[:16].upper()} so"]
        harmless = ["extraordinarilylongword here", f"{i + 10**15} is a number", "anotherverylongwordinatext ok"]
        rows.append((i, WORDS + (kinds[i % 3] if i % 2 else harmless[i % 3]) + " " + WORDS, "en", "s"))
    return rows


def test_held_out_accuracy(spark):
    df = workload.table(spark, "/root/testdata/sf0.01", "documents")
    labelled = workload.labelled_findings(df)
    scanner = secret_scan.fit(labelled, secret_scan.fit_dictionary(df))
    held = secret_scan.candidates(df.where(langid.held_out(F.col("doc_id")))).withColumn("label", workload.finding_label())
    rows = scanner.judge(held.where("label IS NOT NULL")).collect()
    assert len(rows) > 20 and {r.label for r in rows} == {0, 1}
    assert sum(r.secret == bool(r.label) for r in rows) >= 0.95 * len(rows)


def test_same_answer_in_every_run(spark):
    df = documents(spark, _rows(120))
    runs = [sorted(secret_scan.scan(df, workload.labelled_findings(df)).collect()) for _ in range(2)]
    assert runs[0] == runs[1] and len(runs[0]) == 120
    assert [r.secret for r in sorted(runs[0])] == [bool(i % 2) for i in range(120)]


def test_candidates(spark):
    text = f"a={KEY};b={HEX} next {KEY} {KEY}\nshort éééééééééééééééééééé"
    rows = secret_scan.candidates(documents(spark, [(1, text, "en", "s")])).orderBy("word_at", "run_at").collect()
    assert [(r.word_at, r.run_at, r.value) for r in rows] == [(0, 0, KEY), (0, 1, HEX), (2, 0, KEY), (3, 0, KEY)]
    assert (rows[2].before, rows[2].after) == (f"a={KEY};b={HEX} next", KEY)


def test_features_are_defined_for_any_value(spark):
    values = ["0" * 16, "a" * 16, "-" * 16, "A1" * 20, "/usr/local/lib/python", KEY]
    df = documents(spark, [(i, v, "en", "s") for i, v in enumerate(values)])
    rows = secret_scan.with_features(secret_scan.candidates(df), []).collect()
    assert len(rows) == len(values)
    assert all(r[f] is not None for r in rows for f in secret_scan.FEATURES)


def test_one_kind_of_label_or_none(spark):
    df = documents(spark, _rows(9))
    found = secret_scan.candidates(df)
    for label, expected in ((1, True), (0, False), (None, False)):
        labelled = found.withColumn("label", F.lit(label).cast("int"))
        assert {r.secret for r in secret_scan.scan(df, labelled).collect()} == {expected}


def test_odd_rows(spark):
    df = with_clashes(odd_documents(spark))
    rows = secret_scan.scan(df, workload.labelled_findings(df)).collect()
    assert {r.doc_id for r in rows} == {8} and rows[0].length == 200_000
    empty = secret_scan.scan(df.limit(0), workload.labelled_findings(df.limit(0)))
    assert empty.count() == 0


def test_redacted(spark):
    df = documents(spark, _rows(60) + [(1000, None, "en", "s")])
    scanner = secret_scan.fit(workload.labelled_findings(df), secret_scan.fit_dictionary(df))
    texts = {r.doc_id: r.text for r in secret_scan.redacted(df, scanner).collect()}
    before = {r.doc_id: r.text for r in df.collect()}
    assert len(texts) == 61 and texts[1000] is None
    for i in range(60):
        assert ("[secret]" in texts[i]) == bool(i % 2)
        if i % 2 == 0:
            assert texts[i] == before[i]


def test_redacted_without_keys(spark):
    df = documents(spark, _rows(60))
    scanner = secret_scan.fit(workload.labelled_findings(df), secret_scan.fit_dictionary(df))
    expected = sorted(r.text for r in secret_scan.redacted(df, scanner).collect())
    assert sum("[secret]" in t for t in expected) == 30
    for key in (None, 5):
        keyless = df.withColumn("doc_id", F.lit(key).cast("long"))
        found = secret_scan.redacted(keyless, scanner).collect()
        assert sorted(r.text for r in found) == expected and {r.doc_id for r in found} == {key}


def _triple_words(first, last):
    letters = "abcdefghijklmnopqrstuvwxyz"
    return [letters[i // 676] + letters[i // 26 % 26] + letters[i % 26] for i in range(first, last)]


def test_dictionary_counts_all_documents(spark):
    rare = _triple_words(0, 1000)
    rows = [(i, rare[i] if i < 1000 else "zzz", "en", "s") for i in range(3000)]
    assert set(secret_scan.fit_dictionary(documents(spark, rows))) == {*rare, "zzz"}


def test_dictionary_covers_small_languages(spark):
    large, small = _triple_words(0, 3000), _triple_words(17000, 17020)
    rows = [(i, " ".join(large), "en", "s") for i in range(40)]
    rows += [(100 + i, " ".join(small * 5), "de", "s") for i in range(3)] + [(200, "one", None, "s"), (201, None, "fr", "s")]
    df = documents(spark, rows)
    found = secret_scan.fit_dictionary(df, lang="lang")
    assert len(found) == len(set(found)) == secret_scan.DICTIONARY_SIZE and set(small) <= set(found)
    assert not set(small) & set(secret_scan.fit_dictionary(df))
