from __future__ import annotations

import numpy as np
import pytest

from strataflow.llm import token_counts, workload
from tests.llm.helpers import SF_DIR, documents, odd_documents, with_clashes


def _spans(text):
    encoder = token_counts.encoder(token_counts.VOCABULARY, token_counts.PATTERN)
    pieces = encoder.encoding.decode_tokens_bytes(encoder.encoding.encode_ordinary(text))
    ends = np.cumsum([len(p) for p in pieces]).tolist()
    return pieces, list(zip([0, *ends[:-1]], ends))


def _plain(text, rule):
    """Tokens of each line, byte by byte."""
    data = text.encode()
    line, of_byte = 0, []
    for byte in data:
        of_byte.append(line)
        line += byte == 10
    lines = max(of_byte, default=0) + 1
    given = [0.0] * lines
    for begin, end in _spans(text)[1]:
        own = of_byte[begin:end]
        if rule == "first":
            given[own[0]] += 1
        elif rule == "most":
            given[max(sorted(set(own)), key=own.count)] += 1
        else:
            for section in own:
                given[section] += 1 / len(own)
    return given


TEXTS = ["", "a\nb", "x\n\n\n\n  \n y\n", "\n", "文字\n\U0001f600\n", "one line", "a\r\n\r\nb\n\n\n\n\n\n\n\n\nc", "tail\n\n"]


@pytest.mark.parametrize("rule", ["first", "most", "split"])
def test_rules_by_brute_force(spark, rule):
    df = documents(spark, [(i, t, "en", "s") for i, t in enumerate(TEXTS)])
    rows = token_counts.section_tokens(df, rule=rule).orderBy("doc_id", "section").collect()
    for i, text in enumerate(TEXTS):
        own = [r for r in rows if r.doc_id == i]
        assert np.allclose([r.n_tokens for r in own], _plain(text, rule)), text
        assert "".join(text[r.start_char : r.end_char] for r in own) == text


def test_round_trip_of_the_query(spark):
    """Sections laid end to end are the text; their tokens are those of the whole text."""
    texts = {r.doc_id: r.text for r in workload.table(spark, SF_DIR, "documents").collect()}
    rows = workload.QUERIES["op9_tokens"](spark, SF_DIR).orderBy("doc_id", "section").collect()
    for doc_id, text in texts.items():
        own = [r for r in rows if r.doc_id == doc_id]
        pieces, _ = _spans(text)
        assert b"".join(pieces).decode() == text
        assert sum(r.n_tokens for r in own) == len(pieces)
        assert "".join(text[r.start_char : r.end_char] for r in own) == text
        assert all("\n" not in text[r.start_char : r.end_char - 1] for r in own)


def test_odd_rows(spark):
    df = with_clashes(odd_documents(spark))
    rows = token_counts.section_tokens(df).collect()
    per = {}
    for r in rows:
        per.setdefault(r.doc_id, []).append(r)
    assert 3 not in per and len(per[2]) == 2 * len(per[1])
    assert [(r.section, r.start_char, r.end_char, r.n_tokens) for r in per[4]] == [(0, 0, 0, 0.0)]
    assert token_counts.section_tokens(df.limit(0)).count() == 0
    with pytest.raises(ValueError):
        token_counts.section_tokens(df, rule="last")


def test_fields_as_sections(spark):
    """Sections stated by their first bytes: a title and a body."""
    title = len("Title words")
    df = documents(spark, [(1, "Title wordsand a body", "en", "s")])
    rows = token_counts.section_tokens(df, rule="split", starts_of=lambda data: np.array([0, title])).collect()
    assert [(r.start_char, r.end_char) for r in rows] == [(0, title), (title, 21)]
    assert np.isclose(sum(r.n_tokens for r in rows), len(_spans("Title wordsand a body")[0]))


SPACES = [" ", "\n", "\t", "\u00a0", "\u3000", " \n", "\r\n", "\n "]


@pytest.mark.parametrize("run", SPACES)
@pytest.mark.parametrize("around", [("", ""), ("", "x"), ("a", ""), ("a b", "'ll 12"), ("x\n", "\u6587"), (".", "\x1cx")])
def test_long_spaces_are_encoded_as_they_are(run, around):
    """Runs near and far beyond the bound give the tokens of the whole text."""
    encoder = token_counts.encoder(token_counts.VOCABULARY, token_counts.PATTERN)
    for size in (1, 1023, 1024, 1025, 50_001):
        text = around[0] + (run * size)[:size] + around[1] + " mid" + run * 1500 + "end"
        assert [t for part in encoder.tokens(text) for t in part] == encoder.encoding.encode_ordinary(text)


@pytest.mark.parametrize("unit", [" ", "\n", "a", "7"])
def test_runs_of_ten_million(spark, unit):
    size = 10_000_000
    texts = [unit * size, unit * size + "x y\n"]
    rows = token_counts.section_tokens(documents(spark, [(i, t, "en", "s") for i, t in enumerate(texts)]))
    ends = rows.groupBy("doc_id").agg({"end_char": "max", "n_tokens": "sum"}).orderBy("doc_id").collect()
    assert [r["max(end_char)"] for r in ends] == [len(t) for t in texts]
    assert all(r["sum(n_tokens)"] > 0 for r in ends)
