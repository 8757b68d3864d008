from __future__ import annotations

import re
import textwrap

import pytest

from strataflow.llm import licenses
from tests.llm.helpers import documents, odd_documents, odd_rows, with_clashes


def _text(*names):
    return "\n".join(licenses.SENTENCES[n] for n in names)


WRAPPED = licenses.SENTENCES["bsd-source"].replace(" above ", "\n * above\n * ")
CASES = [
    (_text("mit-notice"), "MIT", None),
    ("Intro words.\n" + _text("mit-grant", "mit-condition", "as-is-implied", "not-liable") + "\nEnd.", "MIT", None),
    (_text("apache-grant", "apache-comply", "apache-copy") + ".\n" + _text("apache-as-is", "apache-see"), "Apache-2.0", None),
    (_text("bsd-grant", "bsd-source", "bsd-binary", "bsd-endorse"), "BSD-3-Clause", None),
    (_text("bsd-grant", "bsd-source", "bsd-binary"), "BSD-2-Clause", None),
    (_text("bsd-grant") + "\n" + WRAPPED + "\n" + _text("bsd-binary"), "BSD-2-Clause", None),
    (_text("bsd-grant", "bsd-binary", "bsd-source"), None, "bsd-grant,bsd-binary,bsd-source"),
    ("no mark before it\n" + _text("apache-notice") + "\nand after", "Apache-2.0", None),
    (_text("gpl3-notice", "mit-notice", "mit-notice"), "GPL-3.0-only,MIT", None),
    (_text("mit-notice").upper().replace(" ", "   "), "MIT", None),
    ("Not released under the MIT License.", None, None),
    (_text("gpl-hope"), None, "gpl-hope"),
]


def test_every_known_sentence_has_an_anchor_and_a_rule():
    for sentence in licenses.SENTENCES.values():
        assert re.search(f"(?i)({licenses.ANCHORS})", sentence)
    assert {n for _, order in licenses.RULES for n in order} <= set(licenses.SENTENCES)
    of_normal = [licenses.normal(s) for s in licenses.SENTENCES.values()]
    assert len(set(of_normal)) == len(of_normal)


@pytest.mark.parametrize("form", ["as it is", "in a long text"])
def test_cases(spark, form):
    lead = "" if form == "as it is" else "Some plain words stand here. " * 200 + "\n"
    rows = [(i, lead + text, "en", "s") for i, (text, _, _) in enumerate(CASES)]
    found = {r.doc_id: r for r in licenses.scan(documents(spark, rows)).collect()}
    for i, (text, names, left) in enumerate(CASES):
        assert (found[i].licenses, found[i].unmatched) == (names, left), text


def test_odd_rows(spark):
    rows = licenses.scan(with_clashes(odd_documents(spark))).collect()
    assert len(rows) == len(odd_rows())
    assert all((r.n_sentences, r.sentences, r.licenses, r.unmatched) == (0, None, None, None) for r in rows)
    assert licenses.scan(documents(spark, [])).count() == 0


def _scanned(spark, texts):
    rows = [(i, text, "en", "s") for i, text in enumerate(texts)]
    found = {r.doc_id: r for r in licenses.scan(documents(spark, rows)).collect()}
    return [found[i] for i in range(len(texts))]


def test_every_sentence_and_rule_is_found_in_its_own_text(spark):
    rows = _scanned(spark, [*licenses.SENTENCES.values(), *(_text(*order) for _, order in licenses.RULES)])
    alone, together = rows[: len(licenses.SENTENCES)], rows[len(licenses.SENTENCES) :]
    assert [r.sentences for r in alone] == list(licenses.SENTENCES)
    found = [(r.licenses, r.sentences, r.unmatched) for r in together]
    assert found == [(name, ",".join(order), None) for name, order in licenses.RULES]


def _wrapped(sentence, begin="", width=60):
    return "\n".join(begin + line for line in textwrap.wrap(sentence, width))


def test_sentences_over_lines_and_inside_them(spark):
    mit = ["mit-grant", "mit-condition", "as-is-implied", "not-liable"]
    apache = ["apache-grant", "apache-comply", "apache-copy", "apache-as-is", "apache-see"]
    notice = "Copyright (c) 2020 A\n"
    grant = "\n\n".join(_wrapped(licenses.SENTENCES[n]) for n in mit)
    header = "\n *\n".join(_wrapped(licenses.SENTENCES[n], " * ") for n in mit)
    usual = "\n#\n".join(_wrapped(licenses.SENTENCES[n], "# ") for n in apache).replace(" at http", " at\n#\n#     http")
    cases = [
        (notice + grant, "MIT", ",".join(mit)),
        ("/*\n * " + notice + header + "\n */\nint main;", "MIT", ",".join(mit)),
        ("# " + notice + usual + "\nimport os", "Apache-2.0", ",".join(apache)),
        ("Title\n" + _wrapped(_text("isc-grant"), width=40), "ISC", "isc-grant"),
        ("BSD License\n" + _wrapped(_text("bsd-grant"), "-- ") + "\n", None, "bsd-grant"),
        ("this tool is Licensed under the MIT License.", "MIT", "mit-licensed"),
        ("See here: the code, if any, is released under the\nMIT License. Bye", "MIT", "mit-notice"),
        ("The code isn't, as some think, licensed under the MIT License.", None, None),
        ("It is no longer released under the MIT License. Data is licensed under CC BY 4.0.", "CC-BY-4.0", "cc-by-notice"),
        ("This work is licensed under the GNU General Public License, version 3 or later.", None, None),
        ("Unlicensed under the MIT License.", None, None),
    ]
    for (text, names, sentences), row in zip(cases, _scanned(spark, [text for text, _, _ in cases])):
        assert (row.licenses, row.sentences) == (names, sentences), text
