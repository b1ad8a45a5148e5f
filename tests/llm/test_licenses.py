import re

import pytest

from docspark.llm import licenses


@pytest.mark.parametrize(
    "source, expected",
    [
        ("mit", ["mit"]),
        ("mit or gpl-2.0 and bsd", ["mit", "gpl-2.0", "bsd", "and", "or"]),
        ("(mit or gpl-2.0) and bsd", ["mit", "gpl-2.0", "or", "bsd", "and"]),
        ("gpl-2.0 with classpath-exception-2.0 or mit", ["gpl-2.0", "classpath-exception-2.0", "with", "mit", "or"]),
        ("mit and (", ["mit"]),
        ("mit or or bsd", ["mit"]),
        ("mit */ text", ["mit"]),
        (") mit", []),
        ("", []),
    ],
)
def test_expressions(source, expected):
    assert licenses.postfix(source) == expected


def test_evaluation():
    value = lambda s: licenses.evaluate(licenses.postfix(s))
    assert value("mit or gpl-2.0") == ({"mit", "gpl-2"}, 1.0)
    assert value("mit and gpl-2.0") == ({"mit", "gpl-2"}, 0.3)
    assert value("gpl-2.0 with classpath-exception") == ({"gpl-2"}, 0.65)


ROWS = [
    (1, "Released UNDER the MIT License. Under the MIT license"),
    (2, "Licensed under the Apache-License, Version 2.0; cc by nc cc by-nc"),
    (3, "// SPDX-License-Identifier: (GPL-2.0 WITH Linux-note OR MIT) AND BSD-3-Clause\ncode"),
    (4, None),
    (5, ""),
    (5, ""),
    (6, "mit under the \xe9mit license underthe mit license"),
    (7, "word " * 300_000 + "cc by nc"),
    (None, "All rights reserved."),
]


def test_scan_against_brute_force(spark, docs_of):
    rows = licenses.scan(docs_of(ROWS)).collect()
    assert len(rows) == len(ROWS)
    for r in rows:
        text = next(t for i, t in ROWS if i == r.doc_id) or ""
        words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text))
        places, labels = [], set()
        for phrase, label in licenses.BASE.items():
            want = phrase.split()
            hits = [i for i in range(len(words) - len(want) + 1) if words[i : i + len(want)] == want]
            places += hits
            labels |= {label} if hits else set()
        expected = (len(words), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(labels)))
        assert tuple(r)[1:6] == expected
        assert labels <= set(r.labels.split(",")) and 0 <= r.score <= 1
    by_id = {r.doc_id: r for r in rows}
    assert by_id[3].labels == "bsd-3-clause,gpl-2,mit" and by_id[3].score == 1.0
    assert by_id[None].labels == "all-rights-reserved" and by_id[None].score == 0.0


def test_several_statements_in_one_place():
    phrases = licenses.automaton()
    result = lambda text: licenses.scan_text(text, phrases)[5:]
    tag = b"SPDX-License-Identifier:"
    assert result(tag + b" MIT */ code(); /* " + tag + b" GPL-3.0 */") == ("gpl-3,mit", 0.3)
    assert result(tag + b" MIT OR " + tag + b" GPL-2.0\n" + tag + b"\n" + tag + b" ISC") == ("gpl-2,isc,mit", 0.3)
    assert result(b"text cc by, images CC BY-NC") == ("cc-by,cc-by-nc", 0.1)
    assert result(b"only CC BY-NC and cc by sa") == ("cc-by-nc,cc-by-sa", 0.1)
    gpl = b"GNU General Public License"
    assert result(gpl + b" version 2; parts: " + gpl + b", any version") == ("gpl,gpl-2", 0.3)
    assert result(gpl + b" version 3") == ("gpl-3", 0.3)
    assert result(b"Creative Commons Attribution-NonCommercial (CC BY-NC)") == ("cc-by-nc", 0.1)
