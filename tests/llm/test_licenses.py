from __future__ import annotations

import re

import pytest

from renewline.llm import licenses
from tests.llm import data

TEXTS = data.odd_texts() + [
    "Released under the MIT License.",
    "mit license MIT-License mit  license! premit license mit licenses",
    "GNU General Public License, version 3. See the Apache License, Version 2.0 too",
    "SPDX-License-Identifier: BSD-3-Clause",
    "Permission is hereby granted, free of charge, to any person obtaining a copy of it",
    "general public license general public license",
    "x General PUBLIC\nlicenseé general public license",
    "All rights reserved.",
    data.prose(3, 500) + " Apache License " + data.prose(4, 500) + " mit license",
]


def plain(text: str | None) -> tuple:
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered)
    places, labels = [], set()
    for phrase, label in licenses.BASE.items():
        parts = phrase.split()
        for i in range(len(words)):
            if words[i : i + len(parts)] == parts:
                places.append(i)
                labels.add(label)
    return len(words), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(labels))


@pytest.fixture(scope="module")
def rows(spark, tmp_path_factory):
    folder = data.parquet(data.documents(spark, TEXTS), tmp_path_factory.mktemp("licenses"))
    return licenses.op6_license_scan(spark, folder).collect()


def test_base_equals_brute_force(rows):
    assert len(rows) == len(TEXTS) + 3
    for r in rows:
        if r.doc_id is not None:
            assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) == plain(TEXTS[r.doc_id])
        assert set(filter(None, r.base_labels.split(","))) <= set(r.labels.split(","))
        assert 0 <= r.score <= 1 and (r.score > 0) == bool(r.labels)
        assert r.labels == ",".join(sorted(set(r.labels.split(","))))


def test_clean_texts_have_no_labels(rows):
    odd = len(data.odd_texts())
    assert {r.labels for r in rows if r.doc_id is not None and r.doc_id < odd} == {""}


@pytest.fixture(scope="module")
def scanner():
    return licenses.Scanner()


def labels(scanner, text):
    return scanner.scan(text)[5].split(",")


def test_longer_and_higher_rules_suppress_contained_ones(scanner):
    assert labels(scanner, "licensed under the Apache License, Version 2.0") == ["apache", "apache-2.0"]
    spans = scanner.scan("licensed under the Apache License, Version 2.0")[7]
    assert spans == [{"label": "apache-2.0", "first_word": 0, "last_word": 7}]
    assert labels(scanner, "the GNU Lesser General Public License v2.1") == ["gpl", "lgpl-2.1"]
    assert labels(scanner, "SPDX-License-Identifier: BSD-3-Clause") == ["bsd-3-clause"]


def test_every_rule_is_gated_by_a_keyword_of_its_matches():
    found = licenses.rules()
    assert len(found) > 300
    for rule in found:
        words = set(re.findall(r"[a-z0-9]+", rule.pattern))
        assert any(w.startswith(rule.keyword) for w in words), rule


@pytest.mark.parametrize("label,names", licenses.NAMES.items())
def test_names_are_found(scanner, label, names):
    for name in names:
        plain_name = re.sub(r"\(\?:([^()|]*)(?:\|[^()]*)?\)\??", r"\1", name).replace(" ?", " ").replace("?", "")
        found = labels(scanner, f"some words {plain_name} and more")
        assert any(f.split("-")[0] == label.split("-")[0] for f in found), (name, plain_name, found)


def test_intervals():
    kept = licenses._Intervals()
    kept.add(10, 20)
    kept.add(15, 30)
    assert kept.holds(11, 19) and kept.holds(16, 30) and not kept.holds(9, 12) and not kept.holds(12, 31)
    kept.add(5, 40)
    assert kept.starts == [5] and kept.holds(16, 40)


def test_empty_table(spark, tmp_path):
    assert licenses.op6_license_scan(spark, data.parquet(data.documents(spark, []), tmp_path)).count() == 0


@pytest.mark.parametrize("text,expected", [
    *((f"# SPDX-License-Identifier: {name}", label) for name, label in [
        ("MIT", "mit"), ("MIT-0", "mit-0"), ("ISC", "isc"), ("Zlib", "zlib"), ("Unlicense", "unlicense"), ("BSL-1.0", "boost"),
        ("Artistic-2.0", "artistic"), ("CDDL-1.0", "cddl"), ("OFL-1.1", "ofl"), ("PostgreSQL", "postgresql"), ("NCSA", "ncsa"),
        ("MS-PL", "ms-pl"), ("GPL-2.0-or-later", "gpl-2.0"), ("CC-BY-NC-SA-4.0", "cc-by-nc-sa"), ("Apache-2.0 OR MIT", "apache-2.0,mit"),
        ("(GPL-2.0-or-later OR MIT) AND BSD-3-Clause", "bsd-3-clause,gpl-2.0,mit"),
    ]),
    ("Released under the MIT", "mit"), ("Released under the GPL.", "gpl"), ("licensed under the LGPL", "lgpl"),
    ("AGPL licensed", "agpl"), ("BSD licensed", "bsd"), ("Dual licensed under MIT and GPL", "gpl,mit"),
    ("available under ISC or the MPL, and", "isc,mpl"), ("licensed under MIT and GPL v3", "gpl-3.0,mit"),
    ("no limit under MIT rules", ""), ("the disc under mpl", ""),
])
def test_identifiers_and_short_names(scanner, text, expected):
    found = scanner.scan(text)
    assert found[5] == expected and (found[6] >= 0.8) == bool(expected)


def test_every_identifier_and_short_name_in_every_frame(scanner):
    for label, names in licenses.SPDX.items():
        for name in names:
            one = re.sub(r"\(\?:[^()]*\)\?", "", name).replace("  ", " ")
            one = re.sub(r"\[(.)[^]]*\]", r"\1", one) if "invariants" not in one else "gfdl 1 1 invariants only"
            for before in ("", "mit or ", "gpl 2 0 or later or mit and "):
                assert label in labels(scanner, f"x spdx license identifier {before}{one}"), (label, before, one)
    for label, name in licenses.SHORT.items():
        for text in (f"released under the {name}", f"licensed under mit or {name}", f"licensed under bsd and mit and {name}", f"{name} licensed", f"{name} license"):
            assert label in labels(scanner, text), text


def test_no_two_rules_are_the_same():
    found = licenses.rules()
    assert len({r.pattern for r in found}) == len(found)
