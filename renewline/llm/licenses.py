"""License scans by ordered signature rules.

A text is reduced to words; a rule is a regular expression over the words joined by
blanks. Rules are gated by keywords: one automaton finds all keywords in one pass over
the text, and a rule runs only if its keyword occurs. Matches are accepted in the order
of priority, then length, then place; a match inside an accepted one of another rule is
suppressed. Three base phrases are counted beside that and never suppressed.

Rules are made of hand-written names and hand-written frames ("licensed under the ..."),
of SPDX identifiers after their tag, alone or in expressions, of short names where a
license is spoken of ("released under the MIT", "AGPL licensed"), and of hand-written
passages of single licenses.

Words are runs of ASCII letters and digits and of all other non-ASCII characters, with
A-Z in lower case. Null and empty texts have no words, no labels and score 0.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from dataclasses import dataclass

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from renewline.llm.common import small_batches

# The base phrases and their labels.
BASE = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}

#: Names of licenses as they stand among words, with their labels. Written as regular
#: expressions over lower-case words; the keyword of a rule is its longest plain word.
NAMES = {
    "mit": ["mit license", "expat license", "mit x11 license", "x11 license"],
    "apache": ["apache license", "apache software license", "asl"],
    "apache-1.1": ["apache (?:software )?license (?:version )?1 1"],
    "apache-2.0": ["apache (?:software )?license (?:version )?2(?: 0)?", "apache 2(?: 0)?", "asl 2(?: 0)?"],
    "gpl": ["gnu general public license", "gnu gpl", "general public license"],
    "gpl-2.0": ["(?:gnu )?general public license (?:version |v)?2(?: 0)?", "gplv2", "gpl (?:version |v)?2(?: 0)?"],
    "gpl-3.0": ["(?:gnu )?general public license (?:version |v)?3(?: 0)?", "gplv3", "gpl (?:version |v)?3(?: 0)?"],
    "lgpl": ["(?:gnu )?lesser general public license", "(?:gnu )?library general public license", "gnu lgpl"],
    "lgpl-2.1": ["(?:gnu )?lesser general public license (?:version |v)?2 1", "lgplv2 1", "lgpl (?:version |v)?2 1"],
    "lgpl-3.0": ["(?:gnu )?lesser general public license (?:version |v)?3(?: 0)?", "lgplv3", "lgpl (?:version |v)?3(?: 0)?"],
    "agpl": ["(?:gnu )?affero general public license", "gnu agpl"],
    "agpl-3.0": ["(?:gnu )?affero general public license (?:version |v)?3(?: 0)?", "agplv3", "agpl (?:version |v)?3(?: 0)?"],
    "bsd": ["bsd license", "bsd style license", "berkeley software distribution license"],
    "bsd-2-clause": ["bsd 2 clause(?: license)?", "2 clause bsd(?: license)?", "simplified bsd license", "freebsd license"],
    "bsd-3-clause": ["bsd 3 clause(?: license)?", "3 clause bsd(?: license)?", "(?:new|modified|revised) bsd license"],
    "bsd-4-clause": ["bsd 4 clause(?: license)?", "4 clause bsd(?: license)?", "original bsd license"],
    "mpl": ["mozilla public license"],
    "mpl-1.1": ["mozilla public license (?:version |v)?1 1", "mpl 1 1"],
    "mpl-2.0": ["mozilla public license (?:version |v)?2(?: 0)?", "mpl 2 0"],
    "epl": ["eclipse public license"],
    "epl-1.0": ["eclipse public license (?:version |v)?1 0", "epl 1 0"],
    "epl-2.0": ["eclipse public license (?:version |v)?2 0", "epl 2 0"],
    "isc": ["isc license", "internet systems consortium license"],
    "zlib": ["zlib license", "zlib libpng license"],
    "boost": ["boost software license"],
    "unlicense": ["the unlicense", "unlicense license"],
    "cc0": ["cc0 1 0", "creative commons zero", "creative commons cc0"],
    "cc-by": ["creative commons attribution", "cc by"],
    "cc-by-sa": ["creative commons attribution share ?alike", "cc by sa"],
    "cc-by-nc": ["creative commons attribution non ?commercial", "cc by nc"],
    "cc-by-nd": ["creative commons attribution no ?derivat(?:ive|e)s?", "cc by nd"],
    "artistic": ["artistic license"],
    "cddl": ["common development and distribution license"],
    "cpl": ["common public license"],
    "eupl": ["european union public licence"],
    "ofl": ["sil open font license", "open font license"],
    "osl": ["open software license"],
    "afl": ["academic free license"],
    "psf": ["python software foundation license", "psf license"],
    "php": ["php license"],
    "ruby": ["ruby license"],
    "postgresql": ["postgresql license"],
    "openssl": ["openssl license"],
    "wtfpl": ["do what the fuck you want to public license", "wtfpl"],
    "ms-pl": ["microsoft public license"],
    "ms-rl": ["microsoft reciprocal license"],
    "upl": ["universal permissive license"],
    "ncsa": ["university of illinois ncsa open source license", "ncsa open source license"],
    "gfdl": ["(?:gnu )?free documentation license"],
    "odbl": ["open database license"],
    "sspl": ["server side public license"],
    "busl": ["business source license"],
    "proprietary": ["proprietary license", "commercial license", "end user license agreement"],
}

_UNDER = r"(?:is |are )?(?:released|licensed|distributed|available|provided|published) under (?:the )?(?:terms of (?:the )?)?"

#: Frames around a name: expression, priority, score.
FRAMES = [
    (_UNDER + "{name}", 80, 0.95),
    (r"(?:subject to|governed by|covered by) (?:the )?(?:terms of (?:the )?)?{name}", 75, 0.9),
    (r"(?:see|read) (?:the )?{name}", 65, 0.8),
    (r"{name}", 50, 0.7),
]

#: SPDX identifiers as words; they count after their tag only.
SPDX = {
    "mit": ["mit", "x11", "mit cmu", "mit modern variant"],
    "mit-0": ["mit 0"],
    "apache-1.0": ["apache 1 0"],
    "apache-1.1": ["apache 1 1"],
    "apache-2.0": ["apache 2(?: 0)?"],
    "gpl-1.0": ["gpl 1 0(?: only| or later)?"],
    "gpl-2.0": ["gpl 2(?: 0)?(?: only| or later)?", "gplv2"],
    "gpl-3.0": ["gpl 3(?: 0)?(?: only| or later)?", "gplv3"],
    "lgpl-2.0": ["lgpl 2 0(?: only| or later)?"],
    "lgpl-2.1": ["lgpl 2 1(?: only| or later)?", "lgplv2 1"],
    "lgpl-3.0": ["lgpl 3(?: 0)?(?: only| or later)?", "lgplv3"],
    "agpl-1.0": ["agpl 1 0(?: only| or later)?"],
    "agpl-3.0": ["agpl 3(?: 0)?(?: only| or later)?", "agplv3"],
    "0bsd": ["0bsd"],
    "bsd-1-clause": ["bsd 1 clause"],
    "bsd-2-clause": ["bsd 2 clause(?: patent| views)?"],
    "bsd-3-clause": ["bsd 3 clause(?: clear| lbnl| attribution| modification)?"],
    "bsd-4-clause": ["bsd 4 clause(?: uc| shortened)?"],
    "mpl-1.0": ["mpl 1 0"],
    "mpl-1.1": ["mpl 1 1"],
    "mpl-2.0": ["mpl 2 0(?: no copyleft exception)?"],
    "epl-1.0": ["epl 1 0"],
    "epl-2.0": ["epl 2 0"],
    "isc": ["isc"],
    "zlib": ["zlib", "zlib acknowledgement", "libpng(?: 2 0)?"],
    "boost": ["bsl 1 0"],
    "unlicense": ["unlicense"],
    "cc0": ["cc0 1 0"],
    "cc-by": ["cc by(?: [1-4] [05])?"],
    "cc-by-sa": ["cc by sa(?: [1-4] [05])?"],
    "cc-by-nc": ["cc by nc(?: [1-4] [05])?"],
    "cc-by-nd": ["cc by nd(?: [1-4] [05])?"],
    "cc-by-nc-sa": ["cc by nc sa(?: [1-4] [05])?"],
    "cc-by-nc-nd": ["cc by nc nd(?: [1-4] [05])?"],
    "artistic": ["artistic 1 0(?: perl| cl8)?", "artistic 2 0"],
    "cddl": ["cddl 1 0", "cddl 1 1"],
    "cpl": ["cpl 1 0"],
    "eupl": ["eupl 1 [012]"],
    "ofl": ["ofl 1 0(?: rfn| no rfn)?", "ofl 1 1(?: rfn| no rfn)?"],
    "osl": ["osl [123] [01]"],
    "afl": ["afl [123] [012]"],
    "psf": ["psf 2 0", "python 2 0(?: 1)?"],
    "php": ["php 3 0", "php 3 01"],
    "ruby": ["ruby"],
    "postgresql": ["postgresql"],
    "openssl": ["openssl"],
    "wtfpl": ["wtfpl"],
    "ms-pl": ["ms pl"],
    "ms-rl": ["ms rl"],
    "upl": ["upl 1 0"],
    "ncsa": ["ncsa"],
    "gfdl": ["gfdl 1 1(?: only| or later)?", "gfdl 1 2(?: only| or later)?", "gfdl 1 3(?: only| or later)?", "gfdl 1 [123] (?:no )?invariants(?: only| or later)"],
    "odbl": ["odbl 1 0"],
    "sspl": ["sspl 1 0"],
    "busl": ["busl 1 1"],
    "blueoak": ["blueoak 1 0 0"],
    "mulan": ["mulanpsl [12] 0"],
    "vim": ["vim"],
    "curl": ["curl"],
    "zpl": ["zpl [12] [01]"],
}
#: Any one identifier of an expression, and what joins two; "or later" belongs to an identifier.
_ONE = r"(?:(?!(?:or(?! later(?![^ ]))|and) )[a-z0-9]+ ){1,8}(?:or|and) "
_TAG = "spdx license identifier "
#: Frames around an identifier: first, second and third of an expression.
SPDX_FRAMES = [(_TAG + _ONE * n + "{name}", 90 - n, 1.0) for n in range(3)]

#: Short names; they count where a license is spoken of.
SHORT = {
    "mit": "mit", "apache": "apache", "gpl": "gpl", "lgpl": "lgpl", "agpl": "agpl", "bsd": "bsd", "isc": "isc",
    "mpl": "mpl", "epl": "epl", "zlib": "zlib", "cc0": "cc0", "cddl": "cddl", "cpl": "cpl", "eupl": "eupl",
    "ofl": "ofl", "osl": "osl", "afl": "afl", "gfdl": "gfdl", "odbl": "odbl", "sspl": "sspl", "busl": "busl",
    "ncsa": "ncsa", "upl": "upl", "unlicense": "unlicense", "ms-pl": "ms pl", "ms-rl": "ms rl",
}
_SHORT_ONE = rf"(?:gnu )?(?:{'|'.join(SHORT.values())})(?: licen[cs]e)?(?: (?:version )?v?[1-4](?: [0-9])?)? (?:and |or )(?:the )?(?:gnu )?"
#: A longer name goes on here, which rules of its own find.
_LONGER = r"(?! (?:licen[cs]e|(?:version )?v?[1-4])(?![^ ]))"
#: Frames around a short name, with a word that they hold besides.
SHORT_FRAMES = [
    (_UNDER + "{name}", 80, 0.95, "under"),
    (_UNDER + _SHORT_ONE + "{name}" + _LONGER, 79, 0.95, "under"),
    (_UNDER + _SHORT_ONE * 2 + "{name}" + _LONGER, 78, 0.95, "under"),
    ("{name} licen[cs]ed", 65, 0.8, "licen"),
    ("{name} licen[cs]e", 50, 0.7, "licen"),
]

#: Passages that single licenses hold, with their labels.
PASSAGES = {
    "mit": [
        "permission is hereby granted free of charge to any person obtaining a copy",
        "the above copyright notice and this permission notice shall be included in all copies",
        "the software is provided as is without warranty of any kind express or implied",
    ],
    "bsd": [
        "redistribution and use in source and binary forms with or without modification are permitted",
        "redistributions of source code must retain the above copyright notice",
        "redistributions in binary form must reproduce the above copyright notice",
    ],
    "bsd-3-clause": ["neither the name of .{1,80}? nor the names of its contributors may be used to endorse"],
    "bsd-4-clause": ["all advertising materials mentioning features or use of this software must display"],
    "apache-2.0": [
        "you may not use this file except in compliance with the license",
        "unless required by applicable law or agreed to in writing software distributed under the license",
        "www apache org licenses license 2 0",
    ],
    "gpl": [
        "this program is free software you can redistribute it and or modify it",
        "you should have received a copy of the gnu general public license",
        "either version [23] of the license or at your option any later version",
        "www gnu org licenses gpl",
    ],
    "lgpl": [
        "you should have received a copy of the gnu lesser general public license",
        "www gnu org licenses lgpl",
    ],
    "agpl": [
        "you should have received a copy of the gnu affero general public license",
        "www gnu org licenses agpl",
    ],
    "mpl-2.0": [
        "this source code form is subject to the terms of the mozilla public license",
        "mozilla org mpl 2 0",
    ],
    "isc": ["permission to use copy modify and or distribute this software for any purpose with or without fee"],
    "zlib": ["altered source versions must be plainly marked as such"],
    "boost": ["www boost org license 1 0"],
    "unlicense": ["this is free and unencumbered software released into the public domain"],
    "cc0": ["creativecommons org publicdomain zero"],
    "cc-by": ["creativecommons org licenses by [1-4] 0"],
    "cc-by-sa": ["creativecommons org licenses by sa"],
    "cc-by-nc": ["creativecommons org licenses by nc"],
    "cc-by-nd": ["creativecommons org licenses by nd"],
    "public-domain": ["(?:released|placed) (?:in|into) the public domain", "dedicated to the public domain"],
    "proprietary": ["all rights reserved unauthori[sz]ed copying", "strictly confidential and proprietary"],
    "copyright": ["all rights reserved"],
}
_PASSAGE_PRIORITY, _PASSAGE_SCORE = 70, 0.9
#: Labels whose passages also stand in texts under other licenses.
_WEAK = {"copyright": (20, 0.3)}


@dataclass(frozen=True)
class Rule:
    label: str
    pattern: str
    keyword: str
    priority: int
    score: float
    #: A second keyword that every match holds.
    also: str = ""


def _keyword(pattern: str) -> str:
    """The longest word that every match of the pattern holds."""
    plain = re.sub(r"\(\?:[^()]*(?:\([^()]*\)[^()]*)*\)\??|\[[^\]]*\]\S*|\.\{[^}]*\}\??|\S?\?", " ", pattern)
    return max(re.findall(r"[a-z0-9]{2,}", plain), key=len)


def rules() -> list[Rule]:
    """All rules: every name, identifier and short name in every frame of its kind, and the passages."""
    out = []
    for label, names in NAMES.items():
        for name in names:
            for frame, priority, score in FRAMES:
                out.append(Rule(label, frame.format(name=name), _keyword(name), priority, score))
    for label, names in SPDX.items():
        for name in names:
            for frame, priority, score in SPDX_FRAMES:
                out.append(Rule(label, frame.replace("{name}", name), _keyword(name), priority, score, "spdx"))
    written = {rule.pattern for rule in out}
    for label, name in SHORT.items():
        for frame, priority, score, also in SHORT_FRAMES:
            pattern = frame.replace("{name}", name)
            if pattern.replace("[cs]", "c") not in written:
                out.append(Rule(label, pattern, _keyword(name), priority, score, also))
    for label, passages in PASSAGES.items():
        priority, score = _WEAK.get(label, (_PASSAGE_PRIORITY, _PASSAGE_SCORE))
        out += [Rule(label, p, _keyword(p), priority, score) for p in passages]
    return out


# Bytes of words stay, A-Z in lower case; all others become blanks.
_WORD_BYTES = bytes(
    b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else b + 32 if 0x41 <= b <= 0x5A else 0x20
    for b in range(256)
)


class Scanner:
    """Compiled rules behind a keyword automaton. Built once per task."""

    def __init__(self, signature_rules: list[Rule] | None = None):
        self.rules = sorted(signature_rules if signature_rules is not None else rules(), key=lambda r: -r.priority)
        self.compiled = [re.compile(rf"(?<![^ ])(?:{r.pattern})(?![^ ])") for r in self.rules]
        self.by_keyword: dict[str, list[int]] = {}
        for i, rule in enumerate(self.rules):
            self.by_keyword.setdefault(rule.keyword, []).append(i)
        self.automaton = ahocorasick.Automaton()
        for keyword in {*self.by_keyword, *BASE, *(rule.also for rule in self.rules if rule.also)}:
            # Short ones stand in many words, as mit in limit, and count as whole words only.
            self.automaton.add_word(f" {keyword} " if len(keyword) < 5 else keyword, keyword)
        self.automaton.make_automaton()

    def detections(self, flat: str, keywords: set[str]) -> list[tuple[int, int, Rule]]:
        """Accepted matches (start, end, rule), in characters of the joined words."""
        found = []
        for i in sorted(i for k in keywords for i in self.by_keyword.get(k, ())):
            if self.rules[i].also and self.rules[i].also not in keywords:
                continue
            for m in self.compiled[i].finditer(flat):
                found.append((m.start(), m.end(), self.rules[i]))
        found.sort(key=lambda d: (-d[2].priority, d[0] - d[1], d[0], d[2].label))
        accepted: list[tuple[int, int, Rule]] = []
        kept = _Intervals()
        for start, end, rule in found:
            if not kept.holds(start, end):
                kept.add(start, end)
                accepted.append((start, end, rule))
        return accepted

    def scan(self, text: str | None) -> tuple:
        """Word count, base places, first and last base word, base labels, labels, score, spans."""
        words = text.encode().translate(_WORD_BYTES).split() if text else []
        if not words:
            return 0, 0, None, None, "", "", 0.0, []
        flat = b" ".join(words).decode()
        keywords = {k for _, k in self.automaton.iter(f" {flat} ")}
        if not keywords:
            return len(words), 0, None, None, "", "", 0.0, []
        spaces = [m.start() for m in re.finditer(" ", flat)]
        places, base = [], set()
        for phrase in keywords & BASE.keys():
            at = flat.find(phrase)
            while at >= 0:
                if (at == 0 or flat[at - 1] == " ") and flat[at + len(phrase) : at + len(phrase) + 1] in ("", " "):
                    places.append(bisect_right(spaces, at))
                    base.add(BASE[phrase])
                at = flat.find(phrase, at + 1)
        accepted = self.detections(flat, keywords)
        labels = base | {rule.label for _, _, rule in accepted}
        score = max([0.7 if base else 0.0, *(rule.score for _, _, rule in accepted)])
        spans = [
            {"label": rule.label, "first_word": bisect_right(spaces, start), "last_word": bisect_right(spaces, end - 1)}
            for start, end, rule in sorted(accepted, key=lambda d: d[:2])
        ]
        first, last = (min(places), max(places)) if places else (None, None)
        return len(words), len(places), first, last, ",".join(sorted(base)), ",".join(sorted(labels)), score, spans


class _Intervals:
    """Accepted intervals of which none holds another, ordered by start and by end."""

    def __init__(self):
        self.starts: list[int] = []
        self.ends: list[int] = []

    def holds(self, start: int, end: int) -> bool:
        at = bisect_right(self.starts, start) - 1
        return at >= 0 and self.ends[at] >= end

    def add(self, start: int, end: int) -> None:
        # Intervals inside the new one are no longer needed to answer holds().
        at = bisect_right(self.starts, start - 1) if start else 0
        stop = at
        while stop < len(self.starts) and self.ends[stop] <= end:
            stop += 1
        self.starts[at:stop] = [start]
        self.ends[at:stop] = [end]


SCHEMA = (
    "doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, "
    "labels string, score double, spans array<struct<label:string,first_word:long,last_word:long>>"
)


def scan_licenses(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", signature_rules: list[Rule] | None = None
) -> DataFrame:
    """One row per document: base counts, labels, score and the accepted spans in words."""
    small_batches(docs.sparkSession)
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    kinds = [pa.int64()] * 4 + [pa.string(), pa.string(), pa.float64()]
    kinds.append(pa.list_(pa.struct([("label", pa.string()), ("first_word", pa.int64()), ("last_word", pa.int64())])))
    names = [field.split(" ")[0] for field in re.split(r", (?=\w+ )", SCHEMA)]

    def run(batches):
        scanner = Scanner(signature_rules)
        for batch in batches:
            found = list(zip(*map(scanner.scan, batch.column(1).to_pylist()))) or [()] * len(kinds)
            arrays = [batch.column(0), *(pa.array(c, k) for c, k in zip(found, kinds))]
            yield pa.record_batch(arrays, names=names)

    return rows.mapInArrow(run, SCHEMA)


def op6_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base places, labels and score of every document."""
    return scan_licenses(spark.read.parquet(f"{sf_dir}/documents.parquet")).drop("spans")
