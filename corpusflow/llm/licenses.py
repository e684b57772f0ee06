"""License scans by ordered signature rules.

A text is reduced to its lower-case words with single spaces. Rules are
regular expressions over that form, gated by keywords that must occur as
words. A detection inside another one is suppressed; of equal intervals the
one of the earlier rule stays.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusflow.llm.common import text_blocks

#: Bytes of words: letters a-z after lower-casing, digits and every byte of a
#: non-ASCII character; all other ASCII characters separate words.
_TABLE = bytes(
    b + 32 if 0x41 <= b <= 0x5A else b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else 0x20 for b in range(256)
)


class Rule(NamedTuple):
    label: str
    keywords: frozenset[bytes]
    pattern: re.Pattern[bytes]
    weight: float
    phrase: bytes


# Fixed values: (label, name as written in running text, SPDX words). Names
# are patterns over normalised words; the first literal word gates the rule.
FAMILIES = (
    ("mit", "mit(?: x11)?|expat", "mit"),
    ("mit-0", "mit no attribution", "mit 0"),
    ("apache-1.1", "apache(?: software)? license version 1 1", "apache 1 1"),
    ("apache-2", "apache(?: software)? license(?: version)? 2(?: 0)?|apache 2(?: 0)?", "apache 2 0"),
    ("bsd-2-clause", "simplified bsd|bsd 2 clause|freebsd", "bsd 2 clause"),
    ("bsd-3-clause", "new bsd|modified bsd|revised bsd|bsd 3 clause", "bsd 3 clause"),
    ("bsd-4-clause", "original bsd|bsd 4 clause", "bsd 4 clause"),
    ("0bsd", "zero clause bsd|0bsd|bsd 0 clause", "0bsd"),
    ("gpl-1", "gnu general public license version 1|gpl v1|gplv1", "gpl 1 0(?: only| or later)?"),
    ("gpl-2", "gnu general public license(?: as published by the free software foundation)?(?: either)? version 2|gnu gpl version 2|gpl v2|gplv2", "gpl 2 0(?: only| or later)?"),
    ("gpl-3", "gnu general public license(?: as published by the free software foundation)?(?: either)? version 3|gnu gpl version 3|gpl v3|gplv3", "gpl 3 0(?: only| or later)?"),
    ("lgpl-2", "gnu library general public license version 2|lgpl v2 0|lgplv2 0", "lgpl 2 0(?: only| or later)?"),
    ("lgpl-2.1", "gnu lesser general public license version 2 1|lgpl v2 1|lgplv2 1", "lgpl 2 1(?: only| or later)?"),
    ("lgpl-3", "gnu lesser general public license version 3|lgpl v3|lgplv3", "lgpl 3 0(?: only| or later)?"),
    ("agpl-3", "gnu affero general public license version 3|agpl v3|agplv3", "agpl 3 0(?: only| or later)?"),
    ("gfdl-1.3", "gnu free documentation license version 1 3", "gfdl 1 3(?: only| or later)?"),
    ("mpl-1.1", "mozilla public license(?: version)? 1 1", "mpl 1 1"),
    ("mpl-2", "mozilla public license(?: version| v)? 2(?: 0)?", "mpl 2 0"),
    ("epl-1", "eclipse public license(?: version| v)? 1 0", "epl 1 0"),
    ("epl-2", "eclipse public license(?: version| v)? 2 0", "epl 2 0"),
    ("cddl-1", "common development and distribution license(?: version)? 1 0", "cddl 1 0"),
    ("cpl-1", "common public license(?: version)? 1 0", "cpl 1 0"),
    ("eupl-1.2", "european union public licen[cs]e(?: version)? 1 2", "eupl 1 2"),
    ("artistic-1", "artistic license(?: version)? 1 0", "artistic 1 0"),
    ("artistic-2", "artistic license(?: version)? 2 0", "artistic 2 0"),
    ("bsl-1", "boost software license(?: version)? 1 0", "bsl 1 0"),
    ("busl-1.1", "business source license(?: version)? 1 1", "busl 1 1"),
    ("sspl-1", "server side public license(?: version)? 1", "sspl 1 0"),
    ("isc", "isc", "isc"),
    ("zlib", "zlib(?: libpng)?", "zlib"),
    ("unlicense", "unlicense", "unlicense"),
    ("wtfpl", "do what the fuck you want to public license|wtfpl", "wtfpl"),
    ("psf-2", "python software foundation license(?: version)? 2?", "psf 2 0"),
    ("ofl-1.1", "sil open font license(?: version)? 1 1", "ofl 1 1"),
    ("ncsa", "university of illinois ncsa open source license", "ncsa"),
    ("postgresql", "postgresql license", "postgresql"),
    ("ms-pl", "microsoft public license", "ms pl"),
    ("ms-rl", "microsoft reciprocal license", "ms rl"),
    ("cc0-1", "cc0(?: 1 0)?(?: universal)?|creative commons zero(?: v?1 0)?", "cc0 1 0"),
    ("cc-by", "cc by(?= [1-4] 0)|creative commons attribution(?= (?:[1-4] 0|international|license|unported))", "cc by [1-4] 0"),
    ("cc-by-sa", "cc by sa|creative commons attribution share ?alike", "cc by sa [1-4] 0"),
    ("cc-by-nd", "cc by nd|creative commons attribution no ?deriv(?:ative)?s", "cc by nd [1-4] 0"),
    ("cc-by-nc", "cc by nc(?! (?:sa|nd))|creative commons attribution non ?commercial(?! (?:share|no))", "cc by nc [1-4] 0"),
    ("cc-by-nc-sa", "cc by nc sa|creative commons attribution non ?commercial share ?alike", "cc by nc sa [1-4] 0"),
    ("cc-by-nc-nd", "cc by nc nd|creative commons attribution non ?commercial no ?deriv(?:ative)?s", "cc by nc nd [1-4] 0"),
    ("odbl-1", "open data(?: commons)? open database license|odbl", "odbl 1 0"),
    ("odc-by-1", "open data commons attribution license", "odc by 1 0"),
    ("pddl-1", "public domain dedication and license", "pddl 1 0"),
)
# Fixed values: (weight, text that must occur, words before the name, words
# after it).
FORMS = (
    (0.98, " under ", "(?:is |are |be )?(?:dual )?(?:licensed|released|distributed|published|provided|available|redistributed) (?:to you )?under (?:the )?(?:terms (?:and conditions )?of )?(?:the )?", "(?: licen[cs]e)?"),
    (0.95, " under ", "under (?:the )?(?:terms (?:and conditions )?of )?(?:the )?", " licen[cs]e"),
    (0.90, "ed by ", "(?:covered|governed) by (?:the )?", "(?: licen[cs]e)?"),
    (0.85, " licen", "licen[cs]e ", ""),
    (0.70, " licen", "(?:the )?", "(?: v(?:ersion)?)?(?: [0-9]){0,2}(?: international| unported)? licen[cs]e"),
)
# Sentences that stand in one license's own text.
SIGNATURES = (
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files"),
    ("mit", "the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software"),
    ("apache-2", "you may not use this file except in compliance with the license you may obtain a copy of the license at"),
    ("apache-2", "unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis"),
    ("apache-2", "www apache org licenses license 2 0"),
    ("bsd-2-clause", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met"),
    ("bsd-3-clause", "neither the name of .{1,60} nor the names of its contributors may be used to endorse or promote products"),
    ("bsd-4-clause", "all advertising materials mentioning features or use of this software must display the following acknowledge?ment"),
    ("gpl-2", "either version 2 of the license or at your option any later version"),
    ("gpl-3", "either version 3 of the license or at your option any later version"),
    ("gpl-3", "www gnu org licenses gpl 3 0"),
    ("lgpl-2.1", "either version 2 1 of the license or at your option any later version"),
    ("gpl", "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license"),
    ("mpl-2", "this source code form is subject to the terms of the mozilla public license v 2 0"),
    ("epl-2", "this program and the accompanying materials are made available under the terms of the eclipse public license"),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted"),
    ("zlib", "this software is provided as is without any express or implied warranty in no event will the authors be held liable"),
    ("unlicense", "this is free and unencumbered software released into the public domain"),
    ("bsl-1", "permission is hereby granted free of charge to any person or organization obtaining a copy of the software and accompanying documentation covered by this license"),
    ("wtfpl", "you just do what the fuck you want to"),
    ("ofl-1.1", "this font software is licensed under the sil open font license"),
    ("cc0-1", "creativecommons org publicdomain zero 1 0"),
    ("cc-by", "creativecommons org licenses by [1-4] 0"),
    ("cc-by-sa", "creativecommons org licenses by sa [1-4] 0"),
    ("cc-by-nc", "creativecommons org licenses by nc [1-4] 0"),
    ("cc-by-nd", "creativecommons org licenses by nd [1-4] 0"),
    ("cc-by-nc-sa", "creativecommons org licenses by nc sa [1-4] 0"),
    ("cc-by-nc-nd", "creativecommons org licenses by nc nd [1-4] 0"),
    ("proprietary", "all rights reserved (?:unauthorized|no part)"),
    ("public-domain", "(?:dedicated|released|placed) (?:in)?to the public domain"),
)
#: The base phrases and their labels.
BASE = (("under the mit license", "mit"), ("apache license version 2", "apache-2"), ("cc by nc", "cc-by-nc"))


def _literal_words(pattern: str) -> list[str]:
    """Words of a pattern that every match holds: those outside of groups."""
    depth, flat = 0, []
    for ch in pattern.replace(" ?", " \0 "):  # an optional space joins words
        depth += ch == "("
        flat.append(ch if depth == 0 else " \0 ")
        depth -= ch == ")"
    words = "".join(flat).split(" ")
    sure = [w for i, w in enumerate(words) if re.fullmatch("[a-z0-9]+", w) and "\0" not in (words[i - 1 : i] + words[i + 1 : i + 2])]
    return sure or [w for w in words if re.fullmatch("[a-z0-9]{3,}", w)]


def _rule(label: str, body: str, gates: list[str], weight: float, phrase: str = " ") -> Rule:
    return Rule(label, frozenset(g.encode() for g in gates), re.compile(b"(?<= )" + body.encode() + b"(?= )"), weight, phrase.encode())


def build_rules() -> list[Rule]:
    """All rules in priority order: SPDX identifiers, sentences of license
    texts, then names in running text by form."""
    out = [_rule(label, "spdx license identifier " + f"(?:{spdx})", ["spdx", "identifier"], 0.99) for label, _, spdx in FAMILIES]
    out += [_rule(label, text, _literal_words(text), 0.97) for label, text in SIGNATURES]
    for weight, phrase, before, after in FORMS:
        for label, name, _ in FAMILIES:
            for alt in _alternatives(name):
                # a name that ends in "license" needs no second one
                tail = "" if "licen" in alt else after
                out.append(_rule(label, f"{before}(?:{alt}){tail}", _literal_words(alt), weight, phrase))
    return out


def _alternatives(name: str) -> list[str]:
    """Top-level alternatives of a name pattern."""
    out, depth, cur = [], 0, ""
    for ch in name:
        depth += (ch == "(") - (ch == ")")
        if ch == "|" and depth == 0:
            out.append(cur)
            cur = ""
        else:
            cur += ch
    return [*out, cur]


class Scanner:
    def __init__(self, rules: list[Rule] | None = None):
        self.rules = build_rules() if rules is None else rules
        self.by_gate: dict[bytes, list[int]] = {}
        for i, r in enumerate(self.rules):
            if not r.keywords:
                raise ValueError(f"rule {i} ({r.label}) has no keyword")
            self.by_gate.setdefault(min(r.keywords, key=lambda w: (-len(w), w)), []).append(i)
        self.gates = frozenset(self.by_gate)
        self.base = [(f" {p} ".encode(), label) for p, label in BASE]

    def detect(self, joined: bytes, words: set[bytes]) -> list[tuple[int, int, int]]:
        """(start, end, rule) of kept detections, byte offsets in ``joined``."""
        ids = sorted(i for g in self.gates & words for i in self.by_gate[g])
        found = []
        for i in ids:
            r = self.rules[i]
            if r.keywords <= words and r.phrase in joined:
                found += [(m.start(), m.end(), i) for m in r.pattern.finditer(joined)]
        kept: list[tuple[int, int, int]] = []
        # Longest first: what lies inside a kept detection says nothing more.
        # Between equal intervals the earlier rule has priority. Kept intervals
        # contain none of each other, so only the last one that starts no later
        # can contain the next.
        found.sort(key=lambda d: (d[0], -d[1], d[2]))
        for s, e, i in found:
            if not kept or e > kept[-1][1]:
                kept.append((s, e, i))
        return kept

    def scan(self, text: str) -> dict:
        words = text.encode("utf-8", "surrogatepass").translate(_TABLE).split()
        joined = b" " + b" ".join(words) + b" "
        # Place of the space before each word: positions become word numbers.
        spaces = np.flatnonzero(np.frombuffer(joined, np.uint8) == 0x20)
        starts, base = [], set()
        distinct = set(words)
        for phrase, label in self.base:
            if distinct.issuperset(phrase.split()):
                at = joined.find(phrase)
                while at >= 0:
                    starts.append(at)
                    base.add(label)
                    at = joined.find(phrase, at + 1)
        starts = np.searchsorted(spaces, starts).tolist()
        kept = self.detect(joined, distinct)
        first, last = (np.searchsorted(spaces, [d[i] for d in kept]) - 1 for i in (0, 1))
        miss = 1.0
        best: dict[str, float] = {}
        for _, _, i in kept:
            r = self.rules[i]
            best[r.label] = max(best.get(r.label, 0.0), r.weight)
        for label in base:
            best[label] = max(best.get(label, 0.0), 0.95)
        for w in best.values():
            miss *= 1 - w
        return {
            "n_words": len(words), "n_base": len(starts), "first_word": min(starts, default=None), "last_word": max(starts, default=None),
            "base_labels": ",".join(sorted(base)), "labels": ",".join(sorted(best)), "score": 1 - miss if best else 0.0,
            "detections": [
                {"label": self.rules[d[2]].label, "rule": d[2], "first": a, "last": b} for d, a, b in zip(kept, first.tolist(), last.tolist())
            ],
        }


_FIELDS = (
    "n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double, "
    "detections array<struct<label:string,rule:int,first:int,last:int>>"
)


def license_column(text: Column) -> Column:
    """Everything ``license_scan`` returns, as a struct; null text is empty."""

    @F.pandas_udf(_FIELDS)
    def run(it: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        scanner = Scanner()
        for texts in it:
            rows = pd.DataFrame([scanner.scan(t) for block in text_blocks(texts) for t in block], columns=[f.split()[0] for f in _FIELDS.split(", ")])
            yield rows.astype({"first_word": "Int64", "last_word": "Int64"})

    return run(text)


def license_scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: ``doc_id``, ``n_words``, ``n_base`` (all
    places of base phrases), ``first_word``, ``last_word``, ``base_labels``,
    ``labels`` (the rules' too), ``score`` (1 minus the product of the kept
    labels' error weights) and ``detections`` (word positions).

    Defined cases: a null text is empty; a text without words has no labels and
    score 0; repeated rows and null ids are kept; an empty table gives no rows;
    other columns are ignored. Row-local, no shuffle.
    """
    d = docs.select(F.col(id_col).alias("doc_id"), license_column(F.col(text_col)).alias("_l"))
    return d.select("doc_id", "_l.*")
