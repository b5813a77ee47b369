"""License detection by ordered signature rules.

A text becomes its words (A-Z lower-cased, punctuation gone) with one blank between them, so that layout does
not matter. Rules are regular expressions over that form, tried only where their keyword occurs. Detections are
taken by priority, then length, then place; one that lies inside a detection already taken is suppressed. Three
base phrases are always reported besides, with the places where they stand.

The rules are written as families below and expanded over versions and variants.

Defined cases: a null or empty text has no words, no labels and score 0; no detection gives empty label strings
and null places; repeated rows are scanned alike; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from seawarden.llm import texts

#: Base phrases and their labels.
BASE = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}

#: Bytes between words: ASCII that is neither a digit nor a lower-case letter, once A-Z are lower-cased.
BETWEEN = bytes(b if b >= 0x80 or 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A else 0x20 for b in range(256))
_NORMAL = bytes(BETWEEN[b + 32 if 65 <= b <= 90 else b] for b in range(256))


@dataclass(frozen=True)
class Rule:
    priority: int  # lower wins
    label: str
    keyword: str
    pattern: re.Pattern
    confidence: float


def _family(priority: int, confidence: float, keyword: str, rows: list[tuple[str, str]]) -> list[Rule]:
    return [Rule(priority, label, keyword, re.compile(f"(?<= ){text}(?= )"), confidence) for label, text in rows]


def _versions(label: str, text: str, versions: str) -> list[tuple[str, str]]:
    """One row per version; `{v}` in the text is the version's digits as words."""
    return [(label.format(v=v), text.replace("{v}", v.replace(".", " "))) for v in versions.split()]


def build_rules() -> list[Rule]:
    """All rules, the surest first: identifiers, license texts, full names, creative commons, short references."""
    rules: list[Rule] = []

    # identifiers in the words of a machine-readable tag
    plain = "mit isc zlib wtfpl unlicense 0bsd curl ncsa x11 postgresql ruby php vim w3c tcl beerware json ms-pl ms-rl"
    versioned = {
        "apache": "1.0 1.1 2.0",
        "mpl": "1.0 1.1 2.0",
        "epl": "1.0 2.0",
        "cddl": "1.0 1.1",
        "eupl": "1.0 1.1 1.2",
        "osl": "1.0 2.0 2.1 3.0",
        "afl": "1.1 1.2 2.0 2.1 3.0",
        "artistic": "1.0 2.0",
        "bsl": "1.0",
        "python": "2.0",
        "ecl": "1.0 2.0",
        "lppl": "1.0 1.1 1.2 1.3a 1.3c",
        "ofl": "1.0 1.1",
        "cecill": "1.0 1.1 2.0 2.1",
        "upl": "1.0",
        "cpl": "1.0",
        "zpl": "1.1 2.0 2.1",
        "blueoak": "1.0.0",
    }
    ids = [(name, name.replace("-", " ")) for name in plain.split()]
    ids += [row for name, versions in versioned.items() for row in _versions(name + "-{v}", name + " {v}", versions)]
    ids += [(f"bsd-{n}-clause", f"bsd {n} clause") for n in (1, 2, 3, 4)]
    for name, versions in (("gpl", "1.0 2.0 3.0"), ("lgpl", "2.0 2.1 3.0"), ("agpl", "1.0 3.0"), ("gfdl", "1.1 1.2 1.3")):
        ids += _versions(f"{name}-{{v}}-only", name + " {v}(?: only)?", versions)
        ids += _versions(f"{name}-{{v}}-or-later", name + " {v}(?: or later| plus)", versions)
    variants = ["", "-nc", "-nd", "-sa", "-nc-nd", "-nc-sa"]
    numbers = "1.0 2.0 2.5 3.0 4.0"
    for variant in variants:
        ids += _versions(f"cc-by{variant}-{{v}}", f"cc by{variant.replace('-', ' ')} {{v}}", numbers)
    ids += _versions("cc0-{v}", "cc0 {v}", "1.0")
    rules += _family(0, 1.0, "spdx license identifier", [(i, f"spdx license identifier {text}") for i, text in ids])

    # sentences of license texts
    body = {
        "permission is hereby granted": [
            ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software"),
            ("bsl-1.0", "permission is hereby granted free of charge to any person or organization obtaining a copy"),
            ("ofl-1.1", "permission is hereby granted free of charge to any person obtaining a copy of the font software"),
        ],
        "permission to use copy modify": [
            ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee"),
            ("hpnd", "permission to use copy modify and distribute this software and its documentation for any purpose"),
        ],
        "redistribution and use in source and binary forms": [
            ("bsd", "redistribution and use in source and binary forms with or without modification are permitted"),
        ],
        "without warrant": [
            ("apache-2.0", "without warranties or conditions of any kind either express or implied see the license"),
        ],
        "without any warranty": [
            ("gpl", "without any warranty without even the implied warranty of merchantability or fitness"),
        ],
        "free software": [
            ("gpl", "this (?:program|library) is free software you can redistribute it and or modify it"),
        ],
        "unencumbered": [
            ("unlicense", "this is free and unencumbered software released into the public domain"),
        ],
        "public license": [
            ("mpl-2.0", "this source code form is subject to the terms of the mozilla public license v(?:ersion)? ?2 0"),
            ("wtfpl", "do what the fuck you want to public license"),
        ],
        "as is": [
            ("as-is", "the software is provided as is without warranty of any kind"),
            ("zlib", "this software is provided as is without any express or implied warranty in no event"),
        ],
        "reproduc": [
            ("reserved", "no part of this [^ ]+ may be reproduced(?: [^ ]+){0,12} without (?:the )?(?:prior )?[^ ]* ?permission"),
        ],
    }
    for keyword, rows in body.items():
        rules += _family(1, 0.95, keyword, rows)

    # full names with versions
    version = "(?: version| v)? ?"
    names = {
        "apache": _versions("apache-{v}", f"apache (?:software )?licen[cs]e{version}{{v}}", "1.0 1.1 2.0"),
        "mozilla": _versions("mpl-{v}", f"mozilla public licen[cs]e{version}{{v}}", "1.0 1.1 2.0"),
        "eclipse": _versions("epl-{v}", f"eclipse public licen[cs]e{version}{{v}}", "1.0 2.0"),
        "european union": _versions("eupl-{v}", f"european union public licen[cs]e{version}{{v}}", "1.0 1.1 1.2"),
        "artistic": _versions("artistic-{v}", f"artistic licen[cs]e{version}{{v}}", "1.0 2.0"),
        "boost": _versions("bsl-{v}", f"boost software licen[cs]e{version}{{v}}", "1.0"),
        "academic free": _versions("afl-{v}", f"academic free licen[cs]e{version}{{v}}", "1.1 1.2 2.0 2.1 3.0"),
        "open software": _versions("osl-{v}", f"open software licen[cs]e{version}{{v}}", "1.0 2.0 2.1 3.0"),
        "common development": _versions(
            "cddl-{v}", f"common development and distribution licen[cs]e(?: cddl)?{version}{{v}}", "1.0 1.1"
        ),
        "open font": _versions("ofl-{v}", f"open font licen[cs]e{version}{{v}}", "1.0 1.1"),
        "open database": _versions("odbl-{v}", f"open database licen[cs]e(?: odbl)?{version}{{v}}", "1.0"),
        "common public": _versions("cpl-{v}", f"common public licen[cs]e{version}{{v}}", "1.0"),
    }
    for keyword, rows in names.items():
        rules += _family(2, 0.9, keyword, rows)
    gnu = []
    for label, name, versions in (
        ("agpl", "affero general public licen[cs]e", "1 3"),
        ("lgpl", "(?:lesser|library) general public licen[cs]e", "2 2.1 3"),
        ("gpl", "general public licen[cs]e", "1 2 3"),
    ):
        for suffix, more in (("-or-later", " (?:or later|or at your option any later version|or any later version)"), ("", "")):
            head = f"(?:gnu )?{name}(?: (?:a?gpl|lgpl))?(?: as published by the free software foundation(?: either)?)?"
            for v in versions.split():
                full = v if "." in v else f"{v}.0"
                gnu.append((f"{label}-{full}{suffix}", f"{head}{version}{v.replace('.', ' ')}(?: 0)?{more}"))
    rules += _family(2, 0.9, "general public", gnu)
    gfdl = _versions("gfdl-{v}", f"(?:gnu )?free documentation licen[cs]e{version}{{v}}", "1.1 1.2 1.3")
    rules += _family(2, 0.9, "free documentation", gfdl)

    # creative commons, by short name, full name and address
    words = {"nc": "non ?commercial", "nd": "no ?deriv(?:ative)?s?(?: works)?", "sa": "share ?alike"}
    for variant in sorted(variants, key=len, reverse=True):
        parts = variant.strip("-").split("-") if variant else []
        short = "".join(f" {part}" for part in parts)
        long = "".join(f" {words[part]}" for part in parts)
        label = f"cc-by{variant}-{{v}}"
        rules += _family(3, 0.9, "cc by", _versions(label, f"cc by{short}{version}{{v}}", numbers))
        licence = "(?: international| unported| generic)?(?: public)?(?: licen[cs]e)?"
        rules += _family(3, 0.9, "commons", _versions(label, f"creative commons attribution{long}{licence}{version}{{v}}", numbers))
        address = f"creativecommons org licenses by{short} {{v}}"
        rules += _family(3, 0.95, "creativecommons", _versions(label, address, numbers))
        rules += _family(4, 0.7, "cc by", [(f"cc-by{variant}", f"cc by{short}")] if parts else [])
        rules += _family(4, 0.7, "commons", [(f"cc-by{variant}", f"creative commons attribution{long}")])
    rules += _family(3, 0.9, "cc0", _versions("cc0-{v}", f"cc0{version}{{v}}", "1.0"))
    rules += _family(3, 0.95, "creativecommons", [("cc0-1.0", "creativecommons org publicdomain zero 1 0")])

    # short references
    under = "(?:licen[cs]ed|released|distributed|available|published) under (?:the )?(?:terms of the )?"
    references = {
        "mit": ["mit licen[cs]e", f"{under}mit"],
        "isc": ["isc licen[cs]e"],
        "bsd": ["(?:new |modified |simplified |[234] clause )?bsd licen[cs]e", "bsd [234] clause(?: licen[cs]e)?"],
        "apache": ["apache (?:software )?licen[cs]e"],
        "mpl": ["mozilla public licen[cs]e"],
        "epl": ["eclipse public licen[cs]e"],
        "agpl": ["(?:gnu )?affero general public licen[cs]e", f"{under}agpl"],
        "lgpl": ["(?:gnu )?(?:lesser|library) general public licen[cs]e", f"{under}lgpl"],
        "gpl": ["gnu general public licen[cs]e", f"{under}(?:gnu )?gpl"],
        "gfdl": ["(?:gnu )?free documentation licen[cs]e"],
        "zlib": ["zlib licen[cs]e"],
        "public-domain": ["(?:released|dedicated|placed|is) (?:in|into|to) the public domain"],
        "proprietary": ["proprietary and confidential", f"{under}(?:a )?proprietary licen[cs]e"],
        "cc0": ["cc0 public domain dedication"],
    }
    words_of = {"public-domain": "public domain", "gfdl": "free documentation", "mpl": "mozilla", "epl": "eclipse"}
    for label, forms in references.items():
        for form in forms:
            keyword = words_of.get(label, label)
            if "general public" in form:
                keyword = "general public"
            rules += _family(5, 0.7, keyword, [(label, form)])
    rules += _family(6, 0.5, "rights reserved", [("some-reserved", "some rights reserved")])
    rules += _family(6, 0.4, "copyright", [("copyright", "copyright (?:c )?[12][0-9]{3}(?: [12][0-9]{3})?")])
    return rules


class _Furthest:
    """The furthest end of intervals added so far that start at or before a place: a tree of maxima over the starts."""

    def __init__(self, starts: list[int]):
        self.rank = {start: k for k, start in enumerate(sorted(set(starts)), 1)}
        self.most = [0] * (len(self.rank) + 1)

    def add(self, start: int, end: int) -> None:
        k = self.rank[start]
        while k < len(self.most):
            self.most[k] = max(self.most[k], end)
            k += k & -k

    def up_to(self, start: int) -> int:
        k, found = self.rank[start], 0
        while k:
            found = max(found, self.most[k])
            k &= k - 1
        return found


class Scanner:
    """All rules, grouped by keyword."""

    def __init__(self):
        self.by_keyword: dict[bytes, list[Rule]] = {}
        for rule in build_rules():
            self.by_keyword.setdefault(rule.keyword.encode(), []).append(rule)
        self.base = [(f" {phrase} ".encode(), len(phrase.split()), label) for phrase, label in BASE.items()]

    def detections(self, plain: bytes) -> list[tuple[int, int, Rule]]:
        """Surviving detections in the normal form of a text, as (first, past last, rule) in characters."""
        rules = [rule for keyword, group in self.by_keyword.items() if keyword in plain for rule in group]
        if not rules:
            return []
        text = plain.decode()
        found = [(m.start(), m.end(), rule) for rule in rules for m in rule.pattern.finditer(text)]
        found.sort(key=lambda x: (x[2].priority, x[0] - x[1], x[0], x[2].label))
        taken, furthest = [], _Furthest([start for start, _, _ in found])
        for start, end, rule in found:
            if furthest.up_to(start) < end:
                taken.append((start, end, rule))
                furthest.add(start, end)
        return sorted(taken, key=lambda x: x[:2])

    def scan(self, raw: bytes) -> tuple:
        """n_words, n_base, first_word, last_word, base_labels, labels, score."""
        words = raw.translate(_NORMAL).split()
        plain = b" " + b" ".join(words) + b" "
        places, labels = [], set()
        for phrase, _, label in self.base:
            at = plain.find(phrase)
            if at >= 0:
                labels.add(label)
            while at >= 0:
                places.append(at)
                at = plain.find(phrase, at + 1)
        taken = self.detections(plain)
        score = max([rule.confidence for _, _, rule in taken] + [0.5] * bool(places), default=0.0)
        own = labels | {rule.label for _, _, rule in taken}
        first, last = (plain.count(b" ", 0, at(places)) if places else None for at in (min, max))
        return len(words), len(places), first, last, ",".join(sorted(labels)), ",".join(sorted(own)), score


_scanner: list[Scanner] = []


def scanner() -> Scanner:
    """One scanner for each worker process."""
    if not _scanner:
        _scanner.append(Scanner())
    return _scanner[0]


SCHEMA = (
    "doc_id long, n_words long, n_base long, first_word long, last_word long, "
    "base_labels string, labels string, score double"
)


def scan(docs: DataFrame) -> DataFrame:
    """Words, base places, labels and score of every document."""
    types = [pa.int64()] * 4 + [pa.string()] * 2 + [pa.float64()]
    names = [part.split()[0] for part in SCHEMA.split(", ")][1:]

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        raw, offsets = texts.string_bytes(batch["text"])
        own = scanner()
        rows = [own.scan(raw[a:b].tobytes()) for a, b in zip(offsets[:-1], offsets[1:], strict=True)]
        columns = {"doc_id": batch["doc_id"]}
        for name, kind, values in zip(names, types, zip(*rows, strict=True), strict=True):
            columns[name] = pa.array(values, kind)
        return texts.table(None, columns)

    return texts.per_batch(texts.ids_and_texts(docs), run, SCHEMA)


def spans(docs: DataFrame) -> DataFrame:
    """Every surviving detection: doc_id, label, first and last word, priority, confidence and the words found."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        raw, offsets = texts.string_bytes(batch["text"])
        own, rows = scanner(), []
        for doc_id, a, b in zip(batch["doc_id"].to_pylist(), offsets[:-1], offsets[1:], strict=True):
            plain = b" " + b" ".join(raw[a:b].tobytes().translate(_NORMAL).split()) + b" "
            text = plain.decode()
            blanks = np.flatnonzero(np.frombuffer(text.encode("utf-32-le"), np.uint32) == 32)
            for start, end, rule in own.detections(plain):
                first, *inner = np.searchsorted(blanks, [start - 1, start, end]).tolist()
                last = first + inner[1] - inner[0]
                rows.append((doc_id, rule.label, first, last, rule.priority, rule.confidence, text[start:end]))
        kinds = [pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.int32(), pa.float64(), pa.string()]
        names = ["doc_id", "label", "first_word", "last_word", "priority", "confidence", "found"]
        values = list(zip(*rows, strict=True)) if rows else [[]] * len(kinds)
        return texts.table(None, {n: pa.array(v, k) for n, v, k in zip(names, values, kinds, strict=True)})

    schema = (
        "doc_id long, label string, first_word long, last_word long, priority int, confidence double, found string"
    )
    return texts.per_batch(texts.ids_and_texts(docs), run, schema)
