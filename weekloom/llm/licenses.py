"""License detection by ordered signature rules.

A few hundred regular expressions, written by hand as (license, wording) pairs, run over the lower-cased text. Each rule names a
literal keyword its matches contain, any run of white space, ``-`` and ``_`` counting as one space; a text without the keyword never
runs the rule. Rules run on a copy whose line ends, with indentation and the comment signs that open the next line, and runs of blanks are one space,
so a wrapped, indented or commented notice is found as on one line; positions are those of the given text. The words of a wording may stand any
number of blanks apart. After an SPDX tag every license of the expression counts, with ``-only``, ``-or-later`` or ``+``. A detection is dropped when its interval lies
inside that of a detection that ranks before it: lower priority number first, then the longer one, then the earlier rule. The
container may itself be dropped: containment is transitive, so the outcome does not depend on the order of the checks.

Null and empty texts have no words and no labels; positions are null and the score is 0. Repeated rows give equal rows. Only
``doc_id`` and ``text`` are read; a null ``doc_id`` stays null. Whole texts are scanned whatever their length.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections.abc import Callable
from dataclasses import dataclass
from functools import lru_cache

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weekloom.llm.common import ASCII_LOWER, map_slices

# fixed values: phrases and their labels
PHRASES = (
    (b" gnu general public license ", "gpl"),
    (b" apache license ", "apache"),
    (b" cc by ", "cc-by"),
    (b" mit license ", "mit"),
)

# every byte that is not part of a word becomes a space, A-Z become a-z
_WORD_BYTES = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))

# label | name (regular expression, words separated by one space) | keyword | versions
LICENSES = """
gpl | gnu general public licen[cs]e | general public licen | 1.0 2.0 3.0
lgpl | gnu (?:lesser|library) general public licen[cs]e | general public licen | 2.0 2.1 3.0
agpl | gnu affero general public licen[cs]e | affero | 1.0 3.0
gfdl | gnu free documentation licen[cs]e | free documentation | 1.1 1.2 1.3
apache | apache(?: software)? licen[cs]e | apache | 1.0 1.1 2.0
mit | (?:mit|expat|x11) licen[cs]e | licen |
bsd-2-clause | (?:simplified bsd|bsd 2.clause|2.clause bsd|freebsd) licen[cs]e | bsd |
bsd-3-clause | (?:new bsd|modified bsd|bsd 3.clause|3.clause bsd) licen[cs]e | bsd |
bsd-4-clause | (?:original bsd|bsd 4.clause|4.clause bsd) licen[cs]e | bsd |
isc | isc licen[cs]e | isc licen |
mpl | mozilla public licen[cs]e | mozilla | 1.0 1.1 2.0
epl | eclipse public licen[cs]e | eclipse | 1.0 2.0
cddl | common development and distribution licen[cs]e | common development | 1.0 1.1
cpl | common public licen[cs]e | common public | 1.0
eupl | european union public licen[cs]e | european union | 1.1 1.2
osl | open software licen[cs]e | open software | 1.0 2.1 3.0
afl | academic free licen[cs]e | academic free | 2.1 3.0
artistic | artistic licen[cs]e | artistic | 1.0 2.0
bsl | boost software licen[cs]e | boost | 1.0
zlib | zlib(?:/libpng)? licen[cs]e | zlib |
ofl | sil open font licen[cs]e | open font | 1.0 1.1
psf | python software foundation licen[cs]e | python software | 2.0
php | php licen[cs]e | php licen | 3.0 3.01
ruby | ruby licen[cs]e | ruby licen |
unlicense | (?:the )?unlicense | unlicense |
wtfpl | do what the f[a-z*]+ you want to public licen[cs]e | you want to public | 2.0
cc-by | (?:cc by|creative commons attribution) | c | 1.0 2.0 2.5 3.0 4.0
cc-by-sa | (?:cc by.sa|creative commons attribution.share ?alike) | c | 1.0 2.0 2.5 3.0 4.0
cc-by-nc | (?:cc by.nc|creative commons attribution.non ?commercial) | c | 1.0 2.0 2.5 3.0 4.0
cc-by-nd | (?:cc by.nd|creative commons attribution.no ?deriv[a-z]+) | c | 1.0 2.0 2.5 3.0 4.0
cc-by-nc-sa | (?:cc by.nc.sa|creative commons attribution.non ?commercial.share ?alike) | c | 2.0 2.5 3.0 4.0
cc-by-nc-nd | (?:cc by.nc.nd|creative commons attribution.non ?commercial.no ?deriv[a-z]+) | c | 2.0 2.5 3.0 4.0
cc0 | (?:cc0|creative commons zero)(?: universal)? | c | 1.0
odbl | open (?:data commons open )?database licen[cs]e | database licen | 1.0
odc-by | open data commons attribution licen[cs]e | data commons | 1.0
pddl | public domain dedication and licen[cs]e | public domain | 1.0
"""
CC_KEYWORDS = ("cc by", "cc-by", "creative commons", "cc0")

# label | keyword | wording that only this license has
TEXTS = (
    ("mit", "hereby granted", r"permission is hereby granted, free of charge, to any person obtaining a copy"),
    ("isc", "copy, modify, and", r"permission to use, copy, modify, and(?:/or)? distribute this software for any purpose"),
    ("bsd-2-clause", "redistribution", r"redistribution and use in source and binary forms, with or without modification, are permitted"),
    ("bsd-3-clause", "neither the name", r"neither the name of .{1,120}? nor the names of its contributors may be used"),
    ("gpl", "free software foundation", r"under the terms of the gnu general public license as published by the free software foundation"),
    ("lgpl", "free software foundation", r"under the terms of the gnu lesser general public license as published by the free software foundation"),
    ("zlib", "altered source", r"altered source versions must be plainly marked as such"),
    ("unlicense", "unencumbered", r"this is free and unencumbered software released into the public domain"),
    ("public-domain", "public domain", r"(?:dedicated to|placed in(?:to)?|released (?:in)?to) the public domain"),
    ("bsl-1.0", "executable object code", r"machine-executable object code generated by a source language processor"),
)
# label | address
ADDRESSES = (
    ("apache-2.0", r"apache\.org/licenses/license-2\.0"), ("gpl-3.0", r"gnu\.org/licenses/gpl-3\.0"), ("gpl-2.0", r"gnu\.org/licenses/gpl-2\.0"),
    ("lgpl-3.0", r"gnu\.org/licenses/lgpl-3\.0"), ("agpl-3.0", r"gnu\.org/licenses/agpl-3\.0"), ("mit", r"opensource\.org/licenses/mit\b"),
    ("mpl-2.0", r"mozilla\.org/mpl/2\.0"), ("cc0-1.0", r"creativecommons\.org/publicdomain/zero/1\.0"),
    *((f"cc-{kind}-{v}", rf"creativecommons\.org/licenses/{kind}/{re.escape(v)}")
      for kind in ("by", "by-sa", "by-nc", "by-nd", "by-nc-sa", "by-nc-nd") for v in ("3.0", "4.0")),
)
# wording | priority | weight; the lower priority number wins
NOTICES = (
    (r"licen[cs]ed under (?:the )?{}", 3, 0.95),
    (r"(?:released|distributed|available|published|provided) under (?:the )?{}", 3, 0.95),
    (r"(?:terms|conditions) of (?:the )?{}", 4, 0.9),
    (r"{}", 5, 0.75),
)
PHRASE_WEIGHT = 0.6
GAP = re.compile(r"[\s\-_]+")
# a line end with the blanks around it and a comment sign, or a run of blanks that is not one space
FOLD = re.compile(r"[^\S\n]*+(?:\n[^\S\n]*+(?:[*#;>%!|/]++|--)?[^\S\n]*+)++|[^\S\n]{2,}+|[^\S\n\x20]")
SPDX = r"spdx-license-identifier:[\s(]*+(?:[a-z0-9.+\-]+[\s)]+(?:and|or|with)[\s(]+)*(?P<id>{}(?:-only|-or-later|\+)?)(?![a-z0-9\-+]|\.[a-z0-9])"


@dataclass(frozen=True)
class Rule:
    label: str
    keywords: tuple[str, ...]  # one of them is in every match, its words separated by any of GAP
    pattern: str
    priority: int
    weight: float


def spaced(pattern: str) -> str:
    return pattern.replace(" ", r"[\s\-_]+")


@lru_cache(maxsize=1)
def signature_rules() -> tuple[Rule, ...]:
    """All rules: identifiers and addresses first, then license wording, notices with a version, notices, bare names."""
    rules = [Rule(label, ("licenses/", "/mpl/", "publicdomain/"), pattern, 1, 1.0) for label, pattern in ADDRESSES]
    rules += [Rule(label, (keyword,), pattern.replace(" ", r"\s+"), 2, 0.9) for label, keyword, pattern in TEXTS]
    for line in LICENSES.strip().splitlines():
        label, name, keyword, versions = split_fields(line)
        keywords = CC_KEYWORDS if keyword == "c" else (keyword,)
        for version in versions.split():
            short = re.escape(version.removesuffix(".0")) + (r"(?:\.0)?" if version.endswith(".0") else "")
            tail = rf",?\s+(?:\(?(?:version|v\.?)\s*)?{short}(?!\.?\d)"
            rules.append(Rule(f"{label}-{version}", ("spdx",), SPDX.format(re.escape(f"{label}-{version}")), 1, 1.0))
            notice, priority, weight = NOTICES[0]
            rules.append(Rule(f"{label}-{version}", keywords, rf"\b{spaced(notice.format(name))}{tail}", priority - 1, weight))
            rules.append(Rule(f"{label}-{version}", keywords, rf"\b{spaced(name)}{tail}", 4, 0.9))
        if not versions:
            rules.append(Rule(label, ("spdx",), SPDX.format(re.escape(label)), 1, 1.0))
        rules += [Rule(label, keywords, rf"\b{spaced(w.format(name))}\b", p, weight) for w, p, weight in NOTICES]
    return tuple(rules)


def split_fields(line: str) -> list[str]:
    """Fields are separated by a bar with a space before it; the bars inside a name have none."""
    return [x.strip() for x in re.split(r"\s\|", line)]


@lru_cache(maxsize=1)
def compiled() -> tuple[tuple[tuple[str, ...], tuple[tuple[int, Rule, re.Pattern], ...]], ...]:
    """Rules with their place in the order, grouped by keywords so that a group is gated once per text."""
    groups: dict[tuple[str, ...], list] = {}
    for i, rule in enumerate(signature_rules()):
        groups.setdefault(rule.keywords, []).append((i, rule, re.compile(rule.pattern)))
    return tuple((k, tuple(v)) for k, v in groups.items())


@lru_cache(maxsize=None)
def words_of(keyword: str) -> list[str]:
    return GAP.split(keyword)


def gate(text: str) -> Callable[[tuple[str, ...]], bool]:
    """Whether one of the keywords is in the text, however its words are separated; the copy with single spaces is made when first needed."""
    plain = None

    def passes(keywords: tuple[str, ...]) -> bool:
        nonlocal plain
        for keyword in keywords:
            if keyword in text:
                return True
            words = words_of(keyword)
            if len(words) > 1 and all(w in text for w in words):
                if plain is None:
                    plain = GAP.sub(" ", text)
                if " ".join(words) in plain:
                    return True
        return False

    return passes


def folded(text: str) -> tuple[str, list[int], list[int]]:
    """The copy that rules run on; from each of the copy's places in the first list, the given text is ahead by the second."""
    pieces, places, ahead = [], [0], [0]
    at = size = 0
    for m in FOLD.finditer(text):
        pieces += [text[at:m.start()], " "]
        size += m.start() - at + 1
        at = m.end()
        places.append(size)
        ahead.append(at - size)
    return "".join(pieces) + text[at:], places, ahead


def detections(text: str) -> list[tuple[int, int, int, Rule]]:
    """(start, end, rule's place, rule) of every match in a lower-cased text, before suppression."""
    found = []
    copy, places, ahead = folded(text)
    passes = gate(copy)

    def given(place: int) -> int:
        return place + ahead[bisect_right(places, place) - 1]

    for keywords, rules in compiled():
        if passes(keywords):
            for i, rule, pattern in rules:
                group = "id" if "id" in pattern.groupindex else 0
                found += [(given(m.start(group)), given(m.end(group) - 1) + 1, i, rule) for m in pattern.finditer(copy)]
    return found


def suppress(found: list[tuple[int, int, int, Rule]]) -> list[tuple[int, int, int, Rule]]:
    """Drop each detection inside one that ranks before it.

    In order of start, longest first, the detections that may contain the present one have been met; for every priority only
    the farthest end matters.
    """
    kept, reach = [], {}
    for d in sorted(found, key=lambda d: (d[0], -d[1], d[3].priority, d[2])):
        start, end, _, rule = d
        # of equal priority an earlier detection that reaches as far is longer, or the same interval by an earlier rule
        if not any(p <= rule.priority and far >= end for p, far in reach.items()):
            kept.append(d)
        reach[rule.priority] = max(reach.get(rule.priority, -1), end)
    return kept


def describe(text: str) -> tuple[int, int, int | None, int | None, str, str, float]:
    """n_words, n_base, first_word, last_word, base_labels, labels, score of one text."""
    words = text.encode().translate(_WORD_BYTES).split()
    line = b" " + b" ".join(words) + b" "
    places, base = [], set()
    for phrase, label in PHRASES:
        at = line.find(phrase)
        while at >= 0:
            places.append(at)
            base.add(label)
            at = line.find(phrase, at + 1)
    kept = suppress(detections(text.translate(ASCII_LOWER)))
    labels = base | {rule.label for *_, rule in kept}
    score = max([PHRASE_WEIGHT] * bool(base) + [rule.weight for *_, rule in kept], default=0.0)
    first, last = (line.count(b" ", 0, at) for at in (min(places), max(places))) if places else (None, None)
    return len(words), len(places), first, last, ",".join(sorted(base)), ",".join(sorted(labels)), score


def license_labels(docs: DataFrame) -> DataFrame:
    """One row per document with word counts, base places, labels and score."""
    def work(ids, texts):
        rows = [(i, *describe(t or "")) for i, t in zip(ids, texts)]
        return [list(c) for c in zip(*rows)]

    return map_slices(docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")), (
        "doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double"), work)


def license_spans(docs: DataFrame) -> DataFrame:
    """One row per kept detection: its label, interval (code points, end exclusive), priority and weight."""
    def work(ids, texts):
        rows = [(i, d[3].label, d[0], d[1], d[3].priority, d[3].weight) for i, t in zip(ids, texts)
                for d in suppress(detections((t or "").translate(ASCII_LOWER)))]
        return [list(c) for c in zip(*rows)] if rows else [[]] * 6

    return map_slices(docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")),
                      "doc_id long, label string, start long, end long, priority int, weight double", work)
