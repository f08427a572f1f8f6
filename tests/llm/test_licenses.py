"""License labels: base places against plain word lists, suppression against its definition."""

import random
import re

from weekloom.llm import licenses

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
PIECES = ["GNU", "General", "public", "License", "apache", "license", "CC", "BY", "-", " ", " ", "\n", "mit", "MIT License", "é", "x", "2.0", ", version ",
          "Licensed under the Apache License, Version 2.0", "SPDX-License-Identifier: MIT", "CC BY-NC 4.0", "\x7f", "ß"]


def base(text):
    words = WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    phrases = [(p.decode().split(), label) for p, label in licenses.PHRASES]
    places = [(i, label) for i in range(len(words)) for p, label in phrases if words[i:i + len(p)] == p]
    first, last = (min(places)[0], max(places)[0]) if places else (None, None)
    return len(words), len(places), first, last, ",".join(sorted({label for _, label in places}))


def test_base_places(spark):
    draw = random.Random(6)
    texts = [" ".join(draw.choices(PIECES, k=draw.randint(0, 25))) for _ in range(400)] + [None, "", "cc by cc by", "license " * 20_000 + "mit license"]
    frame = spark.createDataFrame([(i, t, "z") for i, t in enumerate(texts)], "doc_id long, text string, labels string")
    rows = {r["doc_id"]: r for r in licenses.license_labels(frame).collect()}
    assert {i: tuple(r)[1:6] for i, r in rows.items()} == {i: base(t) for i, t in enumerate(texts)}
    assert all(set(filter(None, r["base_labels"].split(","))) <= set(r["labels"].split(",")) and 0 <= r["score"] <= 1 for r in rows.values())
    assert licenses.license_labels(frame.limit(0)).count() == 0


def test_suppression_follows_its_definition():
    draw = random.Random(1)
    rules = [licenses.Rule(str(i), (), "", draw.randint(1, 4), 1.0) for i in range(30)]
    for _ in range(300):
        found = []
        for _ in range(draw.randint(0, 12)):
            i, a = draw.randrange(30), draw.randint(0, 20)
            found.append((a, a + draw.randint(1, 12), i, rules[i]))
        found = list({d[:3]: d for d in found}.values())

        def rank(d):
            return d[3].priority, d[0] - d[1], d[0], d[2]

        want = [d for d in found if not any(e is not d and e[0] <= d[0] and e[1] >= d[1] and rank(e) < rank(d) for e in found)]
        assert sorted(licenses.suppress(found)) == sorted(want)


def test_versions_and_tags():
    def labels(text):
        return licenses.describe(text)[5]

    assert labels("Licensed under the Apache License, Version 2.0.") == "apache,apache-2.0"
    assert labels("GNU General Public License, version 3.") == "gpl,gpl-3.0"
    assert labels("// SPDX-License-Identifier: BSD-3-Clause") == "bsd-3-clause"
    assert labels("see creativecommons.org/licenses/by-sa/4.0/") == "cc-by-sa-4.0"
    assert labels("Permission is hereby granted, free of charge, to any person obtaining a copy") == "mit"
    assert labels("the commit of the mitten") == "" and len(licenses.signature_rules()) > 300


def test_spans_lie_in_the_text(spark):
    frame = spark.createDataFrame([(1, "é Released under the MIT License. é"), (2, None)], "doc_id long, text string")
    assert [tuple(r)[:4] for r in licenses.license_spans(frame).collect()] == [(1, "mit", 2, 32)]


def test_every_rule_holds_its_keyword():
    """The gate loses nothing: what a rule matches contains one of its keywords, on texts made of all wordings."""
    wordings = ["licensed under the gnu lesser general public license version 2.1", "the unlicense", "cc0 1.0", "creative commons attribution 4.0",
                "open data commons open database license 1.0", "public domain dedication and license 1.0", "spdx-license-identifier: mit",
                "www.apache.org/licenses/license-2.0", "released under isc license", "x11 license"]
    for text in wordings:
        for rule in licenses.signature_rules():
            if re.search(rule.pattern, text):
                assert any(k in text for k in rule.keywords), (rule, text)


def test_gate_passes_every_separator():
    """Wrapped, doubled and hyphenated wordings give what the rules find without a gate."""
    names = [licenses.split_fields(line)[1] for line in licenses.LICENSES.strip().splitlines()]
    plain = [re.sub(r"\(\?:([^()|]*)[^()]*\)\??", r"\1", n).replace("[cs]", "s").replace(" ?", " ").replace("[a-z*]+", "x").replace("[a-z]+", "s").replace(".", "-")
             for n in names]
    wordings = [f"licensed under the {name}, version 2.1" for name in plain] + [re.sub(r"\(\?:([^()|]*)[^()]*\)\??", r"\1", t[2]).replace(".{1,120}?", "x") for t in licenses.TEXTS]
    met = set()
    for text in wordings:
        for gap in (" ", "\n", "  ", "\r\n  ", "\t", "-", "_", " - ", "\u00a0"):
            given = f"see {text.replace(' ', gap)} 1.0"
            want = [(m.start(), m.end(), i) for i, r in enumerate(licenses.signature_rules()) for m in re.finditer(r.pattern, given)]
            assert sorted(d[:3] for d in licenses.detections(given)) == sorted(want), given
            met |= {licenses.signature_rules()[i].keywords for *_, i in want}
    assert {r.keywords for r in licenses.signature_rules()} - met == {("licenses/", "/mpl/", "publicdomain/"), ("spdx",)}


def test_wrapped_notices():
    def labels(text):
        return licenses.describe(text)[5]

    assert labels("GNU Lesser General\nPublic License, version 2.1") == "lgpl-2.1"
    assert labels("Creative\nCommons Attribution 4.0") == "cc-by-4.0"
    assert labels("Permission is hereby\ngranted, free of charge, to any person obtaining a copy") == "mit"
    assert labels("Common  Development-and Distribution License 1.0") == "cddl-1.0"


def test_indented_and_commented_notices():
    def labels(text):
        return licenses.describe(text)[5]

    assert labels("GNU Lesser General\n        Public License, version 2.1") == "lgpl-2.1"
    for lead in (" * ", "# ", "// ", "-- ", "   ;; ", "> ", "\t"):
        assert labels(f"{lead}GNU Lesser General\n{lead}Public License, version 2.1") == "lgpl-2.1", lead
        assert labels(f"{lead}Permission is hereby granted,\r\n{lead}free of charge, to any\n{lead}\n{lead}person obtaining a copy") == "mit", lead
    assert labels("Neither the name of the copyright\nholder nor the names of its\n# contributors may be used") == "bsd-3-clause"


def test_tag_expressions():
    def labels(text):
        return licenses.describe(text)[5]

    assert labels("SPDX-License-Identifier: (MIT OR Apache-2.0)") == "apache-2.0,mit"
    assert labels("# SPDX-License-Identifier: GPL-2.0-only OR MIT.") == "gpl-2.0,mit"
    assert labels("SPDX-License-Identifier: LGPL-2.1+ AND (MIT OR BSD-3-Clause)") == "bsd-3-clause,lgpl-2.1,mit"
    assert labels("SPDX-License-Identifier: Apache-2.0 WITH LLVM-exception OR GPL-3.0-or-later") == "apache-2.0,gpl-3.0"
    assert labels("SPDX-License-Identifier: MIT-0") == "" and labels("SPDX-License-Identifier: none, mit is meant") == ""


def test_positions_are_those_of_the_given_text():
    text = "see \n\n *   the gnu lesser general\n *  public   license,\n * version 2.1 \t and\n# spdx-license-identifier: mit"
    spans = {rule.label: text[a:b] for a, b, _, rule in licenses.suppress(licenses.detections(text))}
    assert spans == {"lgpl-2.1": "gnu lesser general\n *  public   license,\n * version 2.1", "mit": "mit"}


def test_folding_takes_linear_time():
    for text in ("\n" * 300_000, " " * 300_000, "\n * " * 100_000, "gnu " + " " * 300_000, "spdx-license-identifier: " + "mit or " * 30_000):
        licenses.describe(text)
