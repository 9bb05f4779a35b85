from __future__ import annotations

import random
import re
from re import _parser

import brute

from tessitura.llm import license_rules, licenses, registry


def scanned(df):
    return {r["doc_id"]: r for r in licenses.scan(df).collect()}


def test_rules_are_many_and_gated():
    rules = license_rules.rules()
    assert len(rules) > 200
    for label, keyword, exp, rank, sure in rules:
        re.compile(exp)
        assert keyword == keyword.lower() and any(g in keyword for g in licenses.GATES), (label, keyword)
        assert 0 <= sure <= 100 and rank > 0


def test_base_against_brute_force(spark, duck):
    _, rows = duck("SELECT doc_id, text FROM documents")
    found = registry.QUERIES["op8_license_scan"](spark, "/root/testdata/sf0.01").collect()
    got = {r["doc_id"]: (r["n_words"], r["n_base"], r["first_word"], r["last_word"], r["base_labels"]) for r in found}
    assert got == {i: brute.base_licenses(t) for i, t in rows}
    for r in found:
        mine = r["labels"].split(",") if r["labels"] else []
        assert mine == sorted(set(mine)) and set(r["base_labels"].split(",")) - {""} <= set(mine) and 0 <= r["score"] <= 1
        assert (r["score"] > 0) == bool(mine)


def test_phrases(make):
    texts = [
        "MIT License mit  license\nMIT, License", "mitlicense mit-license x", "GNU General Public License general public licenses", "", None, "the apache\tlicense", "General Public License general public license mit license",
        "mit mit license license", "É mit license É", "license mit", "K İ mit license", "public license general public license", "...", "mit license" * 3,
    ]
    rows = list(enumerate(texts))
    got = {i: (r["_n_words"], r["_n_base"], r["_first_word"], r["_last_word"], r["_base_labels"]) for i, r in scanned(make(rows)).items()}
    assert got == {i: brute.base_licenses(t) for i, t in rows}


def test_a_longer_detection_hides_those_inside(make):
    rows = [
        (1, "licensed under the Apache License, Version 2.0"), (2, "SPDX-License-Identifier: GPL-2.0-or-later"), (3, "GNU Lesser General Public License v2.1 or later"), (4, "Creative Commons Attribution-ShareAlike 4.0"),
        (5, "Permission is hereby granted, free of charge, to any person obtaining a copy"), (6, "nothing here"), (7, "released into the public domain"),
    ]
    found = scanned(make(rows))
    assert found[1]["_labels"] == "apache,apache-2.0" and found[1]["_base_labels"] == "apache"
    assert found[2]["_labels"] == "gpl-2.0-or-later" and found[2]["_score"] == 1.0
    assert "lgpl-2.1-or-later" in found[3]["_labels"].split(",") and "gpl" in found[3]["_base_labels"].split(",")
    assert found[4]["_labels"] == "cc-by-sa-4.0" and found[5]["_labels"] == "mit" and found[6]["_labels"] == "" and found[6]["_score"] == 0
    assert found[7]["_labels"] == "public-domain"


WRAPPED = [
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted"),
    ("gpl-2.0-or-later", "either version 2 of the License, or (at your option) any later version."),
    ("gpl-3.0-or-later", "either version 3 of the License, or (at your option) any later version."),
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy"),
    ("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose"),
    ("zlib", "This software is provided 'as-is', without any express or implied warranty"),
    ("bsd-3-clause", "Neither the name of the copyright holder nor the names of its contributors"),
    ("apache-2.0", "Licensed under the Apache License, Version 2.0"),
    ("mpl-2.0", "the Mozilla Public License, v. 2.0"),
    ("cc-by-sa-4.0", "a Creative Commons Attribution-ShareAlike 4.0 license"),
    ("public-domain", "placed into the public domain"),
    ("proprietary", "All rights reserved"),
]


GAPS = [" ", "\n", "\t", "   ", "\r\n", "\n * ", " *\n * ", "\n# ", "\n// ", "\n//", "*/\n/* ", "\n;; ", "\n-- ", "\n% ", '\n" ', "\n\n> ", "\u00a0", "\u2028"]


def test_wrapped_and_commented_texts(make):
    found = scanned(make([(100 * g + i, text.replace(" ", gap)) for g, gap in enumerate(GAPS) for i, (_, text) in enumerate(WRAPPED)]))
    for g, gap in enumerate(GAPS):
        for i, (label, _) in enumerate(WRAPPED):
            one, plain = found[100 * g + i], found[i]
            assert label in one["_labels"].split(","), (gap, label)
            bases = {*one["_base_labels"].split(","), *plain["_base_labels"].split(",")}  # their words may have any gap
            assert {*one["_labels"].split(",")} - bases == {*plain["_labels"].split(",")} - bases and one["_score"] == plain["_score"], (gap, label)


def test_long_runs_of_signs_are_one_gap(make):
    runs = ["*" * 50_000, " " * 50_000, "- " * 50_000, "#/" * 50_000, '" - ' * 50_000]
    rows = [(i, f"bsd {run}\nlicense") for i, run in enumerate(runs)]
    assert {r["_labels"] for r in scanned(make(rows)).values()} == {"bsd"}


def samples(parsed):
    """Texts that an expression matches: the first choice everywhere, and every other choice once."""
    out = [""]
    for op, arg in parsed:
        op = str(op)
        if op == "LITERAL":
            some = [chr(arg)]
        elif op in ("ANY", "NOT_LITERAL"):
            some = ["x"]
        elif op == "AT" or op.startswith("ASSERT"):
            some = [""]
        elif op == "IN":
            some = [chr(a) if str(o) == "LITERAL" else chr(a[0]) if str(o) == "RANGE" else " " for o, a in arg]
        elif op == "SUBPATTERN":
            some = samples(arg[3])
        elif op == "BRANCH":
            some = [s for branch in arg[1] for s in samples(branch)]
        else:
            assert op in ("MAX_REPEAT", "MIN_REPEAT")
            some = [""] * (arg[0] == 0) + [s * max(arg[0], 1) for s in samples(arg[2])]
        out = [o + some[0] for o in out] + [out[0] + s for s in some[1:]]
    return out


def test_keyword_and_gate_stand_in_every_match():
    n = 0
    for label, keyword, exp, *_ in license_rules.rules():
        for text in samples(_parser.parse(exp)):
            hit = re.search(exp, text)
            assert hit and keyword in hit.group() and any(g in hit.group() for g in licenses.GATES), (label, keyword, text)
            n += 1
    assert n > 3000


def test_gated_and_ungated_scans_agree(make, monkeypatch):
    every = sorted({s for _, _, exp, *_ in license_rules._PHRASES for s in samples(_parser.parse(exp))} | {"(mpl-2.0)", "mpl 2.0", "mplv2", "x\nmpl-1.1 or later", "a simple example"})
    gated = scanned(make(list(enumerate(every))))
    ungated = [(label, "", *rest) for label, _, *rest in license_rules.rules()]
    monkeypatch.setattr(licenses, "rules", lambda: ungated)
    monkeypatch.setattr(licenses, "GATES", ("",))
    assert {i: r["_labels"] for i, r in gated.items()} == {i: r["_labels"] for i, r in scanned(make(list(enumerate(every)))).items()}
    assert gated[every.index("(mpl-2.0)")]["_labels"] == gated[every.index("mpl 2.0")]["_labels"] == "mpl-2.0"


def test_labels_against_brute_force(spark, make, duck):
    """The whole table of the query, and every sample of the hand-written rules with other texts around it."""
    rules = license_rules.rules()
    _, rows = duck("SELECT doc_id, text FROM documents", "sf0.001")
    found = registry.QUERIES["op8_license_scan"](spark, "/root/testdata/sf0.001").collect()
    assert {r["doc_id"]: (r["labels"], r["score"]) for r in found} == {i: brute.license_labels(t, rules, license_rules.GAP) for i, t in rows}
    rng = random.Random(0)
    every = [samples(_parser.parse(exp))[0] for _, _, exp, *_ in license_rules._PHRASES]
    made = [(i, f"Some words {s.title()}, and\n * {rng.choice(every)} then {rng.choice(every)}".replace(" ", rng.choice([" ", "  ", "\n# "]))) for i, s in enumerate(every)]
    assert {i: (r["_labels"], r["_score"]) for i, r in scanned(make(made)).items()} == {i: brute.license_labels(t, rules, license_rules.GAP) for i, t in made}


def test_odd_rows_and_no_python(make, odd):
    df = make(odd, extra=True)
    found = licenses.scan(df)
    assert found.columns[: len(df.columns) - 2] == [c for c in df.columns if c not in ("_n_words", "_score")]
    assert found.where("_low = 'x' AND `a.b` = 'x'").count() == len(odd)
    assert licenses.scan(make([])).count() == 0
    plan = found._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow|Exchange", plan.split("Physical Plan")[1].replace("RoundRobinPartitioning", "").replace("Exchange ", "", 1))
