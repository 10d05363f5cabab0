import random
import re
import time

import pytest

from tests.llm.conftest import corpus, rows
from tracewright.llm import licenses

PHRASES = {"gnu general public license": "gpl", "apache license": "apache", "cc by": "cc-by", "mit license": "mit"}


def base(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", low)
    at = [(i, label) for p, label in PHRASES.items() for i in range(len(words)) if words[i : i + len(p.split())] == p.split()]
    return len(words), len(at), min(at)[0] if at else None, max(at)[0] if at else None, ",".join(sorted({x for _, x in at}))


@pytest.mark.parametrize(
    "text, labels",
    [
        ("Licensed under the Apache License, Version 2.0.", "apache,apache-2.0"),
        ("Licensed under CC BY-NC 4.0.", "cc-by,cc-by-nc"),
        ("Released under the MIT License. Released under the mit license", "mit"),
        ("This work is licensed under the GNU General Public License, version 3.", "gpl,gpl-3.0"),
        ("SPDX-License-Identifier: BSD-3-Clause", "bsd-3-clause"),
        ("Permission is hereby granted, free of charge, to any person obtaining a copy of this software to deal", "mit"),
        ("All rights reserved. Copyright (c) 2020 X", "all-rights-reserved,copyright"),
        ("MITLicense mit. license cc  by \nécc by", "cc-by,mit"),
        ("an intermittent licenser", ""),
        ("GNU GNU General Public License license apache apache license", "apache,gpl"),
    ],
)
def test_labels_and_base(text, labels):
    got = licenses.scanner()(text)
    assert got[:5] == base(text) and got[5] == labels
    assert 0 <= got[6] <= 1 and (got[6] > 0) == bool(labels)


def test_contained_hits_of_less_priority_are_suppressed():
    rules = (licenses.Rule("long", 9, 1.0, ("aa",), "aa bb cc"), licenses.Rule("short", 5, 0.5, ("bb",), "bb"), licenses.Rule("gated", 5, 0.5, ("zz",), "cc"))
    assert licenses.scanner(rules)("aa bb cc")[5] == "long"
    assert licenses.scanner(rules)("aa bb cc bb zz")[5] == "long,short"


def test_there_are_hundreds_of_rules():
    assert len(licenses.PASSAGES) + 2 * len(licenses.FAMILIES) > 200
    assert len(licenses.RULES) > 300 and len({(r.label, r.pattern) for r in licenses.RULES}) == len(licenses.RULES)


def plain_scan(rules, text):
    """Labels and score by comparing every hit with every one taken before."""
    line = f" {' '.join(re.findall('[^\x00-\x2f\x3a-\x60\x7b-\x7f]+', text))} "
    hits = []
    for r in rules:
        if all(k in line for k in r.keywords):
            hits += [(-r.priority, m.start() - m.end(), m.start(), m.end(), r.label, r.confidence) for m in re.finditer(f"(?<= )(?:{r.pattern})(?= )", line)]
    taken, labels, score = [], {label for p, label in PHRASES.items() if f" {p} " in line}, 0.0
    score = licenses.BASE_CONFIDENCE if labels else 0.0
    for _, _, a, b, label, confidence in sorted(hits):
        if not any(x <= a and b <= y for x, y in taken):
            taken.append((a, b))
            labels.add(label)
            score = max(score, confidence)
    return ",".join(sorted(labels)), score


def test_random_hits_equal_brute_force():
    rnd = random.Random(3)
    for _ in range(400):
        rules = []
        for i in range(rnd.randrange(1, 12)):
            words = [rnd.choice("abc") for _ in range(rnd.randrange(1, 5))]
            rules.append(licenses.Rule(f"l{i}", rnd.randrange(1, 4), rnd.randrange(1, 10) / 10, (words[0],), " ".join(words)))
        text = " ".join(rnd.choice("abcd") for _ in range(rnd.randrange(40)))
        assert licenses.scanner(tuple(rules))(text)[5:] == plain_scan(rules, text)
    pieces = "gnu general public license v 2 3 0 apache mit cc by nc sa 4 under the terms of licensed released software all rights reserved".split()
    for _ in range(200):
        text = " ".join(rnd.choice(pieces) for _ in range(60))
        assert licenses.scanner()(text)[5:] == plain_scan(licenses.RULES, text)


def test_long_text_takes_linear_time():
    began = time.time()
    got = licenses.scanner()("mit license here. " * 170_000)
    assert got[1] == 170_000 and got[5] == "mit" and time.time() - began < 20


def test_operator_on_odd_rows(docs, none):
    scan = licenses.scanner()
    assert rows(licenses.scan_licenses(docs)) == sorted(((r[0], *scan(r[1])) for r in corpus()), key=repr)
    assert all(scan(r[1])[:5] == base(r[1]) for r in corpus())
    assert licenses.scan_licenses(none).collect() == []
