import random
import re

from tests.llm.helpers import awkward, documents, empty

from ledgerline.llm import licenses

BASE = {"mit": "under the mit license", "apache-2": "apache license version 2", "cc-by-nc": "cc by nc"}


def words_of(text):
    lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower)


def matches(words, rule):
    """Leftmost places of a rule, word by word: greedy about optional words, as the rule's expression is."""

    def ends(at, tokens):
        if not tokens:
            yield at
            return
        token = tokens[0].removeprefix("~")
        if at < len(words) and re.fullmatch(token, words[at]):
            yield from ends(at + 1, tokens[1:])
        if tokens[0].startswith("~"):
            yield from ends(at, tokens[1:])

    at, found = 0, []
    while at < len(words):
        end = next(ends(at, rule.words.split()), None)
        if end is not None and end > at:
            found.append((at, end))
        at = end if end is not None and end > at else at + 1
    return found


def brute(text):
    words = words_of(text)
    held = set(words)
    found = []
    for k, rule in enumerate(licenses.RULES):
        plain = [t for t in rule.words.split() if re.fullmatch("[a-z0-9]+", t)]
        if held.issuperset(plain):
            found += [(s, e, rule.priority, k, rule) for s, e in matches(words, rule)]
    stay = []
    for a in found:
        covers = [b for b in found if b is not a and b[0] <= a[0] and b[1] >= a[1] and b[2] <= a[2]]
        covers = [b for b in covers if b[1] - b[0] > a[1] - a[0] or b[2:4] < a[2:4]]
        if a[4].base or not covers:
            stay.append(a)
    stay.sort(key=lambda a: (a[0], -a[1], a[2], a[3]))
    return len(words), [(s, e, r.label) for s, e, _, _, r in stay], max([r.confidence for *_, r in stay], default=0.0)


def check(frame):
    rows = licenses.with_licenses(frame).collect()
    assert len(rows) == frame.count()
    for r in rows:
        ours = r["licenses"]
        n, found, score = brute(r["text"])
        assert (ours["n_words"], [(d["start"], d["stop"], d["label"]) for d in ours["detections"]], ours["score"]) == (n, found, score)
        assert ours["labels"] == sorted({f[2] for f in found})
        words = words_of(r["text"])
        places = {label: [i for i in range(n) if words[i : i + len(p.split())] == p.split()] for label, p in BASE.items()}
        for label, starts in places.items():
            assert [d["start"] for d in ours["detections"] if d["base"] and d["label"] == label] == starts


TEXTS = [
    "Licensed under the MIT License, see LICENSE", "under the mit license under the mit license",
    "SPDX-License-Identifier: GPL-2.0-or-later", "licensed under the GNU General Public License version 3",
    "Apache License, Version 2.0 (the License)", "apache license version 2 apache license version 2 0", "CC BY-NC-SA 4.0 and cc-by-nc 4.0",
    "cc by nc nd", "CC-BY-NC cc by nc cc by nc", "bsd 3 clause license; 3-clause BSD licence", "under\x00the\x7fmit{license}", "under the émit license",
    "İ under the mit license", "Permission is hereby granted, free of charge, to any person obtaining a copy", "", " ", None, "mit",
    "released under the terms of the Mozilla Public License v 2.0 or the new bsd license",
]


def test_same_as_brute_force(spark):
    check(spark.createDataFrame(enumerate(TEXTS), "doc_id long, text string"))
    check(documents(spark).select("doc_id", "text"))
    check(awkward(spark).withColumnRenamed("spans", "licenses"))
    assert licenses.with_licenses(empty(spark)).count() == 0


def test_random_words_of_rules(spark):
    pick = random.Random(3)
    vocabulary = sorted({t.removeprefix("~") for r in licenses.RULES for t in r.words.split() if re.fullmatch("~?[a-z0-9]+", t)})
    texts = []
    for _ in range(300):
        words = []
        for _ in range(pick.randint(1, 6)):
            rule = pick.choice(licenses.RULES)
            words += [t.removeprefix("~") for t in rule.words.split() if re.fullmatch("~?[a-z0-9]+", t) and (t[0] != "~" or pick.random() < 0.6)]
            words += pick.sample(vocabulary, pick.randint(0, 2))
        texts.append(pick.choice([" ", "-", ", "]).join(words))
    check(spark.createDataFrame(enumerate(texts), "doc_id long, text string"))


def test_every_rule_is_reached(spark):
    """Each rule finds its own words (with the optional ones), so its keyword opens it."""
    plain = lambda t: re.sub(r"\[(.).*?\]", r"\1", re.sub(r"\(\?:(\w+)\|.*?\)", r"\1", t.removeprefix("~"))).replace("?", "")
    texts = [" ".join(plain(t) for t in r.words.split()) for r in licenses.RULES]
    rows = licenses.with_licenses(spark.createDataFrame(enumerate(texts), "doc_id long, text string")).collect()
    assert len(licenses.RULES) > 300
    for r in rows:
        assert licenses.RULES[r["doc_id"]].label in r["licenses"]["labels"] or r["licenses"]["detections"][0]["stop"] >= 3


def test_many_detections_and_long_texts(spark):
    many, distinct = "under the mit license or " * 50_000, " ".join(f"v{i}" for i in range(500_000))
    rows = licenses.with_licenses(spark.createDataFrame([(1, many), (2, distinct)], "doc_id long, text string"))
    found = {r["doc_id"]: r for r in rows.selectExpr("doc_id", "licenses.n_words n", "size(licenses.detections) d", "licenses.labels l").collect()}
    assert (found[1]["n"], found[1]["d"], found[1]["l"]) == (250_000, 50_000, ["mit"])
    assert (found[2]["n"], found[2]["d"]) == (500_000, 0)


def test_no_python(spark):
    plan = licenses.with_licenses(documents(spark))._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Arrow|Pandas", plan)
