"""License scans: ordered signature rules over the words of a text, as expressions of the JVM.

A text is lower-cased (A-Z) and brought to a normal form in which every word stands between two spaces of its own, so
a rule is a regular expression over whole words and neighbouring matches share no character. Which rules a text is
tried against is decided by one pass for the rules' keywords. Of overlapping detections, one that lies inside the words
of another of the same or a better priority is suppressed; base rules stay whatever covers them.
"""

from __future__ import annotations

from dataclasses import dataclass
from itertools import groupby
from string import ascii_lowercase, ascii_uppercase

from pyspark.sql import Column, DataFrame, functions as F

from ledgerline.llm.expressions import let, places, scan

#: Everything that separates words: ASCII characters that are neither digits nor small letters.
SEPARATOR = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


@dataclass(frozen=True)
class Rule:
    """``words`` are regular expressions of single words; one after ``~`` may be missing.

    Every text that the rule matches holds ``keyword``, a literal word of the rule. Priority 0 is best.
    """

    label: str
    keyword: str
    words: str
    priority: int
    confidence: float
    base: bool = False

    def __post_init__(self):
        if "'" in self.label + self.words or "\\" in self.label + self.words:
            raise ValueError("labels and words are written into SQL: no quotes or backslashes")
        if self.keyword not in self.words.split():
            raise ValueError(f"{self.keyword!r} is no literal word of {self.words!r}")

    @property
    def pattern(self) -> str:
        """The rule over the normal form."""
        return "".join(f"(?: {w[1:]} )?" if w.startswith("~") else f" {w} " for w in self.words.split())


#: Base phrases and their labels (fixed values).
BASE = (
    ("mit", "mit", "under the mit license"),
    ("apache-2", "apache", "apache license version 2"),
    ("cc-by-nc", "nc", "cc by nc"),
)

#: Licenses: label, words of the identifier, keyword, words of the name (fixed values).
NAMES = """
0bsd | 0bsd | bsd | zero clause bsd
0bsd | 0bsd | bsd | bsd zero clause
afl-3 | afl 3 0 | academic | academic free ~license ~version ~v 3 ~0
agpl-3 | agpl 3 0 | affero | ~gnu affero general public ~license ~version ~v 3 ~0
agpl-3 | agpl 3 0 | agpl | ~gnu agpl ~version ~v 3 ~0
agpl-3 | agpl 3 0 | agplv3 | ~gnu agplv3
apache-1 | apache 1 1 | apache | apache ~software ~license ~version ~v 1 ~1
apache-2 | apache 2 0 | apache | apache ~software ~license ~version ~v 2 ~0
apsl-2 | apsl 2 0 | apple | apple public source ~license ~version 2 ~0
artistic-1 | artistic 1 0 | artistic | ~perl artistic ~license ~version 1 ~0
artistic-2 | artistic 2 0 | artistic | ~perl artistic ~license ~version 2 ~0
beerware | beerware | beerware | beerware
beerware | beerware | beer | beer ware
blueoak-1 | blueoak 1 0 0 | oak | blue oak model ~license ~version 1 ~0 ~0
bsd-1 | bsd 1 clause | bsd | bsd (?:1|one) clause
bsd-2 | bsd 2 clause | bsd | bsd (?:2|two) clause
bsd-2 | bsd 2 clause | bsd | (?:2|two) clause bsd
bsd-2 | bsd 2 clause | bsd | simplified bsd
bsd-2 | bsd 2 clause | freebsd | freebsd
bsd-3 | bsd 3 clause | bsd | bsd (?:3|three) clause
bsd-3 | bsd 3 clause | bsd | (?:3|three) clause bsd
bsd-3 | bsd 3 clause | bsd | (?:new|modified|revised) bsd
bsd-4 | bsd 4 clause | bsd | bsd (?:4|four) clause
bsd-4 | bsd 4 clause | bsd | (?:original|old) bsd
bsl-1 | bsl 1 0 | boost | boost software ~license ~version 1 ~0
bsl-1 | bsl 1 0 | boost | boost
busl-1.1 | busl 1 1 | business | business source ~license ~version 1 ~1
cc-by | cc by [1-4] 0 | attribution | creative commons attribution ~[1-4] ~0 ~international
cc-by | cc by [1-4] 0 | cc | cc by [1-4] 0
cc-by-nc | cc by nc [1-4] 0 | noncommercial | creative commons attribution noncommercial ~[1-4] ~0 ~international
cc-by-nc | cc by nc [1-4] 0 | commercial | creative commons attribution non commercial ~[1-4] ~0 ~international
cc-by-nc | cc by nc [1-4] 0 | nc | cc by nc [1-4] 0
cc-by-nc-nd | cc by nc nd [1-4] 0 | nd | cc by nc nd ~[1-4] ~0
cc-by-nc-nd | cc by nc nd [1-4] 0 | noderivatives | creative commons attribution noncommercial noderivatives
cc-by-nc-sa | cc by nc sa [1-4] 0 | sa | cc by nc sa ~[1-4] ~0
cc-by-nc-sa | cc by nc sa [1-4] 0 | sharealike | creative commons attribution noncommercial sharealike
cc-by-nd | cc by nd [1-4] 0 | nd | cc by nd ~[1-4] ~0
cc-by-nd | cc by nd [1-4] 0 | noderivatives | creative commons attribution noderivatives
cc-by-sa | cc by sa [1-4] 0 | sa | cc by sa ~[1-4] ~0
cc-by-sa | cc by sa [1-4] 0 | sharealike | creative commons attribution sharealike
cc-by-sa | cc by sa [1-4] 0 | alike | creative commons attribution share alike
cc0 | cc0 1 0 | cc0 | cc0 ~1 ~0 ~universal
cc0 | cc0 1 0 | dedication | creative commons public domain dedication
cddl-1 | cddl 1 0 | cddl | cddl ~version ~v 1 ~[01]
cddl-1 | cddl 1 0 | distribution | common development and distribution ~license ~version 1 ~[01]
cecill-2 | cecill 2 1 | cecill | cecill ~version ~v 2 ~[01]
cecill-b | cecill b | cecill | cecill b
cpal-1 | cpal 1 0 | cpal | cpal ~version 1 ~0
cpl-1 | cpl 1 0 | common | common public ~license ~version ~v 1 ~0
curl | curl | curl | curl
ecl-2 | ecl 2 0 | educational | educational community ~license ~version 2 ~0
efl-2 | efl 2 0 | eiffel | eiffel forum ~license ~version 2 ~0
elastic-2 | elastic 2 0 | elastic | elastic ~license ~version ~v 2 ~0
epl-1 | epl 1 0 | eclipse | eclipse public ~license ~version ~v 1 ~0
epl-2 | epl 2 0 | eclipse | eclipse public ~license ~version ~v 2 ~0
eupl-1.2 | eupl 1 2 | eupl | eupl ~version ~v 1 ~2
eupl-1.2 | eupl 1 2 | european | european union public ~license ~version ~v 1 ~2
gfdl-1.3 | gfdl 1 3 | documentation | ~gnu free documentation ~license ~version 1 ~3
gpl-1 | gpl 1 0 | general | ~gnu general public ~license ~version ~v 1 ~0
gpl-2 | gpl 2 0 | general | ~gnu general public ~license ~version ~v 2 ~0
gpl-2 | gpl 2 0 | gpl | ~gnu gpl ~version ~v 2 ~0
gpl-2 | gpl 2 0 | gplv2 | ~gnu gplv2
gpl-3 | gpl 3 0 | general | ~gnu general public ~license ~version ~v 3 ~0
gpl-3 | gpl 3 0 | gpl | ~gnu gpl ~version ~v 3 ~0
gpl-3 | gpl 3 0 | gplv3 | ~gnu gplv3
hpnd | hpnd | historical | historical permission notice and disclaimer
icu | icu | icu | icu
ijg | ijg | jpeg | independent jpeg group
ipl-1 | ipl 1 0 | ibm | ibm public ~license ~version 1 ~0
isc | isc | isc | isc
lgpl-2 | lgpl 2 0 | library | ~gnu library general public ~license ~version ~v 2 ~0
lgpl-2.1 | lgpl 2 1 | lesser | ~gnu lesser general public ~license ~version ~v 2 ~1
lgpl-2.1 | lgpl 2 1 | lgpl | ~gnu lgpl ~version ~v 2 ~1
lgpl-3 | lgpl 3 0 | lesser | ~gnu lesser general public ~license ~version ~v 3 ~0
lgpl-3 | lgpl 3 0 | lgpl | ~gnu lgpl ~version ~v 3 ~0
lgpl-3 | lgpl 3 0 | lgplv3 | ~gnu lgplv3
lpl-1 | lpl 1 02 | lucent | lucent public ~license ~version 1 ~02
lppl-1.3 | lppl 1 3c | latex | latex project public ~license ~version 1 ~3c
mit | mit | mit | mit
mit-0 | mit 0 | mit | mit no attribution
mit-0 | mit 0 | mit | mit 0
mpl-1.1 | mpl 1 1 | mozilla | mozilla public ~license ~version ~v 1 ~1
mpl-2 | mpl 2 0 | mozilla | mozilla public ~license ~version ~v 2 ~0
mpl-2 | mpl 2 0 | mpl | mpl ~version ~v 2 ~0
ms-pl | ms pl | microsoft | microsoft public
ms-rl | ms rl | microsoft | microsoft reciprocal
mulan-2 | mulanpsl 2 0 | mulan | mulan permissive software ~license ~version ~v 2
ncsa | ncsa | ncsa | ~university ~of ~illinois ncsa ~open ~source
npl-1 | npl 1 0 | netscape | netscape public ~license ~version 1 ~0
odbl-1 | odbl 1 0 | database | open database ~license ~version ~v 1 ~0
odc-by-1 | odc by 1 0 | data | open data commons attribution
ofl-1.1 | ofl 1 1 | sil | sil open font ~license ~version 1 ~1
openssl | openssl | openssl | openssl
osl-3 | osl 3 0 | osl | osl ~version 3 ~0
osl-3 | osl 3 0 | open | open software ~license ~version ~v 3 ~0
pddl-1 | pddl 1 0 | dedication | open data commons public domain dedication
php-3 | php 3 01 | php | php ~license ~version 3 ~01
postgresql | postgresql | postgresql | postgresql
psf-2 | psf 2 0 | python | python software foundation ~license ~version 2
qpl-1 | qpl 1 0 | qpl | qpl ~version 1 ~0
ruby | ruby | ruby | ruby
sleepycat | sleepycat | sleepycat | sleepycat
sspl-1 | sspl 1 0 | server | server side public ~license ~version 1
unicode | unicode dfs 2016 | unicode | unicode
unlicense | unlicense | unlicense | unlicense
upl-1 | upl 1 0 | universal | universal permissive ~license ~version 1 ~0
vim | vim | vim | vim
w3c | w3c | w3c | w3c ~software ~notice ~and
wtfpl | wtfpl | wtfpl | wtfpl ~version ~2
x11 | x11 | x11 | x11
zlib | zlib | zlib | zlib
zlib | zlib | zlib | zlib libpng
zpl-2 | zpl 2 1 | zope | zope public ~license ~version 2 ~1
"""

#: How a text speaks of a license: words, priority, confidence. ``{id}`` and ``{name}`` come from ``NAMES``.
FORMS = (
    ("spdx licen[cs]e identifier {id}", 1, 1.0),
    ("licen[cs]ed ~to ~you under ~the ~terms ~of ~the {name}", 2, 0.95),
    ("(?:released|distributed|published|available|provided|redistributed|governed|covered) (?:under|by) ~the ~terms ~of ~the {name}", 2, 0.9),
    ("{name} licen[cs]e", 3, 0.85),
)

#: Sentences and addresses that only one license has: label, keyword, words (fixed values).
SENTENCES = (
    ("mit", "hereby", "permission is hereby granted free of charge to any person obtaining a copy"),
    ("isc", "hereby", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted"),
    ("bsd", "redistribution", "redistribution and use in source and binary forms with or without modification are permitted"),
    ("bsd-3", "endorse", "neither the name of ~the ~copyright ~holder ~nor ~the ~names ~of ~its ~contributors may be used to endorse or promote products"),
    ("gpl", "redistribute", "you can redistribute it and or modify it under the terms of the gnu general public license"),
    ("lgpl", "lesser", "you can redistribute it and or modify it under the terms of the gnu lesser general public license"),
    ("agpl", "affero", "you can redistribute it and or modify it under the terms of the gnu affero general public license"),
    ("zlib", "misrepresented", "the origin of this software must not be misrepresented"),
    ("unlicense", "unencumbered", "this is free and unencumbered software released into the public domain"),
    ("boost", "executable", "machine executable object code generated by a source language processor"),
    ("mpl-2", "mozilla", "this source code form is subject to the terms of the mozilla public license"),
    ("epl", "eclipse", "made available under the terms of the eclipse public license"),
    ("wtfpl", "wtfpl", "you just do what the fuck you want to wtfpl"),
    ("ofl", "font", "this font software is licensed under the sil open font license"),
    ("artistic", "artistic", "you may redistribute it under the terms of the artistic license"),
    ("public-domain", "domain", "(?:released|dedicated|placed) (?:into|to|in) the public domain"),
    ("all-rights-reserved", "reserved", "all rights reserved"),
    ("as-is", "warranty", "is provided as is without warranty of any kind"),
    ("proprietary", "proprietary", "proprietary and confidential"),
    ("no-redistribution", "prohibited", "(?:unauthorized|unauthorised) (?:copying|use|distribution) ~of ~this ~file is ~strictly prohibited"),
    ("apache-2", "apache", "~www apache org licenses license 2 0"),
    ("mit", "mit", "opensource org licenses? mit"),
    ("bsd-3", "bsd", "opensource org licenses? bsd 3 clause"),
    ("bsd-2", "bsd", "opensource org licenses? bsd 2 clause"),
    ("isc", "isc", "opensource org licenses? isc"),
    ("gpl-2", "gpl", "gnu org licenses ~old ~licenses gpl 2 0"),
    ("gpl-3", "gpl", "gnu org licenses gpl 3 0"),
    ("lgpl-3", "lgpl", "gnu org licenses lgpl 3 0"),
    ("agpl-3", "agpl", "gnu org licenses agpl 3 0"),
    ("mpl-2", "mozilla", "mozilla org mpl 2 0"),
    ("epl-2", "eclipse", "eclipse org legal epl ~v20 ~2 ~0"),
    ("unlicense", "unlicense", "unlicense org"),
    ("cc0", "creativecommons", "creativecommons org publicdomain zero"),
    ("cc-by", "creativecommons", "creativecommons org licenses by [1-4] 0"),
    ("cc-by-sa", "creativecommons", "creativecommons org licenses by sa [1-4] 0"),
    ("cc-by-nc", "creativecommons", "creativecommons org licenses by nc [1-4] 0"),
    ("cc-by-nd", "creativecommons", "creativecommons org licenses by nd [1-4] 0"),
    ("cc-by-nc-sa", "creativecommons", "creativecommons org licenses by nc sa [1-4] 0"),
    ("cc-by-nc-nd", "creativecommons", "creativecommons org licenses by nc nd [1-4] 0"),
)


def default_rules() -> tuple[Rule, ...]:
    """Base rules, each form of each license, and the sentences: some 450 rules, best priority first."""
    rules = [Rule(label, keyword, words, 0, 1.0, base=True) for label, keyword, words in BASE]
    for line in NAMES.strip().splitlines():
        label, identifier, keyword, name = (part.strip() for part in line.split(" | "))
        for words, priority, confidence in FORMS:
            gate = "spdx" if "{id}" in words else keyword
            rules.append(Rule(label, gate, words.format(id=identifier, name=name), priority, confidence))
    rules += [Rule(label, keyword, words, 1, 0.98) for label, keyword, words in SENTENCES]
    unique = {(r.label, r.words): r for r in rules}
    return tuple(sorted(unique.values(), key=lambda r: r.priority))


RULES = default_rules()

_FOUND = "struct<start:int,stop:int,priority:int,rule:int,label:string,confidence:double,base:boolean>"
FIELDS = f"struct<n_words:bigint,detections:array<{_FOUND}>,labels:array<string>,score:double>"


def normal_form(text: Column) -> Column:
    """The words of a text, each between two spaces of its own; empty without words."""
    lower = F.translate(F.coalesce(text.cast("string"), F.lit("")), ascii_uppercase, ascii_lowercase)
    return let(
        F.btrim(F.regexp_replace(lower, SEPARATOR, "  "), F.lit(" ")),
        lambda words: F.when(words == "", "").otherwise(F.concat(F.lit(" "), words, F.lit(" "))),
    )


def count_words(normal: Column) -> Column:
    """Words in a stretch of the normal form: half of its spaces."""
    return ((F.length(normal) - F.length(F.translate(normal, " ", ""))) / 2).cast("int")


def keyword_pattern(rules: tuple[Rule, ...]) -> str:
    """One expression for all keywords, grouped by their first letters, so that a word meets few alternatives."""
    words = sorted({r.keyword for r in rules})
    parts = [f"{first}(?:{'|'.join(w[1:] for w in group)})" for first, group in groupby(words, key=lambda w: w[0])]
    return f" ({'|'.join(parts)}) "


def _detections(normal: Column, rules: tuple[Rule, ...]) -> Column:
    """All matches of the rules whose keywords the text has, by start, longest first, then by priority and rule."""
    # As one SQL expression, which becomes a literal: built column by column it would take longer than to run.
    rows = [
        f"named_struct('keyword', '{r.keyword}', 'pattern', '{r.pattern}', 'priority', {r.priority}, 'rule', {k}, "
        f"'label', '{r.label}', 'confidence', {r.confidence}D, 'base', {str(r.base).lower()})"
        for k, r in enumerate(rules)
    ]
    table = F.expr(f"array({', '.join(rows)})")

    def of_rule(r: Column) -> Column:
        return F.transform(
            places(normal, r["pattern"], count_words),
            lambda p: F.struct(
                p["start"].alias("start"), (-p["stop"]).alias("before"), r["priority"].alias("priority"), r["rule"].alias("rule"),
                r["label"].alias("label"), r["confidence"].alias("confidence"), r["base"].alias("base"),
            ),
        )

    def tried(present: Column) -> Column:
        candidates = F.filter(table, lambda r: F.array_contains(present, r["keyword"]))
        return F.array_sort(F.flatten(F.transform(candidates, of_rule)))

    found = let(F.array_distinct(F.regexp_extract_all(normal, F.lit(keyword_pattern(rules)), F.lit(1))), tried)
    return F.transform(
        found,
        lambda d: F.struct(
            d["start"], (-d["before"]).alias("stop"), d["priority"], d["rule"], d["label"], d["confidence"], d["base"]
        ),
    ).cast(f"array<{_FOUND}>")


def _kept(detections: Column, levels: int) -> Column:
    """Without those inside an earlier one of the same or a better priority.

    In the given order a container comes before its contents, so the furthest stop so far, for each priority, tells.
    """

    def step(reach: Column, d: Column) -> Column:
        inside = F.element_at(reach, d["priority"] + 1) >= d["stop"]
        # Level p of the state: the furthest stop of priorities up to p.
        after = F.transform(reach, lambda far, p: F.when(p >= d["priority"], F.greatest(far, d["stop"])).otherwise(far))
        return F.struct(after.alias("state"), F.struct(d.alias("d"), (~inside | d["base"]).alias("stays")).alias("out"))

    nothing = F.array(*[F.lit(0)] * levels)
    marked = scan(detections, nothing, step, "array<int>", f"struct<d:{_FOUND},stays:boolean>")
    return F.transform(F.filter(marked, lambda m: m["stays"]), lambda m: m["d"])


def with_licenses(
    df: DataFrame, text: str = "text", into: str = "licenses", rules: tuple[Rule, ...] = RULES
) -> DataFrame:
    """Add the struct ``into`` (see ``FIELDS``) to every row; no row moves, none is dropped, nothing leaves the JVM.

    ``detections`` are those that stay, by start, longest first: start and stop are word numbers (stop exclusive).
    ``labels`` are their distinct labels, sorted; ``score`` is the highest confidence among them, 0 without any. A null
    or empty text, or one without words, has no words and no detections. Repeated rows get the same result each, an empty
    table gives an empty one. An existing column ``into`` is replaced, other columns stay. A text is one value of a
    row: a task holds about six copies of the longest; n detections in one text cost n to the power of 1.5.
    """
    levels = max(r.priority for r in rules) + 1

    def result(normal: Column) -> Column:
        def of_kept(kept: Column) -> Column:
            labels = F.array_sort(F.array_distinct(F.transform(kept, lambda d: d["label"])))
            score = F.coalesce(F.array_max(F.transform(kept, lambda d: d["confidence"])), F.lit(0.0))
            words = count_words(normal).cast("long")
            return F.struct(
                words.alias("n_words"), kept.alias("detections"), labels.alias("labels"), score.alias("score")
            ).cast(FIELDS)

        return let(_kept(_detections(normal, rules), levels), of_kept)

    return df.withColumn(into, let(normal_form(F.col(text)), result))
