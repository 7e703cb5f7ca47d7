"""License scans: ordered signature rules behind a keyword prefilter.

A text becomes lower-case words joined by single blanks. The license keywords among them choose the signature rules whose
regular expressions run; overlapping detections are resolved by priority and interval containment. All of it is one map
over the documents without a shuffle.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

GAP = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: Phrases and labels fixed by the contract of op7.
BASE = {"under the mit license": "mit", "apache license version 2": "apache-2", "cc by nc": "cc-by-nc"}


@dataclass(frozen=True)
class Signature:
    """``regex`` runs over blank-joined words of texts that hold ``keyword``, a word of every match; a higher priority
    suppresses what it contains."""

    label: str
    keyword: str
    regex: str
    priority: int
    weight: float


#: Signatures written by hand from license names, notices, identifiers and sentences of license texts, one a line: label,
#: keyword, priority, regex over lower-case words.
SIGNATURES = r"""
mit|mit|4|(?:released|licensed|distributed|available|provided|published|covered) under (?:the terms of )?(?:the )?mit licen[sc]e
mit|mit|3|under (?:the terms of )?(?:the )?mit licen[sc]e
mit|mit|2|(?:the )?mit licen[sc]e(?: mit)?
mit|mit|2|mit licensed
mit|mit|2|mit expat licen[sc]e
mit|mit|5|spdx license identifier mit
mit|mit|3|licen[sc]e mit
mit|expat|2|(?:the )?expat licen[sc]e
mit|x11|2|(?:the )?x11 licen[sc]e
mit|hereby|6|permission is hereby granted free of charge to any person obtaining a copy(?: of this software and associated documentation files)?
mit|noninfringement|4|merchantability fitness for a particular purpose and noninfringement
mit|substantial|4|shall be included in all copies or substantial portions of the software
mit-0|mit|5|spdx license identifier mit 0
mit-0|attribution|3|(?:the )?mit no attribution(?: licen[sc]e)?
apache-2|apache|4|(?:released|licensed|distributed|available|provided|published|covered) under (?:the terms of )?(?:the )?apache(?: software)? licen[sc]e(?: v| version)? 2(?: 0)?
apache-2|apache|3|under (?:the terms of )?(?:the )?apache(?: software)? licen[sc]e(?: v| version)?(?: 2)?(?: 0)?
apache-2|apache|3|(?:the )?apache(?: software)? licen[sc]e(?: v| version) 2(?: 0)?
apache-2|apache|2|(?:the )?apache licen[sc]e 2(?: 0)?
apache-2|apache|2|apache 2(?: 0)? licen[sc]ed?
apache-2|apache|1|(?:the )?apache(?: software)? licen[sc]e
apache-2|apache|2|licensed under (?:the )?apache(?: 2)?(?: 0)?
apache-2|apache|5|spdx license identifier apache 2 0
apache-2|apache|6|licenses license 2 0 apache
apache-2|apache|4|http www apache org licenses license 2 0
apache-2|apache|4|https www apache org licenses license 2 0
apache-2|compliance|6|you may not use this file except in compliance with the license
apache-2|limitations|5|see the license for the specific language governing permissions and limitations under the license
apache-1.1|apache|3|(?:the )?apache(?: software)? licen[sc]e(?: v| version) 1 1
apache-1.1|apache|5|spdx license identifier apache 1 1
bsd|bsd|3|under (?:the terms of )?(?:the |a )?bsd(?: style)? licen[sc]e
bsd|bsd|1|(?:the )?bsd(?: style)? licen[sc]e
bsd|bsd|2|licensed under (?:the )?bsd
bsd|bsd|1|bsd licensed
bsd-2|freebsd|2|(?:the )?freebsd licen[sc]e
bsd-2|simplified|3|(?:the )?simplified bsd licen[sc]e
bsd-2|clause|3|(?:the )?bsd 2 clause(?: simplified)?(?: licen[sc]e)?
bsd-2|clause|3|(?:the )?2 clause bsd(?: licen[sc]e)?
bsd-2|clause|3|(?:the )?two clause bsd(?: licen[sc]e)?
bsd-2|bsd|5|spdx license identifier bsd 2 clause
bsd-2|redistribution|5|redistribution and use in source and binary forms with or without modification are permitted
bsd-2|redistributions|4|redistributions of source code must retain the above copyright notice
bsd-2|redistributions|4|redistributions in binary form must reproduce the above copyright notice
bsd-3|revised|3|(?:the )?revised bsd licen[sc]e
bsd-3|modified|3|(?:the )?modified bsd licen[sc]e
bsd-3|bsd|3|(?:the )?new bsd licen[sc]e
bsd-3|clause|3|(?:the )?bsd 3 clause(?: new| revised)?(?: licen[sc]e)?
bsd-3|clause|3|(?:the )?3 clause bsd(?: licen[sc]e)?
bsd-3|clause|3|(?:the )?three clause bsd(?: licen[sc]e)?
bsd-3|bsd|5|spdx license identifier bsd 3 clause
bsd-3|endorse|6|may be used to endorse or promote products derived from this software(?: without specific prior written permission)?
bsd-4|clause|3|(?:the )?bsd 4 clause(?: licen[sc]e)?
bsd-4|bsd|3|(?:the )?original bsd licen[sc]e
bsd-4|advertising|6|all advertising materials mentioning features or use of this software
bsd-0|0bsd|3|0bsd(?: licen[sc]e)?
bsd-0|clause|3|(?:the )?zero clause bsd(?: licen[sc]e)?
gpl|gpl|1|(?:the )?gpl licen[sc]e
gpl|gpl|2|(?:licensed|released|distributed) under (?:the )?gpl
gpl|gnu|1|(?:the )?gnu general public licen[sc]e
gpl|gnu|1|(?:the )?gnu gpl
gpl-2|gplv2|3|(?:licensed |released |distributed )?(?:under )?(?:the )?gplv2(?: licen[sc]e)?
gpl-2|gpl|3|(?:the )?gpl(?: v| version) ?2(?: 0)?(?: licen[sc]e)?
gpl-2|gnu|4|(?:the )?gnu general public licen[sc]e(?: as published by the free software foundation)?(?: either)?(?: v| version) 2(?: 0)?
gpl-2|gnu|4|version 2 of the gnu general public licen[sc]e
gpl-2|gnu|3|(?:the )?gnu gpl v2
gpl-2|gpl|5|spdx license identifier gpl 2 0(?: only| or later)?
gpl-2|2|5|either version 2 of the license or at your option any later version
gpl-3|gplv3|3|(?:licensed |released |distributed )?(?:under )?(?:the )?gplv3(?: licen[sc]e)?
gpl-3|gpl|3|(?:the )?gpl(?: v| version) ?3(?: 0)?(?: licen[sc]e)?
gpl-3|gnu|4|(?:the )?gnu general public licen[sc]e(?: as published by the free software foundation)?(?: either)?(?: v| version) 3(?: 0)?
gpl-3|gnu|4|version 3 of the gnu general public licen[sc]e
gpl-3|gnu|3|(?:the )?gnu gpl v3
gpl-3|gpl|5|spdx license identifier gpl 3 0(?: only| or later)?
gpl-3|3|5|either version 3 of the license or at your option any later version
gpl|redistribute|4|free software you can redistribute it and or modify it under the terms of the gnu general public license
gpl|gnu|3|you should have received a copy of the gnu general public license
lgpl|lgpl|2|(?:the )?(?:gnu )?lgpl(?: licen[sc]e)?
lgpl|lesser|3|(?:the )?gnu lesser general public licen[sc]e
lgpl|gnu|3|(?:the )?gnu library general public licen[sc]e
lgpl-2.1|lgplv2|3|(?:the )?lgplv2(?: 1)?(?: licen[sc]e)?
lgpl-2.1|lgpl|3|(?:the )?lgpl(?: v| version) ?2 1(?: licen[sc]e)?
lgpl-2.1|lesser|4|(?:the )?gnu lesser general public licen[sc]e(?: v| version) 2 1
lgpl-2.1|lgpl|5|spdx license identifier lgpl 2 1(?: only| or later)?
lgpl-3|lgplv3|3|(?:the )?lgplv3(?: licen[sc]e)?
lgpl-3|lgpl|3|(?:the )?lgpl(?: v| version) ?3(?: licen[sc]e)?
lgpl-3|lesser|4|(?:the )?gnu lesser general public licen[sc]e(?: v| version) 3
lgpl-3|lgpl|5|spdx license identifier lgpl 3 0(?: only| or later)?
agpl-3|agpl|2|(?:the )?(?:gnu )?agpl(?: licen[sc]e)?
agpl-3|agplv3|3|(?:the )?agplv3(?: licen[sc]e)?
agpl-3|agpl|3|(?:the )?agpl(?: v| version) ?3(?: licen[sc]e)?
agpl-3|affero|4|(?:the )?gnu affero general public licen[sc]e(?: v| version)?(?: 3)?
agpl-3|agpl|5|spdx license identifier agpl 3 0(?: only| or later)?
mpl|mozilla|2|(?:the )?mozilla public licen[sc]e
mpl-1.1|mozilla|3|(?:the )?mozilla public licen[sc]e(?: v| version)? 1 1
mpl-1.1|mpl|3|mpl(?: v| version)? 1 1
mpl-2|mozilla|3|(?:the )?mozilla public licen[sc]e(?: v| version)? 2(?: 0)?
mpl-2|mpl|3|mpl(?: v| version)? 2(?: 0)?
mpl-2|mpl|3|mpl v2(?: 0)?
mpl-2|mpl|5|spdx license identifier mpl 2 0
mpl-2|mozilla|5|this source code form is subject to the terms of the mozilla public license v 2 0
epl|eclipse|2|(?:the )?eclipse public licen[sc]e
epl-1|eclipse|3|(?:the )?eclipse public licen[sc]e(?: v| version)? 1(?: 0)?
epl-1|epl|5|spdx license identifier epl 1 0
epl-2|eclipse|3|(?:the )?eclipse public licen[sc]e(?: v| version)? 2(?: 0)?
epl-2|epl|5|spdx license identifier epl 2 0
edl-1|eclipse|3|(?:the )?eclipse distribution licen[sc]e(?: v| version)?(?: 1)?(?: 0)?
cddl-1|cddl|2|(?:the )?cddl(?: licen[sc]e)?(?: v| version)?(?: 1)?(?: 0)?
cddl-1|distribution|3|(?:the )?common development and distribution licen[sc]e
cddl-1|cddl|5|spdx license identifier cddl 1 0
cpl-1|common|2|(?:the )?common public licen[sc]e(?: version 1 0)?
isc|isc|2|(?:the )?isc licen[sc]e
isc|isc|3|under (?:the )?isc licen[sc]e
isc|isc|5|spdx license identifier isc
isc|permission|5|permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted
zlib|zlib|2|(?:the )?zlib licen[sc]e
zlib|zlib|2|(?:the )?zlib libpng licen[sc]e
zlib|zlib|5|spdx license identifier zlib
zlib|misrepresented|6|the origin of this software must not be misrepresented
libpng|libpng|2|(?:the )?libpng licen[sc]e
bsl-1|boost|3|(?:the )?boost software licen[sc]e(?: version)?(?: 1)?(?: 0)?
bsl-1|bsl|5|spdx license identifier bsl 1 0
busl-1.1|business|3|(?:the )?business source licen[sc]e(?: 1 1)?
busl-1.1|busl|5|spdx license identifier busl 1 1
unlicense|unlicense|3|(?:the )?unlicense
unlicense|unlicense|5|spdx license identifier unlicense
unlicense|unencumbered|6|free and unencumbered software released into the public domain
wtfpl|wtfpl|3|(?:the )?wtfpl
wtfpl|fuck|4|do what the fuck you want to public license
cc0-1|cc0|3|(?:the )?cc0(?: 1 0)?(?: licen[sc]e| universal)?
cc0-1|zero|3|creative commons zero(?: v1| 1 0)?
cc0-1|cc0|5|spdx license identifier cc0 1 0
cc-by|cc|2|cc by(?: [0-9]+)?(?: 0)?(?: licen[sc]e)?
cc-by|attribution|3|(?:the )?creative commons attribution(?: [0-9]+ 0)?(?: international)?(?: licen[sc]e)?
cc-by|cc|5|spdx license identifier cc by [0-9]+ 0
cc-by-sa|cc|3|cc by sa(?: [0-9]+)?(?: 0)?
cc-by-sa|attribution|4|(?:the )?creative commons attribution share ?alike(?: [0-9]+ 0)?(?: international)?(?: licen[sc]e)?
cc-by-sa|cc|5|spdx license identifier cc by sa [0-9]+ 0
cc-by-nc|cc|3|cc by nc(?: [0-9]+)?(?: 0)?
cc-by-nc|attribution|4|(?:the )?creative commons attribution non ?commercial(?: [0-9]+ 0)?(?: international)?(?: licen[sc]e)?
cc-by-nc|cc|5|spdx license identifier cc by nc [0-9]+ 0
cc-by-nd|cc|3|cc by nd(?: [0-9]+)?(?: 0)?
cc-by-nd|attribution|4|(?:the )?creative commons attribution no ?deriv(?:ative)?s(?: [0-9]+ 0)?
cc-by-nd|cc|5|spdx license identifier cc by nd [0-9]+ 0
cc-by-nc-sa|cc|4|cc by nc sa(?: [0-9]+)?(?: 0)?
cc-by-nc-sa|attribution|5|(?:the )?creative commons attribution non ?commercial share ?alike(?: [0-9]+ 0)?
cc-by-nc-sa|cc|5|spdx license identifier cc by nc sa [0-9]+ 0
cc-by-nc-nd|cc|4|cc by nc nd(?: [0-9]+)?(?: 0)?
cc-by-nc-nd|attribution|5|(?:the )?creative commons attribution non ?commercial no ?deriv(?:ative)?s(?: [0-9]+ 0)?
creative-commons|creativecommons|2|creativecommons org licenses(?: [a-z]+)?
creative-commons|commons|1|(?:a |the )?creative commons licen[sc]e
artistic-1|artistic|3|(?:the )?artistic licen[sc]e 1 0
artistic-2|artistic|3|(?:the )?artistic licen[sc]e(?: v| version)? 2(?: 0)?
artistic-2|artistic|5|spdx license identifier artistic 2 0
artistic|artistic|1|(?:the )?(?:perl )?artistic licen[sc]e
perl|perl|3|under the same terms as perl itself
ofl-1.1|ofl|3|(?:the )?(?:sil )?ofl(?: 1 1)?
ofl-1.1|font|3|(?:the )?(?:sil )?open font licen[sc]e(?: version)?(?: 1 1)?
ofl-1.1|ofl|5|spdx license identifier ofl 1 1
postgresql|postgresql|2|(?:the )?postgresql licen[sc]e
postgresql|postgresql|5|spdx license identifier postgresql
python-2|psf|2|(?:the )?psf licen[sc]e
python-2|python|3|(?:the )?python software foundation licen[sc]e(?: version 2)?
python-2|python|5|spdx license identifier python 2 0
ruby|ruby|2|(?:the )?ruby licen[sc]e
php-3|php|2|(?:the )?php licen[sc]e(?: version)?(?: 3)?(?: 0| 01)?
php-3|php|5|spdx license identifier php 3 0
ms-pl|microsoft|3|(?:the )?microsoft public licen[sc]e
ms-pl|ms|2|ms pl
ms-pl|ms|5|spdx license identifier ms pl
ms-rl|microsoft|3|(?:the )?microsoft reciprocal licen[sc]e
ms-rl|ms|5|spdx license identifier ms rl
upl-1|permissive|3|(?:the )?universal permissive licen[sc]e(?: v| version)?(?: 1)?(?: 0)?
upl-1|upl|5|spdx license identifier upl 1 0
eupl-1.2|eupl|3|(?:the )?eupl(?: v| version)?(?: 1)?(?: 2)?
eupl-1.2|european|3|(?:the )?european union public licen[sc]e
osl-3|open|3|(?:the )?open software licen[sc]e(?: v| version)?(?: 3)?(?: 0)?
osl-3|osl|5|spdx license identifier osl 3 0
afl-3|academic|3|(?:the )?academic free licen[sc]e(?: v| version)?(?: 3)?(?: 0)?
ncsa|ncsa|3|(?:the )?(?:university of illinois )?ncsa(?: open source)? licen[sc]e
ncsa|ncsa|5|spdx license identifier ncsa
openssl|openssl|3|(?:the )?openssl licen[sc]e
openssl|openssl|5|spdx license identifier openssl
openssl|openssl|4|this product includes software developed by the openssl project
curl|curl|2|(?:the )?curl licen[sc]e
ijg|jpeg|3|(?:the )?independent jpeg group licen[sc]e
ijg|jpeg|4|this software is based in part on the work of the independent jpeg group
freetype|freetype|3|(?:the )?freetype(?: project)? licen[sc]e
imagemagick|imagemagick|3|(?:the )?imagemagick licen[sc]e
vim|vim|2|(?:the )?vim licen[sc]e
w3c|w3c|3|(?:the )?w3c(?: software)?(?: notice and)? licen[sc]e
unicode|unicode|3|(?:the )?unicode(?: inc)? licen[sc]e(?: agreement)?
json|json|2|(?:the )?json licen[sc]e
json|evil|6|the software shall be used for good not evil
beerware|beerware|3|(?:the )?beerware licen[sc]e
beerware|beer|3|(?:the )?beer ware licen[sc]e
fair|fair|2|(?:the )?fair licen[sc]e
ecl-2|educational|3|(?:the )?educational community licen[sc]e(?: version)?(?: 2)?(?: 0)?
gfdl|gfdl|2|(?:the )?(?:gnu )?gfdl(?: 1 [0-9])?
gfdl|gnu|3|(?:the )?gnu free documentation licen[sc]e(?: version)?(?: 1 [0-9])?
odbl-1|odbl|3|(?:the )?odbl(?: 1 0)?
odbl-1|database|3|(?:the )?open database licen[sc]e
odc-by|attribution|3|(?:the )?open data commons attribution licen[sc]e
pddl|dedication|3|(?:the )?public domain dedication and licen[sc]e
openrail|openrail|3|(?:the )?(?:creativeml )?openrail(?: m)?(?: licen[sc]e)?
openrail|bigscience|3|(?:the )?bigscience(?: bloom)? rail(?: 1 0)?(?: licen[sc]e)?
sspl-1|server|3|(?:the )?server side public licen[sc]e
sspl-1|sspl|3|(?:the )?sspl(?: v1| 1 0)?
elastic-2|elastic|3|(?:the )?elastic licen[sc]e(?: v| version)?(?: 2)?(?: 0)?
commons-clause|clause|4|(?:the )?commons clause(?: licen[sc]e)?(?: condition)?
polyform|polyform|3|(?:the )?polyform [a-z]+ licen[sc]e
public-domain|domain|4|(?:released|dedicated|placed|donated) (?:in|into|to) the public domain
public-domain|domain|2|(?:is |are )?in the public domain
public-domain|dedication|3|public domain dedication
proprietary|reserved|3|all rights reserved
proprietary|proprietary|3|proprietary and confidential
proprietary|unauthorized|5|unauthorized copying of this file via any medium is strictly prohibited
proprietary|eula|2|(?:the )?end user licen[sc]e agreement eula
proprietary|redistribute|3|you may not copy modify or redistribute
freeware|freeware|2|(?:is |this )?freeware
shareware|shareware|2|(?:is |this )?shareware
research-only|academic|3|for (?:academic|research and academic) use only
non-commercial|commercial|3|for non commercial(?: research)? use only
non-commercial|noncommercial|3|noncommercial use only
copyright|copyright|3|copyright(?: c)? (?:19|20)[0-9][0-9](?: (?:19|20)[0-9][0-9])?
copyright|copyright|2|(?:the )?copyright holders?
copyright|copyrighted|2|this (?:work|software|file) is copyrighted
"""
#: Confidence of a detection by its priority.
WEIGHTS = {1: 0.6, 2: 0.7, 3: 0.85, 4: 0.9, 5: 1.0, 6: 0.95}


def signatures() -> list[Signature]:
    rows = [line.split("|", 3) for line in SIGNATURES.strip().splitlines()]
    return [Signature(label, keyword, regex, int(priority), WEIGHTS[int(priority)]) for label, keyword, priority, regex in rows]


def normalized(text: Column) -> Column:
    """`` w w w ``: lower-cased words with one blank before and after each; `` `` alone for no words.

    Lower-casing letters beyond A-Z as well moves no word boundary and makes no a-z of the phrases, and is much faster."""
    return F.regexp_replace(F.concat(F.lit(" "), F.lower(F.coalesce(text, F.lit(""))), F.lit(" ")), GAP, " ")


def _spans(norm: Column, regex) -> Column:
    """array<struct<start, end>> in words of the matches of a regex of whole words, leftmost first."""
    regex = F.concat(F.lit("(?<= )(?:"), regex, F.lit(")(?= )"))
    count = lambda s: (F.length(s) - F.length(F.replace(s, F.lit(" "), F.lit("")))).cast("long")
    pairs = F.arrays_zip(F.split(norm, regex).alias("gap"), F.regexp_extract_all(norm, regex, F.lit(0)).alias("hit"))
    none = F.array().cast("array<struct<start:bigint,end:bigint>>")
    return F.aggregate(
        F.filter(pairs, lambda p: p["hit"].isNotNull()),
        F.struct(F.lit(-1).cast("long").alias("at"), none.alias("spans")),
        lambda acc, p: F.struct(
            (acc["at"] + count(p["gap"]) + count(p["hit"])).alias("at"),
            F.array_append(acc["spans"], F.struct((acc["at"] + count(p["gap"])).alias("start"), (acc["at"] + count(p["gap"]) + count(p["hit"]) + 1).alias("end"))).alias("spans"),
        ),
        lambda acc: acc["spans"],
    )


DETECTION = "struct<start:bigint,last:bigint,rank:int,label:string,weight:double>"


def detections(norm: Column, held: Column, rules: list[Signature]) -> Column:
    """array of detections that no detection of higher or equal priority contains; start and end in words. ``held``: the
    keywords that the text holds.

    Sorted by start, then by falling end and priority, a container stands before what it contains, so one pass with the
    furthest end of each priority settles containment.
    """
    by: dict[str, list[Signature]] = {}
    for r in rules:
        by.setdefault(r.keyword, []).append(r)

    def row(r: Signature) -> Column:
        return F.struct(F.lit(r.regex).alias("regex"), F.lit(r.priority).alias("priority"), F.lit(r.label).alias("label"), F.lit(r.weight).alias("weight"))

    table = F.create_map(*[x for kw, rs in by.items() for x in (F.lit(kw), F.array(*map(row, rs)))])
    chosen = F.flatten(F.transform(held, lambda kw: table[kw]))
    found = F.flatten(F.transform(chosen, lambda r: F.transform(_spans(norm, r["regex"]), lambda s: F.struct(s["start"].alias("start"), (-s["end"]).alias("last"), (-r["priority"]).alias("rank"), r["label"].alias("label"), r["weight"].alias("weight")))))
    levels = max(r.priority for r in rules)
    zero = F.struct(*[F.lit(-1).cast("long").alias(f"e{k}") for k in range(1, levels + 1)], F.array().cast(f"array<{DETECTION}>").alias("kept"))

    def step(acc, d):
        end, level = -d["last"], -d["rank"]
        inside = F.lit(False)
        for k in range(1, levels + 1):
            inside = inside | ((level <= k) & (acc[f"e{k}"] >= end))
        ends = [F.when(level == k, F.greatest(acc[f"e{k}"], end)).otherwise(acc[f"e{k}"]).alias(f"e{k}") for k in range(1, levels + 1)]
        return F.struct(*ends, F.when(inside, acc["kept"]).otherwise(F.array_append(acc["kept"], d)).alias("kept"))

    return F.aggregate(F.array_sort(F.array_distinct(found)), zero, step, lambda acc: acc["kept"])


def scan_licenses(docs: DataFrame, rules: list[Signature] | None = None, base: dict[str, str] = BASE) -> DataFrame:
    """doc_id, n_words, base (array of start and label of every base place), found (array of detections) for each row.

    A null or empty text has no words and no places; ties of equal detections go by label; repeated rows and null ids
    stay; other columns are ignored; no rows give no rows. Texts without a keyword run no signature. A very long text is one
    string of one task, read as a whole.
    """
    rules = signatures() if rules is None else rules
    df = docs.select("doc_id", normalized(F.col("text")).alias("norm"))
    any_base = F.lit(False)
    for phrase in base:
        any_base = any_base | F.contains("norm", F.lit(f" {phrase} "))
    phrase = F.lit("|".join(base))
    labels = F.create_map(*[F.lit(x) for kv in base.items() for x in kv])
    hits = F.regexp_extract_all("norm", F.concat(F.lit("(?<= )(?:"), phrase, F.lit(")(?= )")), F.lit(0))
    places = F.when(any_base, F.transform(F.arrays_zip(_spans(F.col("norm"), phrase).alias("s"), hits.alias("h")), lambda x: F.struct(x["s"]["start"].alias("start"), labels[x["h"]].alias("label"))))
    held = F.array_intersect(F.split("norm", " "), F.array(*[F.lit(k) for k in sorted({r.keyword for r in rules})]))
    df = df.withColumn("held", held)
    none = F.array()
    return df.select(
        "doc_id",
        F.greatest(F.length("norm") - F.length(F.replace("norm", F.lit(" "), F.lit(""))) - 1, F.lit(0)).cast("long").alias("n_words"),
        F.coalesce(places, none.cast("array<struct<start:bigint,label:string>>")).alias("base"),
        F.coalesce(F.when(F.size("held") > 0, detections(F.col("norm"), F.col("held"), rules)), none.cast(f"array<{DETECTION}>")).alias("found"),
    )


def op7(spark, sf_dir: str) -> DataFrame:
    df = scan_licenses(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))
    base = F.array_sort(F.array_distinct("base.label"))
    every = F.array_sort(F.array_distinct(F.concat("base.label", "found.label")))
    score = F.greatest(F.when(F.size("base") > 0, 1.0).otherwise(0.0), F.coalesce(F.array_max("found.weight"), F.lit(0.0)))
    return df.select("doc_id", "n_words", F.size("base").cast("long").alias("n_base"), F.array_min("base.start").alias("first_word"), F.array_max("base.start").alias("last_word"), F.array_join(base, ",").alias("base_labels"), F.array_join(every, ",").alias("labels"), score.alias("score"))
