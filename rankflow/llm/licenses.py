"""License scans (operator 8): ordered signature rules over normalised words.

A text is reduced to its lower-case words with single blanks between them.  Rules
are regular expressions on that form.  Each license has its own tier-1 rules (notice
sentences and addresses, written out below) and, by the templates, tier-2 rules (its
name as a grant) and tier-3 rules (its name as a mention).  A license's rules run only
on texts that hold its keyword.  Detections are intervals of the normalised text.
An interval inside another of the same or a stronger tier is dropped; the rest say
which licenses the text names.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rankflow.llm.common import ascii_lower

# Fixed values of the base scan: phrase, label.
BASE_PHRASES = (("the mit license", "mit"), ("apache license version 2", "apache-2"), ("cc by nc", "cc-by-nc"))

#: label | keyword | names (regex alternatives over normalised words) | notices (regex alternatives); - for none.
#: The keyword is a literal part of every name and notice of its line.
LICENSES = """
mit | mit | mit license, mit licence | opensource org licenses mit, spdx license identifier mit
mit | expat | expat license | -
mit | permission is hereby | - | permission is hereby granted free of charge to any person obtaining a copy
apache-2 | apache | apache license version 2( 0)?, apache license 2 0, apache 2( 0)? license | apache org licenses license 2 0, spdx license identifier apache 2 0
apache-2 | asl 2 | asl 2 0 | -
apache-2 | unless required by | - | unless required by applicable law or agreed to in writing software
apache-1.1 | apache | apache (software )?license version 1 1, apache license 1 1 | spdx license identifier apache 1 1, this product includes software developed by the apache software foundation
cc-by-nc | cc | cc by nc | spdx license identifier cc by nc
cc-by-nc | creative | creative commons attribution non ?commercial | creativecommons org licenses by nc( [0-9])?
cc-by-nc-sa | cc | cc by nc sa | spdx license identifier cc by nc sa
cc-by-nc-sa | creative | creative commons attribution non ?commercial share ?alike | creativecommons org licenses by nc sa
cc-by-nc-nd | cc | cc by nc nd | spdx license identifier cc by nc nd
cc-by-nc-nd | creative | creative commons attribution non ?commercial no ?deriv[a-z]* | creativecommons org licenses by nc nd
cc-by-nd | cc | cc by nd | spdx license identifier cc by nd
cc-by-nd | creative | creative commons attribution no ?deriv[a-z]* | creativecommons org licenses by nd
cc-by-sa | cc | cc by sa | spdx license identifier cc by sa
cc-by-sa | creative | creative commons attribution share ?alike | creativecommons org licenses by sa
cc-by | cc | cc by( [0-9] [0-9])? | spdx license identifier cc by
cc-by | creative | creative commons attribution( [0-9] [0-9])? | creativecommons org licenses by [0-9]
cc0 | cc0 | cc0( 1 0)? | spdx license identifier cc0
cc0 | cc zero | cc zero | -
cc0 | creative commons zero | creative commons zero | -
cc0 | publicdomain | - | creativecommons org publicdomain zero
gpl-2 | gpl | gpl ?v?2( 0)?, gpl version 2 | spdx license identifier gpl 2 0( only| or later)?, gnu org licenses gpl 2 0
gpl-3 | gpl | gpl ?v?3( 0)?, gpl version 3 | spdx license identifier gpl 3 0( only| or later)?, gnu org licenses gpl 3 0
gpl-2 | general public | gnu general public license version 2, gnu general public license v2 | -
gpl-2 | free software foundation | - | published by the free software foundation (either )?version 2 of the license
gpl-3 | general public | gnu general public license version 3, gnu general public license v3 | -
gpl-3 | free software foundation | - | published by the free software foundation (either )?version 3 of the license
gpl | general public | gnu general public license, general public license | this program is free software you can redistribute it and or modify it under the terms of the gnu general public license
lgpl-2.1 | lgpl | lgpl ?v?2 1, lgpl version 2 1 | spdx license identifier lgpl 2 1( only| or later)?
lgpl-3 | lgpl | lgpl ?v?3( 0)?, lgpl version 3 | spdx license identifier lgpl 3 0( only| or later)?
lgpl | lesser | gnu lesser general public license, lesser general public license | under the terms of the gnu lesser general public license
agpl-3 | affero | gnu affero general public license( version 3)?, affero gpl | under the terms of the gnu affero general public license
agpl-3 | agpl | agpl ?v?3( 0)?, agpl version 3 | spdx license identifier agpl 3 0( only| or later)?
gfdl | free documentation | gnu free documentation license | permission is granted to copy distribute and or modify this document under the terms of the gnu free documentation license
bsd-2-clause | bsd | bsd 2 clause, 2 clause bsd, simplified bsd, freebsd license | spdx license identifier bsd 2 clause, opensource org licenses bsd 2 clause
bsd-3-clause | bsd | bsd 3 clause, 3 clause bsd, new bsd, modified bsd | spdx license identifier bsd 3 clause, opensource org licenses bsd 3 clause
bsd-4-clause | bsd | bsd 4 clause, 4 clause bsd, original bsd | spdx license identifier bsd 4 clause
bsd | bsd | bsd license, bsd style license | opensource org licenses bsd license
bsd | berkeley | berkeley license | -
bsd | redistribution | redistribution and use in source and binary forms | redistribution and use in source and binary forms with or without modification are permitted
0bsd | 0bsd | 0bsd | spdx license identifier 0bsd
0bsd | zero clause | zero clause bsd | -
isc | isc | isc license, isc licence | opensource org licenses isc, spdx license identifier isc
isc | permission to use | permission to use copy modify and or distribute this software | permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted
mpl-1.1 | mozilla | mozilla public license version 1 1, mozilla public license 1 1 | mozilla org mpl mpl 1 1
mpl-2 | mozilla | mozilla public license( version)? 2( 0)?, mozilla public license v 2 0 | mozilla org mpl 2 0, subject to the terms of the mozilla public license v 2 0
mpl-2 | mpl | mpl ?v?2( 0)? | spdx license identifier mpl 2 0
epl-1 | eclipse | eclipse public license( version| v)? 1( 0)? | eclipse org legal epl v10
epl-2 | eclipse | eclipse public license( version| v)? 2( 0)? | eclipse org legal epl (v20|2 0)
epl | epl | epl ?v?[12]( 0)? | spdx license identifier epl [12] 0
edl-1 | eclipse | eclipse distribution license( version| v)?( 1 0)? | eclipse org org documents edl v10
eupl-1.2 | eupl | eupl( v| version)?( 1 [12])? | spdx license identifier eupl 1 [12], licensed under the eupl version 1 [12]
eupl-1.2 | european union | european union public licen[cs]e | -
cddl-1 | cddl | cddl( 1 [01])? | spdx license identifier cddl 1 [01]
cddl-1 | common development | common development and distribution license | subject to the terms of the common development and distribution license
cpl-1 | common public | common public license( version)?( 1 0)? | -
cpl-1 | ibm com | - | ibm com developerworks library os cpl
ms-pl | microsoft | microsoft public license | -
ms-pl | ms pl | - | opensource org licenses ms pl
ms-rl | microsoft | microsoft reciprocal license | -
ms-rl | ms rl | - | opensource org licenses ms rl
artistic-2 | artistic | artistic license( version)? 2( 0)? | perlfoundation org artistic license 2 0
artistic-1 | artistic | artistic license( version)?( 1 0)? | opensource org licenses artistic license
unlicense | unlicense | the unlicense, unlicense | unlicense org, spdx license identifier unlicense
unlicense | unencumbered | free and unencumbered software | this is free and unencumbered software released into the public domain
public-domain | public domain | public domain | released into the public domain, dedicated to the public domain
wtfpl | wtfpl | wtfpl( version 2)? | spdx license identifier wtfpl
zlib | zlib | zlib license, zlib libpng license | spdx license identifier zlib
zlib | as is without | provided as is without any express or implied warranty | this software is provided as is without any express or implied warranty in no event will the authors be held liable
bsl-1 | boost | boost software license( version)?( 1 0)? | boost org license 1 0, distributed under the boost software license
busl-1.1 | business source | business source license( 1 1)? | -
busl-1.1 | mariadb | - | mariadb com bsl11
sspl-1 | server side | server side public license( version)?( 1)? | mongodb com licensing server side public license
elastic-2 | elastic | elastic license( version)?( 2 0)? | elastic co licensing elastic license
ofl-1.1 | open font | sil open font license( version)?( 1 1)?, open font license | -
ofl-1.1 | ofl | ofl 1 1, sil ofl | spdx license identifier ofl 1 1, scripts sil org ofl
psf-2 | python | python software foundation license( version)?( 2)? | docs python org license
psf-2 | psf | psf license | -
php-3 | php | php license( version)?( 3 0[01]?)? | php net license
postgresql | postgresql | postgresql licen[cs]e | opensource org licenses postgresql
openssl | openssl | openssl license | this product includes software developed by the openssl project
odbl-1 | open database | open database license( v| version)?( 1 0)? | made available under the open database license
odbl-1 | odbl | odbl( v?1 0)? | opendatacommons org licenses odbl
pddl-1 | public domain dedication | public domain dedication and license | -
pddl-1 | pddl | - | opendatacommons org licenses pddl
openrail | rail | openrail m?, open rail, bigscience (open )?rail license | -
openrail | use based | - | use based restrictions as referenced in
llama | llama | llama [0-9] community license( agreement)? | llama meta com license
all-rights-reserved | rights reserved | all rights reserved | -
all-rights-reserved | may be reproduced | - | no part of this [a-z]+ may be reproduced
proprietary | proprietary | proprietary license, proprietary and confidential | -
proprietary | unauthorized copying | - | unauthorized copying of this file via any medium is strictly prohibited
"""
#: Templates over a license's names: tier, weight, pattern.
TEMPLATES = (
    (2, 0.95, "(licensed|released|distributed|available|published|provided) under (the )?(terms of )?(the )?({name})"),
    (2, 0.9, "(the )?({name}) (license|licence) (agreement|file|text|terms|applies)"),
    (2, 0.9, "license (is )?({name})"),
    (3, 0.6, "({name})"),
)


def rules() -> list[dict]:
    """All rules in their order: order, label, keyword, tier, weight, pattern."""
    out = []
    for line in LICENSES.strip().splitlines():
        label, keyword, names, notices = (x.strip() for x in line.split(" | ", 3))
        name = "|".join(n.strip() for n in names.split(","))
        found = [(1, 0.99, n.strip()) for n in notices.split(",") if notices != "-"]
        found += [(tier, weight, t.replace("{name}", name)) for tier, weight, t in TEMPLATES if names != "-"]
        out += [{"label": label, "keyword": keyword, "tier": t, "weight": w, "pattern": f" ({p})(?= )"} for t, w, p in found]
    return [{"order": k, **r} for k, r in enumerate(sorted(out, key=lambda r: r["tier"]))]


def normalised(text: Column | str) -> Column:
    """Lower-case words ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` with one blank before, between and after."""
    text = F.col(text) if isinstance(text, str) else text
    words = F.regexp_replace(ascii_lower(text), "[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+", " ")
    inner = F.btrim(words, F.lit(" "))
    return F.when(inner == "", F.lit(" ")).otherwise(F.concat(F.lit(" "), inner, F.lit(" ")))


def _n_words(padded: Column) -> Column:
    """Words of a text of words each with one blank after it, and one blank in front."""
    return F.length(padded) - F.length(F.replace(padded, F.lit(" "), F.lit(""))) - 1


_FAMILIES = ("array<struct<keyword:string,rules:array<struct<"
             "order:int,label:string,tier:int,weight:double,pattern:string>>>>")


def scan_licenses(docs: DataFrame, rule_set: list[dict] | None = None) -> DataFrame:
    """All columns of ``docs`` with the scan's result.

    Added: n_words; base_counts (places of each base phrase, in order); first_word and
    last_word (least and greatest word index at which a base phrase starts, null without
    one); base_labels; labels (base and rule labels); score (greatest weight among the
    surviving detections, 1 with a base phrase, 0 without any); detections (array of
    label, tier, start and end in characters of the normalised text).  Labels are
    distinct, sorted, comma-joined.  A null or empty text has no words and no labels.
    Columns of these names in ``docs`` are replaced.
    """
    rule_set = rules() if rule_set is None else rule_set
    made = ("_norm", "n_words", "base_counts", "first_word", "last_word", "base_labels", "labels", "score", "detections")
    df = docs.drop(*made).withColumn("_norm", normalised(F.coalesce(F.col("text"), F.lit(""))))
    norm = F.col("_norm")
    df = df.withColumn("n_words", _n_words(norm).cast("long"))
    # A place of a phrase is " phrase " with the blank behind it left for the next place.
    counts = [F.when(F.contains(norm, F.lit(f" {p} ")), F.size(F.split(norm, f" {p}(?= )")) - 1).otherwise(0) for p, _ in BASE_PHRASES]
    df = df.withColumn("base_counts", F.array(*[c.cast("long") for c in counts]))
    hit = [F.col("base_counts")[k] > 0 for k in range(len(BASE_PHRASES))]
    first, last = [], []
    for k, (p, _) in enumerate(BASE_PHRASES):
        before = F.concat(F.substring_index(norm, f" {p} ", 1), F.lit(" "))
        behind = F.concat(F.lit(" "), F.substring_index(norm, f" {p} ", -1))
        first.append(F.when(hit[k], _n_words(before)))
        last.append(F.when(hit[k], F.col("n_words") - _n_words(behind) - len(p.split())))
    df = df.withColumns({"first_word": F.least(*first).cast("long"), "last_word": F.greatest(*last).cast("long")})
    base = F.array_compact(F.array(*[F.when(h, F.lit(label)) for h, (_, label) in zip(hit, BASE_PHRASES)]))
    df = df.withColumn("_base", base)

    families: dict[str, list[dict]] = {}
    for r in rule_set:
        families.setdefault(r["keyword"], []).append(r)
    literal = json.dumps([{"keyword": k, "rules": v} for k, v in families.items()])
    table = F.from_json(F.lit(literal), _FAMILIES)
    gate = F.lit(False)
    for k in families:
        gate = gate | F.contains(norm, F.lit(k))
    df = df.withColumn("_rules", F.when(gate, F.flatten(F.transform(
        F.filter(table, lambda f: F.contains(norm, f["keyword"])), lambda f: f["rules"]))))
    # Where a rule matches: the texts between its matches and the matches give the offsets.
    df = df.withColumn("_found", F.transform("_rules", lambda r: F.struct(
        r.alias("r"), F.regexp_extract_all(norm, r["pattern"], F.lit(0)).alias("hits"))))
    df = df.withColumn("_found", F.filter("_found", lambda f: F.size(f["hits"]) > 0))
    empty = F.array().cast("array<struct<start:int,stop:int>>")
    df = df.withColumn("_found", F.transform("_found", lambda f: F.struct(f["r"].alias("r"), F.aggregate(
        F.arrays_zip(F.slice(F.split(norm, f["r"]["pattern"]), 1, F.size(f["hits"])).alias("gap"), f["hits"].alias("hit")),
        F.struct(F.lit(0).alias("at"), empty.alias("spans")),
        lambda a, x: F.struct(
            (a["at"] + F.length(x["gap"]) + F.length(x["hit"])).alias("at"),
            F.array_append(a["spans"], F.struct((a["at"] + F.length(x["gap"])).alias("start"), (
                a["at"] + F.length(x["gap"]) + F.length(x["hit"])).alias("stop"))).alias("spans")),
        lambda a: a["spans"]).alias("spans"))))
    # By start, the longer first, then tier and order: whatever holds an interval stands before it.
    df = df.withColumn("_all", F.sort_array(F.flatten(F.transform("_found", lambda f: F.transform(f["spans"], lambda s: F.struct(
        s["start"].alias("start"), (-s["stop"]).alias("minus_stop"), f["r"]["tier"].alias("tier"), f["r"]["order"].alias("order"),
        f["r"]["label"].alias("label"), f["r"]["weight"].alias("weight")))))))
    d = F.col("_all")
    reach = F.aggregate(d, F.struct(F.lit(0).alias("t1"), F.lit(0).alias("t2"), F.lit(0).alias("t3"),
                                    F.array().cast("array<boolean>").alias("keep")), _sweep, lambda a: a["keep"])
    df = df.withColumn("_keep", reach)
    df = df.withColumn("detections", F.coalesce(F.transform(
        F.filter(F.arrays_zip(d.alias("d"), F.col("_keep").alias("k")), lambda x: x["k"]),
        lambda x: F.struct(x["d"]["label"].alias("label"), x["d"]["tier"].alias("tier"), x["d"]["start"].alias("start"),
                           (-x["d"]["minus_stop"]).alias("stop"), x["d"]["weight"].alias("weight"))),
        F.array().cast("array<struct<label:string,tier:int,start:int,stop:int,weight:double>>")))
    named = F.array_sort(F.array_distinct(F.concat("_base", F.transform("detections", lambda x: x["label"]))))
    weight = F.coalesce(F.array_max(F.transform("detections", lambda x: x["weight"])), F.lit(0.0))
    return df.withColumns({
        "base_labels": F.array_join(F.array_sort("_base"), ","), "labels": F.array_join(named, ","),
        "score": F.when(F.size("_base") > 0, F.lit(1.0)).otherwise(weight),
    }).drop("_norm", "_base", "_rules", "_found", "_all", "_keep")


def _sweep(a: Column, x: Column) -> Column:
    """Furthest stop so far by tier; an interval is kept unless one of its tier or a stronger reaches its stop."""
    stop = -x["minus_stop"]
    stronger = F.when(x["tier"] == 1, a["t1"]).when(x["tier"] == 2, F.greatest(a["t1"], a["t2"])).otherwise(
        F.greatest(a["t1"], a["t2"], a["t3"]))
    far = lambda k: F.when(x["tier"] == k, F.greatest(a[f"t{k}"], stop)).otherwise(a[f"t{k}"])
    return F.struct(far(1).alias("t1"), far(2).alias("t2"), far(3).alias("t3"), F.array_append(a["keep"], stronger < stop).alias("keep"))
