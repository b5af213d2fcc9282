"""License scan by ordered signature rules (operator 10).

A text becomes its words, lower-cased and joined by single spaces; rules are regular expressions
over whole words. A rule runs only on texts that contain its keyword, and all of them only on texts
that contain a gate word; the gate is made from the rules, each of which names words that all its
matches have. A detection is an interval of words; it is suppressed if another one
contains it, where equal intervals go to the rule of higher priority. Detections are found, sorted
and folded inside a document's row, in time proportional to their number; nothing is shuffled.
DataFrame functions only.

Special cases: a null or empty text has no words and no labels; repeated rows are returned as often
as they occur; overlapping detections of which none contains another are all kept.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardlens.llm.common import ascii_lower

#: Phrases that always count, and their labels.
BASE = (("mit license", "mit"), ("apache license", "apache"), ("general public license", "gpl"))
NOT_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
LICENSE = ("licens", "licenc")


@dataclass(frozen=True)
class SignatureRule:
    label: str
    keyword: str    # the prefilter: plain text that every match has
    pattern: str    # over words joined by single spaces
    priority: int   # of two equal intervals the higher one stays
    weight: float   # how sure a match is
    gates: tuple[str, ...] = ()  # plain texts of which every match has one; the keyword if there are none


#: label, keyword, pattern of the name.
NAMES = (
    ("mit", "mit", "(?:the )?mit(?: x11| expat)?"),
    ("apache", "apache", "(?:the )?apache(?: software)?"),
    ("apache-1.1", "apache", "(?:the )?apache(?: software)? license(?: version)? 1 1"),
    ("apache-2.0", "apache", "(?:the )?apache(?: software)? license(?: version)? 2(?: 0)?"),
    ("gpl", "general public", "(?:the )?(?:gnu )?general public"),
    ("gpl-2.0", "general public", "(?:the )?(?:gnu )?general public license(?: version)? v?2(?: 0)?"),
    ("gpl-3.0", "general public", "(?:the )?(?:gnu )?general public license(?: version)? v?3(?: 0)?"),
    ("lgpl", "lesser general", "(?:the )?(?:gnu )?lesser general public"),
    ("lgpl-2.1", "lesser general", "(?:the )?(?:gnu )?lesser general public license(?: version)? v?2 1"),
    ("lgpl-3.0", "lesser general", "(?:the )?(?:gnu )?lesser general public license(?: version)? v?3(?: 0)?"),
    ("agpl", "affero", "(?:the )?(?:gnu )?affero general public"),
    ("agpl-3.0", "affero", "(?:the )?(?:gnu )?affero general public license(?: version)? v?3(?: 0)?"),
    ("gfdl", "free documentation", "(?:the )?(?:gnu )?free documentation"),
    ("bsd", "bsd", "(?:the )?bsd"),
    ("bsd-2-clause", "bsd", "(?:the )?(?:simplified bsd|bsd 2 clause|2 clause bsd)"),
    ("bsd-3-clause", "bsd", "(?:the )?(?:new bsd|modified bsd|revised bsd|bsd 3 clause|3 clause bsd)"),
    ("bsd-4-clause", "bsd", "(?:the )?(?:original bsd|bsd 4 clause|4 clause bsd)"),
    ("0bsd", "bsd", "(?:the )?(?:zero clause bsd|0bsd|bsd zero clause)"),
    ("isc", "isc", "(?:the )?isc"),
    ("mpl", "mozilla", "(?:the )?mozilla public"),
    ("mpl-2.0", "mozilla", "(?:the )?mozilla public license(?: version)? v?2(?: 0)?"),
    ("epl", "eclipse", "(?:the )?eclipse public"),
    ("epl-2.0", "eclipse", "(?:the )?eclipse public license(?: version)? v?2(?: 0)?"),
    ("cddl", "common development", "(?:the )?common development and distribution"),
    ("cpl", "common public", "(?:the )?common public"),
    ("eupl", "european union", "(?:the )?european union public"),
    ("artistic", "artistic", "(?:the )?(?:perl )?artistic"),
    ("zlib", "zlib", "(?:the )?zlib(?: libpng)?"),
    ("boost", "boost", "(?:the )?boost software"),
    ("python", "python", "(?:the )?python(?: software foundation)?"),
    ("ruby", "ruby", "(?:the )?ruby"),
    ("php", "php", "(?:the )?php"),
    ("openssl", "openssl", "(?:the )?openssl"),
    ("postgresql", "postgresql", "(?:the )?postgresql"),
    ("unlicense", "unlicense", "(?:the )?unlicense"),
    ("wtfpl", "wtfpl", "(?:the )?wtfpl"),
    ("ms-pl", "microsoft", "(?:the )?microsoft public"),
    ("ms-rl", "microsoft", "(?:the )?microsoft reciprocal"),
    ("sil-ofl", "open font", "(?:the )?(?:sil )?open font"),
    ("odbl", "database", "(?:the )?open (?:data commons )?(?:open )?database"),
    ("sspl", "server side", "(?:the )?server side public"),
    ("busl", "business source", "(?:the )?business source"),
    ("elastic", "elastic", "(?:the )?elastic"),
    ("afl", "academic free", "(?:the )?academic free"),
    ("osl", "open software", "(?:the )?open software"),
    ("cecill", "cecill", "(?:the )?cecill"),
    ("vim", "vim", "(?:the )?vim"),
    ("tex", "latex", "(?:the )?latex project public"),
    ("ncsa", "ncsa", "(?:the )?(?:university of illinois )?ncsa(?: open source)?"),
    ("w3c", "w3c", "(?:the )?w3c(?: software)?"),
    ("cc-by", "cc by", "(?:the )?cc by(?: [1-4](?: [05])?)?"),
    ("cc-by-sa", "cc by sa", "(?:the )?cc by sa(?: [1-4](?: [05])?)?"),
    ("cc-by-nc", "cc by nc", "(?:the )?cc by nc(?: [1-4](?: [05])?)?"),
    ("cc-by-nd", "cc by nd", "(?:the )?cc by nd(?: [1-4](?: [05])?)?"),
    ("cc-by-nc-sa", "cc by nc sa", "(?:the )?cc by nc sa(?: [1-4](?: [05])?)?"),
    ("cc-by-nc-nd", "cc by nc nd", "(?:the )?cc by nc nd(?: [1-4](?: [05])?)?"),
    ("cc0", "cc0", "(?:the )?cc0(?: 1 0)?"),
)
#: How a name is used: pattern around it, priority, weight, gates.
USES = (
    ("{name} licen[sc]es?", 20, 0.7, LICENSE),
    ("(?:licensed|released|distributed|published|available|provided|covered) under (?:the terms of )?{name}"
     "(?: licen[sc]e)?", 40, 0.95, ("licens", "released under", "distributed under", "published under",
                                    "available under", "provided under", "covered under")),
    ("licen[sc]e {name}", 30, 0.8, LICENSE),
    ("spdx license identifier {name}", 50, 1.0, LICENSE),
    ("governed by {name}(?: licen[sc]e)?", 35, 0.9, ("governed by",)),
)
#: label, keyword, pattern, priority, weight of texts that state terms without the license's name.
TEXTS = (
    ("mit", "permission is hereby granted", "permission is hereby granted free of charge to any person obtaining a copy", 45, 0.95),
    ("isc", "permission to use", "permission to use copy modify and or distribute this software for any purpose", 45, 0.95),
    ("bsd", "redistribution and use", "redistribution and use in source and binary forms with or without modification", 45, 0.95),
    ("bsd-3-clause", "endorse or promote", "may be used to endorse or promote products derived from", 30, 0.8),
    ("gpl", "free software", "this program is free software you can redistribute it and or modify it", 45, 0.95),
    ("lgpl", "free software", "this library is free software you can redistribute it and or modify it", 45, 0.95),
    ("zlib", "as is", "this software is provided as is without any express or implied warranty", 20, 0.6, ("warrant",)),
    ("unlicense", "unencumbered", "this is free and unencumbered software released into the public domain", 45, 0.95),
    ("public-domain", "public domain", "(?:in|into|to) the public domain", 25, 0.7),
    ("public-domain", "public domain", "dedicated to the public domain", 30, 0.85),
    ("creative-commons", "creative commons", "creative commons(?: attribution)?(?: share ?alike)?(?: non ?commercial)?(?: licen[sc]e)?", 20, 0.7),
    ("cc-by", "creative commons", "creative commons attribution(?: [1-4](?: 0)?)?(?: international)?", 30, 0.85),
    ("cc-by-sa", "creative commons", "creative commons attribution share ?alike(?: [1-4](?: 0)?)?(?: international)?", 40, 0.9),
    ("cc-by-nc", "creative commons", "creative commons attribution non ?commercial(?: [1-4](?: 0)?)?(?: international)?", 40, 0.9),
    ("proprietary", "all rights reserved", "(?:copyright )?(?:c )?all rights reserved", 15, 0.5),
    ("proprietary", "confidential", "proprietary and confidential", 30, 0.8),
    ("proprietary", "permission", "without (?:the )?(?:express |prior )?(?:written )?permission", 15, 0.5),
    ("copyright", "copyright", "copyright(?: c)? (?:19|20)[0-9]{2}", 10, 0.4),
    ("no-warranty", "warrant", "without warrant(?:y|ies)(?: or conditions)? of any kind", 10, 0.3),
    ("copyleft", "copyleft", "copyleft(?: licen[sc]e)?", 15, 0.5),
)


def signature_rules() -> list[SignatureRule]:
    """All rules; order settles what priorities leave open."""
    rules = [SignatureRule(label, keyword, use.format(name=name), priority, weight, gates)
             for label, keyword, name in NAMES for use, priority, weight, gates in USES]
    # Names with a version say enough by themselves.
    rules += [SignatureRule(label, keyword, name, 25, 0.75, LICENSE) for label, keyword, name in NAMES if " license" in name]
    return rules + [SignatureRule(*text) for text in TEXTS]


def gate_words(rules: list[SignatureRule]) -> list[str]:
    """Plain texts of which every text with a match has one; none contains another."""
    words = {phrase for phrase, _ in BASE}.union(*(rule.gates or (rule.keyword,) for rule in rules))
    return sorted(w for w in words if not any(v != w and v in w for v in words))


def _spaces(text: Column) -> Column:
    return F.length(text) - F.length(F.replace(text, F.lit(" "), F.lit("")))


def _starts(words: str, pattern: str) -> str:
    """SQL for the (first word, words) of all matches of a pattern; both ends of ``words`` are spaces.

    Spaces count words: what stands before a match has as many spaces as words before it.
    """
    spaces = "length({0}) - length(replace({0}, ' ', ''))"
    return f"""transform(regexp_extract_all({words}, {pattern}, 0), m -> {spaces.format('m')})""", \
           f"""transform(split({words}, {pattern}), g -> {spaces.format('g')})"""


def scan_licenses(docs: DataFrame, rules: list[SignatureRule] | None = None) -> DataFrame:
    """doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score and n_detections.

    ``score`` is 1 minus the product of (1 - weight) over the labels found, each with its best
    detection.
    """
    rules = signature_rules() if rules is None else rules
    lowered = docs.select("doc_id", F.regexp_replace(
        ascii_lower(F.coalesce("text", F.lit(""))), NOT_WORD, " ").alias("w"))
    lowered = lowered.withColumn("w", F.concat(F.lit(" "), F.trim("w"), F.lit(" ")))
    n_words = F.when(F.col("w") == "  ", 0).otherwise(_spaces(F.col("w")) - 1).cast("long")
    found = lowered.select("doc_id", n_words.alias("n_words"), F.when(
        reduce(or_, [F.contains("w", F.lit(g)) for g in gate_words(rules)]), F.col("w")).alias("w"))
    counts, firsts, lasts, labels = [], [], [], []
    for phrase, label in BASE:
        n = F.when(F.contains("w", F.lit(f" {phrase} ")), F.regexp_count("w", F.lit(f" {phrase}(?= )"))).otherwise(0)
        counts.append(n)
        firsts.append(F.when(n > 0, _spaces(F.substring_index("w", f" {phrase} ", 1))))
        after = _spaces(F.substring_index("w", f" {phrase} ", -1))
        lasts.append(F.when(n > 0, F.col("n_words") - after - len(phrase.split())))
        labels.append(F.when(n > 0, label))
    found = found.select(
        "doc_id", "n_words", "w", sum(counts[1:], counts[0]).cast("long").alias("n_base"),
        F.least(*firsts).cast("long").alias("first_word"), F.greatest(*lasts).cast("long").alias("last_word"),
        F.array_compact(F.array(*labels)).alias("base"))
    table = F.array(*[F.struct(F.lit(r.label).alias("label"), F.lit(r.keyword).alias("keyword"),
                               F.lit(f" {r.pattern}(?= )").alias("pattern"), F.lit(-r.priority).alias("rank"),
                               F.lit(k).alias("no"), F.lit(r.weight).alias("weight"))
                      for k, r in enumerate(rules)])
    matches, gaps = _starts("w", "r.pattern")
    # (start, -end, rank, rule, label, weight): in sorting order, a container stands first.
    places = f"""flatten(transform(filter(rules, r -> contains(w, r.keyword) AND w rlike r.pattern), r ->
        transform(array({matches}), ms -> transform(array({gaps}), gs ->
            aggregate(sequence(1, size(ms)),
                named_struct('at', 0, 'out', cast(array() as array<struct<a:int,z:int,rank:int,no:int,label:string,weight:double>>)),
                (s, i) -> named_struct('at', s.at + gs[i - 1] + ms[i - 1], 'out', array_append(s.out,
                    named_struct('a', s.at + gs[i - 1], 'z', -(s.at + gs[i - 1] + ms[i - 1]), 'rank', r.rank,
                                 'no', r.no, 'label', r.label, 'weight', r.weight))),
                s -> s.out))[0])[0]))"""
    fold = """aggregate(array_sort(places),
        named_struct('end', 0, 'n', 0, 'best', map_from_arrays(cast(array() as array<string>), cast(array() as array<double>))),
        (s, d) -> CASE WHEN -d.z <= s.end THEN s ELSE named_struct('end', -d.z, 'n', s.n + 1, 'best',
            map_concat(map_filter(s.best, (k, v) -> k <> d.label),
                       map(d.label, greatest(d.weight, coalesce(try_element_at(s.best, d.label), 0D))))) END)"""
    scanned = found.withColumn("rules", F.when(F.col("w").isNotNull(), table)).withColumn(
        "places", F.when(F.col("w").isNotNull(), F.expr(places))).withColumn("kept", F.expr(fold))
    best = F.expr("aggregate(map_values(kept.best), 1D, (p, v) -> p * (1D - v))")
    base_score = F.when(F.size("base") > 0, 0.7).otherwise(0.0)
    every = F.array_union("base", F.coalesce(F.map_keys("kept.best"), F.array().cast("array<string>")))
    return scanned.select(
        "doc_id", "n_words", "n_base", "first_word", "last_word",
        F.array_join(F.array_sort("base"), ",").alias("base_labels"),
        F.array_join(F.array_sort(every), ",").alias("labels"),
        F.greatest(base_score, F.coalesce(1.0 - best, F.lit(0.0))).alias("score"),
        F.coalesce("kept.n", F.lit(0)).cast("long").alias("n_detections"))
