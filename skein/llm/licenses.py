"""License scans by ordered signature rules, in DataFrame functions alone.

Rules are phrases over lower-case words with small regex parts, made from a hand-written list of license families and
the ways in which notices name them. A rule is tried only on texts that hold its keyword; texts without any keyword
of the list skip all rules. Of the detections of a text, one whose interval lies within that of another is dropped;
of equal intervals the rule of the higher priority (lower number) stays. Detections that only overlap in part all stay.

Contract for odd inputs: null and empty texts have no words and no detections; words of any length and texts of any
length are read whole; repeated rows give equal values; an empty table gives no rows; extra columns don't matter.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import let, running, table

NOT_WORD = "[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]++"
#: Words around a keyword in which its rules are tried: no rule can match more, whatever their length.
REACH = 40
PLACES = "array<struct<start:int,end:int>>"
DETECTION = "struct<start:int,end:int,label:string,rule:string>"
#: The phrases that are counted in every text, with their labels.
BASE = (("cc by", "cc-by"), ("general public license", "gpl"), ("all rights reserved", "reserved"))


@dataclass(frozen=True)
class Rule:
    name: str
    label: str
    keyword: str
    pattern: str
    priority: int


#: label, names as words, versions ("" for none). A version's digits are words of their own.
FAMILIES = (
    ("apache", ("apache software license", "apache license", "asl"), ("2 0", "1 1", "1 0", "")),
    ("gpl", ("gnu general public license", "gnu gpl", "gpl"), ("3 0", "2 0", "1 0", "3", "2", "1", "")),
    ("lgpl", ("gnu lesser general public license", "gnu library general public license", "gnu lgpl", "lgpl"), ("3 0", "2 1", "2 0", "3", "2", "")),
    ("agpl", ("gnu affero general public license", "affero general public license", "gnu agpl", "agpl"), ("3 0", "1 0", "3", "1", "")),
    ("gfdl", ("gnu free documentation license", "gfdl"), ("1 3", "1 2", "1 1", "")),
    ("mit", ("mit license", "expat license", "x11 license", "mit expat license"), ("",)),
    ("bsd", ("bsd license", "bsd style license", "new bsd license", "modified bsd license", "simplified bsd license", "revised bsd license", "original bsd license", "free bsd license"), ("",)),
    ("bsd-2-clause", ("bsd 2 clause license", "2 clause bsd license", "bsd 2 clause"), ("",)),
    ("bsd-3-clause", ("bsd 3 clause license", "3 clause bsd license", "bsd 3 clause"), ("",)),
    ("bsd-0-clause", ("zero clause bsd license", "bsd zero clause license", "0bsd"), ("",)),
    ("isc", ("isc license", "internet systems consortium license"), ("",)),
    ("mpl", ("mozilla public license", "mpl"), ("2 0", "1 1", "1 0", "2", "")),
    ("epl", ("eclipse public license", "epl"), ("2 0", "1 0", "2", "1", "")),
    ("cddl", ("common development and distribution license", "cddl"), ("1 1", "1 0", "")),
    ("cpl", ("common public license", "cpl"), ("1 0", "")),
    ("eupl", ("european union public licence", "european union public license", "eupl"), ("1 2", "1 1", "1 0", "")),
    ("artistic", ("artistic license", "perl artistic license"), ("2 0", "1 0", "")),
    ("bsl", ("boost software license",), ("1 0", "")),
    ("busl", ("business source license",), ("1 1", "1 0", "")),
    ("zlib", ("zlib license", "zlib libpng license", "libpng license"), ("",)),
    ("psf", ("python software foundation license", "psf license"), ("2 0", "2", "")),
    ("ofl", ("sil open font license", "open font license"), ("1 1", "1 0", "")),
    ("odbl", ("open database license", "odbl"), ("1 0", "")),
    ("odc-by", ("open data commons attribution license", "odc by"), ("1 0", "")),
    ("pddl", ("public domain dedication and license", "pddl"), ("1 0", "")),
    ("ogl", ("open government licence", "open government license"), ("3 0", "2 0", "1 0", "")),
    ("afl", ("academic free license",), ("3 0", "2 1", "2 0", "1 2", "")),
    ("osl", ("open software license",), ("3 0", "2 1", "2 0", "1 1", "")),
    ("ms-pl", ("microsoft public license", "ms pl"), ("",)),
    ("ms-rl", ("microsoft reciprocal license", "ms rl"), ("",)),
    ("upl", ("universal permissive license",), ("1 0", "")),
    ("ncsa", ("university of illinois ncsa open source license", "ncsa open source license"), ("",)),
    ("unlicense", ("the unlicense",), ("",)),
    ("wtfpl", ("do what the fuck you want to public license", "wtfpl"), ("2", "")),
    ("qpl", ("q public license",), ("1 0", "")),
    ("cecill", ("cecill license", "cecill"), ("2 1", "2 0", "1 1", "")),
    ("lppl", ("latex project public license", "lppl"), ("1 3c", "1 3", "1 2", "")),
    ("sspl", ("server side public license", "sspl"), ("1 0", "1", "")),
    ("openssl", ("openssl license", "ssleay license"), ("",)),
    ("php", ("php license",), ("3 01", "3 0", "")),
    ("ruby", ("ruby license",), ("",)),
    ("w3c", ("w3c software notice and license", "w3c license"), ("",)),
    ("rail", ("open rail license", "bigscience rail license", "creativeml open rail m"), ("",)),
)
#: Words that come before a family's name in a notice.
LEADS = ("", "(?:licensed|released|distributed|available|published|provided|made available) under (?:the |a )?(?:terms (?:and conditions )?of (?:the )?)?", "subject to (?:the )?(?:terms of (?:the )?)?")
TAIL = "(?: (?:version|v|ver))? {}(?: or (?:any )?later(?: version)?)?"
#: label, word form of the Creative Commons parts.
COMMONS = (("cc-by-nc-nd", "nc nd"), ("cc-by-nc-sa", "nc sa"), ("cc-by-nc", "nc"), ("cc-by-nd", "nd"), ("cc-by-sa", "sa"), ("cc-by-4-0", ""))
COMMONS_LONG = (
    ("cc-by-nc-nd", "attribution non ?commercial no ?deriv(?:ative)?s"),
    ("cc-by-nc-sa", "attribution non ?commercial share ?alike"),
    ("cc-by-nc", "attribution non ?commercial"),
    ("cc-by-nd", "attribution no ?deriv(?:ative)?s"),
    ("cc-by-sa", "attribution share ?alike"),
    ("cc-by", "attribution"),
)
#: name, label, keyword, pattern: clauses and notices that stand for a license or a reservation.
CLAUSES = (
    ("mit-grant", "mit", "hereby", "permission is hereby granted free of charge to any person obtaining a copy(?: of this software)?"),
    ("mit-notice", "mit", "substantial", "the above copyright notice and this permission notice shall be included in all copies or substantial portions(?: of the software)?"),
    ("isc-grant", "isc", "fee", "permission to use copy modify and or distribute this software for any purpose with or without fee"),
    ("bsd-grant", "bsd", "redistribution", "redistribution and use in source and binary forms with or without modification are permitted"),
    ("bsd-endorse", "bsd-3-clause", "endorse", "may be used to endorse or promote products derived from this software"),
    ("as-is", "no-warranty", "warranty", "(?:the software is )?provided as is without warranty of any kind"),
    ("no-warranty-gpl", "gpl", "warranty", "without even the implied warranty of merchantability or fitness for a particular purpose"),
    ("gpl-free", "gpl", "redistribute", "you can redistribute it and or modify it under the terms of the gnu general public license"),
    ("lgpl-free", "lgpl", "redistribute", "you can redistribute it and or modify it under the terms of the gnu lesser general public license"),
    ("agpl-free", "agpl", "redistribute", "you can redistribute it and or modify it under the terms of the gnu affero general public license"),
    ("gpl-copy", "gpl", "gnu", "you should have received a copy of the gnu general public license"),
    ("apache-comply", "apache", "compliance", "you may not use this file except in compliance with the license"),
    ("apache-url", "apache", "apache", "www apache org licenses license 2 0"),
    ("gnu-url", "gpl", "gnu", "www gnu org (?:copyleft|licenses)(?: gpl(?: html)?)?"),
    ("mpl-notice", "mpl", "mozilla", "this source code form is subject to the terms of the mozilla public license"),
    ("unlicense-text", "unlicense", "unencumbered", "this is free and unencumbered software released into the public domain"),
    ("public-domain", "public-domain", "domain", "(?:released (?:in)?to|placed in(?:to)?|dedicated to|is in) the public domain"),
    ("cc0", "cc0", "cc0", "cc0(?: 1 0)?(?: universal)?"),
    ("cc-zero", "cc0", "zero", "creative commons zero(?: 1 0)?"),
    ("cc-url-by", "cc-by", "creativecommons", "creativecommons org licenses by(?: [a-z]{2}){0,2}(?: [1-4] [0-9])?"),
    ("cc-url-zero", "cc0", "creativecommons", "creativecommons org publicdomain zero(?: 1 0)?"),
    ("cc-generic", "creative-commons", "creative", "creative commons licen[sc]e"),
    ("spdx", "spdx", "spdx", "spdx license identifier [a-z0-9]+(?: [0-9]+){0,3}"),
    ("reserved-some", "reserved", "reserved", "(?:some|no) rights reserved"),
    ("reserved-all", "reserved", "reserved", "(?:copyright )?(?:c )?(?:[0-9]{4} )?all rights reserved"),
    ("copyright-year", "copyright", "copyright", "copyright (?:c )?(?:19|20)[0-9]{2}(?: (?:19|20)[0-9]{2})?(?: by)?"),
    ("copyright-by", "copyright", "copyrighted", "copyrighted (?:material|by|work|c)"),
    ("proprietary", "proprietary", "proprietary", "proprietary and confidential"),
    ("confidential", "proprietary", "unauthorized", "unauthorized (?:copying|use|reproduction|distribution)(?: or (?:copying|use|reproduction|distribution))?"),
    ("eula", "proprietary", "eula", "eula"),
    ("end-user", "proprietary", "agreement", "end user license agreement"),
    ("commercial", "non-commercial", "commercial", "(?:for )?non commercial (?:use|purposes)(?: only)?"),
    ("research", "non-commercial", "research", "for research (?:use|purposes) only"),
    ("personal", "non-commercial", "personal", "for personal (?:use|purposes) only"),
    ("academic", "non-commercial", "academic", "for academic (?:use|purposes) only"),
    ("permission", "reserved", "permission", "(?:used|reprinted|reproduced) (?:with|by) permission(?: of)?"),
    ("no-reproduction", "reserved", "reproduced", "no part of this (?:publication|work|book|document) may be reproduced"),
    ("dual", "dual", "dual", "dual licensed(?: under)?"),
    ("same-terms-perl", "artistic", "perl", "under the same terms as perl(?: itself)?"),
    ("patents", "patent-grant", "patent", "additional grant of patent rights"),
    ("trademark", "trademark", "trademark", "(?:registered )?trademarks? (?:of|are the property of)(?: their respective owners)?"),
)


def _keyword(name: str) -> str:
    """The name as a prefix that any spelling of "license" shares: few texts hold it without a notice."""
    for word in ("license", "licence"):
        if word in name:
            return name[: name.index(word)] + "licen"
    return name + " "


def rules() -> list[Rule]:
    """All rules in order of priority: clauses first, then full notices, longer names and given versions before
    shorter ones."""
    out = [(name, label, keyword, pattern) for name, label, keyword, pattern in CLAUSES]
    for k, (label, parts) in enumerate(COMMONS):
        out += [(f"cc-short-{k}-{n}", label, "cc by", f"{lead}cc by {parts + ' ' if parts else ''}[1-4] [0-9]") for n, lead in enumerate(LEADS[:2])]
        out += [(f"cc-bare-{k}", label, "cc by", f"cc by {parts}")] * bool(parts)
    for k, (label, words) in enumerate(COMMONS_LONG):
        out += [(f"cc-long-{k}-{n}", label, "attribution", f"{lead}(?:creative commons |cc ){words}(?: (?:[1-4] [0-9] )?(?:international|unported|generic|public))?(?: licen[sc]e)?") for n, lead in enumerate(LEADS[:2])]
    for label, names, versions in FAMILIES:
        for name in names:
            for version in versions:
                for n, lead in enumerate(LEADS):
                    tail = TAIL.format(version) if version else ""
                    out.append((f"{label}-{name}-{version}-{n}".replace(" ", "-"), label, _keyword(name), lead + name.replace("license", "licen[sc]e") + tail))
    out += [("base-" + label, label, _keyword(phrase), phrase) for phrase, label in BASE]
    return [Rule(name, label, keyword, pattern, k) for k, (name, label, keyword, pattern) in enumerate(out)]


def word_line(text: Column) -> Column:
    """The lower-case words of a text with one space before, between and after them. Beyond A to Z, lower() changes
    letters into letters only, so words stay as they are."""
    return F.regexp_replace(F.concat(F.lit(" "), F.lower(F.coalesce(text, F.lit(""))), F.lit(" ")), NOT_WORD, " ")


def spaces(x: Column) -> Column:
    return F.length(x) - F.length(F.replace(x, F.lit(" "), F.lit("")))


def _places(line: Column, pattern: Column) -> Column:
    """Array of (start, end) of a pattern's matches, in words from 0, end exclusive. Matches are whole words: signs are set
    before the first and after the last of each, which stand in no word."""
    whole = F.concat(F.lit("(?<= )(?:"), pattern, F.lit(")(?= )"))
    words = F.split(F.trim(F.regexp_replace(line, whole, F.lit("\x01$0\x02"))), " ")
    at = lambda sign: F.filter(F.transform(words, lambda w, i: F.when(F.contains(w, F.lit(sign)), i)), lambda i: i.isNotNull())
    found = F.transform(F.arrays_zip(at("\x01").alias("a"), at("\x02").alias("b")), lambda x: F.struct(x["a"].alias("start"), (x["b"] + 1).alias("end")))
    return F.when(F.rlike(line, whole), found).otherwise(F.array().cast(PLACES))


def detections(line: Column, rule_list: list[Rule]) -> Column:
    """Array of (start, end, label, rule) of a word line, after suppression."""
    by_word: dict[str, list[Rule]] = {}
    for r in rule_list:
        by_word.setdefault(r.keyword, []).append(r)

    def literal(rs: list[Rule]) -> Column:
        return F.array(*[F.struct(F.lit(r.priority).alias("priority"), F.lit(r.name).alias("name"), F.lit(r.label).alias("label"), F.lit(r.pattern).alias("pattern")) for r in rs])

    def entry(k: str, rs: list[Rule]) -> Column:
        """A keyword, its first word, whether that is a whole word of it, and its rules."""
        return F.struct(F.lit(f" {k}").alias("word"), F.lit(k.split(" ")[0]).alias("head"), F.lit(" " in k).alias("exact"), literal(rs).alias("rules"))

    table = F.array(*[entry(k, rs) for k, rs in by_word.items()])

    def tried(x: Column, r: Column) -> Column:
        own = F.filter(_places(x["line"], r["pattern"]), lambda p: (p["start"] <= x["at"]) & (x["at"] < p["end"]))  # the others are found where their own keyword stands
        return F.transform(own, lambda p: F.struct((p["start"] + x["before"]).alias("start"), (-p["end"] - x["before"]).alias("back"), r["priority"].alias("priority"), r["label"].alias("label"), r["name"].alias("rule")))

    def around(words: Column, i: Column) -> Column:
        """The words about number i as a line, and the number of the first."""
        first = F.greatest(F.lit(0), i - REACH)
        return F.struct(line_of(words, first, i - first + REACH).alias("line"), first.alias("before"), (i - first).alias("at"))

    def line_of(words: Column, first: Column, n: Column) -> Column:
        return F.concat(F.lit(" "), F.array_join(F.slice(words, first + 1, n), " "), F.lit(" "))

    def matches(words: Column) -> Column:
        """What the rules find about each place of a keyword that the text holds."""

        def of(k: Column) -> Column:
            begins = lambda w: F.when(k["exact"], w == k["head"]).otherwise(F.startswith(w, k["head"]))
            at = F.filter(F.transform(words, lambda w, i: F.when(begins(w), i)), lambda i: i.isNotNull())
            real = F.filter(at, lambda i: ~k["exact"] | F.startswith(line_of(words, i, F.lit(REACH)), k["word"]))
            return F.flatten(F.transform(F.transform(real, lambda i: around(words, i)), lambda x: F.flatten(F.transform(k["rules"], lambda r: tried(x, r)))))

        return F.flatten(F.transform(F.filter(table, lambda k: F.contains(line, k["word"])), of))

    def add(end: Column, x: Column) -> tuple[Column, Column]:
        item = F.struct(x["start"].alias("start"), (-x["back"]).alias("end"), x["label"].alias("label"), x["rule"].alias("rule"))
        return F.greatest(end, -x["back"]), F.when(-x["back"] <= end, F.array().cast(f"array<{DETECTION}>")).otherwise(F.array(item))

    return let(F.array_sort(F.array_distinct(let(F.split(F.trim(line), " "), matches))), lambda found: running(found, F.lit(-1), DETECTION, add))


def keyword_gate(keywords: set[str]) -> str:
    """A regex for any word that begins with a keyword; branches by first letter, so that few are tried."""
    by_letter: dict[str, list[str]] = {}
    for k in sorted(keywords):
        by_letter.setdefault(k[0], []).append(k[1:])
    return " (?:" + "|".join(f"{c}(?:{'|'.join(rest)})" for c, rest in by_letter.items()) + ")"


def scan(docs: DataFrame) -> DataFrame:
    """Per row of docs: doc_id, n_words, the base phrases' places, and the detections of all rules."""
    rule_list = rules()
    gate = keyword_gate({r.keyword for r in rule_list})
    lined = docs.select("doc_id", word_line(F.col("text")).alias("line"))
    none = F.array().cast(f"array<{DETECTION}>")
    found = F.when(F.col("line").rlike(gate), detections(F.col("line"), rule_list)).otherwise(none)
    base = [F.when(F.contains("line", F.lit(f" {phrase} ")), _places(F.col("line"), F.lit(phrase))).otherwise(F.array().cast(PLACES)).alias(label) for phrase, label in BASE]
    return lined.select("doc_id", (spaces(F.col("line")) - 1).cast("long").alias("n_words"), *base, found.alias("detections"))


def op7_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """n_base and the first and last word are of the base phrases; labels also hold those of the rules; score is the
    share of words that detections cover, from 0 to 1."""
    found = scan(table(spark, sf_dir, "documents"))
    labels = [label for _, label in BASE]
    starts = F.transform(F.concat(*labels), lambda p: p["start"])
    base = F.array_compact(F.array(*[F.when(F.size(c) > 0, F.lit(c)) for c in labels]))
    covered = F.aggregate("detections", F.struct(F.lit(0).alias("at"), F.lit(0).alias("n")), lambda s, d: F.struct(F.greatest(s["at"], d["end"]).alias("at"), (s["n"] + d["end"] - F.greatest(s["at"], d["start"])).alias("n")), lambda s: s["n"])
    return found.select(
        "doc_id",
        "n_words",
        F.size(F.concat(*labels)).cast("long").alias("n_base"),
        F.array_min(starts).cast("long").alias("first_word"),
        F.array_max(starts).cast("long").alias("last_word"),
        F.array_join(F.array_sort(base), ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_union(base, F.array_distinct(F.transform("detections", lambda d: d["label"])))), ",").alias("labels"),
        F.when(F.col("n_words") > 0, covered / F.col("n_words")).otherwise(0.0).cast("double").alias("score"),
    )
