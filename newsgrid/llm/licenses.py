"""License scan by ordered signature rules, in DataFrame functions only.

A text is lower-cased (A-Z), cut into words and joined by single spaces. A rule is a regex over that
form, a label, a priority and a keyword; only rules whose keyword is among the words are tried, and
only in texts that hold a keyword at all. A detection inside another of higher priority, or inside a
longer one of the same priority, is suppressed. Null text is empty. Extra columns pass, those named like a
result are replaced, names with a leading underscore are reserved; repeated rows are scanned each.

Words are cut by one split and matches by one replacement that marks them, as both are linear in the text;
the list of all matches that the regex functions offer copies the text once per match.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
MARK = "\u0001"  # stands in no joined text
RUN = 256  # lengths that are summed one by one

# Phrases and the labels the base scan gives them.
BASE = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}

# Fixed values: (keyword, name pattern, label stem, versions). A version adds its digits to the label.
FAMILIES = [
    ("apache", r"apache (?:software )?licen[sc]e", "apache", "1.0 1.1 2.0"),
    ("mozilla", r"mozilla public licen[sc]e", "mpl", "1.0 1.1 2.0"),
    ("eclipse", r"eclipse public licen[sc]e", "epl", "1.0 2.0"),
    ("affero", r"(?:gnu )?affero general public licen[sc]e", "agpl", "1.0 3.0"),
    ("lesser", r"(?:gnu )?lesser general public licen[sc]e", "lgpl", "2.1 3.0"),
    ("library", r"(?:gnu )?library general public licen[sc]e", "lgpl", "2.0"),
    ("general", r"(?:gnu )?general public licen[sc]e", "gpl", "1.0 2.0 3.0"),
    ("gpl", r"(?:gnu )?gpl", "gpl", "1.0 2.0 3.0"),
    ("gplv2", r"gplv2", "gpl-2.0", ""),
    ("gplv3", r"gplv3", "gpl-3.0", ""),
    ("lgpl", r"lgpl", "lgpl", "2.0 2.1 3.0"),
    ("agpl", r"agpl", "agpl", "1.0 3.0"),
    ("documentation", r"(?:gnu )?free documentation licen[sc]e", "gfdl", "1.1 1.2 1.3"),
    ("artistic", r"artistic licen[sc]e", "artistic", "1.0 2.0"),
    ("boost", r"boost software licen[sc]e", "bsl", "1.0"),
    ("academic", r"academic free licen[sc]e", "afl", "1.1 1.2 2.0 2.1 3.0"),
    ("open", r"open software licen[sc]e", "osl", "1.0 1.1 2.0 2.1 3.0"),
    ("european", r"european union public licen[sc]e", "eupl", "1.0 1.1 1.2"),
    ("cddl", r"cddl", "cddl", "1.0 1.1"),
    ("common", r"common development and distribution licen[sc]e", "cddl", "1.0 1.1"),
    ("common", r"common public licen[sc]e", "cpl", "1.0"),
    ("cecill", r"cecill", "cecill", "1.0 1.1 2.0 2.1"),
    ("python", r"python software foundation licen[sc]e", "psf", "2.0"),
    ("php", r"php licen[sc]e", "php", "3.0 3.01"),
    ("zope", r"zope public licen[sc]e", "zpl", "1.1 2.0 2.1"),
    ("zlib", r"zlib licen[sc]e", "zlib", ""),
    ("isc", r"isc licen[sc]e", "isc", ""),
    ("mit", r"mit licen[sc]e", "mit", ""),
    ("expat", r"expat licen[sc]e", "mit", ""),
    ("unlicense", r"(?:the )?unlicense", "unlicense", ""),
    ("wtfpl", r"wtfpl", "wtfpl", "1.0 2.0"),
    ("beerware", r"beerware", "beerware", ""),
    ("proprietary", r"proprietary(?: and confidential)?", "proprietary", ""),
    ("confidential", r"confidential and proprietary", "proprietary", ""),
    ("openssl", r"openssl licen[sc]e", "openssl", ""),
    ("sil", r"sil open font licen[sc]e", "ofl", "1.0 1.1"),
    ("database", r"open database licen[sc]e", "odbl", "1.0"),
    ("odbl", r"odbl", "odbl", "1.0"),
    ("microsoft", r"microsoft public licen[sc]e", "ms-pl", ""),
    ("microsoft", r"microsoft reciprocal licen[sc]e", "ms-rl", ""),
    ("postgresql", r"postgresql licen[sc]e", "postgresql", ""),
    ("spdx", r"spdx licen[sc]e identifier", "spdx-tag", ""),
]
# Clauses and notices that need no version.
CLAUSES = [
    ("permission", r"permission is hereby granted free of charge to any person obtaining a copy", "mit"),
    ("permission", r"permission to use copy modify and or distribute this software for any purpose", "isc"),
    ("redistribution", r"redistribution and use in source and binary forms with or without modification", "bsd"),
    ("endorse", r"may be used to endorse or promote products", "bsd-3-clause"),
    ("bsd", r"(?:2 clause|simplified) bsd(?: licen[sc]e)?|bsd 2 clause", "bsd-2-clause"),
    ("bsd", r"(?:3 clause|new|modified|revised) bsd(?: licen[sc]e)?|bsd 3 clause", "bsd-3-clause"),
    ("bsd", r"(?:4 clause|original) bsd(?: licen[sc]e)?|bsd 4 clause", "bsd-4-clause"),
    ("bsd", r"bsd licen[sc]e", "bsd"),
    ("mit", r"(?:licensed|released) under (?:the )?mit", "mit"),
    ("apache", r"(?:licensed|released) under (?:the )?apache", "apache"),
    ("public", r"(?:in|into|to) the public domain|public domain dedication", "public-domain"),
    ("cc0", r"cc0(?: 1 0)?(?: universal)?", "cc0-1.0"),
    ("copyright", r"copyright (?:c )?(?:19|20)[0-9]{2}", "copyright-notice"),
    ("reserved", r"some rights reserved", "some-rights-reserved"),
    ("warranty", r"without warranty of any kind", "no-warranty"),
    ("commercial", r"not for commercial use|non commercial use only", "non-commercial"),
    ("redistribute", r"do not redistribute|may not redistribute", "no-redistribution"),
]
# Sentences of licence bodies and of file headers.
SENTENCES = [
    ("portions", r"the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software", "mit"),
    ("noninfringement", r"fitness for a particular purpose and noninfringement", "mit"),
    ("merchantability", r"merchantability fitness for a particular purpose and non ?infringement in no event shall the authors", "mit"),
    ("redistributions", r"redistributions of source code must retain the above copyright notice", "bsd"),
    ("redistributions", r"redistributions in binary form must reproduce the above copyright notice", "bsd"),
    ("advertising", r"all advertising materials mentioning features or use of this software must display", "bsd-4-clause"),
    ("contributors", r"neither the name of .{1,80}? nor the names of its contributors", "bsd-3-clause"),
    ("regents", r"the regents of the university of california", "bsd"),
    ("compliance", r"you may not use this file except in compliance with the license", "apache-2.0"),
    ("obtain", r"you may obtain a copy of the license at http www apache org licenses license 2 0", "apache-2.0"),
    ("governing", r"see the license for the specific language governing permissions and limitations under the license", "apache-2.0"),
    ("grant", r"grant of patent license subject to the terms and conditions of this license", "apache-2.0"),
    ("foundation", r"as published by the free software foundation", "gpl"),
    ("option", r"either version 2 of the license or at your option any later version", "gpl-2.0-or-later"),
    ("foundation", r"free software foundation either version 2 of the license or at your option any later version", "gpl-2.0-or-later"),
    ("foundation", r"free software foundation either version 3 of the license or at your option any later version", "gpl-3.0-or-later"),
    ("foundation", r"free software foundation version 2 of the license", "gpl-2.0"),
    ("foundation", r"free software foundation version 3 of the license", "gpl-3.0"),
    ("copyleft", r"a free copyleft license for software and other kinds of works", "gpl-3.0"),
    ("network", r"ensure cooperation with the community in the case of network server software", "agpl-3.0"),
    ("libraries", r"applies to some specially designated software packages typically libraries", "lgpl-2.1"),
    ("mozilla", r"this source code form is subject to the terms of the mozilla public license v 2 0", "mpl-2.0"),
    ("mozilla", r"the contents of this file are subject to the mozilla public license version 1 1", "mpl-1.1"),
    ("eclipse", r"this program and the accompanying materials are made available under the terms of the eclipse public license", "epl"),
    ("organization", r"permission is hereby granted free of charge to any person or organization obtaining a copy of the software and accompanying documentation covered by this license", "bsl-1.0"),
    ("liable", r"this software is provided as is without any express or implied warranty in no event will the authors be held liable", "zlib"),
    ("misrepresented", r"the origin of this software must not be misrepresented", "zlib"),
    ("misrepresented", r"altered source versions must be plainly marked as such and must not be misrepresented", "zlib"),
    ("unencumbered", r"this is free and unencumbered software released into the public domain", "unlicense"),
    ("dedicate", r"dedicate any and all copyright interest in the software to the public domain", "unlicense"),
    ("affirmer", r"affirmer hereby overtly fully permanently irrevocably and unconditionally waives", "cc0-1.0"),
    ("credit", r"you must give appropriate credit provide a link to the license and indicate if changes were made", "cc-by"),
    ("commercial", r"you may not use the material for commercial purposes", "cc-by-nc"),
    ("remix", r"if you remix transform or build upon the material you must distribute your contributions under the same license", "cc-by-sa"),
    ("remix", r"if you remix transform or build upon the material you may not distribute the modified material", "cc-by-nd"),
    ("fuck", r"do what the fuck you want to", "wtfpl"),
    ("beer", r"you can buy me a beer in return", "beerware"),
    ("font", r"the font software may be modified altered or added to", "ofl"),
    ("font", r"reserved font name", "ofl"),
    ("intent", r"the intent of this document is to state the conditions under which a package may be copied", "artistic-1.0"),
    ("perl", r"(?:under the same terms as|same terms as) perl(?: itself)?", "perl"),
    ("invariant", r"with no invariant sections no front cover texts and no back cover texts", "gfdl"),
    ("database", r"this database is made available under the open database license", "odbl"),
    ("openssl", r"this product includes software developed by the openssl project", "openssl"),
    ("reproduced", r"no part of this (?:book|publication|document|work) may be reproduced", "no-reproduction"),
    ("consent", r"without the (?:prior|express)(?: prior)? written (?:consent|permission) of", "no-reproduction"),
    ("trade", r"(?:contains|constitutes) (?:confidential and )?(?:proprietary information|trade secrets)", "proprietary"),
    ("reserved", r"all rights reserved by the (?:author|licensor|publisher)s?", "reserved-by-owner"),
    ("evaluation", r"for (?:internal )?evaluation (?:purposes )?only", "evaluation-only"),
    ("academic", r"for (?:academic|research) (?:use|purposes) only", "research-only"),
    ("research", r"for (?:academic and )?research (?:use|purposes) only", "research-only"),
    ("educational", r"for (?:personal|private)(?: and| or)? educational use only", "personal-use"),
    ("personal", r"for personal(?: and)? non ?commercial use only", "personal-use"),
]
# The parts a Creative Commons name may add, and its versions.
CC_PARTS = ["", "nc", "nd", "sa", "nc nd", "nc sa"]
CC_LONG = {"nc": "non ?commercial", "nd": "no ?derivatives", "sa": "share ?alike"}
CC_VERSIONS = ["1.0", "2.0", "2.5", "3.0", "4.0"]


def rules() -> list[tuple[str, str, str, int]]:
    """(keyword, regex, label, priority), most specific first; hundreds, from the families and versions above."""
    out = []
    for keyword, name, stem, versions in FAMILIES:
        for v in versions.split():
            digits = v.replace(".", " ")
            short = digits.removesuffix(" 0")
            for form in dict.fromkeys([digits, short]):
                out.append((keyword, f"{name} (?:version |v ?)?{form}", f"{stem}-{v}", 30 + (form == digits)))
            out.append((keyword, f"{name} v{short}(?: or later)?", f"{stem}-{v}", 30))
            out.append((keyword, f"{name} (?:version |v ?)?{short}(?: 0)? or (?:any )?later(?: version)?", f"{stem}-{v}-or-later", 40))
        out.append((keyword, name, stem, 10))
    for parts in CC_PARTS:
        label = "-".join(["cc", "by", *parts.split()])
        long = " ".join(["attribution", *[CC_LONG[p] for p in parts.split()]])
        depth = len(parts.split())
        for v in CC_VERSIONS:
            digits = v.replace(".", " ")
            out.append(("cc", " ".join(["cc by", *parts.split(), digits]), f"{label}-{v}", 30 + depth))
            out.append(("commons", f"creative commons {long} {digits}(?: international| unported| generic)?", f"{label}-{v}", 30 + depth))
        out.append(("cc", " ".join(["cc by", *parts.split()]), label, 10 + depth))
        out.append(("commons", f"creative commons {long}", label, 10 + depth))
    out += [(k, p, label, 20) for k, p, label in CLAUSES] + [(k, p, label, 35) for k, p, label in SENTENCES]
    return sorted(out, key=lambda r: (-r[3], r[2], r[1]))


def lowered(text: str) -> Column:
    upper = "".join(map(chr, range(65, 91)))
    return F.translate(F.coalesce(text, F.lit("")), upper, upper.lower())


def places(phrase: str) -> Column:
    """Word positions at which ``phrase`` starts in ``_words``; looked for only where the joined text holds it."""
    words = phrase.split(" ")
    alike = lambda i: F.forall(F.array(*[F.struct(F.lit(k + 1).alias("k"), F.lit(w).alias("w")) for k, w in enumerate(words)]), lambda x: F.element_at("_words", i + x["k"]) == x["w"])
    found = F.filter(F.sequence(F.lit(0), F.size("_words") - len(words)), alike)
    return F.when(F.contains("_norm", F.lit(f" {phrase} ")), found).otherwise(F.array().cast("array<int>"))


def _literal_rules() -> Column:
    return F.array(*[F.struct(F.lit(k).alias("keyword"), F.lit(rf"(?<= )(?:{p})(?= )").alias("regex"), F.lit(label).alias("label"), F.lit(n).alias("priority")) for k, p, label, n in rules()])


def bound(value: Column, body) -> Column:
    """``body(value)`` with the value evaluated once; a lambda evaluates what it reads from outside at every step."""
    return F.element_at(F.transform(F.array(value), body), 1)


def summed(values: Column) -> Column:
    return F.aggregate(values, F.lit(0), lambda a, x: a + x)


def block_numbers(values: Column) -> Column:
    """0, 1, ... for the blocks of ``RUN`` elements; none for an empty array."""
    last = F.floor((F.size(values) - 1) / RUN).cast("int")
    return F.when(F.size(values) > 0, F.sequence(F.lit(0), last)).otherwise(F.array().cast("array<int>"))


def block_of(values: Column, b: Column) -> Column:
    return F.slice(values, b * RUN + 1, F.lit(RUN))


def starts_of(lengths: Column) -> Column:
    """The sum of the lengths before each one: block sums first, so that the work stays linear in long lists."""
    sums = F.transform(block_numbers(lengths), lambda b: summed(block_of(lengths, b)))
    before = F.aggregate(sums, F.array(F.lit(0)), lambda a, x: F.concat(a, F.array(F.element_at(a, -1) + x)))
    within = lambda part, start: F.transform(part, lambda _, i: start + summed(F.slice(part, F.lit(1), i)))
    return bound(before, lambda at: F.flatten(F.transform(block_numbers(lengths), lambda b: bound(block_of(lengths, b), lambda part: within(part, F.element_at(at, b + 1))))))


def detections() -> Column:
    """(from, upto, priority, label) of every match of every rule whose keyword is in ``_present``, in characters of ``_norm``, in order."""

    def placed(rule: Column, lengths: Column) -> Column:
        span = lambda start, i: F.struct(start.alias("from"), (start + F.element_at(lengths, i + 1)).alias("upto"), rule["priority"].alias("priority"), rule["label"].alias("label"))
        return F.filter(F.transform(starts_of(lengths), span), lambda _, i: i % 2 == 1)

    def of(rule: Column) -> Column:
        pieces = F.split(F.regexp_replace("_norm", rule["regex"], F.lit(f"{MARK}$0{MARK}")), MARK)  # gap, match, gap, match, gap
        return bound(F.transform(pieces, lambda x: F.length(x)), lambda lengths: F.when(F.size(lengths) > 1, placed(rule, lengths)))

    found = F.transform(F.filter(F.col("_rules"), lambda r: F.array_contains("_present", r["keyword"])), of)
    return F.array_sort(F.flatten(F.filter(found, lambda x: x.isNotNull())))


def unsuppressed(found: Column) -> Column:
    """Detections that lie in none of higher priority and in no longer one of theirs.

    ``found`` is in order of place; a block of it is compared with the blocks before that reach into it.
    """
    inside = lambda x, y: (y["from"] <= x["from"]) & (y["upto"] >= x["upto"]) & ((y["priority"] > x["priority"]) | ((y["priority"] == x["priority"]) & (y["upto"] - y["from"] > x["upto"] - x["from"])))
    reach = F.transform(block_numbers(found), lambda b: F.array_max(F.transform(block_of(found, b), lambda x: x["upto"])))

    def kept(far: Column, b: Column) -> Column:
        first = F.element_at(found, b * RUN + 1)["from"]
        near = F.filter(block_numbers(found), lambda c: (c <= b + 1) & (F.element_at(far, c + 1) >= first))
        return bound(F.flatten(F.transform(near, lambda c: block_of(found, c))), lambda ys: F.filter(block_of(found, b), lambda x: ~F.exists(ys, lambda y: inside(x, y))))

    return bound(reach, lambda far: F.flatten(F.transform(block_numbers(found), lambda b: kept(far, b))))


def covered(spans: Column) -> Column:
    """Characters under at least one of the spans (from, upto)."""
    start = F.struct(F.lit(0).alias("upto"), F.lit(0).alias("n"))
    step = lambda a, x: F.struct(F.greatest(a["upto"], x["upto"]).alias("upto"), (a["n"] + F.greatest(F.lit(0), x["upto"] - F.greatest(a["upto"], x["from"]))).alias("n"))
    return F.aggregate(F.array_sort(spans), start, step, lambda a: a["n"])


def scan_licenses(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with n_words, base_places (per phrase), detections (kept ones), labels and score.

    score: the share of the text's characters that kept detections cover, at most 1.
    """
    keywords = sorted({r[0] for r in rules()})
    step = docs.withColumn("_words", F.filter(F.split(lowered(text), BETWEEN), lambda w: w != ""))
    step = step.withColumn("_norm", F.concat(F.lit(" "), F.array_join("_words", " "), F.lit(" ")))
    step = step.withColumn("base", F.filter(F.array(*[F.struct(F.lit(label).alias("label"), places(p).alias("at")) for p, label in BASE.items()]), lambda x: F.size(x["at"]) > 0))
    step = step.withColumn("_present", F.array_intersect("_words", F.array(*[F.lit(k) for k in keywords])))
    step = step.withColumn("_rules", F.when(F.size("_present") > 0, _literal_rules()))
    step = step.withColumn("_found", F.coalesce(detections(), F.array()))
    step = step.withColumn("detections", unsuppressed(F.col("_found")))
    base = F.transform("base", lambda x: x["label"])
    labels = F.array_sort(F.array_union(base, F.transform("detections", lambda x: x["label"])))
    cover = covered(F.transform("detections", lambda x: F.struct(x["from"].alias("from"), x["upto"].alias("upto"))))
    made = ("n_words", "base", "detections", "base_labels", "labels", "score")
    return step.select(
        *[c for c in docs.columns if c not in made], F.size("_words").cast("long").alias("n_words"), "base", "detections", F.array_sort(F.array_distinct(base)).alias("base_labels"),
        labels.alias("labels"), (cover / F.greatest(F.length("_norm"), F.lit(1))).alias("score"),
    )
