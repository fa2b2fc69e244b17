"""License scans (operator 10), native.

Method: ordered signature rules.  A text is reduced to its words (lower case,
one space between); texts that hold none of the keywords are done.  In the
others each keyword is looked for once, and where it occurs one pattern, of all its
rules, tells whether any of them matches; only then each rule of that keyword is
matched by itself.  The detections are ordered, and one that lies inside another of at least its priority is
suppressed, so the more specific rule wins.  Everything is DataFrame functions.

Nulls count as the empty text, which has no words and no detections; repeated
rows each get their result; an empty table gives an empty result.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hangar.llm.common import table


class Rule(NamedTuple):
    label: str
    level: int      # priority: 4 tag, 3 grant, 2 full name, 1 passing mention
    keyword: str    # words, or the start of one, that every match holds
    pattern: str    # over the words of a text, between word boundaries


#: Words of a text: runs of these; the scan is blind to the case of A-Z.
SEPARATORS = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"

#: The base phrases and their labels.
BASE = (("mit", "mit license"), ("apache", "apache license"), ("gpl", "general public license"))

V = r"(?: version)?"
LATER = r"(?: or (?:\(?at your option\)? )?(?:any )?later(?: version)?)?"
#: label: keyword of the name, the name's pattern, the identifier's pattern.
NAMES = {
    "mit": ("mit", r"mit(?: license)?", r"mit"),
    "mit-0": ("mit", r"mit no attribution(?: license)?", r"mit 0"),
    "apache": ("apache", r"apache(?: software)? licen[sc]e", r"apache"),
    "apache-1.1": ("apache", rf"apache(?: software)? licen[sc]e{V} v?1 1", r"apache 1 1"),
    "apache-2.0": ("apache", rf"apache(?: software)? licen[sc]e{V} v?2(?: 0)?", r"apache 2(?: 0)?"),
    "gpl": ("general public", r"(?:gnu )?general public licen[sc]e", r"(?:gnu )?gpl"),
    "gpl-1.0": ("general public", rf"(?:gnu )?general public licen[sc]e{V} v?1(?: 0)?{LATER}", r"gplv?1|gpl 1 0(?: only| or later)?"),
    "gpl-2.0": ("general public", rf"(?:gnu )?general public licen[sc]e{V} v?2(?: 0)?{LATER}", r"gplv2|gpl v?2(?: 0)?(?: only| or later)?"),
    "gpl-3.0": ("general public", rf"(?:gnu )?general public licen[sc]e{V} v?3(?: 0)?{LATER}", r"gplv3|gpl v?3(?: 0)?(?: only| or later)?"),
    "lgpl": ("general public", r"(?:gnu )?(?:lesser|library) general public licen[sc]e", r"lgpl"),
    "lgpl-2.0": ("general public", rf"(?:gnu )?library general public licen[sc]e{V} v?2(?: 0)?{LATER}", r"lgpl 2 0(?: only| or later)?"),
    "lgpl-2.1": ("general public", rf"(?:gnu )?lesser general public licen[sc]e{V} v?2 1{LATER}", r"lgplv2 1|lgpl v?2 1(?: only| or later)?"),
    "lgpl-3.0": ("general public", rf"(?:gnu )?lesser general public licen[sc]e{V} v?3(?: 0)?{LATER}", r"lgplv3|lgpl v?3(?: 0)?(?: only| or later)?"),
    "agpl": ("affero", r"(?:gnu )?affero general public licen[sc]e", r"agpl"),
    "agpl-3.0": ("affero", rf"(?:gnu )?affero general public licen[sc]e{V} v?3(?: 0)?{LATER}", r"agplv3|agpl v?3(?: 0)?(?: only| or later)?"),
    "gfdl": ("free documentation", rf"(?:gnu )?free documentation licen[sc]e(?:{V} v?1 [1-3])?{LATER}", r"gfdl(?: 1 [1-3])?"),
    "bsd": ("bsd", r"bsd(?: style)? licen[sc]e", r"bsd"),
    "bsd-2-clause": ("bsd", r"(?:bsd 2 clause|2 clause bsd|two clause bsd|simplified bsd)(?: licen[sc]e)?", r"bsd 2 clause"),
    "bsd-3-clause": ("bsd", r"(?:bsd 3 clause|3 clause bsd|three clause bsd|new bsd|modified bsd|revised bsd)(?: licen[sc]e)?", r"bsd 3 clause"),
    "bsd-4-clause": ("bsd", r"(?:bsd 4 clause|4 clause bsd|original bsd)(?: licen[sc]e)?", r"bsd 4 clause"),
    "0bsd": ("bsd", r"(?:zero clause bsd|bsd zero clause)(?: licen[sc]e)?", r"0bsd"),
    "isc": ("isc", r"isc licen[sc]e", r"isc"),
    "mpl": ("mozilla", r"mozilla public licen[sc]e", r"mpl"),
    "mpl-1.1": ("mozilla", rf"mozilla public licen[sc]e{V} v?1 1", r"mpl 1 1"),
    "mpl-2.0": ("mozilla", rf"mozilla public licen[sc]e{V} v?2(?: 0)?", r"mpl 2(?: 0)?"),
    "epl": ("eclipse", r"eclipse public licen[sc]e", r"epl"),
    "epl-1.0": ("eclipse", rf"eclipse public licen[sc]e{V} v?1(?: 0)?", r"epl 1 0"),
    "epl-2.0": ("eclipse", rf"eclipse public licen[sc]e{V} v?2(?: 0)?", r"epl 2 0"),
    "cddl": ("common development", r"common development and distribution licen[sc]e(?: 1 [01])?", r"cddl(?: 1 [01])?"),
    "cpl-1.0": ("common public", rf"common public licen[sc]e(?:{V} v?1(?: 0)?)?", r"cpl 1 0"),
    "eupl": ("european union public", rf"european union public licen[sc]e(?:{V} v?1 [0-2])?", r"eupl(?: 1 [0-2])?"),
    "artistic": ("artistic", rf"artistic licen[sc]e(?:{V} v?[12](?: 0)?)?", r"artistic [12] 0"),
    "bsl-1.0": ("boost", rf"boost software licen[sc]e(?:{V} v?1(?: 0)?)?", r"bsl 1 0"),
    "zlib": ("zlib", r"zlib(?: libpng)? licen[sc]e", r"zlib"),
    "unlicense": ("unlicen", r"(?:the )?unlicense", r"unlicense"),
    "wtfpl": ("what the", r"do what the f\w+ you want to public licen[sc]e", r"wtfpl"),
    "cc0-1.0": ("cc0", r"cc0(?: 1 0)?(?: universal)?|creative commons(?: cc0| zero)(?: 1 0)?(?: universal)?", r"cc0 1 0"),
    "cc-by": ("cc by", r"cc by(?: [1-4] \d)?|creative commons attribution(?: [1-4] \d)?", r"cc by [1-4] \d"),
    "cc-by-sa": ("cc by", r"cc by sa(?: [1-4] \d)?|creative commons attribution share ?alike(?: [1-4] \d)?", r"cc by sa [1-4] \d"),
    "cc-by-nd": ("cc by", r"cc by nd(?: [1-4] \d)?|creative commons attribution no ?deriv\w+(?: [1-4] \d)?", r"cc by nd [1-4] \d"),
    "cc-by-nc": ("cc by", r"cc by nc(?: [1-4] \d)?|creative commons attribution non ?commercial(?: [1-4] \d)?", r"cc by nc [1-4] \d"),
    "cc-by-nc-sa": ("cc by", r"cc by nc sa(?: [1-4] \d)?|creative commons attribution non ?commercial share ?alike(?: [1-4] \d)?", r"cc by nc sa [1-4] \d"),
    "cc-by-nc-nd": ("cc by", r"cc by nc nd(?: [1-4] \d)?|creative commons attribution non ?commercial no ?deriv\w+(?: [1-4] \d)?", r"cc by nc nd [1-4] \d"),
    "odbl": ("open database", r"open(?: data commons)? (?:open )?database licen[sc]e(?: 1 0)?", r"odbl 1 0"),
    "ofl": ("open font", r"(?:sil )?open font licen[sc]e(?: (?:version )?1 [01])?", r"ofl 1 [01]"),
    "psf": ("python software", r"python software foundation licen[sc]e(?: (?:version )?2(?: 0)?)?", r"(?:psf|python) 2 0"),
    "postgresql": ("postgresql", r"postgresql licen[sc]e", r"postgresql"),
    "openssl": ("openssl", r"openssl licen[sc]e", r"openssl"),
    "ncsa": ("ncsa", r"(?:university of illinois )?ncsa(?: open source)? licen[sc]e", r"ncsa"),
    "vim": ("vim", r"vim licen[sc]e", r"vim"),
    "sspl": ("server side", rf"server side public licen[sc]e(?:{V} v?1)?", r"sspl 1 0"),
    "busl": ("business source", r"business source licen[sc]e(?: 1 1)?", r"busl 1 1"),
    "openrail": ("openrail", r"(?:creativeml |bigscience )?openrail(?: m)?(?: licen[sc]e)?", r"open ?rail"),
}
GRANT = (r"(?:(?:dual )?licen[sc]ed|released|distributed|available|published|provided|covered|"
         r"made available|redistribut\w+)(?: \S+){0,4}? under(?: the(?: terms(?: and conditions)? of(?: the)?)?)?")
#: Rules beyond names: texts and notices of licenses.
TEXTS = (
    ("mit", 3, "free of charge", r"permission is hereby granted free of charge to any person obtaining a copy"),
    ("mit", 2, "substantial portions", r"shall be included in all copies or substantial portions of the software"),
    ("isc", 3, "with or without fee", r"permission to use copy modify and (?:or )?distribute this software for any purpose with or without fee"),
    ("bsd", 2, "redistribution and use", r"redistribution and use in source and binary forms with or without modification"),
    ("bsd-3-clause", 3, "neither the name", r"neither the name of .{1,200}? nor the names of its contributors may be used"),
    ("bsd-4-clause", 3, "advertising materials", r"all advertising materials mentioning features or use of this software"),
    ("gpl", 2, "free software", r"this program is free software you can redistribute it and or modify it"),
    ("zlib", 2, "altered source versions", r"altered source versions must be plainly marked as such"),
    ("unlicense", 3, "unencumbered", r"this is free and unencumbered software released into the public domain"),
    ("public-domain", 2, "public domain", r"(?:released|placed|dedicated|is|are) (?:in|into|to) the public domain"),
    ("public-domain", 1, "public domain", r"public domain"),
    ("apache-2.0", 3, "www apache org", r"www apache org licenses license 2 0"),
    ("gpl", 2, "www gnu org", r"www gnu org licenses(?: gpl)?"),
    ("mpl-2.0", 3, "mozilla org mpl", r"mozilla org mpl 2 0"),
    ("cc-by", 2, "creativecommons org", r"creativecommons org licenses by \d \d"),
    ("cc-by-sa", 2, "creativecommons org", r"creativecommons org licenses by sa \d \d"),
    ("cc-by-nc", 2, "creativecommons org", r"creativecommons org licenses by nc \d \d"),
    ("cc0-1.0", 2, "creativecommons org", r"creativecommons org publicdomain zero 1 0"),
    ("proprietary", 2, "all rights reserved", r"all rights reserved"),
    ("proprietary", 3, "proprietary", r"proprietary and confidential"),
)
_FIRST = {"cc by": ("cc by", "creative commons"), "cc0": ("cc0", "creative commons")}
#: Further names, each behind its own keyword.
_OTHER = {
    "bsd-2-clause": ("freebsd", r"freebsd(?: licen[sc]e)?"),
    "openrail": ("open rail", r"(?:creativeml |bigscience )?open rail(?: m)?(?: licen[sc]e)?"),
}
#: Keywords and forms of the tags in a grant; by default the label's first word, and the tag.
#: Names that match their own tag need none.
_GRANTED = {"psf": (("psf", "psf 2 0"), ("python", "python 2 0"))} | dict.fromkeys(
    ("mit", "unlicense", "openrail", *(n for n in NAMES if n.startswith("cc"))), ())


def _rules() -> tuple[Rule, ...]:
    out = [Rule(label, 1, phrase.split()[0], phrase) for label, phrase in BASE]
    for label, (word, name, tag) in NAMES.items():
        out.append(Rule(label, 4, "spdx", rf"spdx license identifier (?:{tag})"))
        out.append(Rule(label, 3, "licen", rf"licen[sc]e (?:{tag})"))
        names = [(keyword, name) for keyword in _FIRST.get(word, (word,))]
        for keyword, form in names + [_OTHER[n] for n in (label,) if n in _OTHER]:
            out.append(Rule(label, 3, keyword, rf"{GRANT} (?:the )?(?:{form})"))
            out.append(Rule(label, 2, keyword, rf"(?:{form})" if label != "mit" else "mit license"))
        for keyword, form in _GRANTED.get(label, ((label.split("-")[0], tag),)):
            out.append(Rule(label, 3, keyword, rf"{GRANT} (?:the )?(?:gnu )?(?:{form})"))
    return tuple(out + [Rule(*t) for t in TEXTS])


#: In order; hundreds, as each license has its tag, field, grant and name rules.
RULES = _rules()
HIT = "array<struct<start:int,order:int,end:int,label:string,level:int>>"


def words(text: Column) -> Column:
    """The words of a text, one space between; A-Z as they are."""
    return F.trim(F.regexp_replace(F.coalesce(text, F.lit("")), SEPARATORS, " "))


def lowered(text: Column) -> Column:
    up = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.translate(text, up, up.lower())


def _spaces(text: Column) -> Column:
    return F.length(text) - F.length(F.replace(text, F.lit(" "), F.lit("")))


def bounded(pattern: Column) -> Column:
    return F.concat(F.lit("(?<![^ ])(?:"), pattern, F.lit(")(?![^ ])"))


def starts(norm: Column, pattern: Column, found: Column | None = None) -> Column:
    """Matches between word boundaries: index of the first word, and of the word
    after the last, by counting the spaces of the matches (``found``, if they are
    known) and the gaps."""
    if found is None:
        found = F.regexp_extract_all(norm, bounded(pattern), F.lit(0))
    zipped = F.zip_with(F.transform(F.split(norm, bounded(pattern), -1), _spaces),
                        F.transform(found, _spaces),
                        lambda g, m: F.struct(g.alias("gap"), m.alias("size")))
    return F.aggregate(
        F.slice(zipped, F.lit(1), F.size(found)),
        F.struct(F.lit(0).alias("at"),
                 F.array().cast("array<struct<start:int,end:int>>").alias("hits")),
        lambda s, m: F.struct(
            (s["at"] + m["gap"] + m["size"]).alias("at"),
            F.concat(s["hits"], F.array(F.struct(
                (s["at"] + m["gap"]).alias("start"),
                (s["at"] + m["gap"] + m["size"] + 1).alias("end")))).alias("hits")),
        lambda s: s["hits"])


RULE = "array<struct<order:int,label:string,level:int,pattern:string>>"


def _table(rules: list[tuple[int, Rule]]) -> Column:
    return F.array(*[F.struct(
        F.lit(i).alias("order"), F.lit(r.label).alias("label"), F.lit(r.level).alias("level"),
        F.lit(r.pattern).alias("pattern")) for i, r in rules])


def live(norm: Column, rules: tuple[Rule, ...]) -> Column:
    """The rules of the keywords that occur together with a match of any of their
    rules.  Keywords and patterns are literals: compiled once, each read once."""
    groups: dict[str, list[tuple[int, Rule]]] = {}
    for i, r in enumerate(rules):
        groups.setdefault(r.keyword, []).append((i, r))
    return F.flatten(F.array(*[
        F.when(F.contains(norm, F.lit(word)) & F.regexp_like(norm, F.lit(
            f"(?<![^ ])(?:{'|'.join(dict.fromkeys(r.pattern for _, r in own))})(?![^ ])")), _table(own))
        .otherwise(F.array().cast(RULE)) for word, own in groups.items()]))


def detect(norm: Column, rules: tuple[Rule, ...] = RULES) -> Column:
    """All detections in a lowered word text, ordered by start, longest and
    highest priority first."""
    matched = F.filter(F.transform(live(norm, rules), lambda r: F.struct(
        r.alias("rule"), F.regexp_extract_all(norm, bounded(r["pattern"]), F.lit(0)).alias("found"))),
        lambda m: F.size(m["found"]) > 0)
    hits = F.flatten(F.transform(matched, lambda m: F.transform(
        starts(norm, m["rule"]["pattern"], m["found"]), lambda h: F.struct(
            h["start"].alias("start"), (-h["end"]).alias("back"), (-m["rule"]["level"]).alias("down"),
            m["rule"]["order"].alias("order"), h["end"].alias("end"), m["rule"]["label"].alias("label"),
            m["rule"]["level"].alias("level")))))
    return F.transform(F.array_sort(hits), lambda h: F.struct(
        h["start"], h["order"], h["end"], h["label"], h["level"]))


def resolve(hits: Column) -> Column:
    """Suppresses what lies inside a detection of at least its priority.

    The hits come by start, longest first, so what contains a hit has been
    seen: it is enough to keep, per priority, how far any hit has reached.
    """
    levels = range(1, 5)

    def step(s, h):
        inside = F.lit(False)
        for v in levels:
            inside = inside | ((h["level"] <= v) & (s["reach"][v - 1] >= h["end"]))
        reach = F.array(*[F.when(h["level"] == v, F.greatest(s["reach"][v - 1], h["end"]))
                          .otherwise(s["reach"][v - 1]) for v in levels])
        return F.struct(reach.alias("reach"), F.when(inside, s["kept"]).otherwise(
            F.concat(s["kept"], F.array(h))).alias("kept"))

    zero = F.struct(F.array(*[F.lit(-1) for _ in levels]).alias("reach"),
                    F.array().cast(HIT).alias("kept"))
    return F.aggregate(hits, zero, step, lambda s: s["kept"])


def gate(rules: tuple[Rule, ...]) -> str:
    """Finds any rule's keyword at the start of a word.  Alternatives are grouped
    by first letter, so most words are passed after one look."""
    heads: dict[str, set[str]] = {}
    for r in rules:
        heads.setdefault(r.keyword[0], set()).add(r.keyword[1:])
    return "(?i)(?<![^ ])(?=[" + "".join(sorted(heads)) + "])(?:" + "|".join(
        f"{c}(?:{'|'.join(sorted(rest))})" for c, rest in sorted(heads.items())) + ")"


def scan(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """doc_id, n_words, base (starts and labels of the base phrases) and
    detections (resolved) of every row of ``docs`` (doc_id, text)."""
    norm = docs.select("doc_id", words(F.col("text")).alias("norm"))
    sized = norm.select(
        "doc_id", F.when(F.col("norm") == "", 0).otherwise(_spaces(F.col("norm")) + 1)
        .cast("long").alias("n_words"),
        F.when(F.regexp_like("norm", F.lit(gate(rules))), lowered(F.col("norm"))).alias("norm"))
    none = F.array().cast(HIT)
    def places(label, phrase):
        return F.transform(starts(F.col("norm"), F.lit(phrase)), lambda h: F.struct(
            h["start"].alias("start"), F.lit(label).alias("label")))

    base = F.flatten(F.array(*[places(*b) for b in BASE]))
    has_base = F.contains("norm", F.lit(" license")) & F.col("norm").isNotNull()
    return sized.select(
        "doc_id", "n_words",
        F.when(has_base, base).otherwise(F.array().cast("array<struct<start:int,label:string>>"))
        .alias("base"),
        F.when(F.col("norm").isNull(), none).otherwise(resolve(detect(F.col("norm"), rules)))
        .alias("detections"))


def op10_license_scan(spark, sf_dir):
    """Words, base places and labels of every document; ``score`` is the
    confidence of the strongest detection (a quarter per priority level)."""
    found = scan(table(spark, sf_dir, "documents").select("doc_id", "text"))
    at = F.transform("base", lambda b: b["start"].cast("long"))
    base = F.transform("base", lambda b: b["label"])
    own = F.transform("detections", lambda d: d["label"])
    joined = lambda a: F.concat_ws(",", F.array_sort(F.array_distinct(a)))
    return found.select(
        "doc_id", "n_words", F.size("base").cast("long").alias("n_base"),
        F.array_min(at).alias("first_word"), F.array_max(at).alias("last_word"),
        joined(base).alias("base_labels"), joined(F.concat(base, own)).alias("labels"),
        F.coalesce(F.array_max(F.transform("detections", lambda d: d["level"] / F.lit(4.0))),
                   F.lit(0.0)).alias("score"))
