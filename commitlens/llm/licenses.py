"""License statements found by ordered signature rules, with built-in functions only."""

from __future__ import annotations

import json
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from commitlens.llm.scans import largest_before, sums_before

# Characters of a word, once A-Z are lower-cased.
_WORD, _RAW_WORD = r"[0-9a-z\x{80}-\x{10FFFF}]", r"[0-9A-Za-z\x{80}-\x{10FFFF}]"
_GAP = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]"
_RAW_GAP = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]"


class Rule(NamedTuple):
    """One signature over a text's words joined by single spaces.

    ``keyword`` stands in every match, so a text without it is never searched. ``tier`` orders the
    rules: of two detections one of which contains the other, the lower tier wins, then the longer one.
    """

    keyword: str
    pattern: str
    label: str
    tier: int
    confidence: float


# Phrases whose words must stand one after the other, and what they are called.
BASE = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}

# Families of licenses: label, keyword, how the name is written, and the versions there are. A
# version is written "v 2 0", "version 2", "2 0" or "v2"; a zero at its end may be left out.
FAMILIES = [
    ("gpl", "general public", r"(?:gnu )?general public licen[sc]e", ("1.0", "2.0", "3.0")),
    ("gpl", "gpl", r"(?:gnu )?gpl", ("1.0", "2.0", "3.0")),
    ("lgpl", "general public", r"(?:gnu )?(?:lesser|library) general public licen[sc]e", ("2.0", "2.1", "3.0")),
    ("lgpl", "lgpl", r"(?:gnu )?lgpl", ("2.0", "2.1", "3.0")),
    ("agpl", "general public", r"(?:gnu )?affero general public licen[sc]e", ("1.0", "3.0")),
    ("agpl", "agpl", r"(?:gnu )?agpl", ("1.0", "3.0")),
    ("gfdl", "free documentation", r"(?:gnu )?free documentation licen[sc]e", ("1.1", "1.2", "1.3")),
    ("gfdl", "fdl", r"(?:gnu )?g?fdl", ("1.1", "1.2", "1.3")),
    ("apache", "apache", r"apache(?: software)? licen[sc]e|apache", ("1.0", "1.1", "2.0")),
    ("mpl", "mozilla", r"mozilla public licen[sc]e", ("1.0", "1.1", "2.0")),
    ("epl", "eclipse", r"eclipse public licen[sc]e", ("1.0", "2.0")),
    ("eupl", "european", r"european union public licen[sc]e", ("1.0", "1.1", "1.2")),
    ("cddl", "common development", r"common development and distribution licen[sc]e", ("1.0", "1.1")),
    ("cpl", "common public", r"common public licen[sc]e", ("1.0",)),
    ("osl", "open software", r"open software licen[sc]e", ("1.0", "2.0", "2.1", "3.0")),
    ("afl", "academic free", r"academic free licen[sc]e", ("1.2", "2.0", "2.1", "3.0")),
    ("artistic", "artistic", r"artistic licen[sc]e", ("1.0", "2.0")),
    ("ofl", "open font", r"(?:sil )?open font licen[sc]e", ("1.0", "1.1")),
    ("bsl", "boost", r"boost software licen[sc]e", ("1.0",)),
    ("busl", "business source", r"business source licen[sc]e", ("1.0", "1.1")),
    ("php", "php", r"php licen[sc]e", ("3.0", "3.1")),
    ("python", "python", r"python(?: software foundation)? licen[sc]e", ("2.0",)),
    ("lppl", "latex", r"latex project public licen[sc]e", ("1.0", "1.2", "1.3")),
    ("ecl", "educational community", r"educational community licen[sc]e", ("1.0", "2.0")),
    ("apsl", "apple public", r"apple public source licen[sc]e", ("1.0", "2.0")),
    ("upl", "universal permissive", r"universal permissive licen[sc]e", ("1.0",)),
    ("odbl", "open database", r"(?:odc )?open database licen[sc]e", ("1.0",)),
    ("odc-by", "open data commons", r"open data commons attribution licen[sc]e", ("1.0",)),
    ("cecill", "cecill", r"cecill(?: free software licen[sc]e)?(?: agreement)?", ("1.0", "2.0", "2.1")),
    ("sspl", "server side public", r"server side public licen[sc]e", ("1.0",)),
    ("cc-by", "attribution", r"creative commons attribution", ("1.0", "2.0", "2.5", "3.0", "4.0")),
    ("cc-by", "cc by", r"cc by", ("1.0", "2.0", "2.5", "3.0", "4.0")),
    ("cc-by-sa", "attribution", r"creative commons attribution share ?alike", ("1.0", "2.0", "2.5", "3.0", "4.0")),
    ("cc-by-sa", "cc by", r"cc by sa", ("1.0", "2.0", "2.5", "3.0", "4.0")),
    ("cc-by-nd", "attribution", r"creative commons attribution no ?deriv(?:ative)?s?(?: works)?", ("1.0", "2.0", "2.5", "3.0", "4.0")),
    ("cc-by-nd", "cc by", r"cc by nd", ("1.0", "2.0", "2.5", "3.0", "4.0")),
    ("cc-by-nc", "attribution", r"creative commons attribution non ?commercial", ("1.0", "2.0", "2.5", "3.0", "4.0")),
    ("cc-by-nc", "cc by", r"cc by nc", ("1.0", "2.0", "2.5", "3.0", "4.0")),
    ("cc-by-nc-sa", "attribution", r"creative commons attribution non ?commercial share ?alike", ("1.0", "2.0", "2.5", "3.0", "4.0")),
    ("cc-by-nc-sa", "cc by", r"cc by nc sa", ("1.0", "2.0", "2.5", "3.0", "4.0")),
    ("cc-by-nc-nd", "attribution", r"creative commons attribution non ?commercial no ?deriv(?:ative)?s?(?: works)?", ("1.0", "2.0", "2.5", "3.0", "4.0")),
    ("cc-by-nc-nd", "cc by", r"cc by nc nd", ("1.0", "2.0", "2.5", "3.0", "4.0")),
    ("cc0", "cc0", r"(?:creative commons )?(?:cc0|cc0 universal|cc0 public domain dedication)", ("1.0",)),
    ("zpl", "zope", r"zope public licen[sc]e", ("1.1", "2.0", "2.1")),
    ("ms-pl", "microsoft public", r"microsoft public licen[sc]e", ()),
    ("ms-rl", "microsoft reciprocal", r"microsoft reciprocal licen[sc]e", ()),
    ("mit", "mit", r"(?:the )?mit(?: x11)? licen[sc]e|mit x11", ()),
    ("mit", "x11 licen", r"x11 licen[sc]e", ()),
    ("mit", "expat", r"expat licen[sc]e", ()),
    ("bsd", "bsd", r"bsd(?: style)? licen[sc]e", ()),
    ("bsd-2-clause", "bsd", r"(?:simplified|freebsd|2 clause|two clause) bsd(?: licen[sc]e)?|bsd 2 clause(?: licen[sc]e)?", ()),
    ("bsd-3-clause", "bsd", r"(?:new|revised|modified|3 clause|three clause) bsd(?: licen[sc]e)?|bsd 3 clause(?: licen[sc]e)?", ()),
    ("bsd-4-clause", "bsd", r"(?:original|4 clause|four clause) bsd(?: licen[sc]e)?|bsd 4 clause(?: licen[sc]e)?", ()),
    ("isc", "isc", r"isc licen[sc]e", ()),
    ("zlib", "zlib", r"zlib(?: libpng)? licen[sc]e", ()),
    ("unlicense", "unlicense", r"(?:the )?unlicense", ()),
    ("wtfpl", "wtfpl", r"wtfpl", ()),
    ("ncsa", "ncsa", r"(?:university of illinois )?ncsa(?: open source)? licen[sc]e", ()),
    ("postgresql", "postgresql", r"postgresql licen[sc]e", ()),
    ("openssl", "openssl", r"openssl licen[sc]e", ()),
    ("ruby", "ruby", r"ruby licen[sc]e", ()),
    ("vim", "vim", r"vim licen[sc]e", ()),
    ("sleepycat", "sleepycat", r"sleepycat licen[sc]e", ()),
    ("beerware", "beer", r"beer ?ware licen[sc]e", ()),
]

# Sentences of license texts and of notices that name none.
SENTENCES = [
    ("permission is hereby granted", r"permission is hereby granted free of charge to any person obtaining a copy", "mit", 1, 0.95),
    ("permission to use", r"permission to use copy modify and or distribute this software for any purpose", "isc", 1, 0.95),
    ("redistribution and use", r"redistribution and use in source and binary forms with or without modification are permitted", "bsd", 1, 0.95),
    ("neither the name", r"neither the name of (?:[^ ]+ ){1,12}nor the names of its contributors may be used", "bsd-3-clause", 1, 0.9),
    ("advertising materials", r"all advertising materials mentioning features or use of this software must display", "bsd-4-clause", 1, 0.9),
    ("verbatim copies", r"everyone is permitted to copy and distribute verbatim copies of this licen[sc]e document", "gpl", 1, 0.8),
    ("either version", r"either version 2 of the licen[sc]e or (?:at your option )?any later version", "gpl-2.0", 1, 0.9),
    ("either version", r"either version 3 of the licen[sc]e or (?:at your option )?any later version", "gpl-3.0", 1, 0.9),
    ("you may not use this file", r"you may not use this file except in compliance with the licen[sc]e", "apache-2.0", 1, 0.8),
    ("subject to the terms of the mozilla", r"subject to the terms of the mozilla public licen[sc]e v 2 0", "mpl-2.0", 1, 0.95),
    ("public domain", r"(?:released|placed|dedicated) (?:in|into|to) the public domain", "public-domain", 1, 0.9),
    ("unencumbered software", r"this is free and unencumbered software released into the public domain", "unlicense", 1, 0.95),
    ("altered source versions", r"altered source versions must be plainly marked as such", "zlib", 1, 0.9),
    ("do what the fuck", r"do what the fuck you want to public licen[sc]e", "wtfpl", 1, 0.95),
    ("all rights reserved", r"(?:copyright (?:c )?(?:[0-9]{4} )?(?:[^ ]+ ){0,6})?all rights reserved", "proprietary", 3, 0.4),
    ("may not be reproduced", r"may not be reproduced (?:[^ ]+ ){0,10}without (?:the )?(?:prior )?(?:written )?permission", "proprietary", 2, 0.6),
]

_GRANT = (
    r"(?:this (?:work|software|file|program|document|text) is )?"
    r"(?:licen[sc]ed|released|distributed|available|published|shared|provided|redistributable)(?: to you)?"
    r" under (?:the )?(?:terms (?:and conditions )?of (?:the )?|conditions of (?:the )?)?"
)


def _version(number: str) -> str:
    major, minor = number.split(".")
    tail = "(?: 0)?" if minor == "0" else f" {minor}"
    return rf"(?: (?:international|unported|generic))?(?: licen[sc]e)? (?:version |v ?)?{major}{tail}(?: only| or later| international| unported)?"


def rules() -> list[Rule]:
    """All rules in order: identifiers, notices and sentences, names with a version, bare names."""
    made = [Rule(*s) for s in SENTENCES]
    for label, keyword, name, versions in FAMILIES:
        for number in versions:
            ident, exact = f"{label} {number}".replace("-", " ").replace(".", " "), f"{label}-{number}"
            full = rf"(?:{name}){_version(number)}"
            made.append(Rule("spdx", rf"spdx licen[sc]e identifier {ident}(?: only| or later)?", exact, 0, 1.0))
            made.append(Rule(keyword, _GRANT + full, exact, 1, 0.95))
            made.append(Rule(keyword, full, exact, 2, 0.85))
        plain = label.replace("-", " ").replace(".", " ")
        made.append(Rule("spdx", rf"spdx licen[sc]e identifier {plain}", label, 0, 1.0))
        made.append(Rule(keyword, rf"{_GRANT}(?:{name})(?: licen[sc]e)?", label, 1, 0.9))
        if label != "apache":
            made.append(Rule(keyword, name, label, 3, 0.6))
    # Spellings of one family share their identifiers.
    return sorted(dict.fromkeys(made), key=lambda r: r.tier)


# What a text must hold, in any case and at the beginning of a word, for a rule or a base phrase to
# be tried at all.
GATE = (
    "licen[sc]|spdx|unlicense|[al]?gpl|g?fdl|apache|cc0|wtfpl|cecill|mit x11|unencumbered|public domain"
    "|all rights reserved|permission|redistribution and use|neither the name|advertising materials"
    "|verbatim copies|either version|altered source versions|do what the fuck|you may not use"
    "|may not be reproduced|creative commons attribution|[234] clause bsd|(?:new|revised|modified|original"
    "|simplified|freebsd|two clause|three clause|four clause) bsd|bsd [234] clause|cc by"
)
# The letters and digits it may begin with, looked at first.
_GATE_STARTS = "(?=[abcdefglmnoprstuvwy234])"

_FOUND = "struct<start:bigint,end:bigint,tier:int,number:int,label:string,confidence:double>"


def _spaces(c: str) -> str:
    return f"(length({c}) - length(replace({c}, ' ', '')))"


def _places(text: str, rule: str) -> str:
    """SQL: all non-overlapping matches of ``rule`` in ``text``, with the words they begin and end at."""
    pattern = f"concat('(?<![^ ])(?:', {rule}.pattern, ')(?![^ ])')"
    # Before a match stand the spaces of all pieces and matches before it.
    starts = sums_before(f"zip_with(hits, slice(pieces, 1, size(hits)), (h, p) -> cast({_spaces('p')} + {_spaces('h')} AS bigint))")
    return f"""transform(array(regexp_extract_all({text}, {pattern}, 0)), hits -> IF(size(hits) = 0, cast(array() AS array<{_FOUND}>),
        transform(array(split({text}, {pattern}, -1)), pieces -> zip_with(
            zip_with(hits, slice(pieces, 1, size(hits)), (h, p) -> named_struct('hit', h, 'piece', p)), {starts},
            (x, at) -> named_struct(
                'start', cast(at + {_spaces("x.piece")} AS bigint),
                'end', cast(at + {_spaces("x.piece")} + {_spaces("x.hit")} + 1 AS bigint),
                'tier', {rule}.tier, 'number', {rule}.number,
                'label', {rule}.label, 'confidence', {rule}.confidence)))[0]))[0]"""


def _table(made: list[Rule]) -> str:
    """SQL for the rules as an array literal."""
    rows = [r._asdict() | {"number": i} for i, r in enumerate(made)]
    kind = "array<struct<keyword:string,pattern:string,label:string,tier:int,confidence:double,number:int>>"
    text = json.dumps(rows).replace("\\", "\\\\").replace("'", "\\'")
    return f"from_json('{text}', '{kind}')"


def _detect(text: str, made: list[Rule]) -> str:
    """SQL: detections of all rules whose keyword ``text`` holds, by place, the containing one first."""
    return f"""array_sort(
        flatten(transform(
            filter({_table(made)}, r -> contains({text}, r.keyword)), r -> {_places(text, "r")})),
        (a, b) -> CASE WHEN a.start <> b.start THEN IF(a.start < b.start, -1, 1)
            WHEN a.end <> b.end THEN IF(a.end > b.end, -1, 1)
            WHEN a.tier <> b.tier THEN IF(a.tier < b.tier, -1, 1)
            ELSE IF(a.number < b.number, -1, IF(a.number > b.number, 1, 0)) END)"""


def _suppress(found: str) -> str:
    """SQL: sorted detections without those that lie in one of their own or a better tier.

    Whatever contains a detection stands before it, so the farthest end so far of each tier decides.
    """
    # Ends so far of a tier's and all better ones' detections.
    reach = [largest_before(f"transform(all, d -> IF(d.tier <= {t}, d.end, -1L))") for t in range(4)]
    best = reach[0]
    for t in range(1, 4):
        best = f"zip_with({best}, {reach[t]}, (x, y) -> {'array(x, y)' if t == 1 else 'concat(x, array(y))'})"
    kept = f"filter(zip_with(all, {best}, (d, e) -> named_struct('d', d, 'inside', e[d.tier] >= d.end)), x -> NOT x.inside)"
    return f"transform(array({found}), all -> IF(size(all) < 2, all, transform({kept}, x -> x.d)))[0]"


def words_of(text: Column) -> Column:
    """The text's words, A-Z lower-cased, joined by single spaces."""
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    return F.trim(F.regexp_replace(F.translate(text, upper, lower), f"{_GAP}+", " "))


def word_count(text: Column) -> Column:
    """How many words a text has: every word becomes one letter and what is between them nothing."""
    counted = F.length(F.regexp_replace(text, f"{_RAW_GAP}*+{_RAW_WORD}++{_RAW_GAP}*+", "x"))
    return F.when(text.rlike(_RAW_WORD), counted).otherwise(0).cast("long")


def license_scan(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(id, n_words, base, found): base phrases and rule detections of every whole text.

    ``base`` has (start, end, label) of every place where a phrase's words stand one after the other;
    ``found`` has the detections that are left after suppression, in order, words counted from 0. Only texts that pass the keyword gate
    are cut into words, and only rules whose own keyword they hold are tried. One narrow pass of
    built-in functions: nothing is shuffled and a hot source or a copied text costs nothing extra.
    A null text counts as empty, repeated rows give repeated rows, a null id stays null, an empty
    table gives no rows, and other columns are not read.
    """
    gate = f"(?i)(?<!{_RAW_WORD}){_GATE_STARTS}(?:{GATE.replace(' ', f'{_RAW_GAP}+')})"
    text = F.coalesce(F.col(text_column), F.lit(""))
    base = [Rule(p, p, label, 0, 0.8) for p, label in BASE.items()]
    picked = docs.select(F.col(id_column), text.alias("text"))
    gated = picked.select(
        id_column,
        word_count(F.col("text")).alias("n_words"),
        F.when(F.col("text").rlike(gate), words_of(F.col("text"))).alias("words"),
    )
    none = f"cast(array() AS array<{_FOUND}>)"
    return gated.select(
        id_column,
        "n_words",
        F.expr(f"IF(words IS NULL, {none}, {_detect('words', base)})").alias("base"),
        F.expr(f"IF(words IS NULL, {none}, {_suppress(_detect('words', rules()))})").alias("found"),
    )


def license_labels(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(id, n_words, n_base, first_word, last_word, base_labels, labels, score) of ``license_scan``.

    The score is the chance that at least one detection is right, were they independent; 0 without any.
    """
    names = "array_join(array_sort(array_distinct(transform({0}, x -> x.label))), ',')"
    every = "concat(base, found)"
    return license_scan(docs, id_column, text_column).select(
        id_column,
        "n_words",
        F.size("base").cast("long").alias("n_base"),
        F.expr("array_min(transform(base, x -> x.start))").alias("first_word"),
        F.expr("array_max(transform(base, x -> x.start))").alias("last_word"),
        F.expr(names.format("base")).alias("base_labels"),
        F.expr(names.format(every)).alias("labels"),
        F.expr(f"round(1 - aggregate({every}, 1D, (p, x) -> p * (1 - x.confidence)), 6)").alias("score"),
    )
