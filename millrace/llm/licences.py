"""Licence scans by sentence rules.

A text's sentences are normalised and mapped to identifiers of known licence sentences; then the
sequence of identifiers is matched against ordered licence rules. Known are the usual notices, one-line
grants, SPDX tags, and full licence texts by their titles or opening sentences.

Only rows with a word that some known sentence needs go to Python; the rest never leave the JVM.
The words are taken from the sentences: of each the longest word that it cannot do without.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Normalised sentences (lower case, no punctuation) by identifier. "{1}" in an
# identifier stands for what the first group matched.
SENTENCES = (
    ("spdx={1}", r"spdx-license-identifier ([a-z0-9.+-]+(?: (?:or|and|with) [a-z0-9.+-]+)*)"),
    ("mit-grant", r"permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files"),
    ("mit-condition", r"the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software"),
    ("as-is", r"(?:the|this) software is provided (?:by .{0,80} )?as[- ]is"),
    ("no-liability", r"in no event shall .{0,120}be liable"),
    ("bsd-grant", r"redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met"),
    ("bsd-source", r"redistributions of source code must retain the above copyright notice"),
    ("bsd-binary", r"redistributions in binary form must reproduce the above copyright notice"),
    ("bsd-endorse", r"neither the names? of .{0,120}may be used to endorse or promote products"),
    ("bsd-advert", r"all advertising materials mentioning features or use of this software must display"),
    ("isc-grant", r"permission to use copy modify and/?(?:or)? distribute this software for any purpose with or without fee is hereby granted"),
    ("zlib-as-is", r"this software is provided as-is without any express or implied warranty"),
    ("zlib-origin", r"the origin of this software must not be misrepresented"),
    ("zlib-altered", r"altered source versions must be plainly marked as such"),
    ("zlib-notice", r"this notice may not be removed or altered from any source distribution"),
    ("apache-notice", r"licensed under the apache licen[cs]e version 2(?:\.0)?"),
    ("apache-use", r"you may not use this file except in compliance with the licen[cs]e"),
    ("apache-copy", r"you may obtain a copy of the licen[cs]e at"),
    ("apache-law", r"unless required by applicable law or agreed to in writing software distributed under the licen[cs]e is distributed on an as is basis"),
    ("gnu-fixed={1}={2}+", r"you can redistribute it and/or modify it under the terms of the gnu ((?:lesser |library |affero )?general) public licen[cs]e v(?:ersion)? ?([0-9](?:\.[0-9])?)(?: of the licen[cs]e)? or (?:at your option )?(?:any )?later"),
    ("gnu-fixed={1}={2}", r"you can redistribute it and/or modify it under the terms of the gnu ((?:lesser |library |affero )?general) public licen[cs]e v(?:ersion)? ?([0-9](?:\.[0-9])?)"),
    ("gnu-fixed={2}={1}", r"you can redistribute it and/or modify it under the terms of version ([0-9](?:\.[0-9])?) of the gnu ((?:lesser |library |affero )?general) public licen[cs]e"),
    ("gnu-free={1}", r"you can redistribute it and/or modify it under the terms of the gnu ((?:lesser |library |affero )?general) public licen[cs]e"),
    ("gnu-version={1}+", r"(?:either )?version ([0-9.]+) of the licen[cs]e or (?:at your option )?any later version"),
    ("gnu-version={1}+", r"either version ([0-9.]+) or (?:at your option )?any later version"),
    ("gnu-only={1}", r"version ([0-9.]+) of the licen[cs]e"),
    ("gnu-hope", r"distributed in the hope that it will be useful but without any warranty"),
    ("gnu-see", r"see the gnu (?:lesser |library |affero )?general public licen[cs]e for more details"),
    ("gnu-copy", r"you should have received a copy of the gnu"),
    ("gnu-line={1}={2}+", r"(?:licen[cs]ed|released|distributed|available)(?: is)? under(?: the terms of)? the gnu ((?:lesser |library |affero )?general) public licen[cs]e v(?:ersion)? ?([0-9](?:\.[0-9])?) or (?:at your option )?(?:any )?later"),
    ("gnu-line={1}={2}", r"(?:licen[cs]ed|released|distributed|available)(?: is)? under(?: the terms of)? the gnu ((?:lesser |library |affero )?general) public licen[cs]e v(?:ersion)? ?([0-9](?:\.[0-9])?)"),
    ("gnu-title={1}={2}", r"gnu ((?:lesser |library |affero )?general) public licen[cs]e version ([0-9](?:\.[0-9])?) (?:[0-9]{1,2} )?(?:february|june|november) [0-9]{4}"),
    ("gnu-verbatim", r"everyone is permitted to copy and distribute verbatim copies of this licen[cs]e document"),
    ("gpl-short={1}={2}+", r"(?:licen[cs]ed|released|distributed|available) under(?: the)?(?: terms of the)? ([al]?)gpl[- ]?v?(?:ersion)? ?([0-9](?:\.[0-9])?)(?:\+|[- ]or[- ](?:any )?later)"),
    ("gpl-short={1}={2}", r"(?:licen[cs]ed|released|distributed|available) under(?: the)?(?: terms of the)? ([al]?)gpl[- ]?v?(?:ersion)? ?([0-9](?:\.[0-9])?)"),
    ("apache-title", r"apache licen[cs]e version 2\.0 january 2004"),
    ("apache-terms", r"terms and conditions for use reproduction and distribution"),
    ("mpl-notice={1}", r"subject to the terms of the mozilla public licen[cs]e v(?:ersion)?\.? ?([0-9.]+)"),
    ("mpl-copy", r"if a copy of the mpl was not distributed with this file you can obtain one at"),
    ("epl-notice={1}", r"made available under the terms of the eclipse public licen[cs]e (?:- )?v(?:ersion)? ?([0-9.]+)"),
    ("mpl-name={1}", r"mozilla public licen[cs]e v(?:ersion)?\.? ?([0-9]\.[0-9])"),
    ("epl-name={1}", r"eclipse public licen[cs]e (?:- )?v(?:ersion)?\.? ?([0-9]\.[0-9])"),
    ("boost-line", r"distributed under the boost software licen[cs]e version 1\.0"),
    ("boost-title", r"boost software licen[cs]e (?:- )?v(?:ersion)? ?1\.0"),
    ("unlicense", r"this is free and unencumbered software released into the public domain"),
    ("public-domain", r"(?:released|placed|dedicated) (?:in)?to the public domain"),
    ("cc0-line", r"(?:licen[cs]ed|released|dedicated|available) under(?: the)? (?:cc0|creative commons zero)"),
    ("cc-line={1}={2}", r"(?:licen[cs]ed|released|available|distributed) under(?: the| a)? cc[- ](by(?:-nc)?(?:-sa|-nd)?)[- ]([0-9]\.[0-9])"),
    ("cc-long={1}={2}", r"(?:licen[cs]ed|released|available|distributed) under(?: the| a)? creative commons (attribution(?:-?\s?noncommercial)?(?:-?\s?(?:sharealike|noderivatives|noderivs))?) ([0-9]\.[0-9])"),
    ("cc-title={1}={2}", r"creative commons (attribution(?:-?\s?noncommercial)?(?:-?\s?(?:sharealike|noderivatives|noderivs))?) ([0-9]\.[0-9])"),
    ("cc0-title", r"cc0 1\.0 universal"),
    ("short-line={1}", r"(?:licen[cs]ed|released|distributed|available) under(?: the)?(?: terms of the)? (mit|isc|zlib|bsd|apache|artistic|wtfpl|unlicense|x11|boost software|eclipse public|mozilla public) licen[cs]e"),
    ("bsd-line={1}", r"(?:licen[cs]ed|released|distributed|available) under(?: the)? (?:bsd[ -])?([234])-clause(?: bsd)?"),
    ("all-rights", r"copyright .{0,200}all rights reserved"),
)
# Rules in the order in which they are tried; the first that matches at a place wins.
RULES = (
    ("{1}", (r"spdx=(.+)",)),
    ("MIT", ("mit-grant", "mit-condition", "as-is", "no-liability")),
    ("MIT", ("mit-grant", "mit-condition", "as-is")),
    ("MIT", ("mit-grant", "mit-condition")),
    ("BSD-4-Clause", ("bsd-grant", "bsd-source", "bsd-binary", "bsd-advert", "bsd-endorse", "as-is", "no-liability")),
    ("BSD-3-Clause", ("bsd-grant", "bsd-source", "bsd-binary", "bsd-endorse", "as-is", "no-liability")),
    ("BSD-3-Clause", ("bsd-grant", "bsd-source", "bsd-binary", "bsd-endorse")),
    ("BSD-2-Clause", ("bsd-grant", "bsd-source", "bsd-binary", "as-is", "no-liability")),
    ("BSD-2-Clause", ("bsd-grant", "bsd-source", "bsd-binary")),
    ("ISC", ("isc-grant", "as-is", "no-liability")),
    ("ISC", ("isc-grant",)),
    ("Zlib", ("zlib-as-is", "zlib-origin", "zlib-altered", "zlib-notice")),
    ("Zlib", ("zlib-origin", "zlib-altered", "zlib-notice")),
    ("Apache-2.0", ("apache-notice", "apache-use", "apache-copy", "apache-law")),
    ("Apache-2.0", ("apache-notice", "apache-use", "apache-copy")),
    ("Apache-2.0", ("apache-notice",)),
    ("Apache-2.0", ("apache-title", "apache-terms")),
    ("Apache-2.0", ("apache-title",)),
    ("{1}GPL-{2}-or-later", (r"gnu-free=(.*)general", r"gnu-version=(.+)\+", "gnu-hope", "gnu-see", "gnu-copy")),
    ("{1}GPL-{2}-or-later", (r"gnu-free=(.*)general", r"gnu-version=(.+)\+")),
    ("{1}GPL-{2}-only", (r"gnu-free=(.*)general", r"gnu-only=(.+)", "gnu-hope", "gnu-see", "gnu-copy")),
    ("{1}GPL-{2}-only", (r"gnu-free=(.*)general", r"gnu-only=(.+)")),
    ("{1}GPL-{2}-or-later", (r"gnu-fixed=(.*)general=(.+)\+", "gnu-hope", "gnu-see", "gnu-copy")),
    ("{1}GPL-{2}-or-later", (r"gnu-fixed=(.*)general=(.+)\+",)),
    ("{1}GPL-{2}-only", (r"gnu-fixed=(.*)general=(.+)", "gnu-hope", "gnu-see", "gnu-copy")),
    ("{1}GPL-{2}-only", (r"gnu-fixed=(.*)general=(.+)",)),
    ("{1}GPL", (r"gnu-free=(.*)general",)),
    ("{1}GPL-{2}-or-later", (r"gnu-line=(.*)general=(.+)\+",)),
    ("{1}GPL-{2}-only", (r"gnu-line=(.*)general=(.+)",)),
    ("{1}GPL-{2}-or-later", (r"gpl-short=([al]?)=(.+)\+",)),
    ("{1}GPL-{2}-only", (r"gpl-short=([al]?)=(.+)",)),
    ("{1}GPL-{2}", (r"gnu-title=(.*)general=(.+)", "gnu-verbatim")),
    ("{1}GPL-{2}", (r"gnu-title=(.*)general=(.+)",)),
    ("MPL-{1}", (r"mpl-notice=(.+)", "mpl-copy")),
    ("MPL-{1}", (r"mpl-notice=(.+)",)),
    ("MPL-{1}", (r"mpl-name=(.+)",)),
    ("EPL-{1}", (r"epl-notice=(.+)",)),
    ("EPL-{1}", (r"epl-name=(.+)",)),
    ("BSL-1.0", ("boost-line",)),
    ("BSL-1.0", ("boost-title",)),
    ("Unlicense", ("unlicense",)),
    ("CC0-1.0", ("cc0-line",)),
    ("CC0-1.0", ("cc0-title",)),
    ("CC-{1}-{2}", (r"cc-line=([^=]+)=(.+)",)),
    ("CC-{1}-{2}", (r"cc-long=([^=]+)=(.+)",)),
    ("CC-{1}-{2}", (r"cc-title=([^=]+)=(.+)",)),
    ("{1}", (r"short-line=(.+)",)),
    ("BSD-{1}-Clause", (r"bsd-line=(.+)",)),
    ("public-domain", ("public-domain",)),
)
# Names of what a group matched.
NAMES = {
    "lesser ": "L", "library ": "L", "affero ": "A", "l": "L", "a": "A", "mit": "MIT", "isc": "ISC", "zlib": "Zlib", "bsd": "BSD", "apache": "Apache", "artistic": "Artistic",
    "wtfpl": "WTFPL", "unlicense": "Unlicense", "x11": "X11", "boost software": "BSL-1.0", "eclipse public": "EPL", "mozilla public": "MPL",
}
# Sentences of no licence that may stand between two of a rule.
GAP = 3

_SENTENCES = [(name, re.compile(rf"(?<![a-z0-9]){pattern}(?![a-z0-9])")) for name, pattern in SENTENCES]
_RULES = [(name, [re.compile(rf"(?:{step})\Z") for step in steps]) for name, steps in RULES]
_LEADERS = re.compile(r"(?m)^[\s/*#;!>|%-]+")
# A full stop between "v" and a version does not end a sentence.
_ENDS = re.compile(r"(?!(?<=\bv)\.\s+[0-9])[.;:!?](?=\s|$)|\n\s*\n")
_DROPPED = re.compile(r"[^\w\s./+=-]+")


def sentences(text: str) -> list[str]:
    """Normalised sentences: line leaders and punctuation gone, white space single, lower case."""
    plain = _LEADERS.sub(" ", text.lower().replace("spdx-license-identifier:", "spdx-license-identifier"))
    parts = (" ".join(_DROPPED.sub(" ", s).split()) for s in _ENDS.split(plain))
    return [s for s in parts if s]


def identified(parts: list[str]) -> list[tuple[int, str]]:
    """(number of the sentence, identifier) of every known sentence, in order."""
    found = []
    for number, sentence in enumerate(parts):
        taken: list[tuple[int, int, str]] = []
        for name, pattern in _SENTENCES:
            for m in pattern.finditer(sentence):
                if all(m.end() <= start or m.start() >= end for start, end, _ in taken):
                    taken.append((m.start(), m.end(), re.sub(r"\{(\d)\}", lambda g, m=m: m.group(int(g.group(1))), name)))
        found += [(number, name) for _, _, name in sorted(taken)]
    return found


def _name(template: str, groups: list[str]) -> str:
    def named(g: re.Match) -> str:
        value = groups[int(g.group(1)) - 1]
        if template.startswith("CC-") and not value[0].isdigit():
            value = re.sub(r"attribution", "BY", re.sub(r"noncommercial", "NC", re.sub(r"sharealike", "SA", re.sub(r"noderiv\w+", "ND", value))))
            value = re.sub(r"[-\s]+", "-", value).upper()
        if template == "{1}" and value not in NAMES:
            return value.upper() if len(value) < 5 else value
        if re.fullmatch(r"[0-9]", value) and "GPL" in template:
            value += ".0"
        return NAMES.get(value, value)

    return re.sub(r"\{(\d)\}", named, template)


def licences(found: list[tuple[int, str]]) -> tuple[list[str], int]:
    """Licences in order of their place, and how many identifiers no rule explains."""
    out, at, unmatched = [], 0, 0
    while at < len(found):
        for template, steps in _RULES:
            own = found[at : at + len(steps)]
            near = all(b[0] - a[0] <= GAP for a, b in zip(own, own[1:], strict=False))
            matches = [p.match(name) for p, (_, name) in zip(steps, own, strict=False)]
            if len(own) == len(steps) and near and all(matches):
                out.append(_name(template, [g for m in matches for g in m.groups()]))
                at += len(steps)
                break
        else:
            unmatched += 1
            at += 1
    return out, unmatched


def _needed(pattern: str) -> str:
    """The longest word that every match of a sentence's pattern holds, as a regular expression.

    A letter class such as the one of "licence" stays; groups, other classes and what may be
    missing separate words. Line leaders and punctuation cannot stand inside a word that is
    found: they stay or become a space.
    """
    flat = pattern.replace("[cs]", "\x00").replace(r"\.", ".")
    while (less := re.sub(r"\([^()]*\)[?]?", " ", flat)) != flat:
        flat = less
    flat = re.sub(r"\[[^\]]*\][?+*]?|\.\{[^}]*\}|.\?", " ", flat)
    words = re.findall(r"[a-z\x00]+", flat)
    return max(words, key=len, default="").replace("\x00", "[cs]")


# Without one of these no sentence above can match.
KEYWORDS = "(?i)" + "|".join(sorted({_needed(pattern) for _, pattern in SENTENCES}))


def licence_scan(documents: DataFrame, text: str = "text") -> DataFrame:
    """Documents with a known licence sentence: doc_id, licences and sentence identifiers in order, and
    how many of those no rule explains.

    NULL and empty texts and texts without a known sentence have no row; repeated rows have one each.
    """

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for doc_id, content in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if found := identified(sentences(content)):
                    names, unmatched = licences(found)
                    rows.append((doc_id, ",".join(names), ",".join(name for _, name in found), unmatched))
            columns = list(zip(*rows, strict=True)) or [[]] * 4
            kinds = (pa.int64(), pa.string(), pa.string(), pa.int32())
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], ["doc_id", "licences", "sentence_ids", "n_unmatched"])

    rows = documents.select(F.col("doc_id").cast("long"), F.col(text).alias("content")).filter(F.col("content").rlike(KEYWORDS))
    return rows.mapInArrow(scan, "doc_id long, licences string, sentence_ids string, n_unmatched int")
