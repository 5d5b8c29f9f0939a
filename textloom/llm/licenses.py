"""Licence recognition by sentences: normalised sentences become identifiers, identifier sequences become licences.

Sentences without a critical word or the short name of a licence cannot state one and are skipped. The others are normalised and looked up in a
table of known licence sentences; a critical sentence that none of them fits is ``UNKNOWN``. Ordered rules then read the
document's identifier sequence: the first rule that fits takes its identifiers out, so a longer rule
stands before a shorter one that is part of it.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Every known sentence holds one of these, in lower case.
CRITICAL = tuple(
    w.encode()
    for w in [
        "licen", "copyright", "warrant", "permission", "permitted", "redistribut", "liab", "endorse", "public domain", "rights reserved",
        "merchantab", "gnu", "(c)", "©", "free software", "later version", "misrepresented", "copy of the mpl", "advertising materials",
    ]
)
# Every licence name without such a word holds one of these; "mit" is a common word elsewhere, so such sentences need not be known.
SHORT = re.compile(rb"gpl|apache|mpl|epl|cddl|bsd|\bmit\b|\bisc\b|wtf|cc0|cc[- ]by|creative\s+commons")
COMMENT = re.compile(r"^[ \t]*(?:/\*+|\*+/|//+|#+|;+|--+|\*+|dnl\b|rem\b|<!--|%+)?[ \t]*", re.M | re.I)
COMMENT_END = re.compile(r"[ \t]*(?:\*+/|-->)[ \t]*$", re.M)
QUOTES = re.compile("[\"'`´‘’“”«»]+")
SENTENCE = re.compile(r"(?<=[.!?;:])(?<!\bv\.)(?<!identifier:)(?<!\bc\.)\s+|\n\s*\n", re.I)
SPACE = re.compile(r"\s+")

# Names of licences in running text; a group is the version.
_V = r"(?:,?\s*(?:version|ver\.?|v\.?)?\s*(\d+(?:\.\d+)*))?"
NAMES: list[tuple[str, str]] = [
    (r"(?:gnu )?affero general public licen[cs]e" + _V + r"|agpl[- ]?v?(\d(?:\.\d)?)?\b", "AGPL"),
    (r"(?:gnu )?(?:lesser|library) (?:general )?public licen[cs]e" + _V + r"|lgpl[- ]?v?(\d(?:\.\d)?)?\b", "LGPL"),
    (r"(?:gnu )?general public licen[cs]e" + _V + r"|gpl[- ]?v?(\d(?:\.\d)?)?\b", "GPL"),
    (r"apache (?:software )?(?:licen[cs]e|public licen[cs]e)" + _V + r"|apache[- ]?(\d(?:\.\d)?)\b", "Apache"),
    (r"mozilla public licen[cs]e" + _V + r"|mpl[- ]?v?(\d\.\d)\b", "MPL"),
    (r"eclipse public licen[cs]e" + _V + r"|epl[- ]?v?(\d\.\d)\b", "EPL"),
    (r"common development and distribution licen[cs]e" + _V + r"|cddl[- ]?v?(\d\.\d)?\b", "CDDL"),
    (r"artistic licen[cs]e" + _V, "Artistic"),
    (r"boost software licen[cs]e" + _V, "BSL"),
    (r"academic free licen[cs]e" + _V, "AFL"),
    (r"(?:2-clause|simplified|freebsd) bsd(?: licen[cs]e)?|bsd[- ]2-clause(?: licen[cs]e)?", "BSD-2-Clause"),
    (r"(?:3-clause|modified|new|revised) bsd(?: licen[cs]e)?|bsd[- ]3-clause(?: licen[cs]e)?", "BSD-3-Clause"),
    (r"(?:4-clause|original) bsd(?: licen[cs]e)?|bsd[- ]4-clause(?: licen[cs]e)?", "BSD-4-Clause"),
    (r"bsd(?:-style)? licen[cs]e", "BSD"),
    (r"(?:mit|expat)(?:/x11)?(?:-style)? licen[cs]e|\bmit\b", "MIT"),
    (r"isc licen[cs]e|\bisc\b", "ISC"),
    (r"zlib(?:/libpng)? licen[cs]e", "Zlib"),
    (r"python software foundation licen[cs]e" + _V, "PSF"),
    (r"w(?:hat )?t(?:he )?f(?:uck )?(?:you want to )?p(?:ublic )?l(?:icen[cs]e)?\b", "WTFPL"),
    (r"the unlicen[cs]e|\bunlicen[cs]e\b", "Unlicense"),
    (r"cc0(?:[- ](\d\.\d))?|creative commons zero(?: v?(\d\.\d))?", "CC0"),
]
CC = re.compile(
    r"(?:cc[- ]by|creative commons(?: licen[cs]e)?[ ,:-]*(?:by|attribution))((?:[- ]+(?:nc|nd|sa|non-?commercial|no-?deriv(?:ative)?s?(?: works)?|share-?alike))*)"
    r"(?:[- ]licen[cs]e)?[ ,-]*(?:version |v)?(\d(?:\.\d)?)?"
)
NAMED = [(re.compile(p), name) for p, name in NAMES]
# Names that are words or institutions as well: without a critical word they must be what something is under.
AMBIGUOUS = ("MIT", "ISC")
UNDER = re.compile(r"\b(?:under|terms)\b.*\b(?:mit|isc)\b")
STATES = re.compile(r"\b(?:licen[cs]ed?|released|distributed|available|published|covered|dual-licen[cs]ed|governed|use of this \w+|terms)\b")

# Known sentences: (identifier, pattern on the normalised sentence). The wording is that of the published licence texts.
SENTENCES = [
    (name, re.compile(pattern))
    for name, pattern in [
        ("SPDX", r"spdx-license-identifier:\s*(\(?[a-z0-9.+\-]+\)?(?: (?:or|and|with) \(?[a-z0-9.+\-]+\)?)*)"),
        ("MIT-GRANT", r"permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation"),
        ("BSL-GRANT", r"permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and accompanying documentation"),
        ("MIT-NOTICE", r"above copyright notice and this permission notice (?:\(including the next paragraph\) )?shall be included in all copies"),
        ("MIT-ASIS", r"the software is provided as is, without warranty of any kind, express(?:ed)? or implied"),
        ("MIT-LIABILITY", r"in no event shall the authors?(?: or copyright holders?)? be liable for any claim, damages or other liability"),
        ("ISC-GRANT", r"permission to use, copy, modify,? (?:and/or|and) distribute this software for any purpose with or without fee is hereby granted"),
        ("ISC-ASIS", r"the software is provided as is and .{1,60} disclaims? all warranties"),
        ("ISC-LIABILITY", r"in no event shall .{1,60} be liable for any special, direct, indirect"),
        ("BSD-GRANT", r"redistribution and use in source and binary forms,? with or without modification,? are permitted"),
        ("BSD-SOURCE", r"redistributions? of source code must retain the (?:above )?copyright notice"),
        ("BSD-BINARY", r"redistributions? in binary form must reproduce the (?:above )?copyright notice"),
        ("BSD-ADVERT", r"all advertising materials mentioning features or use of this software must display"),
        ("BSD-ENDORSE", r"(?:neither the names? of .{1,120}|the names? of .{1,120}) (?:nor the names of .{1,80} )?(?:may|must not|may not) be used to endorse or promote products"),
        ("BSD-ASIS", r"this software is provided by .{1,120} as is and any express(?:ed)? or implied warranties"),
        ("BSD-LIABILITY", r"in no event shall .{1,120} be liable for any direct, indirect, incidental"),
        ("APACHE-COMPLY", r"you may not use this file except in compliance with the licen[cs]e"),
        ("APACHE-COPY", r"you may obtain a copy of the licen[cs]e at"),
        ("APACHE-ASIS", r"unless required by applicable law or agreed to in writing, software distributed under the licen[cs]e is distributed on an as is basis"),
        ("APACHE-SEE", r"see the licen[cs]e for the specific language governing permissions and limitations"),
        ("ASF-GRANT", r"licensed to the apache software foundation"),
        ("GPL-FREE", r"(?:this program|this library|this software|this file|it|\w+) is free software[;:.,]?$"),
        ("GPL-TERMS", r"you can redistribute it and/or modify it under the terms of (?:version (\d(?:\.\d)?) of )?the gnu (lesser |library |affero )?general public licen[cs]e(?:,? version (\d(?:\.\d)?))?"),
        ("GPL-LATER", r"(?:either )?version (\d(?:\.\d)?) of the licen[cs]e,? or (?:\(at your option\) )?any later version"),
        ("GPL-WARRANTY", r"(?:is )?distributed in the hope that it will be useful,? but without any warranty"),
        ("GPL-IMPLIED", r"without even the implied warranty of merchantability or fitness for a particular purpose"),
        ("GPL-SEE", r"see the gnu (?:lesser |library |affero )?general public licen[cs]e for more details"),
        ("GPL-COPY", r"you should have received a copy of the gnu (?:lesser |library |affero )?general public licen[cs]e"),
        ("MPL-TERMS", r"this source code form is subject to the terms of the mozilla public licen[cs]e, v\. ?(\d\.\d)"),
        ("MPL-COPY", r"if a copy of the mpl was not distributed with this file"),
        ("EPL-TERMS", r"this program and the accompanying materials are made available under the terms of the eclipse public licen[cs]e,? v(?:ersion)? ?(\d\.\d)"),
        ("ZLIB-ASIS", r"this software is provided as-is, without any express or implied warranty"),
        ("ZLIB-GRANT", r"permission is granted to anyone to use this software for any purpose, including commercial applications"),
        ("ZLIB-ORIGIN", r"the origin of this software must not be misrepresented"),
        ("UNLICENSE", r"this is free and unencumbered software released into the public domain"),
        ("PUBLIC-DOMAIN", r"(?:placed|released|dedicated|is) (?:in|into|to) the public domain"),
        ("ALL-RIGHTS", r"\ball rights reserved\b"),
        ("COPYRIGHT", r"(?:copyright|\(c\)|©)\s*(?:\(c\)|©)?\s*(?:by\s+)?(?:\d{4}|[a-z])"),
    ]
]

# Ordered rules: (licence, pattern over the sequence `<ID><ID:argument>...`); {1} is the argument. `S` skips unrelated sentences.
_S = r"(?:<(?:UNKNOWN|COPYRIGHT|ALL-RIGHTS)>)*"


def _rule(*ids: str) -> str:
    return _S.join(f"(?:<{i[:-1]}>)?" if i.endswith("?") else f"<{i}>" for i in ids)


_GPL = ("GPL-LATER:([0-9.]+)", "GPL-WARRANTY?", "GPL-IMPLIED?", "GPL-SEE?", "GPL-COPY?")
_GPL_ONLY = ("GPL-WARRANTY?", "GPL-IMPLIED?", "GPL-SEE?", "GPL-COPY?")
RULES = [
    (name, re.compile(pattern))
    for name, pattern in [
        ("{1}", _rule("SPDX:([^>]+)")),
        ("{1}", _rule("ASF-GRANT?", "NAMED:(Apache-2(?:\\.0)?)", "APACHE-COMPLY", "APACHE-COPY?", "NAMED:Apache-2(?:\\.0)??", "APACHE-ASIS?", "APACHE-SEE?")),
        ("BSD-4-Clause", _rule("BSD-GRANT", "BSD-SOURCE", "BSD-BINARY", "BSD-ADVERT", "BSD-ENDORSE", "BSD-ASIS?", "BSD-LIABILITY?")),
        ("BSD-3-Clause", _rule("BSD-GRANT", "BSD-SOURCE", "BSD-BINARY", "BSD-ENDORSE", "BSD-ASIS?", "BSD-LIABILITY?")),
        ("BSD-2-Clause", _rule("BSD-GRANT", "BSD-SOURCE", "BSD-BINARY", "BSD-ASIS?", "BSD-LIABILITY?")),
        ("MIT", _rule("MIT-GRANT", "MIT-NOTICE", "MIT-ASIS?", "MIT-LIABILITY?")),
        ("X11-notice-only", _rule("MIT-GRANT", "MIT-ASIS?", "MIT-LIABILITY?")),
        ("BSL-1.0", _rule("BSL-GRANT", "MIT-ASIS?")),
        ("ISC", _rule("ISC-GRANT", "ISC-ASIS?", "ISC-LIABILITY?")),
        ("Zlib", _rule("ZLIB-ASIS?", "ZLIB-GRANT", "ZLIB-ORIGIN?")),
        ("{1}-{2}-or-later", _rule("GPL-FREE?", "GPL-TERMS:(A?L?GPL)", *_GPL)),
        ("{1}-only", _rule("GPL-FREE?", "GPL-TERMS:(A?L?GPL-[0-9.]+)", *_GPL_ONLY)),
        ("{1}", _rule("GPL-FREE?", "GPL-TERMS:(A?L?GPL)", *_GPL_ONLY)),
        ("MPL-{1}", _rule("MPL-TERMS:([0-9.]+)", "MPL-COPY?")),
        ("EPL-{1}", _rule("EPL-TERMS:([0-9.]+)")),
        ("Unlicense", _rule("UNLICENSE")),
        ("{1}", _rule("NAMED:([^>]+)")),
        ("public-domain", _rule("PUBLIC-DOMAIN")),
        ("all-rights-reserved", _rule("ALL-RIGHTS")),
    ]
]


def normalise(sentence: str) -> str:
    """Lower case, single blanks, no quotation marks, one spelling of licence words."""
    text = SPACE.sub(" ", QUOTES.sub("", sentence.lower())).strip()
    return text.replace("licence", "license").replace("sub-license", "sublicense")


def _version(name: str, version: str | None) -> str:
    if not version:
        return name
    if "." not in version and name != "EPL":
        version += ".0"
    return f"{name}-{version}"


def named_licences(sentence: str) -> list[str]:
    """Licences that a normalised sentence names, in the order of their places; a longer name covers shorter ones in it."""
    found: list[tuple[int, int, str]] = []
    for m in CC.finditer(sentence):
        kinds = re.sub(r"[\s-]+", "", m[1])
        parts = [k for k, w in (("NC", "nc|noncommercial"), ("ND", "nd|noderiv"), ("SA", "sa|sharealike")) if re.search(w, kinds)]
        found.append((m.start(), m.end(), _version("-".join(["CC-BY", *parts]), m[2])))
    for pattern, name in NAMED:
        for m in pattern.finditer(sentence):
            if not any(lo <= m.start() < hi for lo, hi, _ in found):
                found.append((m.start(), m.end(), _version(name, next((g for g in m.groups() if g), None))))
    return [name for _, _, name in sorted(found)]


def identify(sentence: str) -> list[str]:
    """The identifiers of a normalised sentence: ``ID`` or ``ID:argument``."""
    found: list[tuple[int, str]] = []
    for name, pattern in SENTENCES:
        m = pattern.search(sentence)
        if not m:
            continue
        if name == "SPDX":
            return [f"SPDX:{m[1].strip()}"]
        if name == "GPL-TERMS":
            kind = {"lesser ": "LGPL", "library ": "LGPL", "affero ": "AGPL", None: "GPL"}[m[2]]
            found.append((m.start(), f"{name}:{_version(kind, m[1] or m[3])}"))
        else:
            found.append((m.start(), f"{name}:{m[1]}" if m.groups() else name))
    known = {n.partition(":")[0] for _, n in found}
    if STATES.search(sentence) and not known & {"GPL-TERMS", "MPL-TERMS", "EPL-TERMS", "GPL-SEE", "GPL-COPY", "ASF-GRANT"}:
        found += [(len(sentence), f"NAMED:{n}") for n in named_licences(sentence)]
    return [n for _, n in sorted(found, key=lambda x: x[0])] or ["UNKNOWN"]


def sentences(text: str) -> Iterator[str]:
    """Sentences of a text without comment marks; a line end joins lines unless a sentence ends there."""
    plain = COMMENT_END.sub("", COMMENT.sub("", text))
    return (s for s in SENTENCE.split(plain) if s)


def licence_sequence(text: bytes | None) -> list[str]:
    """Identifiers of all critical sentences of a whole text and of those that state a licence by its short name, in order."""
    low = (text or b"").lower()
    if not any(w in low for w in CRITICAL) and not SHORT.search(low):
        return []
    found: list[str] = []
    for sentence in sentences(text.decode("utf-8", "replace")):
        plain = normalise(sentence)
        data = plain.encode()
        if any(w in data for w in CRITICAL):
            found += identify(plain)
        elif SHORT.search(data) and STATES.search(plain):
            found += [f"NAMED:{n}" for n in named_licences(plain) if n not in AMBIGUOUS or UNDER.search(plain)]
    return found


def match_rules(sequence: list[str]) -> list[str]:
    """Licences of an identifier sequence, each once, in the order of the rules that took them."""
    left, found = "".join(f"<{s}>" for s in sequence), []
    for name, pattern in RULES:
        while m := pattern.search(left):
            licence = name
            for i, group in enumerate(m.groups(), 1):
                licence = licence.replace(f"{{{i}}}", f"{group}.0" if (group or "").isdigit() else group or "")
            found.append(licence)
            left = f"{left[: m.start()]}<TAKEN>{left[m.end() :]}"
    return list(dict.fromkeys(found))


def scan_licences(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(``doc_id``, ``licences``, ``sentence_ids``, ``n_unknown``) per row of ``docs``, from whole texts.

    ``licences`` and ``sentence_ids`` are comma-joined and empty where nothing is stated; ``n_unknown`` counts critical sentences that
    no table entry fits. NULL texts state nothing; repeated rows and NULL ids stay; other columns are not read. Nothing is shuffled.
    """

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [licence_sequence(t.as_py()) for t in batch.column(1)]
            columns = [
                batch.column(0),
                pa.array([",".join(sorted(match_rules(s))) if s else "" for s in found], pa.string()),
                pa.array([",".join(i for i in s if i != "UNKNOWN") for s in found], pa.string()),
                pa.array([s.count("UNKNOWN") for s in found], pa.int64()),
            ]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "licences", "sentence_ids", "n_unknown"])

    rows = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).cast("binary").alias("_text"))
    return rows.mapInArrow(scan, "doc_id long, licences string, sentence_ids string, n_unknown long")
