"""License scans by sentence rules.

1. A text is cut into sentences, in three ways: unwrapped (line breaks inside a
   sentence are blanks), unwrapped but cut before lines that begin with a capital
   (headings), and by line, as notices often stand alone on a line.
2. A sentence is normalised -- lower case, marks and runs of blanks as one blank
   -- and looked up among the known licence sentences (``SENTENCES``), whose
   patterns leave room for names, years and versions.  Its identifier and place
   are kept; a sentence that speaks of licences but is not known is ``Unknown``.
3. The document's identifiers, in order of place, are matched against the
   licence rules (``RULES``), in their order: a rule is a sequence of
   identifiers, found sentence after sentence; what a rule has matched is taken
   out of the sequence, so that a later, more general rule cannot claim it.

Whole texts are scanned.  Texts without any of a few telling words are done
after one search of the whole column by Arrow.  One row per document; no shuffle.

Defined results: null and empty texts have no sentences and status ``none``;
repeated rows get a row each; null ids are kept; other columns are ignored; an
empty table gives no rows.  Status: ``licensed`` (a rule matched), ``unknown``
(only unknown licence sentences), ``none``.
"""

from __future__ import annotations

import re
from bisect import bisect_left, bisect_right

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import blocks, prepare

# Words one of which (or the "(c) 2020" of _TELLING) every known
# sentence and every sentence that speaks of a licence has
TELLING = ("licen", "warrant", "redistribut", "permission", "rights reserved", "copyright", "public domain",
           "creative commons", "gnu ", "liable", "cc by", "cc 0", "advertising materials")

# Known licence sentences, normalised, as patterns
SENTENCES = [
    ("Copyright", r"(?!.*all rights reserved|.* all( rights)?$)((copyright( c)?|c) ?\d{4}.*|copyright( c)? .*\d{4}.*)"),
    ("AllRights", r"(.* )?all rights reserved"),
    ("ApacheLic", r"(this (work|file|software|project) is )?licensed under the apache licen[sc]e,? version (?P<v>2 0|2)"
                  r"( the license)?"),
    ("ApacheUse", r"you may not use this file except in compliance with the license"),
    ("ApacheCopy", r"you may obtain a copy of the license at.*"),
    ("ApacheAsIs", r"unless required by applicable law or agreed to in writing software distributed under the license is "
                   r"distributed on an as is basis without warranties or conditions of any kind either express or implied"),
    ("ApacheSee", r"see the license for the specific language governing permissions and limitations under the license"),
    ("GplLic", r"(this (work|file|software|program|project) is )?(licensed|released|distributed) under the (terms of the )?"
               r"gnu general public licen[sc]e,? (version |v)(?P<v>2|3)( 0)?( only)?"),
    ("GplLater", r"(this (work|file|software|program|project) is )?(licensed|released|distributed) under the (terms of the )?"
                 r"gnu general public licen[sc]e,? (version |v)(?P<v>2|3)( 0)? or( at your option)?( any)? later( version)?"),
    ("GplFree", r"(this program|it) is free software you can redistribute it and or modify it under the terms of the gnu "
                r"general public license as published by the free software foundation either version (?P<v>2|3) of the "
                r"license or at your option any later version"),
    ("LgplLic", r"(this (work|file|software|library|project) is )?(licensed|released|distributed) under the (terms of the )?"
                r"gnu (lesser|library) general public licen[sc]e,? (version |v)(?P<v>2 1|2|3)( 0)?"),
    ("AgplLic", r"(this (work|file|software|program|project) is )?(licensed|released|distributed) under the (terms of the )?"
                r"gnu affero general public licen[sc]e,? (version |v)(?P<v>3)( 0)?"),
    ("GplNoWarr", r"this program is distributed in the hope that it will be useful but without any warranty without even "
                  r"the implied warranty of merchantability or fitness for a particular purpose"),
    ("MitLic", r"((this (work|file|software|project) is )?(released|licensed|distributed) under )?(the )?(terms of the )?"
               r"mit licen[sc]e"),
    ("MitPerm", r"permission is hereby granted free of charge to any person obtaining a copy of this software and associated "
                r"documentation files the software to deal in the software without restriction.*"),
    ("MitNotice", r"the above copyright notice and this permission notice shall be included in all copies or substantial "
                  r"portions of the software"),
    ("MitAsIs", r"the software is provided as is without warranty of any kind.*"),
    ("MitLiable", r"in no event shall the authors or copyright holders be liable for any claim.*"),
    ("BsdLic", r"(this (work|file|software|project) is )?(released|licensed|distributed) under the (?P<v>2|3) clause bsd "
               r"licen[sc]e"),
    ("BsdRedist", r"redistribution and use in source and binary forms with or without modification are permitted provided "
                  r"that the following conditions are met.*"),
    ("BsdSource", r"(\d )?redistributions of source code must retain the above copyright notice.*"),
    ("BsdBinary", r"(\d )?redistributions in binary form must reproduce the above copyright notice.*"),
    ("BsdEndorse", r"(\d )?neither the name of .* may be used to endorse or promote products derived from this software "
                   r"without specific prior written permission"),
    ("BsdAsIs", r"this software is provided by the (copyright holders|author|regents).* as is and any express or implied "
                r"warranties.* are disclaimed"),
    ("BsdAdvert", r"(\d )?all advertising materials mentioning features or use of this software must display the following "
                  r"acknowledge?ment.*"),
    ("ZlibAsIs", r"this software is provided as is without any express or implied warranty"),
    ("ZlibLiable", r"in no event will the authors be held liable for any damages arising from the use of this software"),
    ("ZlibPerm", r"permission is granted to anyone to use this software for any purpose including commercial applications and "
                 r"to alter it and redistribute it freely subject to the following restrictions.*"),
    ("ZlibLic", r"((this (work|file|software|project) is )?(released|licensed|distributed) under )?(the )?(terms of the )?"
                r"zlib licen[sc]e"),
    ("BoostLic", r"((this (work|file|software|project) is )?(released|licensed|distributed) under )?(the )?boost software "
                 r"licen[sc]e,? version (?P<v>1 0)( see accompanying file.*)?( august 17th 2003)?"),
    ("BoostPerm", r"permission is hereby granted free of charge to any person or organization obtaining a copy of the software "
                  r"and accompanying documentation covered by this license.*"),
    ("EplLic", r"(all rights reserved )?this program and the accompanying materials are made available under the terms of the "
               r"eclipse public licen[sc]e,? (v ?|version )(?P<v>1 0|2 0)( which .*)?"),
    ("Unlicense", r"this is free and unencumbered software released into the public domain"),
    ("IscPerm", r"permission to use copy modify and or distribute this software for any purpose with or without fee is "
                r"hereby granted.*"),
    ("MplLic", r"this source code form is subject to the terms of the mozilla public license v (?P<v>2 0)"),
    ("MplOld", r"the contents of this file are subject to the mozilla public licen[sc]e,? version (?P<v>1 0|1 1).*"),
    ("CcLic", r"((this work is )?(licensed|released) under )?(a |the )?(creative commons |cc |cc(?=0))(?P<v>(by( nc)?( sa| nd)?|0)( \d \d)?)"
              r"( international| unported)?( licen[sc]e)?"),
    ("PublicDomain", r"(this (work|file|software) (is|has been) )?(released|placed|dedicated)( in)?to the public domain"),
]

# Ordered licence rules; {v} is the version a sentence names
RULES = [
    ("Apache-{v}", ["ApacheLic", "ApacheUse", "ApacheCopy", "ApacheAsIs", "ApacheSee"]),
    ("Apache-{v}", ["ApacheLic"]),
    ("GPL-{v}-or-later", ["GplFree", "GplNoWarr"]),
    ("GPL-{v}-or-later", ["GplFree"]),
    ("GPL-{v}-or-later", ["GplLater"]),
    ("GPL-{v}", ["GplLic"]),
    ("LGPL-{v}", ["LgplLic"]),
    ("AGPL-{v}", ["AgplLic"]),
    ("MIT", ["MitPerm", "MitNotice", "MitAsIs", "MitLiable"]),
    ("MIT", ["MitPerm", "MitNotice", "MitAsIs"]),
    ("MIT", ["MitLic"]),
    ("BSD-4-Clause", ["BsdRedist", "BsdSource", "BsdBinary", "BsdAdvert", "BsdEndorse", "BsdAsIs"]),
    ("BSD-3-Clause", ["BsdRedist", "BsdSource", "BsdBinary", "BsdEndorse", "BsdAsIs"]),
    ("BSD-2-Clause", ["BsdRedist", "BsdSource", "BsdBinary", "BsdAsIs"]),
    ("BSD-{v}-Clause", ["BsdLic"]),
    ("ISC", ["IscPerm", "MitAsIs"]),
    ("ISC", ["IscPerm"]),
    ("MPL-{v}", ["MplLic"]),
    ("MPL-{v}", ["MplOld"]),
    ("Zlib", ["ZlibAsIs", "ZlibLiable", "ZlibPerm"]),
    ("Zlib", ["ZlibPerm"]),
    ("Zlib", ["ZlibLic"]),
    ("BSL-{v}", ["BoostLic", "BoostPerm"]),
    ("BSL-{v}", ["BoostLic"]),
    ("BSL-1.0", ["BoostPerm"]),
    ("EPL-{v}", ["EplLic"]),
    ("Unlicense", ["Unlicense"]),
    ("CC-{v}", ["CcLic"]),
    ("Public-Domain", ["PublicDomain"]),
    ("All-Rights-Reserved", ["Copyright", "AllRights"]),
    ("All-Rights-Reserved", ["AllRights"]),
]

UNKNOWN = "Unknown"
# in raw text any marks, line breaks and comment signs can stand for a blank; "(c) 2020" is telling too
_TELLING = re.compile("|".join(w.replace("cc 0", "cc ?0").replace(" ?", r"\W*").replace(" ", r"\W+") for w in TELLING)
                      + r"|\bc\W*\d{4}", re.I)
# the same for a column at once; at least as wide (there, other letters than a-z end a word)
_GATE = "|".join(w.replace("cc 0", "cc ?0").replace(" ?", r"[^\pL\pN_]*").replace(" ", r"[^\pL\pN_]+") for w in TELLING) + (
    r"|\bc[^\pL\pN_]*\pN{4}")
# "v. 2.0" is no end of a sentence
_STOP = re.compile(r"(?<=[.!?:;])(?!(?<=\b[vV]\.)\s+\d)[\"')\]]*(?:[ \t]|\r?\n)+(?=[\"'(\[]*[A-Z0-9])|(?:\r?\n[ \t]*){2,}|\Z")
_LINE = re.compile(r"\r?\n|\Z")
# as _STOP, and also before a line that begins with a capital: a heading may have no stop
_HEADING = re.compile(r"\r?\n(?=[ \t]*[\"'(\[]*[A-Z])|" + _STOP.pattern)
_COMMENT = re.compile(r"(?m)^[ \t]*(?://+|#+|\*+|/\*+|--+|;+|%+)[ \t]?")
_MARKS = re.compile(r"[^\w]+")
_KNOWN = [(name, re.compile(p)) for name, p in SENTENCES]
_SPEAKS = re.compile(r"\blicen[sc]e[ds]?\b|\ball rights reserved\b|\bpublic domain\b")
_APART = "|"


def normal(sentence: str) -> str:
    return _MARKS.sub(" ", _COMMENT.sub("", sentence).lower()).strip()


def identify(sentence: str) -> tuple[str, str] | None:
    """(identifier, version) of a normalised sentence; None if it says nothing."""
    for name, pattern in _KNOWN:
        m = pattern.fullmatch(sentence)
        if m:
            return name, (m.groupdict().get("v") or "")
    return (UNKNOWN, "") if _SPEAKS.search(sentence) else None


def sentences(text: str) -> list[tuple[int, int, str, str]]:
    """(start, end, identifier, version) of the licence sentences, in order.  A
    known sentence beats an unknown one that overlaps it, else the earlier and
    longer one stays."""
    if not _TELLING.search(text):
        return []
    found: dict[tuple[int, int], tuple[str, str]] = {}
    stops: list[int] = []
    for cut in (_STOP, _HEADING, _LINE):
        start = 0
        for m in cut.finditer(text):
            a, b = start, m.start()
            start = m.end()
            if cut is _STOP:
                stops.append(b)
            elif cut is _LINE and bisect_right(stops, a) < bisect_left(stops, b):
                continue  # a line of several sentences is none itself
            if b > a and (a, b) not in found and _TELLING.search(text, a, b):
                got = identify(normal(text[a:b]))
                if got:
                    found[a, b] = got
    out: list[tuple[int, int, str, str]] = []
    known = sorted(((a, b, *v) for (a, b), v in found.items() if v[0] != UNKNOWN), key=lambda x: (x[0], -x[1]))
    last = -1
    for s in known:
        if s[0] >= last:
            out.append(s)
            last = s[1]
    taken = [(a, b) for a, b, _, _ in out]
    i = 0
    unknown = sorted(((a, b, *v) for (a, b), v in found.items() if v[0] == UNKNOWN), key=lambda x: (x[0], -x[1]))
    last = -1
    for s in unknown:
        while i < len(taken) and taken[i][1] <= s[0]:
            i += 1
        if s[0] >= last and not (i < len(taken) and taken[i][0] < s[1]):
            out.append(s)
            last = s[1]
    return sorted(out)


def _version(v: str, rule: str) -> str:
    if "CC-" in rule:
        return re.sub(r"-(\d)-(\d)$", r"-\1.\2", v.upper().replace(" ", "-"))
    return v.replace(" ", ".") if " " in v or "Clause" in rule else f"{v}.0"


def apply_rules(found: list[tuple[int, int, str, str]]) -> list[str]:
    """Licences of a document's sentences, in order of place."""
    names = [s[2] for s in found]
    hits: list[tuple[int, str]] = []
    for licence, rule in RULES:
        i = 0
        while i + len(rule) <= len(names):
            if names[i: i + len(rule)] == rule:
                version = next((found[j][3] for j in range(i, i + len(rule)) if found[j][3]), "")
                hits.append((i, licence.replace("{v}", _version(version, licence))))
                names[i: i + len(rule)] = [_APART] * len(rule)
                i += len(rule)
            else:
                i += 1
    return [name for _, name in sorted(hits)]


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, status, licenses`` (distinct, in order of place), ``found`` (start,
    stop and identifier of each licence sentence) of every row."""
    prepare(docs.sparkSession)
    span = pa.struct([("start", pa.int64()), ("stop", pa.int64()), ("sentence", pa.string())])

    def read(batches):
        for b in batches:
            for first, run in blocks(b.column(1)):
                status, names, spans = [], [], []
                telling = pc.match_substring_regex(run, _GATE, ignore_case=True)
                for t in pc.if_else(telling, run, pa.scalar("", run.type)).to_pylist():
                    found = sentences(t) if t else []
                    got = list(dict.fromkeys(apply_rules(found)))
                    status.append("licensed" if got else "unknown" if found else "none")
                    names.append(got)
                    spans.append([{"start": a, "stop": e, "sentence": n} for a, e, n, _ in found])
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).slice(first, len(run)), pa.array(status, pa.string()),
                     pa.array(names, pa.list_(pa.string())), pa.array(spans, pa.list_(span))],
                    ["doc_id", "status", "licenses", "found"])

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col)).mapInArrow(
        read, "doc_id long, status string, licenses array<string>, "
              "found array<struct<start:bigint,stop:bigint,sentence:string>>")
