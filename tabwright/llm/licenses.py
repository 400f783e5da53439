"""License scan by ordered signature rules.

Rules are regexes over the lower-cased text, in order of priority. A rule is tried only on texts
that hold its keyword. Detections are ordered by priority; one whose interval lies within that
of a detection of the same or a better priority is suppressed. What is left gives the labels.

The base phrases fixed by contract are counted over words, apart from the rules.
"""

from __future__ import annotations

import re
from bisect import bisect_left, bisect_right
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tabwright.llm.words import ALPHANUMERIC, bounds, byte_texts, fresh

#: Base phrases and their labels, fixed by contract.
PHRASES = ((("cc", "by"), "cc-by"), (("general", "public", "license"), "gpl"), (("all", "rights", "reserved"), "reserved"))


@dataclass(frozen=True)
class Signature:
    """``keyword`` is in every text that the pattern matches; a lower ``priority`` wins."""

    label: str
    keyword: str
    pattern: str
    priority: int
    score: float


# Signatures in groups of falling certainty. A line is: label, keyword, regex. In a regex a blank stands
# for any run of blanks and line breaks (comment marks at line starts included).
_TAGS = """
0bsd 0bsd
aal aal
afl-3.0 afl-3
agpl-3.0 agpl-3
apache-1.1 apache-1.1
apache-2.0 apache-2.0
artistic-2.0 artistic-2
beerware beerware
bsd-2-clause bsd-2-clause
bsd-3-clause bsd-3-clause
bsd-4-clause bsd-4-clause
bsl-1.0 bsl-1.0
cc0-1.0 cc0-1.0
cc-by-3.0 cc-by-3
cc-by-4.0 cc-by-4
cc-by-nc-4.0 cc-by-nc-4
cc-by-nc-nd-4.0 cc-by-nc-nd-4
cc-by-nc-sa-4.0 cc-by-nc-sa-4
cc-by-nd-4.0 cc-by-nd-4
cc-by-sa-3.0 cc-by-sa-3
cc-by-sa-4.0 cc-by-sa-4
cddl-1.0 cddl-1.0
cecill-2.1 cecill-2.1
cpal-1.0 cpal-1.0
ecl-2.0 ecl-2.0
epl-1.0 epl-1.0
epl-2.0 epl-2.0
eupl-1.2 eupl-1.2
gfdl-1.3 gfdl-1.3
gpl-2.0 gpl-2.0
gpl-3.0 gpl-3.0
isc isc
lgpl-2.1 lgpl-2.1
lgpl-3.0 lgpl-3.0
mit mit
mpl-1.1 mpl-1.1
mpl-2.0 mpl-2.0
ms-pl ms-pl
ncsa ncsa
odbl-1.0 odbl-1.0
ofl-1.1 ofl-1.1
osl-3.0 osl-3.0
postgresql postgresql
psf-2.0 psf-2.0
python-2.0 python-2.0
unlicense unlicense
upl-1.0 upl-1.0
w3c w3c
wtfpl wtfpl
zlib zlib
zpl-2.1 zpl-2.1
"""
_NOTICES = r"""
apache-2.0|apache|apache license,? version 2(\.0)?
apache-2.0|apache|apache license,? v(ersion)? ?2(\.0)?
apache-2.0|apache|apache 2(\.0)? license
apache-2.0|apache|licensed under the apache license, version 2
apache-1.1|apache|apache software license,? version 1\.1
apache-1.0|apache|apache software license,? version 1\.0
gpl-3.0|general public license|gnu general public license,? (version |v\.? ?)3(\.0)?
gpl-2.0|general public license|gnu general public license,? (version |v\.? ?)2(\.0)?
gpl-1.0|general public license|gnu general public license,? (version |v\.? ?)1(\.0)?
gpl-3.0-or-later|any later version|gnu general public license .{0,160}version 3.{0,80}any later version
gpl-2.0-or-later|any later version|gnu general public license .{0,160}version 2.{0,80}any later version
lgpl-3.0|lesser general public license|gnu lesser general public license,? (version |v\.? ?)3(\.0)?
lgpl-2.1|lesser general public license|gnu lesser general public license,? (version |v\.? ?)2\.1
lgpl-2.0|library general public license|gnu library general public license,? (version |v\.? ?)2(\.0)?
agpl-3.0|affero general public license|gnu affero general public license,? (version |v\.? ?)3(\.0)?
gfdl-1.3|free documentation license|gnu free documentation license,? version 1\.3
gfdl-1.2|free documentation license|gnu free documentation license,? version 1\.2
mpl-2.0|mozilla public license|mozilla public license,? (version |v\.? ?)2(\.0)?
mpl-1.1|mozilla public license|mozilla public license,? (version |v\.? ?)1\.1
epl-2.0|eclipse public license|eclipse public license,? (- )?(version |v\.? ?)2(\.0)?
epl-1.0|eclipse public license|eclipse public license,? (- )?(version |v\.? ?)1(\.0)?
eupl-1.2|european union public|european union public licen[cs]e,? (version |v\.? ?)1\.2
eupl-1.1|european union public|european union public licen[cs]e,? (version |v\.? ?)1\.1
cddl-1.0|common development and distribution license|common development and distribution license,?.{0,12}version 1\.0
cpl-1.0|common public license|common public license,? version 1\.0
artistic-2.0|artistic license|artistic license,? (version )?2(\.0)?
artistic-1.0|artistic license|artistic license,? (version )?1(\.0)?
osl-3.0|open software license|open software license,? (version |v\.? ?)3\.0
afl-3.0|academic free license|academic free license,? (version |v\.? ?)3\.0
ecl-2.0|educational community license|educational community license,? version 2\.0
ofl-1.1|sil open font license|sil open font license,? version 1\.1
bsl-1.0|boost software license|boost software license,? - version 1\.0
bsl-1.0|boost software license|boost software license,? version 1\.0
busl-1.1|business source license|business source license,? (version )?1\.1
odbl-1.0|database|open (data commons open )?database licen[cs]e
odc-by-1.0|open data commons attribution license|open data commons attribution license
pddl-1.0|public domain dedication and license|public domain dedication and license
ms-pl|microsoft public license|microsoft public license
ms-rl|microsoft reciprocal license|microsoft reciprocal license
zlib|zlib|zlib/libpng license
zpl-2.1|zope public license|zope public license,? \(?(zpl\)? )?version 2\.1
php-3.01|php license|php license,? (version )?3\.01
python-2.0|python software foundation license|python software foundation license,? version 2
sspl-1.0|server side public license|server side public license,? (version |v\.? ?)1
elastic-2.0|elastic license|elastic license,? 2\.0
polyform-noncommercial|polyform|polyform noncommercial license
polyform-shield|polyform|polyform shield license
cc-by-nc-nd-4.0|cc|cc[ -]by[ -]nc[ -]nd[ -]4(\.0)?
cc-by-nc-sa-4.0|cc|cc[ -]by[ -]nc[ -]sa[ -]4(\.0)?
cc-by-nc-4.0|cc|cc[ -]by[ -]nc[ -]4(\.0)?
cc-by-nd-4.0|cc|cc[ -]by[ -]nd[ -]4(\.0)?
cc-by-sa-4.0|cc|cc[ -]by[ -]sa[ -]4(\.0)?
cc-by-4.0|cc|cc[ -]by[ -]4(\.0)?
cc-by-nc-nd-3.0|cc|cc[ -]by[ -]nc[ -]nd[ -]3(\.0)?
cc-by-nc-sa-3.0|cc|cc[ -]by[ -]nc[ -]sa[ -]3(\.0)?
cc-by-nc-3.0|cc|cc[ -]by[ -]nc[ -]3(\.0)?
cc-by-nd-3.0|cc|cc[ -]by[ -]nd[ -]3(\.0)?
cc-by-sa-3.0|cc|cc[ -]by[ -]sa[ -]3(\.0)?
cc-by-3.0|cc|cc[ -]by[ -]3(\.0)?
cc-by-sa-2.0|cc|cc[ -]by[ -]sa[ -]2(\.0)?
cc-by-2.0|cc|cc[ -]by[ -]2(\.0)?
cc0-1.0|cc0|cc0[ -]1(\.0)?
cc-by-nc-nd-4.0|creative commons|creative commons attribution[ -]non-?commercial[ -]no-?deriv(ative)?s 4\.0
cc-by-nc-sa-4.0|creative commons|creative commons attribution[ -]non-?commercial[ -]share-?alike 4\.0
cc-by-nc-4.0|creative commons|creative commons attribution[ -]non-?commercial 4\.0
cc-by-nd-4.0|creative commons|creative commons attribution[ -]no-?deriv(ative)?s 4\.0
cc-by-sa-4.0|creative commons|creative commons attribution[ -]share-?alike 4\.0
cc-by-4.0|creative commons|creative commons attribution 4\.0
cc-by-nc-sa-3.0|creative commons|creative commons attribution[ -]non-?commercial[ -]share-?alike 3\.0
cc-by-sa-3.0|creative commons|creative commons attribution[ -]share-?alike 3\.0
cc-by-3.0|creative commons|creative commons attribution 3\.0
mit|permission is hereby granted|permission is hereby granted, free of charge, to any person obtaining a copy
isc|permission to use, copy|permission to use, copy, modify, and(/or)? distribute this software for any purpose
bsd-3-clause|redistribution and use|redistribution and use in source and binary forms.{0,1200}neither the name
bsd-2-clause|redistribution and use|redistribution and use in source and binary forms
unlicense|unencumbered software|free and unencumbered software released into the public domain
wtfpl|fuck|do what the fuck you want to public license
beerware|beer-ware|the beer-ware license
cecill-2.1|cecill|cecill free software license agreement.{0,40}2\.1
json|shall be used for good|shall be used for good, not evil
"""
_ADDRESSES = r"""
apache-2.0|apache.org/licenses|apache\.org/licenses/license-2\.0
apache-1.1|apache.org/licenses|apache\.org/licenses/license-1\.1
gpl-3.0|gnu.org/licenses|gnu\.org/licenses/gpl-3\.0
gpl-2.0|gnu.org/licenses|gnu\.org/licenses/(old-licenses/)?gpl-2\.0
lgpl-3.0|gnu.org/licenses|gnu\.org/licenses/lgpl-3\.0
lgpl-2.1|gnu.org/licenses|gnu\.org/licenses/(old-licenses/)?lgpl-2\.1
agpl-3.0|gnu.org/licenses|gnu\.org/licenses/agpl-3\.0
gfdl-1.3|gnu.org/licenses|gnu\.org/licenses/fdl-1\.3
mpl-2.0|mozilla.org/mpl|mozilla\.org/mpl/2\.0
mpl-1.1|mozilla.org/mpl|mozilla\.org/mpl/(mpl-)?1\.1
epl-2.0|eclipse.org/legal|eclipse\.org/legal/epl-(v)?2
epl-1.0|eclipse.org/legal|eclipse\.org/legal/epl-(v)?1
mit|opensource.org/licenses|opensource\.org/licenses/mit
isc|opensource.org/licenses|opensource\.org/licenses/isc
bsd-3-clause|opensource.org/licenses|opensource\.org/licenses/bsd-3-clause
bsd-2-clause|opensource.org/licenses|opensource\.org/licenses/bsd-2-clause
zlib|opensource.org/licenses|opensource\.org/licenses/zlib
artistic-2.0|opensource.org/licenses|opensource\.org/licenses/artistic-2\.0
osl-3.0|opensource.org/licenses|opensource\.org/licenses/osl-3\.0
afl-3.0|opensource.org/licenses|opensource\.org/licenses/afl-3\.0
ms-pl|opensource.org/licenses|opensource\.org/licenses/ms-pl
eupl-1.2|opensource.org/licenses|opensource\.org/licenses/eupl-1\.2
cc-by-nc-nd-4.0|creativecommons.org|creativecommons\.org/licenses/by-nc-nd/4\.0
cc-by-nc-sa-4.0|creativecommons.org|creativecommons\.org/licenses/by-nc-sa/4\.0
cc-by-nc-4.0|creativecommons.org|creativecommons\.org/licenses/by-nc/4\.0
cc-by-nd-4.0|creativecommons.org|creativecommons\.org/licenses/by-nd/4\.0
cc-by-sa-4.0|creativecommons.org|creativecommons\.org/licenses/by-sa/4\.0
cc-by-4.0|creativecommons.org|creativecommons\.org/licenses/by/4\.0
cc-by-nc-nd-3.0|creativecommons.org|creativecommons\.org/licenses/by-nc-nd/3\.0
cc-by-nc-sa-3.0|creativecommons.org|creativecommons\.org/licenses/by-nc-sa/3\.0
cc-by-nc-3.0|creativecommons.org|creativecommons\.org/licenses/by-nc/3\.0
cc-by-nd-3.0|creativecommons.org|creativecommons\.org/licenses/by-nd/3\.0
cc-by-sa-3.0|creativecommons.org|creativecommons\.org/licenses/by-sa/3\.0
cc-by-3.0|creativecommons.org|creativecommons\.org/licenses/by/3\.0
cc0-1.0|creativecommons.org|creativecommons\.org/publicdomain/zero/1\.0
pdm-1.0|creativecommons.org|creativecommons\.org/publicdomain/mark/1\.0
odbl-1.0|opendatacommons.org|opendatacommons\.org/licenses/odbl
odc-by-1.0|opendatacommons.org|opendatacommons\.org/licenses/by
pddl-1.0|opendatacommons.org|opendatacommons\.org/licenses/pddl
bsl-1.0|boost.org/license|boost\.org/license_1_0
ofl-1.1|scripts.sil.org/ofl|scripts\.sil\.org/ofl
unlicense|unlicense.org|unlicense\.org
wtfpl|wtfpl.net|wtfpl\.net
sspl-1.0|mongodb.com/licensing|mongodb\.com/licensing/server-side-public-license
elastic-2.0|elastic.co/licensing|elastic\.co/licensing/elastic-license
"""
_NAMES = r"""
mit|mit|(released|licensed|distributed|available) under (the )?(terms of the )?mit( license)?
mit|mit license|mit license
mit|mit licence|mit licence
mit|expat|expat license
apache|apache license|apache license
apache|apache|(released|licensed|distributed|available) under (the )?apache
gpl|general public license|general public license
gpl|gpl|(released|licensed|distributed|available) under (the )?(gnu )?gpl
gpl|gpl|gplv[123]
lgpl|lgpl|lgplv?(2|3)
lgpl|lesser general public license|lesser general public license
agpl|agpl|agplv?3
agpl|affero general public license|affero general public license
gfdl|free documentation license|free documentation license
mpl|mozilla public license|mozilla public license
mpl|mpl|(released|licensed|distributed|available) under (the )?mpl
epl|eclipse public license|eclipse public license
eupl|european union public|european union public licen[cs]e
cddl|common development and distribution license|common development and distribution license
artistic|artistic license|artistic license
bsd|bsd|(2|3|4|two|three|four)-clause bsd( license)?
bsd|bsd|(modified|simplified|new|revised|original) bsd license
bsd|bsd license|bsd(-style)? license
isc|isc license|isc license
zlib|zlib license|zlib license
boost|boost software license|boost software license
ofl|open font license|open font license
psf|python software foundation|python software foundation license
php|php license|php license
ruby|ruby license|ruby license
perl|same terms as perl|same terms as perl( itself)?
postgresql|postgresql|postgresql licen[cs]e
openssl|openssl license|openssl license
unlicense|unlicense|the unlicense
cc0|cc0|cc0
public-domain|public domain|(dedicated to|placed in|released into|in) the public domain
public-domain|public domain|public domain (dedication|mark)
cc-by-nc-nd|cc|cc[ -]by[ -]nc[ -]nd
cc-by-nc-sa|cc|cc[ -]by[ -]nc[ -]sa
cc-by-nc|cc|cc[ -]by[ -]nc
cc-by-nd|cc|cc[ -]by[ -]nd
cc-by-sa|cc|cc[ -]by[ -]sa
cc-by|cc|cc[ -]by
cc-by-nc-sa|creative commons|creative commons attribution[ -]non-?commercial[ -]share-?alike
cc-by-nc|creative commons|creative commons attribution[ -]non-?commercial
cc-by-sa|creative commons|creative commons attribution[ -]share-?alike
cc-by|creative commons|creative commons attribution
creative-commons|creative commons|creative commons
open-government|open government|open government licen[cs]e
"""
#: ``.{0,60}`` is that rule's own extent: what is prohibited is named within 60 characters.
_TERMS = r"""
reserved|all rights reserved|all rights reserved
reserved|alle rechte vorbehalten|alle rechte vorbehalten
reserved|tous droits|tous droits réservés
reserved|todos los derechos|todos los derechos reservados
reserved|tutti i diritti|tutti i diritti riservati
reserved|todos os direitos|todos os direitos reservados
proprietary|proprietary and confidential|proprietary and confidential
proprietary|unauthorized copying|unauthorized copying .{0,60}prohibited
proprietary|no part of this|no part of this (publication|work|book|document) may be reproduced
proprietary|may not be reproduced|may not be reproduced
proprietary|may not be redistributed|may not be redistributed
proprietary|end user license agreement|end user license agreement
proprietary|trade secret|trade secrets? of
proprietary|commercial license|under a commercial license
personal-use|personal use only|for personal use only
personal-use|private use only|for private use only
non-commercial|non-commercial|(for )?non-commercial (use|purposes)( only)?
non-commercial|noncommercial|(for )?noncommercial (use|purposes)( only)?
research-only|research purposes only|for research purposes only
research-only|academic use only|for academic use only
evaluation|evaluation purposes|for evaluation purposes only
permission|used with permission|used with permission
permission|reprinted with permission|reprinted with permission
permission|reproduced with permission|reproduced with permission
copyright|copyright|copyright (\(c\)|©)? ?(19|20)[0-9]{2}
copyright|©|© ?(19|20)[0-9]{2}
copyright|(c)|\(c\) ?(19|20)[0-9]{2}
warranty|without warranty|without warranty of any kind
warranty|provided|provided ["'`“]{0,2}as is["'`”]{0,2}
"""
#: Between two words: any number of blanks, line ends and comment marks, never given back.
_GAP = r"(?:[\s*#/;%-]++)"


def signatures() -> list[Signature]:
    """All rules in order: tags, notices with a version, addresses, names, terms."""
    out: list[Signature] = []

    def add(label: str, keyword: str, pattern: str, score: float) -> None:
        spaced = re.sub(r"(?<!\[) (?![\]?-])", lambda _: _GAP, pattern)
        # the longest word: between words there may be more than a blank
        out.append(Signature(label, max(keyword.split(), key=len), spaced + r"(?![^\W_])", len(out), score))

    for line in _TAGS.split("\n"):
        if line:
            label, tag = line.split(" ")
            add(label, "spdx-license-identifier", rf"spdx-license-identifier: ?\(?{re.escape(tag)}(\.0)?(-only|-or-later)?", 1.0)
            add(label, "license", rf"""license["']?[:=] ?["']?{re.escape(tag)}["']?""", 0.9)
    for block, score in ((_NOTICES, 0.95), (_ADDRESSES, 0.9), (_NAMES, 0.7), (_TERMS, 0.4)):
        for line in block.split("\n"):
            if line:
                label, keyword, pattern = line.split("|", 2)
                add(label, keyword, pattern, score)
    return out


class Scanner:
    """All rules, compiled once per worker."""

    def __init__(self, rules: list[Signature]):
        self.by_keyword: dict[str, list[tuple[Signature, re.Pattern]]] = {}
        for rule in rules:
            self.by_keyword.setdefault(rule.keyword, []).append((rule, re.compile(rule.pattern, re.DOTALL)))

    def detections(self, text: str) -> list[tuple[Signature, int, int]]:
        """Detections that no other one contains, in order of priority and place. ``text`` is
        lower-cased."""
        found = [(rule, m.start(), m.end())
                 for keyword, rules in self.by_keyword.items() if keyword in text
                 for rule, pattern in rules for m in pattern.finditer(text)
                 # a name within another word is none
                 if not (m.start() and text[m.start()].isalnum() and text[m.start() - 1].isalnum())]
        return suppressed(found)


def suppressed(found: list[tuple[Signature, int, int]]) -> list[tuple[Signature, int, int]]:
    """Without detections that lie within one of a better priority, or of the same rule.

    Of the kept intervals those matter that no other one contains; by start they are also
    ascending by end, so a binary search finds the one that reaches furthest.
    """
    kept: list[tuple[Signature, int, int]] = []
    starts: list[int] = []
    ends: list[int] = []
    for rule, a, b in sorted(found, key=lambda d: (d[0].priority, d[1], -d[2])):
        at = bisect_right(starts, a)
        if at and ends[at - 1] >= b:
            continue
        kept.append((rule, a, b))
        low, high = bisect_left(starts, a), bisect_right(ends, b)
        starts[low:high], ends[low:high] = [a], [b]
    return kept


def phrase_places(data: bytes) -> tuple[int, list[tuple[int, str]]]:
    """Number of words of a lower-cased text, and (first word, label) of every base phrase."""
    starts, ends = bounds(data, ALPHANUMERIC)
    out: list[tuple[int, str]] = []
    for phrase, label in PHRASES:
        first = phrase[0].encode()
        at = data.find(first)
        while at >= 0:
            i = int(np.searchsorted(starts, at))
            if i < len(starts) and starts[i] == at and [data[a:b] for a, b in zip(starts[i: i + len(phrase)], ends[i: i + len(phrase)])] \
                    == [w.encode() for w in phrase]:
                out.append((i, label))
            at = data.find(first, at + 1)
    return len(starts), sorted(out)


def scan(docs: DataFrame, *, text: str = "text", rules: list[Signature] | None = None) -> tuple[DataFrame, list[str]]:
    """The documents without their text and with new columns, whose names are returned: number
    of words, places of base phrases (first word), their labels (distinct, sorted), all labels
    (distinct, sorted), detections (label, start, end in characters; score) and the best score.

    Null and empty texts have none. Every row is scanned on its own and whole.
    """
    rules = signatures() if rules is None else rules
    rest = [c for c in docs.columns if c != text]
    names = fresh(docs, "n_words", "base_words", "base_labels", "labels", "detections", "score")
    hit = "array<struct<label:string,start:int,end:int,score:double>>"
    types = ("long", "array<long>", "array<string>", "array<string>", hit, "double")
    hit_type = pa.list_(pa.struct([("label", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("score", pa.float64())]))
    arrow = (pa.int64(), pa.list_(pa.int64()), pa.list_(pa.string()), pa.list_(pa.string()), hit_type, pa.float64())

    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(rules)
        for batch in batches:
            columns: list[list] = [[] for _ in names]
            for data in byte_texts(batch.column(text)):
                data = (data or b"").lower()
                n, places = phrase_places(data)
                found = scanner.detections(data.decode("utf-8", "replace"))
                base = sorted({label for _, label in places})
                row = (n, [i for i, _ in places], base, sorted({*base, *(r.label for r, _, _ in found)}),
                       [{"label": r.label, "start": a, "end": b, "score": r.score} for r, a, b in sorted(found, key=lambda d: d[1:])],
                       max([0.7] * bool(places) + [r.score for r, _, _ in found], default=0.0))
                for column, value in zip(columns, row):
                    column.append(value)
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in rest), *(pa.array(c, t) for c, t in zip(columns, arrow))], names=[*rest, *names])

    schema = docs.select(*rest).selectExpr("*", *(f"CAST(NULL AS {t}) AS {n}" for n, t in zip(names, types))).schema
    return docs.select(*rest, text).mapInArrow(work, schema), names


def license_report(docs: DataFrame) -> DataFrame:
    """Per document: doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score."""
    found, (n_words, places, base, labels, _, score) = scan(docs.select("doc_id", "text"))
    return found.selectExpr(
        "doc_id", f"{n_words} AS n_words", f"CAST(size({places}) AS BIGINT) AS n_base", f"array_min({places}) AS first_word",
        f"array_max({places}) AS last_word", f"array_join({base}, ',') AS base_labels", f"array_join({labels}, ',') AS labels",
        f"{score} AS score")
