"""License scans with ordered signature rules.

Each rule is a regular expression with a label, a priority and keywords.  A
text is lower-cased (A-Z) and tried for the keywords first; only rules whose
keywords all occur are run.  Of overlapping detections the one of the higher
priority stands, then the longer, then the earlier; a detection inside an
accepted one is suppressed.

Base phrases are detections of their own: their places, words and labels are
reported whatever the rules add.

Edge cases: a null text is empty; a text without detections has labels "",
null first and last words and score 0; repeated rows each get their row; extra
columns are ignored."""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from firmo.llm.common import Words, blocks, column, pick, utf8

#: fixed values: phrase and label
BASE = {"gnu general public license": "gpl", "apache license": "apache", "cc by": "cc-by", "mit license": "mit"}

#: license families: label, names as they are written (words), versions
FAMILIES = [
    ("gpl", ["gnu general public license", "gnu gpl", "gpl"], ["1", "2", "3", "1.0", "2.0", "3.0"]),
    ("lgpl", ["gnu lesser general public license", "gnu library general public license", "lgpl"], ["2", "2.0", "2.1", "3", "3.0"]),
    ("agpl", ["gnu affero general public license", "affero general public license", "agpl"], ["1", "1.0", "3", "3.0"]),
    ("gfdl", ["gnu free documentation license", "gfdl"], ["1.1", "1.2", "1.3"]),
    ("apache", ["apache software license", "apache license", "asl"], ["1.0", "1.1", "2", "2.0"]),
    ("mit", ["mit license", "expat license", "x11 license"], []),
    ("bsd", ["bsd license", "berkeley software distribution"], []),
    ("bsd-2-clause", ["bsd 2 clause", "simplified bsd license", "freebsd license"], []),
    ("bsd-3-clause", ["bsd 3 clause", "modified bsd license", "new bsd license"], []),
    ("bsd-4-clause", ["bsd 4 clause", "original bsd license"], []),
    ("isc", ["isc license"], []),
    ("mpl", ["mozilla public license", "mpl"], ["1.0", "1.1", "2.0"]),
    ("epl", ["eclipse public license", "epl"], ["1.0", "2.0"]),
    ("cddl", ["common development and distribution license", "cddl"], ["1.0", "1.1"]),
    ("cpl", ["common public license"], ["1.0"]),
    ("eupl", ["european union public licence", "eupl"], ["1.0", "1.1", "1.2"]),
    ("artistic", ["artistic license", "perl artistic license"], ["1.0", "2.0"]),
    ("zlib", ["zlib license", "zlib libpng license"], []),
    ("bsl", ["boost software license"], ["1.0"]),
    ("busl", ["business source license"], ["1.1"]),
    ("unlicense", ["the unlicense"], []),
    ("wtfpl", ["wtfpl"], ["2"]),
    ("psf", ["python software foundation license", "psf license"], ["2"]),
    ("ofl", ["sil open font license", "open font license"], ["1.0", "1.1"]),
    ("odbl", ["open database license", "odbl"], ["1.0"]),
    ("postgresql", ["postgresql license"], []),
    ("openssl", ["openssl license"], []),
    ("php", ["php license"], ["3.0", "3.01"]),
    ("ruby", ["ruby license"], []),
    ("ms-pl", ["microsoft public license"], []),
    ("ms-rl", ["microsoft reciprocal license"], []),
    ("lppl", ["latex project public license"], ["1.0", "1.2", "1.3"]),
    ("sspl", ["server side public license"], ["1"]),
    ("afl", ["academic free license"], ["2.1", "3.0"]),
    ("osl", ["open software license"], ["2.1", "3.0"]),
    ("ncsa", ["ncsa open source license"], []),
    ("json", ["json license"], []),
    ("vim", ["vim license"], []),
    ("elastic", ["elastic license"], ["2.0"]),
    ("cecill", ["cecill license", "cecill"], ["1.0", "2.0", "2.1"]),
    ("cc-by", ["cc by", "creative commons attribution"], ["2.0", "2.5", "3.0", "4.0"]),
    ("cc-by-sa", ["cc by sa", "creative commons attribution sharealike", "creative commons attribution share alike"], ["2.0", "2.5", "3.0", "4.0"]),
    ("cc-by-nd", ["cc by nd", "creative commons attribution noderivatives"], ["2.0", "2.5", "3.0", "4.0"]),
    ("cc-by-nc", ["cc by nc", "creative commons attribution noncommercial"], ["2.0", "2.5", "3.0", "4.0"]),
    ("cc-by-nc-sa", ["cc by nc sa", "creative commons attribution noncommercial sharealike"], ["2.0", "2.5", "3.0", "4.0"]),
    ("cc-by-nc-nd", ["cc by nc nd", "creative commons attribution noncommercial noderivatives"], ["2.0", "2.5", "3.0", "4.0"]),
    ("cc0", ["cc0", "creative commons zero"], ["1.0"]),
]
#: further signatures: label, pattern over lower-cased text, keywords, priority, confidence
NOTICES = [
    ("mit", r"permission is hereby granted, free of charge, to any person obtaining a copy", ("hereby granted",), 95, 0.99),
    ("isc", r"permission to use, copy, modify, and/or distribute this software for any purpose", ("permission to use",), 95, 0.99),
    ("bsd", r"redistribution and use in source and binary forms, with or without modification", ("redistribution and use",), 95, 0.95),
    ("unlicense", r"this is free and unencumbered software released into the public domain", ("unencumbered",), 95, 0.99),
    ("public-domain", r"(?:released|placed|dedicated) (?:in|into|to) the public domain", ("public domain",), 60, 0.8),
    ("proprietary", r"all rights reserved", ("rights reserved",), 40, 0.5),
    ("proprietary", r"(?:proprietary and confidential|confidential and proprietary)", ("proprietary", "confidential"), 60, 0.8),
    ("copyright", r"copyright (?:\(c\)|\xc2\xa9|[0-9]{4})", ("copyright",), 20, 0.3),
    ("copyright", r"\xc2\xa9 ?[0-9]{4}", ("©",), 20, 0.3),
    ("spdx", r"spdx-license-identifier:[ \t]*[a-z0-9.+-]+", ("spdx",), 30, 0.9),
]
WORD = rb"[0-9a-z\x80-\xff]"
GAP = rb"[^0-9a-z\x80-\xff]+"


@dataclass(frozen=True)
class Rule:
    label: str
    pattern: re.Pattern[bytes]
    keywords: tuple[bytes, ...]
    priority: int
    confidence: float


def phrase(name: str) -> bytes:
    """Words one after the other, with anything but words between them."""
    return rb"(?<!" + WORD + rb")" + GAP.join(re.escape(w.encode()) for w in name.split()) + rb"(?!" + WORD + rb")"


def rules() -> list[Rule]:
    """All rules in order of priority: names with a version, names in a grant
    ("licensed under ..."), bare names, and the notices."""
    out = []
    for label, names, versions in FAMILIES:
        # an SPDX identifier depends on label and version alone
        for v in versions:
            out.append(Rule(f"{label}-{v}", re.compile(rb"spdx-license-identifier:[ \t]*" + re.escape(label.encode()) + rb"-" + re.escape(v.encode()) + rb"(?:-only|-or-later|\+)?(?![0-9a-z.])"), (b"spdx", v.encode()), 100, 1.0))
        out.append(Rule(label, re.compile(rb"spdx-license-identifier:[ \t]*" + re.escape(label.encode()) + rb"(?:-only|-or-later|\+)?(?![0-9a-z+-]|\.[0-9a-z])"), (b"spdx", label.encode()), 100, 1.0))
        for name in names:
            words = tuple(sorted((w.encode() for w in name.split()), key=len, reverse=True)[:2])
            body = phrase(name)
            for v in versions:
                number = re.escape(v.encode())
                out.append(Rule(f"{label}-{v}", re.compile(body + rb"(?:" + GAP + rb"version)?[^0-9a-z\x80-\xff]{1,4}v?" + number + rb"(?![0-9]|\.[0-9])(?:" + GAP + rb"or" + GAP + rb"later)?"), (*words, v.encode()), 90, 0.95))
            out.append(Rule(label, re.compile(rb"(?:licen[cs]ed|released|distributed|available|published)" + GAP + rb"under" + GAP + rb"(?:the" + GAP + rb"|a" + GAP + rb")?(?:terms" + GAP + rb"of" + GAP + rb"the" + GAP + rb")?" + body), (*words, b"under"), 80, 0.9))
            if len(name.split()) > 1:
                out.append(Rule(label, re.compile(body), words, 70, 0.7))
    for label, text, keys, priority, sure in NOTICES:
        raw = text.encode("latin-1")
        out.append(Rule(label, re.compile(raw.replace(b" ", rb"\s+")), tuple(k.encode() for k in keys), priority, sure))
    return sorted(out, key=lambda r: -r.priority)


class Scanner:
    """Rules with their prefilter.  A rule's first keyword names its group; a text
    is searched once for each distinct keyword, and only for rules still open."""

    def __init__(self) -> None:
        self.rules = rules()
        self.base = [(re.compile(phrase(p)), max(p.split(), key=len).encode() if p != "cc by" else b"cc", label, len(p.split())) for p, label in BASE.items()]
        self.keys = sorted({r.keywords[0] for r in self.rules}, key=len)

    def detect(self, low: bytes) -> list[tuple[int, int, str, float]]:
        """Accepted detections (start, end, label, confidence), by start."""
        have = {k for k in self.keys if k in low}
        if not have:
            return []
        found = []
        seen: dict[bytes, bool] = {}

        def holds(k):
            got = seen.get(k)
            if got is None:
                got = seen[k] = k in low
            return got

        for r in self.rules:
            if r.keywords[0] in have and all(map(holds, r.keywords)):
                found += [(-r.priority, m.start() - m.end(), m.start(), m.end(), r.label, r.confidence) for m in r.pattern.finditer(low)]
        taken: list[tuple[int, int, str, float]] = []
        covered = bytearray(len(low))               # bytes of accepted detections
        for _, _, a, b, label, sure in sorted(found):
            if covered.find(1, a, b) < 0:
                covered[a:b] = b"\1" * (b - a)
                taken.append((a, b, label, sure))
        return sorted(taken)

    def places(self, low: bytes) -> list[tuple[int, int, str]]:
        """(byte start, words, label) of every place of a base phrase."""
        return [(m.start(), n, label) for pattern, key, label, n in self.base if key in low for m in pattern.finditer(low)]


_scanner: list[Scanner] = []


def scanner() -> Scanner:
    if not _scanner:
        _scanner.append(Scanner())
    return _scanner[0]


LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))


def scan(docs: DataFrame) -> DataFrame:
    """(doc_id, byte_start, byte_end, label, confidence) of the accepted
    detections of every whole text."""
    need = pick(docs, "doc_id", "text")

    def run(batches):
        s = scanner()
        for b in blocks(batches, "text"):
            rows = [(i, *d) for i, t in enumerate(utf8(column(b, "text"))) for d in s.detect(t.translate(LOWER))]
            i, a, e, label, sure = zip(*rows, strict=True) if rows else ([],) * 5
            yield pa.RecordBatch.from_arrays([column(b, "doc_id").take(pa.array(i, pa.int64())), pa.array(a, pa.int64()), pa.array(e, pa.int64()), pa.array(label, pa.string()), pa.array(sure, pa.float64())],
                                             names=["doc_id", "byte_start", "byte_end", "label", "confidence"])

    return need.mapInArrow(run, f"doc_id {dict(need.dtypes)['doc_id']}, byte_start long, byte_end long, label string, confidence double")


def query(docs: DataFrame) -> DataFrame:
    need = pick(docs, "doc_id", "text")

    def run(batches):
        s = scanner()
        for b in blocks(batches, "text"):
            texts = utf8(column(b, "text"))
            w = Words(texts)
            first, last, n_base, base_labels, labels, score = [], [], [], [], [], []
            for i, t in enumerate(texts):
                low = t.translate(LOWER)
                got, base = s.detect(low), s.places(low)
                at = [int(np.searchsorted(w.starts, w.at[i] + p)) - int(w.first[i]) for p, _, _ in base]
                own = {x for _, _, x in base}
                n_base.append(len(base))
                first.append(min(at, default=None))
                last.append(max(at, default=None))
                base_labels.append(",".join(sorted(own)))
                labels.append(",".join(sorted(own | {x for _, _, x, _ in got})))
                score.append(max([0.6 * bool(base), *(x for _, _, _, x in got)]))
            yield pa.RecordBatch.from_arrays(
                [column(b, "doc_id"), pa.array(w.counts.astype(np.int64)), pa.array(n_base, pa.int64()), pa.array(first, pa.int64()),
                 pa.array(last, pa.int64()), pa.array(base_labels, pa.string()), pa.array(labels, pa.string()), pa.array(score, pa.float64())],
                names=["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"])

    return need.mapInArrow(run, f"doc_id {dict(need.dtypes)['doc_id']}, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double")
