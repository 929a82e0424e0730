"""License scans by ordered signature rules.

A text becomes its lower-case words joined by blanks. Each rule is a pattern over these words, with a
label and a priority. What every match must hold (one of some stretches, for each part of the pattern) is read off the pattern
itself; only rules whose stretches occur are tried, so none that matches is left out. Where detections overlap, one
that lies inside a detection of the same or a higher priority is suppressed; equal stretches go to the earlier rule
of the higher priority. The three base phrases are always reported.

One row per row of the input, in no order; repeated rows and ids give one row each. A null text counts as empty:
no words, no detections, score 0. Other columns are ignored. Texts of any length are scanned whole.
"""

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
from re import _parser

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillwise.llm.common import slices, table

BASE = (
    (b"under the mit license", "mit"),
    (b"apache license version 2", "apache-2"),
    (b"cc by nc", "cc-by-nc"),
)

# label, name as a pattern over words, identifier as words
LICENSES = (
    ("mit", r"mit|expat|x11 mit", r"mit(?: 0)?"),
    ("apache-1.1", r"apache (?:software )?license,? (?:version )?1 1", r"apache 1 1"),
    ("apache-2", r"apache (?:software )?(?:license )?(?:version |v )?2(?: 0)?", r"apache 2 0"),
    ("bsd-2-clause", r"(?:simplified|freebsd|2 clause|two clause) bsd|bsd 2 clause", r"bsd 2 clause"),
    ("bsd-3-clause", r"(?:new|modified|revised|3 clause|three clause) bsd|bsd 3 clause", r"bsd 3 clause"),
    ("bsd-4-clause", r"(?:original|old|4 clause|four clause) bsd|bsd 4 clause", r"bsd 4 clause"),
    ("0bsd", r"zero clause bsd|bsd zero clause", r"0bsd"),
    ("gpl-1", r"(?:gnu )?(?:general public license|gpl)(?: gpl)? (?:version |v )?1(?: 0)?|gplv1", r"gpl 1 0(?: only| or later)?"),
    ("gpl-2", r"(?:gnu )?(?:general public license|gpl)(?: gpl)? (?:version |v )?2(?: 0)?|gplv2", r"gpl 2 0(?: only| or later)?"),
    ("gpl-3", r"(?:gnu )?(?:general public license|gpl)(?: gpl)? (?:version |v )?3(?: 0)?|gplv3", r"gpl 3 0(?: only| or later)?"),
    ("lgpl-2", r"(?:gnu )?(?:library general public license|lgpl)(?: lgpl)? (?:version |v )?2(?: 0)?|lgplv2", r"lgpl 2 0(?: only| or later)?"),
    ("lgpl-2.1", r"(?:gnu )?(?:lesser general public license|lgpl)(?: lgpl)? (?:version |v )?2 1|lgplv2 1", r"lgpl 2 1(?: only| or later)?"),
    ("lgpl-3", r"(?:gnu )?(?:lesser general public license|lgpl)(?: lgpl)? (?:version |v )?3(?: 0)?|lgplv3", r"lgpl 3 0(?: only| or later)?"),
    ("agpl-3", r"(?:gnu )?(?:affero general public license|agpl)(?: agpl)? (?:version |v )?3(?: 0)?|agplv3", r"agpl 3 0(?: only| or later)?"),
    ("fdl-1.2", r"(?:gnu )?free documentation license (?:version |v )?1 2", r"gfdl 1 2(?: only| or later)?"),
    ("fdl-1.3", r"(?:gnu )?free documentation license (?:version |v )?1 3", r"gfdl 1 3(?: only| or later)?"),
    ("mpl-1.1", r"mozilla public license (?:version |v )?1 1|mpl 1 1", r"mpl 1 1"),
    ("mpl-2", r"mozilla public license (?:version |v )?2(?: 0)?|mpl 2(?: 0)?", r"mpl 2 0"),
    ("epl-1", r"eclipse public license (?:version |v )?1(?: 0)?|epl 1 0", r"epl 1 0"),
    ("epl-2", r"eclipse public license (?:version |v )?2(?: 0)?|epl 2 0", r"epl 2 0"),
    ("eupl-1.2", r"european union public licen[cs]e (?:version |v )?1 2|eupl(?: version| v)? 1 2", r"eupl 1 2"),
    ("cddl-1", r"common development and distribution license (?:version |v )?1(?: 0)?|cddl 1 0", r"cddl 1 0"),
    ("cpl-1", r"common public license (?:version |v )?1(?: 0)?", r"cpl 1 0"),
    ("cc0-1", r"cc0(?: 1 0)?(?: universal)?|creative commons zero", r"cc0 1 0"),
    ("cc-by", r"cc by(?: [1-4] [0-9])?(?! n| s)|creative commons attribution(?: [1-4] [0-9])?(?: international)?(?! non| share| no)", r"cc by [1-4] [0-9]"),
    ("cc-by-sa", r"cc by sa(?: [1-4] [0-9])?|creative commons attribution sharealike(?: [1-4] [0-9])?", r"cc by sa [1-4] [0-9]"),
    ("cc-by-nd", r"cc by nd(?: [1-4] [0-9])?|creative commons attribution noderiv(?:ative)?s(?: [1-4] [0-9])?", r"cc by nd [1-4] [0-9]"),
    ("cc-by-nc", r"cc by nc(?: [1-4] [0-9])?(?! sa| nd)|creative commons attribution noncommercial(?: [1-4] [0-9])?(?! share| noder)", r"cc by nc [1-4] [0-9]"),
    ("cc-by-nc-sa", r"cc by nc sa(?: [1-4] [0-9])?|creative commons attribution noncommercial sharealike", r"cc by nc sa [1-4] [0-9]"),
    ("cc-by-nc-nd", r"cc by nc nd(?: [1-4] [0-9])?|creative commons attribution noncommercial noderiv(?:ative)?s", r"cc by nc nd [1-4] [0-9]"),
    ("artistic-1", r"(?:perl )?artistic license (?:version |v )?1(?: 0)?", r"artistic 1 0(?: perl| cl8)?"),
    ("artistic-2", r"artistic license (?:version |v )?2(?: 0)?", r"artistic 2 0"),
    ("isc", r"isc", r"isc"),
    ("zlib", r"zlib(?: libpng)?", r"zlib(?: acknowledgement)?"),
    ("boost-1", r"boost software license(?: version| v)?(?: 1(?: 0)?)?", r"bsl 1 0"),
    ("unlicense", r"unlicense", r"unlicense"),
    ("wtfpl", r"wtfpl|do what the fuck you want to public license", r"wtfpl"),
    ("postgresql", r"postgresql", r"postgresql"),
    ("python-2", r"python software foundation license|psf license", r"(?:python|psf) 2 0"),
    ("openssl", r"openssl", r"openssl"),
    ("ofl-1.1", r"sil open font license(?: version| v)?(?: 1 1)?|ofl 1 1", r"ofl 1 1"),
    ("ms-pl", r"microsoft public license|ms pl", r"ms pl"),
    ("ms-rl", r"microsoft reciprocal license|ms rl", r"ms rl"),
    ("vim", r"vim", r"vim"),
    ("php-3", r"php license(?: version| v)? 3(?: 0[01]?)?", r"php 3 0[01]?"),
    ("ruby", r"ruby", r"ruby"),
    ("odbl-1", r"open (?:data commons open )?database license(?: 1 0)?|odbl(?: 1 0)?", r"odbl 1 0"),
    ("odc-by-1", r"open data commons attribution license(?: 1 0)?|odc by(?: 1 0)?", r"odc by 1 0"),
    ("pddl-1", r"public domain dedication and license(?: 1 0)?|pddl(?: 1 0)?", r"pddl 1 0"),
    ("osl-3", r"open software license (?:version |v )?3(?: 0)?", r"osl 3 0"),
    ("afl-3", r"academic free license (?:version |v )?3(?: 0)?", r"afl 3 0"),
    ("bsl-1.1", r"business source license(?: version| v)?(?: 1 1)?", r"busl 1 1"),
    ("sspl-1", r"server side public license(?: version| v)?(?: 1)?|sspl", r"sspl 1 0"),
    ("elastic-2", r"elastic license(?: version| v)? 2(?: 0)?", r"elastic 2 0"),
    ("openrail", r"(?:bigscience )?(?:open ?)?rail m?|creativeml open ?rail m", r"openrail"),
    ("llama", r"llama [0-9](?: [0-9])? community", r"llama [0-9](?: [0-9])?"),
    ("hpnd", r"historical permission notice and disclaimer", r"hpnd"),
    ("blueoak-1", r"blue oak model license(?: 1 0 0)?", r"blueoak 1 0 0"),
    ("upl-1", r"universal permissive license(?: version| v)?(?: 1(?: 0)?)?", r"upl 1 0"),
    ("ncsa", r"(?:university of illinois )?ncsa(?: open source)?", r"ncsa"),
)

# rules that stand for themselves: label, pattern over words, priority
NOTICES = (
    ("mit", r"permission is hereby granted free of charge to any person obtaining a copy of this software", 85),
    ("isc", r"permission to use copy modify and or distribute this software for any purpose with or without fee", 85),
    ("bsd-3-clause", r"neither the names? of .{1,80} nor the names of its contributors may be used", 84),
    ("bsd-2-clause", r"redistributions of source code must retain the above copyright notice", 40),
    ("gpl", r"(?:gnu )?general public license|gnu gpl", 45),
    ("lgpl", r"(?:gnu )?lesser general public license|gnu lgpl", 46),
    ("agpl", r"(?:gnu )?affero general public license|gnu agpl", 46),
    ("bsd", r"bsd (?:style )?license", 45),
    ("apache", r"apache (?:software )?license", 45),
    ("cc", r"creative commons(?: license)?", 40),
    ("public-domain", r"(?:in|into|to) the public domain|public domain dedication", 50),
    ("proprietary", r"all rights reserved", 30),
    ("proprietary", r"proprietary and confidential", 55),
    ("apache-2", r"www apache org licenses license 2 0", 75),
    ("mit", r"opensource org licenses mit", 75),
    ("gpl-3", r"www gnu org licenses gpl 3 0", 75),
    ("gpl-2", r"www gnu org licenses (?:old licenses )?gpl 2 0", 75),
    ("mpl-2", r"(?:www )?mozilla org (?:en us )?mpl 2 0", 75),
    ("cc-by", r"creativecommons org licenses by [1-4] [0-9]", 75),
    ("cc-by-sa", r"creativecommons org licenses by sa [1-4] [0-9]", 75),
    ("cc-by-nc", r"creativecommons org licenses by nc [1-4] [0-9]", 75),
    ("cc-by-nc-sa", r"creativecommons org licenses by nc sa [1-4] [0-9]", 75),
    ("cc-by-nd", r"creativecommons org licenses by nd [1-4] [0-9]", 75),
    ("cc0-1", r"creativecommons org publicdomain zero 1 0", 75),
)

_GRANT = r"(?:licen[cs]ed|released|distributed|published|available|provided|modify it|covered|offered) under (?:the )?(?:terms (?:and conditions )?of (?:the )?)?"


@dataclass(frozen=True)
class Rule:
    name: str
    label: str
    needs: tuple[frozenset[bytes], ...]  # of each set, every match holds a member
    pattern: re.Pattern[bytes]
    priority: int


def _needs(parsed) -> list[frozenset[bytes]]:
    """Sets of stretches of a parsed pattern: whatever it matches holds a member of each set."""
    out, run = [], ""
    for kind, value in [*parsed, (None, None)]:
        if kind is _parser.LITERAL:
            run += chr(value)
            continue
        if run:
            out.append(frozenset([run.encode()]))
            run = ""
        if kind is _parser.BRANCH:
            ways = [_needs(way) for way in value[1]]
            if all(ways):
                out.append(frozenset().union(*(max(way, key=lambda x: min(map(len, x))) for way in ways)))
        elif kind is _parser.SUBPATTERN:
            out += _needs(value[-1])
        elif kind is _parser.MAX_REPEAT and value[0] > 0:
            out += _needs(value[-1])
    return out


def _rule(name: str, label: str, pattern: str, priority: int) -> Rule:
    needs = {x for x in _needs(_parser.parse(pattern)) if min(map(len, x)) > 1}
    return Rule(name, label, tuple(sorted(needs, key=sorted)), re.compile(f"(?<= )(?:{pattern})(?= )".encode()), priority)


@lru_cache(maxsize=1)
def rules() -> tuple[Rule, ...]:
    """All rules in order: identifiers, grants, notices and addresses, titles, bare names of several words."""
    out = [_rule(f"base:{label}", label, phrase.decode(), 70) for phrase, label in BASE]
    out += [_rule(f"id:{a}", a, rf"(?:spdx )?license identifier {i}", 90) for a, _, i in LICENSES]
    out += [_rule(f"grant:{a}", a, rf"{_GRANT}(?:{n})(?: (?:public )?licen[cs]e)?", 80) for a, n, _ in LICENSES]
    out += [_rule(f"notice:{i}", *x) for i, x in enumerate(NOTICES)]
    out += [_rule(f"title:{a}", a, rf"(?:{n}) licen[cs]e", 60) for a, n, _ in LICENSES]
    out += [_rule(f"field:{a}", a, rf"licen[cs]e (?:is )?(?:the )?(?:{n})", 55) for a, n, _ in LICENSES]
    return tuple(out)


@lru_cache(maxsize=1)
def _gates() -> tuple[tuple[frozenset[bytes], tuple[Rule, ...]], ...]:
    """The rules by the one of their sets that most rules share, in order within each."""
    shared = Counter(x for r in rules() for x in r.needs)
    out: dict[frozenset[bytes], list[Rule]] = {}
    for r in rules():
        out.setdefault(max(r.needs, key=lambda x: (shared[x], sorted(x)), default=frozenset([b""])), []).append(r)
    return tuple((gate, tuple(own)) for gate, own in out.items())


@lru_cache(maxsize=1)
def _order() -> dict[str, int]:
    return {r.name: i for i, r in enumerate(rules())}


def tried(line: bytes) -> Iterator[Rule]:
    """The rules that may match: one member of each of their sets occurs in the line."""
    there: dict[frozenset[bytes], bool] = {}
    for gate, own in _gates():
        if not any(x in line for x in gate):
            continue
        for r in own:
            for need in r.needs:
                if (here := there.get(need)) is None:
                    here = there[need] = any(x in line for x in need)
                if not here:
                    break
            else:
                yield r


_TO_WORDS = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or chr(b).isalnum() else 32 for b in range(256))


@dataclass(frozen=True)
class Found:
    label: str
    rule: str
    start: int
    end: int
    priority: int


def kept(found: list[Found]) -> list[Found]:
    """Drop what lies inside a detection of the same or a higher priority."""
    reach: dict[int, int] = {}
    out = []
    for d in sorted(found, key=lambda d: (d.start, -d.end, -d.priority)):
        if not any(p >= d.priority and end >= d.end for p, end in reach.items()):
            out.append(d)
        reach[d.priority] = max(reach.get(d.priority, -1), d.end)
    return out


def scan(text: str | None) -> tuple[int, list[int], list[str], list[Found]]:
    """Number of words, starts of the base phrases, their labels, and the detections that stay."""
    words = (text or "").encode().translate(_TO_WORDS).split()
    line = b" " + b" ".join(words) + b" "
    starts, labels = [], []
    for phrase, label in BASE:
        at = line.find(b" " + phrase + b" ")
        if at >= 0:
            labels.append(label)
        while at >= 0:
            starts.append(line.count(b" ", 0, at))
            at = line.find(b" " + phrase + b" ", at + 1)
    found = []
    for r in tried(line):
        for m in r.pattern.finditer(line):
            first = line.count(b" ", 0, m.start()) - 1
            found.append(Found(r.label, r.name, first, first + m[0].count(b" ") + 1, r.priority))
    order = _order()
    found.sort(key=lambda d: order[d.rule])
    return len(words), starts, labels, kept(found)


_FOUND = pa.list_(pa.struct([("label", pa.string()), ("rule", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("priority", pa.int32())]))


def scan_licenses(docs: DataFrame) -> DataFrame:
    """doc_id, n_words, base_starts, base_labels and detections (label, rule, start and end in words, priority)."""
    id_type = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            rows = [scan(t) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array([r[0] for r in rows], pa.int64()),
                    pa.array([r[1] for r in rows], pa.list_(pa.int64())),
                    pa.array([r[2] for r in rows], pa.list_(pa.string())),
                    pa.array([[vars(f) for f in r[3]] for r in rows], _FOUND),
                ],
                ["doc_id", "n_words", "base_starts", "base_labels", "detections"],
            )

    found = "array<struct<label:string,rule:string,start:bigint,end:bigint,priority:int>>"
    schema = f"doc_id {id_type}, n_words bigint, base_starts array<bigint>, base_labels array<string>, detections {found}"
    return docs.select("doc_id", "text").mapInArrow(run, schema)


def op5_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = scan_licenses(table(spark, sf_dir, "documents"))
    joined = lambda c: F.array_join(F.array_sort(F.array_distinct(c)), ",")
    return found.select(
        "doc_id",
        "n_words",
        F.size("base_starts").cast("long").alias("n_base"),
        F.array_min("base_starts").alias("first_word"),
        F.array_max("base_starts").alias("last_word"),
        joined(F.col("base_labels")).alias("base_labels"),
        joined(F.concat("base_labels", F.col("detections.label"))).alias("labels"),
        F.coalesce(F.array_max("detections.priority") / F.lit(100.0), F.lit(0.0)).alias("score"),
    )
