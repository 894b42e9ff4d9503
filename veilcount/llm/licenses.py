"""License scan: ordered signature rules over the words of a text, gated by keywords, with priority and containment.

A rule is a regex over the text's words joined by one blank, a label, a priority and a strength. The rules come from a
table of license names and a table of phrasings, in a fixed order; a few written by hand stand in front. Every rule has
gates, sets of words of which a text must hold one each; only rules whose gates a text's set of words passes are run. Of
the detections, those that lie inside one of higher rank (priority, then length, then rule order) are suppressed.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from dataclasses import dataclass
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from veilcount.llm.texts import plain_words, small_batches, utf8

#: Phrases of the base scan and their labels.
BASE = (("under the mit license", "mit"), ("apache license version 2", "apache-2"), ("cc by nc", "cc-by-nc"))

#: License names as words, their labels, and words of which one is in every match.
NAMES = (
    ("mit", "mit", "mit"),
    ("expat", "mit", "expat"),
    ("x11", "x11", "x11"),
    ("isc", "isc", "isc"),
    ("apache(?: software)? license (?:version )?2(?: 0)?", "apache-2", "apache"),
    ("apache 2(?: 0)?", "apache-2", "apache"),
    ("apache license (?:version )?1 1", "apache-1.1", "apache"),
    ("bsd 2 clause", "bsd-2", "bsd"),
    ("bsd 3 clause", "bsd-3", "bsd"),
    ("bsd 4 clause", "bsd-4", "bsd"),
    ("(?:new|modified|revised) bsd", "bsd-3", "bsd"),
    ("simplified bsd", "bsd-2", "bsd"),
    ("zero clause bsd", "0bsd", "bsd"),
    ("gnu general public license (?:v|version )2", "gpl-2", "gnu"),
    ("gnu general public license (?:v|version )3", "gpl-3", "gnu"),
    ("(?:gpl (?:v ?)?2|gplv2|gpl2)(?: 0)?", "gpl-2", "gpl gplv2 gpl2"),
    ("(?:gpl (?:v ?)?3|gplv3|gpl3)(?: 0)?", "gpl-3", "gpl gplv3 gpl3"),
    ("gnu (?:lesser|library) general public license (?:v|version )2(?: 1)?", "lgpl-2", "gnu"),
    ("gnu lesser general public license (?:v|version )3", "lgpl-3", "gnu"),
    ("(?:lgpl (?:v ?)?2|lgplv2) 1", "lgpl-2", "lgpl lgplv2"),
    ("(?:lgpl (?:v ?)?3|lgplv3)(?: 0)?", "lgpl-3", "lgpl lgplv3"),
    ("gnu affero general public license (?:v|version )3", "agpl-3", "affero"),
    ("(?:agpl (?:v ?)?3|agplv3)(?: 0)?", "agpl-3", "agpl agplv3"),
    ("gnu free documentation license", "gfdl", "documentation"),
    ("mozilla public license (?:v |version )?2(?: 0)?", "mpl-2", "mozilla"),
    ("mpl 2 0", "mpl-2", "mpl"),
    ("mozilla public license (?:v |version )?1 1", "mpl-1.1", "mozilla"),
    ("eclipse public license (?:v |version )?2(?: 0)?", "epl-2", "eclipse"),
    ("eclipse public license (?:v |version )?1(?: 0)?", "epl-1", "eclipse"),
    ("european union public licen[cs]e", "eupl", "european"),
    ("common development and distribution license", "cddl", "development"),
    ("boost software license", "bsl-1", "boost"),
    ("artistic license(?: 2 0)?", "artistic", "artistic"),
    ("zlib", "zlib", "zlib"),
    ("unlicense", "unlicense", "unlicense"),
    ("creative commons zero", "cc0", "commons"),
    ("cc0(?: 1 0)?", "cc0", "cc0"),
    ("(?:cc by|creative commons attribution)(?: [1-4] \\d)?", "cc-by", "cc commons"),
    ("(?:cc by sa|creative commons attribution share ?alike)(?: [1-4] \\d)?", "cc-by-sa", "cc commons"),
    ("(?:cc by nd|creative commons attribution no ?deriv\\w*)(?: [1-4] \\d)?", "cc-by-nd", "cc commons"),
    ("(?:cc by nc|creative commons attribution non ?commercial)(?: [1-4] \\d)?", "cc-by-nc", "cc commons"),
    ("(?:cc by nc sa|creative commons attribution non ?commercial share ?alike)(?: [1-4] \\d)?", "cc-by-nc-sa", "cc commons"),
    ("(?:cc by nc nd|creative commons attribution non ?commercial no ?deriv\\w*)(?: [1-4] \\d)?", "cc-by-nc-nd", "cc commons"),
    ("open database license", "odbl", "database"),
    ("sil open font license", "ofl", "sil"),
    ("python software foundation license", "psf", "python"),
)
#: Phrasings around a name, with the word that each of them needs and its strength.
PHRASINGS = (
    ("licen[cs]ed under (?:the )?(?:terms of (?:the )?)?{}", "under", 1.0),
    ("(?:released|distributed|published|available|made available) under (?:the )?(?:terms of (?:the )?)?{}", "under", 1.0),
    ("under the (?:terms of the )?{}(?: licen[cs]e)?", "under", 0.95),
    ("spdx licen[cs]e identifier {}", "identifier", 1.0),
    ("subject to the (?:terms of the )?{}", "subject", 0.9),
    ("governed by (?:the )?{}", "governed", 0.9),
    ("licen[cs]e {}", "", 0.8),
    ("{} licen[cs]e", "", 0.8),
    ("{}", "", 0.5),
)
#: Clauses and phrases that name no license, with their labels, keywords and strengths.
HAND_WRITTEN = (
    ("permission is hereby granted free of charge to any person obtaining a copy", "mit", "granted", 1.0),
    ("redistribution and use in source and binary forms", "bsd", "redistribution", 0.9),
    ("this is free and unencumbered software released into the public domain", "unlicense", "unencumbered", 1.0),
    ("you may not use this file except in compliance with the license", "apache-2", "compliance", 1.0),
    ("each contributor hereby grants to you a perpetual worldwide non exclusive no charge royalty free irrevocable", "apache-2", "irrevocable", 1.0),
    ("copy and distribute verbatim copies of the program s source code as you receive it", "gpl-2", "verbatim", 0.9),
    ("copy and distribute verbatim copies of the library s complete source code as you receive it", "lgpl-2", "verbatim", 0.9),
    ("convey verbatim copies of the program s source code as you receive it", "gpl-3", "verbatim", 0.9),
    ("prominently offer all users interacting with it remotely through a computer network", "agpl-3", "remotely", 1.0),
    ("covered software is provided under this license on an as is basis", "mpl-2", "covered", 1.0),
    ("each contributor hereby grants you a world wide royalty free non exclusive license", "mpl-2", "contributor", 0.9),
    ("permission to use copy modify and(?: or)? distribute this software for any purpose with or without fee is hereby granted provided", "isc", "fee", 1.0),
    ("permission to use copy modify and(?: or)? distribute this software for any purpose with or without fee is hereby granted the software", "0bsd", "fee", 1.0),
    ("altered source versions must be plainly marked as such", "zlib", "altered", 1.0),
    ("nor the names of (?:its|the|their) contributors may be used to endorse or promote products", "bsd-3", "endorse", 1.0),
    ("all advertising materials mentioning features or use of this software must display", "bsd-4", "advertising", 1.0),
    ("free of charge to any person or organization obtaining a copy of the software and accompanying documentation", "bsl-1", "organization", 1.0),
    ("copyright holder maintains some artistic control over the development of that package", "artistic", "artistic", 1.0),
    ("affirmer hereby overtly fully permanently irrevocably and unconditionally waives", "cc0", "affirmer", 1.0),
    ("not primarily intended for or directed towards commercial advantage or monetary compensation", "cc-by-nc", "monetary", 0.8),
    ("nor any of its individual components in original or modified versions may be sold by itself", "ofl", "sold", 1.0),
    ("psf hereby grants licensee a nonexclusive royalty free world wide license", "psf", "licensee", 1.0),
    ("public domain", "public-domain", "domain", 0.4),
    ("all rights reserved", "all-rights-reserved", "reserved", 0.6),
    ("copyright (?:c )?(?:19|20)\\d\\d", "copyright", "copyright", 0.4),
    ("without warranty of any kind", "warranty-disclaimer", "warranty", 0.3),
)
#: Names that also occur in plain prose count only inside a phrasing.
_BARE = 0.5


@dataclass(frozen=True)
class Rule:
    pattern: re.Pattern
    label: str
    priority: int
    strength: float
    gates: tuple[frozenset[bytes], ...]


def _rule(pattern: str, label: str, priority: int, strength: float, *gates: str) -> Rule:
    words = tuple(frozenset(gate.encode().split()) for gate in gates if gate)
    return Rule(re.compile(rf"(?<!\S){pattern}(?!\S)"), label, priority, strength, words)


def rules() -> list[Rule]:
    """All rules in their fixed order."""
    found = [_rule(phrase, label, 3, 1.0, *phrase.split()) for phrase, label in BASE]
    found += [_rule(pattern, label, 2, strength, keyword) for pattern, label, keyword, strength in HAND_WRITTEN]
    for phrasing, keyword, strength in PHRASINGS:
        for name, label, words in NAMES:
            if phrasing == "{}" and " " not in name and not any(sign.isdigit() for sign in name):
                continue  # one plain word alone says nothing
            priority = 1 if strength > _BARE else 0
            found.append(_rule(phrasing.format(f"(?:{name})"), label, priority, strength, keyword, words))
    return found


class Scanner:
    """The rules and their gates; each task makes its own."""

    def __init__(self):
        self.rules = rules()
        self.keywords = frozenset().union(*(gate for rule in self.rules for gate in rule.gates))

    def detections(self, words: list[bytes]) -> list[tuple[int, int, Rule]]:
        """(first word, word after the last, rule) of all detections that none of higher rank contains."""
        present = self.keywords.intersection(words)
        if not present:
            return []
        text, starts, found = "", [], []
        for order, rule in enumerate(self.rules):
            if all(not gate.isdisjoint(present) for gate in rule.gates):
                if not starts:
                    plain = [word.decode(errors="replace") for word in words]
                    text, starts = " ".join(plain), [0, *accumulate(len(word) + 1 for word in plain)]
                for match in rule.pattern.finditer(text):
                    first, end = bisect_right(starts, match.start()) - 1, bisect_right(starts, match.end() - 1)
                    found.append((first, end, rule, order))
        return _uncontained(found)


def _uncontained(found: list[tuple[int, int, Rule, int]]) -> list[tuple[int, int, Rule]]:
    """Hits that lie in no hit of higher rank, by place: one sweep by start for each priority."""
    kept, above = [], []
    for priority in sorted({hit[2].priority for hit in found}, reverse=True):
        level = sorted((hit for hit in found if hit[2].priority == priority), key=lambda hit: (hit[0], -hit[1], hit[3]))
        above.sort(key=lambda hit: hit[0])
        starts, ends = [hit[0] for hit in above], list(accumulate((hit[1] for hit in above), max))
        reach = -1
        for hit in level:
            at = bisect_right(starts, hit[0])
            if hit[1] > reach and not (at and ends[at - 1] >= hit[1]):
                kept.append(hit[:3])
            reach = max(reach, hit[1])
        above += level
    return sorted(kept, key=lambda hit: hit[:2])


def base_places(words: list[bytes]) -> list[tuple[int, str]]:
    """Every place where a base phrase's words stand consecutively, with its label."""
    found = []
    for phrase, label in BASE:
        wanted = phrase.encode().split()
        at = -1
        while True:
            try:
                at = words.index(wanted[0], at + 1)
            except ValueError:
                break
            if words[at : at + len(wanted)] == wanted:
                found.append((at, label))
    return found


SCAN = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("n_words", T.LongType()),
        T.StructField("base", T.ArrayType(T.StructType([T.StructField("word", T.LongType()), T.StructField("label", T.StringType())]))),
        T.StructField(
            "detections",
            T.ArrayType(
                T.StructType(
                    [
                        T.StructField("first_word", T.LongType()),
                        T.StructField("end_word", T.LongType()),
                        T.StructField("label", T.StringType()),
                        T.StructField("strength", T.DoubleType()),
                    ]
                )
            ),
        ),
    ]
)


def scan_licenses(documents: DataFrame) -> DataFrame:
    """The base places and the kept detections of every row of `documents` (doc_id, text; other columns are ignored).

    A null or empty text has no words and no detections, a null doc_id stays null, repeated rows are each scanned, and
    places where two detections tie are decided by the order of the rules. Detections count words from 0, ends exclusive.
    """

    def scan(batches):
        schema = pa.schema(
            [
                ("doc_id", pa.int64()),
                ("n_words", pa.int64()),
                ("base", pa.list_(pa.struct([("word", pa.int64()), ("label", pa.string())]))),
                (
                    "detections",
                    pa.list_(
                        pa.struct(
                            [
                                ("first_word", pa.int64()),
                                ("end_word", pa.int64()),
                                ("label", pa.string()),
                                ("strength", pa.float64()),
                            ]
                        )
                    ),
                ),
            ]
        )
        scanner = Scanner()
        for batch in small_batches(batches):
            counts, base, hits = [], [], []
            for text in utf8(batch, "text"):
                words = plain_words(text)
                counts.append(len(words))
                base.append([{"word": word, "label": label} for word, label in base_places(words)])
                hits.append(
                    [
                        {"first_word": first, "end_word": end, "label": rule.label, "strength": rule.strength}
                        for first, end, rule in scanner.detections(words)
                    ]
                )
            doc_ids = batch.column(batch.schema.get_field_index("doc_id"))
            yield pa.RecordBatch.from_arrays(
                [doc_ids, pa.array(counts, pa.int64()), pa.array(base, schema.field(2).type), pa.array(hits, schema.field(3).type)],
                schema=schema,
            )

    return documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(scan, SCAN)


def report(documents: DataFrame) -> DataFrame:
    """Counts, extreme places, labels and the strongest detection of every row."""
    scanned = scan_licenses(documents)
    places = F.transform("base", lambda place: place["word"])
    base = F.array_sort(F.array_distinct(F.transform("base", lambda place: place["label"])))
    own = F.transform("detections", lambda hit: hit["label"])
    strength = F.array_max(F.transform("detections", lambda hit: hit["strength"]))
    return scanned.select(
        "doc_id",
        "n_words",
        F.size("base").cast("long").alias("n_base"),
        F.array_min(places).alias("first_word"),
        F.array_max(places).alias("last_word"),
        F.concat_ws(",", base).alias("base_labels"),
        F.concat_ws(",", F.array_sort(F.array_union(base, own))).alias("labels"),
        F.when(F.size("base") > 0, F.lit(1.0)).otherwise(F.coalesce(strength, F.lit(0.0))).alias("score"),
    )
