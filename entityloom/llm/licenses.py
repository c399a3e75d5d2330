"""License scan by ordered signature rules.

A text becomes the sequence of its words, lower-cased and joined by single
spaces. A rule is a regular expression over that sequence with a keyword that
every match contains; an automaton of all keywords decides in one pass which
rules are tried. Rules are ordered: grant texts and identifiers first, then
named licenses with a version, then bare names. A detection that lies inside
another one of an earlier rule class, or inside a longer one of its own class,
is suppressed, so "apache license version 2 0" is not also "apache". Base
phrases are rules like the others but are never suppressed.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from entityloom.llm.common import map_batches, per_worker, text_bytes, text_or_empty

# Phrase and label of the base detections.
BASE = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}

# Rule classes, from the one that wins: confidence of a detection.
GRANT, IDENTIFIER, VERSIONED, NAMED, MENTION = range(5)
CONFIDENCE = {GRANT: 0.98, IDENTIFIER: 0.99, VERSIONED: 0.9, NAMED: 0.7, MENTION: 0.4}

# Sentences that grant or name a license, as words. Label, keyword, pattern.
GRANTS = [
    ("mit", "hereby", r"permission is hereby granted free of charge to any person obtaining a copy"),
    ("mit", "noninfringement", r"fitness for a particular purpose and noninfringement"),
    ("isc", "permission", r"permission to use copy modify and or distribute this software for any purpose with or without fee"),
    ("0bsd", "permission", r"permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted the software"),
    ("bsd-2-clause", "redistribution", r"redistribution and use in source and binary forms with or without modification are permitted"),
    ("bsd-3-clause", "endorse", r"(?:neither the names? of|the names? of).{0,120}? (?:nor the|may not).{0,80}? be used to endorse or promote products"),
    ("bsd-4-clause", "advertising", r"all advertising materials mentioning features or use of this software must display"),
    ("apache-2.0", "compliance", r"you may not use this file except in compliance with the license"),
    ("apache-2.0", "apache", r"apache license version 2 0 january 2004"),
    ("gpl", "redistribute", r"you can redistribute it and or modify it under the terms of the gnu general public license"),
    ("lgpl", "redistribute", r"you can redistribute it and or modify it under the terms of the gnu (?:lesser|library) general public license"),
    ("agpl-3.0", "affero", r"under the terms of the gnu affero general public license"),
    ("gpl", "warranty", r"this program comes with absolutely no warranty"),
    ("mpl-2.0", "mozilla", r"subject to the terms of the mozilla public license v ?2 0"),
    ("mpl-1.1", "mozilla", r"subject to the mozilla public license version 1 1"),
    ("unlicense", "unencumbered", r"this is free and unencumbered software released into the public domain"),
    ("wtfpl", "public", r"do what the [a-z]+ you want to public license"),
    ("zlib", "misrepresented", r"the origin of this software must not be misrepresented"),
    ("bsl-1.0", "boost", r"boost software license version 1 0"),
    ("cc0-1.0", "dedicated", r"has dedicated the work to the public domain by waiving"),
    ("epl-2.0", "eclipse", r"made available under the terms of the eclipse public license (?:v|version )?2 0"),
    ("ofl-1.1", "font", r"this font software is licensed under the sil open font license"),
    ("artistic-2.0", "artistic", r"under the terms of the artistic license(?: version)? 2 0"),
    ("proprietary", "reserved", r"all rights reserved"),
    ("proprietary", "confidential", r"proprietary and confidential"),
]

# Names of licenses. Label, keyword of every match, pattern of the name, versions in use.
NAMES = [
    ("mit", "mit", r"mit", ()),
    ("apache", "apache", r"apache(?: software)?", ("1 0", "1 1", "2 0")),
    ("gpl", "gpl", r"(?:gnu )?gpl", ("1 0", "2 0", "3 0")),
    ("gpl", "general", r"(?:gnu )?general public", ("1", "2", "3")),
    ("lgpl", "lgpl", r"(?:gnu )?lgpl", ("2 0", "2 1", "3 0")),
    ("lgpl", "lesser", r"(?:gnu )?lesser general public", ("2 1", "3")),
    ("agpl", "agpl", r"(?:gnu )?agpl", ("1 0", "3 0")),
    ("agpl", "affero", r"(?:gnu )?affero general public", ("1", "3")),
    ("gfdl", "documentation", r"gnu free documentation", ("1 1", "1 2", "1 3")),
    ("bsd", "bsd", r"bsd", ("2 clause", "3 clause", "4 clause")),
    ("bsd", "bsd", r"(?:new|revised|modified|simplified|original) bsd", ()),
    ("mpl", "mozilla", r"mozilla public", ("1 0", "1 1", "2 0")),
    ("mpl", "mpl", r"mpl", ("1 0", "1 1", "2 0")),
    ("epl", "eclipse", r"eclipse public", ("1 0", "2 0")),
    ("edl", "eclipse", r"eclipse distribution", ("1 0",)),
    ("cddl", "cddl", r"cddl", ("1 0", "1 1")),
    ("cddl", "common", r"common development and distribution", ("1 0", "1 1")),
    ("cpl", "common", r"common public", ("1 0",)),
    ("cpal", "attribution", r"common public attribution", ("1 0",)),
    ("ipl", "ibm", r"ibm public", ("1 0",)),
    ("isc", "isc", r"isc", ()),
    ("zlib", "zlib", r"zlib(?: libpng)?", ()),
    ("libpng", "libpng", r"libpng", ("2 0",)),
    ("bsl", "boost", r"boost software", ("1 0",)),
    ("busl", "business", r"business source", ("1 1",)),
    ("sspl", "server", r"server side public", ("1",)),
    ("elastic", "elastic", r"elastic", ("1 0", "2 0")),
    ("artistic", "artistic", r"artistic", ("1 0", "2 0")),
    ("python", "python", r"python(?: software foundation)?", ("2", "2 0")),
    ("php", "php", r"php", ("3 0", "3 01")),
    ("ruby", "ruby", r"ruby", ()),
    ("perl", "perl", r"perl", ()),
    ("openssl", "openssl", r"openssl", ()),
    ("postgresql", "postgresql", r"postgresql", ()),
    ("ncsa", "ncsa", r"(?:university of illinois )?ncsa(?: open source)?", ()),
    ("x11", "x11", r"x11", ()),
    ("wtfpl", "wtfpl", r"wtfpl", ("2",)),
    ("unlicense", "unlicense", r"(?:the )?unlicense", ()),
    ("eupl", "eupl", r"eupl", ("1 0", "1 1", "1 2")),
    ("eupl", "european", r"european union public", ("1 1", "1 2")),
    ("osl", "open", r"open software", ("1 0", "2 0", "2 1", "3 0")),
    ("afl", "academic", r"academic free", ("2 0", "2 1", "3 0")),
    ("ecl", "educational", r"educational community", ("1 0", "2 0")),
    ("ms-pl", "microsoft", r"microsoft public", ()),
    ("ms-rl", "microsoft", r"microsoft reciprocal", ()),
    ("ofl", "open", r"(?:sil )?open font", ("1 0", "1 1")),
    ("odbl", "database", r"open(?: data commons open)? database", ("1 0",)),
    ("odc-by", "attribution", r"open data commons attribution", ("1 0",)),
    ("cc0", "cc0", r"cc0", ("1 0",)),
    ("cc-by", "attribution", r"(?:creative commons )?attribution", ("2 0", "2 5", "3 0", "4 0")),
    ("cc-by-sa", "sharealike", r"(?:creative commons )?attribution sharealike", ("2 0", "2 5", "3 0", "4 0")),
    ("cc-by-nc", "noncommercial", r"(?:creative commons )?attribution noncommercial", ("2 0", "3 0", "4 0")),
    ("cc-by-nd", "noderivatives", r"(?:creative commons )?attribution noderivatives", ("3 0", "4 0")),
    ("cecill", "cecill", r"cecill", ("1 1", "2 0", "2 1")),
    ("upl", "universal", r"universal permissive", ("1 0",)),
    ("vim", "vim", r"vim", ()),
    ("hpnd", "historical", r"historical permission notice", ()),
    ("json", "json", r"json", ()),
]


@dataclass(frozen=True)
class Rule:
    name: str
    label: str
    keyword: str
    pattern: str
    rank: int
    base: bool = False


def _named_rules() -> list[Rule]:
    """For each name: with each version, as an identifier, granted, and alone."""
    rules = []
    granted = r"(?:licen[cs]ed|released|distributed|available|covered|provided) (?:under|by)(?: the)?(?: terms of the)? "
    for i, (label, keyword, name, versions) in enumerate(NAMES):
        for v in versions:
            short = v.removesuffix(" 0") if v.endswith(" 0") else v
            spelled = rf"(?:{v}|{short})" if short != v else v
            dashed = f"{label}-{v.replace(' ', '-' if 'clause' in v else '.')}"
            rules.append(Rule(f"versioned-{i}-{dashed}", dashed, keyword, rf"(?:{granted})?{name}(?: licen[cs]e)?(?: v| version)? ?{spelled}(?: licen[cs]e)?", VERSIONED))
            rules.append(Rule(f"identifier-{i}-{dashed}", dashed, "spdx", rf"spdx licen[cs]e identifier {label.replace('-', ' ')} {v}(?: only| or later)?", IDENTIFIER))
        rules.append(Rule(f"identifier-{i}", label, "spdx", rf"spdx licen[cs]e identifier {label.replace('-', ' ')}", IDENTIFIER))
        rules.append(Rule(f"granted-{i}", label, keyword, rf"{granted}{name}(?: licen[cs]e)?", NAMED))
        rules.append(Rule(f"named-{i}", label, keyword, rf"{name} licen[cs]e", NAMED))
        rules.append(Rule(f"mention-{i}", label, keyword, rf"(?:see|read|accept|under)(?: the)? {name} (?:terms|text|file|conditions)", MENTION))
    return rules


def default_rules(base: dict[str, str] | None = None) -> list[Rule]:
    """All rules, the base phrases first."""
    phrases = BASE if base is None else base
    rules = [Rule(f"base-{p}", label, p.split()[0], re.escape(p).replace(r"\ ", " "), NAMED, True) for p, label in phrases.items()]
    rules += [Rule(f"grant-{i}", label, k, p, GRANT) for i, (label, k, p) in enumerate(GRANTS)]
    return rules + _named_rules()


# Bytes that separate words: all of ASCII but digits and a-z, as the text is lower-cased before.
_SEPARATORS = bytes(b for b in range(128) if not (48 <= b <= 57 or 97 <= b <= 122))
_TO_SPACE = bytes.maketrans(_SEPARATORS, b" " * len(_SEPARATORS))


def words_of(text: bytes) -> list[bytes]:
    """The words of UTF-8 text: A-Z lower-cased, cut at every ASCII character but letters and digits."""
    return text.lower().translate(_TO_SPACE).split()


class Scanner:
    def __init__(self, rules: Sequence[Rule]):
        import ahocorasick

        self._rules = list(rules)
        self._compiled = [re.compile(rf"(?<![^ ])(?:{r.pattern})(?![^ ])") for r in self._rules]
        by_keyword: dict[str, list[int]] = {}
        for i, r in enumerate(self._rules):
            by_keyword.setdefault(r.keyword, []).append(i)
        self._keywords = ahocorasick.Automaton()
        for keyword, numbers in by_keyword.items():
            self._keywords.add_word(keyword, (keyword, numbers))
        self._keywords.make_automaton()

    def scan(self, text: bytes) -> tuple[int, list[tuple[int, int, str, str, float, bool, bool]]]:
        """Number of words, and detections: first word, word behind the last, label, rule, confidence, base, kept."""
        words = words_of(text)
        line = b" ".join(words).decode("latin-1")  # one character per byte
        wanted = {keyword: numbers for _, (keyword, numbers) in self._keywords.iter(line)}
        found = []
        for i in sorted(i for numbers in wanted.values() for i in numbers):
            for m in self._compiled[i].finditer(line):
                found.append((m.start(), m.end(), i))
        if not found:
            return len(words), []
        found.sort()
        out, place, word = [], 0, 0
        kept = self._resolve(found)
        for (start, end, i), stays in zip(found, kept):
            word += line.count(" ", place, start)
            place = start
            rule = self._rules[i]
            out.append((word, word + line.count(" ", start, end) + 1, rule.label, rule.name, CONFIDENCE[rule.rank], rule.base, stays))
        return len(words), out

    def _resolve(self, found: list[tuple[int, int, int]]) -> list[bool]:
        """Which detections lie in no other one of an earlier class, nor in a longer one of their own.

        One sweep by start for each class: with the longer and then the
        earlier class first among equal starts, a detection is contained if
        the furthest end so far reaches its own.
        """
        rank = [self._rules[i].rank for _, _, i in found]
        order = sorted(range(len(found)), key=lambda k: (found[k][0], -found[k][1], rank[k], found[k][2]))
        kept = [False] * len(found)
        for now in set(rank):
            furthest = -1
            for k in order:
                if rank[k] > now:
                    continue
                if rank[k] == now:
                    kept[k] = found[k][1] > furthest or self._rules[found[k][2]].base
                furthest = max(furthest, found[k][1])
        return kept


_DETECTION = "first_word bigint, end_word bigint, label string, rule string, confidence double, base boolean, kept boolean"


def scan_licenses(docs: DataFrame, rules: Sequence[Rule] | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: the id, ``n_words`` and ``detections``, an array ordered by place.

    A detection has its words ``[first_word, end_word)``, label, rule,
    confidence, whether it is a base phrase and whether it was kept. A missing
    or empty text has no words and no detections. Every row gives one row,
    repeated and missing ids included; other columns are not read.
    """
    chosen = list(default_rules() if rules is None else rules)
    id_type = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("id"), text_or_empty(text_col).alias("text"))
    key = f"licenses {hash(tuple(chosen))} {len(chosen)}"
    types = pa.list_(
        pa.struct([("first_word", pa.int64()), ("end_word", pa.int64()), ("label", pa.string()), ("rule", pa.string()),
                   ("confidence", pa.float64()), ("base", pa.bool_()), ("kept", pa.bool_())])
    )
    names = [types.value_type.field(i).name for i in range(types.value_type.num_fields)]

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        scanner = per_worker(key, lambda: Scanner(chosen))
        results = [scanner.scan(t) for t in text_bytes(batch.column(1))]
        detections = [[dict(zip(names, d)) for d in found] for _, found in results]
        return pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array([n for n, _ in results], pa.int64()), pa.array(detections, types)], ["id", "n_words", "detections"]
        )

    out = map_batches(rows, run, f"id {id_type}, n_words bigint, detections array<struct<{_DETECTION.replace(' ', ':').replace(',:', ',')}>>")
    return out.withColumnRenamed("id", id_col)


def license_summary(scanned: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Counts, places and labels of ``scan_licenses`` output, one row per row."""
    base = F.filter("detections", lambda d: d["base"])
    kept = F.filter("detections", lambda d: d["base"] | d["kept"])
    label = lambda a: F.array_join(F.array_sort(F.array_distinct(F.transform(a, lambda d: d["label"]))), ",")
    return scanned.select(
        id_col,
        "n_words",
        F.size(base).cast("bigint").alias("n_base"),
        F.array_min(F.transform(base, lambda d: d["first_word"])).alias("first_word"),
        F.array_max(F.transform(base, lambda d: d["first_word"])).alias("last_word"),
        label(base).alias("base_labels"),
        label(kept).alias("labels"),
        F.coalesce(F.array_max(F.transform(kept, lambda d: d["confidence"])), F.lit(0.0)).alias("score"),
    )
