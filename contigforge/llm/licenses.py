"""Licence scan: Aho-Corasick finds identifier tags and notice phrases, a shunting-yard parser evaluates their expressions.

Contract of scan():
- a null or empty text has no words, no label and score 0; its row is kept;
- a null id stays null, repeated rows each give a row, an empty table gives none;
- other columns of the input are ignored, whatever their names.
"""

from __future__ import annotations

import re

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from .common import batch, documents, map_batches, texts

# The base phrases and their labels.
BASE = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}

# Notice phrases (in words as the scan splits them) and the identifier each stands for.
NOTICES = {
    "apache license": "apache-2.0",
    "licensed under the apache license version 2 0": "apache-2.0",
    "permission is hereby granted free of charge": "mit",
    "mit license": "mit",
    "redistribution and use in source and binary forms": "bsd",
    "bsd license": "bsd",
    "mozilla public license": "mpl-2.0",
    "eclipse public license": "epl-2.0",
    "lesser general public license": "lgpl",
    "affero general public license": "agpl",
    "gnu free documentation license": "gfdl",
    "cc0": "cc0-1.0",
    "public domain": "public-domain",
    "cc by nc": "cc-by-nc",
    "cc by sa": "cc-by-sa",
    "cc by nd": "cc-by-nd",
    "creative commons attribution": "cc-by",
    "creative commons zero": "cc0-1.0",
    "proprietary and confidential": "proprietary",
    "permission to use copy modify and or distribute this software for any purpose": "isc",
    "isc license": "isc",
    "boost software license": "bsl-1.0",
    "this software is provided as is without any express or implied warranty": "zlib",
    "zlib license": "zlib",
    "free and unencumbered software released into the public domain": "unlicense",
    "artistic license": "artistic",
    "do what the fuck you want to public license": "wtfpl",
    "european union public licence": "eupl",
    "open font license": "ofl",
}

# Identifiers that an expression may name, as patterns over lower case; a + after one means later versions too.
IDENTIFIERS = (
    r"0bsd", r"afl-[123]\.[0-2]", r"a?gpl-[123]\.0(?:-only|-or-later)?", r"lgpl-(?:2\.0|2\.1|3\.0)(?:-only|-or-later)?", r"apache-(?:1\.0|1\.1|2\.0)", r"apsl-[12]\.[0-2]",
    r"artistic-(?:1\.0|2\.0)(?:-perl|-cl8)?", r"beerware", r"blueoak-1\.0\.0", r"bsd-[1-4]-clause(?:-[a-z]+)*", r"bsl-1\.0", r"busl-1\.1", r"bzip2-1\.0\.[56]",
    r"cc-by(?:-nc)?(?:-sa|-nd)?-(?:1\.0|2\.0|2\.5|3\.0|4\.0)(?:-[a-z]+)?", r"cc0-1\.0", r"cddl-1\.[01]", r"cecill-(?:1\.[01]|2\.[01]|b|c)", r"cpl-1\.0", r"curl", r"ecl-[12]\.0",
    r"efl-[12]\.0", r"epl-[12]\.0", r"eupl-1\.[0-2]", r"fsfap", r"ftl", r"gfdl-1\.[1-3](?:-(?:no-)?invariants)?(?:-only|-or-later)?", r"hpnd", r"icu", r"ijg", r"ipl-1\.0", r"isc", r"json",
    r"libpng(?:-2\.0)?", r"lppl-1\.(?:[0-2]|3[ac])", r"mit(?:-0|-cmu|-modern-variant)?", r"mpl-(?:1\.0|1\.1|2\.0)(?:-no-copyleft-exception)?", r"ms-[pr]l", r"mulanpsl-[12]\.0", r"ncsa",
    r"odbl-1\.0", r"odc-by-1\.0", r"ofl-1\.[01]", r"openssl", r"osl-[123]\.[01]", r"pddl-1\.0", r"php-3\.0[01]?", r"postgresql", r"psf-2\.0", r"python-2\.0(?:\.1)?", r"qpl-1\.0", r"ruby",
    r"sissl", r"sleepycat", r"spl-1\.0", r"sspl-1\.0", r"unicode-(?:3\.0|dfs-201[56]|tou)", r"unlicense", r"upl-1\.0", r"vim", r"w3c", r"wtfpl", r"x11", r"zlib", r"zlib-acknowledgement", r"zpl-[12]\.[01]",
    r"licenseref-[0-9a-z.-]+",
)
# What may stand after "with".
EXCEPTIONS = (r"[0-9a-z.+-]*exception(?:-[0-9a-z.]+)*", r"linux-syscall-note", r"bootloader-exception", r"font-exception-2\.0", r"llvm-exception")

#: The words of an identifier tag; an expression follows it on the same line.
TAG = "spdx license identifier"

#: How freely a label lets a text be used, 0 to 1; a label that is not listed counts as UNKNOWN.
FREEDOM = {
    "public-domain": 1.0, "cc0-1.0": 1.0, "mit": 0.95, "bsd": 0.95, "apache-2.0": 0.9, "cc-by": 0.85, "cc-by-sa": 0.6, "mpl-2.0": 0.6, "epl-2.0": 0.6,
    "isc": 0.95, "bsl-1.0": 0.95, "zlib": 0.95, "unlicense": 1.0, "wtfpl": 1.0, "artistic": 0.7, "eupl": 0.5, "ofl": 0.7,
    "gfdl": 0.4, "lgpl": 0.5, "gpl": 0.4, "agpl": 0.3, "cc-by-nd": 0.25, "cc-by-nc": 0.2, "reserved": 0.0, "proprietary": 0.0,
}
UNKNOWN = 0.5

_KEEP = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))
_TOKEN = re.compile(r"\(|\)|[A-Za-z0-9][A-Za-z0-9.+-]*")
_AFTER_TAG = re.compile(rb"(?<![0-9A-Za-z\x80-\xff])spdx[\x01-/:-@\[-`{-\x7f]{1,9}license[\x01-/:-@\[-`{-\x7f]{1,9}identifier(?![0-9A-Za-z\x80-\xff])[ \t:=]*([^\r\n]*)", re.I)
_NAMED = re.compile(rf"(?:{'|'.join(IDENTIFIERS)})\+?")
_EXCEPTED = re.compile("|".join(EXCEPTIONS))
_POWER = {"or": 1, "and": 2, "with": 3}


def words_of(text: str) -> bytes:
    """The words of a text, A-Z in lower case, each with a space before it, and one space at the end."""
    found = text.encode().translate(_KEEP).split()
    return b" " + b" ".join(found) + b" " if found else b""


def family(name: str) -> str:
    """The label of an identifier: GPL-2.0-or-later and gpl-3.0 are gpl, BSD-3-Clause is bsd."""
    name = name.lower()
    for head in ("lgpl", "agpl", "gpl", "gfdl", "bsd-", "artistic", "eupl", "ofl"):
        if name.startswith(head):
            return head.rstrip("-")
    name = name.removesuffix("+")
    return re.sub(r"^(cc-by(?:-nc)?(?:-sa|-nd)?)-\d.*$", r"\1", name)


def to_postfix(expression: str) -> list[str] | None:
    """Shunting-yard: the tokens in postfix order, of the longest beginning that is an expression of known identifiers; None if there is none."""
    out: list[str] = []
    held: list[str] = []
    operand, found = True, None
    for token in _TOKEN.findall(expression):
        low = token.lower()
        if low in _POWER:
            if operand:
                break
            while held and held[-1] != "(" and _POWER[held[-1]] >= _POWER[low]:
                out.append(held.pop())
            held.append(low)
            operand = True
        elif token == "(":
            if not operand:
                break
            held.append(token)
        elif token == ")":
            if operand or "(" not in held:
                break
            while held[-1] != "(":
                out.append(held.pop())
            held.pop()
        elif operand and (_EXCEPTED if held and held[-1] == "with" else _NAMED).fullmatch(low):
            out.append(token)
            operand = False
        else:
            break
        if not operand and "(" not in held:
            found = out + held[::-1]
    return found


def evaluate(postfix: list[str]) -> tuple[set[str], float]:
    """Labels of an expression and its freedom: the freest side of or, the strictest of and; with leaves the licence and names the exception."""
    stack: list[tuple[set[str], float]] = []
    for token in postfix:
        if token not in _POWER:
            label = family(token)
            stack.append(({label}, FREEDOM.get(label, UNKNOWN)))
            continue
        (right, b), (left, a) = stack.pop(), stack.pop()
        stack.append((left | {f"with:{x}" for x in right}, a) if token == "with" else (left | right, max(a, b) if token == "or" else min(a, b)))
    return stack[0]


class Scanner:
    """One automaton over all phrases; phrases are matched as whole consecutive words."""

    def __init__(self, notices: dict[str, str] | None = None):
        self.automaton = ahocorasick.Automaton()
        for phrase, label in {**(NOTICES if notices is None else notices), TAG: ""}.items():
            self.automaton.add_word(f" {phrase} ".encode().decode("latin-1"), (phrase, label, False))
        for phrase, label in BASE.items():
            self.automaton.add_word(f" {phrase} ", (phrase, label, True))
        self.automaton.make_automaton()

    def scan(self, text: str) -> dict:
        """Words, places of base phrases, labels, expressions and score of a whole text."""
        row = words_of(text)
        base, labels, places, free, expressions, last_at, last_word = set(), set(), [], [], [], 0, 0
        for end, (phrase, label, is_base) in self.automaton.iter(row.decode("latin-1")):
            start = end - len(phrase) - 1
            last_word += row.count(b" ", last_at, start) if start >= last_at else -row.count(b" ", start, last_at)
            last_at = start
            if phrase == TAG:
                continue
            labels.add(label)
            free.append(FREEDOM.get(label, UNKNOWN))
            if is_base:
                base.add(label)
                places.append(last_word)
        if b" spdx license identifier " in row:
            for tail in _AFTER_TAG.findall(text.encode()):
                expression = tail.decode("utf-8", "replace")
                if (postfix := to_postfix(expression)) is not None:
                    found, freedom = evaluate(postfix)
                    labels |= found
                    free.append(freedom)
                    expressions.append(" ".join(postfix))
        return {
            "n_words": row.count(b" ") - 1 if row else 0, "n_base": len(places), "first_word": min(places, default=None), "last_word": max(places, default=None),
            "base_labels": ",".join(sorted(base)), "labels": ",".join(sorted(labels)), "score": min(free, default=0.0), "expressions": expressions,
        }


SCHEMA = "doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double, expressions array<string>"


def scan(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", notices: dict[str, str] | None = None) -> DataFrame:
    """One row of SCHEMA for each row of df; see the module for nulls and repeats. score: freedom of the strictest licence found, 0 without any."""

    def make():
        scanner = Scanner(notices)

        def one(b: pa.RecordBatch) -> pa.RecordBatch:
            rows = [scanner.scan(t) for t in b.column("text").to_pylist()]
            kinds = {"base_labels": pa.string(), "labels": pa.string(), "score": pa.float64(), "expressions": pa.list_(pa.string())}
            return batch(doc_id=(b.column("doc_id"), None), **{k: ([r[k] for r in rows], kinds.get(k, pa.int64())) for k in ("n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "expressions")})

        return one

    return map_batches(texts(df, id_col, text_col), make, SCHEMA)


def op5_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The licence scan over every document."""
    return scan(documents(spark, sf_dir)).drop("expressions")
