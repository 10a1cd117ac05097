"""License scan: Aho-Corasick over notices and tags, shunting-yard for expressions.

One automaton holds the notice phrases (as word sequences) and the identifier
tags.  It runs once over the normalised text: A-Z lower-cased, every run of
separators one space.  A phrase hit is a place where its words stand
consecutively.  At a tag hit (``spdx-license-identifier``, ``licensed under``,
``license:``), the words that follow, with parentheses kept, are read as a
licence expression; a shunting-yard parser turns ``and`` / ``or`` / ``with``
(``with`` binds strongest, then ``and``) into the set of choices that the
expression offers.  The reader starts at the automaton's hits, mapped back to
the text.  Behind the two tags of prose, a word counts as an identifier if it
is a known one, holds a digit or begins with ``LicenseRef-``; the expression
ends at any other.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

BASE_PHRASES = {"under the mit license": "mit", "apache license version 2": "apache-2", "cc by nc": "cc-by-nc"}
#: Further notices, each with its label.
NOTICES = {
    "gnu general public license version 2": "gpl-2", "gnu general public license version 3": "gpl-3",
    "gnu lesser general public license": "lgpl", "gnu affero general public license": "agpl-3",
    "mozilla public license": "mpl-2", "redistribution and use in source and binary forms": "bsd",
    "all rights reserved": "all-rights-reserved", "permission is hereby granted free of charge": "mit",
    "creative commons attribution": "cc-by", "licensed under the apache license": "apache-2",
    "this is free and unencumbered software": "unlicense", "released into the public domain": "public-domain",
}
#: Licence identifiers, as in SPDX expressions, lower-cased.
IDENTIFIERS = {
    "mit": "mit", "apache-2.0": "apache-2", "bsd-2-clause": "bsd", "bsd-3-clause": "bsd", "gpl-2.0": "gpl-2",
    "gpl-2.0-only": "gpl-2", "gpl-2.0-or-later": "gpl-2", "gpl-3.0": "gpl-3", "gpl-3.0-only": "gpl-3",
    "gpl-3.0-or-later": "gpl-3", "lgpl-2.1-only": "lgpl", "lgpl-3.0-only": "lgpl", "agpl-3.0-only": "agpl-3",
    "mpl-2.0": "mpl-2", "cc-by-4.0": "cc-by", "cc-by-sa-4.0": "cc-by-sa", "cc-by-nc-4.0": "cc-by-nc",
    "cc0-1.0": "cc0", "isc": "isc", "unlicense": "unlicense", "zlib": "zlib",
}
TAGS = ("spdx license identifier", "licensed under", "license")
#: Tags behind which any identifier is taken; behind the others, words of prose may follow.
EXACT_TAGS = ("spdx license identifier",)
#: Alternatives of an expression that are listed one by one, at most.
MOST_CHOICES = 4096
RESULT = ("n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, "
          "score double, choices array<string>")

_SEPARATORS = bytes(b for b in range(128) if not (0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or 0x41 <= b <= 0x5A))
_CLEAN = bytes.maketrans(_SEPARATORS + bytes(range(0x41, 0x5B)), b" " * len(_SEPARATORS) + bytes(range(0x61, 0x7B)))
#: What may stand between a tag and its expression.
_AFTER = {tag: re.compile(gap) for tag, gap in {"spdx license identifier": rb"[\x00-\x20]*[:=]?[\x20\t]*", "licensed under": rb"[\x00-\x20]*[:=]?[\x20\t]*",
                                                "license": rb"[\x20\t]*:[\x20\t]*"}.items()}
_WORD, _ITEM = re.compile(rb"[^ ]+"), re.compile(rb"\(|\)|[A-Za-z0-9.+-]+|[\r\n]")
#: Words of prose before an expression.
_LEADING = {"the", "either", "of"}
_TOKEN = re.compile(r"\(|\)|[A-Za-z0-9.+-]+")
_RANK = {"with": 3, "and": 2, "or": 1}


def to_postfix(tokens: Iterable[str]) -> list[str] | None:
    """Shunting-yard: infix tokens to postfix, up to the first that cannot continue; None if nothing can be read."""
    out: list[str] = []
    stack: list[str] = []
    depth, want_operand = 0, True
    good = 0
    for token in tokens:
        if want_operand:
            if token == "(":
                stack.append(token)
                depth += 1
                continue
            if token in _RANK or token == ")":
                break
            out.append(token)
            want_operand = False
        elif token == ")" and depth:
            while stack[-1] != "(":
                out.append(stack.pop())
            stack.pop()
            depth -= 1
        elif token in _RANK:
            while stack and stack[-1] != "(" and _RANK[stack[-1]] >= _RANK[token]:
                out.append(stack.pop())
            stack.append(token)
            want_operand = True
        else:
            break
        good += 1
    if not good:
        return None
    if want_operand and stack and stack[-1] in _RANK:  # an operator that nothing follows
        stack.pop()
    return out + [op for op in reversed(stack) if op != "("]


def choices(expression: str) -> set[frozenset[str]]:
    """The alternatives that a licence expression offers: each a set of licences to be met together.

    Unknown identifiers stand for themselves; ``with`` adds its exception to
    the licence; what follows the readable part is ignored.
    """
    return _choices(t.lower() if t.lower() in _RANK else t for t in _TOKEN.findall(expression))


def _tokens(data: bytes, at: int, prose: bool) -> Iterator[str]:
    """Tokens from a place to the line's end; in prose, up to the first word that is no identifier."""
    leading = prose
    for m in _ITEM.finditer(data, at):
        token = m[0].decode()
        low = token.lower()
        if token in "\r\n":
            return
        if leading and low in _LEADING:
            continue
        leading = False
        if prose and low not in _RANK and token not in "()" and low not in IDENTIFIERS and low.rstrip(".+-") not in IDENTIFIERS and not (
                low.startswith("licenseref-") or low[0].isalpha() and any(c.isdigit() for c in low)):
            return
        yield low if low in _RANK else token


def _choices(tokens: Iterable[str]) -> set[frozenset[str]]:
    return _evaluate(tokens)[0]


def _evaluate(tokens: Iterable[str]) -> tuple[set[frozenset[str]], set[str]]:
    """The alternatives of an expression, and every licence in it.

    An expression of more than ``MOST_CHOICES`` alternatives is not
    multiplied out: it stands for itself, as one alternative in postfix order."""
    tokens = to_postfix(tokens) or []
    stack: list[tuple[set[frozenset[str]], set[str]]] = []
    whole = True
    for token in tokens:
        if token not in _RANK:
            name = token.lower().rstrip(".+-") if token.lower() not in IDENTIFIERS else token.lower()
            name = IDENTIFIERS.get(name, name)
            stack.append(({frozenset([name])}, {name}) if name else ({frozenset()}, set()))
            continue
        if len(stack) < 2:
            continue
        (b, of_b), (a, of_a) = stack.pop(), stack.pop()
        if token == "with":
            exception = next(iter(next(iter(b), ())), "")
            stack.append(({frozenset(f"{x} with {exception}" for x in alt) for alt in a}, of_a))
            continue
        whole = whole and (len(a) + len(b) if token == "or" else len(a) * len(b)) <= MOST_CHOICES
        both = set() if not whole else a | b if token == "or" else {x | y for x in a for y in b}
        stack.append((both, of_a | of_b))
    if not stack:
        return set(), set()
    found, licences = stack[-1]
    return (found if whole else {frozenset([" ".join(tokens).lower()])}), licences


@lru_cache(maxsize=4)
def _automaton(phrases: tuple[tuple[str, str], ...]):
    import ahocorasick

    automaton = ahocorasick.Automaton()
    for phrase, label in phrases:
        automaton.add_word(f" {phrase} ", (phrase, label))
    for tag in TAGS:
        automaton.add_word(f" {tag} ", (tag, None))
    automaton.make_automaton()
    return automaton


def _scan(text: str | None, automaton) -> tuple:
    text = text or ""
    raw = text.encode("utf-8", "surrogatepass").translate(_CLEAN)
    words = raw.split()
    clean = (b" " + b" ".join(words) + b" ").decode("latin-1")
    begins, base, labels, found = [], set(), set(), set()
    tags, word, at = [], -1, 0
    for end, (phrase, label) in automaton.iter(clean):
        if label is None:
            word, at = word + clean.count(" ", at, end), end
            tags.append((phrase, word))  # the tag's last word
            continue
        labels.add(label)
        if phrase in BASE_PHRASES:
            base.add(label)
            begins.append(end - len(phrase))
    starts: list[int] = []
    if begins:  # a place's word is the number of blanks before it
        blanks = np.flatnonzero(np.frombuffer(clean.encode("latin-1"), np.uint8) == ord(" "))
        starts = (np.searchsorted(blanks, begins) - 1).tolist()
    if tags:
        data = text.encode("utf-8", "surrogatepass")
        ends = [m.end() for m in _WORD.finditer(raw)]  # a word stands at the same bytes in the text
        for tag, word in tags:
            gap = _AFTER[tag].match(data, ends[word])
            if gap:
                alternatives, licences = _evaluate(_tokens(data, gap.end(), tag not in EXACT_TAGS))
                found.update(" and ".join(sorted(alternative)) for alternative in alternatives)
                labels.update(licences)
    labels.discard("")
    found.discard("")
    score = 1.0 - 0.5 ** (len(starts) + len(labels) + len(found))
    return (len(words), len(starts), min(starts, default=None), max(starts, default=None), ",".join(sorted(base)),
            ",".join(sorted(labels)), score, sorted(found))


def scan_licenses(text: Column, notices: dict[str, str] | None = None) -> Column:
    """Struct column of ``RESULT`` for each text.

    Null counts as empty: no words, no labels, score 0.  ``first_word`` and
    ``last_word`` are null without a base place.  The score is
    1 - 0.5 ^ (base places + labels + choices).  ``choices`` holds the
    alternatives that tagged licence expressions offer; an expression of more
    than ``MOST_CHOICES`` is one choice, written in postfix order, and its
    licences are labels like any other's.
    """
    phrases = tuple({**BASE_PHRASES, **(NOTICES if notices is None else notices)}.items())

    @F.pandas_udf(RESULT)
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        automaton = _automaton(phrases)
        names = [c.split()[0] for c in RESULT.split(", ")]
        for batch in batches:
            rows = pd.DataFrame([_scan(t, automaton) for t in batch], columns=names)
            for c in ("first_word", "last_word"):
                rows[c] = rows[c].astype("Int64")
            yield rows

    return run(text)
