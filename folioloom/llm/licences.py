"""Licence scans: an Aho-Corasick automaton over notice phrases and identifier tags, and licence expressions.

One walk over the words of a text finds all phrases and tags. What follows a tag is an expression such as
``(MIT OR GPL-2.0-only WITH Classpath-exception-2.0) AND CC0-1.0``; it is put into postfix order by the
shunting-yard method and evaluated: a choice is as open as its most open branch, a conjunction as its least
open one, and an exception opens what it modifies by a step.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folioloom.llm.common import LETTERS

# Fixed values of the base scan: phrases and their labels.
BASE = {"under the mit license": "mit", "apache license version 2": "apache-2", "cc by nc": "cc-by-nc"}
# Further notices.
NOTICES = {
    "gnu general public license version 3": "gpl-3",
    "gnu general public license version 2": "gpl-2",
    "gnu affero general public license": "agpl-3",
    "gnu lesser general public license": "lgpl",
    "mozilla public license": "mpl-2",
    "eclipse public license": "epl-2",
    "redistribution and use in source and binary forms": "bsd",
    "isc license": "isc",
    "creative commons attribution": "cc-by",
    "creative commons zero": "cc0",
    "cc by sa": "cc-by-sa",
    "cc by nd": "cc-by-nd",
    "dedicated to the public domain": "public-domain",
    "all rights reserved": "all-rights-reserved",
}
TAGS = ["spdx license identifier", "license expression"]
# How open a licence is, by the start of its label; what is not listed has UNKNOWN.
OPENNESS = {
    "mit": 1.0, "apache": 1.0, "bsd": 1.0, "isc": 1.0, "cc0": 1.0, "public-domain": 1.0, "unlicense": 1.0, "zlib": 1.0,
    "cc-by-nc": 0.2, "cc-by-nd": 0.3, "cc-by-sa": 0.6, "cc-by": 0.9, "lgpl": 0.7, "mpl": 0.7, "epl": 0.7,
    "gpl": 0.5, "agpl": 0.4, "all-rights-reserved": 0.0,
}
UNKNOWN = 0.1
EXCEPTION_STEP = 0.2
PRECEDENCE = {"or": 1, "and": 2, "with": 3}

RESULT = ("n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, "
          "expressions array<string>, score double")


def openness(label: str) -> float:
    fitting = [p for p in OPENNESS if label.startswith(p)]
    return OPENNESS[max(fitting, key=len)] if fitting else UNKNOWN


def postfix(expression: str) -> tuple[list[str], bool]:
    """Tokens of an expression in postfix order, and whether it is well formed (else the tokens are useless)."""
    out, stack, operand_next, depth_ok = [], [], True, True
    for token in re.findall(r"[()]|[A-Za-z0-9.+:-]+", expression):
        low = token.lower()
        if token == "(":
            # An exception is one name.
            depth_ok &= operand_next and stack[-1:] != ["with"]
            stack.append(token)
        elif token == ")":
            while stack and stack[-1] != "(":
                out.append(stack.pop())
            depth_ok &= bool(stack) and not operand_next
            if stack:
                stack.pop()
        elif low in PRECEDENCE:
            depth_ok &= not operand_next
            while stack and stack[-1] != "(" and PRECEDENCE[stack[-1]] >= PRECEDENCE[low]:
                out.append(stack.pop())
            stack.append(low)
            operand_next = True
        else:
            depth_ok &= operand_next
            out.append(low)
            operand_next = False
    depth_ok &= "(" not in stack
    return out + [x for x in reversed(stack) if x != "("], depth_ok and not operand_next


def evaluated(expression: str) -> tuple[float, list[str]]:
    """Openness and licence labels of an expression; 0 and no labels where it is malformed."""
    order, sound = postfix(expression)
    if not sound:
        return 0.0, []
    stack: list[tuple[float, list[str]]] = []
    for token in order:
        if token not in PRECEDENCE:
            stack.append((openness(token), [token]))
            continue
        (right, names), (left, others) = stack.pop(), stack.pop()
        if token == "with":
            stack.append((min(1.0, left + EXCEPTION_STEP), others))
        else:
            stack.append(((max if token == "or" else min)(left, right), others + names))
    return stack[0]


# What names a licence: one of a listed family, a reference, or a name that ends in a version.
IDENTIFIER = re.compile(
    r"(?:" + "|".join(sorted(OPENNESS, key=len, reverse=True)) + r")(?:-[a-z0-9.]+)*\+?|(?:documentref-[a-z0-9.-]+:)?licenseref-[a-z0-9.-]+"
    r"|[a-z][a-z0-9]*(?:-[a-z][a-z0-9]*)*-[0-9][0-9.]*(?:-[a-z0-9.]+)*\+?", re.I)
EXCEPTION = re.compile(r"[a-z0-9.]+(?:-[a-z0-9.]+)*-exception(?:-[a-z0-9.]+)*|(?:documentref-[a-z0-9.-]+:)?additionref-[a-z0-9.-]+", re.I)
TOKEN = re.compile(r"[ \t]*([()]|[A-Za-z0-9.+:-]+)")


def _named(token: str, after: str) -> str | None:
    """The token as an identifier, without marks of a sentence at its end."""
    token = token.rstrip(".:-")
    return token if (EXCEPTION if after == "with" else IDENTIFIER).fullmatch(token) else None


def expression_at(text: str, at: int) -> str:
    """The longest expression that begins there: brackets, identifiers and operators between identifiers. A word that is no identifier ends it.

    An open bracket that is never closed keeps the expression malformed. Nothing where no identifier follows.
    """
    begin, end, depth, after, waiting = None, at, 0, "", True
    while found := TOKEN.match(text, at):
        token, low = found[1], found[1].lower()
        if begin is None:
            begin = found.start(1)
        name = _named(token, after)
        if waiting and token == "(" and after != "with":
            depth += 1
        elif waiting and name:
            end, waiting = found.start(1) + len(name), False
            if name != token:
                break
        elif not waiting and token == ")" and depth:
            depth -= 1
            end = found.end()
        elif not waiting and low in PRECEDENCE:
            waiting = True
        else:
            break
        after = low
        at = found.end()
    return text[begin:end] if begin is not None and end > begin else ""


TAG_TEXT = re.compile(r"(?:spdx-license-identifier|license-expression)[ \t]*:", re.I)


def _automaton() -> ahocorasick.Automaton:
    machine = ahocorasick.Automaton()
    for phrase, label in [*BASE.items(), *NOTICES.items(), *((t, None) for t in TAGS)]:
        machine.add_word(f" {phrase} ", (len(phrase) + 2, phrase, label))
    machine.make_automaton()
    return machine


def scan(text: bytes | None, machine: ahocorasick.Automaton) -> tuple:
    words = (text or b"").translate(LETTERS).split()
    line = f" {b' '.join(words).decode('utf-8', 'replace')} "
    base, labels, values, places, expressions, tagged = set(), set(), [], [], [], False
    counted, position = 0, 0
    for end, (length, phrase, label) in machine.iter(line):
        if label is None:
            tagged = True
            continue
        labels.add(label)
        values.append(openness(label))
        if phrase in BASE:
            start = end - length + 1
            # Matches come by their ends, so starts may step back a little.
            counted += line.count(" ", position, start) if start >= position else -line.count(" ", start, position)
            position = start
            base.add(label)
            places.append(counted)
    if tagged:
        raw = text.decode("utf-8", "replace")
        for tag in TAG_TEXT.finditer(raw):
            expression = expression_at(raw, tag.end())
            value, names = evaluated(expression)
            expressions.append(expression)
            values.append(value)
            labels.update(names)
    return (len(words), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(base)),
            ",".join(sorted(labels)), expressions, min(values, default=0.0))


def licence_scan(docs: DataFrame) -> DataFrame:
    """All rows and columns of ``docs`` and a struct ``licence``: n_words, n_base, first_word, last_word, base_labels,
    labels, expressions, score.

    ``docs`` needs text. Words are ASCII letters in lower case and digits, and all other characters beyond ASCII. A phrase counts
    wherever its words stand one behind the other, overlapping or not. The score is how open the text as a
    whole may be used: all notices and expressions hold together, so the least open one decides; 0 where nothing is found or an
    expression is malformed or missing behind its tag. An expression ends before the first word that is no identifier. Null and empty texts have no words, empty labels and null word places. Texts are
    taken whole; repeated rows each come out. A column called ``licence`` in ``docs`` is replaced.
    """
    @F.arrow_udf(RESULT)
    def scanned(parts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        machine = _automaton()
        kinds = [pa.int64()] * 4 + [pa.string()] * 2 + [pa.list_(pa.string()), pa.float64()]
        names = [x.split()[0] for x in RESULT.split(", ")]
        for part in parts:
            rows = [scan(x, machine) for x in part.cast(pa.binary()).to_pylist()]
            columns = list(zip(*rows, strict=True)) if rows else [[]] * len(kinds)
            yield pa.StructArray.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)

    return docs.withColumn("licence", scanned("text"))
