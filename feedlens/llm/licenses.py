"""License scan (operator 10): Aho-Corasick over word sequences, licence expressions by a
shunting-yard parser.

A text is lower-cased (A-Z only) and reduced to its words joined by single spaces; one automaton
pass finds every notice phrase at word bounds.  Where the identifier tag phrase occurs, the
expression after each ``SPDX-License-Identifier:`` is parsed (WITH binds closest, then AND, then
OR) and its licence ids become labels; an expression that does not parse gives ``unparsed``.
``permissive`` evaluates the expressions: whether each of them can be met with licences of
``PERMISSIVE`` only (OR one side, AND both, WITH the licence; one that does not parse cannot).

Defined results: a null text counts as empty (no words, no labels, score 0); repeated rows are
kept; ``permissive`` is null where there is no expression.  ``score`` is 1 minus the product of (1 - weight) over distinct labels.
"""

from __future__ import annotations

import re
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame

from feedlens.llm import common

#: Base phrases and their labels.
BASE = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}
#: Notice phrases of the method and their labels.
NOTICES = {
    "licensed under cc by nc": "cc-by-nc", "licensed under cc by": "cc-by", "creative commons": "cc",
    "bsd license": "bsd", "mozilla public license": "mpl", "lesser general public license": "lgpl",
    "affero general public license": "agpl", "eclipse public license": "epl", "isc license": "isc",
    "all rights reserved": "proprietary", "released into the public domain": "public-domain",
}
TAG = "spdx license identifier"
WEIGHTS = {"base": 0.9, "notice": 0.7, "tag": 0.95}
#: Licence ids (lower case) that allow reuse under notice terms at most.
PERMISSIVE = frozenset({"0bsd", "apache-2.0", "bsd-2-clause", "bsd-3-clause", "bsl-1.0", "cc0-1.0", "isc", "mit", "mit-0",
                        "ncsa", "postgresql", "unlicense", "x11", "zlib"})
_TAG_LINE = re.compile(r"(?i:spdx-license-identifier):[ \t]*([^\r\n]*)")
_TOKEN = re.compile(r"[ \t]*([()]|[A-Za-z0-9.+:-]+)")
_PRECEDENCE = {"OR": 1, "AND": 2, "WITH": 3}
#: Lower-cases A-Z, keeps digits, a-z and all non-ASCII bytes, turns the rest into spaces.
_WORDS = bytes((c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32) for c in range(256))


@lru_cache(maxsize=1)
def automaton():
    import ahocorasick
    found = ahocorasick.Automaton()
    for phrase in [*BASE, *NOTICES, TAG]:
        found.add_word(f" {phrase} ", phrase)
    found.make_automaton()
    return found


def parse_expression(text: str) -> list[str] | None:
    """Reverse Polish form of a licence expression; None where it does not parse.

    The expression ends at the first character that cannot belong to one or at a word where an
    operator is due."""
    out: list[str] = []
    operators: list[str] = []
    operand_due, at, depth = True, 0, 0
    while m := _TOKEN.match(text, at):
        token = m[1]
        if token in _PRECEDENCE or token.upper() in _PRECEDENCE:
            if operand_due:
                return None
            token = token.upper()
            while operators and operators[-1] != "(" and _PRECEDENCE[operators[-1]] >= _PRECEDENCE[token]:
                out.append(operators.pop())
            operators.append(token)
            operand_due = True
        elif token == "(":
            if not operand_due:
                break
            operators.append(token)
            depth += 1
        elif token == ")":
            if operand_due:
                return None
            if not depth:
                break
            while operators[-1] != "(":
                out.append(operators.pop())
            operators.pop()
            depth -= 1
        else:
            if not operand_due:
                break
            out.append(token)
            operand_due = False
        at = m.end()
    if operand_due or depth:
        return None
    out.extend(reversed(operators))
    return out


def licence_ids(rpn: list[str]) -> list[str]:
    """Licence ids of an expression, lower case; an exception is not a licence."""
    stack: list[list[str]] = []
    for token in rpn:
        if token in _PRECEDENCE:
            right, left = stack.pop(), stack.pop()
            stack.append(left if token == "WITH" else left + right)
        else:
            stack.append([token.lower()])
    return stack[-1]


def permits(rpn: list[str], allowed: set[str] | frozenset[str]) -> bool:
    """Whether the expression can be met with allowed licences only (lower-case ids)."""
    stack: list[bool] = []
    for token in rpn:
        if token in _PRECEDENCE:
            right, left = stack.pop(), stack.pop()
            stack.append({"OR": left or right, "AND": left and right, "WITH": left}[token])
        else:
            stack.append(token.lower() in allowed)
    return stack[-1]


def scan_text(text: str) -> tuple:
    """(words, base places, first, last start, base labels, labels, score, expressions, permissive)."""
    words = text.encode().translate(_WORDS).split()
    joined = f" {b' '.join(words).decode()} "
    places: list[int] = []
    base: set[str] = set()
    weights: dict[str, float] = {}
    expressions: list[str] = []
    permissive = None
    seen = at = 0
    tagged = False
    for end, phrase in automaton().iter(joined):
        start = end - len(phrase) - 1                       # of the space before the phrase
        if phrase in BASE:
            seen, at = (seen + joined.count(" ", at, start), start) if start >= at else (joined.count(" ", 0, start), start)
            places.append(seen)
            base.add(BASE[phrase])
            weights[BASE[phrase]] = max(weights.get(BASE[phrase], 0), WEIGHTS["base"])
        elif phrase == TAG:
            tagged = True
        else:
            weights[NOTICES[phrase]] = max(weights.get(NOTICES[phrase], 0), WEIGHTS["notice"])
    if tagged:
        for m in _TAG_LINE.finditer(text):
            rpn = parse_expression(m[1])
            expressions.append(" ".join(rpn) if rpn else "")
            permissive = permissive is not False and bool(rpn) and permits(rpn, PERMISSIVE)
            for label in licence_ids(rpn) if rpn else ["unparsed"]:
                weights[label] = max(weights.get(label, 0), WEIGHTS["tag"] if rpn else 0.3)
    rest = 1.0
    for label in sorted(weights):
        rest *= 1 - weights[label]
    return (len(words), len(places), min(places, default=None), max(places, default=None),
            ",".join(sorted(base)), ",".join(sorted(weights)), 1 - rest if weights else 0.0, expressions, permissive)


_OUT = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_base", pa.int64()), ("first_word", pa.int64()),
                  ("last_word", pa.int64()), ("base_labels", pa.string()), ("labels", pa.string()),
                  ("score", pa.float64()), ("expressions", pa.list_(pa.string())), ("permissive", pa.bool_())])


def _scan(batches):
    for batch in batches:
        found = [scan_text(t) for t in common.texts_of(batch)]
        columns = dict(zip(_OUT.names[1:], map(list, zip(*found)) if found else [[]] * 9))
        yield common.rows(_OUT, {"doc_id": batch.column("doc_id"), **columns})


def scan(docs: DataFrame) -> DataFrame:
    """Licence findings of every row of ``docs`` (doc_id, text)."""
    return docs.select("doc_id", "text").transform(
            common.map_arrow,
        _scan, "doc_id bigint, n_words bigint, n_base bigint, first_word bigint, last_word bigint, "
               "base_labels string, labels string, score double, expressions array<string>, permissive boolean")


def op10_licenses(spark, sf_dir) -> DataFrame:
    return scan(common.documents(spark, sf_dir))


QUERIES = {"op10_licenses": op10_licenses}
ORACLES: dict[str, str] = {}
