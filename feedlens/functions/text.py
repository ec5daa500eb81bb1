"""Text expressions: trimming, normalisation, accent stripping, word n-grams.

All native Spark expressions (Java regex, ``translate``, higher-order array
functions), so tokenisation runs inside whole-stage codegen on the executors.
"""

from __future__ import annotations

import unicodedata

from pyspark.sql import Column
from pyspark.sql import functions as F

# The token rule (runs of at least two letters, digits or
# underscores; the same tokens as ``\b\w\w+\b`` on Unicode text).
TOKEN_PATTERN = r"[\p{L}\p{N}_]{2,}"

# Whitespace = the characters Python's str.isspace() accepts (generated by rule).
WHITESPACE = "".join(chr(c) for c in range(0x3001) if chr(c).isspace())
WS_RUNS = r"(?U)\s+"


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def strip_ws(c) -> Column:
    """Remove leading/trailing Unicode whitespace (plain ``trim`` only removes
    spaces); a native two-sided trim over the whitespace set, no regex."""
    return F.btrim(_c(c), F.lit(WHITESPACE))


def clean_text(c) -> Column:
    """Trimmed text, blank → null (callers drop the null rows)."""
    s = strip_ws(_c(c))
    return F.when(F.length(s) > 0, s)


def normalize_text(c) -> Column:
    """P5: lower-case, trim, collapse whitespace runs to one space."""
    return strip_ws(F.regexp_replace(F.lower(_c(c)), WS_RUNS, " "))


def _accent_table() -> tuple[str, str, dict[str, str]]:
    """The NFKD rule (decompose, drop combining marks) over the basic plane: characters with
    one base letter or digit and that base, then the combining marks (``translate`` deletes
    what has no counterpart); and ligatures of several letters (Hangul syllables stay whole)."""
    src, dst, marks, several = [], [], [], {}
    for cp in range(0xA0, 0x10000):
        if 0xD800 <= cp < 0xE000 or 0xAC00 <= cp < 0xD7A4:
            continue
        ch = chr(cp)
        base = "".join(x for x in unicodedata.normalize("NFKD", ch) if not unicodedata.combining(x))
        if not base and unicodedata.combining(ch):
            marks.append(ch)
        elif len(base) == 1 and base != ch and base.isalnum():
            src.append(ch)
            dst.append(base)
        elif len(base) > 1 and ch.isalpha() and base.isascii() and base.isalpha():
            several[ch] = base
    return "".join(src + marks), "".join(dst), several


ACCENTED, UNACCENTED, LIGATURES = _accent_table()


def strip_accents(c) -> Column:
    """Accent stripping: one native ``translate``; texts with ligatures get them spelled out, those of
    one byte a character have neither."""
    s = _c(c)
    plain = F.translate(s, ACCENTED, UNACCENTED)
    spelled = plain
    for ligature, letters in LIGATURES.items():
        spelled = F.replace(spelled, F.lit(ligature), F.lit(letters))
    return F.when(F.octet_length(s) == F.length(s), s).when(plain.rlike("[" + "".join(LIGATURES) + "]"), spelled).otherwise(plain)


def tokens(c, accents: bool = True) -> Column:
    """Lower-cased (accent-stripped) word tokens of at least two characters."""
    s = F.lower(_c(c))
    if accents:
        s = strip_accents(s)
    return F.regexp_extract_all(s, F.lit(TOKEN_PATTERN), 0)


def bigrams(tok) -> Column:
    """Adjacent token pairs joined by one space."""
    t = _c(tok)
    n = F.greatest(F.size(t) - 1, F.lit(0))
    return F.zip_with(F.slice(t, 1, n), F.slice(t, 2, n), lambda a, b: F.concat(a, F.lit(" "), b))


def word_ngrams(tok) -> Column:
    """Unigrams followed by bigrams (n-gram range 1..2)."""
    t = _c(tok)
    return F.concat(t, bigrams(t))
