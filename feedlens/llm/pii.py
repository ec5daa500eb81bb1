"""Personal data by bootstrapped contextual extraction (operator 1).

Base rules find emails, IPv4 addresses, card and phone numbers.  These seeds and everything else
of a plausible form (candidates: scans for each form, spaces and parentheses inside included,
``[at]`` addresses, masked cards) form a graph with the lexical patterns around them: the two
words before, and the word before with the word after.  Spark scores the graph in rounds: a
pattern's confidence for a kind is the share of its distinct instances known to be of that kind,
each weighed by its score (seeds 1); an instance not yet known scores 1 minus the product of (1 - confidence) over its accepted
patterns.  Patterns of enough support and confidence promote candidates whose form is plausible
for the kind, which support further patterns in the next round, until nothing changes.

Defined results: a null text counts as empty and holds nothing; repeated rows are kept and get the
same spans; candidates lie between the base spans; strings without a plausible form are no
instances and weigh on no pattern.  Positions are code points.  Texts of any length are scanned
whole; a pattern's words are looked for in the 80 characters before and the 60 after a mention.
Other columns are kept as they are, whatever their names.
"""

from __future__ import annotations

import re
from functools import partial

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedlens.llm import common

KINDS = ("email", "ip", "card", "phone")
MIN_SUPPORT = 3
MIN_CONFIDENCE = 0.8
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")
_EDGE = ".,;:!?()[]{}<>\"'"
_AT = re.compile(r"@| ?(?:\[at\]|\(at\)|\{at\}) ?", re.IGNORECASE)
_AT_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:(?:\.| ?(?:\[dot\]|\(dot\)|\{dot\}) ?)[A-Za-z0-9-]+)*", re.IGNORECASE)
#: Forms begin and end at white space or punctuation, not inside a word or a longer number.
_BEGIN = r"(?<![^\s\[\]{}<>\"',;:!?(=|.])(?<!\w\.)(?<![0-9][,:])"
_END = r"(?![^\s\[\]{}<>\"',;:!?)|.])(?![.,:]\w)"
_NUMBER = r"[0-9]{2,6}"
_FORMS = [(k, re.compile(_BEGIN + p + _END)) for k, p in (
    (1, r"(?:(?:[0-9A-Fa-f]{0,4}:){3,7}[0-9A-Fa-f]{0,4}|[0-9]{1,3}(?:[.-][0-9]{1,3}){3}(?::[0-9]+)?)"),
    (2, r"[0-9*xX]{4}(?:[ -][0-9*xX]{6}[ -][0-9*xX]{5}|(?:[ -]?[0-9*xX]{3,4}){2,4})"),
    (3, rf"(?:\(?[0-9]{{2,5}}\)?(?:[-./]{_NUMBER}){{1,5}}|[0-9]{{7,13}})"),
    (3, rf"\+?(?:[0-9]{{1,3}}[ .-]{{1,2}})?(?:\([0-9]{{1,5}}\)[ -]{{0,2}}{_NUMBER}|[0-9]{{2,5}} {{1,2}}{_NUMBER})"
        rf"(?: {{1,2}}{_NUMBER}){{0,3}}(?:[-./]{_NUMBER}){{0,5}}"))]
_SPACED = _FORMS[-1][1]
_BEGINS, _ENDS = re.compile(_BEGIN), re.compile(_END)
_LAST = re.compile(r"[ ./-]+[0-9]+\Z")


def _luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind number, end) of the base rules, by start, then kind.

    Every rule takes one pass: emails grow from their @, and no search starts inside a digit run."""
    out = []
    free, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > free and text[start - 1] in _LOCAL:
            start -= 1
        m = _DOMAIN.match(text, at + 1) if start < at else None
        if m:
            out.append((start, 0, m.end()))
            free = m.end()
        at = text.find("@", max(at + 1, free))
    if _DIGIT.search(text):
        for m in _IP.finditer(text):
            if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or "0") <= 255 for p in m[0].split(".")):
                out.append((m.start(), 1, m.end()))
        for m in _CARD.finditer(text):
            digits = m[0].replace(" ", "").replace("-", "")
            if 14 <= len(digits) <= 19 and _luhn(digits):
                out.append((m.start(), 2, m.end()))
        if "+" in text:
            for m in _PHONE.finditer(text):
                if 10 <= len(_DIGIT.findall(m[0])) <= 15:
                    out.append((m.start(), 3, m.end()))
    return sorted(out)


def _context(text: str, start: int, end: int) -> tuple[str, str]:
    """The patterns of a mention, digits masked: two words before; one before and one after."""
    before = re.sub("[0-9]", "0", text[max(0, start - 80):start]).lower().split()
    after = text[end:end + 60].lower().split()
    left = before[-2:] if start <= 80 or len(before) > 2 else []
    first = after[0].strip(_EDGE) if after else ""
    two = " ".join(w.strip(_EDGE) for w in left) if len(left) == 2 else ""
    around = f"{before[-1].strip(_EDGE)} _ {first}" if before and first else ""
    return two, around


def _forms_between(text: str, lo: int, hi: int):
    """(start, end, kind number) of everything of a plausible form in a part of the text."""
    free = lo
    for m in _AT.finditer(text, lo, hi):
        start = m.start()
        while start > free and text[start - 1] in _LOCAL:
            start -= 1
        domain = _AT_DOMAIN.match(text, m.end(), hi)
        free = m.end()
        if domain and (m[0] == "@" or start < m.start()) and _BEGINS.match(text, start) and _ENDS.match(text, domain.end(), hi):
            yield start, domain.end(), 0
    if _DIGIT.search(text, lo, hi):
        for k, form in _FORMS:
            for m in form.finditer(text, lo, hi):
                found = m[0]
                if form is _SPACED:
                    while len(_DIGIT.findall(found)) > 15:
                        found = _LAST.sub("", found)
                    if len(_DIGIT.findall(found)) < 7:
                        continue
                if len(found) >= 4 and _DIGIT.search(found):
                    yield m.start(), m.start() + len(found), k


def candidates(text: str, spans: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """(start, end, form) of what has a plausible form between the base spans; ``form`` has bit k
    set where kind k is plausible.  Where places overlap the first, then the longest stays."""
    places: dict[tuple[int, int], int] = {}
    at = 0
    for lo, _, hi in [*spans, (len(text), 0, len(text))]:
        if lo - at >= 4:
            for s, e, k in _forms_between(text, at, lo):
                places[s, e] = places.get((s, e), 0) | 1 << k
        at = max(at, hi)
    out, at = [], 0
    for (s, e), form in sorted(places.items(), key=lambda x: (x[0][0], -x[0][1])):
        if s >= at:
            out.append((s, e, form))
            at = e
    return out


def _id(value: str) -> int:
    return xxhash.xxh3_64_intdigest(value) - (1 << 63)


_SPAN = pa.struct([("s", pa.int64()), ("k", pa.int32()), ("e", pa.int64())])
_MENTION = pa.struct([("s", pa.int64()), ("e", pa.int64()), ("k", pa.int32()), ("form", pa.int32()), ("v", pa.int64()),
                      ("p", pa.list_(pa.string()))])
_MENTIONS = "array<struct<s:bigint,e:bigint,k:int,form:int,v:bigint,p:array<string>>>"
_SPANS = "array<struct<s:bigint,k:int,e:bigint>>"


def mentions(text: str) -> tuple[list, list]:
    """Base spans and mentions (of base spans and candidates)."""
    spans = base_spans(text)
    found = []
    for s, k, e in spans:
        found.append({"s": s, "e": e, "k": k, "form": 0, "v": _id(text[s:e].lower()), "p": [p for p in _context(text, s, e) if p]})
    for s, e, form in candidates(text, spans):
        found.append({"s": s, "e": e, "k": -1, "form": form, "v": _id(text[s:e].lower()), "p": [p for p in _context(text, s, e) if p]})
    return [{"s": s, "k": k, "e": e} for s, k, e in spans], found


def _extract(batches, keep):
    for batch in batches:
        texts = common.texts_of(batch)
        found = [mentions(t) for t in texts]
        yield pa.RecordBatch.from_arrays(
            [*(batch.column(k) for k in keep), pa.array([xxhash.xxh3_128_digest(t) for t in texts], pa.binary()),
             pa.array([f[0] for f in found], pa.list_(_SPAN)), pa.array([f[1] for f in found], pa.list_(_MENTION))],
            [*keep, "__pii_key", "__pii_base", "__pii_mentions"])


def extract(docs: DataFrame, keep: list[str]) -> DataFrame:
    """``keep`` columns, a key of the text, its base spans and mentions; written once."""
    schema = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in docs.select(*keep).schema)
    return common.written(docs.select(*dict.fromkeys([*keep, "text"])).transform(
            common.map_arrow,
        partial(_extract, keep=keep), f"{schema}__pii_key binary, __pii_base {_SPANS}, __pii_mentions {_MENTIONS}"), "pii-mentions")


def discover(extracted: DataFrame, min_support: int = MIN_SUPPORT, min_confidence: float = MIN_CONFIDENCE) -> DataFrame:
    """(kind, instance) of the candidates that accepted patterns promote, with their score.

    Promoted candidates stay promoted with the score they came in by, so the rounds end: each adds
    one at least or is the last."""
    spark = extracted.sparkSession
    # one edge per pattern, instance and kind: copies of a text count once, hot patterns shrink
    edges = common.written(extracted.select(F.explode("__pii_mentions").alias("m")).select("m.v", "m.k", "m.form", F.explode("m.p").alias("p"))
                           .groupBy("p", "v", "k", "form").agg(F.count("*").alias("n")), "pii-edges")
    kinds = F.explode(F.array(*(F.lit(k) for k in range(len(KINDS))))).alias("kind")
    open_edges = edges.filter("k < 0 and form > 0").select("p", "v", "form", kinds).filter(
        F.expr("shiftright(form, kind) & 1 = 1"))
    known = spark.createDataFrame([], "kind int, v bigint, score double")
    before = turn = 0
    while True:
        promoted = edges.filter("k < 0").join(known, "v").select("p", "v", "kind", "score")
        seeds = edges.filter("k >= 0").select("p", "v", F.col("k").alias("kind"), F.lit(1.0).alias("score")).unionByName(promoted)
        support = (seeds.groupBy("p", "kind", "v").agg(F.max("score").alias("score"))
                   .groupBy("p", "kind").agg(F.count("*").alias("n_known"), F.sum("score").alias("weight")))
        every = edges.groupBy("p").agg(F.countDistinct("v").alias("n_all"))
        patterns = (support.join(every, "p").withColumn("confidence", F.round(F.col("weight") / F.col("n_all"), 9))
                    .filter((F.col("n_known") >= min_support) & (F.col("confidence") >= min_confidence)))
        now = common.written(
            open_edges.join(patterns, ["p", "kind"]).groupBy("kind", "v")
            .agg((1 - F.exp(F.sum(F.log(F.greatest(1 - F.col("confidence"), F.lit(1e-6)))))).alias("score"))
            .join(known, ["kind", "v"], "left_anti").unionByName(known), f"pii-round{turn}")
        n = now.count()
        known = now
        if n == before:
            return known
        before, turn = n, turn + 1


def extra_spans(extracted: DataFrame, known: DataFrame) -> DataFrame:
    """(__pii_key, __pii_extra): promoted spans of each distinct text; the best score, then the kind, wins."""
    m = extracted.select("__pii_key", F.explode("__pii_mentions").alias("m")).filter("m.k < 0").select("__pii_key", "m.s", "m.e", "m.v").distinct()
    best = known.groupBy("v").agg(F.max(F.struct("score", (-F.col("kind")).alias("k"))).alias("b")).select("v", (-F.col("b.k")).alias("k"))
    return common.written(m.join(best, "v").groupBy("__pii_key").agg(F.collect_list(F.struct("s", "k", "e")).alias("__pii_extra")), "pii-extra")


def find(docs: DataFrame, keep: list[str]) -> DataFrame:
    """``keep`` columns, ``base`` and ``spans`` (arrays of start, kind number, end) of every row."""
    extracted = extract(docs, keep)
    extra = extra_spans(extracted, discover(extracted))
    return extracted.join(extra, "__pii_key", "left").select(
        *keep, F.col("__pii_base").alias("base"),
        F.array_sort(F.concat("__pii_base", F.coalesce("__pii_extra", F.array().cast(_SPANS)))).alias("spans"))


def as_string(spans):
    names = F.array(*map(F.lit, KINDS))
    return F.concat_ws(",", F.transform(spans, lambda x: F.concat_ws(":", names[x["k"]], x["s"], x["e"])))


def _redact(batches, names):
    for batch in batches:
        extra = batch.column("__pii_extra").to_pylist()
        texts = batch.column("text").to_pylist()
        out = []
        for text, more in zip(texts, extra):
            spans = sorted(base_spans(text or "") + [(x["s"], x["k"], x["e"]) for x in more or []])
            if spans:
                parts, at = [], 0
                for s, k, e in spans:
                    if s >= at:
                        parts += [text[at:s], f"[{KINDS[k].upper()}]"]
                    elif e > at:                              # overlaps the span before: cover the rest too
                        pass
                    at = max(at, e)
                text = "".join([*parts, text[at:]])
            out.append(text)
        columns = [pa.array(out, pa.string()) if n == "text" else batch.column(n) for n in names]
        yield pa.RecordBatch.from_arrays(columns, names)


@common.isolated("text", "n_chars")
def redact(docs: DataFrame) -> DataFrame:
    """``docs`` with every found span replaced by its kind in brackets, n_chars kept in step."""
    extracted = extract(docs, [])
    extra = extra_spans(extracted, discover(extracted))
    names = docs.columns
    key = partial(_keyed, names=names)
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema)
    with_extra = docs.transform(common.map_arrow, key, schema + ", __pii_key binary").join(extra, "__pii_key", "left")
    clean = with_extra.select(*names, "__pii_extra").transform(common.map_arrow, partial(_redact, names=names), schema)
    return clean.withColumn("n_chars", F.char_length("text").cast("long")) if "n_chars" in names else clean


def _keyed(batches, names):
    for batch in batches:
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array([xxhash.xxh3_128_digest(t) for t in common.texts_of(batch)], pa.binary())],
                                         [*names, "__pii_key"])


def _count_of(kind: int):
    """Number of base spans of a kind (a lambda of two parameters would be given the index too)."""
    return F.size(F.filter("base", lambda x: x["k"] == kind)).cast("long")


def op1_pii(spark, sf_dir) -> DataFrame:
    return digests(find(common.documents(spark, sf_dir), ["doc_id"]))


def digests(found: DataFrame) -> DataFrame:
    """Counts by kind and the span strings of rows of :func:`find`."""
    counts = [_count_of(k).alias(f"n_{name}") for k, name in enumerate(KINDS)]
    return found.select("doc_id", *counts, F.sha2(as_string(F.col("base")), 256).alias("base_sha256"), as_string(F.col("spans")).alias("spans"))


QUERIES = {"op1_pii": op1_pii}
ORACLES: dict[str, str] = {}
