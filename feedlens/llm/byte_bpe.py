"""Byte-level BPE encoding and decoding with vectorised pre-tokenisation (operator 8).

Texts become code point arrays and every code point a symbol (letter, number, other, white space
and apostrophe variants; which variant depends only on the next two characters).  A symbol acts
on the eight states of the pre-token automaton, hence is a transition function; functions compose
associatively, so the state before every character comes from a blocked scan over function
numbers and a composition table.  No regular expression runs on the texts.  The resulting byte
slices go through cached pair merging, and decoding gathers vocabulary bytes by offsets.

Defined results: null and empty texts have no tokens and decode to no bytes; special strings are
ordinary text; texts of any length are encoded whole; repeated rows are kept; only the ``keep`` columns are
carried; decoding an id outside the vocabulary raises.
"""

from __future__ import annotations

import base64
import struct
from functools import lru_cache, partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedlens.llm import common
from feedlens.llm.bpe_merge import Costs, merge

LETTER, NUMBER, OTHER, QUOTE1, QUOTE2, SPACE_LAST, SPACE_IN, WHITE_LAST, WHITE_IN, END = range(10)
#: States: nothing open, in a letter / number / other token, after a prefix space, inside a white
#: space run, one and two letters of a contraction to come.
FREE, IN_L, IN_N, IN_O, PREFIX, IN_W, ONE, TWO = range(8)
SEPARATOR = 0x110000
BLOCK = 64
#: Fixed value: the code points that \s matches.
WHITE = [*range(0x09, 0x0E), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]


@lru_cache(maxsize=1)
def classes() -> np.ndarray:
    """LETTER, NUMBER or OTHER of every code point; white space is 255, the separator END."""
    import regex
    out = np.full(SEPARATOR + 1, OTHER, np.uint8)
    every = "".join(chr(c) for c in range(SEPARATOR) if not 0xD800 <= c < 0xE000)
    for what, pattern in ((LETTER, r"\p{L}+"), (NUMBER, r"\p{N}+")):
        for m in regex.finditer(pattern, every):
            lo, hi = ord(m[0][0]), ord(m[0][-1])
            out[lo:hi + 1] = what
    out[WHITE] = 255
    out[SEPARATOR] = END
    return out


@lru_cache(maxsize=1)
def automaton() -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(next state, token starts here) by [state, symbol]; (composition, functions) of the monoid
    of transition functions: function i is symbol i for i < 10, the last is the identity."""
    nxt, starts = np.zeros((8, 10), np.uint8), np.ones((8, 10), bool)
    for state in range(8):
        for symbol, own in ((LETTER, IN_L), (NUMBER, IN_N), (OTHER, IN_O), (QUOTE1, IN_O), (QUOTE2, IN_O)):
            if state in (ONE, TWO):
                nxt[state, symbol], starts[state, symbol] = FREE if state == ONE else ONE, False
            elif state in (own, PREFIX):
                nxt[state, symbol], starts[state, symbol] = own, False
            else:
                nxt[state, symbol] = {QUOTE1: ONE, QUOTE2: TWO}.get(symbol, own)
        for symbol in (SPACE_IN, WHITE_IN):
            nxt[state, symbol], starts[state, symbol] = IN_W, state != IN_W
        nxt[state, SPACE_LAST], nxt[state, WHITE_LAST], nxt[state, END] = PREFIX, FREE, FREE
    functions = [tuple(nxt[:, s]) for s in range(10)]
    number = {}
    for i, f in enumerate(functions):
        number.setdefault(f, i)
    todo = list(range(10))
    while todo:
        f = functions[todo.pop()]
        for g in functions[:10]:
            h = tuple(g[s] for s in f)
            if h not in number:
                number[h] = len(functions)
                functions.append(h)
                todo.append(number[h])
    identity = tuple(range(8))
    number.setdefault(identity, len(functions))
    functions.append(identity)
    comp = np.array([[number[tuple(g[s] for s in f)] for g in functions] for f in functions], np.uint16)
    return nxt, starts, comp, np.array(functions, np.uint8)


def symbols(cp: np.ndarray) -> np.ndarray:
    """Symbol of every code point; looks two characters ahead."""
    kind = classes()[cp]
    out = kind.copy()
    white = kind == 255
    follow = np.append(kind[1:], END)
    last = white & (follow != 255) & (follow != END)
    space = cp == 0x20
    out[white] = WHITE_IN
    out[last] = WHITE_LAST
    out[white & space] = SPACE_IN
    out[last & space] = SPACE_LAST
    quotes = np.flatnonzero(cp == 0x27)
    if len(quotes):
        ahead = np.concatenate([cp, [SEPARATOR, SEPARATOR]])
        a, b = ahead[quotes + 1], ahead[quotes + 2]
        two = ((a == 0x72) & (b == 0x65)) | ((a == 0x76) & (b == 0x65)) | ((a == 0x6C) & (b == 0x6C))
        one = np.isin(a, [0x73, 0x74, 0x6D, 0x64])
        out[quotes[two]] = QUOTE2
        out[quotes[one]] = QUOTE1
    return out


def token_starts(cp: np.ndarray) -> np.ndarray:
    """Indices where pre-tokens start; SEPARATOR code points start none."""
    n = len(cp)
    if not n:
        return np.zeros(0, np.int64)
    nxt, starts, comp, functions = automaton()
    k = len(functions)
    flat = comp.ravel()
    grid = np.full(-(-n // BLOCK) * BLOCK, k - 1, np.uint16)
    grid[:n] = symbols(cp)
    grid = np.ascontiguousarray(grid.reshape(-1, BLOCK).T)
    whole = grid[0].astype(np.int32)                       # function of each block
    for row in grid[1:]:
        whole = flat[whole * k + row].astype(np.int32)
    step = 1
    while step < len(whole):                               # inclusive scan over blocks
        whole[step:] = flat[whole[:-step] * k + whole[step:]]
        step *= 2
    state = np.full(grid.shape[1], FREE, np.int32)
    state[1:] = functions[whole[:-1], FREE]
    found = np.zeros(grid.shape, bool)
    nxt, starts = np.hstack([nxt, np.arange(8, dtype=np.uint8)[:, None]]).ravel(), np.hstack([starts, np.zeros((8, 1), bool)]).ravel()
    for i, row in enumerate(grid):
        at = state * 11 + np.minimum(row, 10)
        found[i] = starts[at]
        state = nxt[at].astype(np.int32)
    flags = found.T.ravel()[:n]
    flags[cp == SEPARATOR] = False
    return np.flatnonzero(flags)


def pre_tokens(texts: list[str]) -> tuple[bytes, np.ndarray, np.ndarray]:
    """UTF-8 bytes of all texts joined, byte offsets of pre-token starts (the end last), and for
    each text the number of its first pre-token (the total last)."""
    sizes = np.array([len(t) for t in texts], np.int64)
    cp = np.full(int(sizes.sum()) + len(texts), SEPARATOR, np.uint32)
    first = np.concatenate([[0], np.cumsum(sizes + 1)])
    for lo, n, text in zip(first, sizes, texts):
        cp[lo:lo + n] = np.frombuffer(text.encode("utf-32-le"), np.uint32)
    starts = token_starts(cp)
    length = np.where(cp == SEPARATOR, 0, 1 + (cp >= 0x80) + (cp >= 0x800) + (cp >= 0x10000))
    ends = np.concatenate([[0], np.cumsum(length)])
    return "".join(texts).encode(), np.append(ends[starts], ends[-1]), np.searchsorted(starts, first)


def load_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}


def ids_of(piece: bytes, ranks: dict[bytes, int]) -> bytes:
    """Token ids of one pre-token as little-endian 32-bit integers."""
    whole = ranks.get(piece)
    found = [whole] if whole is not None else [ranks[p] for p in merge([piece[i:i + 1] for i in range(len(piece))], ranks)]
    return struct.pack(f"<{len(found)}I", *found)


def encode_texts(texts: list[str], cache: Costs) -> tuple[list[bytes], list[bytes]]:
    """Packed token ids and packed 64-bit byte offsets of the pre-tokens, per text."""
    ids, offsets = [], []
    for lo, hi in common.chunks(texts):
        data, at, first = pre_tokens(texts[lo:hi])
        bounds = at.tolist()
        packed = [cache[data[a:b]] for a, b in zip(bounds, bounds[1:])]
        for a, b in zip(first, first[1:]):
            ids.append(b"".join(packed[a:b]))
            offsets.append((at[a:b] - (at[a] if b > a else 0)).astype("<i8").tobytes())
    return ids, offsets


def _encode(batches, shared, with_offsets, columns):
    cache = Costs({}, partial(ids_of, ranks=shared.value))
    for batch in batches:
        ids, offsets = encode_texts(common.texts_of(batch), cache)
        out = [batch.column(c) for c in columns] + [pa.array(ids, pa.binary())]
        yield pa.RecordBatch.from_arrays(out + [pa.array(offsets, pa.binary())] * with_offsets,
                                         [*columns, "token_ids"] + ["token_offsets"] * with_offsets)


def encode(docs: DataFrame, ranks_path: str, keep: tuple[str, ...] = ("doc_id",), with_offsets: bool = False) -> DataFrame:
    """``keep`` columns and ``token_ids`` (binary: little-endian unsigned 32-bit ids) of every row;
    with offsets also ``token_offsets`` (binary: 64-bit byte offsets of the pre-tokens)."""
    shared = docs.sparkSession.sparkContext.broadcast(load_ranks(ranks_path))       # vocabulary-sized
    kept = docs.select(*keep)
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema) + ", token_ids binary" + ", token_offsets binary" * with_offsets
    return docs.select(*keep, *([] if "text" in keep else ["text"])).transform(
            common.map_arrow,
        partial(_encode, shared=shared, with_offsets=with_offsets, columns=list(keep)), schema)


def decode_ids(ids: np.ndarray, vocabulary: np.ndarray, offsets: np.ndarray) -> bytes:
    """Bytes of the ids: a gather from the joined vocabulary bytes."""
    length = offsets[ids + 1] - offsets[ids]
    ends = np.cumsum(length)
    total = int(ends[-1]) if len(ends) else 0
    return vocabulary[np.arange(total) + np.repeat(offsets[ids] - (ends - length), length)].tobytes()


def _decode(batches, shared, offsets_checked):
    ranks = shared.value
    size = max(ranks.values()) + 1
    by_id: list[bytes] = [b""] * size
    for piece, i in ranks.items():
        by_id[i] = piece
    vocabulary = np.frombuffer(b"".join(by_id), np.uint8)
    offsets = np.concatenate([[0], np.cumsum([len(p) for p in by_id])])
    length = np.diff(offsets)
    for batch in batches:
        out = []
        for row, packed in enumerate(batch.column("token_ids")):
            ids = np.frombuffer(packed.as_buffer() or b"", "<u4").astype(np.int64)
            if len(ids) and int(ids.max()) >= size:
                raise ValueError(f"token id {int(ids.max())} is not in the vocabulary")
            if offsets_checked:
                at = np.frombuffer(batch.column("token_offsets")[row].as_buffer() or b"", "<i8")
                check_offsets(length[ids], at)
            out.append(b"".join(decode_ids(ids[i:i + common.CHUNK_CHARS], vocabulary, offsets)
                                for i in range(0, len(ids), common.CHUNK_CHARS)))
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(out, pa.binary())], [*batch.schema.names, "decoded"])


def check_offsets(lengths: np.ndarray, at: np.ndarray) -> None:
    """Every retained pre-token offset must be where a decoded token begins; else raises."""
    begins = np.cumsum(lengths) - lengths
    place = np.searchsorted(begins, at)
    if len(at) and (place[-1] >= len(begins) or (begins[place] != at).any()):
        raise ValueError("token ids and pre-token offsets do not belong together")


def decode(tokens: DataFrame, ranks_path: str) -> DataFrame:
    """Add ``decoded`` (binary) to rows with ``token_ids``; where ``token_offsets`` were retained
    the decoded tokens are checked against them."""
    shared = tokens.sparkSession.sparkContext.broadcast(load_ranks(ranks_path))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in tokens.schema) + ", decoded binary"
    checked = "token_offsets" in tokens.columns
    return tokens.transform(common.map_arrow, partial(_decode, shared=shared, offsets_checked=checked), schema)


def _round_trip(batches, shared, columns):
    return _decode(_encode(batches, shared, True, columns), shared, True)


def round_trip(docs: DataFrame, ranks_path: str, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``keep`` columns, ``token_ids``, ``token_offsets`` and ``decoded`` of every row: :func:`encode`
    and :func:`decode` in one worker pass, so that a task holds one vocabulary and one batch."""
    shared = docs.sparkSession.sparkContext.broadcast(load_ranks(ranks_path))
    schema = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in docs.select(*keep).schema)
    return docs.select(*dict.fromkeys([*keep, "text"])).transform(
        common.map_arrow, partial(_round_trip, shared=shared, columns=list(keep)),
        schema + "token_ids binary, token_offsets binary, decoded binary")


def token_digests(docs: DataFrame) -> DataFrame:
    import public_tokenizers
    return round_trip(docs, public_tokenizers.path("byte_bpe_multi_50k.tiktoken")).select(
        "doc_id", (F.octet_length("token_ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("token_ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def op8_byte_bpe(spark, sf_dir) -> DataFrame:
    return token_digests(common.documents(spark, sf_dir))


QUERIES = {"op8_byte_bpe": op8_byte_bpe}
ORACLES: dict[str, str] = {}
