"""Token counts with a whole-token shortcut (operator 5).

The piece vocabulary merges never cross from a non-space character to a space mark (proved once
on the driver: no piece holds a mark after another character), so a text falls apart into
pre-tokens, each a run of marks and the characters up to the next mark.  Offline, every
vocabulary string that is such a pre-token is merged alone; those that come out as one piece are
the proved whole tokens.  Documents then count proved pre-tokens by one lookup and merge only the
rest, with a bounded cache.

Defined results: null and empty texts have no tokens; a lone space counts as the library counts
it; special strings inside texts are ordinary text; repeated rows are kept.
"""

from __future__ import annotations

import re
from functools import partial

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedlens.llm import common
from feedlens.llm.bpe_merge import Costs, merge

MARK = "▁"
LIMIT = 4096
_SEGMENT = re.compile(f"{MARK}+[^{MARK}]*")


def load_ranks(path: str) -> dict[str, int]:
    """Merge ranks of the ordinary pieces of a sentencepiece model (higher score: earlier)."""
    import sentencepiece
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    pieces = [(-model.GetScore(i), model.IdToPiece(i)) for i in range(model.GetPieceSize())
              if not (model.IsControl(i) or model.IsUnknown(i) or model.IsByte(i) or model.IsUnused(i))]
    return {p: r for r, (_, p) in enumerate(sorted(pieces))}


def prove_whole(ranks: dict[str, int]) -> dict[str, int]:
    """Pre-tokens of the vocabulary that merge into one piece, each with its count 1.

    Raises where a piece would join two pre-tokens, as the split would then not be sound."""
    crossing = [p for p in ranks if re.search(f"[^{MARK}]{MARK}", p)]
    if crossing:
        raise ValueError(f"pieces cross pre-tokens: {crossing[:5]}")
    return {p: 1 for p in ranks if p.startswith(MARK) and merge(list(p), ranks) == [p]}


def cost(segment: str, ranks: dict[str, int]) -> int:
    """Tokens of one pre-token: merged pieces; characters outside the vocabulary as bytes."""
    return sum(1 if p in ranks else len(p.encode()) for p in merge(list(segment), ranks))


def count_tokens(text: str, costs: Costs) -> int:
    if not text:
        return 0
    return sum(map(costs.__getitem__, _SEGMENT.findall(MARK + text.replace(" ", MARK))))


def _count(batches, shared):
    ranks, whole = shared.value
    costs = Costs(whole, partial(cost, ranks=ranks), most=64 << 20)
    for batch in batches:
        texts = common.texts_of(batch)
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.array([len(t.encode()) for t in texts], pa.int64()),
             pa.array([count_tokens(t, costs) for t in texts], pa.int64())], ["doc_id", "n_bytes", "n_tokens"])


def token_counts(docs: DataFrame, model_path: str, limit: int = LIMIT) -> DataFrame:
    """doc_id, n_bytes, n_tokens and over_limit (n_tokens > limit) of every row."""
    ranks = load_ranks(model_path)
    shared = docs.sparkSession.sparkContext.broadcast((ranks, prove_whole(ranks)))   # vocabulary-sized
    counted = (docs.select("doc_id", "text")
               .transform(common.map_arrow, partial(_count, shared=shared), "doc_id bigint, n_bytes bigint, n_tokens bigint"))
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)


def op5_token_counts(spark, sf_dir) -> DataFrame:
    import public_tokenizers
    return token_counts(common.documents(spark, sf_dir), public_tokenizers.path("piece_bpe_32k.model"))


QUERIES = {"op5_token_counts": op5_token_counts}
ORACLES: dict[str, str] = {}
