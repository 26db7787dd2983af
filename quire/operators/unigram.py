"""A byte-unigram language model fitted by Spark — the stand-in scorer.

The evaluation operators consume ``token_scores``; a real deployment plugs its own
model in through ``scoring.score``. For the driver's tables we need a model whose
scores come from the data itself: per model (= corpus source), the smoothed
frequency of each byte-tokenizer id. Log-probs are quantized to multiples of 2^-20
so sums are exact in double precision and independent of summation order.

Counting is pre-aggregated inside each task (a 260-bin histogram per source and
Arrow batch) before the shuffle, so the shuffle carries at most 260 rows per source
per batch regardless of corpus size.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quire.config import BOS_ID, EOS_ID
from quire.functions.tokenizers import BYTE_OFFSET, _as_plain_binary

VOCAB = 256 + BYTE_OFFSET
QUANT = float(2**20)


def _histograms(batches):
    """Arrow batches of ``(model, text)`` → one row per (model, id) with its count in
    the batch. Works on the raw UTF-8 buffers: no per-row Python."""
    for rb in batches:
        models = rb.column(0)
        texts = rb.column(1)
        out_m, out_t, out_c = [], [], []
        for m in pc.unique(models).to_pylist():
            if m is None:
                continue
            sub = _as_plain_binary(pc.filter(texts, pc.equal(models, m)))
            offsets = np.frombuffer(sub.buffers()[1], dtype=np.int64, count=len(sub) + 1)
            data = sub.buffers()[2]
            n_bytes = int(offsets[-1])
            counts = np.zeros(VOCAB, dtype=np.int64)
            if n_bytes:
                counts[BYTE_OFFSET:] = np.bincount(np.frombuffer(data, dtype=np.uint8, count=n_bytes), minlength=256)
            n_docs = len(sub) - sub.null_count
            counts[BOS_ID] += n_docs
            counts[EOS_ID] += n_docs
            nz = np.nonzero(counts)[0]
            out_m.extend([m] * len(nz))
            out_t.append(nz.astype(np.int32))
            out_c.append(counts[nz])
        yield pa.RecordBatch.from_arrays(
            [pa.array(out_m, pa.string()),
             pa.array(np.concatenate(out_t) if out_t else np.zeros(0, np.int32), pa.int32()),
             pa.array(np.concatenate(out_c) if out_c else np.zeros(0, np.int64), pa.int64())],
            names=["model", "token_id", "count"],
        )


def token_counts(docs: DataFrame, model_col: str = "source", text_col: str = "text") -> DataFrame:
    """``model, token_id, count`` for the byte tokenizer with the ``<bos> … <eos>``
    template, pre-aggregated per task."""
    src = docs.select(F.col(model_col).alias("model"), F.col(text_col).alias("text"))
    partial = src.mapInArrow(_histograms, "model string, token_id int, count long")
    return partial.groupBy("model", "token_id").agg(F.sum("count").alias("count"))


def quantize(x: Column) -> Column:
    return F.round(x * F.lit(QUANT)) / F.lit(QUANT)


def fit_unigram(docs: DataFrame, model_col: str = "source", text_col: str = "text") -> DataFrame:
    """``model, token_id, logprob`` for every id of the byte vocabulary (add-one
    smoothing), one row per (model, id): 260 rows per model."""
    counts = token_counts(docs, model_col, text_col)
    models = counts.groupBy("model").agg(F.sum("count").alias("total"))
    grid = models.select("model", "total", F.explode(F.sequence(F.lit(0), F.lit(VOCAB - 1))).alias("token_id"))
    full = grid.join(counts, ["model", "token_id"], "left").fillna(0, ["count"])
    lp = F.log((F.col("count") + F.lit(1)).cast("double") / (F.col("total") + F.lit(VOCAB)).cast("double"))
    return full.select("model", "token_id", quantize(lp).alias("logprob"))


def score_tokens(tokens: DataFrame, lm: DataFrame) -> DataFrame:
    """Attach ``logprob`` to token rows ``(model, token_id, …)``. The model table is
    260 rows per model — bounded by the number of models — so it is broadcast."""
    return tokens.join(F.broadcast(lm), ["model", "token_id"], "left")
