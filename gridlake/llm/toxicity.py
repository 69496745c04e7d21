"""Toxicity: FTRL-proximal logistic regression over hashed n-grams.

Features are binary: word 1-, 2- and 3-grams and skip-grams (two words
with one or two words between), lower-cased, split at everything that is
not a letter, digit or non-ASCII byte, hashed into 2**22 places.  FTRL
keeps a rate per coordinate and an L1 penalty, so most weights are exactly
zero and the model is small enough to broadcast (at most 2**22 entries,
whatever the corpus).

Training reads a bounded sample of the labelled rows (about
``max_rows`` / 2 of each class, chosen by a hash of the id), cut into
shards; each shard is trained by one task, which holds the features of its
rows but one batch of texts only, and the shards' weights are averaged in
Spark.  Scoring reads every text whole.

Edge cases: null or empty texts get the intercept's score; labels that are
null are not used; several labels for one id count as their maximum;
without any training rows the score is 0; repeated rows are scored one by
one; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridlake.llm import words as W
from gridlake.llm.memory import give_back, giving_back, small_batches
from gridlake.llm.staging import stage, uniform01

BITS = 22
PART = 1 << 18          # places whose weights are computed in one step
SEPARATORS = np.array([b < 128 and not chr(b).isalnum() for b in range(256)])
INTERCEPT = -1


def ngram_places(w: W.Words) -> list[tuple[np.ndarray, np.ndarray]]:
    """(place, valid) per feature family, aligned with the words."""
    out = []
    ends = np.repeat(w.offsets[1:], w.counts)
    for k in (1, 2, 3):
        h, valid = W.runs(w, k, seed=k)
        out.append((h, valid))
    n = len(w.hashes)
    for gap in (2, 3):
        h = np.zeros(n, dtype=np.uint64)
        m = max(n - gap, 0)
        h[:m] = W.mix64(w.hashes[:m] * np.uint64(0x9FB21C651E98DF25) + w.hashes[gap:gap + m] + np.uint64(gap))
        out.append((h, np.arange(n) + gap < ends))
    return [((h >> np.uint64(64 - BITS)).astype(np.int32), valid) for h, valid in out]


def features(texts: pa.Array) -> list[np.ndarray]:
    """Distinct feature places of each text (views of one array per slice of
    texts: many small arrays would not be given back to the system)."""
    out: list[np.ndarray] = []
    for a, m in W.text_slices(texts):
        w = W.words(texts.slice(a, m), lower=True, separators=SEPARATORS)
        families = ngram_places(w)
        found = []
        for i in range(m):
            part = slice(w.offsets[i], w.offsets[i + 1])
            found.append(np.unique(np.concatenate([p[part][v[part]] for p, v in families])))
        out += np.split(np.concatenate(found), np.cumsum([len(f) for f in found])[:-1])
    return out


def ftrl(rows: list[np.ndarray], labels: np.ndarray, epochs: int, alpha: float, beta: float, l1: float,
         l2: float, min_rows: int, order: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, float]:
    """FTRL-proximal over binary rows: (places, weights, intercept).

    Places that fewer than ``min_rows`` rows hold are left out.  The
    intercept is one more place, without the L1 penalty.  ``order``: row
    numbers in the order of training.  ``rows`` is used up, so that a shard's
    features are held once.
    """
    size = (1 << BITS) + 1
    held = np.zeros(size, dtype=np.int32)
    for r in rows:
        held[r] += 1                                # places are distinct within a row
    last = np.array([size - 1], dtype=np.int32)
    for i, r in enumerate(rows):
        rows[i] = np.concatenate([r[held[r] >= min_rows], last])
    del held
    z, n = np.zeros(size), np.zeros(size)

    def weights(at: np.ndarray) -> np.ndarray:
        za = z[at]
        shrunk = np.sign(za) * np.maximum(np.abs(za) - np.where(at == size - 1, 0.0, l1), 0)
        return -shrunk / ((beta + np.sqrt(n[at])) / alpha + l2)

    for _ in range(epochs):
        for i in range(len(rows)) if order is None else order:
            at = rows[i]
            w = weights(at)
            g = 1.0 / (1.0 + np.exp(-np.clip(w.sum(), -35, 35))) - labels[i]
            old = n[at]
            new = old + g * g
            z[at] += g - (np.sqrt(new) - np.sqrt(old)) / alpha * w
            n[at] = new
    rows.clear()
    places, values = [], []
    for a in range(0, size - 1, PART):
        at = a + np.flatnonzero(z[a:min(a + PART, size - 1)])
        w = weights(at)
        places.append(at[w != 0])
        values.append(w[w != 0])
    return np.concatenate(places), np.concatenate(values), float(weights(last)[0]) if z[size - 1] else 0.0


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          label_col: str = "toxic", max_rows: int = 40_000, shard_rows: int = 12_000, shard_bytes: int = 64 << 20,
          epochs: int = 8, alpha: float = 5.0, beta: float = 1.0, l1: float = 4.0, l2: float = 1e-3,
          min_rows: int = 2) -> DataFrame:
    """The model as (place, weight); place -1 is the intercept.

    ``labels``: (id_col, label_col) rows that may be learned from.
    ``max_rows``: documented bound on the labelled sample.
    """
    known = labels.select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("y")) \
        .filter("y in (0, 1)").groupBy("id").agg(F.max("y").alias("y"))
    totals = {r["y"]: r["n"] for r in known.groupBy("y").agg(F.count(F.lit(1)).alias("n")).collect()}
    share = F.when(F.col("y") == 1, F.lit(max_rows / 2 / max(totals.get(1, 0), 1))) \
        .otherwise(F.lit(max_rows / 2 / max(totals.get(0, 0), 1)))
    picked = known.filter(uniform01(F.col("id"), salt=17) <= share)      # bounded by max_rows: may be broadcast
    sample = stage(docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
                   .join(F.broadcast(picked), "id"), "toxicity-sample")
    size = sample.agg(F.count(F.lit(1)).alias("n"), F.sum(F.octet_length("text")).alias("b")).first()
    shards = max(1, -(-size["n"] // shard_rows), -(-(size["b"] or 0) // shard_bytes))

    def model_of(batches: Iterator[pa.RecordBatch]) -> pa.RecordBatch:
        rows, parts = [], []
        for batch in batches:
            rows += features(batch.column("text"))
            parts.append(batch.select(["order", "id", "y"]).take(np.arange(len(batch))))    # a copy: the batch may go
        del batch
        known = pa.Table.from_batches(parts)
        order = pc.sort_indices(known, sort_keys=[("order", "ascending"), ("id", "ascending")]).to_numpy()
        y = known["y"].to_numpy().astype(float)
        at, w, intercept = ftrl(rows, y, epochs, alpha, beta, l1, l2, min_rows, order)
        return pa.RecordBatch.from_arrays([pa.array(np.append(at, INTERCEPT), pa.int64()),
                                           pa.array(np.append(w, intercept), pa.float64())], names=["place", "weight"])

    def fit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = model_of(batches)
        give_back()
        yield model

    trained = small_batches(sample).withColumn("order", uniform01(F.col("id"), salt=23)) \
        .withColumn("shard", F.floor(uniform01(F.col("id"), salt=29) * F.lit(shards) * F.lit(0.999999))) \
        .groupBy("shard").applyInArrow(fit, "place long, weight double")
    return stage(trained.groupBy("place").agg((F.sum("weight") / F.lit(float(shards))).alias("weight")),
                 "toxicity-model")


def scorer(model: DataFrame):
    """Column function text -> score in [0, 1] for a trained model."""
    rows = model.toPandas()                      # at most 2**BITS + 1 rows, mostly far fewer (L1)
    sc = model.sparkSession.sparkContext
    inner = rows[rows.place >= 0]
    shared = sc.broadcast((inner.place.to_numpy(np.int64), inner.weight.to_numpy(np.float32),
                           float(rows.weight[rows.place == INTERCEPT].sum()), len(rows) > 0))

    def scores(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        places, weights, intercept, trained = shared.value
        dense = np.zeros(1 << BITS, dtype=np.float32)
        dense[places] = weights
        for texts in batches:
            values = score_texts(texts, dense, intercept)
            yield pa.array(values if trained else np.zeros(len(texts)), pa.float64())

    def score_texts(texts: pa.Array, dense: np.ndarray, intercept: float) -> np.ndarray:
        out = []
        for a, m in W.text_slices(texts):
            w = W.words(texts.slice(a, m), lower=True, separators=SEPARATORS)
            owner, hit = [], []
            of_word = np.repeat(np.arange(m), w.counts)
            for place, valid in ngram_places(w):
                at = np.flatnonzero(valid & (dense[place] != 0))
                owner.append(of_word[at])
                hit.append(place[at])
            # each feature counts once per text
            pair = np.unique((np.concatenate(owner).astype(np.int64) << BITS) | np.concatenate(hit))
            margin = intercept + np.bincount(pair >> BITS, dense[pair & ((1 << BITS) - 1)], minlength=m)
            out.append(1.0 / (1.0 + np.exp(-np.clip(margin, -35, 35))))
        return np.concatenate(out) if out else np.zeros(0)

    @F.arrow_udf("double")
    def score(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        return giving_back(scores)(batches)

    return score


def score_documents(docs: DataFrame, model: DataFrame, text_col: str = "text", out_col: str = "score") -> DataFrame:
    """``docs`` with the score as ``out_col``; every other column is kept."""
    return small_batches(docs).withColumn(out_col, scorer(model)(F.col(text_col)))
