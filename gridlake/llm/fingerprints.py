"""Document fingerprints: threshold-scaled sketches of word shingles.

A sketch keeps every 5-word shingle hash below a fixed fraction of the
hash range, whatever the text's length; so sketches of very unequal texts
can be compared by containment, and the sketch of a union is the union of
the sketches.  A text's smallest hash is kept even if it lies above the
threshold, so that only texts without words have an empty sketch (a merge
drops it again if the union has a smaller one above the threshold).  Only
hashes below the threshold are compared: a longer text never keeps the
other one.  The fraction is a half: of a text with s shingles none lies
below the threshold with chance 2^-s, and a containment c is estimated with
standard error sqrt(c (1 - c) / s) at most.  Likeness is that of the two
sketches and of nothing else: 1 if they are equal, else 0 where one of them
has no hash below the threshold.

A fingerprint is the base64 text of the kept hashes (their first 48 bits,
ascending).  Words are compared with A-Z as a-z; a text with fewer than
five words is one shingle.

Pairing each document with the next one by id needs one shuffle of the
texts: ids are cut at percentiles into buckets, and the first rows of a
bucket are sent along to the bucket before (the very first row to the last
one), so every task finds its next documents locally.

Edge cases: a null text is empty (empty sketch; two empty sketches have
likeness 1, an empty and another 0); null ids come before all others;
rows with equal ids are ordered by their text, rows that are equal in both
are each other's next; a single document is its own next; an empty table
gives an empty result; other columns of the input are ignored.
"""

from __future__ import annotations

import base64
import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridlake.llm import words as W
from gridlake.llm.staging import shuffle_partitions

SHINGLE = 5
FRACTION = 1 / 2
LEAST_ID = -(1 << 63)
BUCKET_BYTES = 32 << 20     # texts of a bucket, on average


def sketch(shingles: np.ndarray, fraction: float = FRACTION) -> np.ndarray:
    """Kept hashes (first 48 bits, ascending) of sorted shingle hashes."""
    if not len(shingles):
        return shingles
    kept = int(np.searchsorted(shingles, np.uint64(int(fraction * 2.0**64))))
    return np.unique(shingles[:max(kept, 1)] >> np.uint64(16))


def merge(sketches: list[np.ndarray], fraction: float = FRACTION) -> np.ndarray:
    """Sketch of the union of texts (exactly the sketch of all shingles)."""
    return sketch(np.unique(np.concatenate(sketches)) << np.uint64(16), fraction)


def encode(kept: np.ndarray) -> str:
    raw = kept.astype(">u8").view(np.uint8).reshape(-1, 8)[:, 2:]
    return base64.b64encode(raw.tobytes()).decode()


def decode(fingerprint: str) -> np.ndarray:
    raw = np.frombuffer(base64.b64decode(fingerprint), dtype=np.uint8).reshape(-1, 6)
    full = np.zeros((len(raw), 8), dtype=np.uint8)
    full[:, 2:] = raw
    return full.reshape(-1).view(">u8").astype(np.uint64)


def below(kept: np.ndarray, fraction: float = FRACTION) -> np.ndarray:
    """The hashes of a sketch that lie below the threshold."""
    return kept[:int(np.searchsorted(kept, np.uint64((int(fraction * 2.0**64) - 1) >> 16), side="right"))]


def share(a: np.ndarray, b: np.ndarray) -> float:
    """Share of the smaller array of distinct hashes that the other one holds."""
    return len(np.intersect1d(a, b, assume_unique=True)) / min(len(a), len(b))


def containment(a: np.ndarray, b: np.ndarray, fraction: float = FRACTION) -> float:
    """Likeness of two sketches: the share of the smaller one's hashes below
    the threshold that the other one holds; 1 if they are equal, else 0 where
    one has no such hash."""
    if np.array_equal(a, b):
        return 1.0
    low, other = below(a, fraction), below(b, fraction)
    return share(low, other) if len(low) and len(other) else 0.0


def sketches(texts: pa.Array, fraction: float = FRACTION) -> list[np.ndarray]:
    """Sketch of each text."""
    out: list[np.ndarray] = []
    for a, m in W.text_slices(texts):
        out += [sketch(s, fraction) for s in W.shingle_sets(W.words(texts.slice(a, m), lower=True), SHINGLE)]
    return out


def with_next(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(bucket, guard, key, id, text), dealt by bucket and sorted; the row
    after a document in its bucket is the next document by id.  Guard rows
    are copies of the following bucket's first rows."""
    spark = docs.sparkSession
    base = docs.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text")) \
        .withColumn("key", F.coalesce("id", F.lit(LEAST_ID)))
    size = base.agg(F.sum(F.octet_length("text")).alias("b")).first()["b"] or 0
    buckets = max(shuffle_partitions(spark), -(-size // BUCKET_BYTES))
    cuts = base.agg(F.percentile_approx("key", [i / buckets for i in range(buckets)], 100 * buckets).alias("c"),
                    F.min("key").alias("m")).first()
    bounds = np.unique(np.array([cuts["m"], *cuts["c"]] if cuts["c"] else [0], dtype=np.int64))

    @F.arrow_udf("array<struct<bucket:int,guard:boolean>>")
    def place(keys: pa.Array) -> pa.Array:
        key = keys.to_numpy(zero_copy_only=False)
        own = np.searchsorted(bounds, key, side="right") - 1
        out = []
        for b, first in zip(own.tolist(), (bounds[own] == key).tolist()):
            spots = [{"bucket": b, "guard": False}]
            if first:
                spots.append({"bucket": (b - 1) % len(bounds), "guard": True})
            out.append(spots)
        return pa.array(out, pa.list_(pa.struct([("bucket", pa.int32()), ("guard", pa.bool_())])))

    return base.withColumn("spot", F.explode(place("key"))) \
        .select("spot.bucket", "spot.guard", "key", "id", "text") \
        .repartition(buckets, "bucket") \
        .sortWithinPartitions("bucket", "guard", "key", "text")


OUT_SCHEMA = ("id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string,"
              " near_edited double, near_next double, n_kept long")


def edited_text(text: str, following: str) -> str:
    """The last half of ``text`` replaced by the start of ``following``."""
    half = len(text) // 2
    return text[:len(text) - half] + following[:half]


def fingerprint_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                          fraction: float = FRACTION) -> DataFrame:
    """One row per document: id, n_chars, fingerprint, and beside it the
    fingerprint of its edited text and the likeness (containment) to that
    and to the next document."""

    def answer(rows):
        """rows: (bucket, guard, id, text); each but the last is followed by its next."""
        if len(rows) < 2:
            return None
        texts = [r[3] for r in rows]
        pairs = [i for i in range(len(rows) - 1) if not rows[i][1] and rows[i][0] == rows[i + 1][0]]
        edited = [edited_text(texts[i], texts[i + 1]) for i in pairs]
        own, changed = sketches(pa.array(texts, pa.string()), fraction), sketches(pa.array(edited, pa.string()), fraction)
        return pa.RecordBatch.from_arrays([
            pa.array([rows[i][2] for i in pairs], pa.int64()),
            pa.array([len(texts[i]) for i in pairs], pa.int64()),
            pa.array([hashlib.sha256(e.encode()).hexdigest() for e in edited], pa.string()),
            pa.array([encode(own[i]) for i in pairs], pa.string()),
            pa.array([encode(c) for c in changed], pa.string()),
            pa.array([containment(own[i], c, fraction) for i, c in zip(pairs, changed)], pa.float64()),
            pa.array([containment(own[i], own[i + 1], fraction) for i in pairs], pa.float64()),
            pa.array([len(own[i]) for i in pairs], pa.int64()),
        ], names=["id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next",
                  "n_kept"])

    def over(batches):
        held = []
        for batch in batches:
            for a, m in W.text_slices(batch.column(4)):
                part = batch.slice(a, m)
                rows = held + list(zip(part.column(0).to_pylist(), part.column(1).to_pylist(),
                                       part.column(3).to_pylist(), part.column(4).to_pylist()))
                held = rows[-1:]
                done = answer(rows)
                if done is not None and done.num_rows:
                    yield done

    return with_next(docs, id_col, text_col).mapInArrow(over, OUT_SCHEMA)
