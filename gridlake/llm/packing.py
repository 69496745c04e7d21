"""Best-fit packing by a length-histogram plan.

Documents become token pieces of at most ``capacity`` tokens.  The plan
works on the histogram of piece lengths alone (at most ``capacity``
entries, whatever the corpus): best-fit decreasing over counts, placing
whole runs of equal pieces into whole runs of equally full sequences.
Pieces then take the planned slots by their rank within their length.

Scale: the driver sees ``capacity`` counts and gives back a plan whose
size depends on ``capacity``, not on the rows, so broadcasting it is
bounded.  Ranks are row numbers inside (length, slice) plus the slice's
offset; a length that a third of all pieces share is cut into many slices.

Edge cases: a null text is the empty text (one piece: the end id); null
ids stay null; repeated rows are packed one by one; an empty table gives
an empty result; other columns of the input are ignored.
"""

from __future__ import annotations

import json
import zlib
from bisect import bisect_left, insort
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gridlake.llm.memory import giving_back, small_batches
from gridlake.llm.staging import slice_rows, stage

CAPACITY = 2048
END_ID = 0


def _byte_of_char() -> dict[str, int]:
    """The printable stand-ins of byte-level vocabularies: bytes that are
    visible Latin-1 characters stand for themselves, the others follow from
    code point 256 on, in order."""
    visible = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in set(visible)]
    return {chr(b): b for b in visible} | {chr(256 + i): b for i, b in enumerate(hidden)}


@lru_cache(maxsize=2)
def encoder(path: str):
    """text -> uint32 ids of the byte-level BPE vocabulary file at ``path``.

    The ids equal those of the ``tokenizers`` library on that file (a test
    holds them against each other), added tokens in the text included: the
    text is split at them and each becomes its own id.  ``tiktoken`` merges
    several times faster.  A text that its pattern engine gives up on
    (millions of equal characters), or that holds an added token which the
    file lets take in white space, goes through ``tokenizers`` itself.
    """
    import os
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    import tiktoken
    from public_tokenizers import PATTERN
    from tokenizers import Tokenizer

    with open(path, encoding="utf-8") as f:
        described = json.load(f)
    vocab, added = described["model"]["vocab"], described.get("added_tokens") or []
    byte = _byte_of_char()
    names = {t["content"]: t["id"] for t in added}
    ranks = {bytes(byte[c] for c in piece): i for piece, i in vocab.items() if piece not in names and all(c in byte for c in piece)}
    odd = [t["content"] for t in added if t.get("lstrip") or t.get("rstrip") or t.get("single_word")]
    fast = tiktoken.Encoding("pieces", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens=names)
    exact = Tokenizer.from_file(path)

    def encode(text: str) -> np.ndarray:
        if not any(o in text for o in odd):
            try:
                return fast.encode_to_numpy(text, allowed_special="all").astype("<u4")
            except Exception:  # the pattern engine's stack limit
                pass
        return np.array(exact.encode(text, add_special_tokens=False).ids, dtype="<u4")

    return encode


PIECE_SCHEMA = "id long, piece int, start long, length long, ids_crc32 long"


def cut(n: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of ``n`` tokens: full ones at the end,
    the first one may be shorter."""
    first = n % capacity or capacity
    starts = [0, *range(first, n, capacity)]
    return [(a, (starts[i + 1] if i + 1 < len(starts) else n) - a) for i, a in enumerate(starts)]


def token_pieces(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text",
                 capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """Pieces of each document: ids of the text, then ``end_id``."""

    def over(batches):
        encode = encoder(tokenizer)
        for batch in batches:
            ids, piece, start, length, crc = [], [], [], [], []
            for ident, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                tokens = np.append(encode(text.as_py() or ""), np.uint32(end_id)).astype("<u4")
                for i, (a, n) in enumerate(cut(len(tokens), capacity)):
                    ids.append(ident)
                    piece.append(i)
                    start.append(a)
                    length.append(n)
                    crc.append(zlib.crc32(tokens[a:a + n].tobytes()))
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array(piece, pa.int32()), pa.array(start, pa.int64()),
                 pa.array(length, pa.int64()), pa.array(crc, pa.int64())],
                names=["id", "piece", "start", "length", "ids_crc32"])

    return small_batches(docs).select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text")) \
        .mapInArrow(giving_back(over), PIECE_SCHEMA)


def plan_best_fit(histogram: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, int, int, int]]:
    """Best-fit decreasing over counts: (length, first rank, first sequence,
    offset) segments, each holding up to the length's next first rank.

    Sequences with equal room are kept as runs of consecutive numbers; one
    step fills a whole run with as many pieces of one length as fit.
    """
    room: dict[int, list[list[int]]] = {}      # room -> runs [first sequence, count]
    rooms: list[int] = []                      # sorted keys of ``room``
    plan: list[tuple[int, int, int, int]] = []
    sequences = 0

    def put(left: int, first: int, count: int) -> None:
        if left <= 0 or count <= 0:
            return
        if left not in room:
            room[left] = []
            insort(rooms, left)
        room[left].append([first, count])

    for length in sorted((n for n, c in histogram.items() if c > 0), reverse=True):
        count, rank = histogram[length], 0
        while count:
            at = bisect_left(rooms, length)
            if at < len(rooms):
                left = rooms[at]
                first, size = room[left].pop()
                if not room[left]:
                    del room[left]
                    rooms.pop(at)
            else:
                left, first, size = capacity, sequences, -(-count // (capacity // length))
                sequences += size
            each = left // length
            full = min(size, count // each)
            for slot in range(each if full else 0):
                plan.append((length, rank, first, capacity - left + slot * length))
                rank += full
            put(left - each * length, first, full)
            count -= full * each
            if full < size:                      # the next sequence of the run takes what remains, if anything
                some = min(count, each)
                for slot in range(some):
                    plan.append((length, rank, first + full, capacity - left + slot * length))
                    rank += 1
                count -= some
                if some:
                    put(left - some * length, first + full, 1)
                    put(left, first + full + 1, size - full - 1)
                else:
                    put(left, first + full, size - full)
    return plan


def pack(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """``pieces`` (id, piece, length, ...) with sequence_id and offset."""
    pieces = stage(pieces, "pieces")
    spark = pieces.sparkSession
    # at most ``capacity`` rows: the one thing that comes to the driver
    histogram = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    segments: dict[int, list[tuple[int, int, int]]] = {}
    for length, rank, sequence, offset in plan_best_fit(histogram, capacity):
        segments.setdefault(length, []).append((rank, sequence, offset))
    rows = slice_rows(spark, sum(histogram.values()))
    plan = spark.createDataFrame(
        [(n, -(-c // rows), segments[n]) for n, c in sorted(histogram.items())],
        "length long, slices long, segments array<struct<rank:long,sequence:long,offset:long>>")
    cut_up = pieces.join(F.broadcast(plan.select("length", "slices")), "length") \
        .withColumn("slice", F.pmod(F.xxhash64("id", "piece"), F.col("slices")))
    counts = cut_up.groupBy("length", "slice").agg(F.count(F.lit(1)).alias("n"))
    earlier = Window.partitionBy("length").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("length", "slice", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    order = Window.partitionBy("length", "slice").orderBy(F.col("id").asc_nulls_first(), "piece", "start")
    ranked = cut_up.withColumn("inside", F.row_number().over(order) - 1) \
        .join(offsets, ["length", "slice"]) \
        .withColumn("rank", F.col("before") + F.col("inside"))
    segment = F.expr("element_at(filter(segments, s -> s.rank <= rank), -1)")
    return ranked.join(F.broadcast(plan.select("length", "segments")), "length") \
        .withColumn("segment", segment) \
        .select(*pieces.columns,
                (F.col("segment.sequence") + F.col("rank") - F.col("segment.rank")).alias("sequence_id"),
                F.col("segment.offset").alias("offset"))


def pack_documents(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text",
                   capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """id, piece, start, length, ids_crc32, sequence_id, offset per piece."""
    return pack(token_pieces(docs, tokenizer, id_col, text_col, capacity, end_id), capacity)
