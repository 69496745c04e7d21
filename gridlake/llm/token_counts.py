"""Token counts: linear longest-match word-piece lengths.

A trie of the vocabulary carries failure links and, per node, the number
of pieces that the greedy longest match has fixed when it falls back from
there.  A word's piece count is then one pass over its bytes: no piece is
ever built, and no byte is looked at twice.

Words are runs without white space; each is prefixed by the vocabulary's
word mark (a space for byte-level vocabularies).  A word that cannot be
cut into pieces counts as one unknown piece.

Edge cases: null or empty texts have 0 words and 0 pieces; words of any
length take linear time; null ids stay null; repeated rows are counted
one by one; an empty table gives an empty result; other columns of the
input are ignored.
"""

from __future__ import annotations

import json
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridlake.llm import words as W
from gridlake.llm.packing import _byte_of_char


class PieceCounter:
    """Longest-match automaton over byte pieces."""

    def __init__(self, pieces, mark: bytes = b""):
        edges: dict[int, int] = {}            # node * 256 + byte -> node
        parent, label, final = [0], [0], [False]
        for piece in pieces:
            node = 0
            for byte in piece:
                key = node << 8 | byte
                nxt = edges.get(key)
                if nxt is None:
                    nxt = edges[key] = len(parent)
                    parent.append(node)
                    label.append(byte)
                    final.append(False)
                node = nxt
            final[node] = bool(piece)
        depth = [0] * len(parent)
        for v in range(1, len(parent)):        # a parent is always numbered before its children
            depth[v] = depth[parent[v]] + 1
        fail, popped = [-1] * len(parent), [0] * len(parent)
        for v in sorted(range(1, len(parent)), key=depth.__getitem__):
            if final[v]:
                fail[v], popped[v] = 0, 1
                continue
            pops, z = popped[parent[v]], fail[parent[v]]
            while z >= 0 and (z << 8 | label[v]) not in edges:
                pops += popped[z]
                z = fail[z]
            if z >= 0:
                fail[v], popped[v] = edges[z << 8 | label[v]], pops
        self.edges, self.fail, self.popped = edges, fail, popped
        self.start, self.prefix = self._run(mark, 0, 0)

    def _run(self, data: bytes, node: int, count: int) -> tuple[int, int]:
        edges, fail, popped = self.edges, self.fail, self.popped
        for byte in data:
            nxt = edges.get(node << 8 | byte)
            while nxt is None:
                if fail[node] < 0:
                    return -1, 0
                count += popped[node]
                node = fail[node]
                nxt = edges.get(node << 8 | byte)
            node = nxt
        return node, count

    def count(self, word: bytes) -> int:
        """Pieces of the marked word; 0 if it cannot be cut into pieces."""
        if self.start < 0:
            return 0
        node, count = self._run(word, self.start, self.prefix)
        while node > 0:
            if self.fail[node] < 0:
                return 0
            count += self.popped[node]
            node = self.fail[node]
        return count if node == 0 else 0


def byte_level_pieces(path: str) -> list[bytes]:
    """Pieces of a byte-level vocabulary file as plain bytes."""
    with open(path, encoding="utf-8") as f:
        vocab = json.load(f)["model"]["vocab"]
    byte = _byte_of_char()
    return [bytes(byte[c] for c in p) for p in vocab
            if all(c in byte for c in p) and not (p.startswith("<|") and p.endswith("|>"))]


@lru_cache(maxsize=2)
def counter(path: str) -> PieceCounter:
    return PieceCounter(byte_level_pieces(path), mark=b" ")


CACHE_WORDS = 1 << 19
COUNT_SCHEMA = "id long, n_words long, n_pieces long, n_unknown long"


def count_column(texts: pa.Array, pieces: PieceCounter, cache: dict[int, int]) -> tuple[list, list, list]:
    """(words, pieces, unknown words) of each text; ``cache`` maps a word's
    hash to its count (cleared when full: memory stays bounded)."""
    n_words, n_pieces, n_unknown = [], [], []
    for a, m in W.text_slices(texts):
        w = W.words(texts.slice(a, m))
        distinct, first, back = np.unique(w.hashes, return_index=True, return_inverse=True)
        counts = np.empty(len(distinct), dtype=np.int64)
        raw = w.raw.tobytes()
        for i, (h, at) in enumerate(zip(distinct.tolist(), first.tolist())):
            n = cache.get(h)
            if n is None:
                if len(cache) >= CACHE_WORDS:
                    cache.clear()
                start = int(w.starts[at])
                n = cache[h] = pieces.count(raw[start:start + int(w.lengths[at])])
            counts[i] = n
        per_word = counts[back]
        sums = np.concatenate([[0], np.cumsum(np.maximum(per_word, 1))])
        lost = np.concatenate([[0], np.cumsum(per_word == 0)])
        n_words += w.counts.tolist()
        n_pieces += np.diff(sums[w.offsets]).tolist()
        n_unknown += np.diff(lost[w.offsets]).tolist()
    return n_words, n_pieces, n_unknown


def token_counts(docs: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_words, n_pieces, n_unknown) per document, by the byte-level
    vocabulary file at ``vocabulary`` (the same path on every worker)."""

    def over(batches):
        pieces, cache = counter(vocabulary), {}
        for batch in batches:
            n_words, n_pieces, n_unknown = count_column(batch.column(1), pieces, cache)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n_words, pa.int64()), pa.array(n_pieces, pa.int64()),
                 pa.array(n_unknown, pa.int64())], names=["id", "n_words", "n_pieces", "n_unknown"])

    return docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text")) \
        .mapInArrow(over, COUNT_SCHEMA)
