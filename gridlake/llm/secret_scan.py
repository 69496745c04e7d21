"""Secret scans with corpus-wide ownership frequency.

1. Each text is scanned by fixed patterns: three base kinds (assign,
   access, hex) and further token shapes that are only candidates, and
   only if they look random.
2. Every matched secret is hashed; Spark counts in how many repositories
   (documents) and owners (sources) each hash occurs.
3. A secret that more than ``max_owners`` owners hold, or more than
   ``max_repositories`` repositories of any owners, is a widely copied
   example; one that stays with few owners, in few of their repositories, is
   live, however short or plain a base secret is.  Further candidates become spans only if they
   are live; base spans stay whatever the verdict, with ``n_live`` /
   ``n_example`` beside them.

Scale: only candidates (hash, owner, repository) are shuffled, never
texts; counting goes (hash, owner, repository) -> (hash, owner) -> hash,
combined before each shuffle, so an example that a third of all documents
hold arrives as one row per task.

Edge cases: null or empty texts have no spans; null ids and sources are
values of their own (a null source is one owner); repeated rows keep their
own result and count once per (owner, repository); an empty table gives
an empty result; other columns of the input are ignored.
"""

from __future__ import annotations

import hashlib
import math
import re
from bisect import bisect_left
from collections import Counter

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridlake.llm.memory import giving_back, small_batches
from gridlake.llm.staging import stage

# The base kinds, in their listed order.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
                    re.IGNORECASE | re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]+")
BASE_KINDS = ("assign", "access", "hex")
# Further shapes, candidates that the ownership count decides on.
EXTRA = {
    "prefixed": re.compile(r"\b(?:gh[pousr]_|glpat-|xox[abprs]-|sk_live_|sk-)[A-Za-z0-9_-]{16,}"),
    # from the start of a run only, without going back into it: linear in the text
    "jwt": re.compile(r"(?<![A-Za-z0-9_-])eyJ[A-Za-z0-9_-]{8,}+\.[A-Za-z0-9_-]{8,}+\.[A-Za-z0-9_-]{8,}+"),
    "urlpass": re.compile(r"[a-z][a-z0-9+.-]{1,12}://[^\s:/@]{1,64}:[^\s:/@]{6,64}@"),
    "opaque": re.compile(r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_-]{24,}={0,2}(?![A-Za-z0-9+/_=-])"),
}
KINDS = BASE_KINDS + tuple(EXTRA)
_RANK = {k: i for i, k in enumerate(KINDS)}


def base_matches(text: str) -> list[tuple[int, int, str, str]]:
    """(start, end, kind, secret) of the base kinds: leftmost, not
    overlapping within a kind, matches that fail the length test dropped."""
    out = [(m.start(), m.end(), "assign", m.group(2)) for m in ASSIGN.finditer(text) if len(m.group(2)) >= 6]
    out += [(m.start(), m.end(), "access", m.group()) for m in ACCESS.finditer(text) if len(m.group()) >= 20]
    out += [(m.start(), m.end(), "hex", m.group()) for m in HEX.finditer(text) if len(m.group()) >= 24]
    return out


def looks_random(secret: str) -> bool:
    """Digits beside letters and at least 3 bits a character."""
    n = len(secret)
    has = re.search(r"[0-9]", secret) and re.search(r"[A-Za-z]", secret)
    bits = -sum(c / n * math.log2(c / n) for c in Counter(secret).values())
    return bool(has) and bits >= 3.0


def apart(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Spans merged where they overlap, in order."""
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a < out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], b))
        else:
            out.append((a, b))
    return out


def extra_matches(text: str, taken: list[tuple[int, int, str, str]]) -> list[tuple[int, int, str, str]]:
    """Further candidates that overlap no span found before them."""
    out, used = [], apart([(a, b) for a, b, _, _ in taken])
    for kind, pattern in EXTRA.items():
        found = []
        for m in pattern.finditer(text):
            at = bisect_left(used, (m.end(), 0))           # the last span that starts before the match ends
            if (at == 0 or used[at - 1][1] <= m.start()) and looks_random(m.group()):
                found.append((m.start(), m.end(), kind, m.group()))
        out += found
        used = apart(used + [(f[0], f[1]) for f in found])
    return out


def joined(spans) -> str:
    """``kind:start:end`` by start, then kind as listed, comma-joined."""
    return ",".join(f"{k}:{a}:{b}" for a, b, k, *_ in sorted(spans, key=lambda s: (s[0], _RANK[s[2]])))


def digest(secret: str) -> bytes:
    return hashlib.sha256(secret.encode("utf-8")).digest()[:16]


# One of these signs is in every text that any pattern can match.
_HINT = re.compile(r"AKIA|://|[0-9a-f]{24}|[A-Za-z0-9+/_.-]{19}|password|passwd|secret|token|api_?key",
                   re.IGNORECASE | re.ASCII)


def scan_text(text: str) -> list[tuple[int, int, str, str]]:
    if not _HINT.search(text):
        return []
    base = base_matches(text)
    return base + extra_matches(text, base)


SCAN_SCHEMA = ("id long, owner string, n_assign long, n_access long, n_hex long, base_sha256 string,"
               " spans array<struct<start:int,end:int,kind:string,base:boolean,hash:binary>>")

SPANS = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("kind", pa.string()), ("base", pa.bool_()),
                            ("hash", pa.binary())]))


def scan(docs: DataFrame, id_col: str, text_col: str, owner_col: str) -> DataFrame:
    """Candidates of each document (one row per document, base and extra)."""

    def over(batches):
        for batch in batches:
            counts: dict[str, list] = {k: [] for k in BASE_KINDS}
            shas, spans = [], []
            for text in batch.column(1):
                found = scan_text(text.as_py() or "")
                base = [f for f in found if f[2] in BASE_KINDS]
                kinds = Counter(f[2] for f in base)
                for k, column in counts.items():
                    column.append(kinds[k])
                shas.append(hashlib.sha256(joined(base).encode()).hexdigest())
                spans.append([{"start": a, "end": b, "kind": k, "base": k in BASE_KINDS, "hash": digest(s)} for a, b, k, s in found])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(2), *[pa.array(counts[k], pa.int64()) for k in BASE_KINDS],
                 pa.array(shas, pa.string()), pa.array(spans, SPANS)],
                names=["id", "owner", "n_assign", "n_access", "n_hex", "base_sha256", "spans"])

    narrow = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"),
                         F.col(owner_col).cast("string").alias("owner"))
    return small_batches(narrow).mapInArrow(giving_back(over), SCAN_SCHEMA)


def ownership(candidates: DataFrame) -> DataFrame:
    """(hash, n_owners, n_repositories) over (hash, owner, repository) rows."""
    return candidates.groupBy("hash", "owner", "repository").agg(F.lit(1).alias("one")) \
        .groupBy("hash", "owner").agg(F.count("one").alias("repositories")) \
        .groupBy("hash").agg(F.count(F.lit(1)).alias("n_owners"), F.sum("repositories").alias("n_repositories"))


def find_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", owner_col: str = "source",
                 max_owners: int = 2, max_repositories: int = 30) -> DataFrame:
    """One row per document: id, n_assign, n_access, n_hex, base_sha256,
    found (array of struct: start, end, kind, base, live, n_owners,
    n_repositories), spans (joined text), n_live, n_example."""
    scanned = stage(scan(docs, id_col, text_col, owner_col)
                    .withColumn("row", F.monotonically_increasing_id()), "secret-scan")
    hits = scanned.select("row", "id", "owner", F.explode("spans").alias("s")) \
        .select("row", F.col("id").alias("repository"), "owner", "s.*")
    counts = stage(ownership(hits), "secret-owners")
    judged = hits.join(counts, "hash") \
        .withColumn("example", (F.col("n_owners") > max_owners) | (F.col("n_repositories") > max_repositories)) \
        .withColumn("live", ~F.col("example")) \
        .filter(F.col("base") | F.col("live"))
    rank = F.array_position(F.array(*[F.lit(k) for k in KINDS]), F.col("kind"))
    per_row = judged.groupBy("row").agg(
        F.sort_array(F.collect_list(F.struct("start", rank.alias("rank"), "end", "kind", "base", "live", "n_owners",
                                             "n_repositories"))).alias("found"),
        F.sum(F.col("live").cast("long")).alias("n_live"),
        F.sum(F.col("example").cast("long")).alias("n_example"))
    text = F.array_join(F.transform("found", lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"),
                                                                   s["end"].cast("string"))), ",")
    none = F.lit(0).cast("long")
    return scanned.drop("spans", "owner").join(per_row, "row", "left").select(
        "id", "n_assign", "n_access", "n_hex", "base_sha256", "found", F.coalesce(text, F.lit("")).alias("spans"),
        F.coalesce("n_live", none).alias("n_live"), F.coalesce("n_example", none).alias("n_example"))
