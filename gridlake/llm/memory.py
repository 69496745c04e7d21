"""Memory of Python workers and of what is sent to them.

A worker serves one task after another.  The C allocator keeps the pages of
freed blocks, so an idle worker would hold what its largest task needed, on
top of what the tasks of later stages take.  The same holds for the executor:
each of its threads may keep the buffers of the largest Arrow batch it sent.
"""

from __future__ import annotations

import ctypes
import re

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

BATCH_BYTES = 1 << 20
BATCH_CONF = "spark.sql.execution.arrow.maxBytesPerBatch"


def give_back() -> None:
    """Return the freed memory of this process to the system (where the C
    library has no ``malloc_trim``, only Arrow's)."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def giving_back(work: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """``work`` (batches to batches), which at its end returns what it freed."""
    def over(batches: Iterator) -> Iterator:
        yield from work(batches)
        give_back()

    return over


def small_batches(df: DataFrame) -> DataFrame:
    """``df``, whose session now sends Arrow batches of about ``BATCH_BYTES``
    (as many rows as before in all; a long text is a batch of its own).  The
    default of 10,000 rows puts a whole split of texts into one batch.  A
    smaller bound that the session has is kept."""
    conf = df.sparkSession.conf
    set_to = conf.get(BATCH_CONF, None)
    if set_to is None or in_bytes(set_to) > BATCH_BYTES:
        conf.set(BATCH_CONF, str(BATCH_BYTES))
    return df


def in_bytes(size: str) -> int:
    """Bytes of a setting such as ``64m`` or ``67108864b``."""
    number, unit = re.fullmatch(r"(\d+)\s*([kmgtp]?)b?", size.strip().lower()).groups()
    return int(number) << 10 * " kmgtp".index(unit or " ")
