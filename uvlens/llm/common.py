"""Small helpers shared by the training-data operators."""

from __future__ import annotations

import ctypes
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from uvlens.session import scratch_path


def materialize(df: DataFrame, kind: str, parts: int | None = None) -> DataFrame:
    """Write ``df`` to a fresh table below the shared checkpoint folder and
    read it back: the lineage is cut, every later reader sees the same rows,
    and a lost executor costs a re-read, not a re-computation. ``parts`` lowers
    the number of files of a table whose size is known to be small."""
    path = scratch_path(df.sparkSession, f"llm-{kind}")
    (df.coalesce(parts) if parts else df).write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def fresh(df: DataFrame, name: str) -> str:
    """A column name not taken in ``df`` (callers' extra columns may clash)."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = "_" + name
    return name


def crc_mod(id_col: str | Column, m: int) -> Column:
    """crc32 of the id as text, modulo ``m`` (null for a null id)."""
    c = F.col(id_col) if isinstance(id_col, str) else id_col
    return F.crc32(c.cast("string").cast("binary")) % m


def about_distinct(*cols: str) -> Column:
    """Approximate number of distinct combinations, to set a sampling rate by. Samples
    take a tenth more (``MARGIN``), so that tables not larger than the sample come whole."""
    return F.approx_count_distinct(F.xxhash64(*cols), 0.02)


MARGIN = 1.1


def hash63(*cols: str | Column) -> Column:
    """A hash of ``cols`` from 0 to 2^63 - 1."""
    return F.xxhash64(*cols).bitwiseAND(F.lit((1 << 63) - 1))


def hash_bound(share: Column) -> Column:
    """The bound that about ``share`` of all ``hash63`` values do not exceed. With 63
    bits, a share of one row in 10^12 still picks its rows."""
    return F.when(share >= 1, F.lit((1 << 63) - 1)).otherwise(
        (F.greatest(share.cast("double"), F.lit(0.0)) * (2.0**63)).cast("bigint") - 1)


def hash_below(share: float, *cols: str | Column) -> Column:
    """Whether a hash of ``cols`` falls into the first ``share`` of all hashes."""
    return hash63(*cols) <= hash_bound(F.lit(float(share)))


def byte_slices(texts: pa.Array, max_bytes: int = 1 << 22) -> Iterator[tuple[int, int]]:
    """Row ranges of a string array holding about ``max_bytes`` each (one row
    at least), so temporaries stay small however long the texts are."""
    off = offsets(texts)
    i, n = 0, len(texts)
    while i < n:
        j = int(np.searchsorted(off, off[i] + max_bytes, side="right")) - 1
        j = min(max(j, i + 1), n)
        yield i, j
        i = j


try:
    _trim = ctypes.CDLL(None).malloc_trim
except (AttributeError, OSError, TypeError):  # another C library than glibc
    _trim = None


def give_back() -> None:
    """Hands freed memory, which Arrow and the C library keep for later, back to the system.
    Worker processes outlive their tasks: what one operator's batches leave adds to what the
    next one needs."""
    pa.default_memory_pool().release_unused()
    if _trim:
        _trim(0)


def offsets(texts: pa.Array) -> np.ndarray:
    kind = np.int64 if pa.types.is_large_string(texts.type) else np.int32
    buf = texts.buffers()[1]
    if buf is None:
        return np.zeros(len(texts) + 1, np.int64)
    off = np.frombuffer(buf, kind, len(texts) + 1, texts.offset * np.dtype(kind).itemsize)
    return off.astype(np.int64)


def as_strings(a) -> pa.Array:
    """One contiguous string array without nulls (null reads as empty)."""
    if isinstance(a, pa.ChunkedArray):
        a = a.combine_chunks()
    if a.null_count:
        a = a.fill_null("")
    return a


def utf8(texts: pa.Array, i: int, j: int) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of rows i..j-1 and the row starts within them (j-i+1 values)."""
    off = offsets(texts)
    data = texts.buffers()[2]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[off[i]:off[j]], off[i:j + 1] - off[i]


def per_row(flags: np.ndarray, start: np.ndarray) -> np.ndarray:
    """Sum of ``flags`` (one value a byte) in every row."""
    out = np.zeros(len(start) - 1, np.int64)
    full = np.flatnonzero(start[1:] > start[:-1])
    if len(full):
        out[full] = np.add.reduceat(flags, start[full], dtype=np.int64)
    return out


VECTOR_PARTS = "key string, piece int, task int, v binary"
_PIECES = 16


def vector_parts(key: str, v: np.ndarray) -> pa.RecordBatch:
    """One task's part of a sum of float64 vectors, cut into pieces (``VECTOR_PARTS``)."""
    task = TaskContext.get()
    pieces = [x.astype(np.float64).tobytes() for x in np.array_split(v, _PIECES)]
    return pa.record_batch([pa.array([key] * _PIECES), pa.array(range(_PIECES), pa.int32()),
                            pa.array([task.partitionId() if task else 0] * _PIECES, pa.int32()),
                            pa.array(pieces, pa.binary())], ["key", "piece", "task", "v"])


def vector_sums(parts: DataFrame) -> dict[str, np.ndarray]:
    """Sums of the tasks' vectors by key, added piece by piece on the executors in the order
    of the tasks; only the sums come to the driver."""
    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, total = None, np.zeros(0)
        for b in batches:
            for key, piece, v in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(3)):
                if (key, piece) != at:
                    if at is not None:
                        yield pa.record_batch([pa.array([at[0]]), pa.array([at[1]], pa.int32()),
                                               pa.array([total.tobytes()], pa.binary())], ["key", "piece", "v"])
                    at, total = (key, piece), 0.0
                total = total + np.frombuffer(v.as_buffer())
        if at is not None:
            yield pa.record_batch([pa.array([at[0]]), pa.array([at[1]], pa.int32()),
                                   pa.array([total.tobytes()], pa.binary())], ["key", "piece", "v"])

    got = (parts.repartition("key", "piece").sortWithinPartitions("key", "piece", "task")
           .mapInArrow(add, "key string, piece int, v binary").toArrow())
    out: dict[str, dict] = {}
    for key, piece, v in zip(got["key"].to_pylist(), got["piece"].to_pylist(), got["v"].to_pylist()):
        out.setdefault(key, {})[piece] = np.frombuffer(v)
    return {k: np.concatenate([out[k][i] for i in range(_PIECES)]) for k in sorted(out)}
