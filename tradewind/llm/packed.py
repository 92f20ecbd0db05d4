"""Record batches as bytes: one row per key instead of one row per record.

A numpy record array is stored column by column, integers as differences, each
column as byte planes, so the high bytes of small differences and the bytes
fixed by the key are runs that the shuffle's compression removes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

SCHEMA = "kind int, key long, n int, data binary"
ARROW = pa.schema([("kind", pa.int32()), ("key", pa.int64()), ("n", pa.int32()),
                   ("data", pa.binary())])


def _bytes(rows: np.ndarray) -> bytes:
    parts = []
    for c in rows.dtype.names:
        col = rows[c]
        if col.dtype.kind == "i":
            col = np.diff(col, prepend=col.dtype.type(0))
        parts.append(np.ascontiguousarray(
            np.ascontiguousarray(col).view(np.uint8).reshape(len(rows), -1).T).tobytes())
    return b"".join(parts)


def pack(kind: int, key: np.ndarray, rows: np.ndarray) -> pa.RecordBatch:
    """One row per distinct key, its records in their given order."""
    order = np.argsort(key, kind="stable")
    key, rows = key[order], rows[order]
    lo = np.flatnonzero(np.diff(key, prepend=key[:1] - 1)) if len(key) else np.empty(0, int)
    hi = np.append(lo[1:], len(key)) if len(lo) else lo
    return pa.RecordBatch.from_pydict({
        "kind": [kind] * len(lo), "key": key[lo] if len(lo) else [],
        "n": (hi - lo).astype(np.int32), "data": [_bytes(rows[a:b]) for a, b in zip(lo, hi)],
    }, schema=ARROW)


def unpack(table: pa.Table, dtype: np.dtype) -> np.ndarray:
    """All records of the table's rows, one row after the other."""
    ns = table.column("n").to_pylist()
    out = np.empty(sum(ns), dtype)
    at = 0
    for n, data in zip(ns, table.column("data").to_pylist()):
        o = 0
        for c in dtype.names:
            t = dtype[c]
            planes = np.frombuffer(data, np.uint8, n * t.itemsize, o).reshape(t.itemsize, n)
            col = np.ascontiguousarray(planes.T).view(t).ravel()
            out[c][at:at + n] = np.cumsum(col, dtype=t) if t.kind == "i" else col
            o += n * t.itemsize
        at += n
    return out


def sized(batches: Iterator[pa.RecordBatch], limit: int) -> Iterator[pa.Table]:
    """The input in tables of about ``limit`` bytes (one row at least)."""
    held, size = [], 0
    for b in batches:
        step = max(1, int(b.num_rows * limit / max(b.nbytes, 1) / 4))
        for i in range(0, b.num_rows, step):
            part = b.slice(i, step)
            held.append(part)
            size += part.nbytes
            if size >= limit:
                yield pa.Table.from_batches(held)
                held, size = [], 0
                pa.default_memory_pool().release_unused()
    if held:
        yield pa.Table.from_batches(held)
