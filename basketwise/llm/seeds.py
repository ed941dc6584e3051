"""Exchanges of packed values between tasks: which ones occur in several places, and in whose texts.

Map tasks sort their values into buckets and send one packed run per bucket. A value that a chunk of texts holds more than once
is settled there, and only one of it is sent on, so that a value in a third of all texts stays a small group.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

ROWS = "bucket int, sid long, data binary"
_NAMES = ["bucket", "sid", "data"]


def dealt(entries: np.ndarray, bucket: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """``entries`` by bucket."""
    order = np.argsort(bucket, kind="stable")
    entries, bucket = entries[order], bucket[order]
    found, first = np.unique(bucket, return_index=True)
    yield from zip(found.tolist(), np.split(entries, first[1:]))


def rows(parts: list[tuple[int, int | None, bytes]]) -> pa.RecordBatch:
    """Rows to exchange: a run of values for a bucket (no sid), or what is known of a text already (with its sid)."""
    bucket, sid, data = zip(*parts) if parts else ([], [], [])
    return pa.RecordBatch.from_arrays([pa.array(bucket, pa.int32()), pa.array(sid, pa.int64()), pa.array(data, pa.binary())], names=_NAMES)


def by_text(sids: np.ndarray, values: np.ndarray) -> Iterator[tuple[int, bytes]]:
    """The values of each text, packed."""
    order = np.argsort(sids, kind="stable")
    sids, values = sids[order], values[order]
    found, first = np.unique(sids, return_index=True)
    data, size = values.tobytes(), values.itemsize
    at = (size * np.append(first, len(values))).tolist()
    for sid, a, b in zip(found.tolist(), at, at[1:]):
        yield sid, data[a:b]


def pack_by_text(sids: np.ndarray, keys: np.ndarray) -> bytes:
    """Texts (in order), how many keys each has, and the lower halves of the keys."""
    found, first = np.unique(sids, return_index=True)
    counts = np.diff(np.append(first, len(sids))).astype(np.uint32)
    return np.uint32(len(found)).tobytes() + found.tobytes() + counts.tobytes() + keys.astype(np.uint32).tobytes()


def unpack_by_text(run: bytes) -> tuple[np.ndarray, np.ndarray]:
    n = int(np.frombuffer(run, np.uint32, 1)[0])
    sids, counts = np.frombuffer(run, np.int64, n, 4), np.frombuffer(run, np.uint32, n, 4 + 8 * n)
    return np.repeat(sids, counts), np.frombuffer(run, np.uint32, offset=4 + 12 * n)


def keys_of(values: np.ndarray, buckets: int) -> np.ndarray:
    """Bucket (upper half) and 32 more bits of a hash."""
    high, low = np.divmod(values, np.uint64(buckets))
    return (low << np.uint64(32)) | (high & np.uint64(0xFFFFFFFF))


def exchange(sent: DataFrame, buckets: int, settle) -> DataFrame:
    """(bucket, data): what was known of texts, and what ``settle(bucket, runs)`` yields of them for the runs of each bucket.

    Both are packed by the texts' own buckets, so a task sends one row to each; ``collected`` takes them apart.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list[bytes]] = {}
        for batch in batches:
            known = []
            for bucket, sid, data in zip(*(c.to_pylist() for c in batch.columns)):
                if sid is None:
                    held.setdefault(bucket, []).append(data)
                else:
                    known.append((sid, data))
            if known:
                yield _packed(known, buckets)
        for bucket in list(held):
            found = list(settle(bucket, held.pop(bucket)))
            if found:
                yield _packed(found, buckets)

    return sent.repartition(buckets, "bucket").mapInArrow(run, "bucket int, data binary")


def _packed(found: list[tuple[int, bytes]], buckets: int) -> pa.RecordBatch:
    by_bucket: dict[int, list[tuple[int, bytes]]] = {}
    for sid, data in found:
        by_bucket.setdefault(sid % buckets, []).append((sid, data))
    packed = []
    for rows_ in by_bucket.values():
        sids, data = zip(*rows_)
        sizes = np.array([len(d) for d in data], np.uint32)
        packed.append(np.uint32(len(sids)).tobytes() + np.array(sids, np.int64).tobytes() + sizes.tobytes() + b"".join(data))
    return pa.RecordBatch.from_arrays([pa.array(list(by_bucket), pa.int32()), pa.array(packed, pa.binary())], names=["bucket", "data"])


def collected(exchanged: DataFrame, buckets: int) -> DataFrame:
    """(sid, data): all packed values of each text in one row; a text's own size bounds it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list[bytes]] = {}
        for batch in batches:
            for data in batch.column(1).to_pylist():
                n = int(np.frombuffer(data, np.uint32, 1)[0])
                sids = np.frombuffer(data, np.int64, n, 4).tolist()
                ends = 4 + 12 * n + np.cumsum(np.frombuffer(data, np.uint32, n, 4 + 8 * n), dtype=np.int64)
                at = 4 + 12 * n
                for sid, end in zip(sids, ends.tolist()):
                    held.setdefault(sid, []).append(data[at:end])
                    at = end
        sids = list(held)
        for i in range(0, len(sids), 1024):
            part = sids[i : i + 1024]
            joined = [b"".join(held.pop(s)) for s in part]
            yield pa.RecordBatch.from_arrays([pa.array(part, pa.int64()), pa.array(joined, pa.binary())], names=["sid", "data"])

    return exchanged.repartition(buckets, "bucket").mapInArrow(run, "sid long, data binary")


def unpacked(data: bytes | None, kind) -> np.ndarray:
    return np.frombuffer(data or b"", dtype=kind)
