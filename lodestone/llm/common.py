"""Shared building blocks of the training-data operators.

Texts are handled as one byte buffer with offsets (the Arrow layout), so hashing
words, windows and byte strings is a handful of numpy passes and no Python object
is made per word.

Cells and buckets.  Operators that must find equal keys anywhere in the corpus deal
documents into *cells* by a hash of their id.  A cell sends each of its distinct keys
once to the *bucket* of that key (delta-coded, a few bytes a key); a bucket answers
with the keys that it got from several cells.  A key that a third of all documents
carry therefore costs one entry per cell, never one per document.
"""

from __future__ import annotations

import contextlib
import ctypes
import gc
import inspect
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import cut, ensure_checkpoint_dir  # noqa: F401

#: Text bytes that a cell holds on average, and that share one key bucket.
CELL_BYTES = 6 << 20
BUCKET_BYTES = 24 << 20
MIN_PARTS = 24

U64 = np.uint64


# ---------------------------------------------------------------- Spark side


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def release(spark: SparkSession) -> None:
    """Let Spark remove the shuffle files of plans that a checkpoint has cut off.

    It does so when its driver finds them unreachable, which may otherwise take long.
    """
    gc.collect()
    spark.sparkContext._jvm.System.gc()


#: Rows and bytes of a batch between Spark and Python.
BATCH_ROWS, BATCH_BYTES = 2000, 8 << 20


def bound_batches(spark: SparkSession) -> None:
    """Hand Python batches of bounded size: 10,000 long texts at a time would not fit a worker.

    Settings that the session was given are left alone; results do not depend on them.
    """
    for name, usual, value in (("maxRecordsPerBatch", "10000", BATCH_ROWS), ("maxBytesPerBatch", None, BATCH_BYTES)):
        key = f"spark.sql.execution.arrow.{name}"
        if usual is None and spark.sparkContext.getConf().contains(key):
            continue
        if usual is None or spark.conf.get(key, usual) == usual:
            spark.conf.set(key, str(value))


def give_back() -> None:
    """Return freed memory, which Arrow and the C library else keep for later, to the system."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # not every C library has this
        ctypes.CDLL(None).malloc_trim(0)


#: Bytes of a group after which freed memory is given back; for many small ones that would cost more than they leave.
LARGE_GROUP = 1 << 18


def tidy(work):
    """``work`` for mapInArrow or applyInArrow, and freed memory given back when it has ended.

    Workers outlive a stage, so what each stage's largest batch took would else stay with
    the executor through all later ones.
    """

    def stream(batches):
        try:
            yield from work(batches)
        finally:
            give_back()

    def call(*tables):
        try:
            return work(*tables)
        finally:
            if sum(getattr(t, "nbytes", 0) for t in tables) >= LARGE_GROUP:
                give_back()

    if inspect.isgeneratorfunction(work):
        return stream
    # Spark tells from the number of arguments whether the key is wanted
    return {1: lambda a: call(a), 2: lambda a, b: call(a, b), 3: lambda a, b, c: call(a, b, c)}[work.__code__.co_argcount]


def unused(name: str, columns: list[str]) -> str:
    """``name``, with underscores in front until no column is called so."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name = "_" + name
    return name


def column_bytes(df: DataFrame, col: str) -> int:
    """Total UTF-8 bytes of a text column: one cheap aggregate, no text moves."""
    got = df.agg(F.sum(F.octet_length(F.col(col).cast("string"))).alias("b")).first()
    return int(got["b"] or 0)


def parts(total_bytes: int, each: int) -> int:
    return max(MIN_PARTS, -(-total_bytes // each))


def cells(docs: DataFrame, n_cells: int, id_col: str = "doc_id", text_col: str = "text", carry: tuple[str, ...] = ()) -> DataFrame:
    """``(cell, doc_id, text)`` and ``carry``, null text as empty; other columns are left out."""
    bound_batches(docs.sparkSession)
    return docs.select(
        F.pmod(F.xxhash64(F.col(id_col)), F.lit(n_cells)).cast("int").alias("cell"),
        F.col(id_col).cast("long").alias("doc_id"),
        F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"),
        *carry,
    )


def shared_keys(sent: DataFrame) -> DataFrame:
    """From ``(cell, bucket, keys)`` to ``(cell, keys)``: keys that several cells sent."""

    def answer(table):
        owners = table.column("cell").to_pylist()
        lists = [unpack(b) for b in table.column("keys").to_pylist()]
        everything = np.concatenate(lists) if lists else np.empty(0, U64)
        everything.sort()
        twice = everything[1:][everything[1:] == everything[:-1]]
        twice = twice[np.append(True, twice[1:] != twice[:-1])] if len(twice) else twice
        out_cells, out = [], []
        for c, keys in zip(owners, lists):
            hit = keys[member(keys, twice)]
            if len(hit):
                out_cells.append(c)
                out.append(pack(hit))
        return pa.table({"cell": pa.array(out_cells, pa.int32()), "keys": pa.array(out, pa.binary())})

    return sent.groupBy("bucket").applyInArrow(tidy(answer), "cell int, keys binary")


def send(cell: int, keys: np.ndarray, n_buckets: int) -> pa.Table:
    """Rows ``(cell, bucket, keys)`` for the distinct sorted ``keys`` of a cell."""
    blobs = split_by_bucket(keys, n_buckets)
    return pa.table(
        {
            "cell": pa.array([cell] * len(blobs), pa.int32()),
            "bucket": pa.array([b for b, _ in blobs], pa.int32()),
            "keys": pa.array([pack(k) for _, k in blobs], pa.binary()),
        }
    )


def received(table: pa.Table) -> np.ndarray:
    """Sorted union of the ``keys`` blobs that came back to a cell."""
    got = [unpack(b) for b in table.column("keys").to_pylist()]
    out = np.concatenate(got) if got else np.empty(0, U64)
    out.sort()
    return out


# ---------------------------------------------------------------- key lists


def split_by_bucket(keys: np.ndarray, n: int) -> list[tuple[int, np.ndarray]]:
    """Sorted keys by bucket, of ``n`` equal ranges of the 64-bit space; work follows the keys, not ``n``."""
    if not len(keys):
        return []
    bucket = bucket_of(keys, n)
    cuts = np.flatnonzero(np.append(True, bucket[1:] != bucket[:-1]))
    return list(zip(bucket[cuts].tolist(), np.split(keys, cuts[1:])))


def bucket_of(keys: np.ndarray, n: int) -> np.ndarray:
    return (keys // U64((1 << 64) // n + 1)).astype(np.int32)


def pack(keys: np.ndarray) -> bytes:
    """Sorted uint64 keys as deltas, byte plane by byte plane, deflated."""
    gaps = np.diff(keys, prepend=U64(0)).astype("<u8")
    planes = np.ascontiguousarray(gaps.view(np.uint8).reshape(-1, 8).T)
    return zlib.compress(planes.tobytes(), 1)


def unpack(blob: bytes) -> np.ndarray:
    planes = np.frombuffer(zlib.decompress(blob), np.uint8).reshape(8, -1)
    return np.cumsum(np.ascontiguousarray(planes.T).view("<u8").reshape(-1), dtype=U64)


def member(keys: np.ndarray, sorted_set: np.ndarray) -> np.ndarray:
    """Mask of ``keys`` that occur in ``sorted_set``."""
    if not len(sorted_set) or not len(keys):
        return np.zeros(len(keys), bool)
    at = np.searchsorted(sorted_set, keys)
    at[at == len(sorted_set)] = 0
    return sorted_set[at] == keys


def distinct_and_repeated(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct keys, and those among them that occur at least twice."""
    k = np.sort(keys)
    if not len(k):
        return k, k
    first = np.append(True, k[1:] != k[:-1])
    again = k[1:][k[1:] == k[:-1]]
    return k[first], again[np.append(True, again[1:] != again[:-1])] if len(again) else again


# ---------------------------------------------------------------- texts as bytes


def text_buffer(column: pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """One uint8 buffer with the texts end to end, and int64 offsets (n + 1)."""
    arr = column.cast(pa.large_string()).combine_chunks() if not isinstance(column, pa.Array) else column.cast(pa.large_string())
    if isinstance(arr, pa.ChunkedArray):
        arr = pa.concat_arrays(arr.chunks) if arr.num_chunks else pa.array([], pa.large_string())
    if arr.null_count:
        arr = arr.fill_null("")
    if len(arr) == 0:
        return np.empty(0, np.uint8), np.zeros(1, np.int64)
    offs = np.frombuffer(arr.buffers()[1], np.int64)[arr.offset : arr.offset + len(arr) + 1]
    data = arr.buffers()[2]
    buf = np.frombuffer(data, np.uint8)[offs[0] : offs[-1]] if data is not None else np.empty(0, np.uint8)
    return buf, offs - offs[0]


def batches(buf: np.ndarray, offs: np.ndarray, limit: int = 2 << 20) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Runs of whole documents of about ``limit`` bytes: (first, last, bytes, offsets)."""
    n, i = len(offs) - 1, 0
    while i < n:
        j = max(i + 1, int(np.searchsorted(offs, offs[i] + limit, "right")) - 1)
        j = min(j, n)
        yield i, j, buf[offs[i] : offs[j]], offs[i : j + 1] - offs[i]
        i = j


_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def ascii_lower(buf: np.ndarray) -> np.ndarray:
    return _LOWER[buf]


def word_spans(buf: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the words ``[^\\x20\\x09-\\x0D]+`` and, per document, the first word's index."""
    n = len(buf)
    if not n:
        z = np.empty(0, np.int64)
        return z, z, np.zeros(len(offs), np.int64)
    word = ~_SPACE[buf]
    before = np.empty(n, bool)
    before[0] = False
    before[1:] = word[:-1]
    edge = offs[:-1][offs[:-1] < n]
    before[edge] = False
    starts = np.flatnonzero(word & ~before)
    after = np.empty(n, bool)
    after[-1] = False
    after[:-1] = word[1:]
    last = offs[1:] - 1
    after[last[last >= 0]] = False
    ends = np.flatnonzero(word & ~after) + 1
    return starts, ends, np.searchsorted(starts, offs)


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (multiply and xor-shift rounds); bijective."""
    x = x.astype(U64, copy=True)
    x ^= x >> U64(30)
    x *= U64(0xBF58476D1CE4E5B9)
    x ^= x >> U64(27)
    x *= U64(0x94D049BB133111EB)
    x ^= x >> U64(31)
    return x


_BYTE = mix(np.arange(1, 257, dtype=U64) * U64(0x9E3779B97F4A7C15))
_BASE = 0x9E3779B97F4A7C15 | 1
_BASE_INV = pow(_BASE, -1, 1 << 64)
_POWERS: dict[int, np.ndarray] = {}


def powers(base: int, n: int) -> np.ndarray:
    have = _POWERS.get(base)
    if have is None or len(have) < n:
        size = max(1 << 16, 1 << (n - 1).bit_length() if n > 1 else 1)
        a = np.full(size, base, U64)
        a[0] = 1
        have = _POWERS[base] = np.cumprod(a, dtype=U64)
    return have[:n]


#: Bytes whose powers are held at a time.
HASH_BYTES = 1 << 19


def span_hashes(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of the byte spans [start, end) of one buffer, ``starts`` ascending.

    Memory follows HASH_BYTES and the number of spans, not the length of the buffer.
    """
    raw = np.empty(len(starts), U64)
    sizes = ends - starts
    for k in np.flatnonzero(sizes > HASH_BYTES).tolist():
        raw[k] = _long_raw(buf, int(starts[k]), int(ends[k]))
    short = np.flatnonzero(sizes <= HASH_BYTES)
    s, e = starts[short], ends[short]
    i = 0
    while i < len(s):
        j = int(np.searchsorted(s, s[i] + HASH_BYTES, "left"))
        lo, hi = int(s[i]), int(e[i:j].max())
        prefix = np.zeros(hi - lo + 1, U64)
        np.cumsum(_BYTE[buf[lo:hi]] * powers(_BASE, hi - lo), out=prefix[1:], dtype=U64)
        raw[short[i:j]] = (prefix[e[i:j] - lo] - prefix[s[i:j] - lo]) * powers(_BASE_INV, hi - lo + 1)[s[i:j] - lo]
        i = j
    return mix(raw + sizes.astype(U64) * U64(0xD6E8FEB86659FD93))


def _long_raw(buf: np.ndarray, lo: int, hi: int) -> np.uint64:
    """The polynomial of one long span, piece by piece."""
    total = 0
    for at in range(lo, hi, HASH_BYTES):
        piece = buf[at : min(at + HASH_BYTES, hi)]
        total += int((_BYTE[piece] * powers(_BASE, len(piece))).sum(dtype=U64)) * pow(_BASE, at - lo, 1 << 64)
    return U64(total % (1 << 64))


_STEP = [U64(x) for x in (0xA0761D6478BD642F, 0xE7037ED1A0B428DB, 0x8EBC6AF09C88C6E3, 0x589965CC75374CC3, 0x1D8E4E27C47D124F, 0xEB44ACCAB455D165, 0x9E6C63D0876A9A47, 0xC2B2AE3D27D4EB4F)]


def window_hashes(items: np.ndarray, length: int) -> np.ndarray:
    """Hash of every run of ``length`` consecutive 64-bit items (len - length + 1 of them).

    Built by doubling: the hash of 2m items is made of those of its two halves.
    """
    n = len(items)
    if n < length:
        return np.empty(0, U64)
    have, out, done = items, None, 0
    size, level = 1, 0
    while True:
        if length & size:
            out = have[: n - length + 1].copy() if out is None else _join(out, have[done : done + n - length + 1], level + 3)
            done += size
        if size * 2 > length:
            break
        have = _join(have[: len(have) - size], have[size:], level)
        size, level = size * 2, level + 1
    return mix(out)


def _join(a: np.ndarray, b: np.ndarray, level: int) -> np.ndarray:
    out = a * _STEP[level % 8]
    out ^= out >> U64(29)
    out += b
    out *= _STEP[(level + 5) % 8]
    return out


def sliding_argmin(values: np.ndarray, width: int) -> np.ndarray:
    """Position of the leftmost smallest value in every window of ``width`` values.

    Values are compared by their upper 32 bits, ties go to the left; two windows with
    the same content thus pick the same place.
    """
    n = len(values)
    if n < width:
        return np.empty(0, np.int64)
    packed = (values & U64(0xFFFFFFFF00000000)) | np.arange(n, dtype=U64)
    full = -(-n // width) * width
    padded = np.full(full, np.iinfo(np.uint64).max, U64)
    padded[:n] = packed
    blocks = padded.reshape(-1, width)
    left = np.minimum.accumulate(blocks, axis=1).reshape(-1)
    right = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].reshape(-1)
    best = np.minimum(right[: n - width + 1], left[width - 1 : n])
    return (best & U64(0xFFFFFFFF)).astype(np.int64)


def inside(first: np.ndarray, n_items: int, length: int) -> np.ndarray:
    """Mask over window starts: the window of ``length`` items lies in one document.

    ``first`` holds each document's first item index, with the total at the end.
    """
    n = n_items - length + 1
    if n <= 0:
        return np.zeros(0, bool)
    room = np.zeros(n_items + 1, np.int32)
    lo, hi = first[:-1], np.maximum(first[1:] - length + 1, first[:-1])
    np.add.at(room, lo, 1)
    np.add.at(room, hi, -1)
    return np.cumsum(room)[:n] > 0


def cover(starts: np.ndarray, ends: np.ndarray, n: int) -> np.ndarray:
    """Mask of the positions that lie in any of the spans."""
    depth = np.zeros(n + 1, np.int64)
    np.add.at(depth, starts, 1)
    np.add.at(depth, ends, -1)
    return np.cumsum(depth[:n]) > 0


def concat(tables: Iterable[pa.Table], schema: pa.Schema) -> pa.Table:
    tables = list(tables)
    return pa.concat_tables(tables) if tables else schema.empty_table()
