"""Media columns: content-defined chunking of payloads, deduplicated and read back.

A payload (bytes) is stored losslessly as a mono 8-bit PCM WAVE file.  The file is cut
where a rolling gear hash of the last 64 bytes meets a mask, so equal passages give equal
chunks whatever stands before them.  Chunks are named by digest; grouping by digest
keeps one copy of each, and a file keeps the ordered list of its digests.  Reading back
joins the lists with the store, puts the chunks in order, checks the digest of the whole
file and decodes the samples.
"""

from __future__ import annotations

import hashlib
import zlib

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common as C

MIN_CHUNK, MAX_CHUNK, MASK_BITS = 1024, 16384, 11
PRESS_LEVEL = 15
RATE = 8000
UNIT = 64
#: Texts that the compression dictionary is made from, at most, and their bytes.
DICTIONARY_TEXTS, DICTIONARY_BYTES = 1000, 1 << 16
_LISTS = pa.schema([("media_key", pa.binary()), ("media_sha", pa.binary()), ("media_bytes", pa.int64()), ("digests", pa.binary())])
_OWNERS = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("media_key", pa.binary())])
_BODIES = pa.schema([("digest", pa.binary()), ("body", pa.binary())])
_FILES = pa.schema([("media_key", pa.binary()), ("payload_bytes", pa.int64()), ("payload_sha", pa.binary()), ("tail_crc32", pa.int64()), ("media_bytes", pa.int64()), ("media_sha", pa.binary()), ("feature", pa.string()), ("n_chunks", pa.int64())])
_FILE_SCHEMA = "media_key binary, payload_bytes long, payload_sha binary, tail_crc32 long, media_bytes long, media_sha binary, feature string, n_chunks long"
#: Bytes of a digest, and of the part of a file's digest by which its rows find each other.
DIGEST, KEY = 16, 16
_GEAR = C.mix(np.arange(256, dtype=np.uint64) + np.uint64(0x632BE59BD9B4E019))


# ---------------------------------------------------------------- the stored form


def pad(data: bytes) -> bytes:
    """Zero bytes up to a positive multiple of 64."""
    return data + b"\0" * (-len(data) % UNIT or (UNIT if not data else 0))


def encode_wave(payload: bytes) -> bytes:
    """A mono, 8-bit unsigned PCM WAVE file with the payload as its samples."""
    fmt = b"fmt " + (16).to_bytes(4, "little") + (1).to_bytes(2, "little") + (1).to_bytes(2, "little") + RATE.to_bytes(4, "little") + RATE.to_bytes(4, "little") + (1).to_bytes(2, "little") + (8).to_bytes(2, "little")
    return b"RIFF" + (4 + len(fmt) + 8 + len(payload)).to_bytes(4, "little") + b"WAVE" + fmt + b"data" + len(payload).to_bytes(4, "little") + payload


def decode_wave(media: bytes) -> bytes:
    """The samples of a WAVE file as written by ``encode_wave``."""
    if media[:4] != b"RIFF" or media[8:12] != b"WAVE":
        raise ValueError("not a WAVE file")
    at = 12
    while at + 8 <= len(media):
        size = int.from_bytes(media[at + 4 : at + 8], "little")
        if media[at : at + 4] == b"data":
            return media[at + 8 : at + 8 + size]
        at += 8 + size + (size & 1)
    raise ValueError("no data chunk")


# ---------------------------------------------------------------- chunking


def cut_points(media: bytes, lo: int = MIN_CHUNK, hi: int = MAX_CHUNK, bits: int = MASK_BITS) -> list[int]:
    """Chunk ends: where the gear hash's top bits are zero, lo to hi bytes apart.

    The gear hash of place i is the sum of gear(byte) << age over the last 64 bytes,
    built here by doubling.
    """
    n = len(media)
    if n <= lo:
        return [n]
    h = _GEAR[np.frombuffer(media, np.uint8)]
    span = 1
    while span < 64:
        older = h[:-span] << np.uint64(span)
        h = h.copy()
        h[span:] += older
        span *= 2
    marks = np.flatnonzero(h >> np.uint64(64 - bits) == 0) + 1
    ends, at, k = [], 0, 0
    while n - at > lo:
        k = int(np.searchsorted(marks, at + lo))
        end = int(marks[k]) if k < len(marks) else n
        at = min(end, at + hi, n)
        ends.append(at)
    if at < n:
        ends.append(n)
    return ends


def press_dictionary(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", samples: int = DICTIONARY_TEXTS) -> bytes:
    """A compression dictionary from up to ``samples`` texts of at most DICTIONARY_BYTES bytes.

    They are those with the smallest hash of their id, one text an id, so what the driver
    reads is bounded.  The dictionary only makes bodies smaller; with too few texts there
    is none.
    """
    text = F.col(text_col).cast("string")
    fit = docs.where(text.isNotNull() & F.col(id_col).isNotNull() & (F.octet_length(text) <= DICTIONARY_BYTES)).select(F.col(id_col).alias("_id"), text.alias("_t"))
    ids = fit.select("_id").distinct().orderBy(F.xxhash64("_id"), "_id").limit(samples)
    got = fit.join(F.broadcast(ids), "_id").groupBy("_id").agg(F.min("_t").alias("t"))
    texts = sorted(r["t"].encode("utf-8", "surrogatepass") for r in got.collect())
    try:
        return zstandard.train_dictionary(112 << 10, texts, k=200, d=8).as_bytes()
    except (zstandard.ZstdError, ValueError):
        return b""


def _media_rows(docs: DataFrame, id_col: str, text_col: str, columns: pa.Schema, schema: str, make) -> DataFrame:
    """One pass over the texts; ``make()`` gives a function from (id, bytes, media) to rows."""

    def run(batches):
        rows_of = make()
        for batch in batches:
            rows = []
            for doc, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()):
                raw = text.encode("utf-8", "surrogatepass")
                rows += rows_of(doc, raw, encode_wave(pad(raw)))
            yield _rows(rows, columns)

    C.bound_batches(docs.sparkSession)
    picked = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    return picked.mapInArrow(run, schema)


def _pieces(media: bytes) -> list[bytes]:
    ends = cut_points(media)
    return [media[a:b] for a, b in zip([0, *ends], ends)]


def _digest(piece: bytes) -> bytes:
    return hashlib.blake2b(piece, digest_size=DIGEST).digest()


def file_lists(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``media_key, media_sha, media_bytes, digests``: the ordered chunk list of each different file.

    A task lists a file once; the rest is left to the grouping by file.
    """

    def make():
        listed: set[bytes] = set()

        def rows(doc, raw, media):
            sha = hashlib.sha256(media).digest()
            if sha in listed:
                return []
            listed.add(sha)
            return [(sha[:KEY], sha, len(media), b"".join(map(_digest, _pieces(media))))]

        return rows

    every = _media_rows(docs, id_col, text_col, _LISTS, "media_key binary, media_sha binary, media_bytes long, digests binary", make)
    return every.groupBy("media_key", "media_sha").agg(F.first("media_bytes").alias("media_bytes"), F.first("digests").alias("digests"))


def owners(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_bytes, media_key`` of every row."""
    return _media_rows(docs, id_col, text_col, _OWNERS, "doc_id long, n_bytes long, media_key binary", lambda: lambda doc, raw, media: [(doc, len(raw), hashlib.sha256(media).digest()[:KEY])])


def chunk_store(docs: DataFrame, dictionary: bytes = b"", id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One compressed copy of every chunk: ``digest, body``.  A task sends each chunk it meets once."""

    def make():
        press, sent = _compressor(dictionary), set()

        def rows(doc, raw, media):
            out = []
            for piece in _pieces(media):
                digest = _digest(piece)
                if digest not in sent:
                    sent.add(digest)
                    out.append((digest, press.compress(piece)))
            return out

        return rows

    sent = _media_rows(docs, id_col, text_col, _BODIES, "digest binary, body binary", make)
    return sent.groupBy("digest").agg(F.first("body").alias("body"))


def read_back(lists: DataFrame, store: DataFrame, dictionary: bytes = b"") -> DataFrame:
    """Reassemble files from ``lists(media_key, media_sha, media_bytes, digests)`` and the store.

    One row per file: ``media_key, payload_bytes, payload_sha, tail_crc32, media_bytes,
    media_sha, feature, n_chunks``.  A file whose digest does not match raises an error.
    """
    places = F.sequence(F.lit(0), (F.length("digests") / DIGEST - 1).cast("int"))
    asked = lists.select("media_key", "media_sha", F.explode(places).alias("place"), "digests")
    first = F.col("place") == 0  # the whole digest travels with the first chunk only
    asked = asked.select("media_key", F.when(first, F.col("media_sha")).alias("media_sha"), "place", F.substring("digests", F.col("place") * DIGEST + 1, F.lit(DIGEST)).alias("digest"))
    parts = asked.join(store, "digest").select("media_key", "media_sha", "place", "body")

    def files(batches):
        open_press = _decompressor(dictionary)
        now, pieces, due = None, [], b""
        for batch in batches:
            rows = []
            for key, sha, place, body in zip(*(batch.column(c).to_pylist() for c in ("media_key", "media_sha", "place", "body"))):
                if place == 0 or key != now:
                    if now is not None:
                        rows.append(_measure(now, pieces, due))
                    now, pieces, due = key, [], sha
                pieces.append(open_press.decompress(body, max_output_size=MAX_CHUNK * 2))
            yield _rows(rows, _FILES)
        if now is not None:
            yield _rows([_measure(now, pieces, due)], _FILES)

    return parts.repartition("media_key").sortWithinPartitions("media_key", "place").mapInArrow(files, _FILE_SCHEMA)


def media_columns(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Store every text as media, chunk, deduplicate, read back and measure.

    One row per input row: ``doc_id, n_bytes, payload_bytes, payload_sha256, tail_crc32,
    media_bytes, media_sha256, feature, n_chunks``.  Null and empty texts are 64 zero
    bytes; equal texts share all chunks and get equal values; rows with null or repeated
    ids are rows of their own; very long texts are chunked whole; other columns are
    ignored; an empty table gives an empty result.
    """
    dictionary = press_dictionary(docs, id_col, text_col)
    files = read_back(file_lists(docs, id_col, text_col), chunk_store(docs, dictionary, id_col, text_col), dictionary)
    hex_of = lambda c: F.lower(F.hex(c))
    found = owners(docs, id_col, text_col).join(files, "media_key")
    return found.select("doc_id", "n_bytes", "payload_bytes", hex_of("payload_sha").alias("payload_sha256"), "tail_crc32", "media_bytes", hex_of("media_sha").alias("media_sha256"), "feature", "n_chunks")


def _compressor(dictionary: bytes) -> zstandard.ZstdCompressor:
    return zstandard.ZstdCompressor(level=PRESS_LEVEL, dict_data=zstandard.ZstdCompressionDict(dictionary)) if dictionary else zstandard.ZstdCompressor(level=PRESS_LEVEL)


def _decompressor(dictionary: bytes) -> zstandard.ZstdDecompressor:
    return zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(dictionary)) if dictionary else zstandard.ZstdDecompressor()


def _measure(key: bytes, pieces: list[bytes], sha: bytes | None) -> tuple:
    media = b"".join(pieces)
    if hashlib.sha256(media).digest() != sha:
        raise ValueError("a file read back differs from the file stored")
    payload = decode_wave(media)
    return key, len(payload), hashlib.sha256(payload).digest(), zlib.crc32(payload[-UNIT:]), len(media), sha, features(np.frombuffer(payload, np.uint8)), len(pieces)


def _rows(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    cols = list(zip(*rows)) if rows else [[]] * len(schema)
    return pa.RecordBatch.from_arrays([pa.array(list(c), f.type) for c, f in zip(cols, schema)], schema=schema)


def features(payload: np.ndarray) -> str:
    """Mean, deviation, zero crossings about the middle and peak of 8-bit samples."""
    x = payload.astype(np.float64) - 128
    signs = x >= 0
    return f"mean={x.mean():.4f};rms={np.sqrt((x * x).mean()):.4f};zcr={np.count_nonzero(signs[1:] != signs[:-1])};peak={int(np.abs(x).max())}"
