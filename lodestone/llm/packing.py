"""Hierarchical multi-length packing.

Documents become token ids (public BPE vocabulary plus an end id) and are routed to
context tiers, powers of two up to the longest window.  Long documents fill whole windows
of the top tier; what is left of each goes to the tier that holds it.  Each tier is packed
into windows of its own size, and the gaps of longer windows are filled from shorter
tiers.  A full window of any tier ends at a power of two and needs no padding.

Scale: documents are dealt to groups by a hash of their id.  Each group packs itself, so
no group is larger than its share of the corpus and a packing never needs a global
order.  ``balance`` deals the finished windows of every tier to training-step groups
with equal token counts.
"""

from __future__ import annotations

import bisect
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from . import common as C
from .bpe import CachedBPE, tokenizer_file

END_ID = 1
#: Text bytes that one packing group holds on average.
GROUP_BYTES = 12 << 20
SCHEMA = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, tier int, step_group long"
_ARROW = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64()), ("doc_tokens", pa.int64()), ("sequence_id", pa.int64()), ("offset", pa.int64()), ("tier", pa.int32()), ("step_group", pa.int64())])
#: A group's sequence ids start at its number times this.
GROUP_STRIDE = 1 << 32


def tier_of(n: int, window: int, smallest: int = 128) -> int:
    """The smallest tier (a power of two from ``smallest``) that holds ``n`` tokens."""
    t = smallest
    while t < n and t < window:
        t *= 2
    return t


def pack(sizes: list[int], window: int = 2048, smallest: int = 128) -> list[list[tuple[int, int, int]]]:
    """Sequences of (document, start, length), each at most ``window`` tokens.

    Whole windows of long documents come first; what is left of each document waits in
    its tier.  Then each tier is packed, the longest first: every piece of a tier opens a
    window of that tier's size, largest first, and the gap behind it is filled from the
    shorter tiers, always with the longest piece that fits.  If none fits, a piece of the
    shortest tier is cut to the gap and its rest waits in the tier that holds it.  So all
    windows are full but the last one that is opened.
    """
    done: list[list[tuple[int, int, int]]] = []
    waiting: dict[int, list[tuple[int, int, int]]] = {}  # tier: (length, -document, start), ascending
    for d, n in enumerate(sizes):
        at = n - n % window
        done += [[(d, k, window)] for k in range(0, at, window)]
        if n > at:
            waiting.setdefault(tier_of(n - at, window, smallest), []).append((n - at, -d, at))
    for pieces in waiting.values():
        pieces.sort()
    tier = tier_of(window, window, smallest)
    while True:
        pieces = waiting.get(tier, [])
        while pieces:
            n, d, at = pieces.pop()
            seq, room = [(-d, at, n)], min(tier, window) - n
            while room and (piece := _filler(waiting, tier, room, window, smallest)):
                seq.append(piece)
                room -= piece[2]
            done.append(seq)
        if tier <= smallest:
            return done
        tier //= 2


def _filler(waiting: dict[int, list[tuple[int, int, int]]], tier: int, room: int, window: int, smallest: int) -> tuple[int, int, int] | None:
    """A piece of at most ``room`` tokens from ``tier`` or a shorter one, cut if no whole piece fits."""
    t = min(tier, tier_of(room, window, smallest))
    while t >= smallest:
        pieces = waiting.get(t, [])
        k = bisect.bisect_right(pieces, (room, 1))
        if k:
            n, d, at = pieces.pop(k - 1)
            return -d, at, n
        t //= 2
    t = smallest
    while t <= tier and not waiting.get(t):
        t *= 2
    if t > tier:
        return None
    n, d, at = waiting[t].pop()
    bisect.insort(waiting.setdefault(tier_of(n - room, window, smallest), []), (n - room, d, at + room))
    return -d, at, room


def pack_documents(docs: DataFrame, window: int = 2048, tokenizer: str | None = None, step_tokens: int = 1 << 16, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Pack every document; one row per piece.

    Null and empty texts are one end id.  Every id lies in exactly one piece, a piece
    never exceeds a window, offsets within a sequence run gapless from 0.  ``tier`` is
    the size of the sequence's window, ``step_group`` the training step it belongs to
    (about ``step_tokens`` tokens each, tier by tier).  Ties are taken in order of id and
    text.  Very long texts are tokenized whole and fill windows of their own.  Repeated
    rows, and rows with null ids, are packed as often as they occur.  Other columns are
    ignored; an empty table gives an empty result.
    """
    path = tokenizer or tokenizer_file("word_bpe_49k.json")
    groups = C.parts(C.column_bytes(docs, text_col), GROUP_BYTES)
    dealt = C.cells(docs, groups, id_col, text_col)

    def tokenize(batches):
        bpe = CachedBPE.shared(path)
        for batch in batches:
            ids = [bpe.encode(t) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("cell"), batch.column("doc_id"), pa.array(ids, pa.binary())], names=["cell", "doc_id", "ids"])

    def run(key, table):
        table = table.sort_by([("doc_id", "ascending"), ("ids", "ascending")])
        ids = [np.append(np.frombuffer(b, "<u2"), np.uint16(END_ID)).astype("<u4") for b in table.column("ids").to_pylist()]
        names = table.column("doc_id").to_pylist()
        sequences = pack([len(x) for x in ids], window)
        base = key[0].as_py() * GROUP_STRIDE
        used = np.array([sum(p[2] for p in s) for s in sequences], np.int64)
        tiers = np.array([tier_of(int(n), window) for n in used], np.int64)
        step = balance(used, tiers, step_tokens)
        rows = []
        for s, seq in enumerate(sequences):
            offset = 0
            for d, at, n in seq:
                rows.append((names[d], at, n, zlib.crc32(ids[d][at : at + n].tobytes()), len(ids[d]), base + s, offset, int(tiers[s]), base + int(step[s])))
                offset += n
        return pa.table([list(c) for c in zip(*rows)] if rows else [[]] * len(_ARROW), schema=_ARROW)

    ids = dealt.mapInArrow(C.tidy(tokenize), "cell int, doc_id long, ids binary")
    return ids.groupBy("cell").applyInArrow(C.tidy(run), SCHEMA)


def balance(used: np.ndarray, tiers: np.ndarray, step_tokens: int) -> np.ndarray:
    """Deal sequences to steps: within a tier, largest to the step with the fewest tokens.

    The number of steps of a tier is its tokens over ``step_tokens``; dealing in snake
    order (forth and back) over sizes keeps the steps within one sequence of each other.
    """
    step = np.zeros(len(used), np.int64)
    base = 0
    for t in np.unique(tiers):
        at = np.flatnonzero(tiers == t)
        at = at[np.argsort(-used[at], kind="stable")]
        n = max(1, int(round(used[at].sum() / step_tokens)))
        lap, pos = np.divmod(np.arange(len(at)), n)
        step[at] = base + np.where(lap % 2 == 0, pos, n - 1 - pos)
        base += n
    return step


def padding(pieces: DataFrame, window: int = 2048) -> DataFrame:
    """Per tier: sequences, tokens and padding (none where the content is a power of two)."""
    used = pieces.groupBy("sequence_id").agg(F.sum("length").alias("used"), F.first("tier").alias("tier"))
    full = F.when(F.col("used") == F.col("tier"), F.col("used")).otherwise(F.lit(window))
    return used.groupBy("tier").agg(F.count("*").alias("sequences"), F.sum("used").alias("tokens"), F.sum(full - F.col("used")).alias("padding"))

