"""SentencePiece encoding and decoding by suffix-array matching.

The words of a batch (a space mark plus the letters up to the next space mark) are put
end to end once each, and a suffix array over that text is built by doubling.  Every
vocabulary piece is binary-searched in it, which gives all places where the piece
occurs; the occurrences, sorted by position, are the edges of a lattice.  The lattice is
then relaxed: each round joins, in every word at once, the neighbouring pair whose
merged edge has the best score (the leftmost of ties), until no word has one.  This is
the merge order of the vocabulary's own library, so the ids are equal to its ids;
characters without an edge become byte pieces.
"""

from __future__ import annotations

import bisect
import heapq
import zlib
from array import array

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common as C
from .bpe import tokenizer_file

MARK = "▁"
#: Characters of distinct words that one suffix array covers.
BATCH_CHARS = 400_000
#: Longer words are relaxed one by one with a heap, in time linear (but for a logarithm) in their length.
LONG_WORD = 128
SCHEMA = "doc_id long, n_pieces long, ids_crc32 long, round_trip boolean, ids array<int>"


class Pieces:
    """A BPE piece vocabulary with byte fallback, read from a model file."""

    _shared: dict[str, "Pieces"] = {}

    def __init__(self, path: str):
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        self.processor = sp
        n = sp.get_piece_size()
        normal = [i for i in range(n) if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i) or sp.is_unused(i))]
        self.text = {i: sp.id_to_piece(i) for i in normal}
        self.bytes = np.full(256, sp.unk_id(), np.int32)
        for i in range(n):
            if sp.is_byte(i):
                self.bytes[int(sp.id_to_piece(i)[3:-1], 16)] = i
        #: Bytes that each id stands for; control and unknown ids stand for none.
        self.raw = [b""] * n
        for i, t in self.text.items():
            self.raw[i] = t.encode()
        for b, i in enumerate(self.bytes.tolist()):
            self.raw[i] = bytes([b])
        order = sorted(normal, key=lambda i: self.text[i])
        self.ids = np.array(order, np.int32)
        self.score = np.array([sp.get_score(i) for i in order])
        self.rank = np.argsort(np.argsort(-self.score, kind="stable"), kind="stable").astype(np.int64)
        self.codes = [np.array([ord(c) for c in self.text[i]], np.uint32) for i in order]
        self.length = np.array([len(c) for c in self.codes])
        self.known: dict[str, bytes] = {}

    @classmethod
    def shared(cls, path: str) -> "Pieces":
        if path not in cls._shared:
            cls._shared[path] = cls(path)
        return cls._shared[path]


# ---------------------------------------------------------------- suffix array


def suffix_ranks(text: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """Suffix array of ``text`` compared on ``depth`` symbols, by doubling, and the ranks."""
    n = len(text)
    _, rank = np.unique(text, return_inverse=True)
    rank, span = rank.astype(np.int64) + 1, 1
    order = np.argsort(rank, kind="stable")
    while span < depth and n:
        second = np.zeros(n, np.int64)
        second[: n - span] = rank[span:] if span < n else 0
        key = rank * (n + 2) + second
        order = np.argsort(key, kind="stable")
        k = key[order]
        new = np.cumsum(np.append(True, k[1:] != k[:-1]))
        rank = np.empty(n, np.int64)
        rank[order] = new
        span *= 2
        if new[-1] == n:
            break
    return order, rank


def find_edges(text: np.ndarray, pieces: Pieces) -> tuple[np.ndarray, np.ndarray]:
    """All occurrences of all pieces in ``text``: (position, piece row), by position and length.

    The pieces are binary-searched together, a symbol a step: after step k each has the
    range of suffixes that start with its first k symbols.
    """
    n = len(text)
    depth = int(pieces.length.max())
    sa, _ = suffix_ranks(text, depth)
    lo, hi = np.zeros(len(pieces.codes), np.int64), np.full(len(pieces.codes), n, np.int64)
    padded = np.append(text, np.zeros(depth + 1, text.dtype))
    for k in range(depth):
        live = np.flatnonzero((pieces.length > k) & (lo < hi))
        if not len(live):
            break
        want = np.array([pieces.codes[p][k] for p in live.tolist()], text.dtype)
        lo[live], hi[live] = _narrow(padded, sa, lo[live], hi[live], want, k, False), _narrow(padded, sa, lo[live], hi[live], want, k, True)
    found = np.flatnonzero(lo < hi)
    count = hi[found] - lo[found]
    piece = np.repeat(found, count)
    at = sa[np.repeat(lo[found], count) + np.arange(int(count.sum())) - np.repeat(np.cumsum(count) - count, count)]
    order = np.lexsort((pieces.length[piece], at))
    return at[order], piece[order]


def _narrow(text, sa, lo, hi, want, k, upper: bool) -> np.ndarray:
    """Bounds, within [lo, hi), of suffixes whose symbol ``k`` is ``want``: first, or one past the last."""
    lo, hi = lo.copy(), hi.copy()
    while True:
        go = np.flatnonzero(lo < hi)
        if not len(go):
            return lo
        mid = (lo[go] + hi[go]) // 2
        c = text[sa[mid] + k]
        right = c <= want[go] if upper else c < want[go]
        lo[go[right]] = mid[right] + 1
        hi[go[~right]] = mid[~right]


# ---------------------------------------------------------------- relaxing


def encode_words(words: list[str], pieces: Pieces) -> list[bytes]:
    """Piece ids (little-endian uint16) of words that no piece crosses."""
    if not words:
        return []
    sizes = np.array([len(w) for w in words])
    text = np.frombuffer("\0".join(words).encode("utf-32-le") + b"\0\0\0\0", np.uint32)
    first = np.cumsum(sizes + 1) - sizes - 1
    at, piece = find_edges(text, pieces)
    edge_key = at * 256 + pieces.length[piece]
    edge_rank = pieces.rank[piece]
    done_pos, done_width = [], []
    for k in np.flatnonzero(sizes > LONG_WORD).tolist():
        lo, hi = np.searchsorted(edge_key, (first[k] * 256, (first[k] + sizes[k]) * 256))
        width = _relax_long(int(sizes[k]), edge_key[lo:hi] - first[k] * 256, edge_rank[lo:hi])
        done_pos.append(first[k] + np.flatnonzero(width))
        done_width.append(width[width > 0])
    # symbols: one per character at first
    short = np.flatnonzero(sizes <= LONG_WORD)
    word = np.repeat(short, sizes[short])
    pos = np.arange(len(word)) - np.repeat(np.cumsum(sizes[short]) - sizes[short] - first[short], sizes[short])
    width = np.ones(len(pos), np.int64)
    big = np.int64(1) << 40

    def look_up(p, w):
        key = p * 256 + w
        i = np.minimum(np.searchsorted(edge_key, key), max(len(edge_key) - 1, 0))
        return np.where(edge_key[i] == key, edge_rank[i], big) if len(edge_key) else np.full(len(p), big)

    while len(pos):
        pair = np.full(len(pos), big)
        same = np.flatnonzero(word[1:] == word[:-1])
        pair[same] = look_up(pos[same], width[same] + width[same + 1])
        # the best pair of each word, leftmost of ties
        starts = np.flatnonzero(np.append(True, word[1:] != word[:-1]))
        best = np.minimum.reduceat(pair, starts)
        n_in = np.diff(np.append(starts, len(pos)))
        best_each = np.repeat(best, n_in)
        ended = best_each == big
        if ended.any():
            done_pos.append(pos[ended])
            done_width.append(width[ended])
            keep = ~ended
            pos, width, word, pair, best_each = pos[keep], width[keep], word[keep], pair[keep], best_each[keep]
            if not len(pos):
                break
        hits = np.flatnonzero(pair == best_each)
        lead = hits[np.append(True, word[hits[1:]] != word[hits[:-1]])]
        width[lead] += width[lead + 1]
        drop = np.ones(len(pos), bool)
        drop[lead + 1] = False
        pos, width, word = pos[drop], width[drop], word[drop]
    pos, width = np.concatenate(done_pos), np.concatenate(done_width)
    order = np.argsort(pos, kind="stable")
    pos, width = pos[order], width[order]
    key = pos * 256 + width
    i = np.minimum(np.searchsorted(edge_key, key), max(len(edge_key) - 1, 0))
    ok = edge_key[i] == key if len(edge_key) else np.zeros(len(key), bool)
    ids = np.where(ok, pieces.ids[piece[i]] if len(piece) else 0, -1).astype(np.int64)
    cuts = np.append(np.searchsorted(pos, first), len(pos))
    raw = np.where(ok, ids, 0).astype("<u2").tobytes()
    out = [raw[2 * a : 2 * b] for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist())]
    for w in np.unique(np.searchsorted(cuts, np.flatnonzero(~ok), "right") - 1).tolist():
        a, b = cuts[w], cuts[w + 1]
        row = np.concatenate([[v] if v >= 0 else pieces.bytes[list(chr(text[p]).encode())] for v, p in zip(ids[a:b].tolist(), pos[a:b].tolist())])
        out[w] = row.astype("<u2").tobytes()
    return out


def _relax_long(n: int, keys: np.ndarray, ranks: np.ndarray) -> np.ndarray:
    """Widths of the symbols that begin at each character of one long word (0: none does).

    The same merge order as in rounds, best edge first and leftmost of ties, kept in a
    heap: a round a merge would look at the whole word each time.
    """
    known, rank = array("q", keys.astype(np.int64).tobytes()), ranks.tolist()
    width, before, heap = [1] * n, list(range(-1, n - 1)), []

    def offer(p: int) -> None:
        q = p + width[p]
        if q < n:
            key = p * 256 + width[p] + width[q]
            i = bisect.bisect_left(known, key)
            if i < len(known) and known[i] == key:
                heapq.heappush(heap, (rank[i], p, width[p] + width[q]))

    for p in range(n - 1):
        offer(p)
    while heap:
        _, p, w = heapq.heappop(heap)
        q = p + width[p]
        if not width[p] or q >= n or width[p] + width[q] != w:
            continue  # one of the two has merged with another since
        width[p], width[q] = w, 0
        if p + w < n:
            before[p + w] = p
        offer(p)
        if before[p] >= 0:
            offer(before[p])
    return np.array(width, np.int64)


def normalize(text: str) -> str:
    """The model's text: a space mark in front and for every space; other characters stay."""
    return MARK + text.replace(" ", MARK) if text else ""


def _split(marked: str) -> list[str]:
    """Words: runs that begin with a mark; pieces never hold a mark after another symbol."""
    return [MARK + w for w in marked[1:].split(MARK)] if marked else []


def encode_batch(texts: list[str], pieces: Pieces, limit: int = BATCH_CHARS) -> list[bytes]:
    """Ids of texts; words not met before by this worker are matched batch by batch."""
    lists = [_join_marks(_split(normalize(t))) for t in texts]
    known = pieces.known
    new = sorted({w for ws in lists for w in ws if w not in known})
    if len(known) + len(new) > 1_000_000:
        known.clear()
        new = sorted({w for ws in lists for w in ws})
    part, size = [], 0
    for w in [*new, None]:
        if part and (w is None or size + len(w) > limit):
            known.update(zip(part, encode_words(part, pieces)))
            part, size = [], 0
        if w is not None:
            part.append(w)
            size += len(w) + 1
    return [b"".join([known[w] for w in ws]) for ws in lists]


def _join_marks(words: list[str]) -> list[str]:
    """Runs of spaces stay with the word after them, as pieces of several marks exist."""
    if MARK not in words:
        return words
    out, run = [], ""
    for w in words:
        if w == MARK:
            run += w
        else:
            out.append(run + w)
            run = ""
    return [*out, run] if run else out


def decode(ids: np.ndarray, pieces: Pieces) -> str:
    """The text of piece ids; byte pieces are joined before they are read as UTF-8."""
    text = b"".join(map(pieces.raw.__getitem__, ids.tolist())).decode("utf-8", "replace").replace(MARK, " ")
    return text[1:]


def encode_documents(docs: DataFrame, model: str | None = None, with_ids: bool = True, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_pieces, ids_crc32, round_trip, ids`` for every row.

    ``ids_crc32`` is over the ids as little-endian unsigned 32-bit numbers; ``round_trip``
    tells whether decoding gives the text back (a text that itself holds the space mark
    does not).  Without ``with_ids`` the ids column is null.  Null and empty texts have no
    pieces.  Rows with null or repeated ids are rows of their own.  Very long texts, also
    such without spaces, are encoded whole.  Other columns are ignored; an empty table
    gives an empty result.
    """
    path = model or tokenizer_file("piece_bpe_32k.model")

    def run(batches):
        pieces = Pieces.shared(path)
        for batch in batches:
            texts = batch.column("text").to_pylist()
            ids = [np.frombuffer(b, "<u2").astype("<u4") for b in encode_batch(texts, pieces)]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array([len(x) for x in ids], pa.int64()),
                    pa.array([zlib.crc32(x.tobytes()) for x in ids], pa.int64()),
                    pa.array([decode(x, pieces) == t for x, t in zip(ids, texts)]),
                    pa.array([x.astype(np.int32) if with_ids else None for x in ids], pa.list_(pa.int32())),
                ],
                names=["doc_id", "n_pieces", "ids_crc32", "round_trip", "ids"],
            )

    C.bound_batches(docs.sparkSession)
    picked = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    return picked.mapInArrow(run, SCHEMA)


def decode_documents(encoded: DataFrame, model: str | None = None) -> DataFrame:
    """``doc_id, text`` from ``doc_id, ids``."""
    path = model or tokenizer_file("piece_bpe_32k.model")

    def run(batches):
        pieces = Pieces.shared(path)
        for batch in batches:
            texts = [decode(np.array(x or [], np.int64), pieces) for x in batch.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(texts, pa.string())], names=["doc_id", "text"])

    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id long, text string")
