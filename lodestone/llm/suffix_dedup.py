"""Suffix-array dedup with a logarithmic index family.

A byte is removed when a ``length``-byte string that also starts earlier (in order of
document id, then position) covers it.

Finding the text to index.  Every ``length``-byte window has an anchor: its
``gram``-byte substring with the smallest hash (leftmost of ties).  Equal windows have
equal anchors, so only windows whose anchor occurs more than once can match.  Anchors
are counted as keys through cells and buckets (see ``common``); a run of windows with
one repeated anchor, an *extent*, then goes to the bucket of that anchor - once per
cell, as equal extents of a cell can only match at the first of them.

Indexing.  A bucket takes its extents in corpus order, in batches.  Each batch gets a
suffix array (window starts sorted by their ``length`` bytes) and is merge-scanned
against every existing level; windows found there, or twice in the batch, are matches,
and the rest become a new level.  Levels of equal size class merge, so a bucket keeps a
logarithmic number of them and each suffix takes part in that many merges.
"""

from __future__ import annotations

import hashlib
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import common as C

SCHEMA = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept_text binary"
_NULL_ID = np.iinfo(np.int64).min
_ARROW = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()), ("kept_sha256", pa.string()), ("kept_text", pa.binary())])
_KEYS = pa.schema([("cell", pa.int32()), ("bucket", pa.int32()), ("keys", pa.binary())])
_SPANS = pa.schema([("cell", pa.int32()), ("spans", pa.binary())])
#: Windows of one batch of the index; a level of class k holds about 2^k batches.
BATCH_WINDOWS = 1 << 16
#: Text bytes of a cell, and of the corpus for each bucket; a bucket's keys take 100 bytes a window.
CELL_BYTES = 4 << 20
BUCKET_BYTES = 3 << 19


# ---------------------------------------------------------------- the index


def windows_view(text: np.ndarray, length: int) -> np.ndarray:
    """Every window of the text as a fixed-width byte string, without copying."""
    return np.ndarray((len(text) - length + 1,), dtype=f"S{length}", buffer=text, strides=(1,))


class Level:
    """A text and the suffix array of its indexed windows."""

    def __init__(self, text: np.ndarray, suffixes: np.ndarray):
        self.text, self.suffixes = text, suffixes

    def keys(self, length: int) -> np.ndarray:
        return windows_view(self.text, length)[self.suffixes]

    def __len__(self) -> int:
        return len(self.suffixes)


def merge_scan(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Merge two sorted key lists: the merged order, and a mask over ``b`` of keys in ``a``.

    The stable sort recognises the two sorted runs and merges them in linear time.
    """
    both = np.concatenate((a, b))
    order = np.argsort(both, kind="stable")
    both = both[order]
    same = np.append(False, both[1:] == both[:-1])
    from_a = order < len(a)
    group = np.cumsum(~same) - 1
    in_a = np.zeros(len(both), bool)
    in_a[group[from_a]] = True
    hit = np.zeros(len(b), bool)
    hit[order[~from_a] - len(a)] = in_a[group[~from_a]]
    return order, hit


class IndexFamily:
    """Suffix arrays in geometric levels; batches must come in corpus order."""

    def __init__(self, length: int, batch: int = BATCH_WINDOWS):
        self.length, self.batch = length, batch
        self.levels: list[Level] = []

    def add(self, text: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """Index the windows at ``starts`` (in order); mask of those seen before."""
        keys = windows_view(text, self.length)[starts]
        order = np.argsort(keys, kind="stable")
        keys = keys[order]
        seen = np.append(False, keys[1:] == keys[:-1]) if len(keys) else np.zeros(0, bool)
        for level in self.levels:
            todo = np.flatnonzero(~seen)
            if not len(todo):
                break
            _, hit = merge_scan(level.keys(self.length), keys[todo])
            seen[todo[hit]] = True
        out = np.zeros(len(starts), bool)
        out[order[seen]] = True
        fresh = starts[order[~seen]]
        if len(fresh):
            self._push(Level(*self._compact(text, fresh)))
        return out

    def _compact(self, text: np.ndarray, suffixes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Keep only the bytes that the new suffixes need."""
        need = C.cover(suffixes, suffixes + self.length, len(text))
        where = np.cumsum(need) - 1
        return np.ascontiguousarray(text[need]), where[suffixes]

    def _class(self, level: Level) -> int:
        return max(0, int(np.log2(max(1, len(level)) / self.batch) + 1e-9)) if len(level) >= self.batch else 0

    def _push(self, level: Level) -> None:
        self.levels.append(level)
        while len(self.levels) > 1 and self._class(self.levels[-2]) <= self._class(self.levels[-1]):
            b, a = self.levels.pop(), self.levels.pop()
            order, _ = merge_scan(a.keys(self.length), b.keys(self.length))
            suffixes = np.concatenate((a.suffixes, b.suffixes + len(a.text)))[order]
            self.levels.append(Level(np.concatenate((a.text, b.text)), suffixes))


# ---------------------------------------------------------------- anchors and extents


def gram_hashes(buf: np.ndarray, gram: int) -> np.ndarray:
    return C.window_hashes(C._BYTE[buf], gram)


#: Windows whose hashes are held at a time.
HASH_WINDOWS = 1 << 19


def extents(buf: np.ndarray, offs: np.ndarray, length: int, gram: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Anchor hash, first and last window start of each run of windows with one anchor.

    Long buffers are taken in stretches of windows; a run that two of them share is two
    extents, which changes no window's anchor.
    """
    ok = C.inside(offs, len(buf), length)
    parts = [_stretch(buf[a : a + HASH_WINDOWS + length - 1], ok[a : a + HASH_WINDOWS], a, length, gram) for a in range(0, len(ok), HASH_WINDOWS)]
    if not parts:
        z = np.empty(0, np.int64)
        return np.empty(0, C.U64), z, z
    anchor, first, last = (np.concatenate(x) for x in zip(*parts))
    return anchor, first, last


def _stretch(buf: np.ndarray, ok: np.ndarray, base: int, length: int, gram: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    h = gram_hashes(buf, gram)
    pick = C.sliding_argmin(h, length - gram + 1)
    new = np.ones(len(pick), bool)
    new[1:] = (pick[1:] != pick[:-1]) | ~ok[:-1]
    first = np.flatnonzero(new & ok)
    stop = np.ones(len(pick), bool)
    stop[:-1] = new[1:] | ~ok[1:]
    last = np.flatnonzero(stop & ok)
    # smallest hashes are small numbers: mix again, as keys are dealt to buckets by size
    return C.mix(h[pick[first]] ^ C._STEP[0]), first + base, last + base


def _sorted_cell(table: pa.Table) -> tuple[pa.Table, np.ndarray]:
    """Rows in corpus order (null ids first, rows of one id by text) and their ids."""
    table = table.sort_by([("doc_id", "ascending"), ("text", "ascending")])
    filled = table.set_column(table.schema.get_field_index("doc_id"), "doc_id", table.column("doc_id").fill_null(_NULL_ID))
    order = np.argsort(filled.column("doc_id").to_numpy(), kind="stable")
    table, filled = table.take(order), filled.take(order)
    return table, filled.column("doc_id").to_numpy()


def _cell_extents(table: pa.Table, length: int, gram: int, want: np.ndarray | None = None):
    """(document row, anchor, start, end, content hash, bytes) arrays of a cell, batch by batch."""
    buf, offs = C.text_buffer(table.column("text"))
    for i, _, b, o in C.batches(buf, offs, 1 << 20):
        anchor, first, last = extents(b, o, length, gram)
        if want is not None:
            keep = C.member(anchor, want)
            anchor, first, last = anchor[keep], first[keep], last[keep]
        doc = np.searchsorted(o, first, "right") - 1
        yield i, b, o, anchor, first, last + length, doc


def _pack_extents(cell: int, bucket: int, rows: np.ndarray, text: bytes) -> dict:
    """``rows``: document id, row in the cell, start in the document and size, a column each."""
    return {"cell": cell, "bucket": bucket, "rows": zlib.compress(np.ascontiguousarray(rows, "<i8").tobytes(), 1), "text": text}


def _unpack_rows(blob: bytes) -> np.ndarray:
    return np.frombuffer(zlib.decompress(blob), "<i8").reshape(4, -1)


_EXT = pa.schema([("cell", pa.int32()), ("bucket", pa.int32()), ("rows", pa.binary()), ("text", pa.binary())])


def _spans_blob(ids: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> bytes:
    return np.stack((ids, starts, ends)).astype("<i8").tobytes() if len(ids) else b""


def remove_earlier(docs: DataFrame, length: int = 100, gram: int = 20, id_col: str = "doc_id", text_col: str = "text", carry: tuple[str, ...] = (), whole: bool = False) -> DataFrame:
    """Remove every byte that a ``length``-byte string with an earlier occurrence covers.

    One row per input row: ``doc_id, n_bytes, n_removed, n_spans, kept_sha256`` and
    ``kept_text`` (binary, as a cut may fall inside a character).  Null and empty texts
    have no bytes; texts shorter than ``length`` are kept whole; of repeated rows the
    first is kept (rows of one id in order of text).  Columns named in ``carry`` pass
    through; other columns are ignored.  An empty table gives an empty result.  With
    ``whole``, ``kept_text`` is a string without the characters that cuts broke; the
    other columns stay as they are.
    """
    total = C.column_bytes(docs, text_col)
    n_cells, n_buckets = C.parts(total, CELL_BYTES), C.parts(total, BUCKET_BYTES)
    dealt = C.cells(docs, n_cells, id_col, text_col)
    full = C.cells(docs, n_cells, id_col, text_col, carry) if carry else dealt
    kinds = T._parse_datatype_string(SCHEMA)
    if whole:
        kinds["kept_text"].dataType = T.StringType()
    kinds = T.StructType([*kinds.fields, *[docs.schema[c] for c in carry]])

    arrow = _ARROW.set(_ARROW.get_field_index("kept_text"), pa.field("kept_text", pa.string())) if whole else _ARROW

    def ask(key, table):
        got = [anchor for _, _, _, anchor, *_ in _cell_extents(table, length, gram)]
        keys, _ = C.distinct_and_repeated(np.concatenate(got) if got else np.empty(0, C.U64))
        return C.send(key[0].as_py(), keys, n_buckets)

    def ship(key, table, back):
        """Extents with repeated anchors: the first of equal ones goes to its bucket, others are matches."""
        if not table.num_rows:
            return _EXT.empty_table()
        cell = key[0].as_py()
        table, ids = _sorted_cell(table)
        _, local = C.distinct_and_repeated(np.concatenate([a for _, _, _, a, *_ in _cell_extents(table, length, gram)] or [np.empty(0, C.U64)]))
        want = np.union1d(local, C.received(back))
        rows, content, pieces = [], [], []
        for i, b, o, anchor, lo, hi, doc in _cell_extents(table, length, gram, want):
            if not len(anchor):
                continue
            content.append(C.span_hashes(b, lo, hi))
            rows.append(np.stack((anchor.view(np.int64), ids[i + doc], i + doc, lo - o[doc], hi - lo)))
            raw = b.tobytes()
            pieces += [raw[s:e] for s, e in zip(lo.tolist(), hi.tolist())]
        if not rows:
            return _EXT.empty_table()
        rows, content = np.concatenate(rows, axis=1), np.concatenate(content)
        order = np.argsort(content, kind="stable")
        again = np.zeros(len(content), bool)
        again[order[1:]] = content[order[1:]] == content[order[:-1]]
        out = []
        if again.any():
            out.append(_pack_extents(cell, -1 - cell, rows[1:, again], b""))
        bucket = C.bucket_of(rows[0].view(C.U64), n_buckets)
        first = np.flatnonzero(~again)
        first = first[np.argsort(bucket[first], kind="stable")]
        edges = np.flatnonzero(np.append(True, np.diff(bucket[first]) != 0))
        for part in np.split(first, edges[1:]):
            out.append(_pack_extents(cell, int(bucket[part[0]]), rows[1:, part], b"".join([pieces[k] for k in part.tolist()])))
        return pa.Table.from_pylist(out, schema=_EXT)

    def match(key, table):
        """The matched spans of a bucket's extents, by cell; negative buckets hold whole matches."""
        r = table.to_pydict()
        lists = [_unpack_rows(x) for x in r["rows"]]
        if key[0].as_py() < 0:
            return pa.table({"cell": r["cell"], "spans": [_spans_blob(x[1], x[2], x[2] + x[3]) for x in lists]}, schema=_SPANS)
        owner = np.repeat(np.array(r["cell"]), [x.shape[1] for x in lists])
        ids, places, starts, sizes = np.concatenate(lists, axis=1)
        text = np.frombuffer(b"".join(r["text"]), np.uint8)
        at = np.cumsum(sizes) - sizes
        order = np.lexsort((starts, places, owner, ids))
        found = _match_in_order(text, at[order], sizes[order], length)
        ext = order[found[0]]
        lo, hi = found[1] + starts[ext], found[2] + starts[ext]
        out_cells, out = [], []
        by = np.argsort(owner[ext], kind="stable")
        edges = np.flatnonzero(np.append(True, np.diff(owner[ext][by]) != 0)) if len(by) else []
        for part in np.split(by, edges[1:]) if len(by) else []:
            out_cells.append(int(owner[ext[part[0]]]))
            out.append(_spans_blob(places[ext[part]], lo[part], hi[part]))
        return pa.table({"cell": pa.array(out_cells, pa.int32()), "spans": pa.array(out, pa.binary())})

    def finish(key, table, back):
        if not table.num_rows:
            return pa.schema([*arrow, *[table.schema.field(c) for c in carry]]).empty_table()
        table, ids = _sorted_cell(table)
        blobs = [np.frombuffer(x, "<i8").reshape(3, -1) for x in back.column("spans").to_pylist()]
        spans = np.concatenate(blobs, axis=1) if blobs else np.empty((3, 0), np.int64)
        buf, offs = C.text_buffer(table.column("text"))
        doc = spans[0]
        gone = C.cover(offs[doc] + spans[1], offs[doc] + spans[2], len(buf))
        broken = _whole_characters(buf, gone) if whole else gone
        out: dict[str, list] = {n: [] for n in _ARROW.names}
        for d in range(len(ids)):
            g = gone[offs[d] : offs[d + 1]]
            kept = buf[offs[d] : offs[d + 1]][~g].tobytes()
            out["n_bytes"].append(len(g))
            out["n_removed"].append(len(g) - len(kept))
            out["n_spans"].append(int(g[:1].sum() + (g[1:] & ~g[:-1]).sum()))
            out["kept_sha256"].append(hashlib.sha256(kept).hexdigest())
            out["kept_text"].append(buf[offs[d] : offs[d + 1]][~broken[offs[d] : offs[d + 1]]].tobytes().decode("utf-8", "replace") if whole else kept)
        out["doc_id"] = table.column("doc_id")
        done = pa.table(out, schema=arrow)
        for c in carry:
            done = done.append_column(c, table.column(c))
        return done

    sent = dealt.groupBy("cell").applyInArrow(C.tidy(ask), "cell int, bucket int, keys binary")
    answers = C.shared_keys(sent)
    shipped = dealt.groupBy("cell").cogroup(answers.groupBy("cell")).applyInArrow(C.tidy(ship), "cell int, bucket int, rows binary, text binary")
    spans = shipped.groupBy("bucket").applyInArrow(C.tidy(match), "cell int, spans binary")
    return full.groupBy("cell").cogroup(spans.groupBy("cell")).applyInArrow(C.tidy(finish), kinds)


def dedup_texts(docs: DataFrame, length: int = 100, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with the text that stays; characters that a cut broke are left out.

    All columns pass through under their names, whatever they are.  Null texts become
    empty, rows with a null id count as the earliest, and of equal rows the first keeps
    its text.  An empty table gives an empty result.
    """
    others = [c for c in docs.columns if c not in (id_col, text_col)]
    carried = {c: f"_carried_{k}" for k, c in enumerate(others)}  # the operator's own columns clash with none of these
    renamed = docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").alias("text"), *[F.col(f"`{c}`").alias(n) for c, n in carried.items()])
    left = remove_earlier(renamed, length, carry=tuple(carried.values()), whole=True)
    back = {id_col: "doc_id", text_col: "kept_text", **carried}
    return left.select(*[F.col(back[c]).cast(docs.schema[c].dataType).alias(c) for c in docs.columns])


def _whole_characters(buf: np.ndarray, gone: np.ndarray) -> np.ndarray:
    """``gone`` with every UTF-8 character of which it has a byte; bytes of two cuts never make up a new one."""
    if not len(buf):
        return gone
    char = np.cumsum((buf & 0xC0) != 0x80)
    return (np.bincount(char, weights=gone, minlength=int(char[-1]) + 1) > 0)[char]


def _match_in_order(text: np.ndarray, at: np.ndarray, sizes: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Feed extents to an index family; (extent, span start, span end) relative to the extents."""
    family = IndexFamily(length)
    n_windows = sizes - length + 1
    batch = np.cumsum(n_windows) // family.batch
    ext_out, lo_out, hi_out = [], [], []
    for part in np.split(np.arange(len(at)), np.flatnonzero(np.diff(batch)) + 1) if len(at) else []:
        raw = np.concatenate([text[a : a + s] for a, s in zip(at[part].tolist(), sizes[part].tolist())])
        base = np.cumsum(sizes[part]) - sizes[part]
        n = n_windows[part]
        ext = np.repeat(np.arange(len(part)), n)
        rel = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
        hit = family.add(raw, base[ext] + rel)
        if hit.any():
            e, r = ext[hit], rel[hit]
            new = np.append(True, (e[1:] != e[:-1]) | (r[1:] > r[:-1] + length))
            head = np.flatnonzero(new)
            tail = np.append(head[1:], len(e)) - 1
            ext_out.append(part[e[head]])
            lo_out.append(r[head])
            hi_out.append(r[tail] + length)
    z = np.empty(0, np.int64)
    return (np.concatenate(ext_out), np.concatenate(lo_out), np.concatenate(hi_out)) if ext_out else (z, z, z)
