"""Substring dedup by level-wise doubling.

A window of ``window`` words that occurs twice anywhere makes its words removable.
Counting every such window of the corpus would move one key per word.  Instead:

* level 1 counts short windows (``base`` words), and of these only the ones that are
  the smallest by hash within some full window - equal full windows have equal such
  anchors, so nothing is lost and about one word in ten sends a key;
* a window repeated at one length alone is extended to twice that length (the last
  step stops at ``window`` words); the others are dropped, until a level has no
  candidates left or the full length is reached.

Keys travel as described in ``common``: once per cell, so frequent passages and large
groups of copies cost one entry per cell and level.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common as C

SCHEMA = "doc_id long, n_words long, n_removed long, kept_sha256 string, kept_text string"
_ARROW = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()), ("kept_sha256", pa.string()), ("kept_text", pa.string())])


def level_lengths(window: int, base: int) -> list[int]:
    """base, 2 base, 4 base, ... with ``window`` as the last."""
    out = [min(base, window)]
    while out[-1] < window:
        out.append(min(out[-1] * 2, window))
    return out


def _words(table: pa.Table):
    buf, offs = C.text_buffer(table.column("text"))
    for i, j, b, o in C.batches(buf, offs):
        starts, ends, first = C.word_spans(b, o)
        yield i, j, b, starts, ends, first, C.span_hashes(b, starts, ends)


def _anchors(h: np.ndarray, first: np.ndarray, window: int, base: int):
    """Per valid full window: hash of its anchor, and the window starts."""
    ok = np.flatnonzero(C.inside(first, len(h), window))
    if not len(ok):
        return np.empty(0, C.U64), ok
    short = C.window_hashes(h, base)
    at = C.sliding_argmin(short, window - base + 1)
    return _anchor_keys(short[at[ok]]), ok


def _anchor_keys(h: np.ndarray) -> np.ndarray:
    """Smallest hashes are small numbers: mix again, as keys are dealt to buckets by size."""
    return C.mix(h ^ C._STEP[0])


def _candidates(h, first, lengths, survivors, window):
    """Starts of full windows all of whose counted parts survived the levels so far."""
    key, at = _anchors(h, first, window, lengths[0])
    keep = C.member(key, survivors[0]) if survivors else np.ones(len(key), bool)
    at = at[keep]
    for length, alive in zip(lengths[1:], survivors[1:]):
        if not len(at):
            break
        wh = C.window_hashes(h, length)
        at = at[C.member(wh[at], alive) & C.member(wh[at + window - length], alive)]
    return at


def remove_repeats(docs: DataFrame, window: int = 35, base: int = 18, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Remove every word that a repeated ``window``-word window covers.

    Returns one row per input row: ``doc_id, n_words, n_removed, kept_sha256`` and
    ``kept_text`` (kept words joined by one space).  Null and empty texts have no
    words; a text shorter than the window is kept whole.  Repeated rows count as
    occurrences of their own.  Columns other than the id and the text are ignored, so
    clashing names do no harm.  An empty table gives an empty result.
    """
    total = C.column_bytes(docs, text_col)
    n_cells, n_buckets = C.parts(total, C.CELL_BYTES), C.parts(total, C.BUCKET_BYTES)
    dealt = C.cells(docs, n_cells, id_col, text_col)
    lengths = level_lengths(window, base)

    def keys_of(table: pa.Table, survivors: list[np.ndarray]) -> np.ndarray:
        """The next level's keys of a cell, occurrence by occurrence."""
        level, out = len(survivors), []
        for *_, first, h in _words(table):
            if level == 0:
                at = np.flatnonzero(C.inside(first, len(h), window))
                if len(at):
                    short = C.window_hashes(h, lengths[0])
                    pick = np.unique(C.sliding_argmin(short, window - lengths[0] + 1)[at])
                    out.append(_anchor_keys(short[pick]))
                continue
            at = _candidates(h, first, lengths, survivors, window)
            if len(at):
                wh = C.window_hashes(h, lengths[level])
                both = at if lengths[level] == window else np.unique(np.concatenate((at, at + window - lengths[level])))
                out.append(wh[both])
        return np.concatenate(out) if out else np.empty(0, C.U64)

    def survive(table: pa.Table, answers: list[np.ndarray]) -> list[np.ndarray]:
        """Per level so far, the sorted keys of this cell that are repeated anywhere."""
        found: list[np.ndarray] = []
        for level in range(len(answers)):
            _, local = C.distinct_and_repeated(keys_of(table, found))
            found.append(np.union1d(local, answers[level]))
        return found

    def ask(level: int):
        def run(key, table: pa.Table, *back: pa.Table) -> pa.Table:
            answers = _by_level(back[0], level) if back else []
            keys, _ = C.distinct_and_repeated(keys_of(table, survive(table, answers)))
            return C.send(key[0].as_py(), keys, n_buckets)

        if level == 0:
            return lambda key, table: run(key, table)
        return lambda key, table, back: run(key, table, back)

    def _by_level(back: pa.Table, levels: int) -> list[np.ndarray]:
        tags = back.column("level").to_numpy(zero_copy_only=False) if back.num_rows else np.empty(0, np.int32)
        return [C.received(back.filter(pa.array(tags == k))) if back.num_rows else np.empty(0, C.U64) for k in range(levels)]

    def finish(key, table, back):
        survivors = survive(table, _by_level(back, len(lengths)))
        out: dict[str, list] = {n: [] for n in _ARROW.names}
        for i, j, b, starts, ends, first, h in _words(table):
            at = _candidates(h, first, lengths, survivors[:-1], window)
            if len(at):
                at = at[C.member(C.window_hashes(h, window)[at], survivors[-1])]
            gone = C.cover(at, at + window, len(h))
            raw = b.tobytes()
            for d in range(j - i):
                lo, hi = first[d], first[d + 1]
                keep = np.flatnonzero(~gone[lo:hi]) + lo
                text = b" ".join([raw[s:e] for s, e in zip(starts[keep].tolist(), ends[keep].tolist())])
                out["n_words"].append(int(hi - lo))
                out["n_removed"].append(int(hi - lo - len(keep)))
                out["kept_sha256"].append(hashlib.sha256(text).hexdigest())
                out["kept_text"].append(text.decode("utf-8", "replace"))
        out["doc_id"] = table.column("doc_id")
        return pa.table(out, schema=_ARROW)

    answers = None
    for level in range(len(lengths)):
        if answers is None:
            sent = dealt.groupBy("cell").applyInArrow(ask(0), "cell int, bucket int, keys binary")
        else:
            sent = dealt.groupBy("cell").cogroup(answers.groupBy("cell")).applyInArrow(_guard(ask(level)), "cell int, bucket int, keys binary")
        back = C.shared_keys(sent).withColumn("level", F.lit(level))
        answers = back if answers is None else answers.unionByName(back)
    return dealt.groupBy("cell").cogroup(answers.groupBy("cell")).applyInArrow(_guard(finish, _ARROW), SCHEMA)


def _guard(f, schema: pa.Schema | None = None):
    """A cell without documents cannot answer; it yields no rows."""
    empty = (schema or pa.schema([("cell", pa.int32()), ("bucket", pa.int32()), ("keys", pa.binary())])).empty_table()

    def run(key, left, right):
        return f(key, left, right) if left.num_rows else empty

    return run
