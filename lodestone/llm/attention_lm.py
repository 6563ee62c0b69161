"""LM scoring with a causal self-attention model in numpy on subword ids.

A text is lower-cased words and an end; each word, with a space in front, becomes ids of
a public byte-level BPE vocabulary.  The model predicts each id from the ids before it in
its document.  Its softmax is over the ``HEAD`` most frequent ids and a few groups of all
others; an id of a group is then drawn by its share of the group over all training
documents, after the same last symbol where it is frequent enough to be counted so.  The
logits are the log shares of what follows the last id in all training documents (a table
of symbol pairs) plus the output of a self-attention layer, so attention learns what
pairs alone do not tell.

Coding.  Each cell of documents is coded once: its distinct words, the ids of each, and
the place of every token among them.  Counts, training and scores start from there.

Training.  Symbols, pair and id counts come from every training document.  So does the
layer: each cell goes once over every symbol of its training documents, all cells from
common weights, and the cells' weights are averaged by Spark.  The common weights come
from passages drawn by a hash from all training documents, in shards of bounded size and
rounds of averaging; without them the cells' layers would differ too much to be averaged.

Scoring.  A document is cut, from its own start, into overlapping windows of ``WINDOW``
symbols, ``STRIDE`` apart; an id is scored once, in the window where it has at least
WINDOW - STRIDE symbols before it, or all there are.  A batch of windows is a few matrix
products with a causal mask.  What stands in other documents never matters.

The base score needs the count of each token over all training documents.  Cells ask the
buckets of ``common`` for their distinct words, so each word costs an entry per cell.
"""

from __future__ import annotations

import base64
import zlib
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common as C
from .bpe import tokenizer_file

WINDOW, STRIDE = 24, 16
#: Width of the layer; ids with a symbol of their own; groups of the other ids; ids that
#: are counted after each symbol, the others by their group.
DIM, HEAD, GROUPS, COUNTED = 16, 248, 8, 2048
#: Symbols that are predicted, and the one that stands before a document.
OUT = HEAD + GROUPS
START = OUT
#: Counted ids, then one for the other ids of each group.
FINE = COUNTED + GROUPS
#: Weight of the single shares in the shares of pairs.
PAIR_PRIOR = 8.0
#: Characters of a passage; passages drawn at least (if there are so many) and as a share of all.
PASSAGE, LEAST_PASSAGES, PASSAGE_SHARE = 1024, 2_000, 1 / 500
#: Passages of a shard; rounds of averaging; descent steps a round; windows of a step.
SHARD, ROUNDS, STEPS, BATCH = 1_000, 2, 800, 32
#: Rate of the pass over all training documents, and windows of its steps; positions whose softmax is held at a time.
PASS_RATE, PASS_BATCH, PIECE = 0.01, 64, 256
_COUNTS = pa.schema([("cell", pa.int32()), ("bucket", pa.int32()), ("keys", pa.binary()), ("counts", pa.binary())])
_CODED = pa.schema([("cell", pa.int32()), ("doc_ids", pa.list_(pa.int64())), *((n, pa.binary()) for n in ("counts", "at", "keys", "ids", "sizes"))])
_OUT = pa.schema([("doc_id", pa.int64()), ("held_out", pa.bool_()), ("n_tokens", pa.int64()), ("n_known", pa.int64()), ("log_counts", pa.float64()), ("score", pa.float64())])
SCHEMA = "doc_id long, held_out boolean, n_tokens long, n_known long, log_counts double, score double"
_END_WORD = C.U64(0xE7D2C3B4A5968778)


# ---------------------------------------------------------------- subword ids


#: Words in a worker's table before it starts anew.
MAX_WORDS = 700_000


class SubwordIds:
    """Ids of words (each with a space in front) of a byte-level BPE vocabulary."""

    _shared: dict[str, "SubwordIds"] = {}

    def __init__(self, path: str):
        import public_tokenizers
        import tiktoken

        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.encoding = tiktoken.Encoding("words", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.end = max(ranks.values()) + 1
        self.size = self.end + 1
        self.end_bytes = np.array([self.end], "<u2").tobytes()
        self.spaced = np.zeros(self.size, np.int64)
        self.spaced[[i for b, i in ranks.items() if b[:1] == b" "]] = 1
        self.known: dict[bytes, bytes] = {}

    @classmethod
    def shared(cls, path: str) -> "SubwordIds":
        if path not in cls._shared:
            cls._shared[path] = cls(path)
        return cls._shared[path]

    def spell(self, words: list[bytes]) -> list[bytes]:
        """Little-endian uint16 ids of each word (lower-cased UTF-8); words not met before are encoded together."""
        if len(self.known) > MAX_WORDS:
            self.known.clear()
        self._learn(list({w for w in words if w not in self.known}))
        return [self.known[w] for w in words]

    def encode(self, words: list[bytes]) -> bytes:
        """Little-endian uint16 ids of a document's words and its end."""
        return b"".join(self.spell(words)) + self.end_bytes

    def _learn(self, new: list[bytes]) -> None:
        """Encode new words in one call; an id that begins with a space begins the next word."""
        if not new:
            return
        texts = [w.decode("utf-8", "replace") for w in new]
        ids = self.encoding.encode_to_numpy(" " + " ".join(texts), disallowed_special=()).astype("<u2")
        starts = np.flatnonzero(self.spaced[ids])
        if len(starts) == len(new):
            raw, cuts = ids.tobytes(), (2 * np.append(starts, len(ids))).tolist()
            self.known.update(zip(new, [raw[i:j] for i, j in zip(cuts, cuts[1:])]))
        else:
            for w, t in zip(new, texts):
                self.known[w] = np.array(self.encoding.encode_ordinary(" " + t), "<u2").tobytes()


# ---------------------------------------------------------------- the model


@dataclass
class Symbols:
    """Of each id: its symbol, and its place among the counted ids (the group's, if it is not counted)."""

    symbol: np.ndarray
    fine: np.ndarray


@dataclass
class Model:
    """Symbols, shares of symbol pairs, log shares of what is counted in its symbol, of ids in what is counted, and the layer's weights."""

    symbols: Symbols
    pairs: np.ndarray
    log_in_symbol: np.ndarray
    log_in_fine: np.ndarray
    weights: dict[str, np.ndarray]


def choose_symbols(counts: np.ndarray, spaced: np.ndarray, end: int) -> Symbols:
    """The end and the most frequent ids have their own symbol, others share by frequency and word start."""
    order = np.lexsort((np.arange(len(counts)), -counts))
    order = np.concatenate(([end], order[order != end]))
    symbol, fine = np.empty(len(counts), np.int32), np.empty(len(counts), np.int32)
    symbol[order[:HEAD]] = np.arange(HEAD)
    tail = order[HEAD:]
    # groups by rank, each about three times as large as the one before, apart for word starts
    tier = np.minimum(np.log(1 + np.arange(len(tail)) / HEAD) / np.log(3), GROUPS // 2 - 1).astype(np.int64)
    symbol[tail] = HEAD + 2 * tier + spaced[tail]
    fine[order[:COUNTED]] = np.arange(COUNTED)
    fine[order[COUNTED:]] = COUNTED + symbol[order[COUNTED:]] - HEAD
    return Symbols(symbol, fine)


def _age_bias(w: dict[str, np.ndarray]) -> np.ndarray:
    """Of every (query, key) place of a window: the key's age bias, or -1e4 for later keys."""
    d = np.arange(WINDOW)[:, None] - np.arange(WINDOW)[None, :]
    return np.where(d < 0, np.float32(-1e4), w["age"][np.clip(d, 0, WINDOW - 1)]).astype(np.float32)


def first_weights(seed: int = 11) -> dict[str, np.ndarray]:
    """The layer before training: it adds nothing to the shares of pairs."""
    rng, f = np.random.default_rng(seed), np.float32
    square = lambda: rng.normal(0, DIM**-0.5, (DIM, DIM)).astype(f)
    return {"E": rng.normal(0, 0.5, (OUT + 1, DIM)).astype(f), "Q": square(), "K": square(), "V": square(), "S": square(), "O": np.zeros((DIM, OUT), f), "age": (-0.05 * np.arange(WINDOW)).astype(f)}


def _squash(x: np.ndarray) -> np.ndarray:
    """x / (1 + |x|), between -1 and 1; its slope is (1 - |result|) squared."""
    return x / (1 + np.abs(x))


def descend(w: dict[str, np.ndarray], stream: np.ndarray, pairs: np.ndarray, steps: int | None, seed: int, rate: float = 0.02) -> dict[str, np.ndarray]:
    """Adam on the cross-entropy of the next symbol, over windows of ``stream`` (START before each passage).

    Windows are drawn at random for ``steps`` steps.  Without ``steps`` they lie end to end and
    each comes once, in random order, so every symbol is learned from.
    """
    if not len(stream):
        return w
    stream = np.append(stream, np.full(max(1, WINDOW + 1 - len(stream)), START))  # a mark is no target
    stream = stream.astype(np.int64)
    rng, f = np.random.default_rng(seed), np.float32
    # weights, gradients and moments are parts of one vector each, so a step of Adam is a few calls
    held = np.concatenate([w[n].ravel() for n in sorted(w)]).astype(f)
    shapes = {n: w[n].shape for n in sorted(w)}
    grad, m, s2 = (np.zeros_like(held) for _ in range(3))
    w, g = _parts(held, shapes), _parts(grad, shapes)
    d = np.arange(WINDOW)[:, None] - np.arange(WINDOW)[None, :]
    age, causal = np.clip(d, 0, WINDOW - 1), (d >= 0).astype(f)
    ones, columns = np.ones(OUT, f), np.arange(DIM)
    p_of, shares = np.empty((PIECE, OUT), f), np.empty((PIECE, OUT), f)
    end = len(stream) - 1 - WINDOW
    starts = np.append(np.arange(0, end, WINDOW), end)
    twice = WINDOW * len(starts) - (len(stream) - 1)  # symbols that the last window shares with the one before
    order, once = rng.permutation(len(starts)), steps is None
    steps = -(-len(starts) // PASS_BATCH) if once else steps
    for t in range(1, steps + 1):
        pick = order[(t - 1) * PASS_BATCH : t * PASS_BATCH]
        at = (starts[pick] if once else rng.integers(0, end + 1, BATCH))[:, None] + np.arange(WINDOW)
        x, y = stream[at], stream[at + 1]
        live = y != START
        if once:
            live[pick == len(starts) - 1, :twice] = False
        asked, target, live = x.ravel(), np.minimum(y, OUT - 1).ravel(), live.ravel()
        square = np.concatenate([w[c] for c in "QKVS"], axis=1)
        tables = (w["E"] @ square).take(asked, axis=0).reshape(*x.shape, 4 * DIM)
        q, k, v, e = (tables[:, :, i : i + DIM] for i in range(0, 4 * DIM, DIM))
        a = q @ k.transpose(0, 2, 1)
        a += w["age"][age]
        np.clip(a, -60, 80, out=a)
        np.exp(a, out=a)
        a *= causal
        if len(cut := np.flatnonzero((x[:, 1:] == START).any(axis=1))):
            part = np.cumsum(x[cut] == START, axis=1)  # a passage does not look into the one before
            a[cut] *= part[:, :, None] == part[:, None, :]
        a /= (a @ ones[:WINDOW])[:, :, None]
        mixed = a @ v
        h = _squash(e + mixed)
        flat, dh = h.reshape(-1, DIM), np.empty((h.size // DIM, DIM), f)
        weight = live.astype(f) / f(max(1, np.count_nonzero(live)))  # a wider number would widen all products
        back, out = np.ascontiguousarray(w["O"].T), np.zeros((OUT, DIM), f)
        for low in range(0, len(flat), PIECE):  # pieces that a core's cache holds
            some = slice(low, low + PIECE)
            hidden = flat[some]
            p, share = p_of[: len(hidden)], shares[: len(hidden)]
            np.matmul(hidden, w["O"], out=p)
            np.exp(p, out=p)
            p *= pairs.take(asked[some], axis=0, out=share, mode="clip")
            whole = p @ ones
            p[np.arange(len(p)), target[some]] -= whole
            scale = (weight[some] / whole)[:, None]  # rows of p stay unscaled, what they are multiplied with is shorter
            out += p.T @ (hidden * scale)
            np.multiply(p @ back, scale, out=dh[some])
        g["O"][:] = out.T
        dh = dh.reshape(h.shape) * (1 - np.abs(h)) ** 2
        ds = dh @ v.transpose(0, 2, 1)
        ds -= np.einsum("ijk,ijk->ij", dh, mixed)[:, :, None]
        ds *= a
        g["age"][:] = np.bincount(age.ravel(), weights=ds.sum(axis=0).ravel(), minlength=WINDOW)
        sent = np.concatenate((ds @ k, ds.transpose(0, 2, 1) @ q, a.transpose(0, 2, 1) @ dh, dh), axis=2).reshape(-1, 4 * DIM)
        for c, part in zip("QKVS", np.split(w["E"].take(asked, axis=0).T @ sent, 4, axis=1)):
            g[c][:] = part
        places = (asked * DIM)[:, None] + columns
        g["E"][:] = np.bincount(places.ravel(), weights=(sent @ square.T).ravel(), minlength=g["E"].size).reshape(g["E"].shape)
        slow = rate * min(1.0, 2 * (1 - (t - 1) / steps))
        m += 0.1 * (grad - m)
        s2 += 0.01 * (grad * grad - s2)
        held -= f(slow / (1 - 0.9**t)) * m / (np.sqrt(s2 / f(1 - 0.99**t)) + f(1e-8))
        np.clip(w["O"], -3, 3, out=w["O"])  # |h| < 1, so logits stay where float32 exponentials are finite
    return w


def _parts(flat: np.ndarray, shapes: dict[str, tuple[int, ...]]) -> dict[str, np.ndarray]:
    """Arrays of the given shapes that lie in ``flat`` one after the other."""
    cuts = np.cumsum([int(np.prod(x)) for x in shapes.values()])
    return {n: part.reshape(x) for (n, x), part in zip(shapes.items(), np.split(flat, cuts[:-1]))}


def id_log_probs(model: Model, ids: np.ndarray, offs: np.ndarray, rows: int = 64) -> np.ndarray:
    """Natural log probability of every id of documents with offsets ``offs``, each from its own document alone."""
    n = np.diff(offs)
    y, fine = model.symbols.symbol[ids], model.symbols.fine[ids]
    # positions of a document: START, then its ids but the last; a position predicts the next id
    x = np.empty(len(ids), np.int64)
    x[1:] = y[:-1]
    x[offs[:-1][n > 0]] = START
    n_windows = -(-n // STRIDE)
    of = np.repeat(np.arange(len(n)), n_windows)
    at = (np.arange(len(of)) - np.repeat(np.cumsum(n_windows) - n_windows, n_windows)) * STRIDE
    first, left = offs[of] + at, n[of] - at  # first predicting position, and how many there are
    order = np.argsort(left < STRIDE, kind="stable")  # windows that end before they are full come last
    first, left, opening = first[order], left[order], at[order] == 0
    w = model.weights
    eq, ek, ev, es = (w["E"] @ w[c] for c in "QKVS")
    ev = np.concatenate((ev, np.ones((len(ev), 1), np.float32)), axis=1)
    back = WINDOW - STRIDE
    bias = _age_bias(w)[back:]
    place, ahead = np.arange(-back, STRIDE), np.arange(STRIDE)
    hidden = np.empty((len(ids), DIM), np.float32)
    padded = np.concatenate((np.zeros(back, np.int64), x, np.zeros(STRIDE, np.int64)))
    for a in range(0, len(first), rows):
        b = min(a + rows, len(first))
        c = padded.take(first[a:b, None] + (place + back))
        asks = np.ascontiguousarray(c[:, back:])
        s = eq.take(asks, axis=0) @ ek.take(c, axis=0).transpose(0, 2, 1)
        s += bias
        s[opening[a:b], :, :back] = -1e4  # nothing stands before a document
        np.minimum(s, 80, out=s)
        np.exp(s, out=s)
        # the last column of the values is 1, so it holds the sum that softmax divides by
        mixed = s @ ev.take(c, axis=0)
        h = _squash(es.take(asks, axis=0) + mixed[:, :, :DIM] / mixed[:, :, DIM:]).reshape(-1, DIM)
        where = (first[a:b, None] + ahead).ravel()
        if left[b - 1] < STRIDE:
            take = (ahead < left[a:b, None]).ravel()
            h, where = h[take], where[take]
        hidden[where] = h
    # the sum of the softmax: positions of one symbol lie together, so its shares are one vector
    by = np.argsort(x.astype(np.int16), kind="stable")
    ends = np.searchsorted(x[by], np.arange(OUT + 2))
    whole, held = np.empty(len(ids), np.float32), np.empty((PIECE, OUT), np.float32)
    for k in np.flatnonzero(np.diff(ends)).tolist():
        for a in range(ends[k], ends[k + 1], PIECE):
            some = by[a : min(a + PIECE, ends[k + 1])]
            z = np.matmul(hidden.take(some, axis=0), w["O"], out=held[: len(some)])
            np.exp(z, out=z)
            whole[some] = z @ model.pairs[k]
    out = np.einsum("ij,ij->i", hidden, np.ascontiguousarray(w["O"].T)[y])
    out += np.log(model.pairs[x, y] / whole)
    return out + model.log_in_symbol[x, fine] + model.log_in_fine[ids]


# ---------------------------------------------------------------- corpus passes


def held_out(id_col: str = "doc_id"):
    """Documents never learned from: crc32 of the id as text, modulo 7, is 2."""
    return F.coalesce((F.crc32(F.col(id_col).cast("string").cast("binary")) % 7) == 2, F.lit(False))


def _learnable(ids: np.ndarray) -> np.ndarray:
    return np.array([zlib.crc32(str(i).encode()) % 7 != 2 for i in ids.tolist()], bool)


def _lower_words(text: bytes) -> list[bytes]:
    """Words of UTF-8 text, A-Z lower-cased; bytes split at just the contract's white space."""
    return text.lower().split()


CODED = "cell int, doc_ids array<bigint>, counts binary, at binary, keys binary, ids binary, sizes binary"


def code(docs: DataFrame, path: str, n_cells: int) -> DataFrame:
    """A row for each cell of ``docs(doc_id, text)``, written once: tokens of each document, places of tokens among the cell's keys, keys with their ids."""

    def run(key, table):
        table = table.sort_by([("doc_id", "ascending"), ("text", "ascending")])
        buf, offs = C.text_buffer(table.column("text"))
        tokens = Tokens(buf, offs)
        keys, at = np.unique(tokens.hashes, return_inverse=True)
        spelling = Spelling(SubwordIds.shared(path), buf, tokens, at)
        row = {"cell": key[0].as_py(), "doc_ids": table.column("doc_id").to_pylist(), "counts": _shrunk(tokens.counts, "<i8"), "at": _shrunk(at, "<u4"), "keys": C.pack(keys), "ids": _shrunk(spelling.flat, "<u2"), "sizes": _shrunk(spelling.sizes, "<u4")}
        return pa.Table.from_pylist([row], schema=_CODED)

    coded = C.cut(C.cells(docs, n_cells).groupBy("cell").applyInArrow(run, CODED))
    C.release(docs.sparkSession)
    return coded


def _shrunk(x: np.ndarray, kind: str) -> bytes:
    """Numbers byte plane by byte plane, compressed."""
    x = x.astype(kind)
    return len(x).to_bytes(8, "little") + pa.compress(np.ascontiguousarray(x.view(np.uint8).reshape(-1, x.itemsize).T), codec="zstd", asbytes=True) if len(x) else bytes(8)


def _grown(blob: bytes, kind: str) -> np.ndarray:
    n, size = int.from_bytes(blob[:8], "little"), np.dtype(kind).itemsize
    planes = np.frombuffer(pa.decompress(blob[8:], n * size, codec="zstd", asbytes=True) if n else b"", np.uint8).reshape(size, -1)
    return np.ascontiguousarray(planes.T).view(kind).reshape(-1).astype(np.int64)


class Coded:
    """A cell as ``code`` wrote it."""

    def __init__(self, row: dict):
        self.cell, self.doc_ids, self.keys = row["cell"], row["doc_ids"], C.unpack(row["keys"])
        self.counts, self.at = _grown(row["counts"], "<i8"), _grown(row["at"], "<u4")
        self.flat, self.sizes = _grown(row["ids"], "<u2"), _grown(row["sizes"], "<u4")
        self.first = np.cumsum(self.sizes) - self.sizes
        self.learn = _learnable(np.array([0 if i is None else i for i in self.doc_ids], np.int64))
        self.token = np.concatenate(([0], np.cumsum(self.counts)))

    @staticmethod
    def each(batches):
        for batch in batches:
            for k in range(batch.num_rows):
                yield Coded(batch.slice(k, 1).to_pylist()[0])

    def uses(self) -> np.ndarray:
        """How often each key stands in training documents."""
        return np.bincount(self.at, weights=np.repeat(self.learn, self.counts), minlength=len(self.keys)).astype(np.int64)

    def runs(self, limit: int = 1 << 16):
        """Runs of documents of about ``limit`` tokens: (first, last, ids, offsets of the documents in them)."""
        i, n = 0, len(self.counts)
        while i < n:
            j = min(n, max(i + 1, int(np.searchsorted(self.token, self.token[i] + limit, "right")) - 1))
            of = self.at[self.token[i] : self.token[j]]
            sizes = self.sizes[of]
            done = np.cumsum(sizes)
            ids = self.flat[np.repeat(self.first[of] - done + sizes, sizes) + np.arange(int(done[-1]))]
            yield i, j, ids, np.concatenate(([0], done))[self.token[i : j + 1] - self.token[i]]
            i = j

    def training_runs(self):
        """(ids, offsets) of training documents only."""
        for i, j, ids, cuts in self.runs():
            n = np.diff(cuts)
            use = self.learn[i:j]
            if use.any():
                yield ids[np.repeat(use, n)], np.concatenate(([0], np.cumsum(n[use])))


def _summed(coded: DataFrame, count, size: int) -> np.ndarray:
    """Sum over all cells of the arrays that ``count`` makes of them; a task sends its sum once."""

    def run(batches):
        total = None
        for cell in Coded.each(batches):
            total = count(cell) if total is None else total + count(cell)
        at = np.flatnonzero(total) if total is not None else np.empty(0, np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at].astype(np.float64) if len(at) else np.empty(0))], names=["at", "n"])

    few = coded.coalesce(2 * coded.sparkSession.sparkContext.defaultParallelism)
    got = few.mapInArrow(run, "at long, n double").groupBy("at").agg(F.sum("n").alias("n")).toArrow()  # at most ``size`` rows
    out = np.zeros(size)
    out[got.column("at").to_numpy()] = got.column("n").to_numpy()
    return out


def _id_counts(coded: DataFrame, size: int) -> np.ndarray:
    """Counts of ids over all training documents."""
    return _summed(coded, lambda c: np.bincount(c.flat, weights=np.repeat(c.uses(), c.sizes), minlength=size), size).astype(np.int64)


def _training_counts(docs: DataFrame, path: str, symbols: Symbols, coded: DataFrame | None = None, counts: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Counts of ids, and of what is counted after each symbol (START before each document), over all training documents.

    What is shuffled and collected does not grow with the input; ``coded`` saves coding ``docs``
    again, and ``counts``, if the ids' are known, counting them.
    """
    coded = code(docs, path, C.parts(C.column_bytes(docs, "text"), C.CELL_BYTES)) if coded is None else coded
    n_pairs = (OUT + 1) * FINE
    shared = coded.sparkSession.sparkContext.broadcast(symbols)

    def pairs(cell):
        total = np.zeros(n_pairs, np.int64)
        for ids, cuts in cell.training_runs():
            total += np.bincount(pair_codes(shared.value, ids, cuts), minlength=n_pairs)
        return total

    counts = _id_counts(coded, len(symbols.symbol)) if counts is None else counts
    return counts, _summed(coded, pairs, n_pairs).astype(np.int64).reshape(OUT + 1, FINE)


def pair_codes(symbols: Symbols, ids: np.ndarray, offs: np.ndarray) -> np.ndarray:
    """Code of each (symbol before, counted id) of documents with offsets ``offs``."""
    before = np.empty(len(ids), np.int64)
    before[1:] = symbols.symbol[ids[:-1]]
    before[offs[:-1][np.diff(offs) > 0]] = START
    return before * FINE + symbols.fine[ids]


def _passages(docs: DataFrame, path: str) -> DataFrame:
    """``shard, rank, ids``: passages drawn by a hash from all training documents, written once.

    A shard holds about SHARD passages; ids of a document's first passage follow a mark.
    """
    learn = docs.where(~held_out())
    # bytes bound characters; passages behind the end of a text come out empty
    last = F.floor(F.greatest(F.octet_length("text") - 1, F.lit(0)) / PASSAGE).cast("int")
    n = int(learn.agg(F.coalesce(F.sum(last + 1), F.lit(0)).alias("n")).first()["n"])
    rate = max(PASSAGE_SHARE, LEAST_PASSAGES / max(1, n))
    shards = max(2, int(n * min(1.0, rate) / SHARD))
    rank = lambda k: F.pmod(F.xxhash64("doc_id", k), F.lit(1 << 30))
    drawn = learn.select("doc_id", "text", last.alias("last"), F.explode(F.filter(F.sequence(F.lit(0), last), lambda k: rank(k) < int(rate * (1 << 30)))).alias("k"))
    drawn = drawn.select(rank(F.col("k")).alias("rank"), "k", "last", F.substring("text", F.col("k") * PASSAGE + 1, F.lit(PASSAGE)).alias("text"))

    def run(batches):
        sub = SubwordIds.shared(path)
        for batch in batches:
            out = []
            for k, last, text in zip(*(batch.column(c).to_pylist() for c in ("k", "last", "text"))):
                words = _lower_words(text.encode("utf-8", "replace"))
                ids = sub.encode(words[k > 0 : len(words) - (k < last)])  # without words that the passage cuts
                out.append(ids[:-2] if k < last else ids)
            yield pa.RecordBatch.from_arrays([batch.column("rank"), pa.array(out, pa.binary())], names=["rank", "ids"])

    got = drawn.mapInArrow(run, "rank long, ids binary").where(F.length("ids") > 0)
    return C.cut(got.withColumn("shard", F.pmod(F.xxhash64("rank"), F.lit(shards)).cast("int")))


def _train(passages: DataFrame, symbol: np.ndarray, pairs: np.ndarray) -> dict[str, np.ndarray]:
    """Rounds of descent in every shard from common weights, and of averaging the shards' weights."""
    w = first_weights()
    for turn in range(ROUNDS):
        shards = passages.groupBy("shard").applyInArrow(_shard_round(passages.sparkSession.sparkContext.broadcast((w, symbol, pairs)), turn), "at long, w double, n long")
        sums = shards.groupBy("at").agg((F.sum("w") / F.sum("n")).alias("w")).toArrow()  # one row a weight
        if not sums.num_rows:
            return w
        flat = np.empty(sums.num_rows, np.float32)
        flat[sums.column("at").to_numpy()] = sums.column("w").to_numpy()
        cuts = np.cumsum([w[n].size for n in sorted(w)])
        w = {n: part.reshape(w[n].shape) for n, part in zip(sorted(w), np.split(flat, cuts[:-1]))}
    return w


def _shard_round(shared, turn: int):
    """Descent of one shard in one round; its weights come back times the length of its stream."""

    def run(key, table):
        w, symbol, pairs = shared.value
        table = table.sort_by([("rank", "ascending"), ("ids", "ascending")])
        stream = np.concatenate([np.concatenate(([START], symbol[np.frombuffer(x, "<u2")])) for x in table.column("ids").to_pylist()])
        new = descend(w, stream, pairs, STEPS, key[0].as_py() * ROUNDS + turn, 0.02 / (turn + 1))
        flat = np.concatenate([new[n].ravel() for n in sorted(new)]).astype(np.float64)
        return pa.table({"at": pa.array(np.arange(len(flat))), "w": pa.array(flat * len(stream)), "n": pa.array(np.full(len(flat), len(stream)))})

    return run


def _pass_over_all(coded: DataFrame, symbol: np.ndarray, pairs: np.ndarray, w: dict[str, np.ndarray]) -> dict[str, np.ndarray]:
    """Each cell descends from ``w`` once over all its training documents; the mean by number of symbols."""
    names = sorted(w)
    size = sum(w[n].size for n in names)
    shared = coded.sparkSession.sparkContext.broadcast((w, symbol, pairs))

    def descent(cell):
        w, symbol, pairs = shared.value
        parts = [np.insert(symbol[ids], cuts[:-1], START) for ids, cuts in cell.training_runs()]
        if not parts:
            return np.zeros(size + 1)
        stream = np.concatenate(parts)
        new = descend(w, stream, pairs, None, cell.cell, PASS_RATE)
        return np.append(np.concatenate([new[n].ravel() for n in names]).astype(np.float64), 1) * len(stream)

    sums = _summed(coded, descent, size + 1)
    if not sums[-1]:
        return w
    parts = np.split((sums[:-1] / sums[-1]).astype(np.float32), np.cumsum([w[n].size for n in names])[:-1])
    return {n: x.reshape(w[n].shape) for n, x in zip(names, parts)}


def fit(docs: DataFrame, path: str, coded: DataFrame) -> Model:
    """Counts, and a layer that has gone over every training document."""
    sub = SubwordIds.shared(path)
    counts = _id_counts(coded, sub.size)
    symbols = choose_symbols(counts, sub.spaced, sub.end)
    counts, pair_counts = _training_counts(docs, path, symbols, coded, counts)
    untrained = assemble(symbols, counts, pair_counts, first_weights())
    w = _train(_passages(docs, path), symbols.symbol, untrained.pairs)
    return replace(untrained, weights=_pass_over_all(coded, symbols.symbol, untrained.pairs, w))


def assemble(symbols: Symbols, counts: np.ndarray, pair_counts: np.ndarray, weights: dict[str, np.ndarray]) -> Model:
    """The model of corpus-wide counts; rare pairs lean on what follows any symbol."""
    own = counts + 0.01
    of = np.zeros(FINE, np.int64)  # the symbol of what is counted
    of[symbols.fine] = symbols.symbol
    fine = np.bincount(symbols.fine, weights=own, minlength=FINE)
    single = np.bincount(symbols.symbol, weights=own, minlength=OUT)
    by_symbol = np.zeros((OUT + 1, OUT))
    np.add.at(by_symbol.T, of, pair_counts.T)
    pairs = (by_symbol + PAIR_PRIOR * single / single.sum()) / (by_symbol.sum(axis=1, keepdims=True) + PAIR_PRIOR)
    with np.errstate(divide="ignore"):  # a group all of whose ids are counted has no others
        inside = np.log((pair_counts + PAIR_PRIOR * fine / single[of]) / (by_symbol[:, of] + PAIR_PRIOR))
    return Model(symbols, pairs.astype(np.float32), inside.astype(np.float32), np.log(own / fine[symbols.fine]), weights)


class Tokens:
    """Hash and place of each token (words, then the end, which has no place) of a run of documents."""

    def __init__(self, buf: np.ndarray, offs: np.ndarray):
        hashes, starts, ends, counts = [], [], [], []
        for i, _, b, o in C.batches(buf, offs):
            b = C.ascii_lower(b)
            s, e, first = C.word_spans(b, o)
            hashes.append(np.insert(C.span_hashes(b, s, e), first[1:], _END_WORD))
            starts.append(np.insert(s + offs[i], first[1:], -1))
            ends.append(np.insert(e + offs[i], first[1:], -1))
            counts.append(np.diff(first) + 1)
        join = lambda parts, kind: np.concatenate(parts) if parts else np.empty(0, kind)
        self.hashes, self.counts = join(hashes, np.uint64), join(counts, np.int64)
        self.starts, self.ends = join(starts, np.int64), join(ends, np.int64)


class Spelling:
    """Ids of the different tokens of a run of documents; ``of`` is each token's place among them."""

    def __init__(self, sub: SubwordIds, buf: np.ndarray, tokens: Tokens, of: np.ndarray):
        one = np.zeros(int(of.max()) + 1 if len(of) else 0, np.int64)
        one[of] = np.arange(len(of))  # some place where each stands
        raw, starts = buf.tobytes(), tokens.starts[one]
        words = [raw[a:b].lower() for a, b in zip(starts.tolist(), tokens.ends[one].tolist())]
        blobs = sub.spell(words)
        for k in np.flatnonzero(starts < 0).tolist():
            blobs[k] = sub.end_bytes
        self.flat = np.frombuffer(b"".join(blobs), "<u2").astype(np.int64)
        self.sizes = np.array([len(x) // 2 for x in blobs], np.int64)


def score_documents(docs: DataFrame, tokenizer: str | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score`` for every row.

    Null and empty texts are one end token.  A score depends on the row's own text and the
    model alone, so rows with equal texts get equal scores (rounded to four decimals).  Rows
    with null or repeated ids are rows of their own.  Very long texts are scored whole,
    window by window.  Other columns are ignored; an empty table gives an empty result.
    """
    path = tokenizer or tokenizer_file("byte_bpe_50k.tiktoken")
    C.bound_batches(docs.sparkSession)
    plain = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    total = C.column_bytes(plain, "text")
    n_buckets = C.parts(total, C.BUCKET_BYTES)
    coded = code(plain, path, C.parts(total, C.CELL_BYTES))
    model = plain.sparkSession.sparkContext.broadcast(fit(plain, path, coded))

    def send(batches):
        """A cell's distinct tokens with their counts in its training documents."""
        for cell in Coded.each(batches):
            counts, rows, done = cell.uses().astype("<i8"), [], 0
            for b, part in C.split_by_bucket(cell.keys, n_buckets):
                rows.append({"cell": cell.cell, "bucket": b, "keys": C.pack(part), "counts": zlib.compress(counts[done : done + len(part)].tobytes(), 1)})
                done += len(part)
            yield from pa.Table.from_pylist(rows, schema=_COUNTS).to_batches()

    def merge(key, table):
        """Counts over all cells, back to each cell in the order in which it asked."""
        r = table.to_pydict()
        lists = [C.unpack(x) for x in r["keys"]]
        counts = [np.frombuffer(zlib.decompress(x), "<i8") for x in r["counts"]]
        keys, at = np.unique(np.concatenate(lists), return_inverse=True)
        sums = np.bincount(at, weights=np.concatenate(counts), minlength=len(keys)).astype("<i8")
        out, done = [], 0
        for x in lists:
            out.append(zlib.compress(sums[at[done : done + len(x)]].tobytes(), 1))
            done += len(x)
        tokens, types = int(sums.sum()), int(np.count_nonzero(sums))
        return pa.table(
            {"cell": pa.array(r["cell"], pa.int32()), "bucket": pa.array(r["bucket"], pa.int32()), "counts": pa.array(out, pa.binary()), "tokens": pa.array([tokens] + [0] * (len(out) - 1), pa.int64()), "types": pa.array([types] + [0] * (len(out) - 1), pa.int64())}
        )

    def finish(key, table, back):
        if not table.num_rows:
            return _OUT.empty_table()
        m, cell = model.value, Coded(table.to_pylist()[0])
        back = back.sort_by("bucket")
        counts = np.concatenate([np.frombuffer(zlib.decompress(x), "<i8") for x in back.column("counts").to_pylist()])
        rows = len(cell.counts)
        owner = np.repeat(np.arange(rows), cell.counts)
        known = np.bincount(owner, weights=(counts > 0)[cell.at], minlength=rows).astype(np.int64)
        logs = np.bincount(owner, weights=np.log10(counts + 1.0)[cell.at], minlength=rows)
        scores = np.empty(rows)
        for i, j, ids, cuts in cell.runs():
            scores[i:j] = np.round(np.add.reduceat(id_log_probs(m, ids, cuts).astype(np.float64), cuts[:-1]) / np.log(10), 4)
        out = {"doc_id": pa.array(cell.doc_ids, pa.int64()), "held_out": ~cell.learn, "n_tokens": cell.counts, "n_known": known, "log_counts": logs, "score": scores}
        return pa.table(out, schema=_OUT)

    asked = coded.mapInArrow(send, "cell int, bucket int, keys binary, counts binary")
    answered = asked.groupBy("bucket").applyInArrow(merge, "cell int, bucket int, counts binary, tokens long, types long")
    scored = coded.groupBy("cell").cogroup(answered.select("cell", "bucket", "counts").groupBy("cell")).applyInArrow(finish, SCHEMA)
    size = answered.agg(F.coalesce(F.sum("tokens"), F.lit(0)).alias("n"), F.coalesce(F.sum("types"), F.lit(0)).alias("v"))
    tokens, types = size.select("n").scalar(), size.select("v").scalar()
    return scored.select("doc_id", "held_out", "n_tokens", "n_known", tokens.alias("train_tokens"), "log_counts", types.alias("_v"), "score").select(
        "doc_id", "held_out", "n_tokens", "n_known", "train_tokens", (F.col("log_counts") - F.col("n_tokens") * F.log10(F.col("train_tokens") + F.col("_v") + 1)).alias("base_score"), "score"
    )
