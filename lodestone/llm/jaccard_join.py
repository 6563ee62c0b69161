"""Near-duplicate join on word shingles with a count-vector R-tree.

A document is the set of its distinct ``shingle``-word runs.  Two sets link when
``100 * intersection >= 80 * union``.  Every set is also a point: its shingles hashed
into ``GROUPS`` groups and counted.  The summed coordinate minima of two points bound
their overlap from above, and so do those of two bounding boxes, which is what the
R-tree walks before any pair of sets is compared.

Getting there without comparing everything with everything:

1. The shingles with the smallest hashes, ``SAMPLED`` of all, are looked up across the
   corpus (cells and buckets of ``common``): which of them does only one set have?
2. Shingles are ordered: looked-up and unique, looked-up and repeated, the rest; by hash
   within each.  Linked sets share a shingle among the first ``floor(0.2 n) + 1`` of each
   in any common order.  In this one most documents begin with unique shingles only and
   can link with nothing; the others' repeated prefix shingles are the blocking keys.
3. Equal sets collapse to their smallest document id.
4. Sets sharing a min-hash are compared with that group's smallest member only; what
   passes is linked.  This joins large groups of near copies with one pair a member.
5. Between sets that are still in different components, each block's R-tree yields the
   pairs within the bound, and these are verified exactly.  No link can be lost: pairs
   of one component need no further link.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common as C
from .components import connected_components

GROUPS = 256
#: A group count is kept in a byte; this one stands for itself and all larger ones, and bounds nothing.
FULL = 255
#: Share of shingles (by hash) that are looked up across the corpus.
SAMPLED = 0.4
_LIMIT = C.U64(int(SAMPLED * (1 << 64)))
SEEDS = (0x2545F4914F6CDD1D, 0x9FB21C651E98DF25)
LEAF = 32
#: Documents of one chunk; a tile holds the sets of two chunks.
TILE = 512
_SENT = pa.schema([("cell", pa.int32()), ("bucket", pa.int32()), ("keys", pa.binary())])

_SETS = "doc_id long, n_shingles long, d1 long, d2 long, m1 long, m2 long, points binary, shingles array<long>, keys array<long>"
_SETS_ARROW = pa.schema(
    [("doc_id", pa.int64()), ("n_shingles", pa.int64()), ("d1", pa.int64()), ("d2", pa.int64()), ("m1", pa.int64()), ("m2", pa.int64())]
    + [("points", pa.binary()), ("shingles", pa.list_(pa.int64())), ("keys", pa.list_(pa.int64()))]
)


# ---------------------------------------------------------------- shingle sets


def shingle_sets(table: pa.Table, shingle: int = 5):
    """Per batch of documents: (first row, sorted distinct hashes, offsets)."""
    buf, offs = C.text_buffer(table.column("text"))
    for i, j, b, o in C.batches(buf, offs):
        b = C.ascii_lower(b)
        starts, ends, first = C.word_spans(b, o)
        h = C.span_hashes(b, starts, ends)
        n = np.diff(first)
        doc = np.repeat(np.arange(j - i), n)
        runs = C.window_hashes(h, shingle)
        ok = np.flatnonzero(C.inside(first, len(h), shingle))
        keys, owner = [runs[ok]], [doc[ok]]
        for size in range(1, shingle):  # fewer words than a shingle: the whole sequence is one
            short = np.flatnonzero(n == size)
            if len(short):
                keys.append(C.mix(C.window_hashes(h, size)[first[short]] + C.U64(size)))
                owner.append(short)
        keys, owner = np.concatenate(keys), np.concatenate(owner)
        order = _by_owner_and_key(owner, keys)
        keys, owner = keys[order], owner[order]
        if len(keys):
            new = np.append(True, (keys[1:] != keys[:-1]) | (owner[1:] != owner[:-1]))
            keys, owner = keys[new], owner[new]
        yield i, keys, np.searchsorted(owner, np.arange(j - i + 1))


def _by_owner_and_key(owner: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Order by owner, then key: one sort of a number made of both, if the key's upper bits tell all apart."""
    bits = int(owner.max(initial=0)).bit_length()
    both = (owner.astype(np.uint64) << C.U64(64 - bits) if bits else C.U64(0)) | (keys >> C.U64(bits))
    order = np.argsort(both)
    both, k = both[order], keys[order]
    if ((both[1:] == both[:-1]) & (k[1:] != k[:-1])).any():
        return np.lexsort((keys, owner))
    return order


def prefix_order(keys: np.ndarray, offs: np.ndarray, repeated: np.ndarray, threshold: int = 80) -> tuple[np.ndarray, np.ndarray]:
    """Shingles of each set's prefix that are not known to be unique, and their owners.

    The prefix is the first ``floor((1 - t) n) + 1`` shingles in the common order.
    """
    n = np.diff(offs)
    owner = np.repeat(np.arange(len(n)), n)
    rank_class = np.where(keys >= _LIMIT, 2, C.member(keys, repeated).astype(np.int8))
    # keys of an owner are sorted already, so their places order them within a class
    order = (np.sort(((owner * 3 + rank_class).astype(np.uint64) << C.U64(32)) | np.arange(len(keys), dtype=np.uint64)) & C.U64(0xFFFFFFFF)).astype(np.int64)
    rank = np.arange(len(keys)) - np.repeat(offs[:-1], n)
    take = (rank < np.repeat((100 - threshold) * n // 100 + 1, n)) & (rank_class[order] > 0)
    return keys[order][take], owner[take]


def digests(keys: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two 64-bit digests of each set (order does not matter)."""
    out = []
    for seed in (1, 2):
        total = np.append(C.U64(0), np.cumsum(C.mix(keys + C.U64(seed * 0x51ED270B7A64D1F3)), dtype=np.uint64))
        out.append(C.mix(total[offs[1:]] - total[offs[:-1]] + np.diff(offs).astype(np.uint64)))
    return out[0], out[1]


def min_hashes(keys: np.ndarray, offs: np.ndarray, seed: int) -> np.ndarray:
    out = np.zeros(len(offs) - 1, np.uint64)
    some = np.flatnonzero(np.diff(offs) > 0)
    if len(some):
        out[some] = np.minimum.reduceat(C.mix(keys ^ C.U64(seed)), offs[some])
    return out


def count_points(keys: np.ndarray, offs: np.ndarray, groups: int = GROUPS) -> np.ndarray:
    """Group counts of each set, one row of bytes a set."""
    n = len(offs) - 1
    owner = np.repeat(np.arange(n), np.diff(offs))
    return np.bincount(owner * groups + (keys % C.U64(groups)).astype(np.int64), minlength=n * groups).reshape(n, groups).clip(0, FULL).astype(np.uint8)


# ---------------------------------------------------------------- the R-tree


class CountRTree:
    """Bulk-loaded R-tree over count points; joins with itself under an overlap bound.

    Sets ``a`` and ``b`` can link only if their overlap is at least
    ``t / (1 + t) * (|a| + |b|)``; the summed minima of the boxes' upper corners bound it.
    """

    def __init__(self, points: np.ndarray, sizes: np.ndarray, threshold: int = 80, leaf: int = LEAF):
        self.order = np.argsort(sizes, kind="stable")
        self.points, self.sizes = points[self.order], sizes[self.order]
        self.threshold, self.leaf = threshold, leaf
        self.levels = []
        upper, least = self.points, self.sizes
        while True:
            cuts = np.arange(0, len(upper), leaf)
            upper, least = np.maximum.reduceat(upper, cuts, axis=0), np.minimum.reduceat(least, cuts)
            self.levels.append((upper, least))
            if len(upper) <= leaf:
                break

    def _may(self, ua, la, ub, lb) -> np.ndarray:
        """Which rows of ``a`` may reach which rows of ``b``."""
        bound = np.minimum(ua[:, None, :], ub[None, :, :]).sum(axis=2, dtype=np.int64)
        return (100 + self.threshold) * bound >= self.threshold * (la[:, None] + lb[None, :])

    def pairs(self):
        """Yield arrays (i, j) of positions whose points are within the bound, i before j."""
        top = len(self.levels) - 1
        upper, least = self.levels[top]
        i, j = np.nonzero(np.triu(self._may(upper, least, upper, least)))
        stack = [(top, i, j)]
        while stack:
            level, i, j = stack.pop()
            below = self.levels[level - 1] if level else (self.points, self.sizes)
            for a, b in zip(i.tolist(), j.tolist()):
                sa, sb = slice(a * self.leaf, (a + 1) * self.leaf), slice(b * self.leaf, (b + 1) * self.leaf)
                may = self._may(below[0][sa], below[1][sa], below[0][sb], below[1][sb])
                if a == b:
                    may = np.triu(may, 0 if level else 1)
                x, y = np.nonzero(may)
                if not len(x):
                    continue
                if level:
                    stack.append((level - 1, x + sa.start, y + sb.start))
                else:
                    yield self.order[x + sa.start], self.order[y + sb.start]


def _block_pairs(table: pa.Table, threshold: int) -> pa.Table:
    """Candidate pairs of a bucket of blocks: different components, within the bound."""
    key = table.column("key").to_numpy()
    doc = table.column("doc_id").to_numpy()
    comp = table.column("component").to_numpy()
    size = table.column("n_shingles").to_numpy()
    points = np.frombuffer(b"".join(table.column("points").to_pylist()), np.uint8).reshape(len(key), -1)
    if (points == FULL).any():
        points = np.where(points == FULL, 1 << 20, points.astype(np.int32))
    order = np.argsort(key, kind="stable")
    edges = np.flatnonzero(np.append(True, np.diff(key[order]) != 0))
    left, right = [], []
    for block in np.split(order, edges[1:]):
        if len(block) < 2:
            continue
        for i, j in CountRTree(points[block], size[block], threshold).pairs():
            i, j = block[i], block[j]
            apart = comp[i] != comp[j]
            a, b = doc[i[apart]], doc[j[apart]]
            left.append(np.minimum(a, b))
            right.append(np.maximum(a, b))
    z = np.empty(0, np.int64)
    pairs = np.unique(np.stack((np.concatenate(left or [z]), np.concatenate(right or [z]))), axis=1)
    return pa.table({"a": pa.array(pairs[0], pa.int64()), "b": pa.array(pairs[1], pa.int64())})


# ---------------------------------------------------------------- the join


def _verify(pairs: DataFrame, sets: DataFrame, threshold: int) -> DataFrame:
    """Pairs (a, b) whose sets link, by exact intersection.

    Pairs are dealt to tiles: documents that share their smallest partner form a cluster,
    a cluster is cut into chunks of about TILE documents, and a pair belongs to the tile
    of its two chunks.  A set travels once to each tile that needs it, however many of
    its pairs are there.
    """
    pairs = C.cut(pairs)  # it is read many times below
    both = pairs.union(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))
    near = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("c"))
    sizes = near.groupBy("c").agg(F.count("*").alias("n"))
    chunk = near.join(sizes, "c").select(F.col("a").alias("doc_id"), F.xxhash64("c", F.pmod(F.xxhash64("a"), F.ceil(F.col("n") / TILE))).alias("chunk"))
    tiled = pairs.join(chunk.select(F.col("doc_id").alias("a"), F.col("chunk").alias("ca")), "a").join(chunk.select(F.col("doc_id").alias("b"), F.col("chunk").alias("cb")), "b")
    tiled = C.cut(tiled.select(F.xxhash64(F.least("ca", "cb"), F.greatest("ca", "cb")).alias("tile"), "a", "b"))
    need = tiled.select(F.col("tile").alias("spot"), F.col("a").alias("doc_id")).union(tiled.select("tile", F.col("b"))).distinct()
    brought = need.join(sets.select("doc_id", "shingles"), "doc_id").select("spot", "doc_id", "shingles")

    def check(key, left, right):
        return _check_tile(left, right, threshold)

    return tiled.groupBy("tile").cogroup(brought.groupBy("spot")).applyInArrow(C.tidy(check), "a long, b long")


def _check_tile(pairs: pa.Table, sets: pa.Table, threshold: int) -> pa.Table:
    """The pairs of a tile that link; intersections by one product of 0/1 matrices a block of shingles."""
    ids = sets.column("doc_id").to_numpy()
    lists = sets.column("shingles").combine_chunks()
    lists = pa.concat_arrays(lists.chunks) if isinstance(lists, pa.ChunkedArray) else lists
    sizes = np.diff(lists.offsets.to_numpy()) if len(lists) else np.empty(0, np.int64)
    flat = lists.flatten().to_numpy() if len(lists) else np.empty(0, np.int64)
    owner = np.repeat(np.arange(len(ids)), sizes)
    order = np.argsort(ids, kind="stable")
    at = lambda name: order[np.searchsorted(ids[order], pairs.column(name).to_numpy())]
    a, b = at("a"), at("b")
    shared = np.zeros(len(a), np.int64)
    _, code, times = np.unique(flat, return_inverse=True, return_counts=True)
    often = times > 1  # a shingle of one set alone is in no intersection
    place = np.cumsum(often) - 1
    use = often[code]
    owner, code = owner[use], place[code[use]]
    by = np.argsort(code, kind="stable")
    owner, code = owner[by], code[by]
    step = max(256, (16 << 20) // (4 * max(1, len(ids))))
    for lo in range(0, int(often.sum()), step):
        s = slice(*np.searchsorted(code, (lo, lo + step)))
        m = np.zeros((len(ids), step), np.float32)
        m[owner[s], code[s] - lo] = 1
        if len(a) * 8 > len(ids) ** 2:
            shared += np.rint((m @ m.T)[a, b]).astype(np.int64)
        else:
            for k in range(0, len(a), 1024):
                t = slice(k, k + 1024)
                shared[t] += np.rint(np.einsum("ij,ij->i", m[a[t]], m[b[t]])).astype(np.int64)
    link = 100 * shared >= threshold * (sizes[a] + sizes[b] - shared)
    return pairs.select(["a", "b"]).filter(pa.array(link))


def _candidate_sets(docs: DataFrame, threshold: int, shingle: int, n_cells: int, n_buckets: int, id_col: str, text_col: str) -> DataFrame:
    """Every document with its set's size and digests; possible partners bring set, point and keys."""
    dealt = C.cells(docs, n_cells, id_col, text_col)

    def distinct_sets(table):
        """Batches of a cell's shingle sets with a mask of those not met before in it."""
        seen: set = set()
        for i, keys, offs in shingle_sets(in_order(table), shingle):
            yield i, keys, offs, _first_of_equal(keys, offs, seen)

    def in_order(table):
        """By id, so that of equal sets in a cell the smallest id is the one that counts."""
        return table.sort_by("doc_id")

    def sampled(table):
        out = [keys[(keys < _LIMIT) & np.repeat(fresh, np.diff(offs))] for _, keys, offs, fresh in distinct_sets(table)]
        return C.distinct_and_repeated(np.concatenate(out) if out else np.empty(0, np.uint64))

    def prefixes(table, back):
        repeated = np.union1d(sampled(table)[1], C.received(_level(back, 0)))
        out = []
        for i, keys, offs, fresh in distinct_sets(table):
            p, owner = prefix_order(keys, offs, repeated, threshold)
            mine = fresh[owner]
            out.append((i, keys, offs, p[mine], owner[mine]))
        return out

    def look_up(key, table):
        return C.send(key[0].as_py(), sampled(table)[0], n_buckets)

    def ask(key, table, back):
        if not table.num_rows:
            return _SENT.empty_table()
        keys, _ = C.distinct_and_repeated(np.concatenate([p for *_, p, _ in prefixes(table, back)]))
        return C.send(key[0].as_py(), keys, n_buckets)

    def answer(key, table, back):
        """All documents; those with a shared prefix key also bring their set, point and keys."""
        if not table.num_rows:
            return _SETS_ARROW.empty_table()
        batches = prefixes(table, back)
        _, local = C.distinct_and_repeated(np.concatenate([p for *_, p, _ in batches]))
        wanted = np.union1d(local, C.received(_level(back, 1)))
        ids = in_order(table).column("doc_id").to_numpy()
        out: dict[str, list] = {n: [] for n in _SETS_ARROW.names}
        for i, keys, offs, p, owner in batches:
            d1, d2 = digests(keys, offs)
            m = [min_hashes(keys, offs, s) for s in SEEDS]
            hit = C.member(p, wanted)
            p, owner = p[hit], owner[hit]
            at = np.searchsorted(owner, np.arange(len(offs)))
            points = count_points(keys, offs)
            for d in range(len(offs) - 1):
                row = (ids[i + d], offs[d + 1] - offs[d], d1.view(np.int64)[d], d2.view(np.int64)[d], m[0].view(np.int64)[d], m[1].view(np.int64)[d])
                mine = p[at[d] : at[d + 1]]
                row += (points[d].tobytes(), keys[offs[d] : offs[d + 1]].view(np.int64), mine.view(np.int64)) if len(mine) else (None, None, None)
                for name, value in zip(_SETS_ARROW.names, row):
                    out[name].append(value)
        return pa.table(out, schema=_SETS_ARROW)

    sent = "cell int, bucket int, keys binary"
    back = C.shared_keys(dealt.groupBy("cell").applyInArrow(C.tidy(look_up), sent)).withColumn("level", F.lit(0))
    more = C.shared_keys(dealt.groupBy("cell").cogroup(back.groupBy("cell")).applyInArrow(C.tidy(ask), sent)).withColumn("level", F.lit(1))
    answers = back.unionByName(more)
    return C.cut(dealt.groupBy("cell").cogroup(answers.groupBy("cell")).applyInArrow(C.tidy(answer), _SETS))


def near_duplicates(docs: DataFrame, threshold: int = 80, shingle: int = 5, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Components of documents whose shingle sets have Jaccard similarity >= threshold %.

    Returns ``doc_id, n_shingles, component_id``, one row per input row; component_id is
    the smallest doc_id reachable by links, itself included.  Null and empty texts and
    texts without words have empty sets and link with nothing.  Repeated rows (one id
    twice) are one node.  Rows with a null id link with nothing: their component_id is
    null.  Other columns are ignored.  An empty table gives an empty result.
    """
    every_row, docs = docs, docs.where(F.col(id_col).isNotNull())
    total = C.column_bytes(docs, text_col)
    n_cells, n_buckets = C.parts(total, C.CELL_BYTES), C.parts(total, C.BUCKET_BYTES)
    every = _candidate_sets(docs, threshold, shingle, n_cells, n_buckets, id_col, text_col)
    C.release(docs.sparkSession)
    nodes = every.select("doc_id", "n_shingles", "d1", "d2").distinct()
    filled = nodes.where("n_shingles > 0")
    classes = filled.groupBy("d1", "d2", "n_shingles").agg(F.min("doc_id").alias("rep"), F.count("*").alias("copies"))
    classes = C.cut(classes)
    same = filled.join(classes.where("copies > 1"), ["d1", "d2", "n_shingles"]).where("doc_id <> rep").select(F.col("doc_id").alias("b"), F.col("rep").alias("a"))
    sets = every.where(F.col("shingles").isNotNull()).join(classes.select(F.col("rep").alias("doc_id")), "doc_id").dropDuplicates(["doc_id"])

    stars = None
    for m in ("m1", "m2"):
        leaders = sets.groupBy(m).agg(F.min("doc_id").alias("a"), F.count("*").alias("n")).where("n > 1")
        star = sets.select(F.col("doc_id").alias("b"), m).join(leaders, m).where("a <> b").select("a", "b")
        stars = star if stars is None else stars.union(star)
    seeds = C.cut(_verify(stars.distinct(), sets, threshold))
    first = connected_components(seeds)
    C.release(docs.sparkSession)

    labelled = sets.join(first.withColumnRenamed("node", "doc_id"), "doc_id", "left").withColumn("component", F.coalesce("component", "doc_id"))
    keyed = labelled.select("doc_id", "component", F.explode("keys").alias("key"))
    open_keys = keyed.groupBy("key").agg(F.min("component").alias("lo"), F.max("component").alias("hi")).where("lo < hi").select("key")
    block_rows = keyed.join(open_keys, "key").join(labelled.select("doc_id", "n_shingles", "points"), "doc_id")
    bucketed = block_rows.withColumn("bucket", F.pmod(F.xxhash64("key"), F.lit(n_buckets)))
    candidates = bucketed.groupBy("bucket").applyInArrow(C.tidy(lambda table: _block_pairs(table, threshold)), "a long, b long").distinct()
    links = _verify(candidates, sets, threshold)
    edges = C.cut(seeds.union(links).union(same.select("a", "b")))
    final = connected_components(edges)
    return (
        every.select("doc_id", "n_shingles")
        .join(final.withColumnRenamed("node", "doc_id"), "doc_id", "left")
        .select("doc_id", "n_shingles", F.coalesce("component", "doc_id").alias("component_id"))
        .union(_without_id(every_row, shingle, id_col, text_col))
    )


def _without_id(docs: DataFrame, shingle: int, id_col: str, text_col: str) -> DataFrame:
    """Rows with a null id: the sizes of their sets, and no component."""

    def run(batches):
        for batch in batches:
            table = pa.table({"text": batch.column("text")})
            sizes = [np.diff(offs) for _, _, offs in shingle_sets(table, shingle)]
            n = pa.array(np.concatenate(sizes) if sizes else np.empty(0, np.int64), pa.int64())
            none = pa.nulls(len(n), pa.int64())
            yield pa.RecordBatch.from_arrays([none, n, none], names=["doc_id", "n_shingles", "component_id"])

    rows = docs.where(F.col(id_col).isNull()).select(F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    return rows.mapInArrow(C.tidy(run), "doc_id long, n_shingles long, component_id long")


def _level(back: pa.Table, level: int) -> pa.Table:
    return back.filter(pa.array(back.column("level").to_numpy(zero_copy_only=False) == level)) if back.num_rows else back


def _first_of_equal(keys: np.ndarray, offs: np.ndarray, seen: set) -> np.ndarray:
    """Mask of sets not met before in this cell; ``seen`` holds their digests."""
    d1, d2 = digests(keys, offs)
    out = np.zeros(len(d1), bool)
    for k, pair in enumerate(zip(d1.tolist(), d2.tolist())):
        if pair not in seen:
            seen.add(pair)
            out[k] = True
    return out
