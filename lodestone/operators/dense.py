"""Vectors: the hashing embedder, the embedding cache, exact top-k."""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


@dataclass(frozen=True)
class EmbedderConfig:
    """Identity of an embedding space."""

    backend: str = "hashing"
    model: str = "hashing"
    dim: int = 384
    query_prefix: str = ""
    passage_prefix: str = ""
    seed: int = 0

    @property
    def fingerprint(self) -> str:
        return hashlib.sha1("|".join(map(str, (self.backend, self.model, self.dim, self.query_prefix, self.passage_prefix))).encode()).hexdigest()[:12]


class Embedder:
    """What turns passages and queries into vectors of one space, perhaps in different ways.

    ``passages`` and ``queries`` take ``(id, text)`` columns of a DataFrame and return
    ``id, vector``; vectors have unit length, or are zero for empty texts.
    """

    config: EmbedderConfig

    def passages(self, df: DataFrame, id_col: str, text_col: str) -> DataFrame:
        raise NotImplementedError

    def queries(self, df: DataFrame, id_col: str, text_col: str) -> DataFrame:
        raise NotImplementedError


class HashingEmbedder(Embedder):
    """Signed counts of hashed tokens: shared words, not shared meaning; needs no model."""

    def __init__(self, dim: int = 384, seed: int | str = 0):
        self.seed = seed
        self.config = EmbedderConfig(model=f"hashing-{dim}d", dim=dim)

    def passages(self, df: DataFrame, id_col: str, text_col: str) -> DataFrame:
        return hash_vectors(df, self.config.dim, self.seed, id_col, text_col)

    queries = passages


#: What model families put in front of queries and of passages.
PREFIXES = {"e5": ("query: ", "passage: "), "bge": ("Represent this sentence for searching relevant passages: ", "")}


class ModelUnavailable(RuntimeError):
    """The embedding model's library or weights are not here."""


class ModelEmbedder(Embedder):
    """A sentence-transformers model, loaded once a worker; batches of 32 texts."""

    def __init__(self, model: str, batch: int = 32):
        try:
            from sentence_transformers import SentenceTransformer
        except ImportError as e:
            raise ModelUnavailable(f"sentence-transformers is not installed, so {model!r} cannot be loaded") from e
        q, p = next((v for family, v in PREFIXES.items() if family in model.lower()), ("", ""))
        self.model, self.batch = model, batch
        self.config = EmbedderConfig("sentence-transformers", model, int(SentenceTransformer(model).get_sentence_embedding_dimension()), q, p)

    def _encode(self, df: DataFrame, id_col: str, text_col: str, prefix: str) -> DataFrame:
        name, size = self.model, self.batch

        def run(batches):
            from sentence_transformers import SentenceTransformer

            model = SentenceTransformer(name)
            for b in batches:
                x = model.encode([prefix + (t or "") for t in b.column("text").to_pylist()], batch_size=size, convert_to_numpy=True)
                yield pa.RecordBatch.from_arrays([b.column("id"), _lists(_unit(x.astype(np.float64)))], names=["id", "vector"])

        rows = df.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
        return rows.mapInArrow(run, f"id {rows.schema['id'].dataType.simpleString()}, vector array<double>")

    def passages(self, df: DataFrame, id_col: str, text_col: str) -> DataFrame:
        return self._encode(df, id_col, text_col, self.config.passage_prefix)

    def queries(self, df: DataFrame, id_col: str, text_col: str) -> DataFrame:
        return self._encode(df, id_col, text_col, self.config.query_prefix)


def build_embedder(name: str, **options) -> Embedder:
    """``hashing`` (or ``hashing-384d``) needs no model; any other name is a model to load."""
    if name.startswith("hashing"):
        dim = name.removeprefix("hashing").strip("-").removesuffix("d")
        return HashingEmbedder(**({"dim": int(dim)} if dim else {}), **options)
    return ModelEmbedder(name, **options)


def _unit(x: np.ndarray) -> np.ndarray:
    norm = np.sqrt((x * x).sum(axis=1, keepdims=True))
    return x / np.where(norm > 0, norm, 1)


def _lists(x: np.ndarray) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1, dtype=np.int32) * x.shape[1]), pa.array(x.ravel()))


def hash_vectors(docs: DataFrame, dim: int = 384, seed: int | str = 0, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id, vector``: unit vectors of signed hashed tokens, a map of each row with no shuffle.

    Tokens are found by Spark; each different token of a batch is hashed once.  A token
    adds 1 or -1 at the place its digest names.
    """

    def run(batches):
        for batch in batches:
            lists = batch.column("tokens")
            for at in range(0, len(lists), 1024):
                part = lists.slice(at, 1024)
                words = part.flatten().dictionary_encode()
                digests = [hashlib.md5(f"{seed}:{w}".encode()).digest() for w in words.dictionary.to_pylist()]
                place = np.array([int.from_bytes(d[:4], "little") % dim for d in digests], np.int64)
                sign = np.array([1.0 if d[4] % 2 else -1.0 for d in digests])
                code = words.indices.to_numpy(zero_copy_only=False)
                owner = np.repeat(np.arange(len(part)), np.diff(part.offsets.to_numpy()))
                x = np.bincount(owner * dim + place[code], weights=sign[code], minlength=len(part) * dim) if len(code) else np.zeros(len(part) * dim)
                yield pa.RecordBatch.from_arrays([batch.column("id").slice(at, 1024), _lists(_unit(x.reshape(-1, dim)))], names=["id", "vector"])

    tokens = F.regexp_extract_all(F.lower(F.coalesce(F.col(text_col), F.lit(""))), F.lit(r"[\p{L}\p{N}_]+"), F.lit(0))
    rows = docs.select(F.col(id_col).alias("id"), tokens.alias("tokens"))
    return rows.mapInArrow(run, f"id {rows.schema['id'].dataType.simpleString()}, vector array<double>")


def hash_embed(docs: DataFrame, dim: int = 384, seed: int | str = 0, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id, slot, value``: the embedding in sparse form (empty texts have no rows)."""
    rows = hash_vectors(docs, dim, seed, id_col, text_col).select("id", F.posexplode("vector").alias("slot", "value"))
    return rows.where("value <> 0").select("id", F.col("slot").cast("long").alias("slot"), "value")


def normalise(vector: Column) -> Column:
    """Unit length; the zero vector stays zero."""
    norm = F.sqrt(F.aggregate(vector, F.lit(0.0), lambda a, x: a + x * x))
    return F.when(norm > 0, F.transform(vector, lambda x: (x / norm).cast("float"))).otherwise(vector)


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, x: s + x)


#: Query vectors that may travel to every executor, and those of a block beyond that.
MAX_BROADCAST, QUERY_BLOCK = 8192, 4096
#: Queries and passages of one matrix product.
TILE = (256, 4096)
_HITS = "query_id long, record_ord long, score double"


class _Best:
    """The best ``k`` passages of each query so far; ties go to the smaller record."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, k: int):
        self.ids, self.q, self.k = ids, vectors, k
        self.score = np.empty((len(ids), 0))
        self.record = np.empty((len(ids), 0), np.int64)

    def add(self, records: np.ndarray, vectors: np.ndarray) -> None:
        for a in range(0, len(records), TILE[1]):
            part, x = records[a : a + TILE[1]], vectors[a : a + TILE[1]].T
            kept = [self._merge(slice(b, b + TILE[0]), part, x) for b in range(0, len(self.ids), TILE[0])]
            if kept:
                self.score, self.record = (np.concatenate(c) for c in zip(*kept))

    def _merge(self, rows: slice, records: np.ndarray, x: np.ndarray):
        new = self.q[rows] @ x
        s = np.concatenate((self.score[rows], new), axis=1)
        r = np.concatenate((self.record[rows], np.broadcast_to(records, new.shape)), axis=1)
        order = np.lexsort((r, -np.round(s, 12)), axis=1)[:, : self.k]
        return np.take_along_axis(s, order, 1), np.take_along_axis(r, order, 1)

    def batch(self) -> pa.RecordBatch:
        n = self.score.shape[1]
        return pa.RecordBatch.from_arrays([pa.array(np.repeat(self.ids, n), pa.int64()), pa.array(self.record.ravel(), pa.int64()), pa.array(self.score.ravel(), pa.float64())], names=["query_id", "record_ord", "score"])


def _matrix(column) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    if isinstance(column, pa.ChunkedArray):
        column = pa.concat_arrays(column.chunks)
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), -1) if len(column) else np.empty((0, 0))


def dense_top_k(passages: DataFrame, queries: DataFrame, k: int, max_broadcast: int = MAX_BROADCAST) -> DataFrame:
    """Exact inner-product top-k: ``query_id, record_ord, score, rank``.

    ``passages(record_ord, vector)``, ``queries(query_id, vector)``; rows without a
    vector are left out.  Up to ``max_broadcast`` queries travel to every executor, and
    passages are scanned once where they are.  More queries are cut into blocks, and
    each block meets each group of passages in a task of its own, so neither side is
    ever whole in one place.  Either way a task keeps k rows a query.
    """
    q = queries.where("vector is not null").select(F.col("query_id").cast("long").alias("query_id"), "vector")
    p = passages.where("vector is not null").select(F.col("record_ord").cast("long").alias("record_ord"), "vector")
    few = q.limit(max_broadcast + 1).toArrow()
    if few.num_rows <= max_broadcast:
        shared = passages.sparkSession.sparkContext.broadcast((few.column("query_id").to_numpy(), _matrix(few.column("vector"))))

        def run(batches):
            best = _Best(*shared.value, k)
            for batch in batches:
                if len(best.ids) and batch.num_rows:
                    best.add(batch.column("record_ord").to_numpy(), _matrix(batch.column("vector")))
            yield best.batch()

        found = p.mapInArrow(run, _HITS)
    else:
        n_blocks = -(-q.count() // QUERY_BLOCK)
        n_groups = max(8, -(-p.count() // 200_000))
        every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
        q = q.withColumn("block", F.pmod(F.xxhash64("query_id"), F.lit(n_blocks)).cast("int")).withColumn("part", every(n_groups))
        p = p.withColumn("part", F.pmod(F.xxhash64("record_ord"), F.lit(n_groups)).cast("int")).withColumn("block", every(n_blocks))

        def meet(left: pa.Table, right: pa.Table) -> pa.Table:
            best = _Best(left.column("query_id").to_numpy(), _matrix(left.column("vector")), k)
            if left.num_rows and right.num_rows:
                best.add(right.column("record_ord").to_numpy(), _matrix(right.column("vector")))
            return pa.Table.from_batches([best.batch()])

        found = q.groupBy("block", "part").cogroup(p.groupBy("block", "part")).applyInArrow(meet, _HITS)
    order = Window.partitionBy("query_id").orderBy(F.desc(F.round("score", 12)), "record_ord")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


# ---------------------------------------------------------------- the embedding cache


def load_cache(spark, path: str, config: EmbedderConfig) -> DataFrame:
    """``text_key, vector`` stored for this embedding space; vectors of another dimension, and a
    cache that is missing or cannot be read, are as if they were not there."""
    empty = spark.createDataFrame([], "text_key string, vector array<double>")
    try:
        held = spark.read.parquet(f"{path}/{config.fingerprint}")
        return held.select(F.col("text_key").cast("string").alias("text_key"), F.col("vector").cast("array<double>").alias("vector")).where(F.size("vector") == config.dim)
    except AnalysisException:
        return empty


def save_cache(fresh: DataFrame, path: str, config: EmbedderConfig) -> None:
    """Append ``text_key, vector`` rows; no rows write nothing."""
    if not fresh.isEmpty():
        fresh.select("text_key", "vector").write.mode("append").parquet(f"{path}/{config.fingerprint}")


def cache_lookup(records: DataFrame, cache: DataFrame, text_col: str = "text") -> DataFrame:
    """Records with their ``text_key`` and the cached vector (null: a miss)."""
    keyed = records.withColumn("text_key", F.left(F.sha1(F.col(text_col)), F.lit(20)))
    return keyed.join(cache.select("text_key", "vector").dropDuplicates(["text_key"]), "text_key", "left")


def cache_misses(records: DataFrame, cache: DataFrame, text_col: str = "text") -> DataFrame:
    keyed = records.withColumn("text_key", F.left(F.sha1(F.col(text_col)), F.lit(20)))
    return keyed.join(cache.select("text_key"), "text_key", "left_anti")
