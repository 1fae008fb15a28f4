"""Read-side queries: exact nearest neighbours, terms with top hits, postings and BM25, embeddings and their cache."""

from __future__ import annotations

import functools
import hashlib
import time
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from folioforge.functions.text import analyse_french


def cosine(a: Column, b: Column) -> Column:
    dot = lambda x, y: F.aggregate(F.zip_with(x, y, lambda p, q: p.cast("double") * q.cast("double")), F.lit(0.0), lambda s, v: s + v)
    return dot(a, b) / F.sqrt(dot(a, a) * dot(b, b))


def nearest(vectors: DataFrame, query: list[float], k: int = 5, key: str = "vec_id", column: str = "embedding") -> DataFrame:
    """The k most similar rows, exactly; the query is a literal, so each row is scored in its scan and k rows leave a task."""
    q = F.array(*[F.lit(float(x)) for x in query])
    return vectors.select(key, F.round(cosine(F.col(column), q), 6).alias("score")).orderBy(F.col("score").desc(), key).limit(k)


def _blocks(vectors: DataFrame, key: str, column: str, rows: int) -> DataFrame:
    """block: at most `rows` keys and vectors, gathered without Python; vectors that are null go."""
    some = vectors.select(F.col(key).cast("long").alias("k"), F.col(column).cast("array<double>").alias("v")).filter("k is not null and v is not null")
    numbered = some.withColumn("at", F.expr(f"monotonically_increasing_id() div {rows}"))  # a partition's ids are in a row, its first a multiple of 2^33
    return numbered.groupBy("at").agg(F.collect_list(F.struct("k", "v")).alias("block")).select("block")


def _matrix(block: pa.ListScalar) -> tuple[np.ndarray, np.ndarray]:
    """Keys, and vectors as rows."""
    keys, v = block.values.field("k"), block.values.field("v")
    sizes = np.diff(v.offsets.to_numpy())
    if (sizes != sizes[0]).any():
        raise ValueError("vectors of several lengths")
    return keys.to_numpy(), v.flatten().to_numpy(zero_copy_only=False).reshape(len(keys), sizes[0])


def _best(q: np.ndarray, m: np.ndarray, keys: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Places in q, places in m and scores of the k best of each q: by score, then key. What isn't above the k-th score isn't sorted."""
    with np.errstate(invalid="ignore", divide="ignore"):
        low = -np.round(q @ m.T / np.sqrt((q * q).sum(1)[:, None] * (m * m).sum(1)), 6)
    last = np.partition(low, k - 1, 1)[:, k - 1] if k < len(keys) else np.full(len(q), np.inf)  # no score: last
    i, j = np.nonzero(low <= np.where(np.isnan(last), np.inf, last)[:, None])
    order = np.lexsort((keys[j], low[i, j], i))
    i, j = i[order], j[order]
    first = np.arange(len(i)) - np.searchsorted(i, i) < k
    i, j = i[first], j[first]
    return i, j, -low[i, j]


def nearest_all(vectors: DataFrame, queries: DataFrame, k: int = 5, key: str = "vec_id", column: str = "embedding", block: int = 256) -> DataFrame:
    """query_id, key, score and rank: the k most similar rows of each row of queries, exactly; keys are whole numbers.

    Blocks of queries meet blocks of rows in the one Python step, which holds the scores of
    `block` queries and one block of rows. k rows a query leave each pair of blocks and are
    ranked by rounded score, then key. A vector of zeros has no score. Queries are brought
    together first, or each file's few would be a block that all rows are sent to.
    """
    rows = _blocks(vectors, key, column, 8 * block)
    asked = _blocks(queries.hint("rebalance"), key, column, 8 * block).select(F.col("block").alias("asked"))

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            for one, other in zip(*part.columns):
                (keys, m), (ids, q) = _matrix(one), _matrix(other)
                for at in range(0, len(ids), block):
                    i, j, scores = _best(q[at : at + block], m, keys, k)
                    yield pa.RecordBatch.from_arrays([pa.array(ids[at + i]), pa.array(keys[j]), pa.array(scores)], names=["query_id", key, "score"])

    found = rows.crossJoin(asked).mapInArrow(run, f"query_id long, `{key}` long, score double")
    ranked = found.withColumn("rank", F.row_number().over(W.partitionBy("query_id").orderBy(F.col("score").desc(), key)))
    return ranked.filter(F.col("rank") <= k)


def terms(df: DataFrame, outer: str, inner: str, size: int, key: str, hits: int = 5) -> DataFrame:
    """Counts by outer and inner term, the `size` most frequent inner ones of each outer one, and their first keys.

    Counts combine before they are shuffled. Keys are ranked behind a filter on the rank, which
    the engine applies before and after the shuffle, so a hot term sends `hits` keys a task.
    """
    counted = df.groupBy(outer, inner).agg(F.count("*").alias("n"))
    order = W.partitionBy(outer).orderBy(F.col("n").desc(), inner)
    best = counted.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= size)
    ranked = df.select(outer, inner, key).withColumn("_r", F.row_number().over(W.partitionBy(outer, inner).orderBy(key))).filter(F.col("_r") <= hits)
    first = ranked.groupBy(F.col(outer).alias("_o"), F.col(inner).alias("_i")).agg(F.array_join(F.array_sort(F.collect_list(key)).cast("array<string>"), ",").alias("top_ids"))
    return best.join(first, F.col(outer).eqNullSafe(F.col("_o")) & F.col(inner).eqNullSafe(F.col("_i"))).drop("_o", "_i")


def facets(df: DataFrame, outer: str, inner: dict[str, int], key: str, hits: int = 5) -> DataFrame:
    """outer, facet, term, n, top_ids, rank: terms() of several inner columns, each with a size of its own."""
    out = None
    for name, size in inner.items():
        one = terms(df, outer, name, size, key, hits).select(outer, F.lit(name).alias("facet"), F.col(name).cast("string").alias("term"), "n", "top_ids", "rank")
        out = one if out is None else out.unionByName(one)
    return out


def postings(docs: DataFrame, key: str, text: str, analyse: Callable[[Column], Column] = analyse_french) -> DataFrame:
    """term, key, tf, length: the inverted index."""
    tokens = docs.select(key, analyse(F.col(text)).alias("t")).withColumn("length", F.size("t"))
    return tokens.select(key, "length", F.explode("t").alias("term")).groupBy("term", key, "length").agg(F.count("*").alias("tf"))


def bm25(index: DataFrame, query: list[str], key: str, k: int = 10, k1: float = 1.2, b: float = 0.75) -> DataFrame:
    """The k best documents of an index for analysed query terms."""
    sizes = index.select(key, "length").distinct().agg(F.count("*").alias("n"), F.avg("length").alias("mean"))
    hit = index.filter(F.col("term").isin(list(query)))
    df = hit.groupBy("term").agg(F.count("*").alias("df"))
    hit = hit.join(df, "term").crossJoin(F.broadcast(sizes))  # one row, of a global aggregate
    idf = F.log(1 + (F.col("n") - F.col("df") + 0.5) / (F.col("df") + 0.5))
    score = idf * F.col("tf") * (k1 + 1) / (F.col("tf") + k1 * (1 - b + b * F.col("length") / F.col("mean")))
    return hit.groupBy(key).agg(F.sum(score).alias("score")).orderBy(F.col("score").desc(), key).limit(k)


def _hash(word: str) -> bytes:
    return hashlib.md5(word.encode()).digest()[:8]


_known = functools.lru_cache(1 << 17)(_hash)


def hashing_embedder(texts: list[str], size: int = 1024) -> np.ndarray:
    """Deterministic unit vectors of hashed words: stands in where no embedding service is given."""
    words = [t.lower().split() for t in texts]
    h = np.frombuffer(b"".join([_known(w) if len(w) < 64 else _hash(w) for ws in words for w in ws]), ">u8").astype(np.uint64)
    at = np.repeat(np.arange(len(texts)) * size, [len(ws) for ws in words]) + (h % np.uint64(size)).astype(np.int64)
    out = np.bincount(at, np.where(h >> np.uint64(63), 1.0, -1.0), len(texts) * size).reshape(-1, size).astype(np.float32)
    return out / np.maximum(np.linalg.norm(out, axis=1, keepdims=True), 1e-9)


def embed(chunks: DataFrame, embedder: Callable[[list[str]], np.ndarray] = hashing_embedder, batch: int = 64, retries: int = 4, retry_on: tuple = (OSError,), sleep: Callable[[float], None] = time.sleep) -> DataFrame:
    """Adds embedding, `batch` texts a call; after an error of a kind in retry_on (time-outs and refused
    connections are OSErrors) a call is made again after 1, 2, 4, ... 16 seconds, `retries` times in all."""

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            for at in range(0, part.num_rows, batch):
                some = part.slice(at, batch)
                for turn in range(retries):
                    try:
                        v = embedder(some.column("embed_text").to_pylist())
                        break
                    except retry_on:
                        if turn == retries - 1:
                            raise
                        sleep(min(16, 2**turn))
                v = np.asarray(v, np.float32)
                ends = pa.array(np.arange(v.shape[0] + 1) * v.shape[1], pa.int32())
                yield pa.RecordBatch.from_arrays([*some.columns, pa.ListArray.from_arrays(ends, pa.array(v.ravel()))], names=[*some.schema.names, "embedding"])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in chunks.schema) + ", embedding array<float>"
    return chunks.mapInArrow(run, schema)


def cache_hits(chunks: DataFrame, cache: DataFrame) -> DataFrame:
    """key and valid: the cache serves a key only with the same hash, the same chunks and at least one.

    chunks: key, content_hash, id; cache: key, content_hash, id.
    """
    now = chunks.select("key", "id", F.col("content_hash").alias("hash_now")).distinct()
    old = cache.select("key", "id", F.col("content_hash").alias("hash_then")).distinct()
    both = now.join(old, ["key", "id"], "full_outer")
    same = F.bool_and(F.coalesce(F.col("hash_now") == F.col("hash_then"), F.lit(False)))
    return both.groupBy("key").agg((same & (F.count("hash_now") > 0)).alias("valid"))


def content_hash(record: Column) -> Column:
    """Hash of a record's text, as it is: equal texts, equal hashes."""
    return F.sha1(record.cast("binary"))


def save_cache(embedded: DataFrame, path: str, buckets: int = 64) -> None:
    """key, content_hash, id, embedding as files by bucket of the key."""
    rows = embedded.select("key", "content_hash", "id", "embedding", F.pmod(F.xxhash64("key"), F.lit(buckets)).alias("bucket"))
    rows.write.mode("overwrite").partitionBy("bucket").option("compression", "gzip").parquet(path)


def embed_cached(chunks: DataFrame, cache: DataFrame | None, **options) -> DataFrame:
    """chunks (key, content_hash, id, embed_text, ...) with embedding and cached: keys that the cache
    serves as a whole take theirs from it, all chunks of the others are embedded again.

    With a cache chunks are read three times, so they should be stored, not a long plan."""
    if cache is None:
        return embed(chunks, **options).withColumn("cached", F.lit(False))
    valid = cache_hits(chunks, cache).filter("valid").select("key")
    known = chunks.join(valid, "key", "left_semi").join(cache.select("key", "id", "embedding"), ["key", "id"])
    rest = embed(chunks.join(valid, "key", "left_anti"), **options)
    return known.withColumn("cached", F.lit(True)).unionByName(rest.withColumn("cached", F.lit(False)))
