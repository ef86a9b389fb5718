"""Exact top-k search that prunes by segment statistics of several resolutions."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import Column, DataFrame, Window, functions as F

# Most rows of a tile: its vectors are one task's memory, 128 MB at 64 dimensions.
TILE_ROWS = 1 << 17
TILE_QUERIES = 1 << 12
# Segments of a vector, coarse to fine.
RESOLUTIONS = (4, 16)
# Queries whose bounds are worked out together.
CHUNK = 64
_EXACT = 2.0**53

FOUND = "query_id long, query_part long, vec_id long, score long"


def _usable(vector: Column) -> Column:
    """Whether a vector takes part: not null, and all components finite."""
    finite = F.forall(
        vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) < float("inf"))
    )
    return vector.isNotNull() & finite


def _matrix(table: pa.Table, width: int) -> np.ndarray:
    """Components as integers floor(256 x), a row per vector, filled up with zeros."""
    lists = table.column("embedding").combine_chunks()
    if isinstance(lists, pa.ChunkedArray):
        lists = lists.chunk(0) if lists.num_chunks else pa.array([], lists.type)
    lengths = np.asarray(lists.value_lengths())
    values = np.floor(np.asarray(lists.flatten()).astype("f8") * 256)
    if len(lengths) and (lengths == width).all():
        return values.reshape(-1, width)
    out = np.zeros((len(lengths), width))
    out[np.arange(width) < lengths[:, None]] = values
    return out


def _statistics(vectors: np.ndarray, segments: int) -> np.ndarray:
    """Per segment its mean and deviation, both times the root of its length.

    With these, |q - x|^2 is at least the squared distance of the statistics,
    and |x|^2 is exactly their squared length; so q.x is at most their product.
    """
    parts = vectors.reshape(len(vectors), segments, -1)
    length = parts.shape[2]
    means = parts.mean(axis=2)
    deviations = np.sqrt(np.maximum((parts * parts).mean(axis=2) - means * means, 0))
    return np.concatenate((means, deviations), axis=1) * np.sqrt(length)


def _best(scores: np.ndarray, k: int) -> np.ndarray:
    """Places of the k highest scores; of equal ones, those that come first."""
    if len(scores) > 4 * k:
        least = np.partition(scores, len(scores) - k)[len(scores) - k]
        places = np.flatnonzero(scores >= least)
    else:
        places = np.arange(len(scores))
    return places[np.argsort(-scores[places], kind="stable")[:k]]


def _search(queries: pa.Table, rows: pa.Table, k: int) -> dict[str, np.ndarray]:
    """The k best of ``rows`` for each of ``queries``, all scores exact."""
    ids = rows.column("vec_id").to_numpy()
    order = np.argsort(ids, kind="stable")
    ids = ids[order]
    longest = max(
        (pa.compute.max(pa.compute.list_value_length(t.column("embedding"))).as_py() or 0 for t in (queries, rows)),
        default=0,
    )
    finest = RESOLUTIONS[-1]
    width = max(finest, -(-longest // finest) * finest)
    x, q = _matrix(rows, width)[order], _matrix(queries, width)
    q_ids, q_parts = queries.column("vec_id").to_numpy(), queries.column("query_part").to_numpy()
    out: dict[str, list] = {"query_id": [], "query_part": [], "vec_id": [], "score": []}

    def emit(i: int, vec_ids: np.ndarray, scores: np.ndarray) -> None:
        out["query_id"].append(np.full(len(vec_ids), q_ids[i]))
        out["query_part"].append(np.full(len(vec_ids), q_parts[i]))
        out["vec_id"].append(vec_ids)
        out["score"].append(scores.astype("i8"))

    if len(x) and len(q) and width * np.abs(x).max() * np.abs(q).max() >= _EXACT:
        # Too large for exact doubles: whole numbers of any size, held to 64 bits.
        for i in range(len(q)):
            others = np.flatnonzero(ids != q_ids[i])
            scores = [
                min(max(sum(int(a) * int(b) for a, b in zip(q[i], x[j])), -(2**63)), 2**63 - 1) for j in others
            ]
            place = sorted(range(len(others)), key=lambda n: (-scores[n], n))[:k]
            emit(i, ids[others[place]], np.array([scores[n] for n in place], dtype="i8"))
        return {name: np.concatenate(v) if v else np.array([], "i8") for name, v in out.items()}

    levels = [(_statistics(x, n), _statistics(q, n)) for n in RESOLUTIONS]
    slack = 1e-9 * width * (np.abs(x).max(initial=0) * np.abs(q).max(initial=0)) + 1e-6
    for at in range(0, len(q), CHUNK):
        chunk = slice(at, at + CHUNK)
        own = ids[None, :] == q_ids[chunk, None]
        bound = np.where(own, -np.inf, levels[0][1][chunk] @ levels[0][0].T)
        # Exact scores of the rows with the highest coarse bounds: k of them
        # are a level that the k best reach.
        likely = min(len(x), 8 * k)
        first = np.argpartition(-bound, likely - 1, axis=1)[:, :likely] if likely else np.zeros((len(bound), 0), int)
        level = np.full(len(bound), -np.inf)
        for i in range(len(bound)):
            places = first[i][np.isfinite(bound[i][first[i]])]
            if len(places) >= k:
                level[i] = np.partition(x[places] @ q[at + i], len(places) - k)[len(places) - k]
        left = np.arange(len(x))
        for data, asked in levels:
            bound = asked[chunk] @ data[left].T
            bound[own[:, left]] = -np.inf
            left = left[(bound >= level[:, None] - slack).any(axis=0)]
        scores = q[chunk] @ x[left].T
        scores[own[:, left]] = -np.inf
        for i in range(len(scores)):
            places = _best(scores[i], k)
            places = places[np.isfinite(scores[i][places])]
            emit(at + i, ids[left[places]], scores[i][places])
    return {name: np.concatenate(v) if v else np.array([], "i8") for name, v in out.items()}


def top_k(queries: DataFrame, vectors: DataFrame, k: int = 5) -> DataFrame:
    """The k rows of ``vectors`` with the highest inner product, for each query.

    Both need vec_id and embedding; columns query_id, rank (from 1), vec_id and
    score come back. Components count as floor(256 x). Candidates are all rows of
    another id; ties go to the smaller id. Vectors that are null or hold null or
    non-finite components take no part, and neither do rows without an id.
    Shorter vectors count as filled up with zeros. Repeated rows are candidates
    each; a query id that stands for several different vectors is asked once with each,
    repeated rows of one vector once. Fewer than k candidates give fewer rows;
    an empty table none. Scores beyond 64 bits are held to the nearest long.

    Rows and queries are dealt evenly, whatever they hold, into tiles; each pair
    of a row tile and a query tile is a task's work of bounded size. A tile
    compares segment statistics, coarse to fine, and computes exact scores for
    the rows that some query of the chunk may still want.
    """
    spark = vectors.sparkSession
    asked = (
        queries.select("vec_id", "embedding")
        .filter(F.col("vec_id").isNotNull() & _usable(F.col("embedding")))
        .dropDuplicates()
        .withColumn("query_part", F.xxhash64("embedding"))
    )
    rows = vectors.select("vec_id", "embedding").filter(F.col("vec_id").isNotNull() & _usable(F.col("embedding")))
    parallel = int(spark.conf.get("spark.sql.shuffle.partitions"))
    row_tiles = max(parallel, -(-vectors.count() // TILE_ROWS))
    query_tiles = max(1, -(-queries.count() // TILE_QUERIES))

    # A row's deal depends on its values and its part of the scan; repeated rows are spread.
    # A query stands once and after a shuffle, where parts and places may change
    # when a task runs again, so its deal depends on its values only.
    value = F.xxhash64("vec_id", "embedding")
    salt = F.xxhash64("vec_id", "embedding", F.spark_partition_id(), F.monotonically_increasing_id())

    def dealt(df: DataFrame, by: Column, own: str, n: int, other: str, m: int) -> DataFrame:
        return df.withColumn(own, F.pmod(by, F.lit(n)).cast("int")).withColumn(
            other, F.explode(F.sequence(F.lit(0), F.lit(m - 1)))
        )

    left = dealt(asked, value, "query_tile", query_tiles, "row_tile", row_tiles)
    right = dealt(rows, salt, "row_tile", row_tiles, "query_tile", query_tiles)

    def search(asked_tile: pa.Table, row_tile: pa.Table) -> pa.Table:
        if not len(asked_tile) or not len(row_tile):
            found = {name: np.array([], "i8") for name in ("query_id", "query_part", "vec_id", "score")}
        else:
            found = _search(asked_tile, row_tile, k)
        return pa.table({name: pa.array(values, pa.int64()) for name, values in found.items()})

    found = (
        left.groupBy("row_tile", "query_tile")
        .cogroup(right.groupBy("row_tile", "query_tile"))
        .applyInArrow(search, FOUND)
    )
    order = Window.partitionBy("query_id", "query_part").orderBy(F.desc("score"), "vec_id")
    return (
        found.withColumn("rank", F.row_number().over(order))
        .filter(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )


def report(vectors: DataFrame, every: int = 50, k: int = 5) -> DataFrame:
    """The k best rows for each row whose vec_id is divisible by ``every``."""
    return top_k(vectors.filter(F.col("vec_id") % every == 0), vectors, k)
