"""Nearest neighbours by a block matrix join, exact.

Vectors are packed into blocks of rows. The queries are dealt to groups of
bounded size, and so are the candidates; each pair of groups is one task, which
holds its queries and lets the candidates' blocks pass one by one. (Queries
come first in a task's sorted partition.)

A tile is a block of candidates against some queries. Vectors are quantised to
int8 with a scale of their own, and the tile's inner products of int8 are whole
numbers, computed exactly by a float matrix product (slabs of ``_SLAB``
dimensions stay under ``2 ** 24``). By Cauchy and Schwarz such a product is off
by at most ``|q| |c - c'| + |q - q'| |c'|``. A pair survives unless that bound puts
it below the query's k-th best score so far, or, before there are k, below the
(k+1)-th best lower bound of the tile (the query itself may be among these).
Survivors are computed anew from the original vectors in double precision,
added up from the first dimension to the last, and go to the query's heap.
The heaps of a query's tasks are merged by a heap, too. No pair that could be
among the k is left out, so recall is 1.

Of equal candidates only the ``k + 1`` with the smallest ids can be among any
query's nearest; the others go before the join, by a window that cuts in the map
tasks first. So copies in any number cost their own lookup as queries and
nothing else.

Work is queries times candidates. A candidate is sent once for each group of
queries (``QUERY_ROWS``) and a query once for each group of candidates
(``CANDIDATE_ROWS``, or fewer where the session has more tasks to fill).

Defined results: rows whose vector is null, empty, zero, or holds null or
non-finite entries take no part, nor do vectors of another length than most
(``vectors.usable``); ties in score go to the smaller id, a null id last; rows
with a null id are candidates and no queries; repeated rows are rows of their
own: each has its result, in which the others appear; with fewer than k
candidates all are returned; an empty table, or one without queries, gives an
empty result; columns beyond the two named are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from heapq import heappush, heappushpop

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starmart.llm.common import shuffle_partitions, stage
from starmart.llm.vectors import matrix, usable

NEAREST = 20
QUERY_ROWS = 1 << 14  # of a group, held by a task
CANDIDATE_ROWS = 1 << 18  # of a group, passing through a task
_BLOCK_ENTRIES = 1 << 16  # of a packed block: 1,024 vectors of 64
_TILE = 2048  # queries of a tile
_PAIRS = 1 << 15  # survivors computed at once
_SLAB = 1024  # 127 * 127 * 1024 < 2 ** 24
_BLOCKS = "block long, rows int, numbers binary, ids binary, known binary, vectors binary"
_FOUND = "row long, query_id long, scores array<double>, ids array<long>"
_RESULT = "query_id long, rank int, vec_id long, score double"


def _pack(dim: int):
    """Rows to blocks: ``row``, ``vec_id`` and vectors of each as packed arrays."""
    size = max(16, _BLOCK_ENTRIES // dim)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = TaskContext.get().partitionId() << 32
        for batch in batches:
            for at in range(0, batch.num_rows, size):
                part = batch.slice(at, size)
                ids = part.column(1)
                packed = [
                    np.asarray(part.column(0)).tobytes(),
                    np.asarray(ids.fill_null(0)).tobytes(),
                    np.asarray(ids.is_valid()).tobytes(),
                    np.ascontiguousarray(matrix(part.column(2), dim)).tobytes(),
                ]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([block]), pa.array([part.num_rows], pa.int32()), *[pa.array([x], pa.binary()) for x in packed]],
                    ["block", "rows", "numbers", "ids", "known", "vectors"],
                )
                block += 1

    return run


class Quantised:
    """Rows as int8 with a scale each, their norms and what quantising took away."""

    def __init__(self, numbers: np.ndarray, ids: np.ndarray, known: np.ndarray, vectors: np.ndarray):
        self.numbers, self.ids, self.known = numbers, ids, known
        self.vectors = v = vectors.astype(np.float64)
        top = np.abs(v).max(axis=1)
        # Scaled by its largest entry first, so that no norm leaves the range of a double.
        self.scale = np.maximum(top / 127.0, np.finfo(float).tiny)
        codes = np.rint(v / self.scale[:, None]).clip(-127, 127)
        self.codes = codes.astype(np.float32)  # whole numbers of 8 bits
        near = codes * self.scale[:, None]

        def norm(m: np.ndarray) -> np.ndarray:
            return top * np.sqrt(np.square(m / np.maximum(top, np.finfo(float).tiny)[:, None]).sum(axis=1))

        # A little more than computed, for what rounding takes.
        self.norm, self.near, self.lost = (norm(m) * (1 + 1e-9) + 1e-12 * top for m in (v, near, v - near))

    def rows(self, which: slice) -> Quantised:
        part = object.__new__(Quantised)
        part.__dict__ = {name: values[which] for name, values in self.__dict__.items()}
        return part


def products(a: Quantised, b: Quantised) -> np.ndarray:
    """int8 inner products of a tile, whole numbers, scaled."""
    total = np.zeros((len(a.codes), len(b.codes)))
    for at in range(0, a.codes.shape[1], _SLAB):
        total += a.codes[:, at : at + _SLAB] @ b.codes[:, at : at + _SLAB].T
    total *= a.scale[:, None]
    total *= b.scale[None, :]
    return total


def exact(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Inner products of paired rows in double precision, from the first dimension to the last."""
    return np.cumsum(a * b, axis=1)[:, -1] + 0.0


def survivors(q: Quantised, c: Quantised, least: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of a tile that may be among the k: ``least`` is each query's k-th score so far, or minus infinity."""
    about = products(q, c)
    off = q.norm[:, None] * c.lost[None, :]
    off += q.lost[:, None] * c.near[None, :]
    least = least.copy()
    free = np.flatnonzero(least == -np.inf)
    if len(free) and about.shape[1] > k:
        lower = about[free] - off[free]
        least[free] = np.partition(lower, lower.shape[1] - k - 1, axis=1)[:, lower.shape[1] - k - 1]
    about += off
    return np.nonzero(~(about < least[:, None]))  # a product out of range compares with nothing and survives


class Search:
    """The queries of a task and a heap for each: the worst entry is on top."""

    def __init__(self, parts: list[Quantised], k: int):
        self.parts, self.k = parts, k
        self.heaps: list[list[list[tuple]]] = [[[] for _ in part.numbers] for part in parts]
        self.least = [np.full(len(part.numbers), -np.inf) for part in parts]

    def add(self, c: Quantised) -> None:
        for part, heaps, least in zip(self.parts, self.heaps, self.least):
            qi, ci = survivors(part, c, least, self.k)
            own = part.numbers[qi] == c.numbers[ci]
            qi, ci = qi[~own], ci[~own]
            for at in range(0, len(qi), _PAIRS):
                i, j = qi[at : at + _PAIRS], ci[at : at + _PAIRS]
                score = exact(part.vectors[i], c.vectors[j])
                keep = score >= least[i]
                i, j, score = i[keep], j[keep], score[keep]
                for a, s, known, d in zip(i.tolist(), score.tolist(), c.known[j].tolist(), c.ids[j].tolist()):
                    # Larger is better: the score, then a known id, then the smaller one.
                    entry, heap = (s, known, -d), heaps[a]
                    if len(heap) < self.k:
                        heappush(heap, entry)
                    elif entry > heap[0]:
                        heappushpop(heap, entry)
                for a in np.unique(i).tolist():
                    if len(heaps[a]) == self.k:
                        least[a] = heaps[a][0][0]

    def found(self) -> pa.RecordBatch | None:
        rows = []
        for part, heaps in zip(self.parts, self.heaps):
            for number, query, heap in zip(part.numbers.tolist(), part.ids.tolist(), heaps):
                if heap:
                    best = sorted(heap, reverse=True)
                    rows.append((number, query, [e[0] for e in best], [-e[2] if e[1] else None for e in best]))
        if not rows:
            return None
        kinds = (pa.int64(), pa.int64(), pa.list_(pa.float64()), pa.list_(pa.int64()))
        names = ["row", "query_id", "scores", "ids"]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names)


def _join(dim: int, kind: str, k: int):
    """Partitions sorted by group pair, queries first: a search for each pair."""

    def unpacked(row: dict) -> tuple[np.ndarray, ...]:
        return (
            np.frombuffer(row["numbers"], np.int64),
            np.frombuffer(row["ids"], np.int64),
            np.frombuffer(row["known"], np.bool_),
            np.frombuffer(row["vectors"], kind).reshape(-1, dim),
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair, held, search = None, [], None
        for batch in batches:
            for at in range(batch.num_rows):
                row = {name: batch.column(name)[at].as_py() for name in ("pair", "side", "numbers", "ids", "known", "vectors")}
                if row["pair"] != pair:
                    if search and (found := search.found()):
                        yield found
                    pair, held, search = row["pair"], [], None
                if row["side"] == 0:
                    held.append(unpacked(row))
                elif held or search:
                    if search is None:
                        whole = Quantised(*[np.concatenate(x) for x in zip(*held)])
                        held, n = [], len(whole.numbers)
                        search = Search([whole.rows(slice(a, a + _TILE)) for a in range(0, n, _TILE)], k)
                    search.add(Quantised(*unpacked(row)))
        if search and (found := search.found()):
            yield found

    return run


def _merge(k: int):
    """Rows sorted by query: the heaps of its tasks merged."""

    def closed(row: int, query: int, heap: list[tuple]) -> list[tuple]:
        best = sorted(heap, reverse=True)
        return [(query, rank, -e[2] if e[1] else None, e[0]) for rank, e in enumerate(best, 1)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, query, heap = None, None, []
        for batch in batches:
            out = []
            for row, q, scores, ids in zip(*[c.to_pylist() for c in batch.columns]):
                if row != now:
                    out += closed(now, query, heap)
                    now, query, heap = row, q, []
                for s, d in zip(scores, ids):
                    entry = (s, d is not None, -(d or 0))
                    if len(heap) < k:
                        heappush(heap, entry)
                    elif entry > heap[0]:
                        heappushpop(heap, entry)
                    else:
                        break  # the rest of a sorted list is no better
            if out:
                yield _ranked(out)
        if heap:
            yield _ranked(closed(now, query, heap))

    return run


def _ranked(rows: list[tuple]) -> pa.RecordBatch:
    kinds = (pa.int64(), pa.int32(), pa.int64(), pa.float64())
    return pa.RecordBatch.from_arrays(
        [pa.array(c, t) for c, t in zip(zip(*rows), kinds)], ["query_id", "rank", "vec_id", "score"]
    )


def _groups(blocks: DataFrame, number: int) -> Column:
    return F.pmod(F.xxhash64("block"), F.lit(number)).cast("int")


def nearest(
    df: DataFrame,
    queries: Column,
    k: int = NEAREST,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    query_rows: int = QUERY_ROWS,
    candidate_rows: int = CANDIDATE_ROWS,
) -> DataFrame:
    """``query_id, rank, vec_id, score``: the k candidates of the largest inner product for each row that ``queries`` picks.

    ``queries`` is a condition on ``vec_id``; every row but the query's own is
    its candidate.
    """
    spark = df.sparkSession
    rows, dim = usable(df, id_col, vector_col, nonzero=True)
    if not dim:
        return spark.createDataFrame([], _RESULT)
    # Written once: a row's number must be the same wherever it is read.
    rows = stage(rows.withColumn("row", F.monotonically_increasing_id()).select("row", "vec_id", "vector"))
    entry = rows.schema["vector"].dataType
    kind = "f4" if isinstance(entry.elementType, T.FloatType) else "f8"
    asked = rows.where(F.col("vec_id").isNotNull() & queries)
    first = Window.partitionBy("vector").orderBy(F.col("vec_id").asc_nulls_last(), "row")
    distinct = rows.withColumn("__copy", F.row_number().over(first)).where(F.col("__copy") <= k + 1)
    pack = _pack(dim)
    left, right = (
        stage(side.select("row", "vec_id", "vector").mapInArrow(pack, _BLOCKS)) for side in (asked, distinct)
    )
    sizes = [side.agg(F.coalesce(F.sum("rows"), F.lit(0)), F.count(F.lit(1))).first() for side in (left, right)]
    if not sizes[0][0]:
        return spark.createDataFrame([], _RESULT)
    by_query = -(-sizes[0][0] // min(query_rows, max(1, (1 << 22) // dim)))
    by_candidate = max(-(-sizes[1][0] // candidate_rows), min(sizes[1][1], -(-shuffle_partitions(spark) // by_query)))
    # A group pair's number is qg * by_candidate + cg; each side goes to all groups of the other.
    each = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    packed = [F.col(c) for c in ("numbers", "ids", "known", "vectors")]
    own = _groups(left, by_query) * by_candidate
    from_left = left.select(own.alias("own"), each(by_candidate).alias("other"), F.lit(0).alias("side"), *packed)
    own = _groups(right, by_candidate)
    from_right = right.select(own.alias("own"), each(by_query).alias("other"), F.lit(1).alias("side"), *packed)
    pairs = from_left.withColumn("pair", F.col("own") + F.col("other")).unionByName(
        from_right.withColumn("pair", F.col("own") + F.col("other") * by_candidate)
    )
    dealt = pairs.drop("own", "other").repartitionById(by_query * by_candidate, F.col("pair"))
    found = dealt.sortWithinPartitions("pair", "side").mapInArrow(_join(dim, kind, k), _FOUND)
    by_row = found.repartition(shuffle_partitions(spark), "row").sortWithinPartitions("row")
    return by_row.mapInArrow(_merge(k), _RESULT)
