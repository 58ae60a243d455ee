"""Exact top k by inner product from an impact-ordered index that is read score at a time.

1. Components become impacts, ``floor(scale * x)``. Rows are dealt evenly into slices, and each slice is cut into blocks of ``BLOCK`` rows. A block's
   index has, per dimension, its rows in descending impact; rows of one impact are a segment.
2. The queries of a block form groups of at most ``GROUP``. Each group meets every slice in a join; in a task, the blocks of a slice follow each other.
3. A segment adds query component times impact to its rows. Segments of all dimensions are read in descending order of that product, in
   rounds that end at a falling level. After a round, a row can still gain at most the level in each dimension that has not reached it yet, or the dimension's
   largest product if that is smaller. Rows whose bound is below the k-th best score known cannot be results; they are dropped on that proof alone.
   Reading ends when few rows are left, and those are scored exactly.
4. The k-th best score known comes from exact scores of the rows that lead after the first round, and goes from block to block of a slice.

Vectors that are null, or hold null or non-finite components, or impacts of 2 ** 20 or more (whose sums would not be exact), and rows without id take no part. A shorter vector counts as zero in the components it lacks. Rows
with the same id are different rows: only the query's own row is no candidate. Equal scores go to the smaller id. With fewer candidates than k,
all are returned. An empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import isqrt

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from subtide.llm.shared import bounded, written

BLOCK = 4_096
#: Blocks a slice has, about.
BLOCKS = 4
GROUP = 128
#: Rows that are scored rather than read on.
FEW = 512
#: Size from which impacts are refused.
MOST_IMPACT = 1 << 20
#: Partitions of the join at most.
MOST_PARTS = 20_000
#: Ends of rounds, as shares of a query's largest product.
LEVELS = (0.5, 0.3, 0.2, 0.12, 0.06, 0.0)


class Block:
    """Rows of a block by descending impact in each dimension."""

    _keys: np.ndarray | None = None

    def __init__(self, impacts: np.ndarray) -> None:
        self.impacts = impacts  # rows, dimensions
        order = np.argsort(-impacts, axis=0, kind="stable")
        self.rows = np.ascontiguousarray(order.T)
        self.sorted = np.ascontiguousarray(np.take_along_axis(impacts, order, axis=0).T)

    @classmethod
    def stored(cls, impacts: np.ndarray, rows: np.ndarray, ordered: np.ndarray) -> Block:
        out = cls.__new__(cls)
        out.impacts, out.rows, out.sorted = impacts, rows, ordered
        return out

    def top(self, query: np.ndarray, k: int, known: int | None, own: int) -> tuple[np.ndarray, np.ndarray, int]:
        """Rows and scores of the block among which its k best are, no less than ``known``; ``own`` is left out. And how many postings were read."""
        n, dims = self.impacts.shape
        most = np.where(query > 0, query * self.sorted[:, 0], query * self.sorted[:, -1])
        reached, gained = np.zeros(n, np.int64), np.zeros(n, np.int64)
        done = np.zeros(dims, np.int64)  # postings read from the end where products are largest
        left, read = np.ones(n, bool), 0
        if 0 <= own < n:
            left[own] = False
        for share in LEVELS:
            level = int(most.max(initial=0) * share)
            until = self._until(query, level)
            more = np.maximum(until - done, 0)
            at = self._places(query, done, more)
            if len(at):
                rows = self.rows.ravel()[at]
                # Sums stay below 2 ** 53, where floating point is exact.
                gained += np.bincount(rows, self.sorted.ravel()[at] * np.repeat(query, more), n).astype(np.int64)
                reached += np.bincount(rows, minlength=n)
                read += len(at)
            done += more
            begun = done > 0
            # Of dimensions that have begun, what is unread is at most the level; of others, at most their largest product.
            bound = gained + level * (int(begun.sum()) - reached) + int(np.minimum(most, level)[~begun].sum())
            if known is None:
                known = self._seed(query, np.where(left, bound, -(1 << 62)), k, int(left.sum()))
            if known is not None:
                left &= bound >= known
            if left.sum() <= FEW:
                break
        rows = np.flatnonzero(left)
        return rows, self.impacts[rows] @ query, read

    def _until(self, query: np.ndarray, level: int) -> np.ndarray:
        """Postings of each dimension whose product is above ``level``."""
        n = self.rows.shape[1]
        size = np.maximum(np.abs(query), 1)
        # query * impact > level: impact > floor(level / query), or for a negative component impact < -floor(level / -query).
        above = self._above(np.where(query > 0, level // size, -(level // size) - 1))
        return np.where(query > 0, above, np.where(query < 0, n - above, 0))

    def _above(self, impacts: np.ndarray) -> np.ndarray:
        """Per dimension, how many rows have more than that impact."""
        if self._keys is None:
            self._highest = int(self.sorted.max())
            self._span = self._highest - int(self.sorted.min()) + 2
            self._first = np.arange(len(self.sorted))
            self._keys = (self._first[:, None] * self._span + (self._highest - self.sorted)).ravel()
        wanted = np.clip(self._highest - impacts, 0, self._span - 1) + self._first * self._span
        return np.searchsorted(self._keys, wanted) - self._first * self.rows.shape[1]

    def _places(self, query: np.ndarray, done: np.ndarray, more: np.ndarray) -> np.ndarray:
        """Places, in the postings of all dimensions, of the ``more`` postings after the first ``done``, from the end of the largest products."""
        n = self.rows.shape[1]
        begin = np.where(query > 0, done, n - done - more) + n * np.arange(len(query))
        return np.repeat(begin - (np.cumsum(more) - more), more) + np.arange(int(more.sum()))

    def _seed(self, query: np.ndarray, bound: np.ndarray, k: int, left: int) -> int | None:
        """The k-th best exact score among rows with high bounds; None with fewer rows than k."""
        if left < k:
            return None
        some = min(left, 8 * k)
        lead = np.argpartition(-bound, some - 1)[:some]
        return int(np.partition(self.impacts[lead] @ query, some - k)[some - k])


def _impacts(vectors: pa.Array, scale: int) -> list[np.ndarray | None]:
    """Integer components of each vector; None for vectors that take no part."""
    values = pc.fill_null(vectors.flatten(), float("nan")).to_numpy(zero_copy_only=False)
    with np.errstate(invalid="ignore", over="ignore"):
        scaled = np.floor(scale * values)
        usable = np.abs(scaled) < MOST_IMPACT
    whole = np.where(usable, scaled, 0).astype(np.int64)
    ends = np.cumsum(pc.fill_null(pc.list_value_length(vectors), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    bad = np.concatenate([[0], np.cumsum(~usable)])
    out: list[np.ndarray | None] = []
    for first, past, known in zip(np.append(0, ends[:-1]), ends, vectors.is_valid().to_pylist(), strict=True):
        out.append(whole[first:past] if known and bad[past] == bad[first] else None)
    return out


def impact_blocks(vectors: DataFrame, vec_id: str, vector: str, scale: int) -> DataFrame:
    """slice, block, dims, ids, impacts, rows, ordered: index blocks, arrays as binary."""
    chosen = vectors.select(F.col(vec_id).cast("long").alias("id"), F.col(vector).cast("array<double>").alias("vector")).where("id IS NOT NULL AND vector IS NOT NULL")
    n = chosen.count()
    slices = max(1, -(-n // (BLOCK * BLOCKS)))
    schema = pa.schema([("slice", pa.int32()), ("block", pa.int32()), ("dims", pa.int32()), *((c, pa.binary()) for c in ("ids", "impacts", "rows", "ordered"))])

    def packed(number: int, ids: list[int], own: list[np.ndarray]) -> pa.RecordBatch:
        dims = max(1, max(map(len, own)))
        impacts = np.zeros((len(own), dims), np.int64)
        for k, vector in enumerate(own):
            impacts[k, : len(vector)] = vector
        block = Block(impacts)
        arrays = (np.array(ids, np.int64), _narrow(impacts), block.rows.astype(np.int16), _narrow(block.sorted))
        columns = [pa.array([x], pa.int32()) for x in (TaskContext.get().partitionId(), number, dims)]
        return pa.RecordBatch.from_arrays([*columns, *(pa.array([a.tobytes()], pa.binary()) for a in arrays)], schema=schema)

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids: list[int] = []
        own: list[np.ndarray] = []
        number = 0
        for rows in batches:
            for one, vector in zip(rows.column(0).to_pylist(), _impacts(rows.column(1), scale), strict=True):
                if vector is not None:
                    ids.append(one)
                    own.append(vector)
                if len(ids) == BLOCK:
                    yield packed(number, ids, own)
                    ids, own, number = [], [], number + 1
        if ids:
            yield packed(number, ids, own)

    kinds = "slice int, block int, dims int, ids binary, impacts binary, rows binary, ordered binary"
    return bounded(chosen).repartition(slices).mapInArrow(build, kinds)


def _narrow(impacts: np.ndarray) -> np.ndarray:
    """As 16-bit numbers if they fit, else as 64-bit ones."""
    return impacts.astype(np.int16) if np.abs(impacts).max(initial=0) < 1 << 15 else impacts


def _wide(stored: bytes, rows: int, columns: int) -> np.ndarray:
    kind = np.int16 if len(stored) == 2 * rows * columns else np.int64
    return np.frombuffer(stored, kind).reshape(rows, columns).astype(np.int64)


def query_groups(blocks: DataFrame, every: int) -> DataFrame:
    """of_slice, of_block, ids, places, vectors: rows whose id ``every`` divides, at most ``GROUP`` a row."""
    schema = pa.schema([("of_slice", pa.int32()), ("of_block", pa.int32()), ("q_dims", pa.int32()), *((c, pa.binary()) for c in ("q_ids", "q_places", "q_vectors"))])

    def choose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                ids = np.frombuffer(row["ids"], np.int64)
                impacts = _wide(row["impacts"], len(ids), row["dims"])
                asked = np.flatnonzero(ids % every == 0)
                for first in range(0, len(asked), GROUP):
                    own = asked[first : first + GROUP]
                    columns = [pa.array([row[c]], pa.int32()) for c in ("slice", "block", "dims")]
                    arrays = (ids[own], own.astype(np.int64), _narrow(impacts[own]))
                    yield pa.RecordBatch.from_arrays([*columns, *(pa.array([a.tobytes()], pa.binary()) for a in arrays)], schema=schema)

    chosen = blocks.select("slice", "block", "dims", "ids", "impacts")
    return chosen.mapInArrow(choose, "of_slice int, of_block int, q_dims int, q_ids binary, q_places binary, q_vectors binary")


def top_k(vectors: DataFrame, k: int = 5, every: int = 50, scale: int = 256, vec_id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """query_id, rank, vec_id, score: for each row whose id ``every`` divides, the k other rows of largest integer inner product."""
    blocks = written(impact_blocks(vectors, vec_id, vector, scale), "impact-blocks")
    groups = written(query_groups(blocks, every), "impact-queries")
    # Every group meets every slice. Groups are dealt into lanes, so that neither the groups of a slice nor its copies are many.
    lanes = max(1, isqrt(groups.count()))
    slices = (blocks.agg(F.max("slice")).first()[0] or 0) + 1
    lane = F.pmod(F.hash("of_slice", "of_block", "q_ids"), F.lit(lanes))
    sent = groups.withColumn("lane", lane).withColumn("slice", F.explode(F.sequence(F.lit(0), F.lit(slices - 1))))
    copied = blocks.withColumn("lane", F.explode(F.sequence(F.lit(0), F.lit(lanes - 1))))
    # The work lies in the products, not in the bytes by which adaptive execution would merge partitions; so their number is set, with room
    # for pairs that hash alike.
    parts = min(MOST_PARTS, 4 * slices * lanes)
    met = sent.repartition(parts, "slice", "lane").join(copied.repartition(parts, "slice", "lane").hint("merge"), ["slice", "lane"])
    schema = pa.schema([("of_slice", pa.int32()), ("of_block", pa.int32()), ("place", pa.int64()), ("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.int64())])

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        current: tuple | None = None

        def results() -> Iterator[pa.RecordBatch]:
            if current is not None and best:
                queries, places = np.frombuffer(current[2], np.int64), np.frombuffer(current[3], np.int64)
                sizes = [len(best[q][0]) for q in best]
                of = np.repeat(list(best), sizes)
                whole = lambda x: pa.array(np.full(len(of), x, np.int32))
                columns = [whole(current[0]), whole(current[1]), pa.array(places[of]), pa.array(queries[of])]
                columns += [pa.array(np.concatenate([best[q][part] for q in best])) for part in (0, 1)]
                yield pa.RecordBatch.from_arrays(columns, schema=schema)

        for batch in batches:
            for row in batch.to_pylist():
                key = (row["of_slice"], row["of_block"], row["q_ids"], row["q_places"], row["slice"])
                if key != current:
                    yield from results()
                    best, current = {}, key
                ids, places = np.frombuffer(row["ids"], np.int64), np.frombuffer(row["q_places"], np.int64)
                n, dims = len(ids), row["dims"]
                block = Block.stored(
                    _wide(row["impacts"], n, dims),
                    np.frombuffer(row["rows"], np.int16).reshape(dims, n).astype(np.int64),
                    _wide(row["ordered"], dims, n),
                )
                asked = _wide(row["q_vectors"], len(places), row["q_dims"])
                home = (row["of_slice"], row["of_block"]) == (row["slice"], row["block"])
                for q in range(len(places)):
                    query = np.zeros(dims, np.int64)
                    query[: min(dims, asked.shape[1])] = asked[q, :dims]
                    old_ids, old_scores = best.get(q, (ids[:0], ids[:0]))
                    known = int(old_scores[k - 1]) if len(old_scores) >= k else None
                    rows, scores, _ = block.top(query, k, known, int(places[q]) if home else -1)
                    own_ids, own_scores = np.concatenate([old_ids, ids[rows]]), np.concatenate([old_scores, scores])
                    order = np.lexsort([own_ids, -own_scores])[:k]
                    best[q] = own_ids[order], own_scores[order]
        yield from results()

    found = met.mapInArrow(search, "of_slice int, of_block int, place long, query_id long, vec_id long, score long")
    ranked = Window.partitionBy("of_slice", "of_block", "place").orderBy(F.col("score").desc(), "vec_id")
    return found.withColumn("rank", F.row_number().over(ranked)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
