"""Approximate nearest neighbours: a hierarchical navigable small-world graph per shard, shard results merged.

Vectors are dealt to shards of bounded size by a hash of their row. In each shard one task builds the graph over the
distinct vectors (equal vectors are one node with a list of its rows, so a very common vector does not crowd out links)
and stores it as flat arrays: vectors, neighbours of level 0 (a row per node, -1 for none), nodes and neighbours of the
upper levels. Queries travel in blocks to every shard; each shard's best are re-scored in double precision on the original
vectors, and the best of all shards are ranked.

Defined cases: rows without an id take no part, as nothing could name them; vectors null, empty, zero, or with null or
non-finite components take none either; ids are whole 64-bit numbers throughout; only vectors of the query's
length are candidates; a row is no candidate of its own, rows with the same id are; ties go to the smaller id, then the
earlier row; an empty table gives no rows; other columns play no part.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from risewatch.llm.shared import numbered, settle

SHARD_ROWS = 4096
QUERY_BLOCK = 512
#: Links a node gets on level 0 and above; room for links on level 0 before they are pruned; breadth of searches.
LINKS, UPPER_LINKS, ROOM, BUILD_BREADTH, SEARCH_BREADTH = 16, 10, 32, 48, 80


class Graph:
    """HNSW over unit vectors, distance 1 - cosine, in flat arrays."""

    def __init__(self, units: np.ndarray, seed: int = 5) -> None:
        self.units = np.ascontiguousarray(units, np.float32)
        n = len(units)
        self.levels = np.minimum((-np.log(1 - np.random.Generator(np.random.PCG64(seed)).random(n)) / np.log(LINKS)).astype(np.int32), 12)
        top = int(self.levels.max(initial=0))
        #: neighbours[level][place[level][node]]
        self.place = [np.arange(n, dtype=np.int32)] + [np.full(n, -1, np.int32) for _ in range(top)]
        for level in range(1, top + 1):
            here = np.flatnonzero(self.levels >= level)
            self.place[level][here] = np.arange(len(here))
        self.neighbours = [np.full((int((self.levels >= level).sum()), ROOM if level == 0 else 2 * UPPER_LINKS), -1, np.int32) for level in range(top + 1)]
        self.counts = [np.zeros(len(x), np.int32) for x in self.neighbours]
        self.seen = np.zeros(n, np.int32)
        self.stamp, self.entry, self.height = 0, -1, -1
        for node in range(n):
            self._insert(node)

    @classmethod
    def stored(cls, units: np.ndarray, place: list[np.ndarray], neighbours: list[np.ndarray], counts: list[np.ndarray], entry: int, height: int) -> Graph:
        self = cls.__new__(cls)
        self.units, self.place, self.neighbours, self.counts, self.entry, self.height = units, place, neighbours, counts, entry, height
        self.seen, self.stamp = np.zeros(len(units), np.int32), 0
        return self

    def _layer(self, query: np.ndarray, starts: list[tuple[float, int]], breadth: int, level: int) -> list[tuple[float, int]]:
        """The `breadth` nearest nodes found on a level, nearest first."""
        self.stamp += 1
        seen, stamp, units = self.seen, self.stamp, self.units
        place, neighbours, counts = self.place[level], self.neighbours[level], self.counts[level]
        for _, x in starts:
            seen[x] = stamp
        todo = list(starts)
        heapq.heapify(todo)
        best = [(-d, x) for d, x in starts]
        heapq.heapify(best)
        while todo:
            d, x = heapq.heappop(todo)
            if d > -best[0][0] and len(best) >= breadth:
                break
            k = place[x]
            near = neighbours[k, : counts[k]]
            near = near[seen[near] != stamp]
            if not len(near):
                continue
            seen[near] = stamp
            far = 1 - units[near] @ query
            if len(best) >= breadth:
                keep = far < -best[0][0]
                near, far = near[keep], far[keep]
            for dy, y in zip(far.tolist(), near.tolist(), strict=True):
                if len(best) < breadth:
                    heapq.heappush(best, (-dy, y))
                elif dy < -best[0][0]:
                    heapq.heapreplace(best, (-dy, y))
                else:
                    continue
                heapq.heappush(todo, (dy, y))
        return sorted((-d, x) for d, x in best)

    def _spread(self, found: list[tuple[float, int]], most: int) -> list[int]:
        """Nearest first, those nearer to the node than to one already chosen; filled up with the nearest of the rest."""
        if len(found) <= most:
            return [x for _, x in found]
        nodes = [x for _, x in found]
        among = 1 - self.units[nodes] @ self.units[nodes].T
        nearest = np.full(len(nodes), np.inf, np.float32)
        chosen: list[int] = []
        for i, (d, _) in enumerate(found):
            if d < nearest[i]:
                chosen.append(i)
                if len(chosen) == most:
                    break
                nearest = np.minimum(nearest, among[i])
        if len(chosen) < most:
            taken = set(chosen)
            chosen += [i for i in range(len(nodes)) if i not in taken][: most - len(chosen)]
        return [nodes[i] for i in chosen]

    def _link(self, node: int, to: int, level: int) -> None:
        k = self.place[level][node]
        row, n = self.neighbours[level][k], self.counts[level][k]
        if n < len(row):
            row[n] = to
            self.counts[level][k] = n + 1
            return
        others = np.append(row, to)
        far = 1 - self.units[others] @ self.units[node]
        keep = self._spread(sorted(zip(far.tolist(), others.tolist(), strict=True)), len(row) * 3 // 4)
        row[:] = -1
        row[: len(keep)] = keep
        self.counts[level][k] = len(keep)

    def _insert(self, node: int) -> None:
        level = int(self.levels[node])
        if self.entry < 0:
            self.entry, self.height = node, level
            return
        query = self.units[node]
        found = [(float(1 - self.units[self.entry] @ query), self.entry)]
        for at in range(self.height, level, -1):
            found = self._layer(query, found[:1], 1, at)
        for at in range(min(level, self.height), -1, -1):
            found = self._layer(query, found, BUILD_BREADTH, at)
            for other in self._spread(found, LINKS if at == 0 else UPPER_LINKS):
                self._link(node, other, at)
                self._link(other, node, at)
        if level > self.height:
            self.entry, self.height = node, level

    def search(self, query: np.ndarray, breadth: int) -> list[int]:
        if self.entry < 0:
            return []
        found = [(float(1 - self.units[self.entry] @ query), self.entry)]
        for at in range(self.height, 0, -1):
            found = self._layer(query, found[:1], 1, at)
        return [x for _, x in self._layer(query, found, breadth, 0)]


def usable(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """row, id, vector array<double>, dim of the vectors that take part."""
    stored = numbered(vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).alias("vector")))
    rows = stored.withColumn("vector", F.col("vector").cast("array<double>")).where("id is not null and vector is not null and size(vector) > 0")
    finite = F.forall("vector", lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) < float("inf")), F.lit(False)))
    return rows.where(finite).where(F.exists("vector", lambda x: x != 0)).select("row", "id", "vector", F.size("vector").alias("dim"))


def _scaled(vectors: np.ndarray) -> np.ndarray:
    """Vectors times powers of two (which changes no cosine), so that tiny and huge components neither vanish nor overflow."""
    return np.ldexp(vectors, -np.frexp(np.abs(vectors).max(axis=-1, keepdims=True))[1])


def _units(vectors: np.ndarray) -> np.ndarray:
    scaled = _scaled(vectors)
    return (scaled / np.sqrt((scaled * scaled).sum(axis=1, keepdims=True))).astype(np.float32)


def _cosines(vectors: np.ndarray, query: np.ndarray) -> np.ndarray:
    """Row by row in one fixed order, so that equal vectors have equal scores."""
    vectors, query = _scaled(vectors), _scaled(query)
    return (vectors * query).sum(axis=1) / (np.sqrt((vectors * vectors).sum(axis=1)) * np.sqrt((query * query).sum()))


def _matrix(column: pa.ChunkedArray | pa.Array, dim: int) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dim)


_INDEX = "dim int, shard int, rows binary, ids binary, starts binary, vectors binary, entry int, height int, place array<binary>, neighbours array<binary>, counts array<binary>"


def build_index(rows: DataFrame, n_shards: int) -> DataFrame:
    """A row per shard with its graph as flat arrays."""

    def build(group: pa.Table) -> pa.Table:
        dim, shard = group.column("dim")[0].as_py(), group.column("shard")[0].as_py()
        vectors, ids, numbers = _matrix(group.column("vector"), dim), group.column("id").to_numpy(), group.column("row").to_numpy()
        order = np.lexsort((numbers, ids))
        vectors, ids, numbers = vectors[order], ids[order], numbers[order]
        nodes, member = np.unique(vectors, axis=0, return_inverse=True)
        by_node = np.argsort(member.ravel(), kind="stable")
        starts = np.concatenate(([0], np.cumsum(np.bincount(member.ravel(), minlength=len(nodes)))))
        mix = np.random.Generator(np.random.PCG64(11)).permutation(len(nodes))  # sorted insertion makes poor graphs
        nodes = nodes[mix]
        pieces = [by_node[starts[x] : starts[x + 1]] for x in mix]
        starts = np.concatenate(([0], np.cumsum([len(x) for x in pieces]))).astype(np.int64)
        by_node = np.concatenate(pieces)
        graph = Graph(_units(nodes))
        pack = lambda arrays: [x.tobytes() for x in arrays]
        out = {"dim": dim, "shard": shard, "rows": numbers[by_node].tobytes(), "ids": ids[by_node].tobytes(), "starts": starts.tobytes(), "vectors": nodes.tobytes(), "entry": graph.entry, "height": graph.height}
        out |= {"place": pack(graph.place), "neighbours": pack(graph.neighbours), "counts": pack(graph.counts)}
        kinds = {"dim": pa.int32(), "shard": pa.int32(), "entry": pa.int32(), "height": pa.int32(), "place": pa.list_(pa.binary()), "neighbours": pa.list_(pa.binary()), "counts": pa.list_(pa.binary())}
        return pa.table({k: pa.array([v], kinds.get(k, pa.binary())) for k, v in out.items()})

    dealt = rows.withColumn("shard", F.pmod(F.xxhash64("row"), F.lit(n_shards)).cast("int")).repartition(n_shards, "dim", "shard")
    return dealt.groupBy("dim", "shard").applyInArrow(build, _INDEX)


class _Shard:
    def __init__(self, row: dict) -> None:
        read = lambda x, kind: np.frombuffer(x, kind)
        self.rows, self.ids, self.starts = read(row["rows"], np.int64), read(row["ids"], np.int64), read(row["starts"], np.int64)
        self.vectors = read(row["vectors"], np.float64).reshape(-1, row["dim"])
        counts = [read(x, np.int32) for x in row["counts"]]
        neighbours = [read(x, np.int32).reshape(len(c), -1) for x, c in zip(row["neighbours"], counts, strict=True)]
        self.graph = Graph.stored(_units(self.vectors), [read(x, np.int32) for x in row["place"]], neighbours, counts, row["entry"], row["height"])

    def nearest(self, own: int, query: np.ndarray, unit: np.ndarray, k: int, breadth: int) -> list[tuple[float, int, int]]:
        nodes = self.graph.search(unit, breadth)
        found = []
        for score, node in sorted(zip(_cosines(self.vectors[nodes], query).tolist(), nodes, strict=True), reverse=True)[: k + 1]:
            # equal scores in a node: its rows are in order of id, and k + 1 of them are enough
            at = slice(self.starts[node], min(self.starts[node + 1], self.starts[node] + k + 1))
            found += [(-score, i, r) for i, r in zip(self.ids[at].tolist(), self.rows[at].tolist(), strict=True) if r != own]
        return sorted(found)[:k]


def nearest(vectors: DataFrame, queries: str, k: int = 5, id_col: str = "vec_id", vector_col: str = "embedding", breadth: int = SEARCH_BREADTH, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """query_id, rank, vec_id, score of the k nearest found for every usable row that the condition `queries` picks (on id)."""
    rows = usable(vectors, id_col, vector_col)
    n = rows.count()
    n_shards = max(1, -(-n // shard_rows))
    index = settle(build_index(rows, n_shards))
    asked = rows.where(queries)
    n_blocks = max(1, -(-asked.count() // QUERY_BLOCK))

    def block(group: pa.Table) -> pa.Table:
        dim = group.column("dim")[0].as_py()
        return pa.table(
            {"dim": pa.array([dim], pa.int32()), "q_rows": pa.array([group.column("row").to_numpy().tobytes()]), "q_ids": pa.array([group.column("id").to_numpy().tobytes()]), "q_vectors": pa.array([_matrix(group.column("vector"), dim).tobytes()])}
        )

    blocks = asked.withColumn("block", F.pmod(F.xxhash64("row"), F.lit(n_blocks))).groupBy("dim", "block").applyInArrow(block, "dim int, q_rows binary, q_ids binary, q_vectors binary")
    # the stated query set goes to every shard, in blocks
    sent = blocks.withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(n_shards - 1))))
    pairs = sent.repartition(max(n_shards, 2), "dim", "shard").join(index.hint("merge"), ["dim", "shard"])

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, shard = None, None
        for batch in batches:
            for at in range(batch.num_rows):
                row = batch.slice(at, 1).to_pylist()[0]
                if held != (row["dim"], row["shard"]):
                    held, shard = (row["dim"], row["shard"]), _Shard(row)
                own, ids = np.frombuffer(row["q_rows"], np.int64), np.frombuffer(row["q_ids"], np.int64)
                vectors = np.frombuffer(row["q_vectors"], np.float64).reshape(-1, row["dim"])
                units = _units(vectors)
                out = [(int(r), int(i), found, number, -score) for r, i, v, u in zip(own, ids, vectors, units, strict=True) for score, found, number in shard.nearest(int(r), v, u, k, breadth)]
                columns = list(zip(*out, strict=True)) or [[]] * 5
                kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.float64())
                yield pa.record_batch([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names=["q_row", "query_id", "vec_id", "row", "score"])

    found = pairs.mapInArrow(search, "q_row long, query_id long, vec_id long, row long, score double")
    best = Window.partitionBy("q_row").orderBy(F.desc("score"), "vec_id", "row")
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
