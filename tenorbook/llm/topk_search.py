"""Exact top-k inner products with a KD-tree per shard.

Vectors are dealt to shards by space: median splits over a bounded sample (at most `cells` cells, about eight sampled vectors for each) cut
the space into cells, and a cell of more than `shard_rows` vectors, equal ones included, is dealt further by row id. Every vector is in
a shard; the sample decides only where it lies. Each shard is a KD-tree: a node is split at the median of its widest
side, and keeps the tight box around its vectors. For a query q, no vector in a box [lo, hi] can score
more than the sum of max(q*lo, q*hi); nodes are visited best bound first, and the search of a shard ends
when the best bound left cannot beat the k-th result so far.

Queries first search the shard that holds them, which also tells the shard's own box. The k-th score found there is held against the boxes of all
other shards, blocks of queries against blocks of boxes, and only pairs of query and shard that can still change the result are searched.
The score goes along. Queries of a shard go in blocks, so a task holds one shard and one block of queries whatever the number of either.

Components become floor(scale * x). Vectors that are null, empty or hold null or non-finite components take no part, as
query or candidate. Vectors of different lengths are not compared. Repeated rows are rows of their own: a row is
excluded only from its own result. Ties go to the smaller id, a null id last. Scores are exact whole numbers; one beyond
the range of a long is the largest or smallest long (but for its sign's last) and ties with others beyond it.

Where components are so large that sums of products may leave 2**53, bounds are widened by their rounding error and scores are
taken in whole numbers of any length. Keys are whole numbers.
"""

from __future__ import annotations

import heapq
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tenorbook.llm.common import stored

_LAST = int(np.iinfo(np.int64).max)
#: Below this, sums of products of whole numbers are exact in doubles.
_EXACT = 2.0**53
#: The largest double within the range of a long.
_WITHIN = float(np.nextafter(2.0**63, 0))
_FOUND = "qid long, query_id long, rid long, id long, score long"
_BOX = "dim int, shard long, low array<double>, high array<double>"
#: Bits of a shard's number that tell shards of one cell apart.
_PARTS = 40
#: Boxes held against one block of queries.
_BOXES = 4096


def limits(queries: np.ndarray, low: np.ndarray, high: np.ndarray, reach: np.ndarray) -> np.ndarray:
    """Of each query and box, what no vector in the box can exceed, rounding included. reach: the largest absolute components, of all boxes or each."""
    with np.errstate(over="ignore", invalid="ignore"):
        most = np.abs(queries) @ reach.T
        slack = np.where(most < _EXACT, 0.0, most * (low.shape[1] + 2) * 2.0**-51)
        found = np.maximum(queries, 0) @ high.T + np.minimum(queries, 0) @ low.T + (slack if slack.ndim == 2 else slack[:, None])
    return np.maximum(np.nan_to_num(found, nan=np.inf), -_WITHIN)  # as scores beyond the range of a long are


class Tree:
    def __init__(self, vectors: np.ndarray, ids: np.ndarray, rids: np.ndarray, leaf: int = 256):
        self.vectors, self.ids, self.rids = vectors, ids, rids
        self.low, self.high, self.least, self.children, self.rows = [], [], [], [], []
        stack = [(np.arange(len(vectors)), -1, 0)]
        while stack:
            rows, parent, side = stack.pop()
            box, node = vectors[rows], len(self.low)
            self.low.append(box.min(0))
            self.high.append(box.max(0))
            self.least.append(int(ids[rows].min()))
            self.children.append([-1, -1])
            self.rows.append(None)
            if parent >= 0:
                self.children[parent][side] = node
            if len(rows) <= leaf:
                self.rows[node] = rows
                continue
            axis = int(np.argmax(self.high[-1] - self.low[-1]))
            order = np.argpartition(box[:, axis], len(rows) // 2)
            stack += [(rows[order[: len(rows) // 2]], node, 0), (rows[order[len(rows) // 2 :]], node, 1)]
        self.low, self.high = np.array(self.low), np.array(self.high)
        self.reach = np.abs(vectors).max(0) if len(vectors) else np.zeros(0)

    def bounds(self, queries: np.ndarray) -> np.ndarray:
        """Of each query and node, what no vector of the node can exceed."""
        return limits(queries, self.low, self.high, self.reach)

    def is_small(self, query: np.ndarray) -> bool:
        with np.errstate(over="ignore"):
            return bool(np.abs(query) @ self.reach < _EXACT)

    def scores(self, rows: np.ndarray, query: np.ndarray, small: bool) -> np.ndarray:
        """Scores as whole numbers within the range of a long."""
        if small:
            return (self.vectors[rows] @ query).astype(np.int64)
        whole = list(map(int, query.tolist()))
        sums = (sum(a * b for a, b in zip(map(int, v), whole, strict=True)) for v in self.vectors[rows].tolist())
        return np.array([max(-_LAST, min(int(_LAST), x)) for x in sums], np.int64)

    def search(self, query: np.ndarray, bounds: np.ndarray, own: int, k: int, floor: tuple[float, int]) -> list[tuple[int, int, int]]:
        """The best (-score, id, rid) not worse than `floor`, a (-score, id) that k others already reach."""
        best: list[tuple[int, int, int]] = []
        queue, small = [(-bounds[0], self.least[0], 0)], self.is_small(query)
        while queue:
            bound, least, node = heapq.heappop(queue)
            if (bound, least) > floor and bound > floor[0]:
                break
            if (bound, least) > floor:
                continue
            if (rows := self.rows[node]) is None:
                for child in self.children[node]:
                    heapq.heappush(queue, (-bounds[child], self.least[child], child))
                continue
            scores = -self.scores(rows, query, small)
            for x in np.flatnonzero(scores <= floor[0]).tolist():
                row = rows[x]
                if self.rids[row] != own:
                    best.append((int(scores[x]), int(self.ids[row]), int(self.rids[row])))
            if len(best) >= k:
                best = heapq.nsmallest(k, best)
                floor = min(floor, best[-1][:2])
        return heapq.nsmallest(k, best)


def _matrix(column: pa.ChunkedArray, rows: int) -> np.ndarray:
    values = pa.concat_arrays([x.flatten() for x in column.chunks]) if column.num_chunks else pa.array([], pa.float64())
    whole = np.floor(values.to_numpy(zero_copy_only=False))
    return np.clip(whole, -1e300, 1e300).reshape(rows, -1 if rows else 0)


def _numbers(table: pa.Table, name: str) -> np.ndarray:
    return table[name].to_numpy()


def _answers(tree: Tree, queries: pa.Table, k: int) -> pa.Table:
    out: dict[str, list] = {"qid": [], "query_id": [], "rid": [], "id": [], "score": []}
    points, qids, names = _matrix(queries["v"], queries.num_rows), _numbers(queries, "rid"), _numbers(queries, "id")
    open_ = queries["floor"].is_null().to_numpy()
    floors, edges = queries["floor"].fill_null(0).to_numpy(), _numbers(queries, "edge")
    for begin in range(0, len(points), 256):
        bounds = tree.bounds(points[begin : begin + 256])
        for x, row in enumerate(bounds, begin):
            for score, name, rid in tree.search(points[x], row, qids[x], k, (float("inf") if open_[x] else -int(floors[x]), int(edges[x]))):
                for column, value in zip(out.values(), (qids[x], names[x], rid, name, -score), strict=True):
                    column.append(value)
    return pa.table({n: pa.array(c, pa.int64()) for n, c in out.items()})


class Cells:
    """Space cut at medians of a sample until there are `parts` cells or a cell's sampled vectors are all equal."""

    def __init__(self, sample: np.ndarray, parts: int):
        self.splits: list[tuple[int, float, int, int]] = []  # axis, threshold, where to go below it and from it on; a cell c is ~c
        self.count = 0
        self.root = self._cut(sample, parts)

    def _cut(self, sample: np.ndarray, parts: int) -> int:
        if parts > 1 and len(sample) > 1:
            axis = int(np.argmax(sample.max(0) - sample.min(0)))
            values = sample[:, axis]
            edge = float(np.median(values))
            if not (values < edge).any():
                edge = float(np.min(values[values > edge], initial=np.inf))
            below = values < edge
            if below.any() and not below.all():
                node = len(self.splits)
                self.splits.append((axis, edge, 0, 0))
                self.splits[node] = (axis, edge, self._cut(sample[below], parts // 2), self._cut(sample[~below], parts - parts // 2))
                return node
        self.count += 1
        return ~(self.count - 1)

    def of(self, vectors: np.ndarray) -> np.ndarray:
        found = np.zeros(len(vectors), np.int64)
        stack = [(self.root, np.arange(len(vectors)))]
        while stack:
            node, rows = stack.pop()
            if node < 0:
                found[rows] = ~node
                continue
            axis, edge, low, high = self.splits[node]
            below = vectors[rows, axis] < edge
            stack += [(low, rows[below]), (high, rows[~below])]
        return found


def sharded(rows: DataFrame, shard_rows: int, cells: int) -> DataFrame:
    """Rows (rid, v, dim) with `shard`: the cell of space, and within a large cell a part by row id.

    The sample is bounded by 8 * cells vectors, as expected by their number; vectors of a length that the sample lacks are one cell. Cells are
    counted over all rows, at most `cells` numbers for each length.
    """
    count = rows.count()
    wanted = min(cells, -(-count // shard_rows))
    share = 1.0 if not count else min(1.0, 8 * wanted / count)
    drawn = F.pmod(F.xxhash64("rid", F.lit(2)), F.lit(1 << 30)) < int(share * (1 << 30))
    maps: dict[int, Cells] = {}
    if wanted > 1:
        sample = rows.filter(drawn).select("dim", "v").toArrow()
        for dim in sample["dim"].unique().to_pylist():
            some = sample.filter(pc.equal(sample["dim"], dim))
            maps[dim] = Cells(_matrix(some["v"], some.num_rows), max(1, wanted * some.num_rows // sample.num_rows))

    def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dims, found = batch.column("dim").to_numpy(), np.zeros(batch.num_rows, np.int64)
            for dim in np.unique(dims).tolist():
                if dim in maps:
                    at = np.flatnonzero(dims == dim)
                    found[at] = maps[dim].of(_matrix(pa.chunked_array([batch.column("v").take(pa.array(at))]), len(at)))
            yield batch.append_column("cell", pa.array(found, pa.int64()))

    celled = stored(rows.mapInArrow(placed, f"{rows._jdf.schema().toDDL()}, cell long")) if maps else rows.withColumn("cell", F.lit(0).cast("long"))
    sizes = celled.groupBy("dim", "cell").count().select(F.col("dim").alias("_dim"), F.col("cell").alias("_cell"), F.ceil(F.col("count") / shard_rows).alias("_parts"))
    part = F.pmod(F.xxhash64("rid"), F.col("_parts"))
    joined = celled.join(sizes, (F.col("dim") == F.col("_dim")) & (F.col("cell") == F.col("_cell")))
    return joined.select(*rows.columns, (F.shiftleft("cell", _PARTS) + part).alias("shard"))


def open_pairs(queries: DataFrame, boxes: DataFrame, query_rows: int) -> DataFrame:
    """rid, shard: the pairs of query (rid, v, dim, home, floor) and other shard whose box may hold a score not below the query's floor (null: any).

    Blocks of queries meet blocks of boxes of the same length, so a task holds one block of each.
    """
    blocks = [max(1, -(-n // m)) for n, m in ((queries.count(), query_rows), (boxes.count(), _BOXES))]
    queries = queries.select("rid", "v", "home", "floor", "dim", F.pmod(F.xxhash64("rid", F.lit(1)), F.lit(blocks[0])).alias("block"))
    queries = queries.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(blocks[1] - 1)).cast("array<long>")))
    boxes = boxes.select("shard", "low", "high", F.col("dim").alias("dim"), F.pmod(F.xxhash64("shard"), F.lit(blocks[1])).alias("part"))
    boxes = boxes.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks[0] - 1)).cast("array<long>")))
    keys = ["dim", "block", "part"]

    def meet(left: pa.Table, right: pa.Table) -> pa.Table:
        found: list[tuple[np.ndarray, np.ndarray]] = []
        if left.num_rows and right.num_rows:
            points, low, high = _matrix(left["v"], left.num_rows), _matrix(right["low"], right.num_rows), _matrix(right["high"], right.num_rows)
            reach, shards, home, rids = np.maximum(np.abs(low), np.abs(high)), _numbers(right, "shard"), _numbers(left, "home"), _numbers(left, "rid")
            floors = np.where(left["floor"].is_null().to_numpy(), -np.inf, left["floor"].fill_null(0).to_numpy().astype(float))
            for begin in range(0, len(points), 256):
                some = slice(begin, begin + 256)
                q, s = np.nonzero((limits(points[some], low, high, reach) >= floors[some, None]) & (home[some, None] != shards))
                found.append((rids[some][q], shards[s]))
        return pa.table({name: pa.array(np.concatenate([f[k] for f in found]) if found else [], pa.int64()) for k, name in enumerate(("rid", "shard"))})

    return queries.groupBy(*keys).cogroup(boxes.groupBy(*keys)).applyInArrow(meet, "rid long, shard long")


def _box(dim: int, shard: int, vectors: np.ndarray) -> pa.Table:
    return pa.table({"dim": pa.array([dim], pa.int32()), "shard": pa.array([shard], pa.int64()), "low": pa.array([vectors.min(0).tolist()]), "high": pa.array([vectors.max(0).tolist()])})


def _empty(columns: dict[str, pa.DataType], rows: int) -> dict[str, pa.Array]:
    return {name: pa.nulls(rows, kind) for name, kind in columns.items()}


def _at_home(k: int) -> Callable[[pa.Table], pa.Table]:
    """The answers of a shard to its own queries, and its box."""
    answer = dict.fromkeys(("qid", "query_id", "rid", "id", "score"), pa.int64())
    box = {"dim": pa.int32(), "shard": pa.int64(), "low": pa.list_(pa.float64()), "high": pa.list_(pa.float64())}

    def of(table: pa.Table) -> pa.Table:
        vectors = _matrix(table["v"], table.num_rows)
        found = _answers(Tree(vectors, _numbers(table, "id"), _numbers(table, "rid")), table.filter(table["asks"]), k)
        bounds = _box(table["dim"][0].as_py(), table["shard"][0].as_py(), vectors)
        columns = [*answer, *box]
        parts = [pa.table({**dict(zip(found.column_names, found.columns, strict=True)), **_empty(box, found.num_rows)}), pa.table({**_empty(answer, 1), **dict(zip(bounds.column_names, bounds.columns, strict=True))})]
        return pa.concat_tables([p.select(columns) for p in parts])

    return of


def top_k(vectors: DataFrame, key: str = "vec_id", embedding: str = "embedding", every: int = 50, k: int = 5, scale: int = 256, shard_rows: int = 4096, query_rows: int = 4096, cells: int = 1024) -> DataFrame:
    """query_id, rank (from 1), vec_id, score: for each row whose id is divisible by `every`, its k best other rows."""
    rows = vectors.select(F.col(key).cast("long").alias("_key"), F.col(embedding).alias("embedding"))
    rows = rows.filter(F.coalesce(_usable("embedding"), F.lit(False)))
    rows = rows.select(
        F.monotonically_increasing_id().alias("rid"),
        F.coalesce("_key", F.lit(int(_LAST))).alias("id"),
        F.coalesce(F.col("_key") % every == 0, F.lit(False)).alias("asks"),
        F.transform("embedding", lambda x: x.cast("double") * scale).alias("v"),
    ).withColumn("dim", F.size("v"))
    rows = stored(sharded(stored(rows), shard_rows, cells))
    start = {"floor": F.lit(None).cast("long"), "edge": F.lit(int(_LAST))}

    def elsewhere(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows or not right.num_rows:
            return pa.table({n: pa.array([], pa.int64()) for n in ("qid", "query_id", "rid", "id", "score")})
        tree = Tree(_matrix(left["v"], left.num_rows), _numbers(left, "id"), _numbers(left, "rid"))
        return _answers(tree, right, k)

    home = stored(rows.withColumns(start).groupBy("dim", "shard").applyInArrow(_at_home(k), f"{_FOUND}, {_BOX}"))
    first, boxes = home.filter("qid is not null").select("qid", "query_id", "rid", "id", "score"), home.filter("qid is null").select("dim", "shard", "low", "high")
    worst = first.groupBy("qid").agg(F.count(F.lit(1)).alias("n"), F.max(F.struct((-F.col("score")).alias("s"), F.col("id").alias("i"))).alias("w"))
    reached = F.col("n") >= k
    worst = worst.select("qid", F.when(reached, -F.col("w.s")).alias("f"), F.when(reached, F.col("w.i")).alias("e"))
    queries = stored(
        rows.filter("asks")
        .join(worst, F.col("rid") == F.col("qid"), "left")
        .select("rid", "id", "v", "dim", F.col("shard").alias("home"), F.col("f").alias("floor"), F.coalesce("e", start["edge"]).alias("edge"))
    )
    pairs = stored(open_pairs(queries, boxes, query_rows)).select(F.col("rid").alias("_rid"), "shard")
    queries = queries.join(pairs, F.col("rid") == F.col("_rid")).drop("_rid", "home")
    # A shard is copied once per block of the queries still open for it.
    blocks = pairs.groupBy("shard").agg(F.ceil(F.count(F.lit(1)) / query_rows).alias("_blocks")).select(F.col("shard").alias("_shard"), "_blocks")
    queries = queries.join(blocks, F.col("shard") == F.col("_shard")).withColumn("block", F.pmod(F.xxhash64("rid", F.lit(1)), F.col("_blocks")))
    copies = rows.select(*[F.col(c).alias(c) for c in ("rid", "id", "v", "dim", "shard")])  # columns of its own, beside the queries
    copies = copies.join(blocks, F.col("shard") == F.col("_shard")).withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_blocks") - 1)))
    keys = ["dim", "shard", "block"]
    second = copies.drop("_shard", "_blocks").groupBy(*keys).cogroup(queries.drop("_shard", "_blocks").groupBy(*keys)).applyInArrow(elsewhere, _FOUND)
    order = Window.partitionBy("qid").orderBy(F.desc("score"), "id", "rid")
    found = first.unionByName(second).withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    named = F.when(F.col("id") != int(_LAST), F.col("id"))
    return found.select("query_id", "rank", named.alias("vec_id"), "score")


def _usable(name: str) -> Column:
    return (F.size(name) > 0) & F.forall(name, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
