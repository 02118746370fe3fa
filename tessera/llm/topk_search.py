"""Exact top-k search by columnar branch and bound.

Vectors lie in blocks in vertical layout: a block is a matrix whose rows are
dimensions. A block of queries meets a block of candidates; inner products
are accumulated over one group of dimensions after the other. What the
remaining dimensions can add to a score is at most the product of the two
remaining masses (norms over these dimensions), and at least minus that. The
k-th best lower bound of a query is a score that k candidates reach, so
candidates whose upper bound is below it are dropped, and the survivors are
compacted before the next group: for all queries of the block together while
most are alive, for each on its own when few are. Survivors of the last group
have exact scores.
The bound starts high: after the first group the k best partial scores are
finished, and a task that meets the same queries with one block of candidates
after the other carries their k best scores along.

Queries and candidates are dealt into blocks by hash, and blocks of candidates
round robin into lanes, a task each. Every pair of blocks is one row of work, so
a task holds two blocks at a time, and each query keeps k candidates of a lane
before the lanes' results are merged. The queries are a stated share of the
rows; both sides are distributed.

Components are integers (``floor(scale * x)``; where the product exceeds a
double, the largest double). Scores are computed in doubles where they are exact
(below 2^53), in Python integers elsewhere; a score beyond the range of a long
counts as that range's end.

Defined cases: null vectors and those with null or non-finite components take
no part; vectors of different lengths are compared over the dimensions that
both have; an empty vector scores 0; rows with equal ids are candidates of
their own, but a query is no candidate of its own id; ties go to the smaller
id; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tessera.llm.common import materialize, shuffle_width

K = 20
SCALE = 64
QUERY_BLOCK = 512
BLOCK = 8192
DIMENSIONS = 16  # accumulated between two prunings
#: Candidates are compacted when fewer than this share is alive for any query of
#: the block, and worked on query by query when fewer pairs than that share are.
COMPACT, SPARSE = 0.75, 0.2
LARGEST = 1.7976931348623157e308
LEAST_LONG, MOST_LONG = -(1 << 63), (1 << 63) - 1


def integer_vectors(rows: DataFrame, scale: int = SCALE, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """(vec_id, v): vectors that take part, as whole numbers in doubles."""
    def whole_number(x: Column) -> Column:
        y = F.least(F.greatest(x.cast("double") * scale, F.lit(-LARGEST)), F.lit(LARGEST))
        return F.when(F.abs(y) >= 2.0**53, y).otherwise(F.floor(y).cast("double"))  # from there on all are whole

    whole = F.transform(F.col(vector), whole_number)
    usable = F.forall(F.col(vector), lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return rows.filter(F.col(key).isNotNull() & F.col(vector).isNotNull() & usable).select(F.col(key).alias("vec_id"), whole.alias("v"))


def blocks(vectors: DataFrame, size: int, name: str) -> DataFrame:
    """(number, block, ids, width, data): vertical matrices of about ``size``
    vectors. Numbers run from 0 and may repeat, ``block`` does not."""
    vectors = materialize(vectors, name)
    n = max(1, -(-vectors.count() // size))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list = []
        now = None

        def close() -> pa.RecordBatch:
            ids = np.array([h[0] for h in held], dtype="<i8")
            width = max(len(h[1]) for h in held)
            matrix = np.zeros((width, len(held)), dtype="<f8")
            for i, (_, v) in enumerate(held):
                matrix[: len(v), i] = v
            return pa.RecordBatch.from_pydict({"number": [now], "ids": [ids.tobytes()], "width": [width], "data": [matrix.tobytes()]})

        for batch in batches:
            for block, key, v in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if held and (block != now or len(held) >= 2 * size):
                    yield close()
                    held = []
                now = block
                held.append((key, v))
        if held:
            yield close()

    dealt = vectors.select(F.pmod(F.xxhash64("vec_id"), F.lit(n)).alias("block"), "vec_id", "v")
    dealt = dealt.repartition("block").sortWithinPartitions("block", "vec_id")
    packed = dealt.mapInArrow(run, "number long, ids binary, width long, data binary")
    return materialize(packed.withColumn("block", F.monotonically_increasing_id()), f"{name}-blocks")


def search_block(
    qids: np.ndarray, q: np.ndarray, cids: np.ndarray, c: np.ndarray, k: int = K, step: int = DIMENSIONS, floors: np.ndarray | None = None
) -> list[tuple[int, int, int]]:
    """(query, candidate, score) of the k best candidates of each query, of
    those that reach the query's entry in ``floors``. ``q`` and ``c`` are
    vertical: dimensions by vectors."""
    width = min(len(q), len(c))
    q, c = q[:width], c[:width]
    largest = (np.abs(q).max(initial=0.0) or 0.0) * (np.abs(c).max(initial=0.0) or 0.0)
    if not largest * max(width, 1) < 2.0**53:
        return _search_wide(qids, q, cids, c, k)
    cuts = list(range(0, width, step))
    mass = lambda m: np.array([np.sqrt((m[at + step :] ** 2).sum(axis=0)) for at in cuts]).reshape(len(cuts), m.shape[1])
    qmass, cmass = mass(q), mass(c)
    score = q[:step].T @ c[:step] if width else np.zeros((q.shape[1], c.shape[1]))
    score[qids[:, None] == cids[None, :]] = -np.inf  # no candidate of its own id; as are those that are dropped
    reached = np.full(len(qids), -np.inf) if floors is None else floors.copy()
    if len(cids) > k and width > step:  # the k most promising ones of each query, to the end
        ahead = np.argpartition(score, len(cids) - k, axis=1)[:, len(cids) - k :]
        exact = np.take_along_axis(score, ahead, axis=1) + np.einsum("dq,dqk->qk", q[step:], c[step:, ahead])
        reached = np.maximum(reached, exact.min(axis=1))
    for j, at in enumerate(cuts):
        if j:
            score += q[at : at + step].T @ c[at : at + step]
        if at + step < width:
            slack = np.multiply.outer(qmass[j], cmass[j]) * (1 + 1e-9) + 1e-6  # covers rounding of the norms
            keep = score + slack >= reached[:, None]
            score[~keep] = -np.inf
            live = keep.any(axis=0)
            if live.mean() < COMPACT:
                score, c, cmass, cids, keep = score[:, live], c[:, live], cmass[:, live], cids[live], keep[:, live]
            if keep.mean() < SPARSE:
                return _finish_sparse(qids, q, cids, c, k, step, score, reached, qmass, cmass, cuts[j + 1 :], j + 1)
    return [row for i, query in enumerate(qids.tolist()) for row in _best(query, cids, score[i], k)]


def _best(query: int, cids: np.ndarray, score: np.ndarray, k: int) -> list[tuple[int, int, int]]:
    at = np.flatnonzero(score > -np.inf)
    if len(at) > k:
        at = at[score[at] >= np.partition(score[at], len(at) - k)[len(at) - k]]  # ties at the end are told by id
    at = at[np.lexsort((cids[at], -score[at]))[:k]]
    return list(zip([query] * len(at), cids[at].tolist(), score[at].astype(np.int64).tolist(), strict=True))


def _finish_sparse(qids, q, cids, c, k, step, scores, reached, qmass, cmass, cuts, first):
    """The other groups for few survivors: those of each query on their own."""
    width = len(q)
    out: list[tuple[int, int, int]] = []
    for i, query in enumerate(qids.tolist()):
        alive = np.flatnonzero(scores[i] > -np.inf)
        score, bound = scores[i, alive], reached[i]
        for j, at in enumerate(cuts, first):
            score = score + q[at : at + step, i] @ c[at : at + step, alive]
            if at + step < width and len(alive):
                slack = qmass[j, i] * cmass[j, alive] * (1 + 1e-9) + 1e-6
                if len(alive) > k:
                    bound = max(bound, np.partition(score - slack, len(alive) - k)[len(alive) - k])
                keep = score + slack >= bound
                alive, score = alive[keep], score[keep]
        out += _best(query, cids[alive], score, k)
    return out


def _search_wide(qids, q, cids, c, k):
    """Scores that doubles cannot hold, in Python integers."""
    rows = [[int(x) for x in v] for v in c.T]
    out = []
    for query, v in zip(qids.tolist(), q.T, strict=True):
        v = [int(x) for x in v]
        exact = ((sum(a * b for a, b in zip(v, r, strict=True)), cid) for cid, r in zip(cids.tolist(), rows, strict=True) if cid != query)
        scored = ((-max(LEAST_LONG, min(MOST_LONG, s)), cid) for s, cid in exact)
        out += [(query, cid, -s) for s, cid in sorted(scored)[:k]]
    return out


class Leaders:
    """The k best of each query of a block so far."""

    def __init__(self, qids: np.ndarray, k: int):
        self.k, self.qids = k, qids
        self.best: list[list[tuple[int, int]]] = [[] for _ in qids]

    def floors(self) -> np.ndarray:
        return np.array([float(-b[-1][0]) if len(b) == self.k else -np.inf for b in self.best])

    def add(self, found: list[tuple[int, int, int]]) -> None:
        """``found`` has the queries in the order of the block."""
        at = 0
        for i, query in enumerate(self.qids.tolist()):
            end = at
            while end < len(found) and found[end][0] == query and end - at < self.k:
                end += 1
            if end > at:
                self.best[i] = sorted([*self.best[i], *((-s, c) for _, c, s in found[at:end])])[: self.k]
            at = end

    def rows(self) -> list[tuple[int, int, int]]:
        return [(q, c, -s) for q, b in zip(self.qids.tolist(), self.best, strict=True) for s, c in b]


def lane_labels(spark: SparkSession, lanes: int) -> list[int]:
    """A number for each lane that Spark's hash puts into a partition of its own."""
    found: dict[int, int] = {}
    n = 8 * lanes
    while len(found) < lanes:
        place = F.pmod(F.hash("id"), F.lit(lanes)).alias("place")
        found = dict(spark.range(n).select("id", place).groupBy("place").agg(F.min("id").alias("id")).collect())  # a row a lane
        n *= 4
    return [found[i] for i in range(lanes)]


def top_k(queries: DataFrame, candidates: DataFrame, k: int = K, query_block: int = QUERY_BLOCK, block: int = BLOCK) -> DataFrame:
    """query_id, rank (from 1), vec_id, score: the k best candidates of each
    query. Both sides have (vec_id, v) as :func:`integer_vectors` gives them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["query_id", "vec_id", "score"]
        now, leaders = None, None

        def close() -> pa.RecordBatch:
            found = leaders.rows()
            return pa.RecordBatch.from_arrays([pa.array([f[i] for f in found], pa.int64()) for i in range(3)], names=names)

        for batch in batches:
            for which, qi, qw, qd, ci, cw, cd in zip(*(x.to_pylist() for x in batch.columns), strict=True):
                qids, cids = np.frombuffer(qi, "<i8"), np.frombuffer(ci, "<i8")
                q, c = (np.frombuffer(d, "<f8").reshape(w, len(ids)) for d, w, ids in ((qd, qw, qids), (cd, cw, cids)))
                if which != now:
                    if leaders:
                        yield close()
                    now, leaders = which, Leaders(qids, k)
                leaders.add(search_block(qids, q, cids, c, k, floors=leaders.floors()))
        if leaders:
            yield close()

    spark = queries.sparkSession
    asked = blocks(queries, query_block, "queries").select(*[F.col(x).alias(f"q_{x}") for x in ("block", "ids", "width", "data")])
    held = blocks(candidates, block, "candidates")
    # Every block of queries is sent once to each lane's share of candidates.
    lanes = shuffle_width(spark)
    labels = F.lit(lane_labels(spark, lanes)).cast("array<bigint>")
    used = F.lit(min(lanes, (held.agg(F.max("number")).first()[0] or 0) + 1))
    asked = asked.withColumn("lane", F.explode(F.slice(labels, F.lit(1), used)))
    held = held.withColumn("lane", F.element_at(labels, (F.pmod("number", used) + 1).cast("int")))
    # A block is little to move but much to search: lanes are not to be merged by size.
    work = asked.repartition(lanes, "lane").join(held.repartition(lanes, "lane"), "lane")
    work = work.select("q_block", "q_ids", "q_width", "q_data", "ids", "width", "data")
    found = work.mapInArrow(run, "query_id long, vec_id long, score long")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")


def is_query(vec_id: Column) -> Column:
    return vec_id % 20 == 0
