"""Approximate nearest neighbours by learned partitions (largest inner product).

Fitting, on a bounded sample (``max_sample`` distinct vectors with the smallest hash, on the driver): the
sample's neighbour graph is cut into balanced parts - recursive bisection along principal directions, then
rounds of moves to the part that holds most of a vector's neighbours, under a capacity per part. A small
classifier (one hidden layer) learns the parts from vectors; its targets are the shares of the parts among a
vector and its neighbours. Parts grow with the square root of the rows, between ``PARTS`` and a part per
``PART_SAMPLE`` sample vectors.

Calibration, in Spark: the true nearest of ``HELD_OUT`` queries, whose vectors the fit has not seen, are found
by brute force over the whole table. The number of parts to probe is the smallest for which the mean recall of
these queries, less ``SAFETY`` standard errors, reaches ``recall`` (or it is given).

Searching, in Spark: every vector of the table is indexed in its most probable part; a query is routed to its
``probes`` most probable parts. A part with more rows than a block holds is cut into blocks by id hash. A vector
is shuffled once, to its block; a query goes to every block of its parts. Blocks arrive sorted, vectors before
queries, so a task holds one block and at most ``QUERY_BLOCK`` queries at a time, however many queries a part
has. Equal vectors of a block are one; all that can be among the best ``k`` within the rounding of the fast
product are reranked with inner products summed in one fixed order; the best ``k`` of each block are merged by
score and vec_id. A query that met fewer than ``k`` candidates in its parts is searched in all parts.

Defined results: vectors that are null, zero, of another length than most, or hold null or non-finite
components take no part; a null vec_id takes no part; repeated rows of a vec_id are one candidate each and a
query's own vec_id is never its candidate; repeated query rows are one query (equal vectors) per vector;
fewer than ``k`` candidates: all are returned; empty in, empty out; extra columns are ignored.
"""
from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import prepare, smallest_hashes, staged

MAX_SAMPLE = 8192
PARTS, PART_SAMPLE = 32, 32
RECALL = 0.95
HELD_OUT, SAFETY = 256, 2.0
NEIGHBOURS = 16
ROW_BLOCK, QUERY_BLOCK = 16384, 256
HIDDEN = 96


def neighbour_graph(x: np.ndarray, k: int) -> np.ndarray:
    out = np.empty((len(x), min(k, max(len(x) - 1, 0))), np.int64)
    for i in range(0, len(x), 1024):
        s = x[i:i + 1024] @ x.T
        s[np.arange(len(s)), np.arange(i, i + len(s))] = -np.inf
        out[i:i + 1024] = np.argpartition(-s, out.shape[1] - 1, axis=1)[:, :out.shape[1]] if out.shape[1] else 0
    return out


def balanced_parts(x: np.ndarray, graph: np.ndarray, parts: int, rounds: int = 20, slack: float = 1.15) -> np.ndarray:
    part = np.zeros(len(x), np.int64)

    def bisect(rows, first, count):
        if count == 1 or len(rows) < 2:
            part[rows] = first
            return
        c = x[rows] - x[rows].mean(axis=0)
        axis = np.linalg.eigh(c.T @ c)[1][:, -1]
        order = rows[np.argsort(c @ axis, kind="stable")]
        left = count // 2
        cut = len(order) * left // count
        bisect(order[:cut], first, left)
        bisect(order[cut:], first + left, count - left)

    bisect(np.arange(len(x)), 0, parts)
    limit = int(np.ceil(slack * len(x) / parts))
    rows = np.arange(len(x))
    both = np.concatenate([np.stack([np.repeat(rows, graph.shape[1]), graph.ravel()], 1), np.stack([graph.ravel(), np.repeat(rows, graph.shape[1])], 1)])
    for _ in range(rounds):
        votes = np.bincount(both[:, 0] * parts + part[both[:, 1]], minlength=len(x) * parts).reshape(len(x), parts)
        best = votes.argmax(axis=1)
        gain = votes[rows, best] - votes[rows, part]
        size = np.bincount(part, minlength=parts)
        moved = 0
        for i in np.argsort(-gain, kind="stable"):
            if gain[i] <= 0:
                break
            if size[best[i]] < limit and size[part[i]] > 1:
                size[part[i]] -= 1
                size[best[i]] += 1
                part[i] = best[i]
                moved += 1
        if moved < len(x) // 500:
            break
    return part


@dataclass
class Router:
    """One hidden layer over normalised vectors; ``rank`` orders parts by probability."""

    w1: np.ndarray
    b1: np.ndarray
    w2: np.ndarray
    b2: np.ndarray

    def rank(self, x: np.ndarray) -> np.ndarray:
        x = x / np.linalg.norm(x, axis=1, keepdims=True)
        logits = np.maximum(x @ self.w1 + self.b1, 0) @ self.w2 + self.b2
        return np.argsort(-logits, axis=1, kind="stable")


def fit_router(x: np.ndarray, target: np.ndarray, epochs: int = 40, rate: float = 0.004, seed: int = 5) -> Router:
    rng = np.random.default_rng(seed)
    x = x / np.linalg.norm(x, axis=1, keepdims=True)
    p = [rng.standard_normal((x.shape[1], HIDDEN)) * (2 / x.shape[1]) ** 0.5 * 3, np.zeros(HIDDEN), rng.standard_normal((HIDDEN, target.shape[1])) * 0.1, np.zeros(target.shape[1])]
    m, v, step = [np.zeros_like(a) for a in p], [np.zeros_like(a) for a in p], 0
    for _ in range(epochs):
        order = rng.permutation(len(x))
        for i in range(0, len(x), 256):
            rows = order[i:i + 256]
            h = np.maximum(x[rows] @ p[0] + p[1], 0)
            z = h @ p[2] + p[3]
            q = np.exp(z - z.max(axis=1, keepdims=True))
            d = (q / q.sum(axis=1, keepdims=True) - target[rows]) / len(rows)
            dh = (d @ p[2].T) * (h > 0)
            step += 1
            for j, g in enumerate((x[rows].T @ dh, dh.sum(axis=0), h.T @ d, d.sum(axis=0))):
                m[j] = 0.9 * m[j] + 0.1 * g
                v[j] = 0.999 * v[j] + 0.001 * g * g
                p[j] = p[j] - rate * (m[j] / (1 - 0.9 ** step)) / (np.sqrt(v[j] / (1 - 0.999 ** step)) + 1e-9)
    return Router(*p)


def fit(sample: np.ndarray, parts: int = PARTS) -> Router | None:
    """None if the sample is too small to cut; then there is one part. ``sample``: distinct vectors."""
    x = sample / np.linalg.norm(sample, axis=1, keepdims=True) if len(sample) else sample
    parts = min(parts, len(x) // 8)
    if parts < 2:
        return None
    graph = neighbour_graph(x, NEIGHBOURS)
    part = balanced_parts(x, graph, parts)
    target = np.eye(parts)[part] * 0.5
    target += 0.5 * np.stack([np.bincount(p, minlength=parts) for p in part[graph]]) / graph.shape[1]
    return fit_router(x, target)


def fewest_probes(places: list[np.ndarray], parts: int, recall: float) -> int:
    """``places``: per query, how many parts must be probed to meet each of its true nearest."""
    places = [p for p in places if len(p)]
    if not places:
        return parts
    met = np.stack([np.cumsum(np.bincount(p - 1, minlength=parts)) / len(p) for p in places])
    error = met.std(axis=0, ddof=1) / len(met) ** 0.5 if len(met) > 1 else np.ones(parts)
    error[-1] = 0  # all parts hold all
    return int(np.argmax(met.mean(axis=0) - SAFETY * error >= recall)) + 1


def _true_nearest(bc, k: int):
    """The k nearest within a task's rows, of every broadcast query."""
    def run(batches):
        qid, asked = bc.value
        score, ids, parts = np.full((len(qid), k), -np.inf), np.full((len(qid), k), -1), np.zeros((len(qid), k), np.int64)
        for b in batches:
            if b.num_rows:
                own = b.column("vec_id").to_numpy()
                s = asked @ _matrix(b.column("v")).T
                s[qid[:, None] == own] = -np.inf
                s = np.concatenate([score, s], axis=1)
                top = np.argpartition(-s, k - 1, axis=1)[:, :k]
                score = np.take_along_axis(s, top, 1)
                ids = np.take_along_axis(np.concatenate([ids, np.broadcast_to(own, (len(qid), len(own)))], axis=1), top, 1)
                home = b.column("part").to_numpy()
                parts = np.take_along_axis(np.concatenate([parts, np.broadcast_to(home, (len(qid), len(home)))], axis=1), top, 1)
        real = score > -np.inf
        yield pa.RecordBatch.from_arrays([pa.array(np.nonzero(real)[0], pa.int32()), pa.array(score[real], pa.float64()), pa.array(ids[real], pa.int64()), pa.array(parts[real], pa.int32())],
                                         names=["query", "score", "vec_id", "part"])
    return run


def calibrate(home: DataFrame, router: Router, qid: np.ndarray, asked: np.ndarray, k: int, recall: float) -> int:
    """The fewest probes that find the share ``recall`` of the true ``k`` nearest of ``asked`` in the whole table."""
    parts = router.w2.shape[1]
    bc = home.sparkSession.sparkContext.broadcast((qid, asked))  # at most HELD_OUT vectors
    near = home.mapInArrow(_true_nearest(bc, k), "query int, score double, vec_id long, part int")
    place = F.row_number().over(Window.partitionBy("query").orderBy(F.desc("score"), "vec_id"))
    true = near.withColumn("place", place).where(F.col("place") <= k).select("query", "part").toPandas()  # at most HELD_OUT * k rows
    order = np.argsort(router.rank(asked), axis=1) + 1  # part to its rank, per query
    return fewest_probes([order[q, rows.to_numpy()] for q, rows in true.groupby("query")["part"]], parts, recall)


def usable(embeddings: DataFrame) -> DataFrame:
    """vec_id long, v array<double> of the rows that take part."""
    rows = embeddings.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("v"))
    fine = F.forall("v", lambda a: a.isNotNull() & ~F.isnan(a) & (F.abs(a) != float("inf"))) & F.exists("v", lambda a: a != 0)
    rows = rows.where(F.col("vec_id").isNotNull() & F.col("v").isNotNull() & fine)
    sizes = rows.groupBy(F.size("v").alias("n")).count().orderBy(F.desc("count"), "n").first()
    return rows.where(F.size("v") == (sizes.n if sizes else 0))


def _matrix(column) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1) if len(column) else np.zeros((0, 1))


def _ranked(bc, n: int):
    """Adds the ``n`` most probable parts."""
    def run(batches):
        for b in batches:
            if b.num_rows:
                router = bc.value
                parts = router.rank(_matrix(b.column("v")))[:, :n].tolist() if router else [[0]] * b.num_rows
                yield pa.RecordBatch.from_arrays([*b.columns, pa.array(parts, pa.list_(pa.int32()))], names=[*b.schema.names, "parts"])
    return run


class Block:
    """Vectors of a block; equal vectors are one, with their ids ascending."""

    def __init__(self, x: np.ndarray, ids: np.ndarray):
        _, one, same = np.unique(np.ascontiguousarray(x).view(np.dtype((np.void, x.itemsize * x.shape[1])))[:, 0], return_index=True, return_inverse=True)
        self.x, order = x[one], np.lexsort((ids, same))
        self.ids, self.first = ids[order], np.concatenate([[0], np.cumsum(np.bincount(same))])  # copies are ids[first[i]:first[i + 1]]
        self.low, self.high = self.ids[self.first[:-1]], self.ids[self.first[1:] - 1]
        # twice the most that two ways of summing can differ
        self.size, self.rounding = np.linalg.norm(self.x, axis=1), 4 * (x.shape[1] + 2) * np.finfo(float).eps

    def nearest(self, qid: np.ndarray, asked: np.ndarray, k: int):
        """Per query, vec_ids and exact scores of its best ``k``."""
        s = asked @ self.x.T
        s[(qid[:, None] == self.low) & (self.low == self.high)] = -np.inf
        n = min(k, s.shape[1])
        margin = self.rounding * np.linalg.norm(asked, axis=1)[:, None] * self.size + np.finfo(float).tiny
        # everything that can be as good as the k-th; the exact scores decide
        edge = -np.partition(margin - s, n - 1, axis=1)[:, n - 1]
        for r in range(len(qid)):
            at = np.flatnonzero((s[r] + margin[r] >= edge[r]) & (s[r] > -np.inf))
            score = exact(asked[r], self.x[at])
            copies = [c[c != qid[r]][:k] for c in (self.ids[self.first[j]:self.first[j + 1]] for j in at)]
            score, near = np.repeat(score, [len(c) for c in copies]), np.concatenate([self.ids[:0], *copies])
            best = np.lexsort((near, -score))[:k]
            yield near[best], score[best]


def _scan(k: int, most: int):
    """Rows sorted by block, vectors before queries: holds one block and at most ``most`` queries."""
    def answers(block, waiting):
        qid, q, asked = (np.concatenate(c) for c in zip(*waiting))
        found = list(block.nearest(qid, asked, k))
        sizes = [len(ids) for ids, _ in found]
        return pa.RecordBatch.from_arrays([pa.array(np.repeat(qid, sizes), pa.int64()), pa.array(np.repeat(q, sizes), pa.int64()), pa.array(np.concatenate([i for i, _ in found]), pa.int64()),
                                           pa.array(np.concatenate([s for _, s in found]), pa.float64())], names=["query_id", "q", "vec_id", "score"])

    def run(batches):
        key, rows, block, waiting = None, [], None, []
        for b in batches:
            if not b.num_rows:
                continue
            part, r, asks = (b.column(c).to_numpy(zero_copy_only=False) for c in ("part", "r", "asks"))
            ids, q, x = b.column("id").to_numpy(), b.column("q").to_numpy(), _matrix(b.column("v"))
            cuts = np.flatnonzero((np.diff(part) != 0) | (np.diff(r) != 0) | (np.diff(asks.astype(np.int8)) != 0)) + 1
            for i, j in zip([0, *cuts.tolist()], [*cuts.tolist(), b.num_rows]):
                if key != (part[i], r[i]):
                    if waiting:
                        yield answers(block, waiting)
                    key, rows, block, waiting = (part[i], r[i]), [], None, []
                if not asks[i]:
                    rows.append((x[i:j], ids[i:j]))
                    continue
                if block is None:
                    if not rows:
                        continue  # a block without vectors
                    block, rows = Block(*(np.concatenate(c) for c in zip(*rows))), []
                while i < j:
                    n = min(j - i, most - sum(len(w[0]) for w in waiting))
                    waiting.append((ids[i:i + n], q[i:i + n], x[i:i + n]))
                    i += n
                    if sum(len(w[0]) for w in waiting) >= most:
                        yield answers(block, waiting)
                        waiting = []
        if waiting:
            yield answers(block, waiting)
    return run


def exact(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Inner products summed component by component, so equal vectors have equal scores wherever they are."""
    s = np.zeros(len(x))
    for j in range(len(q)):
        s += q[j] * x[:, j]
    return s


def _search(home: DataFrame, asked: DataFrame, k: int) -> DataFrame:
    """home: vec_id, v, part; asked: query_id, q, v, part. Best k of each block."""
    wanted = asked.select("part").distinct()
    blocks = F.broadcast(home.groupBy("part").agg(F.ceil(F.count("*") / ROW_BLOCK).cast("int").alias("rb")).join(wanted, "part"))  # a row per part
    rows = home.join(blocks, "part").select("part", F.pmod(F.xxhash64("vec_id", "v"), F.col("rb")).cast("int").alias("r"), F.lit(False).alias("asks"), F.col("vec_id").alias("id"), F.lit(0).cast("long").alias("q"), "v")
    queries = (asked.join(blocks, "part").withColumn("r", F.explode(F.sequence(F.lit(0), F.col("rb") - 1)))
               .select("part", "r", F.lit(True).alias("asks"), F.col("query_id").alias("id"), "q", "v"))
    sent = rows.unionByName(queries).repartition("part", "r").sortWithinPartitions("part", "r", "asks")
    return sent.mapInArrow(_scan(k, QUERY_BLOCK), "query_id long, q long, vec_id long, score double")


def search(embeddings: DataFrame, every: int = 20, k: int = 20, parts: int | None = None, recall: float = RECALL,
           probes: int | None = None, max_sample: int = MAX_SAMPLE) -> DataFrame:
    """query_id, rank, vec_id, score: the ``k`` nearest found of every row whose vec_id is divisible by ``every``."""
    spark = embeddings.sparkSession
    prepare(spark)
    rows = usable(embeddings)
    queries = rows.where(F.col("vec_id") % every == 0)
    tried = queries.join(F.broadcast(smallest_hashes(queries.select("vec_id"), HELD_OUT)), "vec_id").groupBy("vec_id").agg(F.min("v").alias("v"))  # at most HELD_OUT rows
    tried = tried.withColumn("h", F.xxhash64("v")).orderBy("vec_id").toPandas()
    hashed = rows.select(F.xxhash64("v").alias("h"), "v").where(~F.col("h").isin(tried["h"].tolist()))
    chosen = F.broadcast(smallest_hashes(hashed.select("h"), max_sample))  # at most max_sample numbers
    sample = hashed.join(chosen, "h").groupBy("h").agg(F.first("v").alias("v")).orderBy("h").select("v").toPandas()
    x = np.array(sample["v"].tolist(), float).reshape(len(sample), -1 if len(sample) else 1)
    router = fit(x, parts or max(PARTS, min(int(rows.count() ** 0.5 / 8), max_sample // PART_SAMPLE)))
    count = router.w2.shape[1] if router else 1
    shared = spark.sparkContext.broadcast(router)
    schema = "vec_id long, v array<double>, parts array<int>"
    home = staged(rows.mapInArrow(_ranked(shared, 1), schema).select("vec_id", "v", F.col("parts")[0].alias("part")), "ann-index")
    n = min(probes or calibrate(home, router, tried["vec_id"].to_numpy(), np.array(tried["v"].tolist(), float).reshape(len(tried), -1 if len(tried) else 1), k, recall), count) if router else 1
    own = F.col("vec_id") % every == 0
    queries = (staged(home.where(own).select("vec_id", "v").dropDuplicates().mapInArrow(_ranked(shared, n), schema), "ann-queries")
               .select(F.col("vec_id").alias("query_id"), F.xxhash64("v").alias("q"), "v", "parts"))
    found = staged(_search(home, queries.select("query_id", "q", "v", F.explode("parts").alias("part")), k), "ann-found")
    counts = found.groupBy("query_id", "q").agg(F.count("*").alias("n"))
    short = queries.join(counts, ["query_id", "q"], "left").where(F.coalesce("n", F.lit(0)) < k).select("query_id", "q", "v")
    if router and not short.isEmpty():
        again = _search(home, short.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(count - 1)))).select("query_id", "q", "v", "part"), k)
        found = found.join(short.select("query_id", "q"), ["query_id", "q"], "left_anti").union(again)
    best = found.groupBy("query_id", "q").agg(F.slice(F.array_sort(F.collect_list(F.struct((-F.col("score")).alias("worse"), "vec_id"))), 1, k).alias("top"))
    flat = best.select("query_id", F.posexplode("top").alias("pos", "hit"))
    return flat.select("query_id", (F.col("pos") + 1).cast("int").alias("rank"), F.col("hit.vec_id").alias("vec_id"), (-F.col("hit.worse")).alias("score"))
