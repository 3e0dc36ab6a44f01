"""Nearest neighbours by inner product over balanced posting lists.

Vectors gain one component that makes all lengths equal, so the largest inner product is the smallest
distance. Centroids come from k-means on a bounded sample; every vector is written to the lists of
its nearest centroids, boundary vectors to several (the next centroid must be almost as near and
stand apart from those already taken). A query walks a neighbour graph of the
centroids in memory and opens the lists whose distance is within ``RATIO`` of the nearest. Lists and
their queries are cut into blocks of bounded size, and scores come from the original vectors in
double precision.

Vectors that are null, empty, zero, of another length than most, or hold null or non-finite
components take no part, nor do rows with a null vec_id. Equal vectors are searched once and keep the
smallest ids, so ties go to the smaller vec_id and a repeated row counts once. An empty table gives
an empty result.
"""

from __future__ import annotations

import heapq

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lapsewise.storage import write_and_reload

#: Vectors that k-means sees, and centroids, at most; vectors per list aimed at.
SAMPLE_ROWS, MOST_LISTS, LIST_ROWS = 50_000, 2048, 200
#: Lists of one vector at most, and how much farther than the nearest a list of it may be.
COPIES, SLACK = 3, 1.5
#: Centroids closer to each other than this share of a vector's distance do not both hold it.
APART = 0.2
#: Lists opened by a query: at most so much farther than the nearest, at least so many, at most so many
#: or this share of all lists.
RATIO, LEAST_LISTS, TOP_LISTS, TOP_SHARE = 1.6, 8, 64, 0.25
#: Vectors, and queries, of one list that go to one task.
BLOCK_ROWS = 4096
SALTS = 16


class Centroids:
    """Centroids with a neighbour graph, walked from near to far."""

    def __init__(self, points: np.ndarray, links: int = 16):
        self.points = points
        norms = (points**2).sum(axis=1)
        apart = norms[:, None] - 2 * points @ points.T + norms
        np.fill_diagonal(apart, np.inf)
        n = len(points)
        near = np.argsort(apart, axis=1, kind="stable")[:, : min(links, n - 1)]
        # A ring and a far jump keep the graph in one piece.
        ring = (np.arange(n)[:, None] + np.array([1, n - 1, n // 2 or 1, n // 3 or 1])) % n
        self.graph = np.hstack([near, ring])
        self.entries = np.unique(np.linspace(0, n - 1, min(n, 32)).astype(int))

    def search(self, x: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
        """Up to ``width`` near centroids and their squared distances, nearest first."""
        seen = np.zeros(len(self.points), dtype=bool)
        frontier, kept = [], []

        def visit(ids):
            ids = np.unique(ids[~seen[ids]])
            seen[ids] = True
            for d, i in zip((((self.points[ids] - x) ** 2).sum(axis=1)).tolist(), ids.tolist()):
                if len(kept) < width or d < -kept[0][0]:
                    heapq.heappush(frontier, (d, i))
                    heapq.heappush(kept, (-d, i))
                    if len(kept) > width:
                        heapq.heappop(kept)

        visit(self.entries)
        while frontier:
            d, i = heapq.heappop(frontier)
            if len(kept) >= width and d > -kept[0][0]:
                break
            visit(self.graph[i])
        found = sorted((-d, i) for d, i in kept)
        return np.array([i for _, i in found]), np.array([d for d, _ in found])

    def lists_of(self, x: np.ndarray) -> list[int]:
        """Lists that hold a vector: the nearest, and near ones on other sides of it."""
        ids, dist = self.search(x, 16)
        taken = [int(ids[0])]
        for i, d in zip(ids[1:].tolist(), dist[1:].tolist()):
            if len(taken) == COPIES or d > SLACK**2 * dist[0]:
                break
            if all(((self.points[i] - self.points[j]) ** 2).sum() > APART**2 * d for j in taken):
                taken.append(i)
        return taken

    def opened_by(self, x: np.ndarray) -> list[int]:
        ids, dist = self.search(x, max(TOP_LISTS, int(len(self.points) * TOP_SHARE)))
        return ids[(dist <= RATIO**2 * dist[0]) | (np.arange(len(ids)) < LEAST_LISTS)].tolist()


def lengthened(x: np.ndarray, top: float) -> np.ndarray:
    rest = np.sqrt(np.maximum(0.0, top**2 - (x**2).sum(axis=1)))
    return np.hstack([x, rest[:, None]])


def fit_centroids(x: np.ndarray, count: int, rounds: int = 8, seed: int = 3) -> np.ndarray:
    points = x[np.random.default_rng(seed).choice(len(x), count, replace=False)].copy()
    for _ in range(rounds):
        sums, sizes = np.zeros_like(points), np.zeros(count)
        for i in range(0, len(x), 4096):
            part = x[i : i + 4096]
            near = np.argmax(2 * part @ points.T - (points**2).sum(axis=1), axis=1)
            np.add.at(sums, near, part)
            sizes += np.bincount(near, minlength=count)
        # Full lists shed: an empty centroid moves beside a member of the largest ones.
        empty = np.flatnonzero(sizes == 0)
        points = np.where(sizes[:, None] > 0, sums / np.maximum(1, sizes)[:, None], points)
        points[empty] = points[np.argsort(-sizes)[: len(empty)]] * (1 + 1e-3)
    return points


def usable(table: DataFrame) -> DataFrame:
    """(vec_id, x) of the rows that take part, x in the type given."""
    fine = table.where("vec_id is not null and embedding is not null").select(
        F.col("vec_id").cast("long"), F.col("embedding").alias("x")
    )
    bad = F.exists("x", lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
    fine = fine.where(~bad & F.exists("x", lambda v: v != 0))
    usual = fine.groupBy(F.size("x").alias("n")).count().orderBy(F.desc("count"), "n").first()
    return fine.where(F.size("x") == (usual["n"] if usual else 0))


def search(table: DataFrame, every: int = 20, top: int = 20) -> DataFrame:
    """The ``top`` nearest of each row whose vec_id is divisible by ``every``: query_id, rank, vec_id, score."""
    spark = table.sparkSession
    rows = usable(table)
    kind = rows.schema["x"].dataType.simpleString()
    # Equal vectors: the smallest ids suffice, one more than asked for as a query leaves itself out.
    order = Window.partitionBy("x").orderBy("vec_id")
    ids = (
        rows.distinct().withColumn("_n", F.row_number().over(order)).where(F.col("_n") <= top + 1)
        .groupBy("x").agg(F.array_sort(F.collect_list("vec_id")).alias("ids"))
    )
    vectors = write_and_reload(ids.select(F.element_at("ids", 1).alias("rep"), "x", "ids"), "ann-vectors")
    asked = rows.where(F.col("vec_id") % every == 0)
    stats = vectors.agg(F.count("*"), F.max(F.sqrt(F.aggregate("x", F.lit(0.0), lambda s, v: s + v.cast("double") * v.cast("double"))))).first()
    if not stats[0]:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    n, longest = stats
    sample = vectors.where(F.pmod(F.xxhash64("rep"), F.lit(1 << 30)) < int((1 << 30) * min(1.0, SAMPLE_ROWS / n)))
    sample = np.array([[float(v) for v in r.x] for r in sample.select("x").orderBy("x").collect()] or [vectors.first().x], dtype=np.float64)
    lists = max(1, min(MOST_LISTS, n // LIST_ROWS, len(sample)))
    shared = spark.sparkContext.broadcast((Centroids(fit_centroids(lengthened(sample, longest), lists)), longest))

    def listed(batches):
        centroids, longest = shared.value
        for batch in batches:
            x = lengthened(np.stack(batch["x"]).astype(np.float64), longest)
            found = [centroids.lists_of(v) for v in x]
            yield batch.assign(list=found)

    # A query asks for any vector of its direction: its added component is 0, its length the longest.
    def opened(batches):
        centroids, longest = shared.value
        for batch in batches:
            x = np.stack(batch["x"]).astype(np.float64)
            x = np.hstack([x / np.sqrt((x**2).sum(axis=1, keepdims=True)) * longest, np.zeros((len(x), 1))])
            yield batch[["rep", "x"]].assign(list=[centroids.opened_by(v) for v in x])

    index = write_and_reload(
        vectors.mapInPandas(listed, f"rep long, x {kind}, ids array<long>, list array<int>"), "ann-index"
    ).withColumn("list", F.explode("list"))
    spread = F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))
    reps = vectors.select("x", "rep").withColumn("_salt", spread)
    salted = asked.distinct().withColumn("_salt", F.pmod("vec_id", F.lit(SALTS)).cast("int"))
    queries = write_and_reload(salted.join(reps, ["x", "_salt"]).select(F.col("vec_id").alias("query_id"), "rep"), "ann-queries")
    asked_reps = vectors.join(queries.select("rep").distinct(), "rep")
    visits = write_and_reload(
        asked_reps.mapInPandas(opened, f"rep long, x {kind}, list array<int>"), "ann-visits"
    ).withColumn("list", F.explode("list"))

    # One row per list, at most MOST_LISTS.
    def blocks(of: DataFrame, name: str) -> DataFrame:
        return of.groupBy("list").agg(F.ceil(F.count("*") / BLOCK_ROWS).cast("int").alias(name))

    cut = F.broadcast(blocks(index, "_vb").join(blocks(visits, "_qb"), "list"))

    def own(part: str):
        return F.pmod(F.xxhash64("rep"), F.col(part)).cast("int")

    def every_block(part: str):
        return F.explode(F.sequence(F.lit(0), F.col(part) - 1))

    left = visits.join(cut, "list").withColumn("qb", own("_qb")).withColumn("vb", every_block("_vb"))
    right = index.join(cut, "list").withColumn("vb", own("_vb")).withColumn("qb", every_block("_qb"))
    keys = ["list", "qb", "vb"]

    def compare(q: pd.DataFrame, v: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(q) and len(v):
            x, rep, ids = np.stack(v["x"]).astype(np.float64), v["rep"].to_numpy(), v["ids"].to_numpy()
            for i in range(0, len(q), 256):
                part = q.iloc[i : i + 256]
                y = np.stack(part["x"]).astype(np.float64)
                rough = y @ x.T
                keep = min(2 * top + 2, len(v))
                near = np.argpartition(-rough, keep - 1, axis=1)[:, :keep]
                for j, (who, vector) in enumerate(zip(part["rep"], y)):
                    exact = (x[near[j]] * vector).sum(axis=1)
                    best = sorted(zip((-exact).tolist(), rep[near[j]].tolist(), near[j].tolist()))[: top + 1]
                    out += [(who, r, -s, ids[k]) for s, r, k in best]
        return pd.DataFrame(out, columns=["query", "rep", "score", "ids"])

    pairs = left.select(*keys, "rep", "x").groupBy(keys).cogroup(
        right.select(*keys, "rep", "x", "ids").groupBy(keys)
    ).applyInPandas(compare, "query long, rep long, score double, ids array<long>")
    # A vector found in several lists counts once; its copies are as near as it is.
    found = (
        pairs.groupBy("query", "rep").agg(F.max("score").alias("score"), F.first("ids").alias("ids"))
        .select("query", "score", F.explode("ids").alias("vec_id"))
    )
    best = Window.partitionBy("query").orderBy(F.desc("score"), "vec_id")
    found = (
        found.withColumn("_n", F.row_number().over(best)).where(F.col("_n") <= top + 1)
        .groupBy("query").agg(F.array_sort(F.collect_list(F.struct((-F.col("score")).alias("minus"), "vec_id"))).alias("near"))
    )
    found = found.withColumn("_salt", spread)
    named = queries.withColumn("_salt", F.pmod("query_id", F.lit(SALTS)).cast("int")).join(
        found, (F.col("rep") == F.col("query")) & (queries["query_id"].isNotNull()) & (F.pmod("query_id", F.lit(SALTS)).cast("int") == found["_salt"])
    )
    others = F.slice(F.filter("near", lambda p: p["vec_id"] != F.col("query_id")), 1, top)
    return named.select("query_id", F.posexplode(others).alias("_at", "p")).select(
        "query_id", (F.col("_at") + 1).alias("rank"), "p.vec_id", (-F.col("p.minus")).alias("score")
    )
