"""Approximate nearest neighbours by an adaptive dimension scan.

Nearness is the largest inner product. Vectors are put in the list of their
nearest centre, with one more component that brings all to the same length; a
query probes the lists of the centres with the largest products. Within a list
the vectors, brought to length one, are turned by a random rotation and scanned
in blocks of columns. The share of a squared distance that lies in the first
columns of such a rotation has a known distribution, so a candidate goes as soon
as a test says that its whole distance exceeds the one at which its product
would be the k-th best found so far (adaptive sampling of dimensions, Gao and
Long, SIGMOD 2023). What is left after the last block gets its product from the
original vectors, in double precision.

Work is split by list, blocks of a list's vectors and parts of the queries, so
a task holds at most ``BLOCK`` vectors and about ``PART`` queries, also where one
list holds a third of all. A query first scans its own list, whose k-th best
starts the tests in all others.

Centres, rotation and number of probed lists are fitted on a sample of at most
``SAMPLE`` vectors, those with the smallest hashes; every vector is indexed. The
number of lists is fixed, and as many are probed as hold ``TARGET`` of the
sample's own true neighbours: few where the data lie in clusters, most where
they don't.

Defined cases: vectors that are null, empty or zero or hold null or non-finite
components take no part, nor do rows without an id. Shorter vectors are filled
up with zeros. Rows that share an id count as one candidate, with their best
product; a query never finds its own id; of several vectors of a query id the
smallest, compared by components, is searched. Ties go to the smaller id. With
fewer candidates than k, those found are returned; without any, there are no
rows. Other columns are ignored, whatever their names.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from meridian.llm.common import ship, staged

K = 20
LISTS = 64
SAMPLE = 20_000
SAMPLE_QUERIES = 400
TARGET = 0.97           # share of the sample's neighbours that lie in probed lists
ERROR = 2.5             # a candidate is given up at so many deviations; larger is surer
SLACK = 1e-9            # for rounding, of vectors of length one
COLUMNS = 16            # of a block
BLOCK = 8_192           # vectors a task holds
PART = 4_096            # queries a task holds
STEP = 1_024            # vectors scanned between two looks at the k-th best
SEED = 20_231


@dataclass
class Model:
    width: int              # components of a vector
    scale: float            # largest absolute component
    norm2: float            # largest squared length after scaling
    centres: np.ndarray     # lists x (width + 1)
    rotation: np.ndarray    # width x width
    probes: int             # lists a query looks into


def _usable(vectors: DataFrame) -> DataFrame:
    """``(vec_id, v)`` of the rows that take part."""
    ok = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    v = F.col("embedding")
    return (vectors.where(F.col("vec_id").isNotNull() & v.isNotNull())
            .where(F.forall(v, ok) & F.exists(v, lambda x: x != 0)).select("vec_id", v.alias("v")))


def _matrix(column, width: int) -> np.ndarray:
    """An Arrow column of lists as rows of doubles, filled up with zeros."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    sizes = np.diff(column.offsets.to_numpy())
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    if (sizes == width).all():
        return flat.reshape(len(sizes), width)
    out = np.zeros((len(sizes), width))
    out[np.repeat(np.arange(len(sizes)), sizes), np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = flat
    return out


def _lifted(x: np.ndarray, model: Model) -> np.ndarray:
    """Scaled vectors with the component that brings them to one length."""
    x = x / model.scale
    rest = np.sqrt(np.maximum(model.norm2 - np.einsum("ij,ij->i", x, x), 0.0))
    return np.column_stack([x, rest])


def _products(x: np.ndarray, model: Model) -> np.ndarray:
    """Products of queries with the centres."""
    return (x / model.scale) @ model.centres[:, :-1].T


def _nearest_centre(lifted: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return (lifted @ centres.T - (centres * centres).sum(1) / 2).argmax(1)


def fit(vectors: DataFrame, k: int = K, lists: int = LISTS, target: float = TARGET) -> Model | None:
    """Fitted on at most ``SAMPLE`` of the usable vectors; None without any."""
    size = vectors.agg(F.max(F.size("v")).alias("width"),
                       F.max(F.array_max(F.transform("v", F.abs))).cast("double").alias("scale")).collect()[0]
    if size["width"] is None:
        return None
    scaled2 = F.aggregate("v", F.lit(0.0), lambda s, x: s + (x / F.lit(size["scale"])) * (x / F.lit(size["scale"])))
    norm2 = vectors.agg(F.max(scaled2)).collect()[0][0]
    rows = vectors.orderBy(F.xxhash64("vec_id", "v"), "vec_id").limit(SAMPLE).select("v").toArrow()
    rng = np.random.default_rng(SEED)
    width = size["width"]
    rotation = np.linalg.qr(rng.standard_normal((width, width)))[0]
    model = Model(width, size["scale"], norm2, np.zeros((1, width + 1)), rotation, 1)
    x = _matrix(rows.column("v"), width)
    lifted = _lifted(x, model)
    centres = lifted[rng.permutation(len(lifted))[:lists]]
    for _ in range(10):
        own = _nearest_centre(lifted, centres)
        sums = np.zeros_like(centres)
        np.add.at(sums, own, lifted)
        n = np.bincount(own, minlength=len(centres))[:, None]
        centres = np.where(n > 0, sums / np.maximum(n, 1), centres)
    model.centres = centres
    own = _nearest_centre(lifted, centres)
    # how many of the first lists hold the neighbours of the first vectors
    q = x[:SAMPLE_QUERIES] / model.scale
    near = q @ (x / model.scale).T
    near[np.arange(len(q)), np.arange(len(q))] = -np.inf
    best = np.argsort(-near, axis=1)[:, :min(k, len(x) - 1)]
    place = np.argsort(np.argsort(-_products(x[:SAMPLE_QUERIES], model), axis=1), axis=1)
    needed = np.sort(np.take_along_axis(place, own[best], axis=1).ravel())
    model.probes = 1 + int(needed[min(len(needed) - 1, int(target * len(needed)))]) if len(needed) else len(centres)
    return model


def _list_of(model: Model):
    def assign(batches):
        for batch in batches:
            own = _nearest_centre(_lifted(_matrix(batch.column("v"), model.width), model), model.centres)
            yield pa.record_batch([*batch.columns, pa.array(own, pa.int32())], [*batch.schema.names, "list"])
    return assign


def _lists_for(model: Model):
    def assign(batches):
        for batch in batches:
            order = np.argsort(-_products(_matrix(batch.column("v"), model.width), model), axis=1, kind="stable")
            probed = pa.array(list(order[:, :model.probes].astype(np.int32)), pa.list_(pa.int32()))
            yield pa.record_batch([*batch.columns, probed], [*batch.schema.names, "lists"])
    return assign


def _exact(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Products of rows, summed in the order of the components."""
    total = np.zeros(len(q))
    for d in range(q.shape[1]):
        total += q[:, d] * x[:, d]
    return total


def _best(scores: np.ndarray, ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The k best distinct ids."""
    order = np.lexsort((ids, -scores))
    scores, ids = scores[order], ids[order]
    first = np.sort(np.unique(ids, return_index=True)[1])[:k]
    return scores[first], ids[first]


def _units(x: np.ndarray, model: Model) -> tuple[np.ndarray, np.ndarray]:
    """Rotated vectors of length one, and the lengths they had."""
    x = x / model.scale
    length = np.sqrt(np.einsum("ij,ij->i", x, x))
    length[length == 0] = 1.0        # components too small to square: kept by the slack of the test
    return (x / length[:, None]) @ model.rotation, length


def _share(columns: int, width: int, error: float) -> float:
    """At most this share of a squared distance lies in so many of the rotated
    columns, but for an unlikely rotation: the share has a beta distribution."""
    return columns / width + error * np.sqrt(2 * columns * (width - columns) / (width + 2)) / width


def scan(x: np.ndarray, ids: np.ndarray, q: np.ndarray, own: np.ndarray, bound: np.ndarray, model: Model, k: int,
         error: float = ERROR) -> list[tuple[np.ndarray, np.ndarray]]:
    """The best candidates ``(scores, ids)`` of each query among ``x``: at most
    k, those of at least ``bound`` (the k-th best product known, or -inf)."""
    width = model.width
    edges = [*range(0, width, COLUMNS), width]
    (turned, length), (q_turned, q_length) = _units(x, model), _units(q, model)
    found = [(np.zeros(0), np.zeros(0, ids.dtype))] * len(q)
    bound = bound.astype(np.float64).copy()
    for start in range(0, len(x), STEP):
        part, part_ids, part_length = (a[start:start + STEP] for a in (turned, ids, length))
        for first in range(0, len(q), 256):
            last = min(first + 256, len(q))
            mine = q_turned[first:last]
            # squared distance at which a candidate's product would be the bound
            radius2 = 2 - 2 * (bound[first:last] / model.scale / model.scale / q_length[first:last])[:, None] / part_length
            block = slice(0, edges[1])
            dist = ((mine[:, block] ** 2).sum(1)[:, None] + (part[:, block] ** 2).sum(1) - 2 * mine[:, block] @ part[:, block].T)
            alive = part_ids != own[first:last, None]
            if edges[1] < width:
                alive &= dist <= radius2 * _share(edges[1], width, error) + SLACK
            who, cand = np.nonzero(alive)
            dist = dist[who, cand]
            for i, j in zip(edges[1:-1], edges[2:]):
                step = mine[who, i:j] - part[cand, i:j]
                dist = dist + np.einsum("ij,ij->i", step, step)
                ok = dist <= radius2[who, cand] * (_share(j, width, error) if j < width else 1.0) + SLACK
                who, cand, dist = who[ok], cand[ok], dist[ok]
            if not len(who):
                continue
            score = np.concatenate([_exact(q[first + who[i:i + 100_000]], x[start + cand[i:i + 100_000]])
                                    for i in range(0, len(who), 100_000)])
            ok = score >= bound[first + who]
            who, cand, score = who[ok], cand[ok], score[ok]
            cuts = np.searchsorted(who, np.arange(last - first + 1))
            for at in np.unique(who):
                i, j = cuts[at], cuts[at + 1]
                held = found[first + at]
                best = _best(np.r_[held[0], score[i:j]], np.r_[held[1], part_ids[cand[i:j]]], k)
                found[first + at] = best
                if len(best[0]) == k:
                    bound[first + at] = max(bound[first + at], best[0][-1])
    return found


FOUND = "query_id long, vec_id long, score double"
_EMPTY = pa.table({"query_id": pa.array([], pa.int64()), "vec_id": pa.array([], pa.int64()), "score": pa.array([], pa.float64())})


def _scanner(model: Model, k: int, error: float):
    def run(vectors: pa.Table, visits: pa.Table) -> pa.Table:
        if not vectors.num_rows or not visits.num_rows:
            return _EMPTY
        own = visits.column("query_id").to_numpy()
        found = scan(_matrix(vectors.column("v"), model.width), vectors.column("vec_id").to_numpy(),
                     _matrix(visits.column("v"), model.width), own, visits.column("bound").to_numpy(), model, k, error)
        sizes = [len(s) for s, _ in found]
        return pa.table({"query_id": pa.array(np.repeat(own, sizes), pa.int64()),
                         "vec_id": pa.array(np.concatenate([i for _, i in found]), pa.int64()),
                         "score": pa.array(np.concatenate([s for s, _ in found]), pa.float64())})
    return run


def _top(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
            .withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k))


def nearest(vectors: DataFrame, queries: DataFrame, k: int = K, lists: int = LISTS, target: float = TARGET,
            error: float = ERROR) -> DataFrame:
    """``(query_id, rank, vec_id, score)``: the k nearest found of ``vectors``
    for each of ``queries``, both with ``vec_id`` and ``embedding``."""
    spark = vectors.sparkSession
    vectors = staged(_usable(vectors), "vectors")
    model = fit(vectors, k, lists, target)
    if model is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    kind = vectors.schema["v"].dataType.simpleString()
    indexed = staged(vectors.select(F.col("vec_id").cast("long").alias("vec_id"), "v")
                     .mapInArrow(_list_of(model), f"vec_id long, v {kind}, list int"), "lists")
    sizes = {r["list"]: -(-r["count"] // BLOCK) for r in indexed.groupBy("list").count().collect()}  # a row a list
    blocks = F.create_map(*[F.lit(x) for i in range(len(model.centres)) for x in (i, sizes.get(i, 1))])
    asked = _usable(queries).groupBy(F.col("vec_id").cast("long").alias("query_id")).agg(F.min("v").alias("v"))
    asked = staged(asked.mapInArrow(_lists_for(model), f"query_id long, v {kind}, lists array<int>"), "queries")
    n_parts = max(1, -(-asked.count() // PART))
    spread = indexed.select("vec_id", "v", "list", F.pmod(F.xxhash64("vec_id", "v"), blocks[F.col("list")]).alias("block"),
                            F.explode(F.sequence(F.lit(0), F.lit(n_parts - 1))).alias("part"))

    def visit(of: DataFrame) -> DataFrame:
        to = of.select("query_id", "v", "bound", F.explode("lists").alias("list"))
        to = to.select("*", F.explode(F.sequence(F.lit(0).cast("long"), blocks[F.col("list")].cast("long") - 1)).alias("block"),
                       F.pmod(F.xxhash64("query_id"), F.lit(n_parts)).cast("int").alias("part"))
        groups = [df.groupBy("list", "block", "part") for df in (spread, to)]
        return staged(groups[0].cogroup(groups[1]).applyInArrow(_scanner(model, k, error), FOUND), "found")

    nothing = F.lit(float("-inf"))
    home = visit(asked.select("query_id", "v", F.slice("lists", 1, 1).alias("lists"), nothing.alias("bound")))
    kth = _top(home, k).where(F.col("rank") == k).select("query_id", F.col("score").alias("bound"))
    rest = visit(asked.select("query_id", "v", F.slice("lists", 2, max(1, model.probes - 1)).alias("lists"))
                 .join(kth, "query_id", "left").withColumn("bound", F.coalesce("bound", nothing)))
    return _top(home.unionByName(rest), k).select("query_id", "rank", "vec_id", "score")


ship(__name__)
