"""Exact top-k search by columnar branch and bound.

Vectors are turned into integers and laid out block by block in vertical layout, one
dimension after the other. A query adds up its inner products a block of dimensions at a
time over all candidates of a block; what the remaining dimensions can still add is bounded
by the remaining masses (Cauchy-Schwarz), and candidates that can't reach the k-th best
lower bound are compacted away before the next dimensions are read.

Candidates are dealt to groups by a hash of the distinct row, so that a group holds at most
so many components whatever the ids look like; each group gets a copy of every query. One
exchange brings them together, candidates first: a task keeps the blocks of one group and lets
the queries pass. Never a broadcast, and no more groups than memory and cores ask for, so that
the copies of the queries don't outgrow the candidates.

Defined results
* null or empty vectors, and vectors with null, NaN or infinite components, take no part;
* vectors of different dimension are never compared;
* repeated rows count once; rows of one id with different vectors are one candidate, and
  one query, with the best of its scores;
* scores beyond 64 bits are set to the nearest 64-bit value; other columns aren't read; an
  empty table gives an empty table.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from learnmetrics.llm.common import release, table

SCALE = 256
TOP = 5
QUERY_STEP = 50
#: Most rows in a block of candidates, and in a block of queries.
CANDIDATE_ROWS, QUERY_ROWS = 1 << 14, 512
#: Most components in a group of candidates, on average (64 MB of a task).
GROUP_CELLS = 1 << 23
#: Dimensions added up between two rounds of compaction.
STEP = 8


def usable(column: str):
    """The vector is there and all its components are finite."""
    finite = F.forall(column, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return F.col(column).isNotNull() & (F.size(column) > 0) & F.coalesce(finite, F.lit(False))


def _distinct(vectors: DataFrame) -> DataFrame:
    """Repeated rows are put together before the shuffle."""
    return vectors.groupBy("id", "v").agg(F.lit(1).alias("one")).select("id", "v")


def _group_count(rows: int, cells: int, query_rows: int, cores: int, tasks: int) -> int:
    """Groups of candidates: as many as memory needs, and otherwise only so many that the copies of
    the queries are no more rows than the candidates, unless there are idle cores."""
    shared = max(2 * cores, rows // max(1, query_rows))
    return max(1, math.ceil(cells / GROUP_CELLS), min(2 * tasks, math.ceil(rows / 1024), shared))


def _exact_dot(columns: np.ndarray, query: np.ndarray) -> np.ndarray:
    """Inner products of huge integers, within 64 bits."""
    exact = [sum(int(a) * int(b) for a, b in zip(row, query, strict=True)) for row in columns.T]
    return np.array([max(-(2**63), min(2**63 - 1, x)) for x in exact], dtype=np.int64)


def search_block(ids: np.ndarray, columns: np.ndarray, query_ids: np.ndarray, queries: np.ndarray, top: int):
    """(query place, id, score) of every query's best ``top`` candidates of one block.

    ``columns`` is dimensions x candidates, ``queries`` dimensions x queries.
    """
    dims = len(columns)
    # Rows that hold the best ``top`` ids for certain, where several rows share an id.
    need = (top - 1) * int(np.unique(ids, return_counts=True)[1].max(initial=1)) + 1
    order = np.argsort(-(np.abs(columns).sum(axis=1) * np.abs(queries).sum(axis=1)), kind="stable")
    columns, queries = columns[order], queries[order]
    big = float(np.abs(columns).max(initial=0)) * float(np.abs(queries).max(initial=0)) * dims >= 2**52
    cuts = [*range(0, dims, STEP), dims]
    left = [np.sqrt((columns[c:] ** 2).sum(axis=0)) for c in cuts[1:]]
    mine = [np.sqrt((queries[c:] ** 2).sum(axis=0)) for c in cuts[1:]]
    found_q, found_id, found_score = [], [], []
    first = queries[: cuts[1]].T @ columns[: cuts[1]]
    for q in range(len(query_ids)):
        alive = np.flatnonzero(ids != query_ids[q])
        if big:
            total = _exact_dot(columns[:, alive], queries[:, q])
        else:
            total = first[q][alive]
            for b, (lo, hi) in enumerate(zip(cuts[:-1], cuts[1:], strict=True)):
                if b:
                    total = total + queries[lo:hi, q] @ columns[lo:hi, alive]
                if len(alive) > need and hi < dims:
                    slack = left[b][alive] * mine[b][q] * (1 + 1e-9) + 1e-6
                    low = total - slack
                    bar = np.partition(low, len(low) - need)[len(low) - need]
                    stay = total + slack >= bar
                    if not stay.all():
                        alive, total = alive[stay], total[stay]
            total = total.astype(np.int64)
        if len(alive) > need:
            bar = np.partition(total, len(total) - need)[len(total) - need]
            stay = total >= bar
            alive, total = alive[stay], total[stay]
        best = np.lexsort((ids[alive], -total))
        # Rows of one id follow each other; the first of them is its best.
        _, once = np.unique(ids[alive][best], return_index=True)
        best = best[np.sort(once)][:top]
        found_q.append(np.full(len(best), q))
        found_id.append(ids[alive][best])
        found_score.append(total[best])
    return (np.concatenate(x) if x else np.zeros(0, np.int64) for x in (found_q, found_id, found_score))


def _pieces(batches, most: tuple[int, int]):
    """(group, dim, asks, ids, vectors) of up to ``most[asks]`` rows each, of rows sorted by group, dim
    and asks."""
    now, ids, values, held = None, [], [], 0
    for batch in batches:
        if batch.num_rows == 0:
            continue
        keys = [batch.column(c).to_numpy(zero_copy_only=False) for c in ("group", "dim", "asks")]
        edges = (np.flatnonzero(np.any([k[1:] != k[:-1] for k in keys], axis=0)) + 1).tolist()
        for lo, hi in zip([0, *edges], [*edges, batch.num_rows], strict=True):
            key = tuple(k[lo].item() for k in keys)
            while lo < hi:
                if held and (key != now or held == most[now[2]]):
                    yield *now, np.concatenate(ids), np.concatenate(values)
                    ids, values, held = [], [], 0
                now = key
                rows = min(hi - lo, most[now[2]] - held)
                ids.append(batch.column("id").slice(lo, rows).to_numpy(zero_copy_only=False))
                values.append(batch.column("v").slice(lo, rows).flatten().to_numpy(zero_copy_only=False).reshape(rows, -1))
                lo, held = lo + rows, held + rows
    if held:
        yield *now, np.concatenate(ids), np.concatenate(values)


def _best(place: np.ndarray, ids: np.ndarray, score: np.ndarray, top: int):
    """Of each query place its best ``top`` ids; an id counts once, with the best of its scores."""
    order = np.lexsort((~score, ids, place))
    place, ids, score = place[order], ids[order], score[order]
    once = np.ones(len(place), dtype=bool)
    once[1:] = (place[1:] != place[:-1]) | (ids[1:] != ids[:-1])
    place, ids, score = place[once], ids[once], score[once]
    order = np.lexsort((ids, ~score, place))
    place, ids, score = place[order], ids[order], score[order]
    stay = np.arange(len(place)) - np.searchsorted(place, place) < top
    return place[stay], ids[stay], score[stay]


def search_groups(batches, top: int, candidate_rows: int, query_rows: int):
    """(query_id, vec_id, score) of every query's best ``top`` candidates of its group, for rows
    (group, dim, asks, id, v) sorted by group, dim and asks."""
    key, blocks = None, []
    for group, dim, asks, ids, vectors in _pieces(batches, (candidate_rows, query_rows)):
        if (group, dim) != key:
            key, blocks = (group, dim), []
        columns = np.ascontiguousarray(np.floor(vectors.astype(np.float64) * SCALE).T)
        if not asks:
            blocks.append((ids, columns))
        elif blocks:
            found = zip(*(search_block(*block, ids, columns, top) for block in blocks), strict=True)
            place, near, score = _best(*(np.concatenate(x).astype(np.int64) for x in found), top)
            yield pa.RecordBatch.from_arrays([pa.array(ids[place]), pa.array(near), pa.array(score)], names=["query_id", "vec_id", "score"])
    blocks = None
    release()


def exact_top_k(vectors: DataFrame, queries: DataFrame, top: int = TOP, vec: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score): best ``top`` of ``vectors`` for each row of ``queries``."""
    spark = vectors.sparkSession
    base, asked = (
        df.where(usable(embedding) & F.col(vec).isNotNull()).select(F.col(vec).cast("long").alias("id"), F.col(embedding).alias("v"))
        for df in (vectors, queries)
    )
    rows, cells = base.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.size("v")), F.lit(0))).first()
    cores = spark.sparkContext.defaultParallelism
    groups = _group_count(rows, cells, asked.count(), cores, max(cores, int(spark.conf.get("spark.sql.shuffle.partitions"))))
    # Dealt by id and vector, so that neither a repeated row nor an id of many vectors fills one group.
    dealt = F.pmod(F.xxhash64("id", "v"), F.lit(groups)).cast("int")
    everywhere = F.explode(F.sequence(F.lit(0), F.lit(groups - 1)))
    meeting = (
        _distinct(base).select(dealt.alias("group"), F.size("v").alias("dim"), F.lit(False).alias("asks"), "id", "v")
        .unionByName(_distinct(asked).select(everywhere.alias("group"), F.size("v").alias("dim"), F.lit(True).alias("asks"), "id", "v"))
        .repartitionById(groups, "group").sortWithinPartitions("group", "dim", "asks")
    )
    candidate_rows, query_rows = CANDIDATE_ROWS, QUERY_ROWS

    def run(batches):
        return search_groups(batches, top, candidate_rows, query_rows)

    kind = T.StructType([T.StructField(c, T.LongType()) for c in ("query_id", "vec_id", "score")])
    found = meeting.mapInArrow(run, kind)
    found = found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top).select("query_id", "rank", "vec_id", "score")


def op10_exact_top_k(spark, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return exact_top_k(vectors, vectors.where(F.col("vec_id") % QUERY_STEP == 0))


OP10_SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = len(embedding)
), scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.e, c.e)::BIGINT AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 50 = 0
), ranked AS (
  SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank, vec_id, score FROM scored
)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 5
"""
