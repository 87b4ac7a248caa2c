"""Approximate nearest neighbours by inner product: NN-descent graph, greedy graph search.

1. Equal vectors become one node (the smallest id); a node keeps the ids needed to answer.
2. First neighbours come from short stretches of nodes sorted along random directions.
3. NN-descent: each round joins every node's neighbours, in both directions, with their
   vectors, compares neighbours of neighbours with each other inside the group, and keeps
   each node's best. It ends when few edges are new.
4. Search: a query keeps its best candidates, and each round expands the unvisited ones by a
   join with the neighbour lists, until all of them were visited.
5. The candidates left are scored exactly on the original vectors.

Graph and search compare 8-bit vectors; one component more makes the graph's inner products
order neighbours as distances do, whatever the norms. The caps below (neighbours kept,
reverse neighbours joined, candidates kept) are those of the method and bound every group.

Defined results
* null or empty vectors, zero vectors, and vectors with null, NaN or infinite components,
  take no part, as candidates and as queries;
* vectors of different dimension are never neighbours;
* repeated rows count once; rows of one id with different vectors are different candidates
  of that id, and its best score counts;
* queries that aren't rows of the index start from nodes chosen by hash;
* other columns aren't read; an empty table gives an empty table.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from learnmetrics.llm.common import stored, table
from learnmetrics.llm.topk import usable

TOP = 20
QUERY_STEP = 20
#: Neighbours kept per node; neighbours of both directions joined in a round; best pairs a
#: node sends on from one group.
KEPT, JOINED, SENT = 24, 36, 6
#: Rounds of NN-descent at most, and the share of new edges that ends it.
ROUNDS, ENOUGH = 8, 0.02
DIRECTIONS, STRETCH = 3, 256
#: Search: neighbours of both directions in a node's list, candidates kept, nodes expanded in a
#: round, rounds at most, starts for outside queries.
LISTED, BEAM, EXPANDED, SEARCH_ROUNDS, STARTS = 48, 200, 48, 8, 32


def _dot(a: str | Column, b: str | Column) -> Column:
    """Inner product in double precision, summed from the first component on."""
    products = F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double"))
    return F.aggregate(products, F.lit(0.0), lambda s, x: s + x)


def _lists(array: pa.Array) -> tuple[np.ndarray, pa.Array]:
    """(offsets, values) of a list array."""
    return array.offsets.to_numpy().astype(np.int64) - array.offsets[0].as_py(), array.flatten()


def _pack(vectors: np.ndarray) -> list[bytes]:
    """A 32-bit scale and 8-bit components for each row."""
    scale = np.abs(vectors).max(axis=1, keepdims=True).astype(np.float32) / 127
    scale[scale == 0] = 1
    small = np.rint(vectors / scale).astype(np.int8)
    return [bytes(r) for r in np.concatenate((scale.view(np.uint8), small.view(np.uint8)), axis=1)]


def _unpack(codes: pa.Array) -> np.ndarray:
    """Vectors (float32) of codes of one length."""
    raw = np.frombuffer(b"".join(codes.to_pylist()), dtype=np.uint8).reshape(len(codes), -1)
    return raw[:, 4:].view(np.int8) * np.ascontiguousarray(raw[:, :4]).view(np.float32)


_FOUND = T.StructType([T.StructField("node", T.LongType()), T.StructField("near", T.LongType()), T.StructField("sim", T.FloatType())])


def _found(node: list, near: list, sim: list) -> pa.RecordBatch:
    join = lambda x, kind: pa.array(np.concatenate(x) if x else np.zeros(0, kind))
    return pa.RecordBatch.from_arrays([join(node, np.int64), join(near, np.int64), join(sim, np.float32)], names=["node", "near", "sim"])


def _classes(vectors: DataFrame, vec: str, embedding: str) -> DataFrame:
    """(node, id, v): usable rows; node is the smallest id with the same vector."""
    nonzero = F.exists("v", lambda x: x != 0)
    rows = vectors.where(usable(embedding) & F.col(vec).isNotNull()).select(F.col(vec).cast("long").alias("id"), F.col(embedding).alias("v"))
    rows = rows.where(nonzero)
    return rows.join(rows.groupBy("v").agg(F.min("id").alias("node")), "v")


def _codes(classes: DataFrame) -> DataFrame:
    """(node, dim, code, along): 8-bit vector and places along the random directions."""
    nodes = classes.where("id = node").groupBy("node").agg(F.min("v").alias("v"))
    sized = nodes.withColumns({"dim": F.size("v"), "norm": _dot("v", "v")})
    largest = sized.groupBy("dim").agg(F.max("norm").alias("most"))

    def run(batches):
        for batch in batches:
            dims = batch.column(1).to_numpy()
            for dim in np.unique(dims):
                rows = np.flatnonzero(dims == dim)
                part = batch.take(pa.array(rows))
                v = part.column(2).flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(rows), dim)
                more = np.sqrt(np.maximum(part.column(4).to_numpy() - part.column(3).to_numpy(), 0))
                full = np.column_stack((v, more))
                unit = full / np.sqrt((full**2).sum(axis=1, keepdims=True))
                along = unit @ np.random.default_rng(int(dim)).normal(size=(dim + 1, DIRECTIONS))
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.array(_pack(unit), pa.binary()), pa.array(along.tolist(), pa.list_(pa.float64()))],
                    names=["node", "dim", "code", "along"],
                )

    # One row per dimension: rows of one dimension, usually all, stay where they are.
    return sized.join(F.broadcast(largest), "dim").select("node", "dim", "v", "norm", "most").mapInArrow(run, "node long, dim int, code binary, along array<double>")


def _first_neighbours(codes: DataFrame) -> DataFrame:
    """(node, near, sim) from stretches of nodes sorted along each direction."""

    def run(batches):
        for batch in batches:
            node, near, sim = [], [], []
            dims, ids = batch.column(1).to_numpy(), batch.column(0).to_numpy()
            for dim in np.unique(dims):
                rows = np.flatnonzero(dims == dim)
                for lo in range(0, len(rows), STRETCH):
                    part = rows[max(0, min(lo, len(rows) - STRETCH)) : lo + STRETCH]
                    x = _unpack(batch.column(2).take(pa.array(part)))
                    s = x @ x.T
                    np.fill_diagonal(s, -np.inf)
                    keep = min(KEPT, len(part) - 1)
                    if keep < 1:
                        continue
                    best = np.argpartition(-s, keep - 1, axis=1)[:, :keep]
                    node.append(np.repeat(ids[part], keep))
                    near.append(ids[part][best].reshape(-1))
                    sim.append(np.take_along_axis(s, best, axis=1).reshape(-1))
            yield _found(node, near, sim)

    tasks = max(1, min(int(codes.sparkSession.conf.get("spark.sql.shuffle.partitions")), codes.count() // (2 * STRETCH)))
    found = None
    for i in range(DIRECTIONS):
        placed = codes.select("node", "dim", "code", F.col("along")[i].alias("p"))
        some = placed.repartitionByRange(tasks, "dim", "p").sortWithinPartitions("dim", "p").mapInArrow(run, _FOUND)
        found = some if found is None else found.unionByName(some)
    return found


def _best(edges: DataFrame, key: str, near: str, kept: int, flag: Column) -> DataFrame:
    """Each key's ``kept`` best distinct neighbours, with the combined ``flag``.

    The rows are dealt by key once; grouping, ranking and what a caller adds by key follow in
    the same stage."""
    edges = edges.repartition(key).groupBy(key, near).agg(F.max("sim").alias("sim"), flag.alias("flag"))
    order = Window.partitionBy(key).orderBy(F.desc("sim"), near)
    return edges.withColumn("r", F.row_number().over(order)).where(F.col("r") <= kept).drop("r")


def _local_join(batches):
    """Compares the members of each group; a member gets the best it didn't have yet."""
    for batch in batches:
        node, near, sim = [], [], []
        bounds, members = _lists(batch.column(0))
        ids = members.field("u").to_numpy()
        fresh = members.field("flag").to_numpy() > 0
        bar = members.field("bar").to_numpy()
        codes = members.field("code")
        for lo, hi in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
            own, new = ids[lo:hi], fresh[lo:hi]
            if hi - lo < 2 or not new.any():
                continue
            x = _unpack(codes.slice(lo, hi - lo))
            s = x @ x.T
            s[~(new[:, None] | new[None, :]) | (own[:, None] == own[None, :]) | (s <= bar[lo:hi, None])] = -np.inf
            keep = min(SENT, hi - lo - 1)
            best = np.argpartition(-s, keep - 1, axis=1)[:, :keep]
            value = np.take_along_axis(s, best, axis=1)
            real = value > -np.inf
            node.append(np.repeat(own, real.sum(axis=1)))
            near.append(own[best][real])
            sim.append(value[real])
        yield _found(node, near, sim)


def build_graph(codes: DataFrame) -> DataFrame:
    """(node, near, sim, flag): each node's neighbours; flag tells the last round's edges."""
    graph = stored(_best(_first_neighbours(codes), "node", "near", KEPT, F.lit(1)), "graph")
    for turn in range(ROUNDS):
        both = graph.select(F.col("node").alias("v"), F.col("near").alias("u"), "flag").unionByName(
            graph.select(F.col("near").alias("v"), F.col("node").alias("u"), "flag")
        )
        order = Window.partitionBy("v").orderBy(F.desc("flag"), F.xxhash64("u", "v", F.lit(turn)))
        some = both.withColumn("r", F.row_number().over(order)).where(F.col("r") <= JOINED)
        # Code and bar of every node, by one exchange of both tables.
        known = codes.select("node", "code", F.lit(None).cast("float").alias("sim")).unionByName(
            graph.select("node", F.lit(None).cast("binary").alias("code"), "sim")
        )
        least = known.groupBy(F.col("node").alias("u")).agg(F.max("code").alias("code"), F.min("sim").alias("low"), F.count("sim").alias("c"))
        bar = F.when(F.col("c") >= KEPT, F.col("low")).otherwise(F.lit(float("-inf")).cast("float"))
        targets = least.select("u", "code", bar.alias("bar"))
        groups = some.join(targets, "u").groupBy("v").agg(F.collect_list(F.struct("u", "flag", "bar", "code")).alias("members"))
        pairs = groups.select("members").mapInArrow(_local_join, _FOUND)
        edges = graph.withColumn("flag", F.lit(0)).unionByName(pairs.withColumn("flag", F.lit(1)))
        told = Observation()
        best = _best(edges, "node", "near", KEPT, F.min("flag"))
        graph = stored(best.observe(told, F.coalesce(F.sum("flag"), F.lit(0)).alias("new"), F.count("*").alias("total")), "graph")
        if told.get["new"] <= ENOUGH * told.get["total"]:
            break
    return graph


def _expand(batches):
    """Scores the neighbours of each (query, node) row against the query's vector."""
    for batch in batches:
        query, near, sim = [], [], []
        queries, bar = batch.column(0).to_numpy(), batch.column(3).to_numpy()
        bounds, listed = _lists(batch.column(2))
        ids, codes = listed.field("near").to_numpy(), listed.field("code")
        for i, (lo, hi) in enumerate(zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True)):
            q = np.frombuffer(batch.column(1)[i].as_buffer(), dtype=np.float32)
            x = _unpack(codes.slice(lo, hi - lo))
            if x.shape[1] != len(q):
                continue
            value = x @ q
            good = value > bar[i]
            query.append(np.full(int(good.sum()), queries[i]))
            near.append(ids[lo:hi][good])
            sim.append(value[good])
        yield _found(query, near, sim)


def _query_codes(queries: DataFrame) -> DataFrame:
    """(query, node, q): the query's vector, 32-bit, with 0 for the graph's own component."""

    def run(batches):
        for batch in batches:
            vectors = [np.append(np.asarray(v, dtype=np.float32), np.float32(0)).tobytes() for v in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(vectors, pa.binary())], names=["query", "node", "q"])

    return queries.select("query", "node", "v").mapInArrow(run, "query long, node long, q binary")


def _search_state(edges: DataFrame) -> tuple[DataFrame, int]:
    """The best candidates of every query, stored, and how many of them are to be expanded.

    ``expand`` marks the next ones, ``bar`` is what their neighbours must beat: only what beats
    the last of a full beam is worth sending."""
    every = Window.partitionBy("query")
    order = Window.partitionBy("query", "flag").orderBy(F.desc("sim"), "near")
    bar = F.when(F.count("*").over(every) >= BEAM, F.min("sim").over(every)).otherwise(F.lit(float("-inf")).cast("float"))
    state = _best(edges, "query", "near", BEAM, F.max("flag")).withColumn("bar", bar)
    state = state.withColumn("expand", (F.col("flag") == 0) & (F.row_number().over(order) <= EXPANDED))
    told = Observation()
    state = stored(state.observe(told, F.count_if("expand").alias("left")), "state")
    return state, told.get["left"]


def search(graph: DataFrame, codes: DataFrame, queries: DataFrame) -> DataFrame:
    """(query, near, sim, flag): best candidates of ``queries`` (query, node, v); node is the
    query's own node, or null."""
    both = graph.select("node", "near", "sim").unionByName(graph.select(F.col("near").alias("node"), F.col("node").alias("near"), "sim"))
    lists = stored(
        _best(both, "node", "near", LISTED, F.lit(0)).join(codes.select(F.col("node").alias("near"), "code"), "near")
        .groupBy("node").agg(F.collect_list(F.struct("near", "code")).alias("listed")),
        "lists",
    )
    coded = stored(_query_codes(queries), "queries")
    starts = [r["node"] for r in codes.select("node").orderBy(F.xxhash64("node"), "node").limit(STARTS).collect()]
    begin = coded.where("node is not null").select("query", F.col("node").alias("near"))
    if starts:
        begin = begin.unionByName(coded.where("node is null").select("query", F.explode(F.array(*[F.lit(x).cast("long") for x in starts])).alias("near")))
    begin = begin.withColumns({"sim": F.lit(0.0).cast("float"), "flag": F.lit(0)})
    state, left = _search_state(begin)
    vectors = coded.select("query", "q")
    for _ in range(SEARCH_ROUNDS):
        if not left:
            break
        frontier = state.where("expand").select("query", F.col("near").alias("node"), "bar")
        rows = frontier.join(vectors, "query").join(lists, "node").select("query", "q", "listed", "bar")
        reached = rows.mapInArrow(_expand, _FOUND).withColumnRenamed("node", "query").withColumn("flag", F.lit(0))
        # The starts have no score of their own yet; they get it as somebody's neighbour.
        seen = state.where("expand").select("query", "near", F.lit(float("-inf")).cast("float").alias("sim"), F.lit(1).alias("flag"))
        state, left = _search_state(state.select("query", "near", "sim", "flag").unionByName(seen).unionByName(reached))
    return state


def approximate_top_k(vectors: DataFrame, queries: DataFrame, top: int = TOP, vec: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score): the nearest found of ``vectors`` for each row of ``queries``."""
    classes = stored(_classes(vectors, vec, embedding), "classes")
    codes = stored(_codes(classes), "codes")
    asked = queries.where(usable(embedding) & F.col(vec).isNotNull()).select(F.col(vec).cast("long").alias("query"), F.col(embedding).alias("v")).where(F.exists("v", lambda x: x != 0)).distinct()
    asked = stored(asked.join(classes.select("v", "node").distinct(), "v", "left").withColumn("key", F.col("query")), "asked")
    # Rows of one query id with different vectors search apart.
    asked = asked.withColumn("query", F.xxhash64("key", "v"))
    graph = build_graph(codes)
    found = search(graph, codes, asked.select("query", "node", "v")).select("query", F.col("near").alias("node"))
    found = found.unionByName(asked.where("node is not null").select("query", "node"))
    order = Window.partitionBy("node").orderBy("id")
    members = classes.select("node", "id", "v").distinct().withColumn("r", F.row_number().over(order)).where(F.col("r") <= top + 1)
    scored = (
        found.join(members.select("node", "id", F.col("v").alias("c")), "node")
        .join(asked.select("query", "key", "v"), "query").where("id <> key and size(v) = size(c)")
        .select(F.col("key").alias("query_id"), F.col("id").alias("vec_id"), _dot("v", "c").alias("score"))
        .repartition("query_id").groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    )
    ranks = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return scored.withColumn("rank", F.row_number().over(ranks)).where(F.col("rank") <= top).select("query_id", "rank", "vec_id", "score")


def op8_nearest(spark, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return approximate_top_k(vectors, vectors.where(F.col("vec_id") % QUERY_STEP == 0))
