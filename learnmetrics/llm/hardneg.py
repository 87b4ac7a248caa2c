"""Hard-negative mining by a BOND scan of vertically stored vectors.

Vectors are turned into integers and stored block by block in vertical layout: one dimension
after the other, with the least and greatest value of each. An anchor reads the dimensions of
a block in the descending order of its own components' magnitudes. After every few dimensions
a candidate's score lies between its partial sum plus the least and plus the most that the
unread dimensions can add; candidates whose range can't matter leave the bitmap. Two scans:

1. positives: candidates of the anchor's label whose upper end is below the k-th best lower
   end of the block go; the best of all blocks are the anchor's positives.
2. negatives: with the positives' scores, the wanted windows of scores are known exactly as
   integers. Candidates of other labels whose range meets no window go, and so do those that,
   for every window they meet, stand below the n-th best candidate that is certain to lie in
   it. Those left are read to the end and ranked.

Blocks of anchors meet blocks of candidates in a keyed join, so no label or vector, however
frequent, fills a task: distinct rows are dealt by a hash of the whole row.

Defined results
* rows with a null id or label, a null or empty vector, or a null, NaN or infinite component
  take no part; vectors of different dimension are never compared;
* repeated rows count once; rows that share an id but differ in vector or label are rows of
  their own, but never positives or negatives of an anchor with that id;
* ties go to the smaller id; scores beyond 64 bits are set to the nearest 64-bit value;
* other columns aren't read; an empty table gives an empty table.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from learnmetrics.llm.common import stored, table
from learnmetrics.llm.topk import _exact_dot, usable

SCALE = 256
POSITIVES, NEGATIVES = 5, 10
#: The window of a negative's score, in hundredths of the positive's.
LOW, HIGH = 30, 90
#: Most rows in a block of candidates and of anchors, on average.
CANDIDATE_ROWS, ANCHOR_ROWS = 1 << 14, 1 << 12
#: Dimensions read between two rounds of pruning.
STEP = 8
#: Below this many candidates the rest of the dimensions is read at once.
FEW = 32


def _blocks(rows: DataFrame, count: int, name: str) -> DataFrame:
    """(block, dim, <name>_ids, <name>_labels, <name>_data): int64 ids and labels, components as
    float64, one dimension after the other."""

    def build(part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values(["id", "label"], kind="stable")
        columns = np.ascontiguousarray(np.floor(np.stack(part["v"].to_numpy()).astype(np.float64) * SCALE).T)
        return pd.DataFrame(
            {
                "block": [part["block"].iloc[0]], "dim": [part["dim"].iloc[0]], "ids": [part["id"].to_numpy(np.int64).tobytes()],
                "labels": [part["label"].to_numpy(np.int64).tobytes()], "data": [columns.tobytes()],
            }
        )

    dealt = rows.withColumns({"block": F.pmod(F.xxhash64("id", "label", "v"), F.lit(count)).cast("int"), "dim": F.size("v")})
    found = dealt.groupBy("block", "dim").applyInPandas(build, "block int, dim int, ids binary, labels binary, data binary")
    return found.withColumnsRenamed({c: f"{name}_{c}" for c in ("ids", "labels", "data")})


class Block:
    """Vertical candidates with what each dimension holds at least and at most."""

    def __init__(self, ids: np.ndarray, labels: np.ndarray, columns: np.ndarray):
        self.ids, self.labels, self.columns = ids, labels, columns
        self.least, self.most = columns.min(axis=1), columns.max(axis=1)
        self.largest = float(np.abs(columns).max(initial=0))

    def ranges(self, anchor: np.ndarray, alive: np.ndarray):
        """Yields (candidates, lower end, upper end, done) of their scores after every step; the
        receiver sends back which of them to go on with. The last ones are exact."""
        if self.largest * float(np.abs(anchor).max(initial=0)) * len(anchor) >= 2**52:
            exact = _exact_dot(self.columns[:, alive], anchor)
            yield alive, exact, exact, True
            return
        order = np.argsort(-np.abs(anchor), kind="stable")
        sized = anchor[order]
        ends = np.sort(np.stack((sized * self.least[order], sized * self.most[order])), axis=0)
        rest = np.zeros((2, len(order) + 1))
        rest[:, :-1] = np.cumsum(ends[:, ::-1], axis=1)[:, ::-1]
        total, read = np.zeros(len(alive)), 0
        while read < len(order):
            # Few candidates, or hardly anything left to read: no more rounds of pruning.
            stop = len(order) if len(alive) <= FEW else min(len(order), read + STEP)
            for d, x in zip(order[read:stop].tolist(), sized[read:stop].tolist(), strict=True):
                total += x * self.columns[d][alive]
            read = stop
            if read < len(order):
                stay = yield alive, total + rest[0, read], total + rest[1, read], False
                if not stay.all():
                    alive, total = alive[stay], total[stay]
        exact = total.astype(np.int64)
        yield alive, exact, exact, True


def _scan(block: Block, anchor: np.ndarray, alive: np.ndarray, stay_of) -> tuple[np.ndarray, np.ndarray]:
    """(candidates, exact scores) left when ``stay_of(low, high)`` has chosen after each step."""
    steps = block.ranges(anchor, alive)
    found, low, high, done = next(steps)
    while not done:
        found, low, high, done = steps.send(stay_of(low, high))
    return found, low


def _nth_best(values: np.ndarray, n: int):
    return np.partition(values, len(values) - n)[len(values) - n] if len(values) >= n else -np.inf


def _best(ids: np.ndarray, scores: np.ndarray, n: int) -> np.ndarray:
    """Places of the ``n`` best scores, ties to the smaller id."""
    if len(scores) > n:
        at = np.flatnonzero(scores >= _nth_best(scores, n))
        return at[np.lexsort((ids[at], -scores[at]))][:n]
    return np.lexsort((ids, -scores))


def positives_of(block: Block, anchor_id: int, label: int, anchor: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """(places, scores) of the block's best ``n`` rows of the anchor's label."""
    alive = np.flatnonzero((block.labels == label) & (block.ids != anchor_id))
    found, score = _scan(block, anchor, alive, lambda low, high: high >= _nth_best(low, n))
    best = _best(block.ids[found], score, n)
    return found[best], score[best]


def windows(scores: list[int], low: int = LOW, high: int = HIGH) -> list[tuple[int, int]]:
    """The integers between ``low`` and ``high`` hundredths of each score, ends included."""
    return [(-(-low * s // 100), high * s // 100) for s in scores]


def negatives_of(
    block: Block, anchor_id: int, label: int, anchor: np.ndarray, wanted: list[tuple[int, int]], n: int
) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each wanted window the (places, scores) of the block's first ``n`` rows of other labels."""
    alive = np.flatnonzero((block.labels != label) & (block.ids != anchor_id))
    real = sorted({w for w in wanted if w[0] <= w[1]})

    def stay_of(low: np.ndarray, high: np.ndarray) -> np.ndarray:
        stay = np.zeros(len(low), dtype=bool)
        for least, most in real:
            certain = low[(low >= least) & (high <= most)]
            stay |= (low <= most) & (high >= max(least, _nth_best(certain, n)))
        return stay

    none = np.zeros(0, np.int64)
    if not real or not len(alive):
        return [(none, none) for _ in wanted]
    found, score = _scan(block, anchor, alive, stay_of)
    out = {}
    for least, most in real:
        inside = np.flatnonzero((score >= least) & (score <= most))
        best = inside[_best(block.ids[found[inside]], score[inside], n)]
        out[least, most] = found[best], score[best]
    return [out.get(w, (none, none)) for w in wanted]


def _meeting(candidates: DataFrame, anchors: DataFrame, blocks: int) -> DataFrame:
    """Every block of candidates with every block of anchors of its dimension, by key. Never a
    broadcast: the size Spark knows of the anchors is that before there is one per block."""
    asked = anchors.drop("block").withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    return candidates.join(asked.hint("merge"), ["block", "dim"])


def _loaded(row: dict, name: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    ids = np.frombuffer(row[f"{name}_ids"], np.int64)
    return ids, np.frombuffer(row[f"{name}_labels"], np.int64), np.frombuffer(row[f"{name}_data"]).reshape(row["dim"], -1)


def _rows_of(batches, columns: list[str]):
    """One row (of binary blocks) after the other."""
    for batch in batches:
        for i in range(batch.num_rows):
            yield {c: batch.column(c)[i].as_py() for c in columns}


_BLOCK = ["dim", "c_ids", "c_labels", "c_data", "a_block", "a_ids", "a_labels", "a_data"]


def hard_negatives(
    vectors: DataFrame, anchors: DataFrame, positives: int = POSITIVES, negatives: int = NEGATIVES,
    low: int = LOW, high: int = HIGH, vec: str = "vec_id", embedding: str = "embedding", label: str = "label",
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score): for each row of
    ``anchors`` and each of its positives the first negatives of ``vectors``."""
    spark = vectors.sparkSession

    def distinct(df: DataFrame) -> DataFrame:
        there = usable(embedding) & F.col(vec).isNotNull() & F.col(label).isNotNull()
        rows = df.where(there).select(F.col(vec).cast("long").alias("id"), F.col(label).cast("long").alias("label"), F.col(embedding).alias("v"))
        return rows.groupBy("id", "label", "v").agg(F.lit(1).alias("one")).drop("one")

    base, asked = distinct(vectors), distinct(anchors)
    tasks = max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    rows, anchor_rows = base.count(), asked.count()
    blocks = max(1, math.ceil(rows / CANDIDATE_ROWS), min(2 * tasks, math.ceil(rows / 2048)))
    candidates = stored(_blocks(base, blocks, "c"), "candidates")
    asked_blocks = _blocks(asked, max(1, math.ceil(anchor_rows / ANCHOR_ROWS)), "a").withColumn("a_block", F.col("block"))
    asked_blocks = stored(asked_blocks, "anchors")
    meeting = _meeting(candidates, asked_blocks, blocks).select(*_BLOCK)
    long = T.LongType()

    def find_positives(batches):
        for row in _rows_of(batches, _BLOCK):
            block, (ids, labels, columns) = Block(*_loaded(row, "c")), _loaded(row, "a")
            found = [positives_of(block, int(ids[i]), int(labels[i]), columns[:, i], positives) for i in range(len(ids))]
            place = np.repeat(np.arange(len(ids)), [len(f) for f, _ in found])
            where, score = (np.concatenate([x[k] for x in found]).astype(np.int64) for k in (0, 1))
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(place), row["a_block"], dtype=np.int32)), pa.array(np.full(len(place), row["dim"], dtype=np.int32)),
                 *map(pa.array, (place, ids[place], block.ids[where], score))],
                names=["a_block", "dim", "place", "anchor_id", "positive_id", "positive_score"],
            )

    best = Window.partitionBy("a_block", "dim", "place").orderBy(F.desc("positive_score"), "positive_id")
    found = meeting.mapInArrow(find_positives, "a_block int, dim int, place long, anchor_id long, positive_id long, positive_score long")
    found = found.withColumn("r", F.row_number().over(best)).where(F.col("r") <= positives).drop("r")
    found = stored(found, "positives")

    # Each block of anchors gets the scores of its anchors' positives: at most so many a row.
    scores = found.groupBy("a_block", "dim").agg(
        F.array_sort(F.collect_list(F.struct("place", "positive_score", "positive_id"))).alias("wanted")
    )
    known = asked_blocks.join(scores, ["a_block", "dim"])

    def find_negatives(batches):
        for row in _rows_of(batches, [*_BLOCK, "places", "scores", "positives"]):
            block, (ids, labels, columns) = Block(*_loaded(row, "c")), _loaded(row, "a")
            place, score, positive = (np.array(row[c], dtype=np.int64) for c in ("places", "scores", "positives"))
            edge = np.flatnonzero(np.diff(place, prepend=-1, append=len(ids) + 1))
            out = [[], [], []]
            for a, b in zip(edge[:-1].tolist(), edge[1:].tolist(), strict=True):
                i = int(place[a])
                wanted = windows([int(s) for s in score[a:b]], low, high)
                for j, (where, got) in enumerate(negatives_of(block, int(ids[i]), int(labels[i]), columns[:, i], wanted, negatives)):
                    out[0].append(np.full(len(where), a + j))
                    out[1].append(block.ids[where])
                    out[2].append(got)
            if not out[0]:
                continue
            at, negative, got = (np.concatenate(x).astype(np.int64) for x in out)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(at), row["a_block"], dtype=np.int32)), pa.array(np.full(len(at), row["dim"], dtype=np.int32)),
                 *map(pa.array, (place[at], ids[place[at]], positive[at], score[at], negative, got))],
                names=["a_block", "dim", "place", "anchor_id", "positive_id", "positive_score", "negative_id", "negative_score"],
            )

    again = _meeting(candidates, known, blocks).select(
        *_BLOCK, F.col("wanted.place").alias("places"), F.col("wanted.positive_score").alias("scores"), F.col("wanted.positive_id").alias("positives")
    )
    kind = "a_block int, dim int, place long, anchor_id long, positive_id long, positive_score long, negative_id long, negative_score long"
    first = Window.partitionBy("a_block", "dim", "place", "positive_id", "positive_score").orderBy(F.desc("negative_score"), "negative_id")
    ranked = again.mapInArrow(find_negatives, kind).withColumn("rank", F.row_number().over(first)).where(F.col("rank") <= negatives)
    return ranked.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")


def op13_hard_negatives(spark, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    vectors = vectors.select("vec_id", "embedding", moved.alias("label"))
    return hard_negatives(vectors, vectors.where(F.col("vec_id") % 100 == 0))


OP13_SQL = """
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS e
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = len(embedding)
), scored AS (
  SELECT a.vec_id AS anchor_id, c.vec_id, a.label = c.label AS same, list_inner_product(a.e, c.e)::BIGINT AS score
  FROM v a JOIN v c ON a.vec_id <> c.vec_id WHERE a.vec_id % 100 = 0
), positive AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5
), negative AS (
  SELECT anchor_id, positive_id, vec_id AS negative_id, positive_score, score AS negative_score,
         row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id) AS n
  FROM positive JOIN scored USING (anchor_id)
  WHERE NOT same AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score
)
SELECT anchor_id, positive_id, n::INTEGER AS rank, negative_id, positive_score, negative_score FROM negative WHERE n <= 10
"""
