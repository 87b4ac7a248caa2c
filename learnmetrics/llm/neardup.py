"""Near-duplicate grouping: SuperMinHash signatures, banding, exact verification, union-find.

1. A task turns every text into its set of word shingles, a fingerprint of the set and a
   SuperMinHash signature. Each shingle draws a random permutation of the signature's slots
   and puts level + random into the slot of its permutation at that level; levels are
   correlated, so slots fill evenly, and a document stops as soon as every slot is filled
   (lower levels always win).
2. Documents with equal sets become one node, the smallest id among them.
3. Bands of the signature give buckets. In a bucket, nodes are first compared with a pivot,
   not with each other, so that a group of thousands of copies costs a comparison each. Then
   the pairs that share a bucket and are still in different components are compared, unless
   exact bounds tell that they can't be similar: by the sizes of their sets, and by the
   shingles that stand in no other component. No pair that shares a bucket is lost.
4. Every compared pair is confirmed on the full shingle sets; components come from
   large-star / small-star joins. Nothing about documents reaches the driver.

At 40 bands of 4 rows a pair of similarity 0.75 misses every bucket with probability
(1 - 0.75^4)^40 = 2.5e-7, and less above.

Defined results
* null, empty or blank text: empty set, linked with nothing, kept;
* fewer than five words: the whole sequence is the one shingle;
* rows sharing a ``doc_id`` are one node with several sets; all of them get its component;
  null ids take no part: component null, kept;
* other input columns aren't read; an empty table gives an empty table.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from learnmetrics.llm.common import binary_array, mix64, offsets_of, spans, stored, table, text_slices
from learnmetrics.llm.shingles import shingle_sets

WIDTH = 5
SIMILARITY = 75  # per cent
BANDS = 40
BAND_ROWS = 4
#: Elements whose permutations a task holds at once.
ELEMENTS = 1 << 16
TEXT_SLICE = 2 << 20
#: 64-bit words of a set's bitmap, by which pairs are excluded before their sets are compared.
BITMAP = 16
#: Rounds that compare nodes with a pivot; then the pairs left between components are listed.
STAR_ROUNDS = 2

_UNSET = np.uint64(2**64 - 1)


def superminhash(values: np.ndarray, offsets: np.ndarray, slots: int, seed: int = 1) -> np.ndarray:
    """Signatures (rows x slots) of sets of 64-bit values; an empty set keeps the largest value.

    The level stands in the top 16 bits of a slot, the random rank in the lower 48.
    """
    sizes = np.diff(offsets)
    out = np.full((len(sizes), slots), _UNSET, dtype=np.uint64)
    flat = out.reshape(-1)
    row = np.flatnonzero(sizes)
    if not len(row):
        return out
    lengths = sizes[row]
    element = values[spans(offsets[:-1][row], lengths)]
    perm = None
    for level in range(slots):
        owner = np.repeat(row, lengths)
        draw = mix64(element, seed + 1 + level)
        rank = draw >> np.uint64(16)
        pick = level + (((draw & np.uint64(0xFFFF)) * np.uint64(slots - level)) >> np.uint64(16)).astype(np.int64)
        if perm is None:
            slot = pick
        else:
            at = np.arange(len(element))
            slot = perm[at, pick].astype(np.int64)
            perm[at, pick] = perm[:, level]
        np.minimum.at(flat, owner * slots + slot, (np.uint64(level) << np.uint64(48)) | rank)
        open_rows = (out[row] == _UNSET).any(axis=1)
        if not open_rows.any():
            break
        stay = np.repeat(open_rows, lengths)
        if perm is None:
            pick, element = pick[stay], element[stay]
            perm = np.tile(np.arange(slots, dtype=np.uint16), (len(element), 1))
            perm[np.arange(len(element)), pick] = 0
        elif not open_rows.all():
            element, perm = element[stay], perm[stay]
        row, lengths = row[open_rows], lengths[open_rows]
    return out


def _signatures(docs: DataFrame, width: int, bands: int, rows: int) -> DataFrame:
    """(doc, n, f1, f2, bands): set size, fingerprint of the set, bucket hashes."""

    def run(batches):
        for batch, texts in text_slices(batches, "text", TEXT_SLICE):
            sets, bounds = shingle_sets(texts, width)
            sizes = np.diff(bounds)
            prints = []
            for seed in (21, 22):
                total = np.concatenate(([np.uint64(0)], np.cumsum(mix64(sets, seed), dtype=np.uint64)))
                with np.errstate(over="ignore"):
                    prints.append((total[bounds[1:]] - total[bounds[:-1]]).astype(np.int64))
            hashes = np.zeros((len(sizes), bands), dtype=np.uint64)
            lo = 0
            while lo < len(sizes):
                hi = max(lo + 1, int(np.searchsorted(bounds, bounds[lo] + ELEMENTS, "right")) - 1)
                part = superminhash(sets[bounds[lo] : bounds[hi]], bounds[lo : hi + 1] - bounds[lo], bands * rows)
                value = np.broadcast_to(np.arange(bands, dtype=np.uint64), (hi - lo, bands))
                for j in range(rows):
                    value = mix64(value ^ part[:, j::rows], 31 + j)
                hashes[lo:hi] = value
                lo = hi
            used = np.where(sizes > 0, bands, 0)
            listed = pa.ListArray.from_arrays(
                pa.array(offsets_of(used).astype(np.int32)), pa.array(hashes[sizes > 0].reshape(-1).astype(np.int64))
            )
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sizes.astype(np.int64)), *map(pa.array, prints), listed],
                names=["doc", "n", "f1", "f2", "bands"],
            )

    schema = T.StructType(
        [T.StructField("doc", docs.schema["doc"].dataType), T.StructField("n", T.LongType()), T.StructField("f1", T.LongType()),
         T.StructField("f2", T.LongType()), T.StructField("bands", T.ArrayType(T.LongType()))]
    )
    return docs.mapInArrow(run, schema)


def _full_sets(docs: DataFrame, width: int) -> DataFrame:
    """(node, items, bits): the shingle set of each document as an array of hashes, and a bitmap
    of it with a bit for each hash."""

    def run(batches):
        for batch, texts in text_slices(batches, "text", TEXT_SLICE):
            sets, bounds = shingle_sets(texts, width)
            items = pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), pa.array(sets.astype(np.int64)))
            bits = np.zeros((len(texts), 64 * BITMAP), dtype=bool)
            bits[np.repeat(np.arange(len(texts)), np.diff(bounds)), (sets % np.uint64(64 * BITMAP)).astype(np.int64)] = True
            bits = pa.FixedSizeListArray.from_arrays(pa.array(np.packbits(bits, axis=1).reshape(-1).view(np.int64)), BITMAP)
            yield pa.RecordBatch.from_arrays([batch.column(0), items, bits.cast(pa.list_(pa.int64()))], names=["node", "items", "bits"])

    listed = T.ArrayType(T.LongType())
    schema = T.StructType([T.StructField("node", docs.schema["doc"].dataType), T.StructField("items", listed), T.StructField("bits", listed)])
    return docs.mapInArrow(run, schema)


def _verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose full sets are similar enough."""
    left = sets.select(F.col("node").alias("a"), F.col("items").alias("x"))
    right = sets.select(F.col("node").alias("b"), F.col("items").alias("y"))
    common = F.size(F.array_intersect("x", "y"))
    return (
        pairs.join(right, "b").join(left, "a")
        .withColumn("common", common)
        .where(100 * F.col("common") >= percent * (F.size("x") + F.size("y") - F.col("common")))
        .select("a", "b")
    )


def components(edges: DataFrame) -> DataFrame:
    """(node, comp) of every node of ``edges`` (a, b), comp the smallest node reachable.

    Alternates large-star and small-star until the edges are stars around their minima.
    Hot nodes are pre-aggregated to their minimum; a node's edges are never gathered.
    """
    stars = _stars(edges)
    return stars.unionByName(stars.select(F.col("comp").alias("node"), "comp")).distinct()


def _stars(edges: DataFrame) -> DataFrame:
    """:func:`components` without the rows of the components' smallest nodes; rows may repeat."""
    edges = edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        # A row for each edge, so repeated ones needn't go before the small stars are made.
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")
        large = stored(large, "large")
        # Done when no node has two parents and no parent has one itself.
        ends = large.select(F.col("u").alias("node"), F.col("v").alias("up"), F.lit(0).alias("parent")).unionByName(
            large.select(F.col("v").alias("node"), F.lit(None).cast(large.schema["v"].dataType).alias("up"), F.lit(1).alias("parent"))
        )
        ends = ends.groupBy("node").agg(F.min("up").alias("low"), F.max("up").alias("high"), F.max("parent").alias("parent"))
        if ends.where("low < high or (low is not null and parent = 1)").isEmpty():
            return large.select(F.col("u").alias("node"), F.col("v").alias("comp"))
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (
            large.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
            .unionByName(low.select("u", F.col("m").alias("v"))).where("u <> v").distinct()
        )
        edges = stored(small, "small")


def near_duplicates(
    docs: DataFrame,
    text: str = "text",
    doc: str = "doc_id",
    width: int = WIDTH,
    percent: int = SIMILARITY,
    bands: int = BANDS,
    band_rows: int = BAND_ROWS,
) -> DataFrame:
    """(doc, n_shingles, component_id, kept) for every row of ``docs``."""
    docs = docs.select(F.col(doc).alias("doc"), F.col(text).alias("text"))
    rows = stored(_signatures(docs, width, bands, band_rows), "signatures")
    classes = stored(
        rows.where("n > 0 and doc is not null").groupBy("n", "f1", "f2")
        .agg(F.min("doc").alias("node"), F.first("bands").alias("bands")),
        "classes",
    )
    placed = classes.select("node", "n", F.explode("bands").alias("bucket"))
    shared = placed.groupBy("bucket").agg(F.min("node").alias("low"), F.max("node").alias("high")).where("low < high")
    members = stored(placed.join(shared.select("bucket"), "bucket").select("bucket", "node", "n"), "members")
    sets = stored(_full_sets(docs.join(members.select(F.col("node").alias("doc")).distinct(), "doc", "left_semi"), width), "sets")

    found = _join_members(members, sets, percent)
    return (
        rows.join(classes.select("n", "f1", "f2", "node"), ["n", "f1", "f2"], "left")
        .join(found, "node", "left")
        .withColumn("comp", F.coalesce("comp", F.when(F.col("doc").isNotNull(), F.coalesce("node", "doc"))))
        .select(
            F.col("doc").alias(doc), F.col("n").alias("n_shingles"), F.col("comp").alias("component_id"),
            F.col("doc").eqNullSafe(F.col("comp")).alias("kept"),
        )
    )


def _join_members(members: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """(node, comp) of all nodes linked within buckets but the smallest of each component (see
    the module's text, step 3).

    ``members`` has bucket, node and n, the size of the node's set; ``able`` is how many of
    its shingles can be in common with others, n until that is known better. That is found
    once: components only grow and rows only go, so the bound holds in later rounds.
    """
    found, tested = members.where(F.lit(False)).select("node", F.col("node").alias("comp")), None
    members = members.withColumn("able", F.col("n")).withColumn("comp", F.col("node"))
    for turn in range(STAR_ROUNDS + 1):
        if turn:
            labelled = members.drop("comp").join(found.distinct(), "node", "left").withColumn("comp", F.coalesce("comp", "node"))
            members = stored(_apart(labelled), "apart")
        if turn == 1:
            members = stored(_apart(_reaching(_with_shared_items(members, sets), percent)), "sharing")
        pairs = _star(members, turn, percent) if turn < STAR_ROUNDS else _crossing(members, sets, percent)
        if turn < STAR_ROUNDS:
            pairs = stored(pairs if tested is None else pairs.join(tested, ["a", "b"], "left_anti"), "pairs")
            tested = pairs if tested is None else tested.unionByName(pairs)
        links = stored(_verified(pairs, sets, percent).distinct(), "links")
        if not links.isEmpty():
            found = _stars(links.unionByName(found.select(F.col("comp").alias("a"), F.col("node").alias("b"))))
    return found.distinct()


def _reaching(members: DataFrame, percent: int) -> DataFrame:
    """Rows that can reach the similarity with a set as large as the bucket's smallest."""
    least = members.groupBy("bucket").agg(F.min("n").alias("low"))
    best = F.greatest("low", "able")
    return members.join(least, "bucket").where(100 * F.col("able") >= percent * (F.col("n") + best - F.col("able"))).drop("low")


def _apart(members: DataFrame) -> DataFrame:
    """What is still to be compared: rows of buckets that hold two components."""
    two = members.groupBy("bucket").agg(F.min("comp").alias("low"), F.max("comp").alias("high")).where("low < high").select("bucket")
    return members.join(two, "bucket").select("bucket", "node", "n", "able", "comp")


def _with_shared_items(members: DataFrame, sets: DataFrame) -> DataFrame:
    """``members`` with ``able`` reduced to the shingles that also stand in another component
    still to be compared. The others can't be in common with any node a link is still needed
    to, so bounds from it are exact; in a group of copies they are each copy's own changes.
    A node of several rows keeps its bound: what is counted over all of them says little of one."""
    nodes = members.select("node", "comp").distinct()
    items = sets.join(nodes, "node").select("node", "comp", F.explode("items").alias("item"))
    own = items.groupBy("item").agg(F.min("comp").alias("low"), F.max("comp").alias("high")).where("low = high").select("item")
    alone = items.join(own, "item").groupBy("node").agg(F.count("*").alias("alone"))
    alone = alone.join(sets.groupBy("node").agg(F.count("*").alias("rows")).where("rows = 1").select("node"), "node")
    return members.join(alone, "node", "left").withColumn("able", F.col("n") - F.coalesce("alone", F.lit(0))).drop("alone")


def _can_reach(percent: int):
    """Sets of n and m shingles, of which able and able_b can be in common, can be similar enough."""
    return (100 + percent) * F.least("able", "able_b") >= percent * (F.col("n") + F.col("m"))


def _star(members: DataFrame, turn: int, percent: int) -> DataFrame:
    """Pairs (a, b) of each bucket's pivot and the nodes outside its component.

    The pivot is the smallest node at first, then another one each turn. In the first turn a
    node meets only the pivot it shares most buckets with: in a large group of copies most
    links come from that one comparison.
    """
    order = [F.xxhash64(F.lit(turn), "comp"), F.xxhash64(F.lit(turn), "node")] if turn else [F.lit(0), F.lit(0)]
    first = F.min(F.struct(order[0].alias("o"), F.col("comp"), order[1].alias("p"), "node", F.col("n").alias("m"), F.col("able").alias("able_b")))
    pivots = members.groupBy("bucket").agg(first.alias("p"))
    pivots = pivots.select("bucket", F.col("p.comp").alias("pivot_comp"), F.col("p.node").alias("pivot"), "p.m", "p.able_b")
    pairs = members.join(pivots, "bucket").where(F.col("comp") != F.col("pivot_comp")).where(_can_reach(percent))
    if turn == 0:
        pairs = pairs.groupBy("pivot", "node").agg(F.count("*").alias("votes"))
        pairs = pairs.groupBy("node").agg(F.max_by("pivot", F.struct("votes", "pivot")).alias("pivot"))
        return pairs.select(F.col("pivot").alias("a"), F.col("node").alias("b"))
    return pairs.select(F.least("pivot", "node").alias("a"), F.greatest("pivot", "node").alias("b")).distinct()


def _crossing(members: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """All pairs (a, b) of nodes in one bucket and in different components that can be similar
    enough.

    A bit of one set's bitmap that the other's lacks is a shingle that the other lacks, and
    different bits are different shingles: what is in common has an exact bound without the sets,
    the shared bits and the shingles beyond its bits of the set that has fewer of these. It is
    tried for every pair of a bucket, so it reads plain numbers and takes each one once: methods
    of more than 8,000 bytes of bytecode aren't compiled by the Java machine. Rows hold no more
    than it needs, a list of a node's buckets would be most of what is shuffled.
    """
    words = [F.coalesce(F.get("bits", F.lit(i)), F.lit(0)).alias(f"w{i}") for i in range(BITMAP)]
    # The words aren't named here: the optimizer would derive conditions from each mixture of names.
    held = F.aggregate("bits", F.lit(0), lambda total, word: total + F.bit_count(word))
    bits = sets.select("node", "bits").distinct().select("node", held.alias("held"), *words)
    members = members.join(bits, "node").withColumn("spare", F.col("n") - F.col("held")).drop("held")
    other = members.select(
        "bucket", F.col("node").alias("b"), F.col("n").alias("m"), F.col("able").alias("able_b"), F.col("comp").alias("comp_b"),
        F.col("spare").alias("spare_b"), *(F.col(f"w{i}").alias(f"v{i}") for i in range(BITMAP)),
    )
    pairs = members.withColumnRenamed("node", "a").join(other, "bucket").where("a < b and comp <> comp_b")
    shared = sum(F.bit_count(F.col(f"w{i}").bitwiseAND(F.col(f"v{i}"))) for i in range(BITMAP))
    able = (100 + percent) * (F.least("spare", "spare_b") + shared) >= percent * (F.col("n") + F.col("m"))
    return pairs.where(_can_reach(percent)).where(able).select("a", "b").distinct()


def op5_near_dedup(spark, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))


OP5_SQL = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
         'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w
  FROM documents
), shingles AS (
  SELECT DISTINCT doc_id, s FROM (
    SELECT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
           ELSE list_transform(generate_series(1, len(w) - 4), lambda i: array_to_string(w[i:i + 4], ' ')) END) AS s
    FROM words)
), sizes AS (
  SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id
), rare AS (
  SELECT s FROM shingles GROUP BY s HAVING count(*) > 1
), shared AS (
  SELECT * FROM shingles JOIN rare USING (s)
), common AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c
  FROM shared a JOIN shared b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY 1, 2
), links AS (
  SELECT a, b FROM common JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b
  WHERE 100 * c >= 75 * (x.n + y.n - c)
), pairs AS (
  SELECT a, b FROM links UNION ALL SELECT b, a FROM links
), reach AS (
  SELECT a, b FROM pairs UNION SELECT r.a, l.b FROM reach r JOIN pairs l ON r.b = l.a
), lowest AS (
  SELECT a AS doc_id, min(b) AS low FROM reach GROUP BY a
)
SELECT d.doc_id, coalesce(n, 0)::BIGINT AS n_shingles, least(d.doc_id, coalesce(low, d.doc_id))::BIGINT AS component_id,
       d.doc_id = least(d.doc_id, coalesce(low, d.doc_id)) AS kept
FROM documents d LEFT JOIN sizes USING (doc_id) LEFT JOIN lowest USING (doc_id)
"""
