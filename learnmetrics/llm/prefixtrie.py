"""Conversation prefix trie as a node table behind minimal perfect hashes.

Every prefix of a conversation's turns is a node. A prefix's digest is the XOR of one hash per
turn, of its depth, role and text (two lanes of 64 bits name the node, a third one checks
them), so a parent's digest is the node's without its last turn.

1. Conversations are dealt to shards by a hash of their id. The distinct digests of a shard are
   enumerated with their number of conversations; over all shards that gives the node table.
2. Each shard assigns its digests the slots of a minimal perfect hash (levels of bit arrays:
   digests alone at their place of a level get it, the others go on to the next one). A look-up
   counts only if the digest kept at the slot is the one asked for. Counts are scattered into
   flat arrays by slot, and accumulated through the array of parents' slots from the deepest
   level up.
3. Sums of subtrees are sums over conversations, so those of the shards add up. What belongs to
   a distinct node once (its words, being childless) is counted in the shard that holds its
   smallest member.

No subtree is gathered: a first turn that a third of all conversations share is one row of each
shard. A conversation of very many turns is cut into segments of depth; a segment also holds
the nodes right above it, whose sums are handed on to the segment above. The ids that end at a
node are put together block by block of ids, and hashed as a stream.

Defined results
* rows with a null id take no part; null turns come first, equal turns are ordered by role, then
  by text; null role or text is empty, the same as an empty one; repeated rows are turns of
  their own;
* a conversation without turns left ends at the root; an empty table gives an empty table;
* very long texts are hashed and counted whole; other columns aren't read.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from learnmetrics.llm.common import mix64, stored, table

FAMILY, HEADS = 20, 4
#: Rows of a shard on average, depths in a segment of it, ids in a block of ends.
SHARD_ROWS, SEGMENT, ID_BLOCK = 1 << 17, 1 << 16, 1 << 12
#: Places of a level of the hash per digest still without a slot.
GAMMA = 2
WORDS = r"[^\x20\x09-\x0D]+"
KEY = ["x1", "x2"]
NO_ENDS = hashlib.sha256(b"").hexdigest()


class SlotTable:
    """A minimal perfect hash of distinct digests (pairs of 64-bit values)."""

    def __init__(self, x1: np.ndarray, x2: np.ndarray):
        self.keys = np.zeros((2, len(x1)), dtype=np.uint64)
        self.levels: list[tuple[np.ndarray, np.ndarray]] = []  # (taken bits, slots before each word of 64)
        left, used = np.stack((x1, x2)).astype(np.uint64), 0
        while left.shape[1]:
            if len(self.levels) == 256:
                raise ValueError("digests are not distinct")
            size = -(-GAMMA * left.shape[1] // 64) * 64
            at = self._place(left, len(self.levels), size)
            alone = np.bincount(at, minlength=size) == 1
            words = np.packbits(alone, bitorder="little").view(np.uint64)
            before = used + np.concatenate(([0], np.cumsum(np.bitwise_count(words), dtype=np.int64)))[:-1]
            self.levels.append((words, before))
            got = alone[at]
            self.keys[:, self._slot(words, before, at[got])] = left[:, got]
            used += int(got.sum())
            left = left[:, ~got]

    @staticmethod
    def _place(keys: np.ndarray, level: int, size: int) -> np.ndarray:
        return (mix64(keys[0] ^ mix64(keys[1], 101 + level), 51 + level) % np.uint64(size)).astype(np.int64)

    @staticmethod
    def _slot(words: np.ndarray, before: np.ndarray, at: np.ndarray) -> np.ndarray:
        below = words[at >> 6] & ((np.uint64(1) << (at & 63).astype(np.uint64)) - np.uint64(1))
        return before[at >> 6] + np.bitwise_count(below)

    def slots(self, x1: np.ndarray, x2: np.ndarray) -> np.ndarray:
        """Slot of every digest, -1 for digests that aren't in the table."""
        asked = np.stack((x1, x2)).astype(np.uint64)
        out = np.full(asked.shape[1], -1, dtype=np.int64)
        open_ = np.arange(asked.shape[1])
        for level, (words, before) in enumerate(self.levels):
            at = self._place(asked[:, open_], level, 64 * len(words))
            hit = (words[at >> 6] >> (at & 63).astype(np.uint64)) & np.uint64(1) == 1
            slot = self._slot(words, before, at[hit])
            same = (self.keys[:, slot] == asked[:, open_[hit]]).all(axis=0)
            out[open_[hit][same]] = slot[same]
            open_ = open_[~hit]
        return out


def accumulate(depth: np.ndarray, parent: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Sums over subtrees: ``values`` (kinds x slots) added up through ``parent`` slots (-1: none)
    from the deepest level up."""
    total = values.copy()
    order = np.argsort(-depth, kind="stable")
    cuts = np.flatnonzero(np.diff(depth[order])) + 1
    for level in np.split(order, cuts):
        level = level[parent[level] >= 0]
        for row in total:
            np.add.at(row, parent[level], row[level])
    return total


def _head_turns(conv: Column, heads: int) -> Column:
    return F.crc32(conv.cast("string").cast("binary")) % heads


def _numbered(turns: DataFrame, conv: str, turn: str, role: str, text: str) -> DataFrame:
    """(conv, pos, t1, t2, t3, words): every turn by its number in its conversation from 1, three
    hashes of role and text, words of the text."""
    empty = [F.coalesce(F.col(c).cast("string"), F.lit("")).alias(n) for c, n in ((role, "role"), (text, "text"))]
    rows = turns.where(F.col(conv).isNotNull()).select(F.col(conv).cast("long").alias("conv"), F.col(turn).alias("turn"), *empty)
    order = Window.partitionBy("conv").orderBy(F.col("turn").asc_nulls_first(), "role", "text")
    hashes = [F.xxhash64(F.lit(k), "role", "text").alias(f"t{k}") for k in (1, 2, 3)]
    words = F.regexp_count("text", F.lit(WORDS)).cast("long").alias("words")
    return rows.withColumn("pos", F.row_number().over(order).cast("long")).select("conv", "pos", *hashes, words)


def rebuilt_turns(numbered: DataFrame, family: int = FAMILY, heads: int = HEADS) -> DataFrame:
    """(conv, depth, t1, t2, t3, words, last): the turns of every rebuilt conversation, and a row of
    depth 0 for each. The first h turns come from the conversation its family begins with."""
    base, h = (F.col("conv") - F.col("conv") % family).alias("base"), _head_turns(F.col("conv"), heads).alias("h")
    sizes = numbered.groupBy("conv").agg(F.max("pos").alias("n")).select("conv", "n", base, h)
    first = numbered.where((F.col("conv") % family == 0) & (F.col("pos") < heads))
    given = first.groupBy(F.col("conv").alias("base")).agg(F.max("pos").alias("given"))
    sizes = sizes.join(given, "base", "left").withColumn("given", F.least("h", F.coalesce("given", F.lit(0))))
    sizes = stored(sizes.withColumn("depths", F.col("given") + F.greatest(F.lit(0), F.col("n") - F.col("h"))), "conversations")
    value = ["t1", "t2", "t3", "words"]
    taken = sizes.where("given > 0").join(first.withColumnRenamed("conv", "base"), "base").where("pos <= given")
    own = numbered.join(sizes, "conv").where("pos > h")
    zero = [F.lit(0).cast("long").alias(c) for c in ("depth", *value)]
    rows = (
        sizes.select("conv", *zero, "depths")
        .unionByName(taken.select("conv", F.col("pos").alias("depth"), *value, "depths"))
        .unionByName(own.select("conv", (F.col("given") + F.col("pos") - F.col("h")).alias("depth"), *value, "depths"))
    )
    return rows.withColumn("last", F.col("depth") == F.col("depths")).drop("depths")


def _prefixes(rows: DataFrame, shards: int, segment: int) -> DataFrame:
    """One row per conversation and depth: shard, segment, digest x1, x2, x3, the parent's p1, p2."""
    path = Window.partitionBy("conv").orderBy("depth").rowsBetween(Window.unboundedPreceding, 0)
    at = F.col("depth")
    turn = [F.when(at > 0, F.xxhash64(F.lit(k), at, f"t{k}")).otherwise(F.lit(0).cast("long")).alias(f"h{k}") for k in (1, 2, 3)]
    rows = rows.select("conv", "depth", "words", "last", *turn)
    rows = rows.withColumns({f"x{k}": F.bit_xor(f"h{k}").over(path) for k in (1, 2, 3)})
    return rows.select(
        F.pmod(F.xxhash64("conv"), F.lit(shards)).cast("int").alias("shard"), F.floor(at / segment).cast("int").alias("segment"),
        "conv", "depth", "words", "last", "x1", "x2", "x3",
        *[F.col(f"x{k}").bitwiseXOR(F.col(f"h{k}")).alias(f"p{k}") for k in (1, 2)],
    )


def _ends(prefixes: DataFrame, block: int) -> DataFrame:
    """(x1, x2, ends_sha256): hash of the ids that end at each node, in order, comma-joined.

    Ids are first put together block by block (a block has a bounded number of ids), then a
    node's blocks are read in order, one at a time."""
    blocks = (
        prefixes.where("last").select(*KEY, "conv", F.floor(F.col("conv") / block).alias("block"))
        .groupBy(*KEY, "block").agg(F.array_join(F.array_sort(F.collect_set("conv")).cast("array<string>"), ",").alias("ids"))
    )

    def run(batches):
        node, state = None, None
        for batch in batches:
            done = [[], [], []]
            for x1, x2, ids in zip(*(batch.column(c).to_pylist() for c in ("x1", "x2", "ids")), strict=True):
                if (x1, x2) != node:
                    if node is not None:
                        for column, value in zip(done, (*node, state.hexdigest()), strict=True):
                            column.append(value)
                    node, state = (x1, x2), hashlib.sha256(ids.encode())
                else:
                    state.update(b"," + ids.encode())
            yield pa.RecordBatch.from_arrays([pa.array(done[0], pa.int64()), pa.array(done[1], pa.int64()), pa.array(done[2], pa.string())], names=[*KEY, "ends"])
        if node is not None:
            yield pa.RecordBatch.from_pydict({"x1": [node[0]], "x2": [node[1]], "ends": [state.hexdigest()]})

    dealt = blocks.repartition(*KEY).sortWithinPartitions(*KEY, "block").select(*KEY, "ids")
    return dealt.mapInArrow(run, "x1 long, x2 long, ends string")


_SUMS = ["all_words", "own_words", "leaves"]


def _shard_sums(part: pd.DataFrame) -> pd.DataFrame:
    """Sums over the subtrees of one shard's nodes (of one segment), by slot."""
    x1, x2 = (part[c].to_numpy(np.int64).view(np.uint64) for c in KEY)
    slots = SlotTable(x1, x2)
    at = slots.slots(x1, x2)
    up = slots.slots(*(part[c].to_numpy(np.int64).view(np.uint64) for c in ("p1", "p2")))
    up[part["depth"].to_numpy() == 0] = -1

    def scattered(values: np.ndarray) -> np.ndarray:
        out = np.zeros(len(at), dtype=np.int64)
        out[at] = values
        return out

    words, mine = part["words"].to_numpy(np.int64), part["mine"].to_numpy(bool)
    own = [part["n"].to_numpy(np.int64) * words, words * mine, (mine & (part["n_children"].to_numpy() == 0)).astype(np.int64)]
    values = np.stack([scattered(v + part[f"below_{c}"].to_numpy(np.int64)) for v, c in zip(own, _SUMS, strict=True)])
    parent = scattered(up)
    total = accumulate(scattered(part["depth"].to_numpy(np.int64)), parent, values)[:, at]
    conv = scattered(part["conv"].to_numpy(np.int64))
    out = part[["shard", "segment", *KEY, "above", "depth"]].copy()
    for name, row in zip(_SUMS, total, strict=True):
        out[name] = row
    known = mine & (up >= 0)
    out["parent"] = pd.array(np.where(known, conv[np.maximum(up, 0)], 0), dtype="Int64")
    out.loc[~known, "parent"] = pd.NA
    return out


def prefix_trie(
    turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text",
    family: int = FAMILY, heads: int = HEADS, shard_rows: int = SHARD_ROWS, segment: int = SEGMENT, id_block: int = ID_BLOCK,
) -> DataFrame:
    """The node table: conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens,
    ends_sha256 of every node."""
    rows = stored(rebuilt_turns(stored(_numbered(turns, conv, turn, role, text), "turns"), family, heads), "rebuilt")
    measured = rows.agg(F.count("*").alias("rows"), F.max("depth").alias("deepest")).first()
    shards, segments = max(1, math.ceil(measured["rows"] / shard_rows)), (measured["deepest"] or 0) // segment + 1
    prefixes = stored(_prefixes(rows, shards, segment), "prefixes")

    # The nodes of every shard; those right above a segment are listed in it too, without counts.
    one = prefixes.select("shard", "segment", *KEY, "x3", "p1", "p2", "depth", "words", "conv", F.lit(1).alias("n"), F.lit(False).alias("above"))
    local = one.groupBy("shard", "segment", *KEY).agg(
        F.sum("n").alias("n"), F.min("conv").alias("conv"), *[F.min(c).alias(c) for c in ("x3", "p1", "p2", "depth", "words")],
        F.max("x3").alias("other_x3"), F.lit(False).alias("above"),
    )
    local = stored(local, "shards")
    same = F.assert_true(F.min("x3") == F.max("other_x3"), F.lit("two prefixes have one digest"))
    nodes = local.groupBy(*KEY).agg(
        F.sum("n").alias("n_convs"), F.min("conv").alias("conv_id"), *[F.min(c).alias(c) for c in ("p1", "p2", "depth")], same.alias("checked")
    )
    nodes = nodes.where(F.col("checked").isNull()).drop("checked")
    children = nodes.where("depth > 0").groupBy(F.col("p1").alias("x1"), F.col("p2").alias("x2")).agg(F.count("*").alias("n_children"))
    nodes = nodes.join(children, KEY, "left").withColumn("n_children", F.coalesce("n_children", F.lit(0).cast("long")))
    nodes = stored(nodes, "nodes")

    if segments > 1:
        top = local.where((F.col("segment") > 0) & (F.col("depth") % segment == 0))
        zero = F.lit(0).cast("long")
        above = top.select("shard", "segment", F.col("p1").alias("x1"), F.col("p2").alias("x2")).distinct().join(
            local.select("shard", *KEY, "conv", "x3", "p1", "p2", "depth", "words"), ["shard", *KEY]
        )
        local = local.unionByName(above.withColumns({"n": zero, "other_x3": F.col("x3"), "above": F.lit(True)}))
    known = local.join(nodes.select(*KEY, F.col("conv_id").alias("first"), "n_children"), KEY).select(
        "shard", "segment", *KEY, "p1", "p2", "depth", "n", "n_children", "above", F.col("first").alias("conv"),
        (~F.col("above") & (F.col("conv") == F.col("first"))).alias("mine"), F.when(F.col("above"), 0).otherwise(F.col("words")).alias("words"),
    )
    schema = f"shard int, segment int, x1 long, x2 long, above boolean, depth long, {', '.join(f'{c} long' for c in _SUMS)}, parent long"
    parts, below = [], None
    for k in range(segments - 1, -1, -1):  # nearly always one segment
        part = known.where(F.col("segment") == k)
        if below is None:
            part = part.withColumns({f"below_{c}": F.lit(0).cast("long") for c in _SUMS})
        else:
            part = part.join(below, ["shard", *KEY], "left").withColumns({f"below_{c}": F.coalesce(f"below_{c}", F.lit(0).cast("long")) for c in _SUMS})
        done = stored(part.groupBy("shard", "segment").applyInPandas(_shard_sums, schema), "sums")
        below = done.where("above").select("shard", *KEY, *[F.col(c).alias(f"below_{c}") for c in _SUMS])
        parts.append(done.where("not above"))
    sums = parts[0]
    for part in parts[1:]:
        sums = sums.unionByName(part)
    sums = sums.groupBy(*KEY).agg(*[F.sum(c).alias(c) for c in _SUMS], F.max("parent").alias("parent_conv_id"))
    return (
        nodes.join(sums, KEY).join(_ends(prefixes, id_block), KEY, "left")
        .select(
            "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", F.col("leaves").alias("n_leaves"),
            (F.col("all_words") - F.col("own_words")).alias("saved_tokens"), F.coalesce("ends", F.lit(NO_ENDS)).alias("ends_sha256"),
        )
    )


def op12_prefix_trie(spark, sf_dir: str) -> DataFrame:
    return prefix_trie(table(spark, sf_dir, "conversations"))


def _half_byte_crc(value: int) -> int:
    for _ in range(4):
        value = value >> 1 ^ (0xEDB88320 if value & 1 else 0)
    return value


#: CRC-32 of a list of bytes behind the start value, half a byte after the other.
_CRC = f"[{', '.join(str(_half_byte_crc(i)) for i in range(16))}]::BIGINT[]"
_HALF = f"xor((%s) >> 4, ({_CRC})[((%s) & 15) + 1])"
_BYTE = _HALF % ((_HALF % (("xor(a, b)",) * 2),) * 2)

OP12_SQL = rf"""
WITH base AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS pos
  FROM conversations WHERE conv_id IS NOT NULL
), convs AS (
  SELECT conv_id, xor(list_reduce([4294967295::BIGINT] || list_transform(string_split(conv_id::VARCHAR, ''), lambda c: ascii(c)::BIGINT),
                                  lambda a, b: {_BYTE}), 4294967295::BIGINT) % 4 AS h
  FROM (SELECT DISTINCT conv_id FROM base)
), turns AS (
  SELECT c.conv_id, 0 AS own, pos, role, text FROM convs c JOIN base b ON b.conv_id = c.conv_id - c.conv_id % 20 AND pos <= h
  UNION ALL
  SELECT conv_id, 1, pos, role, text FROM convs JOIN base USING (conv_id) WHERE pos > h
), paths AS (
  SELECT conv_id, list([role, text]) OVER w AS node, len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')) AS words,
         row_number() OVER w = count(*) OVER (PARTITION BY conv_id) AS last
  FROM turns WINDOW w AS (PARTITION BY conv_id ORDER BY own, pos ROWS UNBOUNDED PRECEDING)
  UNION ALL
  SELECT conv_id, []::VARCHAR[][], 0, conv_id NOT IN (SELECT conv_id FROM turns) FROM convs
), nodes AS (
  SELECT node, min(conv_id) AS conv_id, len(node) AS depth, node[1:len(node) - 1] AS parent, count(*) AS n_convs, any_value(words) AS words,
         sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (WHERE last), '')) AS ends_sha256
  FROM paths GROUP BY node
), children AS (
  SELECT parent AS node, count(*) AS n_children FROM nodes WHERE depth > 0 GROUP BY parent
), subtrees AS (
  SELECT p.node, sum((m.n_convs - 1) * m.words) AS saved_tokens, count(*) FILTER (WHERE c.node IS NULL) AS n_leaves
  FROM nodes m LEFT JOIN children c ON c.node = m.node JOIN paths p ON p.conv_id = m.conv_id AND len(p.node) <= m.depth
  GROUP BY p.node
)
SELECT n.conv_id::BIGINT AS conv_id, n.depth::BIGINT AS depth, CASE WHEN n.depth > 0 THEN u.conv_id END::BIGINT AS parent_conv_id,
       n.n_convs::BIGINT AS n_convs, coalesce(c.n_children, 0)::BIGINT AS n_children, s.n_leaves::BIGINT AS n_leaves,
       s.saved_tokens::BIGINT AS saved_tokens, n.ends_sha256
FROM nodes n JOIN subtrees s ON s.node = n.node LEFT JOIN children c ON c.node = n.node LEFT JOIN nodes u ON u.node = n.parent
"""
