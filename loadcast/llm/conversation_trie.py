"""Prefix trie of conversations: a node for each distinct beginning, with what sharing it saves.

1. A turn becomes a digest of role and text and its number of words; a conversation is the list of its
   turns' digests.  Equal conversations become one sequence with a count.
2. Sequences are sorted by range into shards.  A shard's trie is written as balanced parentheses
   (``parentheses``): findclose delimits subtrees, the rank of leaf pairs counts leaves, cumulative
   arrays over preorder give members, words and savings.
3. Neighbouring shards share the spine of the prefix that the last sequence of one and the first of
   the next have in common.  A shard owns the nodes that it opens first, and each figure is a sum
   over owned nodes, leaves or members, so spine nodes are merged by adding what their shards found.

A conversation is a row of 24 bytes a turn; a shard holds about ``SHARD_TURNS`` turns.  A much used first
turn is spread over shards like any other range, and copies of one conversation are counted before the
sort.  Their ids, which the digest of ends needs in order, are sorted by range and joined into
chunks, so that one task reads a few long chunks instead of the rows of a large group.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from loadcast.llm.parentheses import Minima, encode, findclose, parents
from loadcast.llm.words import WORD_SQL
from loadcast.session import materialise

SHARD_TURNS = 1 << 18
CHUNK_IDS = 1 << 16
HEAD_PARTS = 64
WIDTH = 16
GROUP = 20
NO_ENDS = hashlib.sha256(b"").hexdigest()

_CHUNKS = "class binary, first long, ids binary"
_ENDS = "class binary, ends string"
_NODES = (
    "conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, "
    "member_words long, own_words long, ends string, path binary, parent_path binary"
)


def rebuilt(conversations: DataFrame) -> DataFrame:
    """Conversations whose first turns come from the head of their group of 20.

    conv_id, sequence (16 bytes a turn) and the words of each turn.
    """
    role, text = (F.coalesce(F.col(c), F.lit("")) for c in ("role", "text"))
    told = F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text)
    turn = F.struct(
        F.col("turn"),
        F.unhex(F.substring(F.sha2(told.cast("binary"), 256), 1, 2 * WIDTH)).alias("digest"),
        F.regexp_count(text, F.expr(f"'{WORD_SQL}'")).cast("long").alias("words"),
    )
    own = conversations.where(F.col("conv_id").isNotNull()).select("conv_id", turn.alias("turn"))
    own = own.groupBy("conv_id").agg(F.sort_array(F.collect_list("turn")).alias("turns"))
    heads = own.where(F.col("conv_id") % GROUP == 0)
    heads = heads.select(F.col("conv_id").alias("base"), F.slice("turns", 1, 3).alias("head"))
    taken = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % 4).cast("int")
    joined = own.withColumns({"base": F.col("conv_id") - F.col("conv_id") % GROUP, "h": taken})
    joined = joined.join(heads, "base", "left")
    first = F.when(F.col("head").isNull(), F.slice("turns", 1, 0))
    first = first.otherwise(F.slice("head", F.lit(1), F.col("h")))
    rest = F.slice("turns", F.col("h") + 1, F.greatest(F.size("turns") - F.col("h"), F.lit(0)))
    joined = joined.select("conv_id", F.concat(first, rest).alias("turns"))
    digests = F.array_join(F.transform("turns", lambda t: F.hex(t["digest"])), "")
    return joined.select(
        "conv_id", F.unhex(digests).alias("key"), F.col("turns.words").alias("words")
    )


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Runs of one class (input in order) as its ids joined by commas."""
    group, ids = None, []

    def row() -> pa.RecordBatch:
        joined = ",".join(map(str, ids)).encode()
        columns = [pa.array([group], pa.binary()), pa.array([ids[0]]), pa.array([joined])]
        return pa.RecordBatch.from_arrays(columns, ["class", "first", "ids"])

    held: list[pa.RecordBatch] = []
    for arrived in batches:
        for key, conv in zip(arrived["class"].to_pylist(), arrived["conv_id"].to_pylist()):
            if ids and (key != group or len(ids) >= CHUNK_IDS):
                held.append(row())
                ids = []
                if len(held) >= 4096:
                    yield from pa.Table.from_batches(held).combine_chunks().to_batches()
                    held = []
            group = key
            ids.append(conv)
    if ids:
        held.append(row())
    if held:
        yield from pa.Table.from_batches(held).combine_chunks().to_batches()


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 of each class's ids from its chunks in order."""
    group, running = None, None
    for arrived in batches:
        classes, found = [], []
        for key, ids in zip(arrived["class"].to_pylist(), arrived["ids"].to_pylist()):
            if running is not None and key == group:
                running.update(b"," + ids)
                continue
            if running is not None:
                classes.append(group)
                found.append(running.hexdigest())
            group, running = key, hashlib.sha256(ids)
        columns = [pa.array(classes, pa.binary()), pa.array(found, pa.string())]
        yield pa.RecordBatch.from_arrays(columns, ["class", "ends"])
    if running is not None:
        columns = [pa.array([group], pa.binary()), pa.array([running.hexdigest()])]
        yield pa.RecordBatch.from_arrays(columns, ["class", "ends"])


def _common(a: bytes, b: bytes) -> int:
    """Turns that two sequences have in common from the start."""
    low, high = 0, min(len(a), len(b)) // WIDTH
    while low < high:
        middle = (low + high + 1) // 2
        if a[: middle * WIDTH] == b[: middle * WIDTH]:
            low = middle
        else:
            high = middle - 1
    return low


def _neighbours(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Turns that each shard shares with the one before and the one behind; -1 without one."""
    for arrived in batches:
        rows = arrived.to_pylist()
        left = [-1 if r["before"] is None else _common(r["before"], r["low"]) for r in rows]
        right = [-1 if r["behind"] is None else _common(r["high"], r["behind"]) for r in rows]
        columns = [arrived["shard"], pa.array(left, pa.int64()), pa.array(right, pa.int64())]
        yield pa.RecordBatch.from_arrays(columns, ["shard", "left", "right"])


def _paths(key: bytes, depth: int) -> list[bytes]:
    """Digest of each beginning of a sequence, from no turns to ``depth``."""
    running, out = hashlib.sha256(), []
    for k in range(depth + 1):
        out.append(running.digest())
        running.update(key[k * WIDTH : (k + 1) * WIDTH])
    return out


def _trie(group: pa.Table) -> pa.Table:
    """The nodes of a shard's trie; those on a shared spine with their path and what is found here."""
    group = group.sort_by("key").combine_chunks()
    keys = group["key"].to_pylist()
    copies = group["n"].to_numpy()
    left, right = group["left"][0].as_py(), group["right"][0].as_py()
    n = len(keys)
    lengths = np.fromiter((len(k) // WIDTH for k in keys), np.int64, n)
    common = np.zeros(n, np.int64)
    for k in range(1, n):
        common[k] = _common(keys[k - 1], keys[k])

    # Nodes in preorder: the root, then what each sequence adds to the one before.
    added = lengths - common
    last = np.cumsum(added)
    size = int(last[-1]) + 1
    sequence = np.r_[0, np.repeat(np.arange(n), added)]
    depth = np.arange(size) - last[sequence] + lengths[sequence]
    depth[0] = 0
    turn_words = group["words"].combine_chunks().flatten().to_numpy(zero_copy_only=False)
    starts = np.cumsum(lengths) - lengths
    sums = np.r_[0, np.cumsum(turn_words, dtype=np.int64)]
    above = sums[starts[sequence] + np.maximum(depth - 1, 0)] - sums[starts[sequence]]
    words = np.zeros(size, np.int64)
    words[1:] = turn_words[(starts[sequence] + depth - 1)[1:]]

    bits = encode(lengths, common)
    opening, close = np.flatnonzero(bits), findclose(bits)
    behind = np.cumsum(bits)[close]
    owned = np.arange(size) > left  # the first sequence's nodes come first
    leaf = ~bits[opening + 1]
    leaf[-1] &= right != lengths[-1]

    def under(values: np.ndarray) -> np.ndarray:
        total = np.r_[0, np.cumsum(values, dtype=np.int64)]
        return total[behind] - total[:size]

    ending = np.zeros(size, np.int64)
    ending[last] = copies
    all_words = np.zeros(size, np.int64)
    all_words[last] = copies * (sums[starts + lengths] - sums[starts])
    members = under(ending)
    member_words = under(all_words) - members * above
    own_words = under(words * owned)
    smallest = Minima(group["conv_id"].to_numpy())
    conv = smallest.of(sequence, np.searchsorted(last, behind))
    parent = parents(depth)
    children = np.bincount(parent[1:][owned[1:]], minlength=size)

    shared = (behind == size) & (depth <= right)
    shared[: left + 1] = True
    path = np.full(size, None, object)
    if left >= 0:
        path[: left + 1] = _paths(keys[0], left)
    if right >= 0:
        spine = np.flatnonzero((behind == size) & (depth <= right))
        path[spine] = np.array(_paths(keys[-1], right), object)[depth[spine]]
    ends = np.full(size, None, object)
    ends[last] = group["ends"].to_pylist()
    outer = np.r_[False, shared[parent[1:]]]
    outer_path = np.where(outer, path[np.maximum(parent, 0)], None)
    known = ~outer & (parent >= 0)
    columns = [
        pa.array(conv), pa.array(depth),
        pa.array(conv[np.maximum(parent, 0)], mask=~known),
        pa.array(members), pa.array(children.astype(np.int64)), pa.array(under(leaf)),
        pa.array(member_words), pa.array(own_words), pa.array(ends, pa.string()),
        pa.array(path, pa.binary()), pa.array(outer_path, pa.binary()),
    ]
    return pa.Table.from_arrays(columns, [c.split()[0] for c in _NODES.split(", ")])


def prefix_trie(conversations: DataFrame, shard_turns: int = SHARD_TURNS) -> DataFrame:
    """A row for each node of the trie of rebuilt conversations.

    Turns go by ``turn``, null first, ties by digest of role and text; null roles and texts are
    empty; rows without conv_id are left out.  Conversation c starts with the first h turns of
    conversation c - c % 20 (h: unsigned crc32 of the decimal c, modulo 4) and goes on with its own
    after its first h; it may have no turn and is then a member of the root alone.  Repeated rows are
    turns of their own.  Texts of any length count whole.  An empty table gives no rows.  Other
    columns are ignored.
    """
    name = F.unhex(F.substring(F.sha2("key", 256), 1, 2 * WIDTH)).alias("class")
    told = materialise(rebuilt(conversations).select(name, "*"), "trie-conversations")
    same = told.groupBy("class", "key", "words").agg(
        F.count(F.lit(1)).alias("n"), F.min("conv_id").alias("conv_id")
    )
    ids = told.select("class", "conv_id").repartitionByRange("class", "conv_id")
    ids = ids.sortWithinPartitions("class", "conv_id").mapInArrow(_chunks, _CHUNKS)
    ids = ids.repartition("class").sortWithinPartitions("class", "first")
    ends = ids.mapInArrow(_digests, _ENDS)

    turns = told.agg(F.sum(F.size("words") + 1)).first()[0] or 0
    shards = int(turns) // shard_turns + 1
    sorted_ = same.join(ends, "class").repartitionByRange(shards, "key")
    sorted_ = materialise(sorted_.withColumn("shard", F.spark_partition_id()), "trie-shards")
    bounds = sorted_.groupBy("shard").agg(F.min("key").alias("low"), F.max("key").alias("high"))
    along = Window.orderBy("shard")  # one row for each shard
    bounds = bounds.withColumns(
        {"before": F.lag("high").over(along), "behind": F.lead("low").over(along)}
    )
    bounds = bounds.mapInArrow(_neighbours, "shard int, left long, right long")

    def trie(group: pa.Table) -> pa.Table:
        return _trie(group)

    nodes = sorted_.join(bounds, "shard").groupBy("shard").applyInArrow(trie, _NODES)
    nodes = materialise(nodes, "trie-nodes")
    figures = ["n_convs", "n_children", "n_leaves", "member_words", "own_words"]
    spines = nodes.where("path IS NOT NULL").groupBy("path").agg(
        F.min("conv_id").alias("conv_id"), F.min("depth").alias("depth"),
        *[F.sum(c).alias(c) for c in figures],
        F.max("ends").alias("ends"), F.min("parent_path").alias("parent_path"),
    )
    spines = spines.withColumn("parent_conv_id", F.lit(None).cast("long"))
    columns = ["conv_id", "depth", "parent_conv_id", *figures, "ends", "parent_path"]
    whole = nodes.where("path IS NULL").select(columns).unionByName(spines.select(columns))
    # A node may have any number of children, so its few rows are repeated for parts of them.
    part = F.pmod(F.xxhash64("conv_id", "depth"), F.lit(HEAD_PARTS))
    parts = F.explode(F.expr(f"sequence(0L, {HEAD_PARTS - 1}L)")).alias("part")
    heads = spines.select(F.col("path").alias("parent_path"), F.col("conv_id").alias("head"), parts)
    below = whole.where("parent_path IS NOT NULL").withColumn("part", part)
    below = below.join(heads, ["parent_path", "part"])
    below = below.withColumn("parent_conv_id", F.col("head")).select(columns)
    whole = whole.where("parent_path IS NULL").unionByName(below)
    return whole.select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves",
        (F.col("member_words") - F.col("own_words")).alias("saved_tokens"),
        F.coalesce("ends", F.lit(NO_ENDS)).alias("ends_sha256"),
    )


TRIE_SQL = r"""
WITH told AS (
    SELECT conv_id AS c, turn, coalesce(role, '') AS role, coalesce(text, '') AS text
    FROM conversations WHERE conv_id IS NOT NULL),
own AS (
    SELECT c, len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')) AS words,
           sha256(strlen(role) || ':' || role || text) AS t,
           row_number() OVER (
               PARTITION BY c ORDER BY turn NULLS FIRST, sha256(strlen(role) || ':' || role || text)) AS k
    FROM told),
ids AS (
    SELECT c, c - c % 20 AS base,
           xor(4294967295, list_reduce(
               list_concat([4294967295::BIGINT], flatten(list_transform(
                   string_split(c::VARCHAR, ''),
                   lambda x: [ord(x)::BIGINT, 0, 0, 0, 0, 0, 0, 0]))),
               lambda a, x: xor(xor(a, x) >> 1, 3988292384 * (xor(a, x) & 1)))) % 4 AS h
    FROM (SELECT DISTINCT c FROM own)),
turns AS (
    SELECT i.c, row_number() OVER (PARTITION BY i.c ORDER BY own.c <> i.base OR own.k > h, own.k) AS d, t, words
    FROM ids i JOIN own ON (own.c = i.base AND own.k <= h) OR (own.c = i.c AND own.k > h)),
paths AS (
    SELECT c, d, words, list(t) OVER (PARTITION BY c ORDER BY d) AS path,
           max(d) OVER (PARTITION BY c) AS size
    FROM turns
    UNION ALL
    SELECT c, 0, 0, []::VARCHAR[], coalesce(size, 0)
    FROM ids LEFT JOIN (SELECT c, max(d) AS size FROM turns GROUP BY c) USING (c)),
members AS (SELECT *, min(c) OVER (PARTITION BY d, path) AS node FROM paths),
nodes AS (
    SELECT node, d, count(*) AS n, max(words) AS words,
           sha256(coalesce(string_agg(c::VARCHAR, ',' ORDER BY c) FILTER (WHERE size = d), '')) AS ends
    FROM members GROUP BY node, d),
linked AS (
    SELECT n.*, p.node AS parent FROM nodes n LEFT JOIN members p ON p.c = n.node AND p.d = n.d - 1),
childless AS (
    SELECT l.*, (SELECT count(*) FROM linked x WHERE x.parent = l.node AND x.d = l.d + 1) AS children
    FROM linked l)
SELECT u.node AS conv_id, u.d AS depth, any_value(u.parent) AS parent_conv_id,
       any_value(u.n) AS n_convs, any_value(u.children) AS n_children,
       count(*) FILTER (WHERE v.children = 0) AS n_leaves,
       sum((v.n - 1) * v.words)::BIGINT AS saved_tokens, any_value(u.ends) AS ends_sha256
FROM childless v
JOIN members m ON m.c = v.node AND m.d <= v.d
JOIN childless u ON u.node = m.node AND u.d = m.d
GROUP BY u.node, u.d
"""
