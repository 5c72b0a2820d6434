"""Near-duplicate documents: MinHash with tensored banding, links confirmed on full sets.

Two small collections of partial keys (``halves`` keys of ``rows`` MinHash values each) are
drawn per document.  A table key is one partial key of the left collection with one of the
right: ``halves ** 2`` tables from ``2 * halves * rows`` hash values instead of
``2 * halves ** 2 * rows``.  With 9 halves of 2 rows, a pair at similarity 0.85 meets in no
table with probability 7e-6 * 2; at 0.8, 1e-4 * 2 (12 halves: 5e-6 * 2).

Whole plan, no step of which holds an unbounded group in one task:

1. one row per document: hash of its shingle set, set size, the two collections (written);
2. documents with equal sets are one class, named by its smallest doc_id;
3. per table key the smallest class (combined before the shuffle) is the candidate partner of
   every other class in the bucket: stars, never all pairs;
4. components of the candidate stars are coarse clusters: a linked pair never spans two;
5. clusters are cut into tiles of bounded total set size, each pair of tiles is one work unit
   that finds the linked pairs on full sets by prefix filter, and returns a spanning forest;
6. components of the confirmed links.

A cluster whose classes are all alike is one component after few comparisons (members already
joined are skipped).  A cluster of k tiles costs k * (k + 1) / 2 units.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loadcast.llm.graph import components
from loadcast.llm.words import hash_words, mix, sequence_hashes, split_words
from loadcast.session import materialise

TILE = 1_500_000  # shingles per tile: 12 MB of hashes


def shingle_set(text: str | None, width: int) -> np.ndarray:
    """Sorted distinct hashes of the word sequences of a text, lower-cased A-Z."""
    return np.unique(sequence_hashes(hash_words(split_words(text, lower=True)), width))


def _multipliers(count: int) -> np.ndarray:
    return mix(np.arange(1, count + 1, dtype=np.uint64) << np.uint64(17)) | np.uint64(1)


def _collections(shingles: np.ndarray, halves: int, rows: int, odd: np.ndarray) -> np.ndarray:
    """``2 * halves`` partial keys; the shingle hashes are uniform, so a product permutes them."""
    low = np.empty(len(odd), np.uint64)
    work = np.empty_like(shingles)
    for k, factor in enumerate(odd):
        np.multiply(shingles, factor, out=work)
        low[k] = work.min()
    low = low.reshape(2 * halves, rows)
    keys = np.arange(2 * halves, dtype=np.uint64)
    for r in range(rows):
        keys = mix(keys * np.uint64(0x9E3779B97F4A7C15) + low[:, r])
    return keys


SIGNED = "doc_id long, n_shingles long, h1 long, h2 long, left array<long>, right array<long>"


def signatures(docs: DataFrame, width: int, halves: int, rows: int) -> DataFrame:
    """One narrow row per document; the only pass over all texts that hashes."""
    odd = _multipliers(2 * halves * rows)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = pa.schema(
            [(c, pa.int64()) for c in ("doc_id", "n_shingles", "h1", "h2")]
            + [(c, pa.list_(pa.int64())) for c in ("left", "right")]
        )
        for batch in batches:
            sizes, h1, h2, left, right = [], [], [], [], []
            for text in batch.column(1):
                s = shingle_set(text.as_py(), width)
                sizes.append(len(s))
                if len(s):
                    keys = _collections(s, halves, rows, odd).view(np.int64)
                    h1.append(int(np.bitwise_xor.reduce(mix(s)).view(np.int64)))
                    h2.append(int(mix(s ^ np.uint64(0xA5A5)).sum(dtype=np.uint64).view(np.int64)))
                    left.append(keys[:halves])
                    right.append(keys[halves:])
                else:
                    h1.append(None), h2.append(None), left.append(None), right.append(None)
            columns = [batch.column(0), pa.array(sizes, pa.int64()), pa.array(h1, pa.int64())]
            columns += [pa.array(h2, pa.int64())]
            columns += [pa.array(x, pa.list_(pa.int64())) for x in (left, right)]
            yield pa.RecordBatch.from_arrays(columns, schema=kinds)

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, SIGNED)


def _table_rows(classes: DataFrame) -> DataFrame:
    """One row per class and table.

    The rows grow here by the number of tables, so the few files of the narrow input are dealt
    to as many tasks as any shuffle first.
    """
    tasks = int(classes.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    classes = classes.repartition(tasks, "doc_id")
    keys = F.flatten(
        F.transform(
            "left",
            lambda x, i: F.transform("right", lambda y, j: F.xxhash64(i, j, x, y)),
        )
    )
    return classes.select(F.col("doc_id").alias("node"), F.explode(keys).alias("key"))


def _candidates(classes: DataFrame) -> DataFrame:
    """Stars: every class of a bucket with the bucket's smallest class."""
    rows = _table_rows(classes)
    leads = (
        rows.groupBy("key")
        .agg(F.min("node").alias("lead"), F.max("node").alias("last"))
        .where("lead < last")
        .select("key", "lead")
    )
    stars = rows.join(leads, "key").where("node != lead")
    return stars.select(F.col("lead").alias("a"), F.col("node").alias("b")).distinct()


class _Forest:
    def __init__(self, n: int) -> None:
        self.up = np.arange(n)

    def root(self, x: int) -> int:
        while self.up[x] != x:
            self.up[x] = self.up[self.up[x]]
            x = self.up[x]
        return x

    def roots(self, xs: np.ndarray) -> np.ndarray:
        r = self.up[xs]
        while True:
            s = self.up[r]
            if np.array_equal(r, s):
                self.up[xs] = r
                return r
            r = s


def linked_pairs(
    sets: list[np.ndarray], sides: np.ndarray, percent: int
) -> list[tuple[int, int]]:
    """A spanning forest of the pairs with ``100 * both >= percent * either``.

    Exact prefix filter: tokens are ordered from rare to frequent; two sets that are linked
    share a token among the first ``n - ceil(percent * n / 100) + 1`` of each.  ``sides`` is 0 or
    1 for the two tiles of a unit; pairs inside one tile are the work of that tile's own unit,
    where all sides are 0.
    """
    n = len(sets)
    size = np.array([len(s) for s in sets])
    start = np.concatenate([[0], np.cumsum(size)])
    _, code, count = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    rank = np.empty(len(count), np.int64)
    rank[np.argsort(count, kind="stable")] = np.arange(len(count))
    code = rank[code]
    rare = count.size - np.count_nonzero(count > 1)  # tokens below this rank occur once
    for k in range(n):
        code[start[k] : start[k + 1]].sort()
    two = bool(sides.any())
    order = np.argsort(size, kind="stable")
    forest, found = _Forest(n), []
    postings: tuple[dict[int, list[int]], ...] = ({}, {})
    mark = np.zeros(len(count), bool)
    for x in order:
        own = code[start[x] : start[x + 1]]
        prefix = own[: len(own) - -(-percent * len(own) // 100) + 1]
        prefix = prefix[prefix >= rare].tolist()
        other = postings[1 - sides[x]] if two else postings[0]
        near = [y for token in prefix for y in other.get(token, ())]
        for token in prefix:
            postings[sides[x] if two else 0].setdefault(token, []).append(x)
        if not near:
            continue
        ys = np.unique(np.array(near))
        ys = ys[100 * size[ys] >= percent * size[x]]
        ys = ys[forest.roots(ys) != forest.root(x)]
        if len(ys):
            mark[own] = True
        step = 4
        while len(ys):
            # One of each component first: what it joins need not be compared.
            _, first = np.unique(forest.roots(ys), return_index=True)
            head = first[:step] if len(first) < len(ys) else np.arange(min(step, len(ys)))
            step *= 4
            group = ys[head]
            ys = np.delete(ys, head)
            both = np.array([np.count_nonzero(mark[code[start[y] : start[y + 1]]]) for y in group])
            either = size[group] + size[x] - both
            for y in group[100 * both >= percent * either]:
                r, s = forest.root(x), forest.root(y)
                if r != s:
                    forest.up[max(r, s)] = min(r, s)
                    found.append((int(x), int(y)))
            if len(ys):
                ys = ys[forest.roots(ys) != forest.root(x)]
        mark[own] = False
    return found


def _with_sets(docs: DataFrame, members: DataFrame, width: int) -> DataFrame:
    """The full sets of the classes in a cluster, as bytes of sorted 64-bit hashes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [shingle_set(t.as_py(), width).tobytes() for t in batch.column(2)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), batch.column(3), pa.array(sets, pa.binary())],
                names=["doc_id", "cluster", "tiles", "shingles"],
            )

    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    joined = texts.join(members, "doc_id").select("doc_id", "cluster", "text", "tiles")
    return joined.mapInArrow(run, "doc_id long, cluster long, tiles long, shingles binary")


def _confirm(sets: DataFrame, percent: int) -> DataFrame:
    """Linked pairs ``a``, ``b`` of every unit: a spanning forest each."""

    def solve(rows: list[tuple[int, int, bytes]], two: bool) -> list[tuple[int, int]]:
        if len(rows) < 2:
            return []
        sides = np.array([side for _, side, _ in rows]) if two else np.zeros(len(rows), int)
        sets = [np.frombuffer(raw, np.uint64) for _, _, raw in rows]
        return [(rows[x][0], rows[y][0]) for x, y in linked_pairs(sets, sides, percent)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unit, rows = None, []

        def out(pairs: list[tuple[int, int]]) -> pa.RecordBatch:
            columns = [pa.array([p[k] for p in pairs], pa.int64()) for k in (0, 1)]
            return pa.RecordBatch.from_arrays(columns, names=["a", "b"])

        for batch in batches:
            pairs: list[tuple[int, int]] = []
            cluster, one, two, tile, doc, raw = (batch.column(k) for k in range(6))
            for k in range(batch.num_rows):
                key = (cluster[k].as_py(), one[k].as_py(), two[k].as_py())
                if key != unit:
                    if unit:
                        pairs += solve(rows, unit[1] != unit[2])
                    unit, rows = key, []
                rows.append((doc[k].as_py(), int(tile[k].as_py() != key[1]), raw[k].as_py()))
            yield out(pairs)
        if unit:
            yield out(solve(rows, unit[1] != unit[2]))

    tile = F.pmod(F.xxhash64("doc_id", F.lit(5)), F.col("tiles"))
    others = F.sequence(F.lit(0).cast("long"), F.col("tiles") - 1)
    units = (
        sets.withColumn("tile", tile)
        .withColumn("other", F.explode(others))
        .select(
            "cluster",
            F.least("tile", "other").alias("one"),
            F.greatest("tile", "other").alias("two"),
            "tile",
            "doc_id",
            "shingles",
        )
        .repartition("cluster", "one", "two")
        .sortWithinPartitions("cluster", "one", "two")
    )
    return units.mapInArrow(run, "a long, b long")


def near_duplicates(
    docs: DataFrame, width: int = 5, percent: int = 80, halves: int = 12, rows: int = 2
) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` for every row of ``docs(doc_id, text)``.

    Documents whose shingle sets meet ``100 * both >= percent * either`` are linked;
    ``component_id`` is the smallest doc_id reachable and ``kept`` marks that document.
    Null or blank texts have no shingles and are linked with nothing.  Rows that repeat a doc_id
    are one node.  A row without doc_id is in no component (``component_id`` null) and kept.
    Other columns are ignored; an empty table gives no rows.
    """
    signed = materialise(signatures(docs, width, halves, rows), "signed")
    same = ["h1", "h2", "n_shingles"]
    nodes = signed.where("n_shingles > 0 AND doc_id IS NOT NULL")
    # The collections follow from the set, so any of equal rows will do.
    classes = materialise(
        nodes.groupBy(*same).agg(
            F.min("doc_id").alias("doc_id"),
            F.first("left").alias("left"),
            F.first("right").alias("right"),
        ),
        "classes",
    )
    coarse = components(_candidates(classes))
    clusters = coarse.join(classes.select(F.col("doc_id").alias("node"), "n_shingles"), "node")
    weight = clusters.groupBy("root").agg(F.sum("n_shingles").alias("weight"))
    tiles = F.ceil(F.col("weight") / F.lit(TILE)).cast("long").alias("tiles")
    members = coarse.join(weight.select("root", tiles), "root").select(
        F.col("node").alias("doc_id"), F.col("root").alias("cluster"), "tiles"
    )
    links = _confirm(_with_sets(docs, members, width), percent)
    # Rows of one doc_id may have different sets: they are one node all the same.
    lead = classes.select(*same, F.col("doc_id").alias("lead"))
    owned = nodes.select("doc_id", *same).join(lead, same).select("doc_id", "lead")
    same_id = owned.join(_repeated(owned), "doc_id").select(
        F.col("doc_id").alias("a"), F.col("lead").alias("b")
    )
    found = components(links.unionByName(same_id))
    rooted = lead.join(found.withColumnRenamed("node", "lead"), "lead", "left").select(
        *same, F.coalesce("root", "lead").alias("root")
    )
    out = signed.select("doc_id", *same).join(rooted, same, "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("root", "doc_id"))
    return out.select("doc_id", "n_shingles", component.alias("component_id")).withColumn(
        "kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True))
    )


def _repeated(owned: DataFrame) -> DataFrame:
    """doc_ids that occur with more than one set."""
    several = owned.groupBy("doc_id").agg(F.min("lead").alias("x"), F.max("lead").alias("y"))
    return several.where("x < y").select("doc_id")
