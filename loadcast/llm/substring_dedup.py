"""Repeated passages: FM-index shards, matching statistics of streamed contexts.

A window is ``width`` consecutive words.  A word is removed when a window that covers it also
starts in a document with a smaller doc_id.  An index of the whole corpus in every task, or every
document against every shard, would grow with the square of the corpus, so shards follow content:

1. every window has an anchor, the ``GRAM`` words of least hash in it (all of equal least); the
   words of all windows that an anchor has are its *context*;
2. anchors that occur in one document only are dropped; equal contexts become one row with the
   smallest and largest doc_id (combined before the shuffle: copies cost nothing more);
3. the words of the remaining contexts are fetched from the smallest document; contexts of an
   anchor form a shard, and shards are indexed in chunks of bounded size;
4. the contexts are streamed through the chunk's index by backward search; intervals of
   ``width`` words are reported with the smallest doc_id among their occurrences;
5. every occurrence of a context takes the windows whose smallest doc_id is below its own.

An anchor with more than ``CROWD`` different contexts has no bounded shard.  Its contexts go to
finer shards by the anchor with 17 words before or after it (each window has the one or the
other).  Should such a shard be crowded again, its windows are grouped by their 128-bit hash
(exact as well, combined before the shuffle).
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loadcast.llm.fm_index import FmIndex
from loadcast.llm.words import hash_words, mix, split_words
from loadcast.session import materialise

GRAM = 16
CROWD = 256
CHUNK = 200_000  # words of an index chunk, beyond which the next anchor starts a new one

_BASE = np.uint64(0xD1342543DE82EF95)
_BACK = np.uint64(pow(0xD1342543DE82EF95, -1, 2**64))


def _powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[:1] = 1
    return np.cumprod(out, dtype=np.uint64)


class Runs:
    """Hashes of any run of words of one document in constant time."""

    def __init__(self, hashes: np.ndarray) -> None:
        n = len(hashes)
        self.back = _powers(_BACK, n + 1)
        self.sums = np.zeros(n + 1, np.uint64)
        np.cumsum(hashes * _powers(_BASE, n), out=self.sums[1:])

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        size = (end - start).astype(np.uint64)
        return mix((self.sums[end] - self.sums[start]) * self.back[start] + size)


def _slide(x: np.ndarray, width: int, best: np.ufunc) -> np.ndarray:
    """``best`` of every ``width`` neighbours, by doubling."""
    have = 1
    while have * 2 <= width:
        x = best(x[:-have], x[have:])
        have *= 2
    rest = width - have
    return best(x[:-rest], x[rest:]) if rest else x


def anchors(hashes: np.ndarray, width: int, gram: int = GRAM) -> tuple[np.ndarray, ...]:
    """``position, anchor hash, context hash, context start, end`` of a document's anchors."""
    n = len(hashes)
    if n < width:
        none = np.empty(0, np.int64)
        return none, none, none, none, none
    runs = Runs(hashes)
    at = np.arange(n - gram + 1)
    grams = runs.of(at, at + gram)
    reach = width - gram + 1
    least = _slide(grams, reach, np.minimum)
    pad = np.zeros(reach - 1, np.uint64)
    most = _slide(np.concatenate([pad, least, pad]), reach, np.maximum)
    where = np.flatnonzero(most == grams)
    # Windows with one least hash are a run; an anchor owns those of its run that hold it.
    head = np.flatnonzero(np.concatenate([[True], least[1:] != least[:-1]]))
    tail = np.append(head[1:], len(least)) - 1
    run = np.searchsorted(head, np.maximum(where - reach + 1, 0), "right") - 1
    while (other := least[head[run]] != grams[where]).any():
        run += other
    start = np.maximum(head[run], where - reach + 1)
    end = np.minimum(tail[run], where) + width
    context = mix(runs.of(start, end) ^ mix((where - start).astype(np.uint64)))
    return where, grams[where].view(np.int64), context.view(np.int64), start, end


def _anchor_rows(docs: DataFrame, width: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            ids, marks = (batch.column(k).to_pylist() for k in (0, 2))
            for doc, text, mark in zip(ids, batch.column(1), marks, strict=True):
                if doc is not None:
                    where, anchor, context, start, _ = anchors(
                        hash_words(split_words(text.as_py())), width
                    )
                    same = [np.full(len(where), x, np.int64) for x in (doc, mark)]
                    out.append([*same, start, anchor, context])
            columns = [np.concatenate([o[k] for o in out] or [[]]) for k in range(5)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c.astype(np.int64)) for c in columns],
                names=["doc_id", "mark", "start", "anchor", "context"],
            ).cast(pa.schema(kinds))

    kinds = [("doc_id", pa.int64()), ("mark", pa.int32()), ("start", pa.int32())]
    kinds += [("anchor", pa.int64()), ("context", pa.int64())]
    return _keyed(docs).mapInArrow(
        run, "doc_id long, mark int, start int, anchor long, context long"
    )


def _keyed(docs: DataFrame) -> DataFrame:
    """Rows that repeat a doc_id are told apart by a hash of their text."""
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), "text", F.hash("text").alias("mark")
    )


WANTED = (
    "anchor long, context long, crowd boolean, first long, last long, at int, words binary"
)


def _fetch(docs: DataFrame, wanted: DataFrame, width: int) -> DataFrame:
    """The words of every wanted context, from the document named with it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows: list[tuple] = []
            for first, text, asked in zip(*(batch.column(k) for k in range(3)), strict=True):
                need = {(x["anchor"], x["context"]): x for x in asked.as_py()}
                words = split_words(text.as_py())
                where, anchor, context, start, end = anchors(hash_words(words), width)
                for k in range(len(where)):
                    x = need.pop((int(anchor[k]), int(context[k])), None)
                    if x is not None:
                        rows.append(
                            (x["anchor"], x["context"], x["crowd"], first.as_py(), x["last"],
                             int(where[k] - start[k]), b" ".join(words[start[k] : end[k]]))
                        )
            kinds = [pa.int64(), pa.int64(), pa.bool_(), pa.int64(), pa.int64(), pa.int32()]
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[k] for r in rows], kind) for k, kind in enumerate([*kinds, pa.binary()])],
                names=["anchor", "context", "crowd", "first", "last", "at", "words"],
            )

    lists = wanted.groupBy(F.col("first").alias("doc_id")).agg(
        F.collect_list(F.struct("anchor", "context", "crowd", "last")).alias("asked")
    )
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return texts.join(lists, "doc_id").select("doc_id", "text", "asked").mapInArrow(run, WANTED)


LEAST = "anchor long, context long, least array<long>"


def _least_batch(rows: list[tuple[int, int, list[int]]]) -> pa.RecordBatch:
    kinds = [pa.int64(), pa.int64(), pa.list_(pa.int64())]
    return pa.RecordBatch.from_arrays(
        [pa.array([r[k] for r in rows], kind) for k, kind in enumerate(kinds)],
        names=["anchor", "context", "least"],
    )


def _search(contexts: DataFrame, width: int) -> DataFrame:
    """Smallest doc_id per window of each context, from the FM-index of the context's shard."""

    def solve(chunk: list[tuple]) -> list[tuple[int, int, list[int]]]:
        texts = [hash_words(words.split()) for *_, words in chunk]
        index = FmIndex(texts, width)
        first = np.array([c[3] for c in chunk], np.int64)
        owner = index.least_owner(first)
        length, low, _ = index.statistics(texts)
        at, out = 0, []
        for (_, anchor, context, _, last, _), text in zip(chunk, texts, strict=True):
            windows = slice(at, at + len(text) - width + 1)
            least = owner[index.class_of[low[windows]]]
            least = np.where(length[windows] >= width, least, last)
            if (least < last).any():
                out.append((anchor, context, least.tolist()))
            at += len(text)
        return out

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunk: list[tuple] = []
        words = 0
        for batch in batches:
            out = []
            for row in zip(*(batch.column(k).to_pylist() for k in range(6)), strict=True):
                if words >= CHUNK and row[0] != chunk[-1][0]:
                    out += solve(chunk)
                    chunk, words = [], 0
                chunk.append(row)
                words += row[5].count(b" ") + 1
            yield _least_batch(out)
        if chunk:
            yield _least_batch(solve(chunk))

    shards = contexts.select("shard", "anchor", "context", "first", "last", "words")
    shards = shards.repartition("shard").sortWithinPartitions("shard")
    return shards.mapInArrow(run, LEAST)


def _finer(contexts: DataFrame, width: int, crowd: int) -> DataFrame:
    """Contexts of crowded anchors by longer anchors; those in one document only are left out."""
    more = (width - GRAM + 1) // 2

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            row, shard, sides = [], [], []
            for k, (at, raw) in enumerate(
                zip(batch.column(4).to_pylist(), batch.column(5).to_pylist(), strict=True)
            ):
                runs, n = Runs(hash_words(raw.split())), raw.count(b" ") + 1
                for side, start in ((0, at - more), (1, at)):
                    end = start + more + GRAM
                    if start >= 0 and end <= n:
                        found = runs.of(np.array([start]), np.array([end]))
                        row.append(k)
                        sides.append(side)
                        shard.append(mix(found + np.uint64(side)).view(np.int64)[0])
            out = batch.take(pa.array(row, pa.int64()))
            out = out.append_column("shard", pa.array(shard, pa.int64()))
            yield out.append_column("side", pa.array(sides, pa.int32()))

    rows = contexts.select("anchor", "context", "first", "last", "at", "words").mapInArrow(
        run,
        "anchor long, context long, first long, last long, at int, words binary, shard long, side int",
    )
    rows = materialise(rows, "finer")
    shared = rows.groupBy("shard").agg(
        F.min("first").alias("lo"), F.max("last").alias("hi"), F.count(F.lit(1)).alias("n")
    )
    shared = shared.where("lo < hi").select("shard", (F.col("n") > crowd).alias("crowd"))
    return rows.join(shared, "shard")


def _crowded(contexts: DataFrame, width: int) -> DataFrame:
    """The same for anchors with very many contexts: windows grouped by hash."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts = []
            for anchor, context, first, last, place, side, raw in zip(
                *(batch.column(k).to_pylist() for k in range(7)), strict=True
            ):
                hashes = hash_words(raw.split())
                # The other windows of the context are in the shard of its other side.
                bound = max(0, place - (width - GRAM + 1) // 2 + 1)
                every = len(hashes) - width + 1
                at = np.arange(bound, every) if side else np.arange(min(bound, every))
                one = Runs(hashes).of(at, at + width).view(np.int64)
                two = Runs(mix(hashes)).of(at, at + width).view(np.int64)
                same = [np.full(len(at), x, np.int64) for x in (anchor, context, first, last)]
                parts.append([*same, at, one, two])
            columns = [np.concatenate([p[k] for p in parts] or [[]]) for k in range(7)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c.astype(np.int64)) for c in columns],
                names=["anchor", "context", "first", "last", "at", "one", "two"],
            )

    names = ["anchor", "context", "first", "last", "at", "side", "words"]
    rows = contexts.select(*names).mapInArrow(
        run, "anchor long, context long, first long, last long, at long, one long, two long"
    )
    # Written, so that the join below reads both sides afresh and AQE can split a hot window.
    rows = materialise(rows, "windows")
    least = rows.groupBy("one", "two").agg(F.min("first").alias("least"), F.count(F.lit(1)).alias("n"))
    least = materialise(least.where("n > 1").drop("n"), "windows")
    # A window of one context only has the smallest document of that context.
    found = rows.join(least, ["one", "two"], "left")
    found = found.withColumn("least", F.coalesce("least", "first"))
    found = found.groupBy("anchor", "context", "last")
    # A document that is repeated has given its contexts more than once.
    ordered = F.array_sort(F.collect_set(F.struct("at", "least")))
    found = found.agg(ordered.alias("found"))
    # Windows of a side that is not crowded are missing here: their place holds a NULL.
    places = F.sequence(F.lit(0), F.element_at("found", -1)["at"].cast("int"))
    known = F.map_from_entries("found")
    found = found.withColumn(
        "least", F.transform(places, lambda k: F.try_element_at(known, k.cast("long")))
    )
    return found.where(F.array_min("least") < F.col("last")).select("anchor", "context", "least")


def repeated_starts(docs: DataFrame, width: int = 50, crowd: int = CROWD) -> DataFrame:
    """``doc_id, mark, starts``: first words of windows that start in a smaller document as well.

    ``mark`` is the hash of the row's text.  Only documents with such windows have a row; ``starts`` may repeat a position.
    """
    marks = materialise(_anchor_rows(docs, width), "anchors")
    contexts = marks.groupBy("anchor", "context").agg(
        F.min("doc_id").alias("first"), F.max("doc_id").alias("last")
    )
    contexts = materialise(contexts, "contexts")
    shared = (
        contexts.groupBy("anchor")
        .agg(F.min("first").alias("lo"), F.max("last").alias("hi"), F.count(F.lit(1)).alias("n"))
        .where("lo < hi")
        .select("anchor", (F.col("n") > crowd).alias("crowd"))
    )
    words = materialise(_fetch(docs, contexts.join(shared, "anchor"), width), "words")
    finer = materialise(_finer(words.where("crowd"), width, crowd), "crowd")
    shards = words.where("NOT crowd").withColumn("shard", F.col("anchor"))
    shards = shards.unionByName(finer.where("NOT crowd"), allowMissingColumns=True)
    least = _search(shards, width).unionByName(_crowded(finer.where("crowd"), width))
    least = materialise(least, "least")
    known = F.filter(
        F.transform("least", lambda m, k: F.when(m < F.col("doc_id"), F.col("start") + k)),
        lambda x: x.isNotNull(),
    )
    hits = marks.join(least, ["anchor", "context"]).select("doc_id", "mark", known.alias("starts"))
    hits = hits.where(F.size("starts") > 0).groupBy("doc_id", "mark")
    return hits.agg(F.flatten(F.collect_list("starts")).alias("starts"))


def covered(n: int, starts: np.ndarray, width: int) -> np.ndarray:
    """Which of ``n`` words lie in a window that begins at one of ``starts``."""
    starts = starts[starts + width <= n]
    step = np.zeros(n + 1, np.int64)
    np.add.at(step, starts, 1)
    np.add.at(step, starts + width, -1)
    return np.cumsum(step)[:n] > 0


def without_repeats(docs: DataFrame, width: int = 50, crowd: int = CROWD) -> DataFrame:
    """``doc_id, n_words, n_removed, kept_sha256, kept`` for each row of ``docs(doc_id, text)``.

    ``kept`` is the text of the words left, joined by one space, ``kept_sha256`` its digest.
    Null and blank texts have no words.  A row without doc_id neither removes nor loses words.
    Rows that repeat a doc_id are judged against smaller doc_ids only.  Other columns are ignored;
    an empty table gives no rows.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n_words, n_removed, digest, kept = [], [], [], []
            for text, starts in zip(batch.column(1), batch.column(2), strict=True):
                words = split_words(text.as_py())
                n_words.append(len(words))
                if starts.is_valid:
                    at = np.unique(starts.values.to_numpy(zero_copy_only=False))
                    gone = covered(len(words), at, width)
                    words = [w for w, g in zip(words, gone.tolist(), strict=True) if not g]
                n_removed.append(n_words[-1] - len(words))
                left = b" ".join(words)
                digest.append(hashlib.sha256(left).hexdigest())
                kept.append(left)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()),
                 pa.array(digest, pa.string()), pa.array(kept, pa.binary()).cast(pa.string())],
                names=["doc_id", "n_words", "n_removed", "kept_sha256", "kept"],
            )

    joined = _keyed(docs).join(repeated_starts(docs, width, crowd), ["doc_id", "mark"], "left")
    return joined.select("doc_id", "text", "starts").mapInArrow(
        run, "doc_id long, n_words long, n_removed long, kept_sha256 string, kept string"
    )
