"""Phrase collocations by counting quotient filters over packed word ids.

1. Texts are encoded in batches of about ``batch_words`` words of one language: a dictionary of the
   batch and its words as numbers in it, with 0 between pieces.  The batch is written once.
2. The dictionaries give the word counts.  Words of fewer than ``least`` occurrences can't be in a
   phrase that has as many; the others get ids, and a join on the word brings the ids to each batch.
   No vocabulary is sent to all tasks.
3. Each task counts n-grams of ids in quotient filters, one for each shard of scrambled keys, and a
   shard's filters are merged by one task.  A frequent n-gram is one entry per task, and
   scrambling spreads n-grams evenly, so no shard is hot.  The number of shards follows the words.
4. Candidates (``least`` occurrences) are scored, compared with longer ones and ranked as DataFrames.

Memory of a task: a batch with its dictionary, ``pending`` counters, and a shard of about
``shard_words`` counters.  A text is cut at separators into slices of about ``slice_bytes`` bytes; a piece
longer than that is taken whole.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from loadcast.llm.quotient_filter import Layout, combine, merge, pack
from loadcast.session import materialise


class Sizes(NamedTuple):
    """How finely the work is cut; the rows don't depend on it."""

    batch_words: int = 1 << 21
    shard_words: int = 1 << 21
    pending: int = 1 << 22
    slice_bytes: int = 1 << 20
    bucket_words: int = 4_096
    id_bits: int = 1  # at least



_ENCODED = "batch string, lang string, size long, words array<string>, counts array<long>, ids binary"
_FILTERS = "width int, shard long, filter binary"
_COUNTED = "width int, w1 long, w2 long, w3 long, a long"
_ENDS = b".,;:!?\n\x0b\x0c\r"
_UPPER = bytes(range(ord("A"), ord("Z") + 1))
_FOLD = bytes.maketrans(_ENDS + b"\t" + _UPPER, b"\n" * len(_ENDS) + b" " + _UPPER.lower())


class _Numbers(dict):
    """Number of each word in order of arrival; 0 ends a piece, 1 is the empty word."""

    def __init__(self) -> None:
        super().__init__({b"\n": 0, b"": 1})

    def __missing__(self, word: bytes) -> int:
        number = self[word] = len(self)
        return number


class _Batch:
    def __init__(self) -> None:
        self.numbers, self.parts, self.size = _Numbers(), [], 0

    def add(self, text: bytes, slice_bytes: int) -> None:
        folded, start = text.translate(_FOLD), 0
        while start < len(folded):
            stop = len(folded)
            if stop - start > slice_bytes:
                cut = folded.rfind(b"\n", start, start + slice_bytes)
                cut = cut if cut >= 0 else folded.find(b"\n", start + slice_bytes)
                stop = cut + 1 if cut >= 0 else stop
            words = folded[start:stop].replace(b"\n", b" \n ").split(b" ")
            ids = np.fromiter(map(self.numbers.__getitem__, words), np.uint32, len(words))
            ids = ids[ids != 1]
            self.size += int(np.count_nonzero(ids))
            self.parts.append(ids)
            start = stop
        self.parts.append(np.zeros(1, np.uint32))

    def row(self, batch: str, lang: str) -> dict:
        ids = np.concatenate(self.parts)
        counts = np.bincount(ids, minlength=len(self.numbers))[2:]
        words = pa.array(list(self.numbers)[2:], pa.binary()).cast(pa.string())
        kind = "<u2" if len(self.numbers) <= 1 << 16 else "<u4"
        return {
            "batch": batch, "lang": lang, "size": self.size, "words": words,
            "counts": counts, "ids": ids.astype(kind).tobytes(),
        }


def _encode(batches: Iterator[pa.RecordBatch], sizes: Sizes) -> Iterator[pa.RecordBatch]:
    task, made, open_ = TaskContext.get().partitionId(), 0, {}

    def rows() -> Iterator[pa.RecordBatch]:
        nonlocal made
        for lang, batch in open_.items():
            made += 1
            row = batch.row(f"{task}-{made}", lang)
            lists = [
                pa.ListArray.from_arrays(pa.array([0, len(x)], pa.int32()), pa.array(x))
                for x in (row["words"], row["counts"])
            ]
            single = [pa.array([row[c]]) for c in ("batch", "lang", "size")]
            columns = [*single, *lists, pa.array([row["ids"]], pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, list(row))
        open_.clear()

    held = 0
    for arrived in batches:
        for lang, text in zip(arrived["lang"].to_pylist(), arrived["text"].to_pylist()):
            batch = open_.setdefault(lang, _Batch())
            before = batch.size
            batch.add(text or b"", sizes.slice_bytes)
            held += batch.size - before
            if held >= sizes.batch_words:
                held = 0
                yield from rows()
    yield from rows()


def _count(
    batches: Iterator[pa.RecordBatch], bits: int, shard_bits: int, width: int, limit: int
) -> Iterator[pa.RecordBatch]:
    """Filters of the n-grams of word ids, a row for each shard."""
    layouts = {w: Layout(w, bits, shard_bits) for w in range(2, width + 1)}
    pending: dict[int, dict[str, list]] = {w: {"keys": [], "counts": [], "n": 0} for w in layouts}

    def settle(w: int, last: bool) -> Iterator[pa.RecordBatch]:
        """Combine what is pending; hand it on if it stays large or nothing follows."""
        held, layout = pending[w], layouts[w]
        if not held["keys"]:
            return
        wide = layout.shard_bits + layout.key_bits > 64
        keys, counts = np.concatenate(held["keys"]), np.concatenate(held["counts"])
        if wide:
            rank = np.lexsort((keys["key"], keys["shard"]))
            keys, counts = keys[rank], counts[rank]
            first = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
            keys, counts = keys[first], np.add.reduceat(counts, first)
        else:
            keys, counts = combine(keys, counts)
        if not last and len(keys) < limit // 2:
            held.update(keys=[keys], counts=[counts], n=len(keys))
            return
        held.update(keys=[], counts=[], n=0)
        if wide:
            shard, inner = keys["shard"], keys["key"]
        elif layout.key_bits == 64:
            shard, inner = np.zeros(len(keys), np.uint64), keys
        else:
            shard = keys >> np.uint64(layout.key_bits)
            inner = keys & np.uint64((1 << layout.key_bits) - 1)
        starts = np.flatnonzero(np.r_[True, shard[1:] != shard[:-1]])
        for low, high in zip(starts, np.r_[starts[1:], len(keys)]):
            data = pack(inner[low:high], counts[low:high], layout.key_bits)
            columns = [pa.array([w], pa.int32()), pa.array([int(shard[low])]), pa.array([data])]
            yield pa.RecordBatch.from_arrays(columns, ["width", "shard", "filter"])

    for arrived in batches:
        for row in arrived.to_pylist():
            kind = "<u2" if row["n_words"] + 2 <= 1 << 16 else "<u4"
            known = np.zeros(row["n_words"] + 2, np.uint64)
            known[np.array(row["local"], np.int64) + 2] = np.array(row["id"], np.uint64)
            ids = known[np.frombuffer(row["ids"], kind)]
            for w, layout in layouts.items():
                places = [ids[k : len(ids) - w + 1 + k] for k in range(w)]
                whole = np.flatnonzero(np.logical_and.reduce([p > 0 for p in places]))
                if not len(whole):
                    continue
                shard, key = layout.scramble([p[whole] for p in places])
                if layout.shard_bits + layout.key_bits > 64:
                    keys = np.empty(len(key), [("shard", np.uint64), ("key", np.uint64)])
                    keys["shard"], keys["key"] = shard, key
                    counts = np.ones(len(keys), np.int64)
                else:
                    if layout.key_bits < 64:
                        key = (shard << np.uint64(layout.key_bits)) | key
                    key.sort()
                    first = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
                    keys, counts = key[first], np.diff(np.r_[first, len(key)])
                held = pending[w]
                held["keys"].append(keys)
                held["counts"].append(counts)
                held["n"] += len(keys)
                if held["n"] >= limit:
                    yield from settle(w, last=False)
    for w in layouts:
        yield from settle(w, last=True)


def _merge(key: tuple, group: pa.Table, bits: int, shard_bits: int, least: int) -> pa.Table:
    width, shard = key[0].as_py(), key[1].as_py()
    keys, counts = merge(group["filter"].to_pylist())
    often = counts >= least
    places = Layout(width, bits, shard_bits).restore(shard, keys[often])
    n = int(often.sum())
    columns = [p.astype(np.int64) for p in places] + [np.zeros(n, np.int64)] * (3 - width)
    names = ["width", "w1", "w2", "w3", "a"]
    values = [np.full(n, width, np.int32), *columns, counts[often]]
    return pa.Table.from_arrays([pa.array(v) for v in values], names)


def count_phrases(
    docs: DataFrame, least: int = 10, sizes: Sizes = Sizes()
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Phrases of two and three words with ``least`` or more occurrences.

    Returns the phrases (width, word ids w1 to w3, occurrences a), the words (lang, word, id, f) that
    have as many, and all word occurrences by language (lang, n).
    """
    texts = docs.select(
        F.coalesce(F.col("lang"), F.lit("und")).alias("lang"),
        F.col("text").cast("binary").alias("text"),
    )
    encoded = materialise(texts.mapInArrow(functools.partial(_encode, sizes=sizes), _ENCODED), "phrase-batches")
    totals = encoded.groupBy("lang").agg(F.sum("size").alias("n"))

    pair = F.explode(F.arrays_zip("words", "counts")).alias("pair")
    found = encoded.select("lang", pair).select("lang", "pair.words", "pair.counts")
    found = found.groupBy("lang", F.col("words").alias("word")).agg(F.sum("counts").alias("f"))
    found = materialise(found.where(F.col("f") >= least), "phrase-words")
    buckets = found.count() // sizes.bucket_words + 1
    bucket = F.pmod(F.xxhash64("lang", "word"), F.lit(buckets))
    place = F.row_number().over(Window.partitionBy("bucket").orderBy("lang", "word"))
    number = ((place - 1) * F.lit(buckets) + F.col("bucket") + 1).cast("long")
    words = found.withColumn("bucket", bucket).select("lang", "word", "f", number.alias("id"))
    words = materialise(words, "phrase-ids")

    bits = max(sizes.id_bits, int(words.agg(F.max("id")).first()[0] or 0).bit_length())
    size = int(encoded.agg(F.sum("size")).first()[0] or 0)
    shard_bits = (size // sizes.shard_words).bit_length()
    entry = encoded.select("batch", "lang", F.posexplode("words").alias("local", "word"))
    known = entry.join(words.select("lang", "word", "id"), ["lang", "word"])
    known = known.groupBy("batch").agg(F.collect_list(F.struct("local", "id")).alias("known"))
    n_words = F.size("words").alias("n_words")
    batches = encoded.select("batch", n_words, "ids").join(known, "batch")
    batches = batches.select("n_words", "ids", "known.local", "known.id")
    count = functools.partial(
        _count, bits=bits, shard_bits=shard_bits, width=3, limit=sizes.pending
    )

    def add(key: tuple[pa.Scalar, ...], group: pa.Table) -> pa.Table:
        return _merge(key, group, bits, shard_bits, least)

    filters = batches.mapInArrow(count, _FILTERS)
    phrases = filters.groupBy("width", "shard").applyInArrow(add, _COUNTED)
    return materialise(phrases, "phrases"), words, totals


def _score(a: str, left: str, right: str) -> F.Column:
    """floor(1000000 * a * a / (left * right)) in whole numbers; counts below 10^15 are exact."""
    a, left, right = (f"cast({c} AS decimal(15,0))" for c in (a, left, right))
    return F.expr(f"({a} * {a} * cast(1000000 AS decimal(8,0))) div ({left} * {right})")


def collocations(
    docs: DataFrame,
    least: int = 10,
    within_percent: int = 50,
    top: int = 2_000,
    sizes: Sizes = Sizes(),
) -> DataFrame:
    """The ``top`` phrases of two or three words of each language that stick together most.

    A-Z are lower-cased, ``[.,;:!?\\n-\\r]`` end a piece, space and tab part words.  Null texts are
    empty, a null language is ``und``.  A phrase that occurs ``least`` times scores the lower of its
    cuts' floor(10^6 a a / (l r)), ties to the first; a pair within a triple that has
    ``within_percent`` of its occurrences is dropped.  Ranked by score, occurrences (both descending)
    and phrase.  Repeated rows count as often as they occur; texts of any length are counted whole; a
    table without phrases gives no rows.  Other columns of ``docs`` are ignored.
    """
    phrases, words, totals = count_phrases(docs, least, sizes)

    def word(place: str) -> DataFrame:
        return words.select(
            F.col("id").alias(place), F.col("word").alias(f"{place}_word"),
            F.col("f").alias(f"{place}_f"), F.col("lang").alias(f"{place}_lang"),
        )

    pairs = phrases.where("width = 2").select("w1", "w2", "a")
    triples = phrases.where("width = 3").select("w1", "w2", "w3", "a")

    # What of each pair lies within a triple: the largest triple on either side.
    sides = triples.select(
        F.explode(
            F.array(F.struct("w1", "w2"), F.struct(F.col("w2").alias("w1"), F.col("w3").alias("w2")))
        ).alias("pair"),
        F.col("a").alias("longer"),
    )
    sides = sides.groupBy("pair.w1", "pair.w2").agg(F.max("longer").alias("longer"))
    kept = pairs.join(sides, ["w1", "w2"], "left").where(
        F.col("longer").isNull() | (F.col("longer") * 100 < F.col("a") * within_percent)
    )
    scored = kept.join(word("w1"), "w1").join(word("w2"), "w2")
    scored = scored.select(
        F.col("w1_lang").alias("lang"),
        F.concat_ws(" ", "w1_word", "w2_word").alias("phrase"),
        "a",
        F.col("w1_f").alias("l"),
        F.col("w2_f").alias("r"),
        _score("a", "w1_f", "w2_f").alias("score"),
    )

    head = pairs.select("w1", "w2", F.col("a").alias("head"))
    tail = pairs.select(F.col("w1").alias("w2"), F.col("w2").alias("w3"), F.col("a").alias("tail"))
    long = triples.join(head, ["w1", "w2"]).join(tail, ["w2", "w3"])
    long = long.join(word("w1"), "w1").join(word("w2"), "w2").join(word("w3"), "w3")
    first, second = _score("a", "w1_f", "tail"), _score("a", "head", "w3_f")
    early = F.col("first") <= F.col("second")
    long = long.withColumns({"first": first, "second": second}).select(
        F.col("w1_lang").alias("lang"),
        F.concat_ws(" ", "w1_word", "w2_word", "w3_word").alias("phrase"),
        "a",
        F.when(early, F.col("w1_f")).otherwise(F.col("head")).alias("l"),
        F.when(early, F.col("tail")).otherwise(F.col("w3_f")).alias("r"),
        F.least("first", "second").alias("score"),
    )

    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = scored.unionByName(long).withColumn("rank", F.row_number().over(order).cast("long"))
    found = ranked.where(F.col("rank") <= top).join(totals, "lang")
    return found.select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


COLLOCATIONS_SQL = r"""
WITH pieces AS (
    SELECT d, lang, unnest(p) AS piece, generate_subscripts(p, 1) AS at
    FROM (
        SELECT row_number() OVER () AS d, coalesce(lang, 'und') AS lang,
               string_split_regex(
                   translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                   '[.,;:!?\x0A-\x0D]') AS p
        FROM documents)),
lists AS (
    SELECT lang, list_filter(string_split_regex(piece, '[\x20\x09]+'), lambda w: w <> '') AS w FROM pieces),
grams AS (
    SELECT lang, k, w[i : i + k - 1] AS p, count(*) AS a
    FROM (SELECT lang, w, k, unnest(generate_series(1, len(w) - k + 1)) AS i
          FROM lists, (VALUES (1), (2), (3)) t(k))
    GROUP BY ALL),
totals AS (SELECT lang, sum(a) AS n FROM grams WHERE k = 1 GROUP BY lang),
often AS (SELECT * FROM grams WHERE a >= 10),
cuts AS (
    SELECT c.lang, c.p, c.a, x.k AS cut, x.a AS l, y.a AS r,
           (1000000::HUGEINT * c.a * c.a) // (x.a::HUGEINT * y.a) AS score
    FROM often c
    JOIN often x ON x.lang = c.lang AND x.k < c.k AND x.p = c.p[1 : x.k]
    JOIN often y ON y.lang = c.lang AND y.p = c.p[x.k + 1 :]
    WHERE c.k > 1),
best AS (
    SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, p ORDER BY score, cut) = 1),
longer AS (
    SELECT lang, q, max(a) AS a
    FROM (SELECT lang, a, unnest([p[1 : 2], p[2 : 3]]) AS q FROM often WHERE k = 3) GROUP BY lang, q),
kept AS (
    SELECT b.* FROM best b LEFT JOIN longer g ON g.lang = b.lang AND g.q = b.p
    WHERE g.a IS NULL OR 100 * g.a < 50 * b.a),
ranked AS (
    SELECT lang, array_to_string(p, ' ') AS phrase, a, l, r, score,
           row_number() OVER (
               PARTITION BY lang ORDER BY score DESC, a DESC, encode(array_to_string(p, ' '))) AS rank
    FROM kept)
SELECT lang, rank, phrase, a, l, r, n::BIGINT AS n, score::BIGINT AS score
FROM ranked JOIN totals USING (lang) WHERE rank <= 2000
"""
