"""Quality rules: importance of hashed n-grams under a trusted target against the raw corpus.

Words and pairs of neighbouring words are hashed into a fixed number of buckets.  Two
multinomials are counted: the trusted target over all documents labelled good and not toxic, and
the raw corpus over all documents.  A document's score is the mean log-likelihood ratio of its
n-grams; it is kept when the base rules pass, the score reaches a threshold, the same for every
document, and none of its words is telling.

* The threshold is the score that parts best all trusted documents from all labelled bad, a trusted
  one scored as if it were not in the target.
* A word is telling when ``TELLING_DOCS`` untrusted documents (bad or toxic) or more have it, at
  least ``TELLING_SHARE`` of them, and that share is ``TELLING_RATIO`` times its share of the
  trusted ones or more.  A few such words of a long text would vanish in the mean.

Counts are summed per task into one dense vector and leave it as sparse rows, so the shuffle is
bounded by buckets times tasks.  The driver sees and sends out the ratio vector (one number per
bucket), the counts of ``SCORE_BINS`` bins a unit of score, and the telling words (as each is in a
fixed share of documents, there are at most as many as a document has words, over that share):
none grows with the corpus.  A bit map of fixed size keeps most unlabelled texts out of the join with
the labels.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from loadcast.llm.words import encode, hash_words, mix, sequence_hashes
from loadcast.session import materialise

BUCKETS = 1 << 16
SMOOTH = 1.0
THRESHOLD = -0.3  # without documents labelled bad
SCORE_BINS = 512
LABEL_BITS = 1 << 23
TELLING_DOCS = 5
TELLING_SHARE = 1 / 4000
TELLING_RATIO = 30.0
REPEAT_WIDTH = 8
MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30
SYMBOLS = b"#*$%&|<>"
BLANKS = b" \t\n\x0b\x0c\r"


def ngram_buckets(hashes: np.ndarray, buckets: int = BUCKETS) -> np.ndarray:
    """Buckets of a document's words and word pairs."""
    pairs = mix(hashes[:-1] * np.uint64(0x9E3779B97F4A7C15) + hashes[1:])
    both = np.concatenate([mix(hashes), pairs])
    return (both >> np.uint64(32)).astype(np.int64) % buckets


def base_counts(text: str | None, hashes: np.ndarray) -> tuple[int, int, int, int]:
    """``word_chars, n_symbols, n_dup_lines, n_repeat_words`` of one text."""
    raw = encode(text)
    chars = len(text or "") - (len(raw) - len(raw.translate(None, BLANKS)))
    symbols = len(raw) - len(raw.translate(None, SYMBOLS))
    seen, repeated_lines = set(), 0
    for line in raw.split(b"\n"):
        if line in seen:
            repeated_lines += 1
        elif line.split(None, 1):
            seen.add(line)
    n = len(hashes)
    if n <= REPEAT_WIDTH:
        return chars, symbols, repeated_lines, 0
    windows = sequence_hashes(hashes, REPEAT_WIDTH)
    order = np.argsort(windows, kind="stable")
    ordered = windows[order]
    same = ordered[1:] == ordered[:-1]
    if not same.any():
        return chars, symbols, repeated_lines, 0
    twice = np.zeros(len(windows), bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    step = np.zeros(n + 1, np.int64)
    starts = np.flatnonzero(twice)
    np.add.at(step, starts, 1)
    np.add.at(step, starts + REPEAT_WIDTH, -1)
    return chars, symbols, repeated_lines, int(np.count_nonzero(np.cumsum(step)[:n]))


def _bucket_counts(docs: DataFrame, buckets: int) -> DataFrame:
    """``bucket, n``: partial counts, one dense vector per task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for text in batch.column(0):
                hashes = hash_words(encode(text.as_py()).split())
                if len(hashes):
                    total += np.bincount(ngram_buckets(hashes, buckets), minlength=buckets)
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays(
            [pa.array(used, pa.int64()), pa.array(total[used], pa.int64())], names=["bucket", "n"]
        )

    partial = docs.select("text").mapInArrow(run, "bucket long, n long")
    return partial.groupBy("bucket").agg(F.sum("n").alias("n"))


def _all_counts(docs: DataFrame, buckets: int) -> np.ndarray:
    counts = np.full(buckets, 0.0)
    for row in _bucket_counts(docs, buckets).collect():
        counts[row["bucket"]] = row["n"]
    return counts


def _ratios(target: np.ndarray, raw: np.ndarray) -> np.ndarray:
    """Smoothed log of target share over corpus share of counts, zero without a target."""

    def share(counts: np.ndarray) -> np.ndarray:
        # The prior is spread evenly and weighs as much as one n-gram per bucket.
        return (counts + SMOOTH) / (counts.sum() + SMOOTH * len(counts))

    return np.log(share(target)) - np.log(share(raw)) if target.any() else np.zeros(len(raw))


def log_ratios(target: DataFrame, raw: DataFrame, buckets: int = BUCKETS) -> np.ndarray:
    """Smoothed log of target share over corpus share, per bucket (``buckets`` numbers)."""
    return _ratios(_all_counts(target, buckets), _all_counts(raw, buckets))


def _fails(n: int, counts: tuple[int, int, int, int]) -> bool:
    return n < MIN_WORDS or 100 * counts[3] > MAX_REPEAT_PERCENT * n


def best_threshold(judged: DataFrame, target: np.ndarray, raw: np.ndarray) -> float:
    """The score that parts best ``judged(text, trusted)`` documents that pass the base rules."""
    buckets = len(raw)
    sent = judged.sparkSession.sparkContext.broadcast((target, raw))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        target, raw = sent.value
        low = np.log(raw + SMOOTH) - np.log(raw.sum() + SMOOTH * buckets)
        for batch in batches:
            scores, good = [], []
            for text, trusted in zip(batch.column(0), batch.column(1).to_pylist(), strict=True):
                text = text.as_py()
                hashes = hash_words(encode(text).split())
                if _fails(len(hashes), base_counts(text, hashes)):
                    continue
                found = ngram_buckets(hashes, buckets)
                used, n = np.unique(found, return_counts=True)
                own = n if trusted else 0
                rest = target.sum() - (n.sum() if trusted else 0) + SMOOTH * buckets
                high = np.log(target[used] - own + SMOOTH) - np.log(rest)
                scores.append(float((high - low[used]) @ n / n.sum()))
                good.append(trusted)
            yield pa.RecordBatch.from_arrays(
                [pa.array(scores, pa.float64()), pa.array(good, pa.bool_())], names=["score", "good"]
            )

    # Judged documents are scored once; equal scores are one row.
    found = judged.select("text", "trusted").mapInArrow(run, "score double, good boolean")
    found = found.groupBy("score").agg(
        F.count_if("good").alias("good"), F.count_if(~F.col("good")).alias("bad")
    )
    found = found.withColumn("bin", F.floor(F.col("score") * SCORE_BINS))
    return _parting(materialise(found, "scores")) if target.any() else THRESHOLD


def _parting(found: DataFrame) -> float:
    """The threshold for ``found(score, good, bad, bin)``: prefix sums run in bins of near scores."""
    sums = found.groupBy("bin").agg(F.sum("good").alias("good"), F.sum("bad").alias("bad"))
    before, good, bad = [], 0, 0
    for row in sorted(sums.collect(), key=lambda r: -r["bin"]):
        before.append((row["bin"], good, bad))
        good, bad = good + row["good"], bad + row["bad"]
    if not good or not bad:
        return THRESHOLD
    offsets = found.sparkSession.createDataFrame(before, "bin long, good_before long, bad_before long")
    falling = Window.partitionBy("bin").orderBy(F.desc("score"))
    # Gained and lost shares when everything down to this score is kept.
    gained = (F.col("good_before") + F.sum("good").over(falling)) / F.lit(float(good))
    lost = (F.col("bad_before") + F.sum("bad").over(falling)) / F.lit(float(bad))
    parted = found.join(F.broadcast(offsets), "bin").select("score", (gained - lost).alias("parted"))
    best = parted.orderBy(F.desc("parted"), F.desc("score")).first()["score"]
    below = found.where(F.col("score") < best).agg(F.max("score")).first()[0]
    return (best + (best if below is None else below)) / 2


def telling_words(judged: DataFrame) -> np.ndarray:
    """Hashes of the words of ``judged(text, trusted)`` that trusted documents almost never have."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        none = np.empty(0, np.int64)
        for batch in batches:
            seen: dict[bool, list[np.ndarray]] = {True: [], False: []}
            for text, trusted in zip(batch.column(0), batch.column(1).to_pylist(), strict=True):
                words = set(encode(text.as_py()).lower().split())
                seen[trusted].append(hash_words(list(words)).view(np.int64))
            hashes, place = np.unique(np.concatenate([*seen[True], *seen[False], none]), return_inverse=True)
            here = sum(map(len, seen[True]))
            counts = [np.bincount(p, minlength=len(hashes)) for p in (place[:here], place[here:])]
            yield pa.RecordBatch.from_arrays(
                [pa.array(hashes), *map(pa.array, counts)], names=["word", "good", "bad"]
            )

    counted = judged.select("text", "trusted").mapInArrow(run, "word long, good long, bad long")
    counted = counted.groupBy("word").agg(F.sum("good").alias("good"), F.sum("bad").alias("bad"))
    sizes = {r["trusted"]: r["count"] for r in judged.groupBy("trusted").count().collect()}
    bad = F.col("bad") / F.lit(float(sizes.get(False, 0) or 1))
    good = (F.col("good") + 0.5) / F.lit(sizes.get(True, 0) + 1.0)
    least = max(TELLING_DOCS, TELLING_SHARE * sizes.get(False, 0))
    often = counted.where((F.col("bad") >= least) & (bad >= TELLING_RATIO * good))
    return np.sort(often.select("word").toArrow()["word"].to_numpy())


def _tells(text: str | None, telling: np.ndarray) -> bool:
    if not len(telling):
        return False
    words = hash_words(list(set(encode(text).lower().split()))).view(np.int64)
    at = np.minimum(np.searchsorted(telling, words), len(telling) - 1)
    return bool((telling[at] == words).any())


def _perhaps_known(docs: DataFrame, known: DataFrame) -> DataFrame:
    """All of ``docs(doc_id, text)`` whose doc_id is in ``known``, and few others.

    A bit map of ``LABEL_BITS`` hashed doc_ids tells, so that texts without a label are not shuffled.
    """
    docs = docs.withColumn("doc_id", F.col("doc_id").cast("long")).where("doc_id IS NOT NULL")
    slot = lambda: F.pmod(F.xxhash64(F.col("doc_id").cast("long")), F.lit(LABEL_BITS)) + 1
    parts = known.groupBy(F.bitmap_bucket_number(slot()).alias("part"))
    parts = parts.agg(F.bitmap_construct_agg(F.bitmap_bit_position(slot())).alias("bits"))
    bits = np.zeros(LABEL_BITS // 8, np.uint8)
    for row in parts.collect():
        own = np.frombuffer(row["bits"], np.uint8)
        bits[(row["part"] - 1) * len(own) : row["part"] * len(own)] = own
    sent = docs.sparkSession.sparkContext.broadcast(bits)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = batch.column(2).to_numpy(zero_copy_only=False) - 1
            marked = sent.value[at >> 3] >> (at & 7).astype(np.uint8) & 1
            yield batch.select(["doc_id", "text"]).filter(pa.array(marked.astype(bool)))

    return docs.select("doc_id", "text", slot().alias("slot")).mapInArrow(run, "doc_id long, text string")


COLUMNS = (
    "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, "
    "n_repeat_words long, base_failed boolean, kept boolean, score double"
)


def quality_rules(
    docs: DataFrame,
    labels: DataFrame,
    threshold: float | None = None,
    buckets: int = BUCKETS,
) -> DataFrame:
    """Base columns, ``score`` and ``kept`` for each row of ``docs(doc_id, text)``.

    ``labels(doc_id, quality, toxic)`` names the trusted documents and those that are bad or toxic;
    the threshold follows from them if none is given.  Null and blank texts have no
    words, fail the base rules and score 0.  Without any trusted document every score is 0.
    Repeated rows are counted and scored each; a null doc_id is passed on and trusted by no label.
    Other columns are ignored; an empty table gives no rows.
    """
    known = labels.where("doc_id IS NOT NULL AND (quality = 0 OR toxic = 1 OR quality = 1 AND toxic = 0)")
    known = known.groupBy("doc_id").agg(
        F.max(F.expr("quality = 1 AND toxic = 0")).alias("trusted"),
        F.max(F.coalesce(F.expr("quality = 0"), F.lit(False))).alias("bad"),
    )
    known = known.withColumn("trusted", F.coalesce("trusted", F.lit(False)))
    known = materialise(known, "labels")
    judged = _perhaps_known(docs.select("doc_id", "text"), known).join(known.hint("merge"), "doc_id")
    judged = materialise(judged.select("text", "trusted", "bad"), "judged")
    target, raw = _all_counts(judged.where("trusted"), buckets), _all_counts(docs, buckets)
    if threshold is None:
        threshold = best_threshold(judged.where("trusted OR bad"), target, raw)
    telling = telling_words(judged)
    sent = docs.sparkSession.sparkContext.broadcast((_ratios(target, raw), telling))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, telling = sent.value
        for batch in batches:
            rows, kept, failed, scores = [], [], [], []
            for text in batch.column(1):
                text = text.as_py()
                hashes = hash_words(encode(text).split())
                n = len(hashes)
                counts = base_counts(text, hashes)
                score = float(table[ngram_buckets(hashes, buckets)].mean()) if n else 0.0
                bad = _fails(n, counts)
                rows.append((n, *counts))
                failed.append(bad)
                scores.append(score)
                good = not bad and score >= threshold
                kept.append(good and not _tells(text, telling))
            columns = [pa.array([r[k] for r in rows], pa.int64()) for k in range(5)]
            columns += [pa.array(failed, pa.bool_()), pa.array(kept, pa.bool_())]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *columns, pa.array(scores, pa.float64())],
                names=[c.split()[0] for c in COLUMNS.split(", ")],
            )

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, COLUMNS)
