"""Benchmark decontamination by latent semantic retrieval.

1. Vocabulary and lengths come from the benchmark; document frequencies of its words from all
   documents (words outside it cannot add to a dot product with a benchmark passage).  The same pass
   writes the benchmark words of every passage of every document, a fraction of the texts' size.
2. The benchmark passages are taken in groups of ``GROUP``, fewer than a space has axes.  A
   randomised SVD of TF-IDF passages gives each group its latent space over the group's words: its
   benchmark passages (with ``ITEM_WEIGHT``, so that the space tells them apart) and the passages of
   all documents, scaled to the weight of ``FIT_DOCS``.  What the axes miss of a benchmark passage is
   added as further axes.  The cross products of the passage matrix are summed over all partitions
   once; range finder, power rounds and eigenproblem of a group run on its sums, in one task, and only
   ``words x rank`` numbers of each group reach the driver.
3. Every document is cut into overlapping passages of several lengths, long enough to hold every
   run of the fitting length, projected, and compared by the product with the latent vector of the
   benchmark passages of fitting length.  The limit is the benchmark passage's own: the least product
   that the words of a copy that step 4 accepts can have.  Passages that reach it are candidates.
   Passages where even the best share of a limit that each word adds, over the items of a part, does
   not sum up to one limit are not projected: no product there reaches a limit.
4. A candidate is confirmed by the longest common subsequence of the benchmark passage and the
   surroundings: ``VERBATIM`` of the passage, or ``PARAPHRASE`` of it where its answer (its last
   words) is found as well.

A benchmark is taken in blocks of ``BLOCK`` items, so what is sent to the tasks is bounded; each
block is one pass over the documents without any shuffle of texts.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loadcast.llm.words import encode
from loadcast.session import remove, scratch_path

RANK = 48
OVERSAMPLE = 16
ITEM_WEIGHT = 100.0
POWER_ROUNDS = 2
FIT_DOCS = 2000  # documents to whose weight the sums over all of them are scaled
FIT_WORDS = 48
FIT_HELD = 4096 * FIT_WORDS  # words that are cut into passages at once
FIT_PASSAGES = 20_000  # passages that a task multiplies at once
FIT_PACKED = 50  # passages in a row
FIT_CELLS = 2**24  # numbers of the sums that a task holds
FIT_SLICE = 512  # numbers of the sums in a row
PARTS = 8  # of the items, for the bound before the projection
BLOCK = 5_000
GROUP = 32
MISSED = 1e-3  # part of a benchmark passage outside the axes that is worth a further axis
SLACK = 0.02  # for rounding in the sums of single precision
VERBATIM = 0.8
PARAPHRASE = 0.5
ANSWER_SHARE = 0.2
MIN_WORDS = 8
STREAM = 20_000  # words that are searched at once

# Lower case, with every ASCII character that is no letter or digit as a gap.
_FOLD = bytes(
    c + 32 if 65 <= c <= 90 else c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 else 32
    for c in range(256)
)


def fold(text: str | None) -> list[bytes]:
    return encode(text).translate(_FOLD).split()


@dataclass
class Items:
    """A block of benchmark passages as word codes, and their words."""

    ids: list
    codes: list[np.ndarray]
    words: dict[bytes, int]

    def code(self, text: str | None) -> np.ndarray:
        """Codes of a text's words, -1 outside the benchmark."""
        words = fold(text)
        return np.fromiter(map(self.words.get, words, repeat(-1)), np.int64, len(words))


@dataclass
class Space:
    """Latent coordinates of a group's words (scaled by IDF) and of its benchmark passages.

    ``which`` are the passages' places in the block, ``vocabulary`` the codes of the words.
    ``limits`` are the least products of a copy; benchmark passages have length 1.  ``screens`` has for
    every passage length a row for each part of the fitting items: what a word adds at most to a
    product, as a share of the item's limit.
    """

    which: np.ndarray
    vocabulary: np.ndarray
    words: np.ndarray
    items: np.ndarray
    sizes: np.ndarray
    limits: np.ndarray
    screens: list[np.ndarray]

    def local(self, codes: np.ndarray, size: int) -> np.ndarray:
        """Places of word codes (of ``size``) in the vocabulary, -1 outside."""
        return _places(self.vocabulary, codes, size)


def _places(vocabulary: np.ndarray, codes: np.ndarray, size: int) -> np.ndarray:
    table = np.full(size + 1, -1)  # the last one is for code -1
    table[vocabulary] = np.arange(len(vocabulary))
    return table[codes]


def read_items(rows: list) -> Items:
    words: dict[bytes, int] = {}
    ids, codes = [], []
    for item, text in rows:
        found = fold(text)
        if len(found) >= MIN_WORDS:
            ids.append(item)
            codes.append(np.array([words.setdefault(w, len(words)) for w in found], np.int64))
    return Items(ids, codes, words)


_PASSAGES = "words binary, times binary, sizes binary"


def _passages(docs: DataFrame, items: Items) -> DataFrame:
    """The benchmark words of all passages, and the documents that have each word.

    A row holds ``FIT_PACKED`` passages: distinct ``words`` (codes, ascending by passage), how many
    ``times`` each occurs, and the ``sizes`` of the passages in distinct words; passages without
    benchmark words are left out.  Rows without sizes hold words and the documents of one task that
    have them, the code behind the last one standing for all documents.
    """
    sent = docs.sparkSession.sparkContext.broadcast(items)
    size = len(items.words)
    names = ["words", "times", "sizes"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items, total = sent.value, np.zeros(size + 1, np.int64)
        held: list[np.ndarray] = []
        words = 0
        for batch in batches:
            total[size] += batch.num_rows
            for text in batch.column(0):
                codes = items.code(text.as_py())
                total[np.unique(codes[codes >= 0])] += 1
                for since in range(0, len(codes), FIT_HELD):
                    held.append(codes[since : since + FIT_HELD])
                    words += len(held[-1])
                    if words >= FIT_HELD:
                        yield packed(held)
                        held, words = [], 0
        if held:
            yield packed(held)
        used = np.flatnonzero(total)
        counted = [pa.array([x.tobytes()], pa.binary()) for x in (used.astype(np.int32), total[used])]
        yield pa.RecordBatch.from_arrays([*counted, pa.array([None], pa.binary())], names=names)

    def packed(held: list[np.ndarray]) -> pa.RecordBatch:
        words, times, sizes = _distinct_words(held, size)
        ends = np.concatenate([[0], np.cumsum(sizes, dtype=np.int64)])
        rows = [(k, min(k + FIT_PACKED, len(sizes))) for k in range(0, len(sizes), FIT_PACKED)]
        return pa.RecordBatch.from_arrays(
            [
                pa.array([words[ends[a] : ends[b]].tobytes() for a, b in rows], pa.binary()),
                pa.array([times[ends[a] : ends[b]].tobytes() for a, b in rows], pa.binary()),
                pa.array([sizes[a:b].tobytes() for a, b in rows], pa.binary()),
            ],
            names=names,
        )

    return docs.select("text").mapInArrow(run, _PASSAGES)


def _distinct_words(texts: list[np.ndarray], size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct words of the texts' passages, how often each occurs, and passage sizes above 0."""
    lengths = np.array([len(codes) for codes in texts])
    codes = np.concatenate(texts)
    before = np.cumsum(-(-lengths // FIT_WORDS)) - -(-lengths // FIT_WORDS)
    place = np.arange(len(codes)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    passage = np.repeat(before, lengths) + place // FIT_WORDS
    known = codes >= 0
    cells, times = np.unique(passage[known] * size + codes[known], return_counts=True)
    sizes = np.bincount(cells // size)
    return (cells % size).astype(np.int32), times.astype(np.uint8), sizes[sizes > 0].astype(np.uint8)


def _numbers(column: pa.Array, kind: type) -> np.ndarray:
    """The numbers in all rows of a binary column."""
    return np.frombuffer(b"".join(column.to_pylist()), kind)


def _document_frequency(passages: DataFrame, size: int) -> tuple[np.ndarray, int]:
    """Documents with each benchmark word, and all documents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counted = [_numbers(batch.column(0), np.int32), _numbers(batch.column(1), np.int64)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(counted[0].astype(np.int64)), pa.array(counted[1])], names=["word", "n"]
            )

    out = np.zeros(size + 1, np.int64)
    counted = passages.where("sizes IS NULL").select("words", "times")
    counted = counted.mapInArrow(run, "word long, n long").groupBy("word")
    for word, n in counted.agg(F.sum("n")).collect():
        out[word] = n
    return out[:size], int(out[size])


def _unit_rows(codes: list[np.ndarray], idf: np.ndarray) -> np.ndarray:
    """TF-IDF of passages, rows of length 1."""
    row = np.repeat(np.arange(len(codes)), [len(c) for c in codes])
    word = np.concatenate(codes) if codes else np.empty(0, np.int64)
    cells = np.bincount(row * len(idf) + word, idf[word], minlength=len(codes) * len(idf))
    rows = cells.reshape(len(codes), len(idf))
    return rows / np.maximum(np.linalg.norm(rows, axis=1, keepdims=True), 1e-12)


def _cross_products(word: np.ndarray, value: np.ndarray, sizes: np.ndarray, width: int) -> np.ndarray:
    """``A' A`` as a flat upper triangle; ``sizes`` are the cells of each row, their words ascending."""
    cells, adds = [np.empty(0, np.int64)], [np.empty(0)]
    first = np.cumsum(sizes) - sizes
    for size in np.unique(sizes[sizes > 0]).tolist():
        at = first[sizes == size] + np.arange(size)[:, None]
        words, values = word[at], value[at]
        for k in range(size):
            cells.append((words[k] * width + words[k:]).ravel())
            adds.append((values[k] * values[k:]).ravel())
    return np.bincount(np.concatenate(cells), np.concatenate(adds), minlength=width * width)


def _axes(
    items: Items, idf: np.ndarray, group: np.ndarray, products: np.ndarray, rank: int, seed: list[int]
) -> np.ndarray:
    """Randomised SVD of a group's passages: range finder, power rounds, eigenproblem.

    ``products`` are the documents' cross products; those of the benchmark passages are added.
    """
    vocabulary = _vocabulary(items, group)
    local = [_places(vocabulary, items.codes[i], len(idf)) for i in group]
    width = len(vocabulary)
    rows = _unit_rows(local, idf[vocabulary])
    half = products.reshape(width, width)
    total = half + np.triu(half, 1).T + ITEM_WEIGHT**2 * (rows.T @ rows)
    draw = np.random.default_rng(seed)
    basis = draw.standard_normal((width, min(rank + OVERSAMPLE, width)))
    for _ in range(POWER_ROUNDS):
        basis = np.linalg.qr(total @ basis)[0]
    values, vectors = np.linalg.eigh(basis.T @ total @ basis)
    return basis @ vectors[:, np.argsort(-values)[:rank]]


def _fitted_axes(
    passages: DataFrame, items: Items, idf: np.ndarray, groups: dict[int, np.ndarray], scale: float,
    rank: int, seed: int,
) -> dict[int, np.ndarray]:
    """Axes of the given groups from all passages; none for a group that meets no passage."""
    vocabularies = {k: _vocabulary(items, group) for k, group in groups.items()}
    sent = passages.sparkSession.sparkContext.broadcast((items, idf, groups, vocabularies))
    size = len(items.words)
    kinds = ["group", "slice", "values"]
    schema = "group long, slice long, values binary"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _, idf, _, vocabularies = sent.value
        sums = {k: np.zeros(len(v) ** 2) for k, v in vocabularies.items()}
        tables = {k: _places(v, np.arange(size), size) for k, v in vocabularies.items()}
        for batch in batches:
            words, times = _numbers(batch.column(0), np.int32), _numbers(batch.column(1), np.uint8)
            sizes = _numbers(batch.column(2), np.uint8)
            ends = np.concatenate([[0], np.cumsum(sizes, dtype=np.int64)])
            for since in range(0, len(sizes), FIT_PASSAGES):
                some = sizes[since : since + FIT_PASSAGES]
                cells = slice(ends[since], ends[since + len(some)])
                row = np.repeat(np.arange(len(some)), some)
                for k, vocabulary in vocabularies.items():
                    local = tables[k][words[cells]]
                    inside = local >= 0
                    word, at = local[inside], row[inside]
                    value = idf[vocabulary][word] * times[cells][inside]
                    value /= np.sqrt(np.bincount(at, value * value, minlength=len(some)))[at]
                    counts = np.bincount(at, minlength=len(some))
                    sums[k] += _cross_products(word, value, counts, len(vocabulary))
        for k, total in sums.items():
            total = np.concatenate([total, np.zeros(-len(total) % FIT_SLICE)]).reshape(-1, FIT_SLICE)
            used = np.flatnonzero(total.any(axis=1))
            yield sums_batch([k] * len(used), used, [x.tobytes() for x in total[used]])

    def sums_batch(group: list[int], part: np.ndarray | list[int], raw: list[bytes]) -> pa.RecordBatch:
        ints = [pa.array(group, pa.int64()), pa.array(part, pa.int64())]
        return pa.RecordBatch.from_arrays([*ints, pa.array(raw, pa.binary())], names=kinds)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, total = None, np.empty(0)
        for batch in batches:
            keys = zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True)
            done: list[tuple] = []
            for key, raw in zip(keys, batch.column(2), strict=True):
                part = np.frombuffer(raw.as_py())
                if key == now:
                    total = total + part
                else:
                    if now is not None:
                        done.append((*now, total.tobytes()))
                    now, total = key, part
            if done:
                yield sums_batch(*map(list, zip(*done, strict=True)))
        if now is not None:
            yield sums_batch([now[0]], [now[1]], [total.tobytes()])

    def fit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items, idf, groups, vocabularies = sent.value
        now, total = None, np.empty(0)

        def fitted() -> pa.RecordBatch:
            products = scale * total[: len(vocabularies[now]) ** 2]
            axes = _axes(items, idf, groups[now], products, rank, [seed, now])
            return sums_batch([now], [0], [axes.tobytes()])

        for batch in batches:
            columns = [c.to_pylist() for c in batch.columns]
            for k, part, raw in zip(*columns, strict=True):
                if k != now:
                    if now is not None:
                        yield fitted()
                    cells = len(vocabularies[k]) ** 2
                    now, total = k, np.zeros(cells + -cells % FIT_SLICE)
                total[part * FIT_SLICE : (part + 1) * FIT_SLICE] = np.frombuffer(raw)
        if now is not None:
            yield fitted()

    parts = passages.where("sizes IS NOT NULL").mapInArrow(run, schema)
    parts = parts.repartition("group", "slice").sortWithinPartitions("group", "slice")
    sums = parts.mapInArrow(add, schema)
    sums = sums.repartition("group").sortWithinPartitions("group", "slice")
    found = sums.mapInArrow(fit, schema).collect()
    shapes = {k: (len(v), -1) for k, v in vocabularies.items()}
    return {r["group"]: np.frombuffer(r["values"]).reshape(shapes[r["group"]]) for r in found}


def _vocabulary(items: Items, group: np.ndarray) -> np.ndarray:
    return np.unique(np.concatenate([items.codes[i] for i in group]))


def latent_spaces(docs: DataFrame, items: Items, rank: int = RANK, seed: int = 3) -> list[Space]:
    """The spaces of all groups, fitted on the benchmark and on every passage of every document."""
    spark = docs.sparkSession
    path = scratch_path(spark, "passages")
    try:
        _passages(docs, items).write.parquet(path)
        passages = spark.read.schema(_PASSAGES).parquet(path)
        counts, n = _document_frequency(passages, len(items.words))
        idf = np.log((1.0 + n) / (1.0 + counts)) + 0.1
        # The items' weight against the documents is the same at every size.
        scale = FIT_DOCS / max(n, FIT_DOCS)
        # Passages of similar length share a group: it is compared at few lengths.
        order = np.argsort([len(c) for c in items.codes], kind="stable")
        groups = [order[k : k + GROUP] for k in range(0, len(order), GROUP)]
        axes: dict[int, np.ndarray] = {}
        for some in _together([len(_vocabulary(items, group)) ** 2 for group in groups]):
            chosen = {k: groups[k] for k in some}
            axes |= _fitted_axes(passages, items, idf, chosen, scale, rank, seed)
    finally:
        remove(spark, path)
    spaces = []
    for k, group in enumerate(groups):
        if k not in axes:
            none = np.zeros(len(_vocabulary(items, group)) ** 2)
            axes[k] = _axes(items, idf, group, none, rank, [seed, k])
        spaces.append(place_items(items, idf, group, axes[k]))
    return spaces


def _together(cells: list[int]) -> list[list[int]]:
    """Groups in order, as many at a time as a task holds the sums of (at least one)."""
    out: list[list[int]] = []
    room = 0
    for k, n in enumerate(cells):
        if n > room:
            out.append([])
            room = FIT_CELLS
        out[-1].append(k)
        room -= n
    return out


def place_items(items: Items, idf: np.ndarray, group: np.ndarray, axes: np.ndarray) -> Space:
    vocabulary = _vocabulary(items, group)
    local = [_places(vocabulary, items.codes[i], len(idf)) for i in group]
    idf = idf[vocabulary]
    rows = _unit_rows(local, idf)
    _, left, more = np.linalg.svd(rows - rows @ axes @ axes.T, full_matrices=False)
    axes = np.concatenate([axes, more[left > MISSED].T], axis=1)
    limits = np.array([_least_product(codes, idf) for codes in local])
    sizes = np.array([len(codes) for codes in local])
    words, placed = (axes * idf[:, None]).astype(np.float32), (rows @ axes).astype(np.float32)
    screens = [_screen(words, placed[fits], limits[fits]) for _, fits in _fitting(sizes)]
    return Space(group, vocabulary, words, placed, sizes, limits, screens)


def _screen(words: np.ndarray, items: np.ndarray, limits: np.ndarray) -> np.ndarray:
    """Upper bounds of the shares of a limit that words add to products, for parts of similar items.

    A product that reaches its limit has shares that sum up to 1 or more.
    """
    if not len(items):
        return np.zeros((1, len(words)), np.float32)
    alike = items @ items.T
    heads = [0]
    while len(heads) < min(PARTS, len(items)):
        heads.append(int(np.argmin(alike[:, heads].max(axis=1))))
    part = np.argmax(alike[:, heads], axis=1)
    with np.errstate(divide="ignore", invalid="ignore"):
        share = np.maximum(words @ items.T, 0.0) / np.maximum(limits, 0.0)
    share[:, limits <= 0.0] = np.inf  # reached by any passage
    return np.stack([share[:, part == k].max(axis=1) for k in np.unique(part)])


def _least_product(item: np.ndarray, idf: np.ndarray) -> float:
    """A lower bound of the product of the item with a passage that holds a copy of it.

    A word of the item that is found adds its IDF squared times its frequency in the item, so the
    accepted shares (``confirmed``) of the words that add least bound the sum from below.
    """
    often = np.bincount(item, minlength=len(idf))
    adds = idf[item] ** 2 * often[item]

    def least(values: np.ndarray, share: float) -> float:
        return np.sort(values)[: int(np.ceil(share * len(values) - 1e-9))].sum()

    paraphrase = max(least(adds, PARAPHRASE), least(adds[-_answer(item) :], VERBATIM))
    bound = min(least(adds, VERBATIM), paraphrase) / np.linalg.norm(idf * often)
    return bound * (1 - SLACK) - SLACK


def common_length(a: np.ndarray, b: np.ndarray) -> int:
    """Longest common subsequence of two code sequences, bit-parallel over ``a``."""
    masks: dict[int, int] = {}
    for k, x in enumerate(a.tolist()):
        masks[x] = masks.get(x, 0) | 1 << k
    full = (1 << len(a)) - 1
    row = full
    for x in b.tolist():
        hit = masks.get(x)
        if hit:
            both = row & hit
            row = (row + both | row - both) & full
    return len(a) - row.bit_count()


def _answer(item: np.ndarray) -> int:
    """Words of the item that stand for its answer."""
    return max(3, int(np.ceil(ANSWER_SHARE * len(item))))


def enough_words(item: np.ndarray, near: np.ndarray, marks: np.ndarray) -> bool:
    """Whether the words of ``near``, in any order, allow the item to be confirmed.

    The item's words that occur at all bound the common subsequence from above.  ``marks`` is a
    scratch row of False, one for each word and one for unknown words.
    """
    marks[near] = True
    occurs = marks[item]
    marks[near] = False
    n = np.count_nonzero(occurs)
    if n < PARAPHRASE * len(item):
        return False
    tail = _answer(item)
    return n >= VERBATIM * len(item) or np.count_nonzero(occurs[-tail:]) >= VERBATIM * tail


def confirmed(item: np.ndarray, near: np.ndarray) -> float:
    """Share of the item that is found in order, 0 if that is no leak."""
    share = common_length(item, near) / len(item)
    if share >= VERBATIM:
        return share
    if share >= PARAPHRASE:
        answer = item[-_answer(item) :]
        if common_length(answer, near) >= VERBATIM * len(answer):
            return share
    return 0.0


def _lengths(sizes: np.ndarray) -> list[int]:
    """Passage lengths: each fits items of down to two thirds of it."""
    out, n = [], int(sizes.max())
    while n >= MIN_WORDS and n * 3 > int(sizes.min()) * 2:
        out.append(n)
        n = n * 2 // 3
    return out[::-1]


def _fitting(sizes: np.ndarray) -> list[tuple[int, np.ndarray]]:
    """Passage lengths with the places of the items that each fits."""
    lengths = _lengths(sizes)
    bounds = zip([0, *lengths[:-1]], lengths, strict=True)
    return [(n, np.flatnonzero((sizes <= n) & (sizes > least))) for least, n in bounds]


def leaks(docs: list[np.ndarray], items: Items, spaces: list[Space]) -> list[dict[int, float]]:
    """Confirmed items of each document and the share of each that is found.

    The documents are searched as streams of about ``STREAM`` words; a candidate passage is compared
    within every document that it touches.  Longer documents are searched in parts that overlap by
    more than an item and its surroundings.
    """
    found: list[dict[int, float]] = [{} for _ in docs]
    overlap = 4 * max((len(c) for c in items.codes), default=0)
    owners: list[int] = []
    parts: list[np.ndarray] = []
    words = 0

    def search() -> None:
        bounds = np.concatenate([[0], np.cumsum([len(p) for p in parts])])
        codes = np.concatenate(parts)
        hits: list[dict[int, float]] = [{} for _ in parts]
        for space in spaces:
            _leaks_of_group(codes, bounds, items, space, hits)
        for owner, hit in zip(owners, hits, strict=True):
            for item, share in hit.items():
                found[owner][item] = max(share, found[owner].get(item, 0.0))
        owners.clear()
        parts.clear()

    for owner, codes in enumerate(docs):
        for since in range(0, max(1, len(codes) - overlap), STREAM):
            owners.append(owner)
            parts.append(codes[since : since + STREAM + overlap])
            words += len(parts[-1])
            if words >= STREAM:
                search()
                words = 0
    if parts:
        search()
    return found


def _running_sums(rows: np.ndarray, run: int = 16) -> np.ndarray:
    """Sums of the first 0, 1, 2, ... rows.

    Runs of rows are summed side by side, then the runs: a plain running sum over short rows takes
    three times as long.
    """
    n, width = rows.shape
    sums = np.zeros((-(-n // run) * run + run, width), rows.dtype)
    sums[1 : n + 1] = rows
    cells = sums.reshape(-1, run, width)
    for k in range(1, run):
        cells[:, k] += cells[:, k - 1]
    ends = np.cumsum(cells[:, -1], axis=0)
    cells[1:] += ends[:-1, None]
    return sums[: n + 1]


def _leaks_of_group(
    codes: np.ndarray, bounds: np.ndarray, items: Items, space: Space, found: list[dict[int, float]]
) -> None:
    n = len(codes)
    local = space.local(codes, len(items.words))
    known = local[local >= 0]
    # Words outside the group add nothing: sums run over the others only.
    inside = np.concatenate([[0], np.cumsum(local >= 0)])
    marks = np.zeros(len(items.words) + 1, bool)
    edges = bounds.tolist()
    for (length, fitting), screen in zip(_fitting(space.sizes), space.screens, strict=True):
        if not len(fitting):
            continue
        step = max(1, length // 4)
        start = np.arange(0, max(1, n - length + step), step)
        # Longer by a step: every run of the length lies within one passage.
        end = np.minimum(start + length + step, n)
        low, high = inside[start], inside[end]
        # Fewer benchmark words than this cannot hold the least share of any fitting item.
        enough = high - low >= PARAPHRASE * space.sizes[fitting].min()
        start, end, low, high = start[enough], end[enough], low[enough], high[enough]
        if np.isfinite(screen).all():
            shares = np.zeros((len(screen), len(known) + 1), np.float32)
            np.cumsum(screen.take(known, axis=1), axis=1, out=shares[:, 1:])
            may = (shares.take(high, axis=1) - shares.take(low, axis=1)).max(axis=0) >= 1 - SLACK
            start, end, low, high = start[may], end[may], low[may], high[may]
        if not len(start):
            continue
        # Sums run over the words of these passages only.
        opened = np.bincount(low, minlength=len(known) + 1) - np.bincount(high, minlength=len(known) + 1)
        used = np.cumsum(opened)[:-1] > 0
        place = np.concatenate([[0], np.cumsum(used)])
        sums = _running_sums(space.words.take(known[used], axis=0))
        score = (sums[place[high]] - sums[place[low]]) @ space.items[fitting].T
        cols, rows = np.nonzero((score >= space.limits[fitting].astype(np.float32)).T)
        first = (np.searchsorted(bounds, start, "right") - 1).tolist()
        behind = np.searchsorted(bounds, end, "left").tolist()
        start, end = start.tolist(), end.tolist()
        last, until = -1, 0
        for row, col in zip(rows.tolist(), cols.tolist(), strict=True):
            item = int(space.which[fitting[col]])
            if item == last and end[row] <= until:
                continue  # inside the surroundings that have been compared
            size = int(space.sizes[fitting[col]])
            last, until = item, end[row] + size // 2
            since = max(0, start[row] - size // 2)
            for doc in range(first[row], behind[row]):
                near = codes[max(since, edges[doc]) : min(until, edges[doc + 1])]
                if not enough_words(items.codes[item], near, marks):
                    continue
                share = confirmed(items.codes[item], near)
                if share > found[doc].get(item, 0.0):
                    found[doc][item] = share


def _scan(docs: DataFrame, items: Items, spaces: list[Space], columns: list[str]) -> DataFrame:
    sent = docs.sparkSession.sparkContext.broadcast((items, spaces))
    at = columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items, spaces = sent.value
        for batch in batches:
            hits, shares = [], []
            held: list[np.ndarray] = []
            words = 0

            def search() -> None:
                for found in leaks(held, items, spaces):
                    hits.append(sorted(items.ids[k] for k in found))
                    shares.append(max(found.values(), default=0.0))
                held.clear()

            for text in batch.column(at):
                held.append(items.code(text.as_py()))
                words += len(held[-1])
                if words >= STREAM:
                    search()
                    words = 0
            search()
            more = [pa.array(hits, pa.list_(pa.int64())), pa.array(shares, pa.float64())]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, *more], names=[*columns, "leaked_items", "leaked_share"]
            )

    fields = [f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in columns]
    schema = ", ".join([*fields, "leaked_items array<long>", "leaked_share double"])
    return docs.select(*columns).mapInArrow(run, schema)


def find_leaks(docs: DataFrame, benchmark: DataFrame, rank: int = RANK) -> DataFrame:
    """``docs`` with ``leaked_items`` (item_ids, ascending) and ``leaked_share`` per row.

    ``benchmark(item_id, text)``: items of fewer than ``MIN_WORDS`` words are too short to tell and
    ignored, as are null texts and rows without item_id.  Null and blank documents leak nothing;
    repeated rows are judged each; texts of any length are searched whole, in bounded parts.  All columns of ``docs`` are kept; clashing columns named like
    the two results are replaced.  Empty tables: no rows, or nothing leaked.
    """
    docs = docs.drop("leaked_items", "leaked_share")
    # Every block is fitted on all of them, not on what the blocks before have made of them.
    texts = docs.select("text")
    known = benchmark.where("item_id IS NOT NULL AND text IS NOT NULL")
    known = known.select(F.col("item_id").cast("long").alias("item_id"), "text")
    blocks = max(1, -(-known.count() // BLOCK))
    for block in range(blocks):
        part = known.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == block)
        items = read_items(sorted((r["item_id"], r["text"]) for r in part.collect()))
        if not items.codes:
            found = docs.withColumns(
                {"leaked_items": F.expr("CAST(array() AS ARRAY<BIGINT>)"), "leaked_share": F.lit(0.0)}
            )
        else:
            found = _scan(docs, items, latent_spaces(texts, items, rank), docs.columns)
        if block:
            # A later block adds to what the earlier ones have found.
            found = found.withColumn(
                "leaked_items", F.array_sort(F.array_union("leaked_items", "_items"))
            ).withColumn("leaked_share", F.greatest("leaked_share", "_share"))
            found = found.drop("_items", "_share")
        if block + 1 < blocks:
            docs = found.withColumnsRenamed({"leaked_items": "_items", "leaked_share": "_share"})
    return found
