import hashlib

import numpy as np
import pytest

from loadcast.llm.fm_index import FmIndex
from loadcast.llm.substring_dedup import without_repeats
from tests.llm.samples import WORD, documents, frame


def brute(rows, width):
    first, out = {}, []
    for doc, text, *_ in rows:
        words = WORD.findall(text or "")
        for k in range(len(words) - width + 1):
            key = tuple(words[k : k + width])
            if doc is not None:
                first[key] = min(doc, first.get(key, doc))
    for doc, text, *_ in rows:
        words = WORD.findall(text or "")
        gone = [False] * len(words)
        for k in range(len(words) - width + 1):
            if doc is not None and first[tuple(words[k : k + width])] < doc:
                gone[k : k + width] = [True] * width
        kept = " ".join(w for w, g in zip(words, gone, strict=True) if not g)
        digest = hashlib.sha256(kept.encode()).hexdigest()
        out.append((doc if doc is not None else -1, len(words), sum(gone), digest))
    return sorted(out)


@pytest.mark.parametrize("crowd", [4096, 5, 1])
def test_equals_brute_force(spark, crowd):
    out = without_repeats(frame(spark), 50, crowd).drop("kept").fillna(-1, ["doc_id"])
    assert sorted(map(tuple, out.collect())) == brute(documents(), 50)


def test_two_texts_of_one_id_lose_their_own_words(spark):
    a, b = " ".join(f"a{k}" for k in range(60)), " ".join(f"b{k}" for k in range(70))
    rows = [(1, a, "", "", 0), (2, a, "", "", 0), (2, b, "", "", 0)]
    out = without_repeats(frame(spark, rows)).collect()
    assert sorted((r["doc_id"], r["n_removed"]) for r in out) == [(1, 0), (2, 0), (2, 60)]


def test_empty_table(spark):
    assert without_repeats(frame(spark, [])).count() == 0


@pytest.mark.parametrize("seed", range(6))
def test_matching_statistics(seed):
    draw = np.random.default_rng(seed)
    alphabet = 2 + 2 * seed
    texts = [draw.integers(1, alphabet, n).astype(np.uint64) for n in draw.integers(1, 60, 12)]
    queries = [draw.integers(1, alphabet + 2, n).astype(np.uint64) for n in (0, 1, 40, 7)]
    width = 6
    index = FmIndex(texts, width)
    length, low, high = index.statistics(queries)
    known = {
        tuple(t[k : k + n]) for t in texts for n in range(1, width + 1) for k in range(len(t) - n + 1)
    }
    at = 0
    for q in queries:
        for k in range(len(q)):
            best = max((n for n in range(1, width + 1) if k + n <= len(q) and tuple(q[k : k + n]) in known), default=0)
            assert length[at] == best
            if best:
                count = sum(
                    tuple(t[j : j + best]) == tuple(q[k : k + best])
                    for t in texts
                    for j in range(len(t) - best + 1)
                )
                assert high[at] - low[at] == count
            at += 1
    owners = draw.integers(0, 100, len(texts))
    least = index.least_owner(owners)
    for at in np.flatnonzero(length == width):
        cls = index.class_of[low[at]]
        rows = index.owner[index.order[low[at] : high[at]]]
        assert least[cls] == owners[rows].min()
