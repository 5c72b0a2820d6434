"""Quotient filters round-trip; phrase collocations equal brute force."""

import re
from collections import Counter

import numpy as np
import pytest

from loadcast.llm.collocations import Sizes, collocations
from loadcast.llm.quotient_filter import Layout, combine, merge, pack, unpack

from .samples import SCHEMA, frame, prose

LAYOUTS = [(2, 1, 0), (3, 1, 3), (2, 5, 0), (3, 17, 7), (3, 21, 0), (3, 24, 2), (3, 27, 20)]


@pytest.mark.parametrize("width, bits, shard_bits", LAYOUTS)
def test_keys_and_counts_come_back(width, bits, shard_bits):
    draw, layout = np.random.default_rng(bits), Layout(width, bits, shard_bits)
    ids = [draw.integers(0, 1 << bits, 3000).astype(np.uint64) for _ in range(width)]
    shards, keys = layout.scramble(ids)
    for shard in np.unique(shards)[:20]:
        own = shards == shard
        for got, want in zip(layout.restore(int(shard), keys[own]), ids):
            assert (got == want[own]).all()
        counts = draw.integers(1, 4, int(own.sum())).astype(np.int64) ** 25
        whole, summed = combine(keys[own], counts)
        half = len(whole) // 2
        parts = [pack(whole[:half], summed[:half], layout.key_bits)]
        parts += [pack(whole, summed, layout.key_bits)]
        twice = summed + np.where(np.arange(len(whole)) < half, summed, 0)
        got_keys, got_counts = merge(parts)
        assert (got_keys == whole).all() and (got_counts == twice).all()


def test_empty_filter():
    none = np.zeros(0, np.uint64)
    keys, counts = unpack(pack(none, none.astype(np.int64), 40))
    assert len(keys) == len(counts) == 0


def test_small_filter_is_compact():
    keys = np.sort(np.random.default_rng(2).choice(1 << 40, 4096, replace=False).astype(np.uint64))
    assert len(pack(keys, np.ones(4096, np.int64), 40)) < 5 * 4096


def brute(rows, least, within, top):
    grams, totals = {}, Counter()
    for _, text, lang, *_ in rows:
        lang = "und" if lang is None else lang
        folded = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split("[.,;:!?\x0a-\x0d]", folded):
            words = re.findall("[^\x20\x09]+", piece)
            totals[lang] += len(words)
            for k in (1, 2, 3):
                for i in range(len(words) - k + 1):
                    key = (lang, tuple(words[i : i + k]))
                    grams[key] = grams.get(key, 0) + 1
    often = {k: a for k, a in grams.items() if a >= least and len(k[1]) > 1}
    out = {}
    for (lang, p), a in often.items():
        longer = [
            b for (x, q), b in often.items()
            if x == lang and len(q) > len(p) and p in (q[:2], q[1:])
        ]
        if any(100 * b >= within * a for b in longer):
            continue
        cuts = []
        for k in range(1, len(p)):
            left, right = grams[lang, p[:k]], grams[lang, p[k:]]
            cuts.append((10**6 * a * a // (left * right), k, left, right))
        score, _, left, right = min(cuts)
        row = (-score, -a, " ".join(p).encode(), a, left, right, score)
        out.setdefault(lang, []).append(row)
    return sorted(
        (lang, rank, p.decode(), a, left, right, totals[lang], score)
        for lang, found in out.items()
        for rank, (_, _, p, a, left, right, score) in enumerate(sorted(found)[:top], 1)
    )


def found(docs, **options):
    return sorted(tuple(r) for r in collocations(docs, **options).collect())


def rows():
    notice = "Read the Terms of use, then Click HERE; ok? yes\x0bno\x0cend"
    texts = [None, "", " \t ", ".,;", "word", "a a a a a a a a a a a a a", "tab\tand  space " * 12]
    texts += [notice] * 12 + [f"the {k} the x of x" for k in range(15)] + ["straße ÄÖ Ä 😀 z"] * 11
    texts += [prose(k, 300, 6) for k in range(6)]
    langs = ["en", None, "und", "de"]
    return [(k, t, langs[k % 4] if k % 5 else "en", "s", 0) for k, t in enumerate(texts)]


@pytest.mark.parametrize("least, within, top", [(10, 50, 2000), (3, 80, 7), (1, 100, 50)])
def test_equals_brute_force(spark, least, within, top):
    got = found(frame(spark, rows()), least=least, within_percent=within, top=top)
    assert got == brute(rows(), least, within, top)


@pytest.mark.parametrize("id_bits", [1, 24])
def test_small_batches_shards_and_slices(spark, id_bits):
    """The same rows when everything is cut finely; wide ids don't fit into one number."""
    sizes = Sizes(50, 16, 64, 40, 3, id_bits)
    assert found(frame(spark, rows()), least=3, sizes=sizes) == brute(rows(), 3, 50, 2000)


def test_very_long_text_and_copies(spark):
    long = [(1, prose(5, 200_000, 30), "en", "s", 0), (2, "x y " * 20_000, "en", "s", 0)]
    assert found(frame(spark, long * 2), least=400) == brute(long * 2, 400, 50, 2000)


def test_empty_table(spark):
    assert found(spark.createDataFrame([], SCHEMA)) == []
