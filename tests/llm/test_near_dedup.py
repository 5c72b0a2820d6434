import numpy as np
import pytest

from loadcast.llm import near_dedup
from loadcast.llm.graph import components
from loadcast.llm.near_dedup import linked_pairs, near_duplicates, shingle_set
from tests.llm.samples import WORD, documents, edited, frame, prose


def brute(rows, width, percent):
    sets = {}
    for doc, text, *_ in rows:
        if doc is not None:
            words = [w.decode() for w in (text or "").encode().lower().split()]
            n = max(1, len(words) - width + 1) if words else 0
            sets.setdefault(doc, []).append(frozenset(tuple(words[k : k + width]) for k in range(n)))
    up = {d: d for d in sets}

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    ids = sorted(sets)
    for i in ids:
        for j in ids:
            for a in sets[i]:
                for b in sets[j]:
                    if i < j and a and b and 100 * len(a & b) >= percent * len(a | b):
                        x, y = sorted((root(i), root(j)))
                        up[y] = x
    return {d: root(d) for d in sets}, {d: len(s[0]) for d, s in sets.items()}


@pytest.mark.parametrize(("width", "percent", "tile"), [(3, 85, 1_500_000), (5, 80, 600)])
def test_equals_brute_force(spark, monkeypatch, width, percent, tile):
    monkeypatch.setattr(near_dedup, "TILE", tile)
    rows = documents()
    out = near_duplicates(frame(spark), width, percent, 12, 2).collect()
    assert len(out) == len(rows)
    roots, sizes = brute(rows, width, percent)
    for r in out:
        if r["doc_id"] is None:
            assert r["component_id"] is None and r["kept"]
        else:
            assert r["component_id"] == roots[r["doc_id"]]
            assert r["n_shingles"] == sizes[r["doc_id"]]
            assert r["kept"] == (r["doc_id"] == r["component_id"])


def test_one_id_with_two_texts_is_one_node(spark):
    a, b = prose(1, 50), prose(2, 50)
    rows = [(5, a, "", "", 0), (7, a, "", "", 0), (7, b, "", "", 0), (9, b, "", "", 0)]
    out = near_duplicates(frame(spark, rows), 5, 80).collect()
    assert {r["component_id"] for r in out} == {5}


def test_empty_table(spark):
    assert near_duplicates(frame(spark, []), 5, 80).count() == 0


def test_linked_pairs_over_two_sides():
    base = prose(1, 80)
    sets = [shingle_set(edited(base, k, k % 8), 3) for k in range(40)]
    sides = np.arange(40) % 2
    want = {
        (x, y)
        for x in range(40)
        for y in range(40)
        if sides[x] != sides[y]
        and 100 * len(np.intersect1d(sets[x], sets[y])) >= 85 * len(np.union1d(sets[x], sets[y]))
    }

    def labels(pairs):
        up = list(range(40))
        for x, y in pairs:
            old, new = up[x], up[y]
            up = [new if u == old else u for u in up]
        return {frozenset(k for k in range(40) if up[k] == u) for u in up}

    got = linked_pairs(sets, sides, 85)
    assert set(got) <= want
    assert labels(got) == labels(want)


def test_components_of_chain_and_star(spark):
    edges = [(k, k + 1) for k in range(40)] + [(100, k) for k in range(101, 140)] + [(7, 7)]
    out = {r["node"]: r["root"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert out == {**dict.fromkeys(range(41), 0), **dict.fromkeys(range(100, 140), 100)}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_words_are_cut_at_six_ascii_blanks_only():
    text = "a\x1cb c\x0bd e\x85f\tg"
    assert [w.encode() for w in WORD.findall(text)] == text.encode().split()
