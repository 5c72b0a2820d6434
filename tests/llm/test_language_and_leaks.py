import random

import numpy as np
import pytest

import corpus_pipeline
from loadcast.llm import decontamination, language
from loadcast.llm.decontamination import common_length, confirmed, find_leaks, fold
from loadcast.llm.language import fit, identify
from loadcast.llm.line_templates import parsed_lines, template_lines, without_templates
from tests.llm.samples import documents, frame, prose
from pyspark.sql import functions as F


def speech(lang: str, seed: int, words: int) -> str:
    syllables = {"aa": ["ka", "mo", "ri", "tu"], "bb": ["schw", "ung", "eit", "zer"]}[lang]
    draw = random.Random(seed)
    return " ".join("".join(draw.choices(syllables, k=3)) for _ in range(words))


@pytest.fixture(scope="module")
def spoken(spark):
    rows = [(k, speech(("aa", "bb")[k % 2], k, 30), ("aa", "bb")[k % 2], f"s{k % 3}", 0) for k in range(200)]
    return frame(spark, rows)


def test_language_of_held_out_texts(spark, spoken):
    model = fit(spoken)
    rows = [(k, speech(("aa", "bb")[k % 2], 1000 + k, 8), None, None, 0) for k in range(100)]
    out = identify(frame(spark, rows), model, ["doc_id"], F.col("text"), host=F.col("source")).collect()
    right = sum(r["language"] == ("aa", "bb")[r["doc_id"] % 2] for r in out)
    assert right >= 98 and all(r["kept"] for r in out)


def test_rare_language_is_in_the_model(spark):
    rows = [(k, speech("aa", k, 6), "aa", None, 0) for k in range(4000)]
    rows += [(5000 + k, speech("bb", k, 30), "bb", None, 0) for k in range(3)]
    model = fit(frame(spark, rows), rows=100)
    assert model.languages == ["aa", "bb"]
    out = identify(frame(spark, rows[-3:]), model, ["doc_id"], F.col("text"), declared=F.col("lang"))
    assert [r["language"] for r in out.collect()] == ["bb"] * 3


def test_text_of_no_fitted_language_is_rejected(spark, spoken):
    draw = random.Random(8)
    abc = "abcdefghijklmnopqrstuvwxyz"
    foreign = ["".join(draw.choices(abc + " ", k=300)) for _ in range(10)]
    foreign += [" ".join("".join(draw.choices(["lai", "nen", "kyy", "pos"], k=3)) for _ in range(20)) for _ in range(10)]
    foreign += ["это совсем другой язык и он никому не известен", "这是一种完全不同的语言没有人认识它"]
    rows = [(k, t, "aa", "s0", 0) for k, t in enumerate(foreign)]
    rows += [(100 + k, speech("bb", 700 + k, 20), None, "s0", 0) for k in range(50)]
    out = identify(frame(spark, rows), fit(spoken), ["doc_id"], F.col("text"), declared=F.col("lang"), host=F.col("source"))
    out = {r["doc_id"]: r for r in out.collect()}
    assert [k for k in out if k < 100 and (out[k]["kept"] or out[k]["language"])] == []
    assert [k for k in out if k >= 100 and out[k]["language"] != "bb"] == []


def test_evidence_decides_where_the_text_does_not(spark, spoken):
    model = fit(spoken)
    host = [(k, speech("bb", k, 30), None, "www.site.example", 0) for k in range(60)]
    host += [(k, speech("aa", k, 30), None, "www.other.example", 0) for k in range(100, 160)]
    unclear = [(900, "q", "aa", None, 0), (901, "q", None, "www.site.example", 0), (902, "q", "BB", None, 0)]
    df = frame(spark, host + unclear)
    out = identify(df, model, ["doc_id"], F.col("text"), declared=F.col("lang"), host=F.col("source"))
    out = {r["doc_id"]: r["language"] for r in out.collect()}
    assert (out[900], out[901], out[902]) == ("aa", "bb", "bb")


def test_language_of_awkward_rows(spark, spoken):
    df = frame(spark, documents())
    out = identify(df, fit(spoken), ["doc_id"], F.col("text"), declared=F.col("lang"), host=F.col("source"))
    out = out.collect()
    assert len(out) == len(documents())
    blank = [r for r in out if r["doc_id"] in (0, 1, 2)]
    assert len(blank) == 3 and not any(r["kept"] or r["language"] for r in blank)
    nothing = fit(frame(spark, []))
    assert not any(r["kept"] for r in identify(df, nothing, ["doc_id"], F.col("text")).collect())
    assert identify(frame(spark, []), fit(spoken), ["doc_id"], F.col("text")).count() == 0


def test_addresses(spark):
    urls = ["http://a.example.de/x", "https://b.example.com/fr/1", "http://c.example.com", None, "x"]
    df = spark.createDataFrame([(u,) for u in urls], "url string")
    got = df.select(language.suffix_language(F.col("url")), language.host_of(F.col("url"))).collect()
    assert [r[0] for r in got] == ["de", "fr", None, None, None]
    assert [r[1] for r in got] == ["a.example.de", "b.example.com", "c.example.com", None, None]


def plain_common(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        last = row[:]
        for k, y in enumerate(b):
            row[k + 1] = last[k] + 1 if x == y else max(last[k + 1], row[k])
    return row[-1]


def test_common_length():
    draw = np.random.default_rng(0)
    for _ in range(200):
        a, b = (draw.integers(-1, 6, draw.integers(1, 30)) for _ in range(2))
        a = np.abs(a)
        assert common_length(a, b) == plain_common(a.tolist(), b.tolist())


def test_paraphrase_needs_its_answer():
    item = np.arange(40)
    half = np.concatenate([item[:16], np.full(4, -1), item[20:24], np.full(6, -1)])
    assert confirmed(item, half) == 0.0
    assert confirmed(item, np.concatenate([half, item[30:]])) == pytest.approx(0.75)


@pytest.mark.parametrize("block", [20_000, 3])
def test_leaks(spark, monkeypatch, block):
    monkeypatch.setattr(decontamination, "BLOCK", block)
    items = [(k, prose(500 + k, 12 + 5 * k, 3000)) for k in range(9)] + [(50, None), (None, "x"), (51, "too short")]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    rows, want = [], {}
    for k in range(80):
        text = prose(900 + k, 5 + 11 * k, 3000)
        if k % 4 == 0:
            item = k // 4 % 9
            words = items[item][1].upper().split()
            if k % 8 == 0:
                words[len(words) // 2] = "changed"
            text = f"{text}\n{'!! '.join(words)} {prose(k, 40, 3000)}"
            want[k] = [item]
        rows.append((k, text, "", "", 0))
    rows += [(200, None, "", "", 0), (201, " ", "", "", 0), (202, "d " * 300, "", "", 0)]
    out = find_leaks(frame(spark, rows), benchmark)
    assert set(frame(spark, rows).columns) < set(out.columns)
    got = {r["doc_id"]: r["leaked_items"] for r in out.collect()}
    assert len(got) == len(rows)
    assert {d: x for d, x in got.items() if x} == want
    assert find_leaks(frame(spark, []), benchmark).count() == 0
    none = find_leaks(frame(spark, rows), benchmark.where("false"))
    assert none.where("size(leaked_items) > 0").count() == 0


def test_no_copy_is_lost_in_a_large_benchmark(spark):
    """Every planted copy that step 4 accepts is a candidate, verbatim or paraphrased."""
    draw = random.Random(5)
    often = [1.0 / (k + 1) for k in range(4000)]

    def text(words):
        return [f"w{k}" for k in draw.choices(range(4000), often, k=words)]

    items = [text(draw.randrange(20, 50)) for _ in range(2000)]
    rows, want = [], {}
    for k in range(200):
        item = draw.randrange(len(items))
        words = list(items[item])
        if k % 2:
            answer = max(3, -(-len(words) // 5))
            free = range(len(words) - answer)
            for at in draw.sample(free, min(len(free), int(0.4 * len(words)))):
                words[at] = f"other{at}"
        rows.append((k, " ".join([*text(draw.randrange(90)), *words, *text(60)]), "", "", 0))
        want[k] = item
    benchmark = spark.createDataFrame(
        [(k, " ".join(x)) for k, x in enumerate(items)], "item_id long, text string"
    )
    got = {r["doc_id"]: r["leaked_items"] for r in find_leaks(frame(spark, rows), benchmark).collect()}
    assert [k for k in want if want[k] not in got[k]] == []
    known = decontamination.read_items(list(enumerate(map(" ".join, items))))
    for k, text_, *_ in rows[:2]:
        near = known.code(text_)
        window = lambda n: [near[a : a + n] for a in range(0, max(1, len(near) - n + 1))]
        brute = [i for i, c in enumerate(known.codes) if any(confirmed(c, w) for w in window(len(c)))]
        assert set(brute) <= set(got[k])


def test_bag_bound_never_loses_a_confirmed_item():
    draw = np.random.default_rng(5)
    marks = np.zeros(31, bool)
    hits = 0
    for _ in range(400):
        item = draw.integers(0, 30, draw.integers(8, 40))
        near = item[draw.random(len(item)) < draw.uniform(0.4, 1)]
        near = np.insert(near, draw.integers(0, len(near) + 1, 5), draw.integers(-1, 30, 5))
        if confirmed(item, near):
            hits += 1
            assert decontamination.enough_words(item, near, marks)
        assert not marks.any()
    assert hits > 50


def test_running_sums():
    for n in (0, 1, 15, 16, 17, 32, 1000):
        rows = np.arange(3.0 * n).reshape(n, 3)
        want = np.concatenate([np.zeros((1, 3)), np.cumsum(rows, axis=0)])
        assert np.allclose(decontamination._running_sums(rows), want)


def test_leaks_of_a_long_text_in_parts(spark, monkeypatch):
    """Copies at every place of a text that is searched in many parts, one of them on each cut."""
    monkeypatch.setattr(decontamination, "STREAM", 100)
    items = [[f"w{k}x{j}" for j in range(20)] for k in range(40)]
    known = decontamination.read_items([(k, " ".join(x)) for k, x in enumerate(items)])
    order = np.arange(40)
    spaces = []
    for group in (order[:20], order[20:]):
        axes = np.zeros((len(decontamination._vocabulary(known, group)), 1))
        spaces.append(decontamination.place_items(known, np.ones(800), group, axes))
    for shift in range(0, 120, 7):
        words = ["other"] * shift
        for item in items:
            words += [*item, *["other"] * 13]
        found = decontamination.leaks([known.code(" ".join(words)), known.code("")], known, spaces)
        assert found == [{k: 1.0 for k in range(40)}, {}]


def test_fold_keeps_letters_and_digits():
    assert fold("Ab-C1 é!!\x85x") == [b"ab", b"c1", "é".encode(), "\x85x".encode()]


def plain_templates(parsed, min_docs, similar):
    """The method on plain lists: ``parsed`` rows are doc, mark, at, leaf, fields."""
    from collections import Counter, defaultdict

    leaves = defaultdict(list)
    for row in parsed:
        leaves[row["leaf"]].append(row)
    dropped = defaultdict(set)
    for rows in leaves.values():
        if len({(r["doc_id"], r["mark"]) for r in rows}) < min_docs:
            continue
        size = len(rows[0]["fields"])
        best = []
        for j in range(size):
            votes = Counter(r["fields"][j] for r in rows)
            top = [v for v in votes if votes[v] == max(votes.values())]
            best.append(top[0] if len(top) == 1 else None)
        near = [
            r for r in rows
            if not size or 100 * sum(a == b for a, b in zip(r["fields"], best, strict=True)) >= similar * size
        ]
        if len({(r["doc_id"], r["mark"]) for r in near}) >= min_docs:
            first = min(r["doc_id"] for r in near)
            for r in near:
                if r["doc_id"] > first:
                    dropped[r["doc_id"], r["mark"]].add(r["at"])
    return dropped


def letters(text):
    """Without digits: a token with one is variable."""
    return text.translate(str.maketrans("0123456789", "abcdefghij"))


def test_line_templates(spark):
    notice = "Released on day {} under the usual terms of page {} in part {} of this set"
    rows = []
    for k in range(40):
        other = letters(prose(k + 99, 5))
        lines = [letters(prose(k, 12)), notice.format(k, k * 7, k + 1) if k % 2 else other, "ok"]
        lines += ["All rights reserved.", letters(prose(k + 50, 20))] if k % 3 == 0 else [""]
        rows.append((k, "\n".join(lines), "", "", 0))
    rows += documents()[:20] + [(3, "All rights reserved.\nx", "", "", 0), (None, "All rights reserved.", "", "", 0)]
    docs = frame(spark, rows)
    out = without_templates(docs, min_docs=5).collect()
    assert len(out) == len(rows)
    parsed = parsed_lines(docs).collect()
    want = plain_templates(parsed, 5, 60)
    texts = {}
    for d, t, *_ in rows:
        texts.setdefault(d, []).append(t)
    total = 0
    for r in out:
        total += r["n_dropped"]
        if r["n_dropped"]:
            fits = [
                t for t in texts[r["doc_id"]]
                if t and "\n".join(x for k, x in enumerate(t.split("\n")) if k not in r["dropped"]) == r["kept"]
            ]
            assert fits
    assert total == sum(map(len, want.values()))
    changed = next(r for r in out if r["doc_id"] == 21)
    assert changed["dropped"] == [1, 3] and "Released" not in changed["kept"]
    first = next(r for r in out if r["doc_id"] == 1 and r["n_lines"] > 2)
    assert "Released" in first["kept"]
    assert without_templates(frame(spark, [])).count() == 0


@pytest.mark.parametrize("docs_fitted", [3, 10**12])
def test_leaks_do_not_depend_on_the_documents_of_the_fit(spark, monkeypatch, docs_fitted):
    """The axes hold every item whole: other fit documents find the same items and shares."""
    items = [(k, prose(5000 + k, 12 + k % 50, 900)) for k in range(80)]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    rows = []
    for k in range(300):
        text = prose(9000 + k, 80, 900)
        if k % 3 == 0:
            words = items[k % 80][1].split()
            words[:: 4 + k % 9] = ["other"] * len(words[:: 4 + k % 9])
            text = f"{text} {' '.join(words)} {prose(9500 + k, 30, 900)}"
        rows.append((k, text, "en", "s", 0))
    docs = frame(spark, rows)

    def found():
        out = find_leaks(docs, benchmark).collect()
        return sorted((r["doc_id"], r["leaked_items"], r["leaked_share"]) for r in out)

    monkeypatch.setattr(decontamination, "FIT_DOCS", 50)
    want = found()
    assert sum(bool(items) for _, items, _ in want) > 50
    monkeypatch.setattr(decontamination, "FIT_DOCS", docs_fitted)
    assert found() == want


def plain_all_templates(parsed, min_docs, similar):
    """Every template of a leaf on plain lists: lines in none that recurs go one field deeper."""
    from collections import Counter, defaultdict

    dropped = defaultdict(set)

    def judge(rows, taken):
        doc = lambda r: (r["doc_id"], r["mark"])
        if len(set(map(doc, rows))) < min_docs:
            return
        size, best = len(rows[0]["fields"]), []
        for j in range(size):
            votes = Counter(r["fields"][j] for r in rows).most_common()
            best.append(votes[0][0] if len(votes) == 1 or votes[0][1] > votes[1][1] else None)
        near = lambda r: 100 * sum(a == b for a, b in zip(r["fields"], best, strict=True)) >= similar * size
        members = [r for r in rows if near(r)]
        if len(set(map(doc, members))) >= min_docs:
            first = min(r["doc_id"] for r in members)
            for r in members:
                if r["doc_id"] > first:
                    dropped[doc(r)].add(r["at"])
            rows = [r for r in rows if not near(r)]
        free = [j for j in range(size) if j not in taken]
        holders, deeper = defaultdict(set), defaultdict(list)
        for r in rows:
            for j in free:
                holders[j, r["fields"][j]].add(doc(r))
        for r in rows:
            if free:
                deeper[max(((j, r["fields"][j]) for j in free), key=lambda c: (len(holders[c]), -c[0]))].append(r)
        for (j, _), some in deeper.items():
            judge(some, taken | {j})

    leaves = defaultdict(list)
    for row in parsed:
        leaves[row["leaf"]].append(row)
    for rows in leaves.values():
        judge(rows, frozenset())
    return dropped


@pytest.mark.parametrize("second, gone", [(100, 198), (90, 188)])
def test_a_leaf_holds_several_templates(spark, second, gone):
    lines = ["Click here to read all about our new offer"] * 100
    lines += ["Click here to see who else has joined today"] * second
    rows = [(k, f"{letters(prose(k, 2))}\n{x}", "", "", 0) for k, x in enumerate(lines)]
    out = without_templates(frame(spark, rows)).collect()
    assert sum(r["n_dropped"] for r in out) == gone
    assert {r["doc_id"] for r in out if not r["n_dropped"]} == {0, 100}


def test_all_templates_of_crowded_leaves(spark):
    """Many templates share leaves and fields, some of them with a field that varies."""
    draw = random.Random(11)
    words = [letters(f"w{k}") for k in range(60)]
    notices = []
    for k in range(24):
        rest = [draw.choice(words[:12]) for _ in range((1, 4, 8, 11)[k % 4])]
        notices.append(["click", "here", "to", *rest])
    rows = []
    for doc in range(150):
        lines = []
        for _ in range(draw.randrange(1, 9)):
            line = list(draw.choice(notices[: draw.choice((6, 24))]))
            if draw.random() < 0.5:
                line[draw.randrange(3, len(line))] = draw.choice(words)
            lines.append(" ".join(line))
        rows.append((doc, "\n".join(lines), "", "", 0))
    rows += [(7, rows[9][1], "", "", 0), (None, rows[3][1], "", "", 0), (900, None, "", "", 0)]
    docs = frame(spark, rows)
    parsed = parsed_lines(docs).collect()
    want = plain_all_templates(parsed, 10, 60)
    got = {(r["doc_id"], r["mark"]): set(r["dropped"]) for r in template_lines(docs, 10, 60).collect()}
    assert got == want
    total = sum(map(len, want.values()))
    assert total > 1.2 * sum(map(len, plain_templates(parsed, 10, 60).values()))


COMMON, RARE = ([f"{x}{k}" for k in range(8)] for x in "ab")


def mostly_common(spark):
    """600 documents of a common passage but for three of a rare one, and both as a benchmark."""
    rows = [(k, " ".join(RARE if k % 200 == 77 else COMMON), "en", "s", 0) for k in range(600)]
    benchmark = [(0, " ".join(COMMON)), (1, " ".join(RARE))]
    return frame(spark, rows), spark.createDataFrame(benchmark, "item_id long, text string")


def fitted_share(items, idf, group, axes):
    """How much of the rare passage's direction the first two fitted axes hold."""
    vocabulary = decontamination._vocabulary(items, group)
    rare = np.isin(vocabulary, [items.words[w.encode()] for w in RARE]) * idf[vocabulary]
    return np.linalg.norm(rare / np.linalg.norm(rare) @ axes[:, :2])


@pytest.fixture
def placed(monkeypatch):
    """Shares that the fits of a test have found; the fit has the documents' passages only."""
    shares = []

    def place(items, idf, group, axes, place=decontamination.place_items):
        shares.append(fitted_share(items, idf, group, axes))
        return place(items, idf, group, axes)

    monkeypatch.setattr(decontamination, "place_items", place)
    monkeypatch.setattr(decontamination, "FIT_DOCS", 20)
    monkeypatch.setattr(decontamination, "ITEM_WEIGHT", 0.0)
    return shares


def test_spaces_are_fitted_on_every_document(spark, placed):
    """A passage of three documents among 600 has its axis: no document is left out of the fit."""
    docs, benchmark = mostly_common(spark)
    items = decontamination.read_items(sorted(map(tuple, benchmark.collect())))
    decontamination.latent_spaces(docs, items, rank=2)
    assert placed == [pytest.approx(1.0)]


def test_pipeline_decontaminates_by_every_document(spark, folder, placed):
    docs, benchmark = mostly_common(spark)
    benchmark.write.parquet(f"{folder}/benchmark.parquet")
    out = corpus_pipeline.decontaminate(spark, docs, folder)
    assert out.count() == 0 and placed == [pytest.approx(1.0)]


def test_every_block_is_fitted_on_the_documents_themselves(spark, monkeypatch):
    seen = []

    def spaces(docs, items, rank, fit=decontamination.latent_spaces):
        seen.append(docs)
        return fit(docs, items, rank)

    monkeypatch.setattr(decontamination, "BLOCK", 1)
    monkeypatch.setattr(decontamination, "latent_spaces", spaces)
    docs, benchmark = mostly_common(spark)
    found = {r["doc_id"]: r["leaked_items"] for r in find_leaks(docs, benchmark).collect()}
    assert all(found[k] == ([1] if k % 200 == 77 else [0]) for k in range(600))
    assert len(seen) == 2 and not any("MapInArrow" in x._jdf.queryExecution().toString() for x in seen)


def test_cross_products_and_axes(spark, monkeypatch):
    """Sums over parts of the groups and slices of the texts equal the plain matrix product."""
    monkeypatch.setattr(decontamination, "FIT_HELD", 96)
    monkeypatch.setattr(decontamination, "FIT_PASSAGES", 7)
    monkeypatch.setattr(decontamination, "FIT_CELLS", 1)
    monkeypatch.setattr(decontamination, "FIT_DOCS", 10**6)
    benchmark = [(k, prose(40 + k, 10 + k % 9, 90)) for k in range(50)]
    texts = [None, "", "none of these", *(prose(700 + k, 3 + 41 * (k % 9), 120) for k in range(60))]
    items = decontamination.read_items(benchmark)
    docs = frame(spark, [(k, t, "en", "s", 0) for k, t in enumerate(texts)])
    codes = [items.code(t) for t in texts]
    counts = np.zeros(len(items.words))
    for c in codes:
        counts[np.unique(c[c >= 0])] += 1
    idf = np.log((1 + len(texts)) / (1 + counts)) + 0.1
    parts = [c[k : k + 48] for c in codes for k in range(0, len(c), 48)]
    for space in decontamination.latent_spaces(docs, items):
        local = [space.local(c, len(idf)) for c in parts]
        rows = decontamination._unit_rows([c[c >= 0] for c in local if (c >= 0).any()], idf[space.vocabulary])
        own = [space.local(items.codes[i], len(idf)) for i in space.which]
        own = decontamination._unit_rows(own, idf[space.vocabulary])
        total = rows.T @ rows + decontamination.ITEM_WEIGHT**2 * (own.T @ own)
        axes = space.words[:, : decontamination.RANK] / idf[space.vocabulary][:, None]
        held = np.trace(axes.T @ total @ axes)
        best = np.sort(np.linalg.eigvalsh(total))[::-1][: axes.shape[1]].sum()
        assert held == pytest.approx(best, rel=1e-5)


def test_bound_before_the_projection_loses_no_candidate(spark):
    draw = random.Random(3)
    items = decontamination.read_items([(k, prose(60 + k, 8 + k, 200)) for k in range(40)])
    docs = []
    for k in range(200):
        words = prose(k % 40 + 60, 8 + k % 40, 200).split()
        words = [w if draw.random() < 0.8 else "other" for w in words]
        docs.append(items.code(f"{prose(2000 + k, 70, 300)} {' '.join(words)} {prose(4000 + k, 50, 300)}"))
    idf = np.linspace(0.2, 5, len(items.words))
    order = np.argsort([len(c) for c in items.codes], kind="stable")
    none = [np.zeros((len(decontamination._vocabulary(items, g)), 1)) for g in (order[:20], order[20:])]
    spaces = [decontamination.place_items(items, idf, g, x) for g, x in zip((order[:20], order[20:]), none, strict=True)]
    found = decontamination.leaks(docs, items, spaces)
    for space in spaces:
        space.screens = [np.full_like(x, np.inf) for x in space.screens]
    assert found == decontamination.leaks(docs, items, spaces)
    assert sum(map(bool, found)) > 100
