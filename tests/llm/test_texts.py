"""Token counts, quality rules and personal data on single texts and small tables."""

import hashlib
import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from loadcast.llm import pii
from loadcast.llm.pii import base_spans, personal_data
from loadcast.llm.quality import (
    BUCKETS,
    THRESHOLD,
    _parting,
    _perhaps_known,
    log_ratios,
    ngram_buckets,
    quality_rules,
    telling_words,
)
from loadcast.llm.tokens import PIECE, pieces, token_counts, tokenizer_path
from loadcast.llm.words import hash_words
from tests.llm.samples import WORD, documents, frame

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def plain_spans(text):
    digits = lambda m: re.sub("[^0-9]", "", m[0])

    def luhn(number):
        doubled = [int(c) * (1 + k % 2) for k, c in enumerate(number[::-1])]
        return sum(d - 9 if d > 9 else d for d in doubled) % 10 == 0

    return (
        [("email", m.start(), m.end()) for m in EMAIL.finditer(text)]
        + [("ip", m.start(), m.end()) for m in IP.finditer(text) if all(int(x) < 256 for x in m[0].split("."))]
        + [("card", m.start(), m.end()) for m in CARD.finditer(text) if 16 <= len(digits(m)) <= 19 and luhn(digits(m))]
        + [("phone", m.start(), m.end()) for m in PHONE.finditer(text) if 8 <= len(digits(m)) <= 15]
    )


def test_spans_equal_the_plain_patterns():
    draw = random.Random(1)
    alphabet = "aB@@..%+-  ()é#0123456789\n" + "4111111111111111"
    for _ in range(3000):
        text = "".join(draw.choice(alphabet) for _ in range(draw.randrange(60)))
        assert base_spans(text) == plain_spans(text), text
    text = "a@b.c@d.e 1.2.3.4.5 +1 (23) 456-7890 4111 1111-1111 1111 @x.y x@y 999.1.1.1 +12345678"
    assert base_spans(text) == plain_spans(text)


def test_personal_data_of_the_sample(spark):
    mail = "write to ann@example.org or +1 (555) 010-9999 now"
    rows = [*documents(), (900, mail, "", "", 0), (900, "other 1.2.3.4", "", "", 0)]
    out = personal_data(frame(spark, rows)).collect()
    assert len(out) == len(rows)
    got = Counter((r["doc_id"], r["base_sha256"], r["n_email"], r["n_ip"]) for r in out)
    want = Counter()
    for doc, text, *_ in rows:
        spans = plain_spans(text or "")
        joined = ",".join(f"{k}:{a}:{b}" for k, a, b in spans)
        kinds = Counter(k for k, _, _ in spans)
        want[doc, hashlib.sha256(joined.encode()).hexdigest(), kinds["email"], kinds["ip"]] += 1
    assert got == want
    clean = next(r["clean"] for r in out if r["n_email"])
    assert clean == "write to [EMAIL] or [PHONE] now"


def test_disclosing_terms(spark):
    rows = [(k, f"filler{k} Codename{'X' if k < 6 else k} x{k} y{k}", "", "", 0) for k in range(60)]
    told = [(k, t + " mail bob@example.org", *r) if k < 6 else (k, t, *r) for k, t, *r in rows]
    out = {r["doc_id"]: r for r in personal_data(frame(spark, told)).collect()}
    # "codenamex" and "mail" occur with the address and nowhere else; filler is unique to a row.
    assert out[0]["n_terms"] == 2 and "term:8:17" in out[0]["spans"]
    assert out[0]["clean"] == "filler0  x0 y0  [EMAIL]"
    assert out[30]["n_terms"] == 0 and out[30]["clean"] == told[30][1]
    assert personal_data(frame(spark, [])).count() == 0


def test_generalised_terms():
    text = "Ann lives in 12b near a@b.cd"
    spans = [("term", 0, 3), ("term", 13, 16), ("term", 17, 21), ("email", 22, 28)]
    assert pii.sanitised(text, spans, {(17, 21)}) == "[NAME] lives in [NUMBER]  [EMAIL]"


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json", "piece_bpe_32k.model"])
def test_token_counts(spark, name):
    special = "a <|endoftext|> b" + " <|endoftext|>"
    rows = [*documents(), (800, special, "", "", 0), (801, "x y'll " * 3000, "", "", 0)]
    rows += [(802, "é" * 9000 + " ab cd", "", "", 0), (803, "a  b \n c " * 2500, "", "", 0)]
    path = tokenizer_path(name)
    if name.endswith(".json"):
        from tokenizers import Tokenizer

        count = lambda t: len(Tokenizer.from_file(path).encode(t, add_special_tokens=False))
    else:
        from sentencepiece import SentencePieceProcessor

        count = lambda t: len(SentencePieceProcessor(model_file=path).encode(t))
    out = token_counts(frame(spark, rows), name, 100).collect()
    want = []
    for doc, text, *_ in rows:
        n = count(text or "")
        want.append((doc, len((text or "").encode()), n, n > 100))
    assert sorted(map(repr, map(tuple, out))) == sorted(map(repr, want))
    assert token_counts(frame(spark, []), name).count() == 0


def test_pieces_join_to_the_text():
    for text in ("", "ab " * 5000, "x" * 20000, "a b\n" * 4000):
        assert "".join(pieces(text)) == text
    assert max(map(len, pieces("ab " * 5000))) < PIECE + 10


def plain_base(text):
    words = WORD.findall(text or "")
    seen, repeated = set(), 0
    for line in (text or "").split("\n"):
        if WORD.search(line):
            repeated += line in seen
            seen.add(line)
    windows = [tuple(words[k : k + 8]) for k in range(len(words) - 7)]
    often = {w for w, n in Counter(windows).items() if n > 1}
    inside = {k + j for k, w in enumerate(windows) if w in often for j in range(8)}
    symbols = len(re.findall(r"[#*$%&|<>]", text or ""))
    return len(words), sum(map(len, words)), symbols, repeated, len(inside)


def test_quality_rules(spark):
    lines = "a b # c\na b # c\n\n\n x\n x\nend é😀 $"
    rows = [*documents(), (700, lines, "", "", 0), (701, "$$ ## q1 q2 " * 9 + " ".join(f"z{k}" for k in range(60)), "", "", 0)]
    labels = spark.createDataFrame(
        [(15, 1, 0), (60, 1, 0), (61, 1, 1), (15, 1, 0), (None, 1, 0)], "doc_id long, quality int, toxic int"
    )
    docs = frame(spark, rows)
    out = quality_rules(docs, labels, threshold=0.0).collect()
    assert len(out) == len(rows)
    key = lambda x: repr(x)
    got = sorted(((r["doc_id"], r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) for r in out), key=key)
    assert got == sorted(((d, *plain_base(t)) for d, t, *_ in rows), key=key)

    def counts(texts):
        total = np.full(BUCKETS, 1.0)
        for t in texts:
            hashes = hash_words((t or "").encode().split())
            if len(hashes):
                np.add.at(total, ngram_buckets(hashes), 1)
        return total / total.sum()

    ratio = np.log(counts(t for d, t, *_ in rows if d in (15, 60))) - np.log(counts(t for _, t, *_ in rows))
    by_id = {d: t for d, t, *_ in rows if d is not None}
    for r in out:
        assert r["base_failed"] == (r["n_words"] < 20 or 100 * r["n_repeat_words"] > 30 * r["n_words"])
        if r["doc_id"] is not None and r["n_words"]:
            hashes = hash_words(by_id[r["doc_id"]].encode().split())
            score = ratio[ngram_buckets(hashes)].mean()
            assert r["score"] == pytest.approx(score, abs=1e-9)
            assert r["kept"] == (not r["base_failed"] and r["score"] >= 0.0)
    assert not log_ratios(docs.where("false"), docs).any()
    assert quality_rules(frame(spark, []), labels).count() == 0


def test_labels_decide_threshold_and_telling_words(spark):
    draw = random.Random(4)
    rows, labels = [], []
    for k in range(600):
        words = [f"v{draw.randrange(300)}" for _ in range(draw.randrange(60, 200))]
        junk, toxic = k % 6 == 1, k % 6 == 2
        if junk:  # every third word is a symbol run: a mean that is only a little lower
            words = [w + "&&%"[k % 3 :] if j % 3 == 0 else w for j, w in enumerate(words)]
        if toxic:
            words[draw.randrange(len(words))] = f"slur{k // 12 % 4}"
        rows.append((k, " ".join(words), "", "", 0))
        if k % 12 < 6:
            labels.append((k, int(not junk), int(toxic)))
    labels = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    kept = {r["doc_id"]: r["kept"] for r in quality_rules(frame(spark, rows), labels).collect()}
    held_out = [k for k in kept if k % 12 >= 6]
    assert not any(kept[k] for k in held_out if k % 6 in (1, 2))
    good = [kept[k] for k in held_out if k % 6 not in (1, 2)]
    assert sum(good) >= 0.95 * len(good)


def test_all_labelled_documents_are_counted(spark):
    """More labels a side than were once taken: the score is the ratio over every trusted document."""
    n = 21_000
    docs = spark.range(2 * n).selectExpr("id AS doc_id", "concat('w', id, ' v', id % 7) AS text")
    labels = spark.range(2 * n).selectExpr("id AS doc_id", "int(id < {0}) AS quality".format(n), "0 AS toxic")
    trusted = docs.where(F.col("doc_id") < n)
    ratio = log_ratios(trusted, docs)
    for row in quality_rules(docs, labels, threshold=0.0).where("doc_id % 1000 = 0").collect():
        words = f"w{row['doc_id']} v{row['doc_id'] % 7}".encode().split()
        assert row["score"] == pytest.approx(ratio[ngram_buckets(hash_words(words))].mean(), abs=1e-9)


def test_threshold_parts_all_scores(spark):
    draw = random.Random(5)
    rows = [(draw.randrange(-900, 900) / 300, draw.random() < 0.5) for _ in range(3000)]
    rows = [(s - 0.8 * (not good), good) for s, good in rows]
    found = Counter(rows)
    scores = sorted({s for s, _ in rows})
    table = [(s, found[s, True], found[s, False], math.floor(s * 512)) for s in scores]
    total = [sum(t[k] for t in table) for k in (1, 2)]
    parted = [
        sum(t[1] for t in table[k:]) / total[0] - sum(t[2] for t in table[k:]) / total[1]
        for k in range(len(table))
    ]
    at = max(range(len(table)), key=lambda k: (parted[k], k))
    want = (scores[at] + scores[max(at - 1, 0)]) / 2
    schema = "score double, good long, bad long, bin long"
    assert _parting(spark.createDataFrame(table, schema)) == want
    assert _parting(spark.createDataFrame(table[:0], schema)) == THRESHOLD


def test_words_of_all_judged_documents_can_tell(spark):
    """A word that one in 2,000 untrusted documents has tells at any size, one in 10,000 does not."""
    judged = spark.range(50_000).selectExpr(
        "concat('x', IF(id % 2000 = 0, ' often', ''), IF(id % 10000 = 1, ' rare', '')) AS text",
        "id >= 25000 AND id % 2 = 1 AS trusted",
    )
    told = telling_words(judged.unionByName(judged.selectExpr("'x' AS text", "true AS trusted")))
    assert set(told) == set(hash_words([b"often"]).view(np.int64))


def test_bit_map_keeps_every_labelled_document(spark):
    ids = [0, -1, -(2**63), 2**63 - 1, *range(5, 40_000, 7)]
    known = spark.createDataFrame([(k,) for k in ids], "doc_id long")
    docs = spark.range(40_000).selectExpr("id AS doc_id", "'x' AS text")
    docs = docs.union(known.where("doc_id < 0 OR doc_id > 40000").selectExpr("doc_id", "'x'"))
    docs = docs.union(spark.sql("SELECT CAST(null AS LONG), 'x'"))
    found = [r["doc_id"] for r in _perhaps_known(docs, known).collect()]
    assert set(ids) <= set(found) and len(found) < len(ids) + 300
