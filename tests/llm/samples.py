"""Small document tables with the awkward cases that every operator must define."""

from __future__ import annotations

import random
import re

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def prose(seed: int, words: int, vocabulary: int = 400) -> str:
    draw = random.Random(seed)
    return " ".join(f"w{draw.randrange(vocabulary)}" for _ in range(words))


def edited(text: str, seed: int, edits: int) -> str:
    draw, words = random.Random(seed), text.split(" ")
    for k in draw.sample(range(len(words)), edits):
        words[k] = f"e{seed}x{k}"
    return " ".join(words)


def documents() -> list[tuple]:
    base, other = prose(1, 120), prose(2, 90)
    passage = prose(3, 60)
    texts: list[str | None] = [None, "", "   \n\t ", "One", "two words", "Three short words"]
    texts += [base, base, base.upper(), edited(base, 4, 1), edited(base, 5, 3), edited(base, 6, 30)]
    texts += [f"{other} {passage}", f"{passage} {prose(7, 40)}", f"x {passage} y {passage} z"]
    texts += [prose(8, 3000), "a b c d e f g h " * 40, "same " * 200, "same " * 130]
    texts += [edited(base, 20 + k, k % 9) for k in range(30)]
    texts += [prose(100 + k, 10 + 7 * k) for k in range(20)]
    texts += ["ÄÖ straße x \x0b tab\tend", "x y 😀 z"]
    rows = [(k, t, "en", f"s{k % 4}" if k % 11 else None, 0) for k, t in enumerate(texts)]
    return [*rows, (6, base, "en", "s2", 0), (None, base, None, None, None)]


def frame(spark, rows: list[tuple] | None = None):
    """The sample with columns whose names operators use themselves."""
    df = spark.createDataFrame(documents() if rows is None else rows, SCHEMA)
    return df.selectExpr("*", "'x' AS kept", "1 AS node", "'y' AS key", "2 AS size", "3 AS mark")
