"""Personal data: pattern spans, and terms that disclose them by corpus co-occurrence.

Information-theoretic sanitisation: let ``n(e)``, ``n(t)`` and ``n(e, t)`` be the documents with a
protected entity (an e-mail, address, card or phone number), with a term, and with the term within
``REACH`` words of the entity.  The term discloses ``PMI(e; t) = log(n(e, t) N / (n(e) n(t)))`` of
the ``IC(e) = -log(n(e) / N)`` that the entity carries; at a share of 1 whoever sees the term knows
the entity.  In documents with the entity, terms from ``GENERAL`` of that information upwards are
generalised to their kind, and from ``REMOVE`` upwards removed, given ``SUPPORT`` documents.

Counts cover all documents.  Term counts leave a task as sums per term, and only for terms that
fall on a fixed-size bit map of the candidate terms (a filter of bounded size; the join that
follows is exact).
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from xxhash import xxh3_64_intdigest

from loadcast.llm.words import encode
from loadcast.session import materialise

REACH = 6
SUPPORT = 3
GENERAL = 0.6
REMOVE = 0.9
MAP_BITS = 1 << 20
KINDS = ("email", "ip", "card", "phone", "term")

_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
# A later digit of the same run never succeeds where its first digit fails.
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_WORD = re.compile(r"[^\x20\x09-\x0D]+")
_EDGES = b"!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"
_DIGITS = b"0123456789"


def _emails(text: str) -> list[tuple[int, int]]:
    """Each usable domain with the longest run of local characters before it."""
    found, at, floor = [], 0, 0
    while (domain := _DOMAIN.search(text, at)) is not None:
        start = domain.start()
        while start > floor and text[start - 1] in _LOCAL:
            start -= 1
        if start < domain.start():
            found.append((start, domain.end()))
            at = floor = domain.end()
        else:
            at = domain.start() + 1
    return found


def _luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        d = d * (1 + k % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def _only_digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """``(kind, start, end)`` in code points, by kind and then start."""
    spans = []
    if "@" in text:
        spans += [("email", a, b) for a, b in _emails(text)]
    raw = encode(text)
    if len(raw) == len(raw.translate(None, _DIGITS)):
        return spans
    for m in _IP.finditer(text) if "." in text else ():
        # Parts may be very long: leading zeros count for nothing, more than 3 digits are too large.
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m[0].split(".")):
            spans.append(("ip", m.start(), m.end()))
    for m in _CARD.finditer(text):
        digits = _only_digits(m[0])
        if 16 <= len(digits) <= 19 and _luhn(digits):
            spans.append(("card", m.start(), m.end()))
    for m in _PHONE.finditer(text) if "+" in text else ():
        if 8 <= len(_only_digits(m[0])) <= 15:
            spans.append(("phone", m.start(), m.end()))
    return spans


def _term(word: str) -> bytes:
    return encode(word).lower().strip(_EDGES)


def _entity(text: str, span: tuple[str, int, int]) -> int:
    kind, start, end = span
    value = text[start:end]
    value = value if kind == "ip" else _only_digits(value) if kind != "email" else value.lower()
    return _hash(encode(f"{kind}:{value}"))


def _hash(term: bytes) -> int:
    return np.uint64(xxh3_64_intdigest(term)).astype(np.int64).item()


def disclosures_near(text: str) -> list[tuple[int, list[int]]]:
    """Each protected entity of a text with the hashes of the terms around it."""
    spans = base_spans(text)
    if not spans:
        return []
    words = [(m.start(), m.end()) for m in _WORD.finditer(text)]
    starts = np.array([a for a, _ in words])
    ends = np.array([b for _, b in words])
    hidden = np.zeros(len(words), bool)
    places = []
    for _, a, b in spans:
        first, last = np.searchsorted(ends, a, "right"), np.searchsorted(starts, b, "left")
        hidden[first:last] = True
        places.append((first, last))
    found: dict[int, set[int]] = {}
    for span, (first, last) in zip(spans, places, strict=True):
        near = found.setdefault(_entity(text, span), set())
        for k in [*range(max(0, first - REACH), first), *range(last, min(len(words), last + REACH))]:
            if not hidden[k] and (term := _term(text[words[k][0] : words[k][1]])):
                near.add(_hash(term))
    return [(entity, sorted(terms)) for entity, terms in found.items()]


def _keyed(docs: DataFrame) -> DataFrame:
    """Rows that repeat a doc_id are told apart by a hash of their text."""
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), "text", F.hash("text").alias("mark")
    )


def _mentions(docs: DataFrame) -> DataFrame:
    """``doc_id, mark, entity, terms``: one row per document and entity."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            ids, marks = batch.column(0).to_pylist(), batch.column(2).to_pylist()
            for doc, mark, text in zip(ids, marks, batch.column(1), strict=True):
                near = disclosures_near(text.as_py() or "")
                rows += [(doc, mark, entity, terms) for entity, terms in near]
            kinds = [pa.int64(), pa.int32(), pa.int64(), pa.list_(pa.int64())]
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[k] for r in rows], kind) for k, kind in enumerate(kinds)],
                names=["doc_id", "mark", "entity", "terms"],
            )

    return _keyed(docs).mapInArrow(run, "doc_id long, mark int, entity long, terms array<long>")


def _term_documents(docs: DataFrame, candidates: DataFrame) -> DataFrame:
    """``term, n_term``: documents with each term, at least for all candidates."""
    slot = F.pmod("term", F.lit(MAP_BITS))
    used = np.zeros(MAP_BITS, bool)
    used[candidates.select(slot.alias("slot")).distinct().toArrow()["slot"].to_numpy()] = True
    sent = docs.sparkSession.sparkContext.broadcast(np.packbits(used))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.unpackbits(sent.value).astype(bool)
        total, held = [], 0

        def out() -> pa.RecordBatch:
            terms, counts = np.unique(np.concatenate(total or [[]]), return_counts=True)
            return pa.RecordBatch.from_arrays(
                [pa.array(terms.astype(np.int64)), pa.array(counts.astype(np.int64))],
                names=["term", "n"],
            )

        for batch in batches:
            for text in batch.column(0):
                terms = {w.strip(_EDGES) for w in encode(text.as_py()).lower().split()}
                found = np.fromiter(map(xxh3_64_intdigest, terms), np.uint64, len(terms))
                found = found.view(np.int64)
                found = found[bits[found % MAP_BITS]]
                total.append(found)
                held += len(found)
            if held > 2_000_000:
                yield out()
                total, held = [], 0
        yield out()

    partial = docs.select("text").mapInArrow(run, "term long, n long")
    return partial.groupBy("term").agg(F.sum("n").alias("n_term"))


def disclosing_terms(docs: DataFrame, mentions: DataFrame) -> DataFrame:
    """``entity, term, share``: terms that disclose at least ``GENERAL`` of an entity."""
    pairs = mentions.select("entity", F.explode("terms").alias("term"))
    both = pairs.groupBy("entity", "term").agg(F.count(F.lit(1)).alias("n_both"))
    both = materialise(both.where(F.col("n_both") >= SUPPORT), "pairs")
    each = mentions.groupBy("entity").agg(F.count(F.lit(1)).alias("n_entity"))
    terms = _term_documents(docs, both.select("term"))
    n = float(docs.count())
    pmi = F.log(F.col("n_both") * n / F.col("n_entity") / F.col("n_term"))
    carried = -F.log(F.col("n_entity") / n)
    share = F.when(carried > 0, pmi / carried)
    joined = both.join(each, "entity").join(terms, "term")
    return joined.select("entity", "term", share.alias("share")).where(F.col("share") >= GENERAL)


def _general(word: str) -> str:
    if any(c.isdigit() for c in word):
        return "[NUMBER]"
    return "[NAME]" if word[:1].isupper() else "[WORD]"


def sanitised(
    text: str, spans: list[tuple[str, int, int]], removed: set[tuple[int, int]]
) -> str:
    """Text with every span replaced: base spans by their kind, terms generalised or removed."""
    out, at = [], 0
    for kind, start, end in sorted(spans, key=lambda s: (s[1], -s[2])):
        if start < at:
            continue
        out.append(text[at:start])
        if kind != "term":
            out.append(f"[{kind.upper()}]")
        elif (start, end) not in removed:
            out.append(_general(text[start:end]))
        at = end
    return "".join([*out, text[at:]])


def _joined(spans: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for kind, start, end in spans)


COLUMNS = (
    "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, "
    "spans string, n_terms long, clean string"
)


def personal_data(docs: DataFrame) -> DataFrame:
    """Counts, digests, spans and sanitised text for each row of ``docs(doc_id, text)``.

    ``spans`` lists the base spans by kind and start, then ``term`` spans; a term never overlaps a
    base span.  Null is an empty text.  Copies count as documents of their own; a null doc_id is
    passed on and its row gets no term spans.  Other columns are ignored; an empty table gives no
    rows.
    """
    mentions = materialise(_mentions(docs), "mentions")
    telling = disclosing_terms(docs, mentions)
    found = mentions.where("doc_id IS NOT NULL").select("doc_id", "mark", "entity")
    listed = found.join(telling, "entity").groupBy("doc_id", "mark", "term").agg(
        F.max("share").alias("share")
    )
    listed = listed.groupBy("doc_id", "mark").agg(
        F.collect_list("term").alias("terms"), F.collect_list("share").alias("shares")
    )
    joined = _keyed(docs).join(listed, ["doc_id", "mark"], "left")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for doc, text, terms, shares in zip(*(batch.column(k) for k in range(4)), strict=True):
                text = text.as_py() or ""
                base = base_spans(text)
                more, removed = [], set()
                if terms.is_valid:
                    known = dict(zip(terms.as_py(), shares.as_py(), strict=True))
                    blocked = sorted((a, b) for _, a, b in base)
                    more, removed = term_spans(text, known, blocked)
                counts = [sum(kind == k for k, _, _ in base) for kind in KINDS[:4]]
                digest = hashlib.sha256(_joined(base).encode()).hexdigest()
                clean = sanitised(text, base + more, removed)
                rows.append((doc.as_py(), *counts, digest, _joined(base + more), len(more), clean))
            kinds = [pa.int64()] * 5 + [pa.string(), pa.string(), pa.int64(), pa.string()]
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[k] for r in rows], kind) for k, kind in enumerate(kinds)],
                names=[c.split()[0] for c in COLUMNS.split(", ")],
            )

    return joined.select("doc_id", "text", "terms", "shares").mapInArrow(run, COLUMNS)


def term_spans(
    text: str, known: dict[int, float], blocked: list[tuple[int, int]]
) -> tuple[list[tuple[str, int, int]], set[tuple[int, int]]]:
    """Spans of the disclosing terms outside the base spans, and those to be removed."""
    spans, removed, k = [], set(), 0
    for m in _WORD.finditer(text):
        while k < len(blocked) and blocked[k][1] <= m.start():
            k += 1
        if k < len(blocked) and blocked[k][0] < m.end():
            continue
        term = _term(m[0])
        share = known.get(_hash(term)) if term else None
        if share is not None:
            spans.append(("term", m.start(), m.end()))
            if share >= REMOVE:
                removed.add((m.start(), m.end()))
    return spans, removed
