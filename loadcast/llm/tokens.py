"""Token counts by a public tokenizer, in Arrow functions that return lengths only.

Texts longer than ``PIECE`` characters are cut where the pre-tokenizer always cuts: before a
single space between two ASCII letters (that space belongs to the word that follows, and no
special string contains one).  Pieces are encoded in batches of about ``BATCH_BYTES`` bytes, so
neither a long text nor many of them make a large batch.
"""

from __future__ import annotations

import os
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

PIECE = 4_096
BATCH_BYTES = 262_144

_SAFE = re.compile(r"(?<=[A-Za-z]) (?=[A-Za-z])")


def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def pieces(text: str) -> list[str]:
    """The text cut at safe boundaries into pieces of ``PIECE`` characters or a little more."""
    out, start = [], 0
    while len(text) - start > PIECE:
        cut = _SAFE.search(text, start + PIECE)
        if cut is None:
            break
        out.append(text[start : cut.start()])
        start = cut.start()
    out.append(text[start:])
    return out


class Counter:
    """Loads the tokenizer once per worker process."""

    _loaded: dict[str, object] = {}

    def __init__(self, name: str) -> None:
        path = tokenizer_path(name)
        if path not in self._loaded:
            os.environ["TOKENIZERS_PARALLELISM"] = "false"
            if path.endswith(".json"):
                from tokenizers import Tokenizer

                model = Tokenizer.from_file(path)
                model.no_truncation()
                model.no_padding()
            else:
                from sentencepiece import SentencePieceProcessor

                model = SentencePieceProcessor(model_file=path)
            self._loaded[path] = model
        self.model, self.cuts = self._loaded[path], path.endswith(".json")

    def lengths(self, batch: list[str]) -> list[int]:
        if self.cuts:
            found = self.model.encode_batch_fast(batch, add_special_tokens=False)
            return [len(x) for x in found]
        return [len(x) for x in self.model.encode(batch, num_threads=1)]

    def counts(self, texts: Iterator[str]) -> list[int]:
        """Tokens of each text; only one batch of pieces is held at a time."""
        totals: list[int] = []
        batch, owner, held = [], [], 0

        def flush() -> None:
            for k, n in zip(owner, self.lengths(batch), strict=True):
                totals[k] += n
            batch.clear(), owner.clear()

        for k, text in enumerate(texts):
            totals.append(0)
            for piece in pieces(text) if self.cuts else [text]:
                batch.append(piece)
                owner.append(k)
                held += len(piece)
                if held >= BATCH_BYTES:
                    flush()
                    held = 0
        if batch:
            flush()
        return totals


def token_counts(
    docs: DataFrame, tokenizer: str = "byte_bpe_50k.json", limit: int = 512
) -> DataFrame:
    """``doc_id, n_bytes, n_tokens, over_limit`` for each row of ``docs(doc_id, text)``.

    Null is an empty text (0 tokens).  Rows keep their order and number, repeated or not; a null
    doc_id is passed on.  Other columns are ignored; an empty table gives no rows.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = Counter(tokenizer)
        for batch in batches:
            tokens = counter.counts(x.as_py() or "" for x in batch.column(1))
            over = np.array(tokens, np.int64) > limit
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(2), pa.array(tokens, pa.int64()), pa.array(over)],
                names=["doc_id", "n_bytes", "n_tokens", "over_limit"],
            )

    size = F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes")
    kinds = docs.select("doc_id").schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text", size).mapInArrow(
        run, f"doc_id {kinds}, n_bytes long, n_tokens long, over_limit boolean"
    )
