"""Language identification by Bayesian fusion of text, declaration, address and host.

* Text: naive Bayes over hashed byte trigrams, fitted on a sample of about ``FIT_ROWS`` labelled
  rows, drawn by language so that each one is known at every size; the mean log-likelihood counts as ``TEMPER`` trigrams at most, as neighbouring
  trigrams are not independent.
* Declared language (markup or metadata): right with probability ``DECLARED``.
* Address: a country suffix, or a language as first path segment; right with ``ADDRESS``.
* Host: the share of each language among the host's documents by text alone, smoothed towards the
  parent domain and that towards the whole corpus (``STRENGTH`` pseudo-documents each), from
  grouped aggregation over all documents.

* Unknown: a text whose mean log-likelihood per trigram lies ``FAR`` deviations (and ``APART``) below what the fitted
  rows of its likeliest language have when they are left out of the counts fits none of the
  languages.  The deviation adds the spread between rows and that of the text's own trigrams, so a
  short text has to be further off; one below ``TELLING`` trigrams cannot tell.

Documents without letters, those that fit no language, and those whose best language stays below
``LEAST`` are rejected.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loadcast.llm.sampling import hashed_sample_by
from loadcast.llm.words import encode
from loadcast.session import materialise

FIT_ROWS = 4000
FIT_LEAST = 120  # rows of a language, where it has as many
BUCKETS = 1 << 14
TEMPER = 60
DECLARED = 0.8
ADDRESS = 0.7
STRENGTH = 20.0
LEAST = 0.5
FAR = 6.0
USUAL_ROWS = 80  # the spread of fewer rows is too uncertain to reject by
APART = 2.0
TELLING = 12
OVERLAP = 3.0  # neighbouring trigrams are not independent

# Country suffixes and the language most used there.
SUFFIXES = {
    "at": "de", "au": "en", "ca": "en", "ch": "de", "cl": "es", "co": "es", "de": "de",
    "es": "es", "fr": "fr", "ie": "en", "mx": "es", "nz": "en", "pe": "es", "uk": "en", "us": "en",
}

# Lower case; ASCII other than letters becomes a blank.
_FOLD = bytes(
    c + 32 if 65 <= c <= 90 else c if c >= 128 or 97 <= c <= 122 else 32 for c in range(256)
)


def trigrams(text: str | None, buckets: int = BUCKETS) -> np.ndarray:
    """Buckets of the byte trigrams of a text, blanks squeezed; empty without letters."""
    words = encode(text).translate(_FOLD).split()
    if not words:
        return np.empty(0, np.int64)
    raw = np.frombuffer(b" " + b" ".join(words) + b" ", np.uint8).astype(np.uint32)
    code = (raw[:-2] << np.uint32(16)) | (raw[1:-1] << np.uint32(8)) | raw[2:]
    return ((code * np.uint32(2654435761)) >> np.uint32(12)).astype(np.int64) % buckets


class Model:
    """Log-likelihood of every trigram bucket under every language (a fixed number of values).

    ``usual`` holds the mean log-likelihood per trigram of each language's own rows, its variance
    between rows, and that between the trigrams of a row.
    """

    def __init__(self, languages: list[str], table: np.ndarray, usual: np.ndarray) -> None:
        self.languages, self.table, self.usual = languages, table, usual

    def log_likelihood(self, text: str | None) -> tuple[int, np.ndarray, bool]:
        """Trigrams of a text, the tempered log-likelihood per language, and whether one fits."""
        found = trigrams(text, len(self.table))
        n = len(found)
        if n == 0 or not self.languages:
            return 0, np.zeros(len(self.languages)), False
        counts = np.bincount(found, minlength=len(self.table))
        mean = counts @ self.table / n
        usual, between, within = self.usual[:, mean.argmax()]
        least = usual - max(APART, FAR * np.sqrt(between + OVERLAP * within / n))
        return n, mean * min(n, TEMPER), n < TELLING or bool(mean.max() >= least)


def fit(labelled: DataFrame, rows: int = FIT_ROWS, buckets: int = BUCKETS) -> Model:
    """``labelled(doc_id, text, lang)``: about ``rows`` rows are used, chosen by hash.

    Languages share them evenly; one with few labelled rows has all of them in the model.
    """
    known = labelled.where("lang IS NOT NULL AND text IS NOT NULL")
    known = known.select("doc_id", "text", "lang")
    sample = hashed_sample_by(known, rows, FIT_LEAST, "lang", "doc_id", "text")
    # Written once: it is read for the counts and again for the fit of each row.
    sample = materialise(sample.select("text", "lang"), "fitted")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[str, np.ndarray] = {}
        for batch in batches:
            for text, lang in zip(batch.column(0), batch.column(1), strict=True):
                counts = np.bincount(trigrams(text.as_py(), buckets), minlength=buckets)
                lang = lang.as_py()
                total[lang] = total[lang] + counts if lang in total else counts
        for lang, counts in total.items():
            used = np.flatnonzero(counts)
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(used), pa.string()), pa.array(used), pa.array(counts[used])],
                names=["lang", "bucket", "n"],
            )

    counted = sample.mapInArrow(run, "lang string, bucket long, n long")
    rows = counted.groupBy("lang", "bucket").agg(F.sum("n").alias("n")).collect()
    languages = sorted({r["lang"] for r in rows})
    table = np.full((buckets, len(languages)), 0.5)
    for r in rows:
        table[r["bucket"], languages.index(r["lang"])] += r["n"]
    if not languages:
        return Model(languages, table, np.zeros((3, 0)))
    return Model(languages, np.log(table / table.sum(axis=0)), _usual(sample, languages, table))


def _usual(sample: DataFrame, languages: list[str], table: np.ndarray) -> np.ndarray:
    """``Model.usual`` from the fitted rows, each judged by the counts of the others."""
    sent = sample.sparkSession.sparkContext.broadcast(table)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = sent.value
        total = table.sum(axis=0)
        for batch in batches:
            rows = []
            for text, lang in zip(batch.column(0), batch.column(1), strict=True):
                used, n = np.unique(trigrams(text.as_py(), len(table)), return_counts=True)
                if n.sum() < TELLING:
                    continue
                k = languages.index(lang.as_py())
                logs = np.log((table[used, k] - n) / (total[k] - n.sum()))
                mean = (logs @ n) / n.sum()
                rows.append((k, mean, ((logs - mean) ** 2 @ n) / n.sum()))
            kinds = [pa.int64(), pa.float64(), pa.float64()]
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[j] for r in rows], kind) for j, kind in enumerate(kinds)],
                names=["k", "mean", "within"],
            )

    judged = sample.mapInArrow(run, "k long, mean double, within double").toArrow()
    which, mean, within = (judged[name].to_numpy() for name in ("k", "mean", "within"))
    # A language with too few rows of telling length rejects nothing.
    usual = np.stack([np.full(len(languages), -np.inf), *np.zeros((2, len(languages)))])
    for k in np.unique(which):
        own = mean[which == k]
        if len(own) < USUAL_ROWS:
            continue
        # Medians: some rows carry a wrong label.
        middle = np.median(own)
        between = (1.4826 * np.median(np.abs(own - middle))) ** 2
        usual[:, k] = middle, between, np.median(within[which == k])
    return usual


def suffix_language(url: Column) -> Column:
    """Language that an address points to: first path segment, else country suffix, else null."""
    path = F.regexp_extract(url, r"^[a-z]+://[^/]*/([a-z]{2})(?:/|$)", 1)
    suffix = F.regexp_extract(url, r"^[a-z]+://[^/:]*\.([a-z]{2})(?:[:/]|$)", 1)
    known = F.create_map(*[F.lit(x) for pair in SUFFIXES.items() for x in pair])
    return F.when(path != "", path).otherwise(F.try_element_at(known, suffix))


def host_of(url: Column) -> Column:
    return F.nullif(F.regexp_extract(url, r"^[a-z]+://([^/:]*)", 1), F.lit(""))


def _log_odds(claim: Column, languages: list[str], right: float) -> list[Column]:
    """Log-likelihood of a claimed language; a missing or unknown claim says nothing."""
    wrong = (1.0 - right) / max(1, len(languages) - 1)
    known = F.coalesce(claim.isin(languages), F.lit(False))
    return [
        F.when(known, F.when(claim == name, np.log(right)).otherwise(np.log(max(wrong, 1e-9))))
        .otherwise(0.0)
        for name in languages
    ]


def _priors(texted: DataFrame, languages: list[str]) -> DataFrame:
    """``host, prior``: smoothed share of each language by host, domain and corpus."""
    sums = [F.sum(F.col("by_text")[k]).alias(f"s{k}") for k in range(len(languages))]
    hosts = texted.where("fits").groupBy("host", "parent").agg(*sums, F.count(F.lit(1)).alias("m"))
    hosts = materialise(hosts, "hosts")

    def rolled(df: DataFrame, *keys: str) -> DataFrame:
        more = [F.sum(f"s{k}").alias(f"s{k}") for k in range(len(languages))]
        return df.groupBy(*keys).agg(*more, F.sum("m").alias("m"))

    top = rolled(hosts).first()
    total = float(top["m"] or 0)
    whole = [
        ((top[f"s{k}"] or 0.0) + 1.0) / (total + len(languages)) for k in range(len(languages))
    ]
    parents = rolled(hosts, "parent").select(
        F.col("parent").alias("above"),
        F.array(
            *[
                (F.col(f"s{k}") + STRENGTH * share) / (F.col("m") + STRENGTH)
                for k, share in enumerate(whole)
            ]
        ).alias("parent_prior"),
    )
    joined = hosts.join(parents, F.col("parent").eqNullSafe(F.col("above")))
    prior = [
        (F.col(f"s{k}") + STRENGTH * F.col("parent_prior")[k]) / (F.col("m") + STRENGTH)
        for k in range(len(languages))
    ]
    return materialise(
        joined.select(F.col("host").alias("of_host"), F.array(*prior).alias("prior")), "priors"
    )


def identify(
    docs: DataFrame,
    model: Model,
    keys: list[str],
    text: Column,
    declared: Column | None = None,
    address: Column | None = None,
    host: Column | None = None,
) -> DataFrame:
    """``keys`` with ``language, confidence, kept`` for each row of ``docs``.

    ``text``, ``declared`` (a language code), ``address`` (a URL) and ``host`` are expressions over
    ``docs``; any of them may be null.  Host ``a.b.example.com`` has the parent ``example.com``.
    A text without letters, or that fits none of the languages, has language null, confidence 0 and
    is not kept; so has every row when the model knows no language.  Rows are judged each, repeated or not; a null host is a host of
    its own.  An empty table gives no rows.
    """
    none = F.lit(None).cast("string")
    declared, address = (none if c is None else c for c in (declared, address))
    host = F.coalesce(host_of(address), none) if host is None else host
    languages = model.languages
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = sent.value
        for batch in batches:
            n, logs, shares, fits = [], [], [], []
            for value in batch.column(batch.num_columns - 1):
                size, log, fit = known.log_likelihood(value.as_py())
                share = np.exp(log - log.max()) if len(log) else log
                n.append(size)
                fits.append(fit)
                logs.append(log.tolist())
                shares.append((share / share.sum()).tolist() if len(log) else [])
            kind = pa.list_(pa.float64())
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], pa.array(n, pa.int64()), pa.array(logs, kind),
                 pa.array(shares, kind), pa.array(fits, pa.bool_())],
                names=[*batch.schema.names[:-1], "n", "log", "by_text", "fits"],
            )

    given = docs.select(
        *keys,
        F.lower(declared).alias("declared"),
        F.lower(address).alias("address"),
        F.lower(host).alias("host"),
        text.alias("text"),
    )
    head = given.drop("text")
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in head.schema)
    texted = given.mapInArrow(
        run, f"{fields}, n long, log array<double>, by_text array<double>, fits boolean"
    )
    texted = texted.withColumn("parent", F.regexp_extract("host", r"([^.]+\.[^.]+)$", 1))
    texted = materialise(texted, "texted")
    if not languages:
        nothing = [none.alias("language"), F.lit(0.0).alias("confidence"), F.lit(False).alias("kept")]
        return texted.select(*keys, *nothing)
    priors = _priors(texted, languages)
    joined = texted.join(priors, F.col("host").eqNullSafe(F.col("of_host")), "left")
    said = _log_odds(F.col("declared"), languages, DECLARED)
    pointed = _log_odds(suffix_language(F.col("address")), languages, ADDRESS)
    scores = [
        F.col("log")[k] + said[k] + pointed[k] + F.coalesce(F.log(F.col("prior")[k]), F.lit(0.0))
        for k in range(len(languages))
    ]
    joined = joined.withColumn("scores", F.array(*scores)).withColumn("top", F.array_max("scores"))
    names = F.array(*map(F.lit, languages))
    language = F.when(
        F.col("fits"), F.element_at(names, F.array_position("scores", F.col("top")).cast("int"))
    )
    mass = F.aggregate(
        "scores", F.lit(0.0), lambda sum_, score: sum_ + F.exp(score - F.col("top"))
    )
    confidence = F.when(F.col("fits"), 1.0 / mass).otherwise(0.0)
    return joined.select(
        *keys, language.alias("language"), confidence.alias("confidence")
    ).withColumn("kept", F.col("confidence") >= LEAST)
