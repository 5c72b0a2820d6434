"""Line dedup by a log-template tree: recurring templates across documents are dropped.

The tree has fixed depth: token count, then the first ``DEPTH`` tokens, with tokens that hold a
digit read as variable.  What follows is cut into at most ``FIELDS`` fields.  In each leaf the
most frequent value of a field is the template's (none, if two are equally frequent); a line
belongs to the template when at least ``SIMILAR`` percent of its fields agree with it.  A template that occurs
in ``MIN_DOCS`` documents or more is dropped from all but the smallest of them.

A leaf holds as many templates as recur: its lines that are in no recurring template go on to leaves
of their own, one for each field value (of those in most documents each line takes its first), and
these are judged in the same way.  A path fixes one field more at every level, so there are at most
``FIELDS`` levels below the tree, and lines whose fields are all equal stay together on it: if they
occur in enough documents, they end in a recurring template.

Only hashes of leaves and fields are shuffled before the last step.  Counts are combined before
each shuffle; equal lines of a leaf vote as one weighted row, so a line that a third of all
documents share costs no more than others.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loadcast.session import materialise

DEPTH = 3
FIELDS = 8
SIMILAR = 60
MIN_TOKENS = 3
MIN_DOCS = 10

_GAP = r"[\x20\x09-\x0D]+"
_VARIABLE = r"(?<![^\x20\x09-\x0D])[^\x20\x09-\x0D0-9]*+[0-9][^\x20\x09-\x0D]*"


def tokens_of(line: Column) -> Column:
    """Tokens of a line; those with a digit are the variable token ``<*>``."""
    general = F.when(line.rlike("[0-9]"), F.regexp_replace(line, _VARIABLE, "<*>")).otherwise(line)
    return F.filter(F.split(general, _GAP), lambda token: token != "")


def parsed_lines(docs: DataFrame) -> DataFrame:
    """``doc_id, mark, at, leaf, fields`` of the lines with at least ``MIN_TOKENS`` tokens."""
    lines = docs.where("doc_id IS NOT NULL").select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.hash("text").alias("mark"),
        F.posexplode(F.split("text", "\n")).alias("at", "line"),
    )
    lines = lines.select("doc_id", "mark", "at", tokens_of(F.col("line")).alias("tokens"))
    lines = lines.where(F.size("tokens") >= MIN_TOKENS)
    rest = F.size("tokens") - DEPTH
    width = F.greatest(F.lit(1), F.ceil(rest / F.lit(float(FIELDS))).cast("int"))
    return (
        lines.withColumn("rest", rest)
        .withColumn("width", width)
        .select(
            "doc_id",
            "mark",
            "at",
            F.xxhash64(
                F.concat_ws(" ", F.size("tokens"), F.slice("tokens", 1, DEPTH))
            ).alias("leaf"),
            F.expr(
                f"""CASE WHEN rest <= 0 THEN CAST(array() AS ARRAY<BIGINT>) ELSE
                transform(sequence(0, CAST(ceil(rest / width) AS INT) - 1), j -> xxhash64(
                  array_join(slice(tokens, CAST({DEPTH} + 1 + j * width AS INT), width), ' ')))
                END"""
            ).alias("fields"),
        )
    )


def _recurring(rows: DataFrame, min_docs: int) -> DataFrame:
    """``leaf, first``: leaves that occur in enough documents."""
    once = rows.select("leaf", "doc_id", "mark").distinct()
    counted = once.groupBy("leaf").agg(
        F.count(F.lit(1)).alias("n_docs"), F.min("doc_id").alias("first")
    )
    return counted.where(F.col("n_docs") >= min_docs).select("leaf", "first")


def templates(lines: DataFrame) -> DataFrame:
    """``leaf, template``: the most frequent value of every field, NULL if there are two."""
    patterns = lines.groupBy("leaf", "fields").agg(F.count(F.lit(1)).alias("n"))
    votes = patterns.select("leaf", "n", F.posexplode("fields").alias("j", "value"))
    votes = votes.groupBy("leaf", "j", "value").agg(F.sum("n").alias("n"))
    # Among the most frequent values the largest and the smallest: one value, if they are equal.
    best = votes.groupBy("leaf", "j").agg(
        F.max(F.struct("n", "value")).alias("high"),
        F.max(F.struct("n", F.bitwise_not("value").alias("value"))).alias("low"),
    )
    value = F.col("high.value")
    only = F.when(value == F.bitwise_not(F.col("low.value")), value)
    ordered = F.array_sort(F.collect_list(F.struct("j", only.alias("value"))))
    return best.groupBy("leaf").agg(F.transform(ordered, lambda x: x["value"]).alias("template"))


def _deeper(rest: DataFrame, min_docs: int) -> DataFrame:
    """``rest`` in leaves one level further down: by the free field value in most documents.

    Values in fewer than ``min_docs`` documents lead to no recurring template; lines that have no
    other ones are left out.
    """
    free = "shiftright(taken, j) % 2 = 0"
    texts = rest.select("leaf", "taken", "doc_id", "mark", F.posexplode("fields").alias("j", "value"))
    once = texts.where(free).select("leaf", "j", "value", "doc_id", "mark").distinct()
    often = once.groupBy("leaf", "j", "value").agg(F.count(F.lit(1)).alias("n_docs"))
    often = materialise(often.where(F.col("n_docs") >= min_docs), "values")
    patterns = rest.select("leaf", "taken", "fields").distinct()
    cells = patterns.select("leaf", "taken", "fields", F.posexplode("fields").alias("j", "value"))
    chosen = cells.where(free).join(often, ["leaf", "j", "value"]).groupBy("leaf", "fields").agg(
        F.max(F.struct("n_docs", (-F.col("j")).alias("j"), "value")).alias("top")
    )
    j = -F.col("top.j")
    return rest.join(materialise(chosen, "chosen"), ["leaf", "fields"]).select(
        "doc_id",
        "mark",
        "at",
        F.xxhash64("leaf", j, "top.value").alias("leaf"),
        "fields",
        (F.col("taken") + F.expr("shiftleft(1, -top.j)")).alias("taken"),
    )


def template_lines(docs: DataFrame, min_docs: int = MIN_DOCS, similar: int = SIMILAR) -> DataFrame:
    """``doc_id, mark, dropped``: positions of the lines to drop, for documents that have any."""
    lines = materialise(parsed_lines(docs), "lines").withColumn("taken", F.lit(0))
    agreeing = F.expr("size(filter(zip_with(fields, template, (a, b) -> a = b), x -> x))")
    near = (F.size("fields") == 0) | (100 * agreeing >= similar * F.size("fields"))
    dropped = None
    while True:
        candidates = materialise(_recurring(lines, min_docs).select("leaf"), "leaves")
        if dropped is not None and candidates.isEmpty():
            break
        lines = materialise(lines.join(candidates, "leaf"), "candidates")
        known = materialise(templates(lines), "templates")
        judged = lines.join(known, "leaf", "left").withColumn("near", F.coalesce(near, F.lit(False)))
        members = judged.where("near").select("doc_id", "mark", "at", "leaf")
        members = materialise(members, "members")
        recurring = materialise(_recurring(members, min_docs), "recurring")
        gone = members.join(recurring, "leaf").where(F.col("doc_id") > F.col("first"))
        gone = gone.select("doc_id", "mark", "at")
        dropped = gone if dropped is None else dropped.unionByName(gone)
        # Lines in no recurring template go on, if there is a field left to part them by.
        rest = judged.join(recurring, "leaf", "left").where("NOT near OR first IS NULL")
        rest = rest.where("bit_count(taken) < size(fields)")
        rest = rest.select("doc_id", "mark", "at", "leaf", "fields", "taken")
        held = materialise(_recurring(rest, min_docs).select("leaf"), "held")
        if held.isEmpty():
            break
        lines = materialise(_deeper(materialise(rest.join(held, "leaf"), "rest"), min_docs), "lines")
    return dropped.groupBy("doc_id", "mark").agg(F.array_sort(F.collect_set("at")).alias("dropped"))


def without_templates(
    docs: DataFrame, min_docs: int = MIN_DOCS, similar: int = SIMILAR
) -> DataFrame:
    """``doc_id, n_lines, n_dropped, dropped, kept`` for each row of ``docs(doc_id, text)``.

    ``dropped`` holds line positions from 0, ``kept`` is the text without them.  A null text has no
    lines and stays null; an empty one has one line.  Lines with fewer than ``MIN_TOKENS`` tokens
    are never dropped.  Every template of a leaf that recurs is dropped, not only its most frequent
    one.  Rows that repeat a doc_id with other text count as documents of their own;
    a row without doc_id neither counts nor loses lines.  Other columns are ignored; an empty table
    gives no rows.
    """
    texts = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), "text", F.hash("text").alias("mark")
    )
    joined = texts.join(template_lines(docs, min_docs, similar), ["doc_id", "mark"], "left")
    split = F.split("text", "\n")
    kept = F.array_join(
        F.filter(split, lambda line, k: ~F.array_contains("dropped", k)), "\n"
    )
    gone = F.coalesce("dropped", F.expr("CAST(array() AS ARRAY<INT>)"))
    return joined.select(
        "doc_id",
        F.coalesce(F.size(split), F.lit(0)).cast("long").alias("n_lines"),
        F.size(gone).cast("long").alias("n_dropped"),
        gone.alias("dropped"),
        F.when(F.size(gone) > 0, kept).otherwise(F.col("text")).alias("kept"),
    )


LINES_SQL = rf"""
WITH lines AS (
  SELECT doc_id, unnest(string_split(text, chr(10))) AS line,
         generate_subscripts(string_split(text, chr(10)), 1) - 1 AS pos
  FROM documents WHERE doc_id IS NOT NULL AND text IS NOT NULL),
tokens AS (
  SELECT doc_id, pos, list_filter(string_split_regex(CASE WHEN regexp_matches(line, '[0-9]')
    THEN regexp_replace(line, '(^|[\x20\x09-\x0D])[^\x20\x09-\x0D]*[0-9][^\x20\x09-\x0D]*',
                        '\1<*>', 'g') ELSE line END, '{_GAP}'), lambda x: x <> '') AS t
  FROM lines),
sized AS (
  SELECT doc_id, pos, t, len(t) || ' ' || array_to_string(t[1:{DEPTH}], ' ') AS leaf,
         len(t) - {DEPTH} AS rest, greatest(1, CAST(ceil((len(t) - {DEPTH}) / {FIELDS}.0) AS INT)) AS width
  FROM tokens WHERE len(t) >= {MIN_TOKENS}),
parsed AS (
  SELECT doc_id, pos, leaf, list_transform(range(CAST(ceil(rest / (width * 1.0)) AS INT)), lambda j:
         array_to_string(t[{DEPTH} + 1 + j * width : {DEPTH} + (j + 1) * width], ' ')) AS fields
  FROM sized WHERE leaf IN (
    SELECT leaf FROM sized GROUP BY leaf HAVING count(DISTINCT doc_id) >= {MIN_DOCS})),
cells AS (
  SELECT doc_id, pos, leaf, unnest(fields) AS value, generate_subscripts(fields, 1) AS j FROM parsed),
votes AS (SELECT leaf, j, value, count(*) AS n FROM cells GROUP BY ALL),
best AS (
  SELECT leaf, j, any_value(value) AS value FROM (
    SELECT *, max(n) OVER (PARTITION BY leaf, j) AS most FROM votes) WHERE n = most
  GROUP BY leaf, j HAVING count(*) = 1),
near AS (
  SELECT c.doc_id, c.pos, c.leaf FROM cells c LEFT JOIN best b
    ON c.leaf = b.leaf AND c.j = b.j AND c.value = b.value
  GROUP BY ALL HAVING 100 * count(b.value) >= {SIMILAR} * count(*)),
members AS (
  SELECT * FROM near UNION ALL SELECT doc_id, pos, leaf FROM parsed WHERE len(fields) = 0),
recurring AS (
  SELECT leaf, min(doc_id) AS first FROM members GROUP BY leaf
  HAVING count(DISTINCT doc_id) >= {MIN_DOCS}),
dropped AS (
  SELECT m.doc_id, list(m.pos) AS gone FROM members m JOIN recurring r ON m.leaf = r.leaf
  WHERE m.doc_id > r.first GROUP BY m.doc_id)
SELECT d.doc_id, coalesce(len(string_split(text, chr(10))), 0) AS n_lines,
       coalesce(len(gone), 0) AS n_dropped,
       CASE WHEN gone IS NULL THEN text ELSE array_to_string(list_transform(
         list_filter(range(len(string_split(text, chr(10)))), lambda k: NOT list_contains(gone, k)),
         lambda k: string_split(text, chr(10))[k + 1]), chr(10)) END AS kept
FROM documents d LEFT JOIN dropped USING (doc_id)
"""
