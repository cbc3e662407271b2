"""Line dedup: later copies of repeated runs of lines are deleted. DataFrame functions only.

The lines with a word of each document are a sequence of line names. A run of ``k`` lines is named by
its first occurrence in the corpus, (row, place) of the least document id. Distributed prefix doubling
names longer runs: the name of ``2k`` lines is the pair of the names of its halves, and what has no
second occurrence drops out, since no longer run from there repeats either. An interval of equal names
holds all places of a repeated run. Naming stops at ``min_lines`` lines: at 2, single lines and pairs of
adjacent lines suffice for the deletion. Maximal runs and longest-common-prefix intervals are not made.

A line is deleted if it lies in a run that occurs earlier: a run of ``min_lines`` lines, or one line of
``min_words`` words. Runs longer than that are unions of such runs, so all of a later copy goes. Order is
by document id (nulls last), then row, then place.

Defined cases: a null text stays null; lines without a word are kept and part no run; a document all of
whose lines go keeps an empty text; of repeated rows the first stays whole; other columns are kept as
they are, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shoalgrid.llm.common import stage
from shoalgrid.operators.skew import lookup

WORD = r"[^\x20\x09-\x0D]+"


def _named(places: DataFrame, keys: list[str]) -> DataFrame:
    """Places whose key occurs twice or more, with the first of them as ``name``."""
    first = places.groupBy(*keys).agg(F.count("*").alias("n"), F.min("at").alias("name")).where("n > 1").drop("n")
    return lookup(places, first, keys, "inner").drop(*keys)


def _joined(runs: DataFrame, step: int) -> DataFrame:
    """Pairs of a run and the run that starts ``step`` lines later in the same document; keyed by both names."""
    second = runs.select(
        F.col("at.row").alias("row"), (F.col("at.j") - step).alias("j"), F.col("name").alias("name_b"), F.col("lines").alias("lines_b"))
    first = runs.select(F.col("at.row").alias("row"), F.col("at.j").alias("j"), "at", F.col("name").alias("name_a"), "lines")
    both = first.join(second, ["row", "j"])
    return both.select(
        "at", F.array_union("lines", "lines_b").alias("lines"), F.col("name_a.row").alias("ra"), F.col("name_a.j").alias("ja"),
        F.col("name_b.row").alias("rb"), F.col("name_b.j").alias("jb"))


def repeated_lines(rows: DataFrame, min_lines: int, min_words: int) -> DataFrame:
    """(row, gone) of ``rows`` (row, id, text): numbers of the lines to delete, from 0."""
    described = F.filter(
        F.transform(F.split("text", "\n", -1), lambda x, i: F.struct(
            i.alias("line"), F.regexp_count(x, F.lit(WORD)).alias("words"), F.xxhash64(x).alias("h"), F.xxhash64(F.lit(1), x).alias("g"))),
        lambda x: x["words"] > 0)
    places = rows.select("row", "id", F.posexplode(described).alias("j", "x")).select(
        F.struct(F.col("id").isNull().alias("none"), "id", "row", "j").alias("at"), F.array("x.line").alias("lines"),
        (F.col("x.words") >= min_words).alias("long"), "x.h", "x.g")
    runs = stage(_named(places, ["h", "g"]), "lines")
    later = runs.where("long and at != name").select("at.row", F.explode("lines").alias("line"))
    size = 1
    while size < min_lines:
        step = min(size, min_lines - size)
        size += step
        runs = stage(_named(_joined(runs, step), ["ra", "ja", "rb", "jb"]), f"runs-{size}")
    if min_lines > 1:
        later = later.unionByName(runs.where("at != name").select("at.row", F.explode("lines").alias("line")))
    elif min_lines == 1:
        later = runs.where("at != name").select("at.row", F.explode("lines").alias("line"))
    return later.groupBy("row").agg(F.collect_set("line").alias("gone"))


def dedup_lines(docs: DataFrame, min_lines: int = 2, min_words: int = 8, id_column: str = "doc_id", text_column: str = "text",
                counts_column: str = "line_counts") -> DataFrame:
    """``docs`` with later copies cut out of the text, and (n_lines, n_removed) as a struct in ``counts_column``.

    A column of the documents that has the name of ``counts_column`` is replaced.
    """
    spread = stage(docs.select(F.monotonically_increasing_id().alias("row"), F.struct("*").alias("doc")), "docs")
    rows = spread.select("row", F.col("doc")[id_column].alias("id"), F.col("doc")[text_column].alias("text"))
    gone = repeated_lines(rows, min_lines, min_words)
    lines = F.split(F.col("doc")[text_column], "\n", -1)
    kept = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), F.col("gone"))
    text = F.when(F.col("gone").isNull(), F.col("doc")[text_column]).otherwise(F.array_join(F.transform(kept, lambda i: lines[i]), "\n"))
    removed = F.coalesce(F.size("gone"), F.lit(0)).cast("long")
    counts = F.struct(F.when(F.col("doc")[text_column].isNull(), 0).otherwise(F.size(lines)).cast("long").alias("n_lines"),
                      F.when(F.col("gone").isNull(), 0).otherwise(removed).cast("long").alias("n_removed"))
    out = spread.join(gone, "row", "left")
    return out.select(*[text.alias(c) if c == text_column else F.col("doc")[c].alias(c) for c in docs.columns if c != counts_column], counts.alias(counts_column))


#: The same rows over the table ``documents``, in DuckDB's SQL.
SQL = """
WITH l AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) - 1 AS i FROM documents),
w AS (SELECT *, len(regexp_extract_all(line, '[^\\x20\\x09-\\x0D]+')) AS words FROM l),
s AS (SELECT *, lead(line) OVER (PARTITION BY doc_id ORDER BY i) AS nxt FROM w WHERE words > 0),
r AS (SELECT *, row_number() OVER (PARTITION BY line ORDER BY doc_id, i) AS one,
    CASE WHEN nxt IS NULL THEN 1 ELSE row_number() OVER (PARTITION BY line, nxt ORDER BY doc_id, i) END AS two FROM s),
d AS (SELECT doc_id, i, (one > 1 AND words >= 8) OR two > 1 OR coalesce(lag(two) OVER (PARTITION BY doc_id ORDER BY i) > 1, false) AS gone FROM r),
t AS (SELECT l.doc_id, string_agg(l.line, chr(10) ORDER BY l.i) FILTER (WHERE NOT coalesce(d.gone, false)) AS kept,
    count(*) AS n_lines, count(*) FILTER (WHERE d.gone) AS n_removed FROM l LEFT JOIN d ON l.doc_id = d.doc_id AND l.i = d.i GROUP BY l.doc_id)
SELECT o.doc_id, CASE WHEN o.text IS NULL THEN NULL ELSE coalesce(t.kept, '') END AS text, coalesce(t.n_lines, 0) AS n_lines, coalesce(t.n_removed, 0) AS n_removed
FROM documents o LEFT JOIN t ON o.doc_id = t.doc_id"""
