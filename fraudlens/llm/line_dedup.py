"""Line de-duplication with DataFrame functions only.

Normalised lines are exploded and hashed, documents are counted per hash, and lines over the
threshold leave every document but one.  Texts are cut by the positions of what goes, so a
text crosses the network once, with its own row.

Defined cases: a null or empty text is one empty line; the key of a line is hashed to 128 bits;
a row without ``doc_id`` counts as no document and never keeps a repeated line; rows that share
a ``doc_id`` are one document, and each is cut by its own lines; an empty table gives an empty
table; an input column named like an added one is replaced.
"""

from __future__ import annotations

from string import ascii_lowercase, ascii_uppercase

from pyspark.sql import Column, DataFrame, functions as F

SPACES = " \t\n\x0b\x0c\r"


def lines_of(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n")


def line_key(line: Column) -> Column:
    """The line without white space at its ends, A-Z in lower case."""
    bare = F.btrim(line, F.lit(SPACES))
    plain = F.octet_length(bare) == F.length(bare)  # all ASCII: the fast function does the same
    return F.when(plain, F.lower(bare)).otherwise(F.translate(bare, ascii_uppercase, ascii_lowercase))


def exploded(docs: DataFrame, min_chars: int) -> DataFrame:
    """One row per line whose key is long enough: document, its text's hash, position, key hashes."""
    line = docs.select(
        F.col("doc_id").alias("doc"),
        F.xxhash64("text").alias("version"),
        F.posexplode(lines_of(F.col("text"))).alias("at", "line"),
    ).where(F.length("line") >= min_chars)
    keyed = line.select("doc", "version", "at", line_key(F.col("line")).alias("key")).where(F.length("key") >= min_chars)
    return keyed.select("doc", "version", "at", F.xxhash64("key").alias("h1"), F.xxhash64(F.lit(1), "key").alias("h2"))


def without_lines(lines: Column, cuts: Column) -> Column:
    """``lines`` without the positions in the sorted array ``cuts``; time linear in both.

    What a lambda takes from outside is computed again for every element, so the lines go in as the
    one element of an outer array: the text is split once, not once a cut.
    """
    def pieces(own: Column) -> Column:
        def piece(k: Column) -> Column:
            start = F.when(k == 0, F.lit(0)).otherwise(F.get(cuts, k - 1) + 1)
            end = F.coalesce(F.get(cuts, k), F.size(own))
            return F.slice(own, start + 1, end - start)

        return F.flatten(F.transform(F.sequence(F.lit(0), F.size(cuts)), piece))

    return F.flatten(F.transform(F.array(lines), pieces))


def mark_repeated_lines(docs: DataFrame, min_chars: int = 40, min_docs: int = 5) -> DataFrame:
    """``docs`` with ``dropped_lines``, the sorted positions to drop (null if none), and ``kept_text``.

    A key of at least ``min_chars`` code points held by at least ``min_docs`` documents loses its
    lines in all of them except the one with the largest ``doc_id``.
    """
    rows = exploded(docs, min_chars)
    frequent = (
        rows.groupBy("h1", "h2")
        .agg(F.count_distinct("doc").alias("holders"), F.max("doc").alias("keeper"))
        .where(F.col("holders") >= min_docs)
        .select("h1", "h2", "keeper")
    )
    dropped = (
        rows.join(frequent, ["h1", "h2"])
        .where(~F.col("doc").eqNullSafe(F.col("keeper")))
        .groupBy("doc", "version")
        .agg(F.array_sort(F.collect_set("at")).alias("cuts"))
    )
    base, gone = docs.drop("dropped_lines", "kept_text").alias("__docs"), dropped.alias("__gone")
    text, cuts = F.col("__docs.text"), F.col("__gone.cuts")
    same_row = F.col("__docs.doc_id").eqNullSafe(F.col("__gone.doc")) & (F.xxhash64(text) == F.col("__gone.version"))
    kept = F.array_join(without_lines(lines_of(text), cuts), "\n")
    return base.join(gone, same_row, "left").select(
        "__docs.*",
        cuts.alias("dropped_lines"),
        F.when(cuts.isNull(), F.coalesce(text, F.lit(""))).otherwise(kept).alias("kept_text"),
    )


def dedup_lines(docs: DataFrame, min_chars: int = 40, min_docs: int = 5) -> DataFrame:
    """The documents with their repeated lines removed: same rows, same columns, whatever their names.

    A null text stays null; a text of which no line goes stays as it is.
    """
    own = {c: f"__own_{c}" for c in ("dropped_lines", "kept_text") if c in docs.columns}
    marked = mark_repeated_lines(docs.withColumnsRenamed(own), min_chars, min_docs)
    text = F.when(F.col("dropped_lines").isNull(), F.col("text")).otherwise(F.col("kept_text"))
    return marked.withColumn("text", text).drop("dropped_lines", "kept_text").withColumnsRenamed({v: k for k, v in own.items()})
