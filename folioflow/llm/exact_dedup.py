"""Exact dedup: skew-safe combining of equal normalised texts.

Three stages, each keyed by the digest *and* the whole normalised text, so that equality is always of full content:

1. local: the map-side half of the first aggregation merges equal texts inside a task, before anything is shuffled;
2. salted: a digest's rows are dealt over `salts` groups, so a text held by a third of all rows meets in no single task;
3. global: at most `salts` winners per text meet in the last aggregation.

Both aggregations carry fixed-width buffers (a count and one decimal that orders candidates), so they run as hash
aggregations and never gather the rows of a group. Members find their winner by an equi-join on the digest, which
adaptive execution splits where a digest is hot.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

WHITE = r"[\x20\x09-\x0D]+"
#: Above any doc_id; a candidate is n_chars * _SHIFT + (_TOP - doc_id), 0 for no id: the longest original text, then the smallest doc_id.
_SHIFT = Decimal(10**20)
_TOP = Decimal(2**63)


def normalised(text: Column) -> Column:
    """The text without white space (null: empty)."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), WHITE, "")


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", salts: int = 16) -> DataFrame:
    """One row per input row: doc_id, keep_id, group_size, kept, text_sha256.

    Nulls and empty texts are all equal to each other; of equal texts the one with most code points in the original
    stays, ties by the smallest id. Rows without an id lose such ties; where one of them is the longest, keep_id is null and
    all rows of the group without an id stay, as nothing tells them apart. Rows that share an id share their fate. Texts
    are compared whole, however long. Extra columns of docs are ignored, an empty table gives an empty result.
    """
    big = T.DecimalType(38, 0)
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(
        F.col(id_col).cast("long").alias("doc_id"), normalised(F.col(text_col)).alias("norm"), F.length(text).alias("n")
    )
    keyed = rows.select(
        F.unhex(F.sha2("norm", 256)).alias("digest"),
        F.xxhash64("norm").alias("second"),
        "norm",
        F.pmod(F.xxhash64("doc_id"), F.lit(salts)).alias("salt"),
        (F.col("n").cast(T.DecimalType(10, 0)) * F.lit(_SHIFT) + F.coalesce(F.lit(_TOP) - F.col("doc_id").cast(T.DecimalType(19, 0)), F.lit(Decimal(0)))).cast(big).alias("rank"),
    )
    salted = keyed.groupBy("digest", "second", "salt", "norm").agg(F.max("rank").alias("rank"), F.count(F.lit(1)).alias("n"))
    winners = salted.groupBy("digest", "second", "norm").agg(F.max("rank").alias("rank"), F.sum("n").alias("group_size"))
    left = F.col("rank") % F.lit(_SHIFT)
    winners = winners.select("digest", "second", F.when(left > 0, (F.lit(_TOP) - left).cast("long")).alias("keep_id"), "group_size")
    members = rows.select("doc_id", F.unhex(F.sha2("norm", 256)).alias("digest"), F.xxhash64("norm").alias("second"))
    return members.join(winners, ["digest", "second"]).select(
        "doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"), F.lower(F.hex("digest")).alias("text_sha256")
    )


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", salts: int = 16) -> DataFrame:
    """The rows of docs that stay, with all their columns."""
    gone = exact_groups(docs, id_col, text_col, salts).where("NOT kept").select(F.col("doc_id").alias("_gone"), "text_sha256")
    digest = F.lower(F.sha2(normalised(docs[text_col]), 256))
    return docs.join(gone, docs[id_col].cast("long").eqNullSafe(gone["_gone"]) & (digest == gone["text_sha256"]), "left_anti")


ORACLE = r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', '', 'g') AS norm FROM documents),
r AS (SELECT doc_id, norm, row_number() OVER (PARTITION BY norm ORDER BY length(text) DESC, doc_id) AS rn, count(*) OVER (PARTITION BY norm) AS group_size FROM d),
k AS (SELECT norm, doc_id AS keep_id FROM r WHERE rn = 1)
SELECT r.doc_id, k.keep_id, r.group_size, r.doc_id = k.keep_id AS kept, sha256(r.norm) AS text_sha256
FROM r JOIN k USING (norm)
"""
