"""Benchmark decontamination by winnowing, in DataFrame functions only.

Every text is a sequence of words. For each stretch of 13 words, the smallest hash among its six 8-word grams is kept
(winnowing with window 6), so two texts that share 13 consecutive words share a fingerprint: nothing is missed. Test
and training fingerprints are joined; documents with a common one are read again, all their 13-word windows are
matched by hash, compared as text, and extended to the words they cover. Benchmark items of fewer words than a window
are windows of their own length, matched over all grams of that length.

Generators are the outer ones: for a plain explode the optimiser would add a filter on the array's size and inline
the whole chain of grams into it, where every doubling doubles the work.

Grams are built by doubling (1, 2, 4, 8 words) and minima by doubling too, so the cost per word does not depend on
the window. The benchmark side is broadcast only when its rows and bytes, both measured, are under bounds.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import Workspace

WINDOW, GRAM = 13, 8
BREAK = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
WORD = r"[0-9A-Za-z\x{80}-\x{10FFFF}]+"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def words_of(text: Column) -> Column:
    """The words of a text with A-Z lower-cased (and no other letter)."""
    text = F.coalesce(text, F.lit(""))
    plain = F.octet_length(text) == F.length(text)
    return F.array_remove(F.split(F.when(plain, F.lower(text)).otherwise(F.translate(text, _UPPER, _LOWER)), BREAK), "")


def _shift(values: str, by: int) -> Column:
    return F.slice(values, by + 1, F.greatest(F.size(values), F.lit(1)))


def _hashed(a: Column, b: Column) -> Column:
    return F.xxhash64(a, b)


def _least(a: Column, b: Column) -> Column:
    return F.least(a, b)


def with_grams(df: DataFrame, upto: int) -> DataFrame:
    """df(words) with g1, g2, g4, ... : hashes of that many words from each position on (the last ones are overhang)."""
    df = df.withColumn("g1", F.transform("words", lambda w: F.xxhash64(w)))
    k = 1
    while 2 * k <= upto:
        df = df.withColumn(f"g{2 * k}", F.zip_with(F.col(f"g{k}"), _shift(f"g{k}", k), _hashed))
        k *= 2
    return df


def grams(length: int) -> Column:
    """Hashes of all `length`-word grams, from the doubled ones."""
    k = 1 << (length.bit_length() - 1)
    body = F.col(f"g{k}") if k == length else F.zip_with(F.col(f"g{k}"), _shift(f"g{k}", length - k), _hashed)
    return F.slice(body, 1, F.greatest(F.size("words") - (length - 1), F.lit(0)))


def with_fingerprints(df: DataFrame) -> DataFrame:
    """df(words, g8) with fps: the distinct winnowed 8-gram hashes of texts that have a whole window."""
    df = df.withColumn("low1", F.slice("g8", 1, F.greatest(F.size("words") - (GRAM - 1), F.lit(0))))
    spread = WINDOW - GRAM + 1
    k = 1
    while 2 * k <= spread:
        df = df.withColumn(f"low{2 * k}", F.zip_with(F.col(f"low{k}"), _shift(f"low{k}", k), _least))
        k *= 2
    if k < spread:
        df = df.withColumn("low", F.zip_with(F.col(f"low{k}"), _shift(f"low{k}", spread - k), _least))
    else:
        df = df.withColumn("low", F.col(f"low{k}"))
    return df.withColumn("fps", F.array_distinct(F.slice("low", 1, F.greatest(F.size("words") - (WINDOW - 1), F.lit(0)))))


def _tagged(hashes: Column, n: int) -> Column:
    return F.transform(hashes, lambda x: F.struct(F.lit(n).alias("n"), x.alias("fp")))


def _contamination(docs: DataFrame, bench: DataFrame, id_col: str, text_col: str, item_col: str, item_text: str, broadcast_rows: int, broadcast_bytes: int) -> DataFrame:
    """contamination with the hash of the text: rows are told apart by id and text, so a repeated id does no harm."""
    spark = docs.sparkSession
    ws = Workspace(spark, "decontaminate")
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(F.col(text_col)).alias("h"), F.col(text_col).alias("text"))
    items = bench.select(F.col(item_col).cast("long").alias("item_id"), words_of(F.col(item_text)).alias("words")).where(F.size("words") > 0)
    items = ws.table(items, "items")
    shorter = sorted(r[0] for r in items.select(F.least(F.size("words"), F.lit(WINDOW)).alias("n")).distinct().collect() if r[0] < WINDOW)  # at most 12 lengths
    lengths = [*shorter, WINDOW]

    windows = None
    for n in lengths:
        own = items.where(F.size("words") >= WINDOW if n == WINDOW else F.size("words") == n)
        own = with_grams(own, n).select("item_id", "words", F.posexplode_outer(grams(n)).alias("at", "hash"))
        own = own.where(F.col("hash").isNotNull()).select("item_id", F.lit(n).alias("n"), "hash", F.array_join(F.slice("words", F.col("at") + 1, n), " ").alias("window"))
        windows = own if windows is None else windows.union(own)
    windows = ws.table(windows.distinct(), "windows")
    prints = with_fingerprints(with_grams(items.where(F.size("words") >= WINDOW), GRAM)).select(F.lit(WINDOW).alias("n"), F.explode_outer("fps").alias("fp"))
    prints = ws.table(prints.union(windows.where(F.col("n") < WINDOW).select("n", F.col("hash").alias("fp"))).distinct(), "prints")
    held, size = windows.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.octet_length("window") + 64), F.lit(0))).first()
    small = F.broadcast if held <= broadcast_rows and size <= broadcast_bytes else lambda df: df

    # One split of each text gives the grams of every length.
    marked = with_fingerprints(with_grams(rows.select("doc_id", "h", words_of(F.col("text")).alias("words")), GRAM))
    tagged = [_tagged(F.col("fps") if n == WINDOW else F.array_distinct(grams(n)), n) for n in lengths]
    found = marked.select("doc_id", "h", F.explode_outer(F.concat(*tagged)).alias("p")).select("doc_id", "h", "p.n", "p.fp")
    suspects = ws.table(found.join(small(prints), ["n", "fp"], "left_semi").select(F.col("doc_id").alias("_id"), F.col("h").alias("_h")).distinct(), "suspects")

    same = F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("h") == F.col("_h"))
    again = ws.table(rows.join(suspects, same, "left_semi").select("doc_id", "h", words_of(F.col("text")).alias("words")), "again")
    hashes = windows.select("n", "hash").distinct()
    spots = None
    for n in lengths:
        own = with_grams(again, n).select("doc_id", "h", "words", F.posexplode_outer(grams(n)).alias("at", "hash"))
        own = own.join(small(hashes.where(F.col("n") == n).select("hash")), "hash", "left_semi")
        own = own.select("doc_id", "h", "at", F.lit(n).alias("n"), F.array_join(F.slice("words", F.col("at") + 1, n), " ").alias("window"))
        spots = own if spots is None else spots.union(own)
    # Positions meet distinct windows; the items that have these are found once for each text, however many of them are equal.
    hits = ws.table(spots.join(small(windows.select("n", "window").distinct()), ["n", "window"], "left_semi"), "hits")
    items_of = hits.select("doc_id", "h", "n", "window").distinct().join(small(windows.select("n", "window", "item_id")), ["n", "window"])
    items_of = items_of.groupBy("doc_id", "h").agg(F.collect_set(F.col("item_id").cast("string")).alias("ids")).select(F.col("doc_id").alias("_i"), F.col("h").alias("_g"), "ids")
    covered = lambda acc, x: F.struct(
        (acc["n"] + F.greatest(F.lit(0), x["at"] + x["n"] - F.greatest(acc["end"], x["at"]))).cast("long").alias("n"), F.greatest(acc["end"], x["at"] + x["n"]).alias("end")
    )
    per_doc = hits.groupBy("doc_id", "h").agg(F.collect_set(F.struct("at", "n")).alias("spots"))
    per_doc = per_doc.join(items_of, F.col("doc_id").eqNullSafe(F.col("_i")) & (F.col("h") == F.col("_g"))).select(
        F.col("doc_id").alias("_id"),
        F.col("h").alias("_h"),
        F.aggregate(F.array_sort("spots"), F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).alias("end")), covered)["n"].alias("hit"),
        F.size("ids").cast("long").alias("items"),
        F.sha2(F.array_join(F.array_sort("ids"), ","), 256).alias("sha"),
    )
    counted = rows.select("doc_id", "h", F.regexp_count(F.coalesce("text", F.lit("")), F.lit(WORD)).cast("long").alias("n_words"))
    out = counted.join(per_doc, same, "left").select(
        "doc_id", "h", "n_words", F.coalesce("hit", F.lit(0)).cast("long").alias("n_hit"), F.coalesce("items", F.lit(0)).cast("long").alias("n_items"), F.coalesce("sha", F.sha2(F.lit(""), 256)).alias("items_sha256")
    )
    return out.withColumn("contaminated", (F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words")))


def contamination(docs: DataFrame, bench: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text: str = "text", broadcast_rows: int = 1_000_000, broadcast_bytes: int = 64 << 20) -> DataFrame:
    """One row per input row: doc_id, n_words, n_hit, n_items, items_sha256, contaminated.

    Null and empty texts have no words and are clean, items without words match nothing, repeated items count by
    their item_id, an empty benchmark leaves every document clean. Rows with the same id, or none, are judged by their
    own texts; texts are read whole. Extra columns on either side are ignored. The benchmark's windows are broadcast
    when they are counted and measured to be under both bounds, else joined by their keys.
    """
    return _contamination(docs, bench, id_col, text_col, item_col, item_text, broadcast_rows, broadcast_bytes).drop("h")


def decontaminate(docs: DataFrame, bench: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text: str = "text", broadcast_rows: int = 1_000_000, broadcast_bytes: int = 64 << 20) -> DataFrame:
    """The clean rows of docs, with all their columns."""
    bad = _contamination(docs, bench, id_col, text_col, item_col, item_text, broadcast_rows, broadcast_bytes).where("contaminated").select(F.col("doc_id").alias("_bad"), F.col("h").alias("_h"))
    return docs.join(bad, docs[id_col].cast("long").eqNullSafe(bad["_bad"]) & (F.xxhash64(docs[text_col]) == bad["_h"]), "left_anti")


ORACLE = r"""
WITH dw AS (SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda w: w <> '') AS w FROM documents),
iw AS (SELECT item_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda w: w <> '') AS w FROM benchmark),
iwin AS (SELECT DISTINCT item_id, least(len(w), 13) AS n, array_to_string(w[i:i + least(len(w), 13) - 1], ' ') AS win
         FROM (SELECT item_id, w, unnest(range(1, len(w) - least(len(w), 13) + 2)) AS i FROM iw WHERE len(w) > 0)),
lens AS (SELECT DISTINCT n FROM iwin),
dwin AS (SELECT doc_id, n, i, array_to_string(w[i:i + n - 1], ' ') AS win
         FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM dw, lens WHERE len(w) >= n)),
hit AS (SELECT doc_id, n, i, item_id FROM dwin JOIN iwin USING (n, win)),
cov AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT DISTINCT doc_id, unnest(range(i, i + n)) AS p FROM hit) GROUP BY doc_id),
its AS (SELECT doc_id, count(*) AS n_items, sha256(string_agg(item, ',' ORDER BY item)) AS sha FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM hit) GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, coalesce(sha, sha256('')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM dw LEFT JOIN cov USING (doc_id) LEFT JOIN its USING (doc_id)
"""
