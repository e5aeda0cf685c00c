"""Secret scans with multipart credential linking, in DataFrame functions only.

Base kinds (assign, access, hex) stand on their own. Weak candidates - a short or unusual access identifier, a mixed
token that could be a secret, an endpoint - are common in clean text, so they are reported only with their complement:

- a weak access identifier with a secret (assign, hex or weak secret) near it,
- a weak secret with an access identifier (access or weak access) near it,
- an endpoint with both near it.

Near means in the same scope (a block of the text between empty lines), however long that is, or with `reach` also at
most that many code points apart. This is an interval join of which only existence matters: spans are ordered by
position and each looks at the nearest identifier, secret and endpoint before and after it, so no pairs are made,
however many spans a text has.

Positions: a pattern's matches and the pieces between them tile the text, so running sums of their lengths are the
offsets. Only those lengths leave the scan, never the text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import Workspace

#: Fixed values: (kind, pattern, least length, the group that it applies to), in the order in which equal starts sort.
KINDS = [
    ("assign", r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 6, 2),
    ("access", r"AKIA[A-Z0-9]+", 20, 0),
    ("hex", r"[0-9a-f]+", 24, 0),
    ("weak_access", r"A(?:KIA|SIA|IDA|ROA|GPA)[A-Z0-9]{8,}", 12, 0),
    ("weak_secret", r"[A-Za-z0-9+/]{24,}", 24, 0),
    ("endpoint", r"https?://[A-Za-z0-9.-]+[A-Za-z0-9:/_-]*", 11, 0),
    ("scope", r"\n[\x20\x09\r]*\n\s*", 2, 0),
]
#: A run of fewer than 24 cannot be a hex match and never changes where a longer one starts.
_SCAN = {"hex": r"[0-9a-f]{24,}"}
BASE = 3


def _gaps(kind: str, pattern: str, group: int) -> Column:
    """array<(gap, length, value)>: code points before each match since the last one, of the match and of its group; null if none."""
    pattern = _SCAN.get(kind, pattern)
    found = F.regexp_extract_all("text", F.lit(pattern), F.lit(0))
    value = F.regexp_extract_all("text", F.lit(pattern), F.lit(group)) if group else found
    pieces = F.split("text", pattern, -1)
    zipped = F.arrays_zip(
        F.transform(F.slice(pieces, 1, F.greatest(F.size(found), F.lit(0))), lambda x: F.length(x)).alias("gap"),
        F.transform(found, lambda x: F.length(x)).alias("len"),
        F.transform(value, lambda x: F.length(x)).alias("own"),
        F.transform(value, lambda x: x.rlike("[0-9]") & x.rlike("[a-z]") & x.rlike("[A-Z]")).alias("mixed"),
    )
    return F.when(F.regexp_like("text", F.lit(pattern)), zipped)


def find_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", reach: int | None = None) -> DataFrame:
    """One row per input row: doc_id, n_assign, n_access, n_hex, base_sha256, spans.

    A null text is empty and has no spans; texts of any length are scanned whole; rows are scanned one by one, so repeated rows and
    rows without an id or with that of others get their own spans; extra columns are ignored; an empty table gives an empty result.
    Offsets are code points, ends exclusive. Parts that are equally near are both before and after; either makes the link.
    """
    ws = Workspace(docs.sparkSession, "secrets")
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    scanned = rows.select("doc_id", *(_gaps(k, p, g).alias(k) for k, p, _, g in KINDS))
    scanned = ws.table(scanned.select("doc_id", F.monotonically_increasing_id().alias("row"), *(k for k, *_ in KINDS)), "scanned")
    real = [k for k, *_ in KINDS if k != "scope"]
    none = scanned.where(" AND ".join(f"{k} IS NULL" for k in real))
    some = scanned.where(" OR ".join(f"{k} IS NOT NULL" for k in real))

    spans = None
    for order, (kind, _, least, _) in enumerate(KINDS):
        own = some.select("doc_id", "row", F.lit(order).alias("kind"), F.lit(least).alias("least"), F.posexplode(kind).alias("at", "m"))
        spans = own if spans is None else spans.union(own)
    before = Window.partitionBy("row", "kind").orderBy("at").rowsBetween(Window.unboundedPreceding, 0)
    spans = spans.withColumn("end", F.sum(F.col("m.gap") + F.col("m.len")).over(before))
    spans = spans.select("doc_id", "row", "kind", (F.col("end") - F.col("m.len")).alias("start"), "end", "m.own", "m.mixed", "least")
    spans = spans.where((F.col("own") >= F.col("least")) & ((F.col("kind") != 4) | F.col("mixed")))

    line = Window.partitionBy("row").orderBy("start", "kind", "end")
    past, ahead = line.rowsBetween(Window.unboundedPreceding, -1), line.rowsBetween(1, Window.unboundedFollowing)
    base = F.col("kind") < BASE
    spans = spans.withColumn("over", F.coalesce(F.max(F.when(base, F.col("end"))).over(past), F.lit(0)) > F.col("start"))
    spans = spans.withColumn("over", F.col("over") | (F.coalesce(F.min(F.when(base, F.col("start"))).over(ahead), F.col("end")) < F.col("end")))
    spans = spans.where(base | (F.col("kind") == 6) | ~F.col("over"))
    spans = spans.withColumn("scope", F.coalesce(F.sum(F.when(F.col("kind") == 6, 1)).over(past), F.lit(0)))

    room = Window.partitionBy("row", "scope").orderBy("start", "kind", "end")
    past, ahead = room.rowsBetween(Window.unboundedPreceding, -1), room.rowsBetween(1, Window.unboundedFollowing)

    def near(*kinds: int) -> Column:
        those = F.col("kind").isin(*kinds)
        left = F.col("start") - F.max(F.when(those, F.col("end"))).over(past)
        right = F.min(F.when(those, F.col("start"))).over(ahead) - F.col("end")
        if reach is None:
            return left.isNotNull() | right.isNotNull()
        return F.coalesce(left <= reach, F.lit(False)) | F.coalesce(right <= reach, F.lit(False))

    spans = spans.withColumn("id_near", near(1, 3)).withColumn("secret_near", near(0, 2, 4))
    linked = F.when(F.col("kind") == 3, F.col("secret_near")).when(F.col("kind") == 4, F.col("id_near")).when(F.col("kind") == 5, F.col("id_near") & F.col("secret_near")).otherwise(base)
    label = F.element_at(F.array(*(F.lit(k) for k, *_ in KINDS)), F.col("kind") + 1)
    text = F.concat_ws(":", label, F.col("start").cast("string"), F.col("end").cast("string"))
    found = spans.withColumn("linked", linked).groupBy("row", "doc_id").agg(
        *(F.sum(F.when(F.col("kind") == i, 1).otherwise(0)).cast("long").alias(f"n_{KINDS[i][0]}") for i in range(BASE)),
        F.array_sort(F.collect_list(F.when(F.col("linked"), F.struct("start", "kind", text.alias("text"))))).alias("all"),
    )
    joined = lambda a: F.array_join(F.transform(a, lambda x: x["text"]), ",")
    found = found.select("row", "doc_id", "n_assign", "n_access", "n_hex", F.sha2(joined(F.filter("all", lambda x: x["kind"] < BASE)), 256).alias("base_sha256"), joined(F.col("all")).alias("spans"))
    kept = some.select("row", "doc_id").join(found.drop("doc_id"), "row", "left")
    zero = F.lit(0).cast("long")
    out = kept.select("doc_id", *(F.coalesce(c, zero).alias(c) for c in ("n_assign", "n_access", "n_hex")), F.coalesce("base_sha256", F.sha2(F.lit(""), 256)).alias("base_sha256"), F.coalesce("spans", F.lit("")).alias("spans"))
    return out.union(none.select("doc_id", zero, zero, zero, F.sha2(F.lit(""), 256), F.lit("")))


def _oracle() -> str:
    parts = [
        f"SELECT doc_id, {i} AS kind, {least} AS least, unnest(range(len(f))) AS pos, unnest(f) AS f, unnest(v) AS val, unnest(p[1:len(f)]) AS p FROM (SELECT doc_id, regexp_extract_all(text, $${pattern}$$, 0) AS f, "
        f"regexp_extract_all(text, $${pattern}$$, {group}) AS v, string_split_regex(text, $${pattern}$$) AS p FROM d)"
        for i, (_, pattern, least, group) in enumerate(KINDS)
    ]
    names = " ".join(f"WHEN {i} THEN '{k}'" for i, (k, *_) in enumerate(KINDS))
    near = lambda kinds: f"coalesce(max(CASE WHEN kind IN ({kinds}) THEN 1 END) OVER past, max(CASE WHEN kind IN ({kinds}) THEN 1 END) OVER ahead) IS NOT NULL"
    return f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
m AS ({' UNION ALL '.join(parts)}),
g AS (SELECT doc_id, kind, least, pos, length(f) AS len, val, sum(length(p) + length(f)) OVER (PARTITION BY doc_id, kind ORDER BY pos) AS e FROM m),
s AS (SELECT doc_id, kind, CAST(e - len AS BIGINT) AS start, CAST(e AS BIGINT) AS e FROM g WHERE length(val) >= least AND (kind <> 4 OR (regexp_matches(val, '[0-9]') AND regexp_matches(val, '[a-z]') AND regexp_matches(val, '[A-Z]')))),
o AS (SELECT *, coalesce(max(CASE WHEN kind < 3 THEN e END) OVER past, 0) > start OR coalesce(min(CASE WHEN kind < 3 THEN start END) OVER ahead, e) < e AS over_base FROM s
      WINDOW past AS (PARTITION BY doc_id ORDER BY start, kind, e ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), ahead AS (PARTITION BY doc_id ORDER BY start, kind, e ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING)),
c AS (SELECT *, coalesce(sum(CASE WHEN kind = 6 THEN 1 END) OVER (PARTITION BY doc_id ORDER BY start, kind, e ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS scope FROM o WHERE kind < 3 OR kind = 6 OR NOT over_base),
n AS (SELECT *, {near('1, 3')} AS id_near, {near('0, 2, 4')} AS secret_near FROM c
      WINDOW past AS (PARTITION BY doc_id, scope ORDER BY start, kind, e ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), ahead AS (PARTITION BY doc_id, scope ORDER BY start, kind, e ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING)),
l AS (SELECT doc_id, kind, start, (CASE kind {names} END) || ':' || start || ':' || e AS txt FROM n WHERE kind < 3 OR (kind = 3 AND secret_near) OR (kind = 4 AND id_near) OR (kind = 5 AND id_near AND secret_near)),
a AS (SELECT doc_id, count(*) FILTER (kind = 0) AS n_assign, count(*) FILTER (kind = 1) AS n_access, count(*) FILTER (kind = 2) AS n_hex,
      sha256(coalesce(string_agg(txt, ',' ORDER BY start, kind) FILTER (kind < 3), '')) AS base_sha256, string_agg(txt, ',' ORDER BY start, kind) AS spans FROM l GROUP BY doc_id)
SELECT d.doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex, coalesce(base_sha256, sha256('')) AS base_sha256, coalesce(spans, '') AS spans
FROM d LEFT JOIN a USING (doc_id)
"""


ORACLE = _oracle()
