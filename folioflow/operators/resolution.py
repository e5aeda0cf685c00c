"""Entity resolution of a paper's records: partitions from any source made final, descriptions grouped, groups taken back to records."""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import normalize as N


def normalised(records: DataFrame) -> DataFrame:
    """(paper, pos, comp, label, kw) of records(paper, pos, composition, label, processing_kw)."""
    return records.select("paper", "pos", N.composition_key(F.col("composition")).alias("comp"), N.label_key(F.col("label")).alias("label"), N.processing_key(F.col("processing_kw")).alias("kw"))


def finalize(records: DataFrame, partitions: DataFrame) -> DataFrame:
    """(paper, comp, label, kw, members) from partitions(paper, members): a partition is named by the normalised metadata of
    its first member, partitions of the same name are one, members are sorted and distinct, empty partitions are gone."""
    heads = partitions.where(F.size("members") > 0).select("paper", F.col("members")[0].alias("pos"), "members")
    named = heads.join(normalised(records), ["paper", "pos"])
    rows = named.select("paper", "comp", "label", "kw", F.explode("members").alias("m"))
    return rows.groupBy("paper", "comp", "label", "kw").agg(F.sort_array(F.collect_set("m")).alias("members"))


def of_partition(partitions: DataFrame, records: DataFrame) -> DataFrame:
    """Records of each partition, found by equal metadata; a null equals a null."""
    p, r = partitions.alias("p"), normalised(records).alias("r")
    same = (F.col("p.paper") == F.col("r.paper")) & F.col("p.comp").eqNullSafe(F.col("r.comp")) & F.col("p.label").eqNullSafe(F.col("r.label")) & F.col("p.kw").eqNullSafe(F.col("r.kw"))
    return p.join(r, same).select("p.paper", "p.comp", "p.label", "p.kw", "r.pos")


def originals(records: DataFrame, field: str, normal: Column) -> DataFrame:
    """(paper, normal, original): every spelling of a field under its normalised form, each once."""
    return records.select("paper", normal.alias("normal"), F.col(field).alias("original")).distinct()


def described(df: DataFrame, *parts: str, referred: str = "referred") -> DataFrame:
    """df with its description: what there is of the parts joined by |; null for records that are only referred to and for
    those with no part, which are never grouped."""
    filled = [F.nullif(F.col(p).cast("string"), F.lit("")) for p in parts]
    return df.withColumn("description", F.when(~F.coalesce(F.col(referred), F.lit(False)) & F.coalesce(*filled).isNotNull(), F.concat_ws("|", *filled)))


def descriptions(df: DataFrame, paper: str, pos: str) -> DataFrame:
    """(paper, description, members in order) of described rows; rows without one stay alone, under null."""
    some = df.where("description IS NOT NULL").groupBy(paper, "description").agg(F.sort_array(F.collect_list(pos)).alias("members"))
    return some.unionByName(df.where("description IS NULL").select(paper, "description", F.array(pos).alias("members")))


def merge_groups(df: DataFrame, groups: DataFrame, paper: str, pos: str, process: Callable[[Column], Column] | None = None) -> DataFrame:
    """(paper, representative, properties, synthesis) from described rows and groups(paper, representative, description).

    The members of all descriptions of a group are its properties, in order of pos; process makes the synthesis from the
    representative, asked once a group. Rows without a description follow alone, without representative and synthesis.
    """
    found = df.where("description IS NOT NULL").join(groups.select(F.col("paper").alias(paper), "representative", "description").distinct(), [paper, "description"])
    merged = found.groupBy(paper, "representative").agg(F.sort_array(F.collect_set(pos)).alias("properties"))
    merged = merged.withColumn("synthesis", process(F.col("representative")) if process else F.lit(None).cast("string"))
    alone = df.where("description IS NULL").select(paper, F.lit(None).cast("string").alias("representative"), F.array(pos).alias("properties"), F.lit(None).cast("string").alias("synthesis"))
    return merged.unionByName(alone)


def raw_descriptions(groups: DataFrame, raw: DataFrame, on: str) -> DataFrame:
    """groups(representative, array `on`) to the raw rows of their descriptions, each once."""
    rows = groups.select("representative", F.explode(on).alias(on))
    return rows.join(raw, on).distinct()


def members_of(groups: DataFrame, objects: DataFrame, key: str) -> DataFrame:
    """Objects of the groups whose key list names them, in a row each."""
    return groups.select("group", F.explode("keys").alias(key)).join(objects, key)


def resolve(records: DataFrame, partition: Callable[[list[dict]], list[list[int]]], most: int = 20) -> tuple[DataFrame, DataFrame]:
    """(partitions, skipped papers): partition sees a paper's records (pos, composition, label, processing_kw) and gives lists of
    positions. Papers with more than `most` records are skipped, listed with their count. An answer that fails, or does
    not place every record once, is an error in its row (paper, members null, error), never the end of the job."""
    sizes = records.groupBy("paper").agg(F.count(F.lit(1)).alias("n"))
    known = records.join(sizes.where(F.col("n") <= most), "paper", "left_semi")

    def one(group: pd.DataFrame) -> pd.DataFrame:
        rows = group.sort_values("pos")
        paper = rows["paper"].iloc[0]
        try:
            got = partition([{"pos": int(r.pos), "composition": r.composition, "label": r.label, "processing_kw": list(r.processing_kw) if r.processing_kw is not None else []} for r in rows.itertuples()])
            if sorted(i for part in got for i in part) != sorted(int(p) for p in rows["pos"]):
                raise ValueError("not every record is in exactly one partition")
            return pd.DataFrame([(paper, [int(i) for i in part], None) for part in got if part], columns=["paper", "members", "error"])
        except Exception as e:  # errors are data
            return pd.DataFrame([(paper, None, f"{type(e).__name__}: {e}")], columns=["paper", "members", "error"])

    done = known.select("paper", "pos", "composition", "label", "processing_kw").groupBy("paper").applyInPandas(one, "paper string, members array<int>, error string")
    return done, sizes.where(F.col("n") > most)


def distinct_instructions(df: DataFrame, text: str, order: str | None = None) -> DataFrame:
    """One row of each instruction, case, white space and marks at its ends apart: the first by `order`, or by the text itself."""
    key = F.lower(F.regexp_replace(F.trim(F.regexp_replace(text, r"\s+", " ")), r"^\W+|\W+$", ""))
    rows = df.select(key.alias("_k"), F.struct(*df.columns).alias("_row"), F.struct(F.col(order or text), F.col(text)).alias("_o"))
    return rows.groupBy("_k").agg(F.min_by("_row", "_o").alias("_row")).select("_row.*")
