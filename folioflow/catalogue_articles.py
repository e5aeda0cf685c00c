"""Registered queries on labelled papers, entity resolution and record tables, with their SQL; they join those of catalogue.py.

A conversation stands for a paper (its turns for paragraphs, with section titles and measurements put in by turn number), a
brand's parts for a paper's records, an embedding label for the paper of a vector.
"""

from __future__ import annotations

import json

from pyspark.sql import functions as F

from .catalogue import _RECORDS, _records, query
from .functions import formula as M
from .functions import normalize as N
from .functions import text as X
from .operators import analysis as A
from .operators import labels as L
from .operators import records as R
from .operators import resolution as E
from .sources import documents as S

_TITLES = ("Abstract", "1. Introduction", "2. Experimental methods", "table", "3. Results/Phases", "", "Conflict of interest")
_ADDED = (" An FCC phase formed.", " It reached 450 MPa at 12.5 % strain.", " The strain rate was 1e-3.", " The mean grain size was 12 um.", " The band gap is 1.5 eV, uptake 3 mmol/g-1.", " Composition in at. %, annealed.", "", " B2 and size of the grains 3 mm, 80 GPa.")
_case = lambda values, by: "CASE " + by + " " + " ".join(f"WHEN {k} THEN '{v}'" for k, v in enumerate(values)) + " END"
_PAPER = (
    f"c AS (SELECT CAST(conv_id AS VARCHAR) AS source, turn AS para_id, 'Paper ' || conv_id AS title, {_case(_TITLES, '(conv_id + turn) % 7')} AS sub_titles, "
    f"text || {_case(_ADDED, '(conv_id * 3 + turn * 5) % 8')} AS page_content FROM (SELECT conv_id, turn, min(text) AS text FROM conversations GROUP BY conv_id, turn))"
)


def _paper(t):
    pick = lambda values, by: F.element_at(F.array(*(F.lit(v) for v in values)), (by + 1).cast("int"))
    rows = t("conversations").groupBy("conv_id", "turn").agg(F.min("text").alias("text"))
    return rows.select(
        F.col("conv_id").cast("string").alias("source"), F.col("turn").alias("para_id"), F.concat(F.lit("Paper "), "conv_id").alias("title"), pick(_TITLES, (F.col("conv_id") + F.col("turn")) % 7).alias("sub_titles"),
        F.concat("text", pick(_ADDED, (F.col("conv_id") * 3 + F.col("turn") * 5) % 8)).alias("page_content"),
    )


#: What stands for the models' judgement here.
JUDGED = {
    "composition": rf"(?iu){L.EDGE}(at|wt)\.?{L.BLANK}*%|composition", "strength_table": f"(?iu){L.EDGE}(MPa|GPa){L.EDGE}|strength", "processing_parameters": "(?iu)anneal|homogeni|roll|melt|aging|cast|quench",
    "synthesis": "(?iu)melt|cast|roll|anneal|sinter|synthesi",
}
GATES = {name: L.says(pattern) for name, pattern in JUDGED.items()}
_FLAGS = (
    "f AS (SELECT *, sub_titles = 'table' AS tab, regexp_matches(sub_titles, '(?i)introduction|experiment|preparation|method|conflict|acknowledge|support') OR sub_titles = 'table' AS barred, "
    "regexp_matches(sub_titles, '(?i)experiment|preparation|method') AS meth, regexp_matches(sub_titles, '(?i)result') AS res, bool_or(regexp_matches(sub_titles, '(?i)result')) OVER (PARTITION BY source) AS has_res, "
    r"regexp_matches(page_content, '(?i)\b(FCC|BCC|HCP|L12|B2|Laves|f.c.c.|b.c.c.|h.c.p.|face-centered cubic|body-centered cubic|hexagonal close-packed|intermetallic|IM)\b') AS phase, "
    r"regexp_matches(page_content, '\b(MPa|GPa)\b|\d+(\.\d+)?\s*%') AS mech, "
    r"regexp_matches(page_content, '(?i)(?:grain|grains)\s+(?:\w+\s+)*size|size\s+(?:\w+\s+)*(?:grain|grains)') AND regexp_matches(page_content, '(?i)\b(?:[μµ]m|um|nm|mm|microns?)\b') AS grain FROM c)"
)
_PROPERTIES = (
    r"l AS (SELECT *, list_distinct_ordered FROM (SELECT *, list_filter(["
    r"CASE WHEN tab AND regexp_matches(page_content, '(?i)\b(at|wt)\.?\s*%|composition') THEN 'composition' END, CASE WHEN tab AND regexp_matches(page_content, '(?i)\b(MPa|GPa)\b|strength') THEN 'strength' END, "
    r"CASE WHEN tab AND regexp_matches(page_content, '(?i)anneal|homogeni|roll|melt|aging|cast|quench') THEN 'processing_parameters' END, CASE WHEN (tab OR NOT barred) AND phase THEN 'phase' END, "
    r"CASE WHEN NOT barred AND mech THEN 'strength' END, CASE WHEN meth AND regexp_matches(page_content, '(?i)strain rate') THEN 'strain_rate' END, CASE WHEN grain AND (NOT has_res OR res OR tab) THEN 'grain_size' END"
    r"], lambda x: x IS NOT NULL) AS list_distinct_ordered, meth AND regexp_matches(page_content, '(?i)melt|cast|roll|anneal|sinter|synthesi') AS is_synthesis FROM f))"
).replace("SELECT *, list_distinct_ordered FROM", "SELECT * FROM").replace("list_distinct_ordered", "labels")
_LABELLED = f"{_PAPER}, {_FLAGS}, {_PROPERTIES}"


@query(f"WITH {_LABELLED} SELECT source, para_id, array_to_string(labels, ',') AS labels, is_synthesis FROM l")
def para_labels(t):
    return L.label_paper(_paper(t), gates=GATES).select("source", "para_id", F.array_join("property_types", ",").alias("labels"), "is_synthesis")


@query(f"WITH {_PAPER}, {_FLAGS} SELECT source, para_id, (res OR tab OR sub_titles = '') AND regexp_matches(page_content, '\\b([Bb]and\\s*[Gg]aps?|Eg)\\b') AND regexp_matches(page_content, '\\beV\\b') AS band_gap, "
       "regexp_matches(sub_titles, '(?i)\\b(?:experiment(?:al|s|ing|ed)?|synthesis(?:es|ing|ed)?|preparation(?:s|al|ed|ing)?|process(?:es|ion|ing)?|method(?:s)?)\\b') AS experiment, NOT barred AS unrestricted, "
       "regexp_matches(page_content, '(?i)(cm3[/\\s]g(-1)?)|(mmol[/\\s]g(-1)?)') AS uptake, tab AS is_table, sub_titles = 'Abstract' AS is_abstract FROM f")
def section_filters(t):
    text = F.col("page_content")
    return _paper(t).select("source", "para_id", L.band_gap().alias("band_gap"), L.in_section(L.EXPERIMENT).alias("experiment"), L.unrestricted().alias("unrestricted"), text.rlike(L.UPTAKE).alias("uptake"), L.is_table().alias("is_table"), L.is_abstract().alias("is_abstract"))


@query(f"WITH {_PAPER} SELECT DISTINCT source, sub_titles FROM c WHERE regexp_matches(sub_titles, '(?i)result')")
def matching_titles(t):
    return L.matching_titles(_paper(t), L.RESULT)


@query(f"WITH {_LABELLED}, w AS (SELECT *, list_contains(labels, 'strength') AS want, bool_or(list_contains(labels, 'strength')) OVER (PARTITION BY source) AS any_, max(CASE WHEN regexp_matches(sub_titles, '(?i)introduction') THEN para_id END) OVER (PARTITION BY source) AS intro FROM l) "
       "SELECT source, para_id FROM w WHERE any_ AND (want OR sub_titles = 'Abstract' OR coalesce(para_id = intro, false))")
def relevant_paragraphs(t):
    """Paragraphs on strength with the paper's abstract and last introduction paragraph."""
    return L.relevant(L.label_paper(_paper(t), gates=GATES), L.has_label("strength")).select("source", "para_id")


@query(f"WITH {_PAPER} SELECT source, arg_min(title, para_id) AS title, coalesce(string_agg(page_content, chr(10) ORDER BY para_id) FILTER (sub_titles = 'Abstract'), '') AS abstract FROM c GROUP BY source")
def title_abstract(t):
    got = L.title_and_abstract(_paper(t))
    return got.select("source", "title", F.array_join("abstract", "\n").alias("abstract"))


@query(f"WITH {_LABELLED}, g AS (SELECT *, is_synthesis OR list_contains(labels, 'composition') AS beside, list_contains(labels, 'strength') OR list_contains(labels, 'strain_rate') AS st, list_contains(labels, 'phase') AS ph FROM l) "
       "SELECT source, para_id, 'strength' AS target, NOT st AS is_context FROM g WHERE st OR beside UNION ALL SELECT source, para_id, 'phase', NOT ph FROM g WHERE ph OR beside UNION ALL SELECT source, para_id, 'synthesis', false FROM g WHERE is_synthesis")
def regroup_targets(t):
    return L.regrouped(L.label_paper(_paper(t), gates=GATES)).select("source", "para_id", "target", "is_context")


@query(f"WITH {_LABELLED} SELECT source, para_id, is_synthesis, array_to_string(labels, ',') AS labels FROM l WHERE is_synthesis OR len(labels) > 0")
def labelled_roundtrip(t):
    """Labelled paragraphs as they are stored, and read back."""
    stored = L.stored_labels(L.label_paper(_paper(t), gates=GATES))
    back = L.labelled_documents(stored.select("source", "para_id", "page_content", F.struct("source", "labels").alias("metadata")))
    return L.synthesis_paragraphs(back).unionByName(back.where("NOT is_synthesis AND size(property_types) > 0")).select("source", "para_id", "is_synthesis", F.array_join("property_types", ",").alias("labels"))


_VECTORS = (
    "v AS (SELECT CAST(label AS VARCHAR) AS source, vec_id AS para_id, CASE vec_id % 3 WHEN 0 THEN 'Results' WHEN 1 THEN 'Methods' ELSE 'Other' END AS sub_titles, CASE WHEN vec_id % 2 = 0 THEN 'FCC found' ELSE 'nothing' END AS page_content, "
    "list_dot_product(CAST(embedding AS DOUBLE[]), CAST((SELECT embedding FROM embeddings WHERE vec_id = 0) AS DOUBLE[])) AS d FROM embeddings), "
    "n AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY d DESC, para_id) AS r FROM v WHERE sub_titles = 'Results' OR source NOT IN (SELECT source FROM v WHERE sub_titles = 'Results'))"
)


def _vectors(t):
    title = F.when(F.col("vec_id") % 3 == 0, "Results").when(F.col("vec_id") % 3 == 1, "Methods").otherwise("Other")
    rows = t("embeddings").select(F.col("label").cast("string").alias("source"), F.col("vec_id").alias("para_id"), title.alias("sub_titles"), F.when(F.col("vec_id") % 2 == 0, "FCC found").otherwise("nothing").alias("page_content"), "embedding")
    return rows.drop("embedding"), rows.select("source", "para_id", "embedding"), t("embeddings").where("vec_id = 0").select("embedding").scalar()


@query(f"WITH {_VECTORS} SELECT source, para_id, round(d, 6) AS similarity FROM n WHERE r <= 5")
def similar_in_sections(t):
    paras, vectors, asked = _vectors(t)
    return L.similar(paras, vectors, asked, 5, L.RESULT).withColumn("similarity", F.round("similarity", 6))


@query(f"WITH {_VECTORS} SELECT source, para_id FROM n WHERE r <= 5 AND page_content = 'FCC found'")
def phase_by_similarity(t):
    paras, vectors, asked = _vectors(t)
    own = L.Labeler("phase", L.PHASE, query=asked, k=5, sections=L.RESULT)
    return L.apply(paras, [own], vectors).where(L.has_label("phase")).select("source", "para_id")


@query("SELECT doc_id FROM documents WHERE source NOT IN (SELECT source FROM documents WHERE doc_id % 1000 = 1)")
def embed_once(t):
    paras = t("documents").select("source", F.col("doc_id").alias("para_id"))
    return L.not_embedded(paras, paras.where("para_id % 1000 = 1")).select(F.col("para_id").alias("doc_id"))


# Entity resolution


_NORM = f"WITH {_RECORDS}, n AS (SELECT paper, pos, replace(comp0, ' ', '') AS comp, trim(rtrim(label0, ',')) AS label, array_to_string(kw0, '|') AS kw FROM r)"
_PARTS = "q AS (SELECT paper, pos // 3 AS part, list(pos ORDER BY pos) AS members FROM r GROUP BY paper, part)"


@query(f"{_NORM}, {_PARTS}, h AS (SELECT q.paper, comp, label, kw, unnest(members) AS m FROM q JOIN n ON n.paper = q.paper AND n.pos = members[1]) "
       "SELECT paper, comp, label, kw, string_agg(CAST(m AS VARCHAR), ',' ORDER BY m) AS members FROM (SELECT DISTINCT * FROM h) GROUP BY paper, comp, label, kw")
def finalize_partitions(t):
    """Partitions of three neighbouring records each, made final."""
    records = _records(t)
    parts = records.groupBy("paper", F.floor(F.col("pos") / 3).alias("part")).agg(F.sort_array(F.collect_list("pos")).alias("members"))
    got = E.finalize(records, parts)
    return got.select("paper", "comp", "label", F.array_join("kw", "|").alias("kw"), F.array_join(F.col("members").cast("array<string>"), ",").alias("members"))


@query(f"{_NORM} SELECT a.paper, a.comp, a.label, b.pos FROM (SELECT DISTINCT paper, comp, label, kw FROM n) a JOIN n b USING (paper, comp, label, kw)")
def partition_records(t):
    records = _records(t)
    return E.of_partition(R.partition_strict(records), records).select("paper", "comp", "label", "pos")


@query(f"WITH {_RECORDS} SELECT DISTINCT paper, replace(comp0, ' ', '') AS normal, comp0 AS original FROM r")
def original_spellings(t):
    return E.originals(_records(t), "composition", N.composition_key(F.col("composition")))


_DESCRIBED = "d AS (SELECT p_brand AS paper, p_partkey AS pos, p_partkey % 7 = 0 AS referred, CASE WHEN p_partkey % 7 <> 0 THEN nullif(concat_ws('|', CASE WHEN p_size % 5 <> 0 THEN p_type END, CASE WHEN p_size % 3 <> 0 THEN p_name END), '') END AS description FROM part)"


def _described(t):
    rows = t("part").select(F.col("p_brand").alias("paper"), F.col("p_partkey").alias("pos"), (F.col("p_partkey") % 7 == 0).alias("referred"), F.when(F.col("p_size") % 5 != 0, F.col("p_type")).alias("composition"), F.when(F.col("p_size") % 3 != 0, F.col("p_name")).otherwise("").alias("symbol"))
    return E.described(rows, "composition", "symbol")


@query(f"WITH {_DESCRIBED} SELECT paper, description, string_agg(CAST(pos AS VARCHAR), ',' ORDER BY pos) AS members FROM d WHERE description IS NOT NULL GROUP BY paper, description UNION ALL SELECT paper, NULL, CAST(pos AS VARCHAR) FROM d WHERE description IS NULL")
def description_groups(t):
    got = E.descriptions(_described(t), "paper", "pos")
    return got.select("paper", "description", F.array_join(F.col("members").cast("array<string>"), ",").alias("members"))


@query(f"WITH {_DESCRIBED} SELECT paper, upper(substr(description, 1, 3)) AS representative, string_agg(CAST(pos AS VARCHAR), ',' ORDER BY pos) AS properties, 'made from ' || upper(substr(description, 1, 3)) AS synthesis FROM d WHERE description IS NOT NULL GROUP BY paper, upper(substr(description, 1, 3)) "
       "UNION ALL SELECT paper, NULL, CAST(pos AS VARCHAR), NULL FROM d WHERE description IS NULL")
def merged_groups(t):
    """Descriptions grouped by their first letters, with the synthesis that a process makes of each group's name."""
    rows = _described(t)
    groups = rows.where("description IS NOT NULL").select("paper", F.upper(F.substring("description", 1, 3)).alias("representative"), "description").distinct()
    got = E.merge_groups(rows, groups, "paper", "pos", lambda name: F.concat(F.lit("made from "), name))
    return got.select("paper", "representative", F.array_join(F.col("properties").cast("array<string>"), ",").alias("properties"), "synthesis")


@query(f"WITH {_DESCRIBED} SELECT DISTINCT upper(substr(description, 1, 3)) AS representative, paper, pos FROM d WHERE description IS NOT NULL")
def raw_descriptions(t):
    rows = _described(t).where("description IS NOT NULL").select("paper", "pos", "description")
    groups = rows.groupBy(F.upper(F.substring("description", 1, 3)).alias("representative")).agg(F.collect_set("description").alias("description"))
    return E.raw_descriptions(groups, rows, "description").select("representative", "paper", "pos")


@query("SELECT o_orderpriority AS \"group\", o_orderkey, o_totalprice FROM orders WHERE o_orderkey IN (SELECT min(o_orderkey) FROM orders GROUP BY o_orderpriority, o_orderstatus)")
def group_members(t):
    first = t("orders").groupBy("o_orderpriority", "o_orderstatus").agg(F.min("o_orderkey").alias("k")).groupBy(F.col("o_orderpriority").alias("group")).agg(F.collect_list("k").alias("keys"))
    return E.members_of(first, t("orders").select("o_orderkey", "o_totalprice"), "o_orderkey").select("group", "o_orderkey", "o_totalprice")


@query("WITH p AS (SELECT p_brand || p_size AS paper, count(*) AS n FROM part GROUP BY paper), k AS (SELECT p_brand || p_size AS paper, p_type, list(p_partkey ORDER BY p_partkey) AS m FROM part GROUP BY paper, p_type) "
       "SELECT paper, array_to_string(m, ',') AS members, false AS skipped FROM k JOIN p USING (paper) WHERE n <= 3 UNION ALL SELECT paper, CAST(n AS VARCHAR), true FROM p WHERE n > 3")
def resolved_papers(t):
    """Records of each paper put together by a partition function; papers with many records are skipped and listed."""
    rows = t("part").select(F.concat("p_brand", F.col("p_size").cast("string")).alias("paper"), F.col("p_partkey").cast("int").alias("pos"), F.col("p_type").alias("composition"), F.lit("").alias("label"), F.split("p_name", " ").alias("processing_kw"))

    def by_composition(records):
        found: dict[str, list[int]] = {}
        for r in records:
            found.setdefault(r["composition"], []).append(r["pos"])
        return list(found.values())

    done, skipped = E.resolve(rows, by_composition, 3)
    done = done.select("paper", F.coalesce(F.array_join(F.col("members").cast("array<string>"), ","), "error").alias("members"), F.lit(False).alias("skipped"))
    return done.unionByName(skipped.select("paper", F.col("n").cast("string").alias("members"), F.lit(True).alias("skipped")))


# Records


_COMPOSITIONS = ("(CoCrNi)94Al6@at", "Fe50Ni50@at", "Ti6Al4V@wt", "FeNi@at/SiC", "5Al10Ti@at", "Al5–Ti10@at")
_PARSED = "CASE p_partkey % 6 WHEN 0 THEN 'Al6 Co31.333 Cr31.333 Ni31.333' WHEN 1 THEN 'Fe50 Ni50' WHEN 4 THEN 'Al33.333 Ti66.667' WHEN 5 THEN 'Al33.333 Ti66.667' END"
_RAW = "CASE p_partkey % 6 " + " ".join(f"WHEN {k} THEN '{c}'" for k, c in enumerate(_COMPOSITIONS)) + " END"
_GRAIN = "CASE WHEN p_size % 3 <> 2 THEN CAST(p_size AS DOUBLE) END"


def _experiments(t):
    n, none = F.col("p_size").cast("string"), F.lit(None).cast("string")
    raw = F.element_at(F.array(*(F.lit(c) for c in _COMPOSITIONS)), (F.col("p_partkey") % 6 + 1).cast("int"))
    size = F.struct(F.concat(n, F.lit(" um")).alias("grain_size"))
    sizes = F.when(F.col("p_size") % 3 != 2, F.array(size)).otherwise(F.array(size, size))
    entry = lambda ys, uts, strain, temperature, kind: F.struct(ys.alias("ys"), uts.alias("uts"), strain.alias("strain"), temperature.alias("temperature"), F.lit("1e-3").alias("strain_rate"), F.lit(kind).alias("test_type"))
    strength = F.array(
        entry(F.when(F.col("p_size") > 5, F.concat(n, F.lit(" GPa"))), none, none, F.when(F.col("p_size") % 4 != 0, "ambient").otherwise("hot"), "tensile"),
        entry(none, F.concat(n, F.lit(" Nmm2")), F.when(F.col("p_size") % 2 == 0, F.concat(n, F.lit(" %"))), F.lit("300 K"), "compressive"),
    )
    two = F.when(F.col("p_size") % 2 == 0, F.array(F.lit("FCC"), F.lit("BCC"))).otherwise(F.array(F.lit("HCP")))
    phase = F.array(F.struct(F.array(F.lit("BCC"), F.lit("FCC")).alias("phases")), F.struct(two.alias("phases")))
    strength = F.when(F.col("p_size") % 7 == 0, F.array().cast(t("part").select(strength.alias("s")).schema["s"].dataType)).otherwise(strength)
    record = F.struct(F.struct(raw.alias("composition")).alias("metadata"), sizes.alias("grain_size"), strength.alias("strength"), phase.alias("phase"), F.struct(F.col("p_type").alias("steps")).alias("synthesis"))
    return t("part").select(F.concat(F.lit("d"), "p_partkey").alias("doi"), record.alias("record"))


@query(f"SELECT 'd' || p_partkey AS doi, {_RAW} AS composition_raw, {_PARSED} AS composition, {_GRAIN} AS grain_size_um, p_size * 1000.0 AS yield_strength_mpa, 25.0 AS temperature_c, 0.001 AS strain_rate, p_type AS synthesis_steps FROM part WHERE p_size > 5 AND p_size % 4 <> 0 AND p_size % 7 <> 0")
def strength_records(t):
    return R.strength_rows(_experiments(t), "tensile")


@query(f"SELECT 'd' || p_partkey AS doi, {_RAW} AS composition_raw, {_PARSED} AS composition, {_GRAIN} AS grain_size_um, NULL::DOUBLE AS yield_strength_mpa, CAST(p_size AS DOUBLE) AS ultimate_tensile_strength_mpa, CAST(p_size AS DOUBLE) AS strain, 300 - 273.15 AS temperature_c, 0.001 AS strain_rate, p_type AS synthesis_steps FROM part WHERE p_size % 2 = 0 AND p_size % 7 <> 0")
def mechanical_records(t):
    return R.mechanical_rows(_experiments(t), "compressive")


@query(f"SELECT 'd' || p_partkey AS doi, {_PARSED} AS composition, {_RAW} AS composition_raw, 'BCC+FCC' AS phases, p_type AS synthesis_steps FROM part WHERE p_size % 2 = 0")
def phase_records(t):
    return R.phase_rows(_experiments(t)).withColumn("phases", F.array_join("phases", "+"))


@query(f"SELECT 'd' || p_partkey AS doi, {_PARSED} AS composition FROM part")
def valid_compositions(t):
    return R.valid_compositions(_experiments(t))


@query("SELECT 'd' || p_partkey AS doi FROM part WHERE p_partkey % 6 = 0")
def many_elements(t):
    return R.with_elements(R.valid_compositions(_experiments(t)), "composition", 3).select("doi")


@query("SELECT p_partkey, CASE p_partkey % 4 WHEN 0 THEN 'Al0.5 Co0.167 Cr0.333' WHEN 3 THEN 'Al0.2 Fe0.4 Ni0.4' END AS material FROM part")
def material_shares(t):
    said = F.element_at(F.array(F.lit("((CoCr2)3Al3)2"), F.lit("Fe2O3-doped"), F.lit("FeNi"), F.lit("Fe2Ni2Al")), (F.col("p_partkey") % 4 + 1).cast("int"))
    return t("part").select("p_partkey", M.normalise_material(said).alias("material"))


@query("SELECT conv_id, n = 1 AND m AS only_melting, m AS any_melting FROM (SELECT conv_id, count(*) AS n, bool_or((conv_id + turn) % 4 IN (0, 1)) AS m FROM (SELECT DISTINCT conv_id, turn FROM conversations) GROUP BY conv_id)")
def melting_routes(t):
    step = F.element_at(F.array(F.lit("Arc melting"), F.lit("suction casting"), F.lit("rolling"), F.lit("annealing")), ((F.col("conv_id") + F.col("turn")) % 4 + 1).cast("int"))
    got = t("conversations").select("conv_id", "turn", step.alias("s")).distinct().groupBy("conv_id").agg(F.collect_list("s").alias("s"))
    return got.select("conv_id", N.only_melting(F.col("s")).alias("only_melting"), N.any_melting(F.col("s")).alias("any_melting"))


@query("SELECT p_partkey FROM part WHERE contains(p_name, 'widget') AND p_brand IN ('Brand#13', 'Brand#5')")
def kind_filter(t):
    rows = R.of_kind(t("part"), "p_name", part="widget")
    return R.of_kind(rows, "p_brand", among=["Brand#13", "Brand#5"]).select("p_partkey")


@query("SELECT o_orderkey, CAST(CASE WHEN o_orderstatus = 'F' AND o_orderkey % 3 <> 0 THEN 1 ELSE 0 END AS INTEGER) AS n FROM orders")
def solid_state_reactions(t):
    kind = F.when(F.col("o_orderstatus") == "F", "solid-state").otherwise("sol-gel")
    given = F.when(F.col("o_orderkey") % 3 == 0, F.array().cast("array<string>")).otherwise(F.array("o_orderpriority"))
    return t("orders").select("o_orderkey", F.size(R.solid_state(F.array(F.struct(kind.alias("reaction_type"), given.alias("precursors"))))).alias("n"))


@query("SELECT doc_id, source AS kept, lang IS NULL AS no_lang, CAST(CASE WHEN lang IS NULL OR lang = '' THEN 1 ELSE 2 END AS INTEGER) AS n_data FROM documents")
def metadata_maps(t):
    """Metadata inherited, taken away and attached to."""
    meta = F.map_filter(F.create_map(F.lit("source"), F.col("source"), F.lit("lang"), F.col("lang"), F.lit("labels"), F.lit("x")), lambda k, v: v.isNotNull())
    rest = R.without(meta, "labels")
    data = R.attach(F.array(F.lit("a")), F.array(F.col("lang"), F.lit(""), F.lit(None).cast("string")))
    return t("documents").select("doc_id", F.try_element_at(R.inherited(meta), F.lit("source")).alias("kept"), (~F.map_contains_key(rest, F.lit("lang"))).alias("no_lang"), F.size(data).alias("n_data"))


@query("SELECT event_type, count(value) AS n, min(value) AS least, round(quantile_cont(value, 0.25), 6) AS q25, round(quantile_cont(value, 0.5), 6) AS q50, round(quantile_cont(value, 0.75), 6) AS q75, max(value) AS most FROM events GROUP BY event_type")
def distribution_by_type(t):
    return A.distribution(t("events"), "event_type", "value")


@query("SELECT o_custkey, tp, fp, fn, CAST(CASE WHEN tp = 0 THEN 0 ELSE round_even(2 * (tp / (tp + fp)) * (tp / (tp + fn)) / (tp / (tp + fp) + tp / (tp + fn)), 2) END AS DOUBLE) AS f1 FROM (SELECT o_custkey, count(*) FILTER (o_orderstatus = 'F') AS tp, count(*) FILTER (o_orderstatus = 'O') AS fp, count(*) FILTER (o_orderstatus = 'P') AS fn FROM orders GROUP BY o_custkey)")
def f1_each(t):
    n = lambda s: F.count_if(F.col("o_orderstatus") == s)
    got = t("orders").groupBy("o_custkey").agg(n("F").alias("tp"), n("O").alias("fp"), n("P").alias("fn"))
    return A.f1_each(A.checked_counts(got.withColumn("entities", F.col("tp") + F.col("fn")), "tp", "fn", "entities").drop("entities"), "tp", "fp", "fn")


@query("SELECT sum(turn) AS tokens_in, sum(len(text)) AS tokens_out, round((sum(turn) * 2.5 + sum(len(text)) * 10.0) / 1e6, 9) AS cost FROM conversations")
def model_cost(t):
    return A.cost(t("conversations").select("turn", F.length("text").alias("n")), "turn", "n", 2.5, 10.0)


@query("SELECT l_suppkey, min(c) AS l_returnflag FROM (SELECT l_suppkey, CASE WHEN l_linenumber % 2 = 0 THEN NULL WHEN l_suppkey % 3 = 0 THEN l_returnflag ELSE 'A' END AS c FROM lineitem) GROUP BY l_suppkey HAVING count(DISTINCT c) = 1")
def conflict_ignoring_nulls(t):
    """One value for each key whose values that are there agree."""
    value = F.when(F.col("l_linenumber") % 2 == 0, F.lit(None).cast("string")).when(F.col("l_suppkey") % 3 == 0, F.col("l_returnflag")).otherwise("A")
    return R.keep_consistent(t("lineitem").select("l_suppkey", "l_linenumber", value.alias("l_returnflag")), "l_suppkey", "l_returnflag", "l_linenumber", nulls_count=False)


# Text


@query("WITH j AS (SELECT event_id, '{\"a\": {\"k\": ' || json_extract_string(props, '$.k') || '}, \"t\": \"' || event_type || '\"}' AS doc FROM events), h AS (SELECT event_id, sha1(unhex('000000000000000000000000000007c0') || sha1(doc)::BLOB) AS h FROM j) "
       "SELECT event_id, substr(h, 1, 8) || '-' || substr(h, 9, 4) || '-5' || substr(h, 14, 3) || '-' || substr('89ab', (instr('0123456789abcdef', substr(h, 17, 1)) - 1) % 4 + 1, 1) || substr(h, 18, 3) || '-' || substr(h, 21, 12) AS uid FROM h")
def json_uuid(t):
    """The uid of nested metadata, whatever the order of its keys."""
    said = F.concat(F.lit('{"t":"'), "event_type", F.lit('",  "a":'), "props", F.lit("}"))
    return t("events").select("event_id", X.json_uuid(said).alias("uid"))


@query("SELECT event_id, CASE event_id % 3 WHEN 0 THEN '{\"k\": ' || event_id || '}' WHEN 1 THEN '[' || event_id || ', \"a\"]' ELSE '\"just text\"' END AS answer FROM events")
def lenient_answers(t):
    k = F.col("event_id") % 3
    said = F.when(k == 0, F.concat(F.lit('{"k":\x00 '), "event_id", F.lit("}\x1f"))).when(k == 1, F.concat(F.lit("("), "event_id", F.lit(", 'a')"))).otherwise("just text")
    return t("events").select("event_id", X.lenient_json(said).alias("answer"))


@query("SELECT doc_id, 'title:' || chr(10) || 'T' || doc_id || chr(10) || 'subtitles:' || chr(10) || source || chr(10) || lang || chr(10) || 'paragraph:' || chr(10) || n_chars AS text, "
       "'title: T' || doc_id || chr(10) || 'abstract: A' || chr(10) || source || chr(10) || lang || chr(10) || 'paragraph: ' || n_chars AS context FROM documents")
def reaction_texts(t):
    path, title, body = F.concat("source", F.lit("/"), "lang"), F.concat(F.lit("T"), "doc_id"), F.col("n_chars").cast("string")
    return t("documents").select("doc_id", X.reaction_text(title, path, body).alias("text"), X.reaction_context(title, F.lit("A"), path, body).alias("context"))


@query("SELECT p_partkey, 'ALL ( ' || replace(p_name, ' ', ' AND ') || ' ) AND PUBYEAR > 2010 AND SUBJAREA ( chem ) AND DOCTYPE ( ar )' AS query, replace(p_name, ' ', '+') AS quoted, "
       "CASE p_partkey % 3 WHEN 0 THEN 'https://pubs.acs.org/x' WHEN 1 THEN 'https://onlinelibrary.wiley.com/x' ELSE '/x' END AS url FROM part")
def search_texts(t):
    publisher = F.when(F.col("p_partkey") % 3 == 0, "ACS").when(F.col("p_partkey") % 3 == 1, "Wiley").otherwise("RSC")
    return t("part").select("p_partkey", X.search_query(F.lit(2010), F.lit("chem"), F.lit("ar"), F.split("p_name", " ")).alias("query"), X.quoted_query(F.col("p_name")).alias("quoted"), X.full_url(publisher, F.lit("/x")).alias("url"))


@query("SELECT o_orderkey, lower(o_orderpriority) AS first, CASE WHEN o_orderstatus = 'F' THEN 'Melt at T.' || chr(10) || 'Cool.' WHEN o_orderstatus = 'O' THEN 'Cool.' ELSE '' END AS prompt FROM orders")
def process_templates(t):
    names = F.when(F.col("o_orderstatus") == "F", F.array(F.lit("melting"), F.lit("unknown"), F.lit("cooling"))).when(F.col("o_orderstatus") == "O", F.array(F.lit("cooling"))).otherwise(F.array(F.lit("none")))
    keys = X.first_keys(F.array(F.create_map("o_orderpriority", F.lit(1)), F.create_map(F.lit("x"), F.lit(2))))
    return t("orders").select("o_orderkey", keys[0].alias("first"), X.listed_templates(names, {"melting": "Melt at T.", "cooling": "Cool."}).alias("prompt"))


@query("SELECT doc_id, CAST(len(regexp_extract_all(text, '[A-Za-z0-9_]+|[^A-Za-z0-9_\\s]')) AS INTEGER) AS words, true AS exact FROM documents")
def word_offsets(t):
    """Words with their places: every word stands where it is said to."""
    docs = t("documents").select("doc_id", "text", X.word_offsets(F.col("text")).alias("w"))
    return docs.select("doc_id", F.size("w").alias("words"), X.stand_in_place(F.col("text"), F.col("w")).alias("exact"))


@query(None)
def token_chunks(t):
    chunks = F.udf(lambda text: X.token_chunks(text or ""), "array<string>", useArrow=True)
    return t("documents").select("doc_id", F.posexplode(chunks("text")).alias("chunk_id", "chunk"))


# Sources


@query("SELECT 'd' || d.doc_id AS source, l.toxic FROM documents d JOIN labels l USING (doc_id) WHERE d.source = 'src3'")
def results_of_source(t):
    docs = t("documents").select(F.col("doc_id").alias("document_id"), F.col("source").alias("publisher"), F.concat(F.lit("d"), "doc_id").alias("source"))
    found = t("labels").select(F.col("doc_id").alias("document_id"), "toxic")
    return S.results_of(found, docs.where("publisher = 'src3'")).select("source", "toxic")


@query("SELECT pos, o_orderkey, o_totalprice FROM (SELECT row_number() OVER (ORDER BY c_custkey DESC) - 1 AS pos, c_custkey AS k FROM customer) JOIN orders ON o_orderkey = k")
def lookup_in_order(t):
    """Rows of a list of ids, in the list's order."""
    ids = t("customer").select("c_custkey", (-F.col("c_custkey")).alias("o"))
    return S.by_ids(t("orders").select("o_orderkey", "o_totalprice"), ids, "o_orderkey", "o").select("pos", "o_orderkey", "o_totalprice")


@query("SELECT '{\"model_name\": \"m\", \"instruction\": \"i\", \"db_name\": \"d\"}' AS line, 0 AS pos UNION ALL SELECT '{\"doi\":\"10.1/' || o_orderkey || '\",\"status\":\"' || o_orderstatus || '\"}', row_number() OVER (ORDER BY o_orderkey) FROM orders")
def export_lines(t):
    """Results as JSON lines below a header, the DOI as first key."""
    docs = t("orders").select(F.col("o_orderkey").alias("document_id"), F.concat(F.lit("10.1/"), "o_orderkey").alias("doi"))
    found = t("orders").select(F.col("o_orderkey").alias("document_id"), F.struct(F.col("o_orderstatus").alias("status")).alias("result"))
    return S.export_lines(found, docs, "m", "i", "d", with_doi=True)


@query("SELECT doc_id, '10.' || (1000 + doc_id % 5) || '/' || doc_id AS doi FROM documents WHERE doc_id % 5 IN (1, 2)")
def known_prefixes(t):
    dois = t("documents").select("doc_id", F.concat(F.lit("10."), (F.col("doc_id") % 5 + 1000).cast("string"), F.lit("/"), "doc_id").alias("doi"))
    return S.without_prefix(S.with_prefix(dois, ["10.1001", "10.1002", "10.1003"]), "10.1003")


@query("SELECT min(doc_id) AS doc_id FROM documents GROUP BY lower(source)")
def distinct_instructions(t):
    rows = t("documents").select("doc_id", "source").groupBy("source").agg(F.min("doc_id").alias("doc_id"))
    said = rows.select("doc_id", F.concat(F.lit("  "), F.upper("source"), F.lit(" . ")).alias("text")).unionByName(rows.select("doc_id", F.col("source").alias("text")))
    return E.distinct_instructions(said, "text").select("doc_id")


@query("SELECT o_orderkey, o_custkey, o_orderpriority FROM orders WHERE o_custkey IN (SELECT c_custkey FROM customer)")
def request_lines(t):
    """Chat requests built, parsed again and joined with what was asked about."""
    asked = t("orders").join(t("customer").select("c_custkey"), F.col("o_custkey") == F.col("c_custkey"), "left_semi").select("o_orderkey", "o_custkey", "o_orderpriority")
    line = S.chat_request(F.lit("system"), S.fenced(F.lit("Read "), F.col("o_orderpriority")), F.col("o_custkey").cast("string"), F.col("o_orderkey"))
    got = lambda path: F.get_json_object("line", path)
    return asked.select(line.alias("line")).select(
        got("$.metadata.task_id").cast("long").alias("o_orderkey"), got("$.metadata.file_name").cast("long").alias("o_custkey"), F.regexp_extract(got("$.messages[1].content"), "```(.*)```", 1).alias("o_orderpriority")
    )


FORMAT = {"properties": {"ys": {"title": "Ys", "type": "string"}}, "required": ["ys"], "title": "Strength", "type": "object"}


@query("SELECT 'The output is JSON of this schema:' || chr(10) || '{\"properties\": {\"ys\": {\"type\": \"string\"}}, \"required\": [\"ys\"]}' AS text")
def format_instructions(t):
    return t("part").sparkSession.createDataFrame([(S.format_instructions(json.loads(json.dumps(FORMAT))),)], "text string")
