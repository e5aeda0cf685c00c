"""The schemas of what is stored and extracted, as DDL and StructTypes."""

from __future__ import annotations

from pyspark.sql import types as T

#: Stores: documents with their metadata, results by document, done keys, vectors, the record of the index.
DOCUMENT = "document_id string, page_content string, metadata struct<source: string, doi: string, title: string, sub_titles: string>"
LABELLED = "page_content string, metadata struct<source: string, doi: string, title: string, sub_titles: string, labels: struct<is_synthesis: boolean, property_types: array<string>>>"
RESULT = "document_id string, result string"
HISTORY = "key string, namespace string"
VECTOR = "uid string, source string, para_id int, page_content string, embedding array<float>"
INDEX_RECORD = "uid string, source string, namespace string, updated_at timestamp"
#: Article elements, paragraphs, tables, figures.
PARAGRAPH = "source string, para_id int, doi string, title string, sub_titles string, page_content string, is_synthesis boolean, property_types array<string>"
ARTICLE = "doi string, title string, abstract string, elements array<struct<pos: int, type: string, title_size: string, text: string>>"
TABLE = "caption string, rows array<array<string>>, footnotes array<string>"
FIGURE = "label string, caption string"
#: Records of an alloy paper: what is known of the material, its measurements, its route.
METADATA = "struct<composition: string, label: string, processing_kw: array<string>>"
STRENGTH = "struct<ys: string, uts: string, strain: string, temperature: string, strain_rate: string, test_type: string>"
RECORD = f"metadata {METADATA}, grain_size array<struct<grain_size: string>>, strength array<{STRENGTH}>, phase array<struct<phases: array<string>>>, synthesis struct<steps: string>"
RECORD_WITHOUT_SYNTHESIS = f"metadata {METADATA}, grain_size array<struct<grain_size: string>>, strength array<{STRENGTH}>, phase array<struct<phases: array<string>>>"
PARTITION = f"canonical_metadata {METADATA}, members array<int>, confidence string"
#: Other domains: band gaps, adsorption, reactions.
BAND_GAP = "material string, band_gap string, unit string"
UPTAKE = "mof string, gas string, uptake string, unit string, temperature string, pressure string"
REACTION = "reaction_type string, precursors array<string>, target struct<target_formula: string>, conditions string"
#: Evaluation of a prompt.
ATTEMPT = "prompt string, tp long, fp long, fn long, f1 double"


def struct(ddl: str) -> T.StructType:
    return T._parse_datatype_string(ddl)


def extended(ddl: str, **fields: str) -> T.StructType:
    """A schema with fields grafted on; one that is there already is an error."""
    out = struct(ddl)
    for name, kind in fields.items():
        if name in out.names:
            raise ValueError(f"{name} is there already")
        out = out.add(name, struct(kind) if ":" in kind and kind.startswith("struct") else T._parse_datatype_string(kind))
    return out
