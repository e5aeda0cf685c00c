"""Text, hash and vector expressions, and the token-aware chunkers."""

from __future__ import annotations

import json
import re
from ast import literal_eval

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Characters that file names cannot hold, and their stand-ins.
FILE_NAME = {"/": "&sol;", "\\": "&bs;", "?": "&qm;", "*": "&st;", ":": "&cl;", "|": "&vb;", "<": "&lt;", ">": "&gt;", '"': "&quot;", "'": "&apos;"}
_NAMESPACE = f"{1984:032x}"


def to_file_name(c: Column) -> Column:
    for char, name in FILE_NAME.items():
        c = F.replace(c, F.lit(char), F.lit(name))
    return F.concat(c, F.lit(".html"))


def from_file_name(c: Column) -> Column:
    for char, name in FILE_NAME.items():
        c = F.replace(c, F.lit(name), F.lit(char))
    return F.regexp_replace(c, r"\.html$", "")


def escape_html(c: Column) -> Column:
    for a, b in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ("\n", "<br>")):
        c = F.replace(c, F.lit(a), F.lit(b))
    return c


def content_uuid(c: Column) -> Column:
    """Name-based UUID (version 5) of the SHA-1 of the text, in a fixed namespace."""
    h = F.sha1(F.concat(F.unhex(F.lit(_NAMESPACE)), F.encode(F.sha1(c), "UTF-8")))
    nibble = F.lower(F.hex(F.conv(F.substring(h, 17, 1), 16, 10).cast("int").bitwiseAND(3).bitwiseOR(8)))
    return F.concat_ws("-", F.substring(h, 1, 8), F.substring(h, 9, 4), F.concat(F.lit("5"), F.substring(h, 14, 3)), F.concat(nibble, F.substring(h, 18, 3)), F.substring(h, 21, 12))


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, x: s + x)


def overlap(a: Column, b: Column) -> Column:
    """Share of a's distinct words (any case) that b has; both empty: 1, a empty: 0."""
    a, b = (F.array_distinct(F.transform(x, lambda w: F.lower(w))) for x in (a, b))
    return F.when((F.size(a) == 0) & (F.size(b) == 0), 1.0).when(F.size(a) == 0, 0.0).otherwise(F.size(F.array_intersect(a, b)) / F.size(a))


def fenced_json(c: Column) -> Column:
    """The body of a json fence, else the outermost bracketed block, else null."""
    fence = F.nullif(F.regexp_extract(c, "(?s)```json\\s*(.*?)\\s*```", 1), F.lit(""))
    return F.coalesce(fence, F.nullif(F.regexp_extract(c, r"(?s)(\[.*\])", 1), F.lit("")))


def escape_braces(c: Column) -> Column:
    """Single braces doubled, doubled ones left alone."""
    return F.regexp_replace(F.regexp_replace(c, r"(?<!\{)\{(?!\{)", "{{"), r"(?<!\})\}(?!\})", "}}")


def tokens(c: Column) -> Column:
    return F.size(F.filter(F.split(c, r"\s+"), lambda w: w != ""))


def words(text: str) -> int:
    """Default token count: runs between white space."""
    return len(text.split())


def sentences(text: str) -> list[str]:
    """Default sentences: white space after a full stop, question or exclamation mark parts them."""
    return [s for s in re.split(r"(?<=[.!?])\s+", text) if s]


def chunk(text: str, most: int = 400, least: int = 200, count=words, split=sentences) -> list[str]:
    """Sentences gathered until a chunk would hold more than `most` tokens.

    A cut is only made where at least `least` tokens are left, the sentence at the cut included, and never right before
    the last sentence; what is left then is one chunk. A first sentence that is too long by itself makes no empty chunk.
    count and split stand for the tokenizer and the sentence splitter.
    """
    if count(text) <= most:
        return [text]
    parts = split(text)
    sizes = [count(p) for p in parts]
    cuts, held, left = [0], 0, sum(sizes)
    for i, size in enumerate(sizes[:-1]):
        held += size
        if held > most:
            if left < least:
                break
            cuts.append(i)
            held = size
        left -= size
    return [" ".join(parts[a:b]) for a, b in zip(cuts, [*cuts[1:], len(parts)], strict=True) if a < b]


@F.pandas_udf(T.ArrayType(T.StringType()))
def chunk_text(texts: pd.Series) -> pd.Series:
    return texts.map(lambda t: chunk(t or ""))


#: Abbreviations whose full stop ends no sentence.
_SHORT = re.compile(r"(ca\.)|(calc\.)|(cal\.)|(no\.)|(e\.g\.)|(i\.e\.)", re.I)


def token_chunks(text: str, size: int = 300) -> list[str]:
    """Chunks of about `size` tokens (words with the white space before them): each ends at the last full stop between half
    and one and a half of it, else at `size`. A full stop before a letter or digit, or of an abbreviation, is none."""
    parts, out, i = re.findall(r"\s*\S+", text), [], 0
    while i < len(parts):
        low, high = i + size // 2, min(i + size + size // 2, len(parts))
        stops = (j for j in range(high, low, -1) if parts[j - 1].endswith(".") and (j == len(parts) or not (re.match(r"\w", parts[j]) or _SHORT.search("".join(parts[max(i, j - 4) : j])))))
        j = next(stops, min(i + size, len(parts)))
        out.append("".join(parts[i:j]).strip())
        i = j
    return out


@F.pandas_udf(T.ArrayType(T.IntegerType()))
def _ends(sizes: pd.Series) -> pd.Series:
    """Running sums of each array."""
    return sizes.map(np.cumsum, na_action="ignore")


def tokens_with_offsets(text: Column, pattern: str) -> Column:
    """array of (token, start): what the pattern finds, one after the other, with its place in the text.

    Each match is taken with the gap before it, so that places are running sums of lengths and the work grows with the text."""
    found = lambda group: F.regexp_extract_all(text, F.lit(f"(?s:.*?)({pattern})"), F.lit(group))
    ends = _ends(F.transform(found(0), lambda piece: F.length(piece)))
    return F.zip_with(found(1), ends, lambda token, end: F.struct(token.alias("token"), (end - F.length(token)).alias("start")))


def sentence_offsets(text: Column) -> Column:
    return tokens_with_offsets(text, r"(?s)\S.*?(?:[.!?](?=\s|$)|$)")


def word_offsets(text: Column) -> Column:
    return tokens_with_offsets(text, r"\w+|[^\w \t\n\f\r]")


def stand_in_place(text: Column, tokens: Column) -> Column:
    """Whether each of tokens (token, start), in their order, stands in the text where it is said to, with white space between them:
    they are written out at their places, and the text compared with that as a whole. Text is null: there is nothing out of place."""
    ends = F.concat(F.array(F.lit(0)), F.transform(tokens, lambda w: w["start"] + F.length(w["token"])))
    item = lambda w, end: F.concat(F.repeat(F.lit(" "), F.coalesce(w["start"], F.length(text)) - end), F.coalesce(w["token"], F.lit("")))
    return F.when(text.isNull(), True).otherwise(F.array_join(F.zip_with(tokens, ends, item), "") == F.translate(text, "\t\n\f\r", "    "))


def windows(text: str, most: int = 5000) -> list[str]:
    """Pieces of at most `most` tokens that end before their last line break; a piece without one ends where it is full."""
    parts, out = re.findall(r"\s*\S+", text), []
    while parts:
        piece, take = "".join(parts[:most]), min(most, len(parts))
        if take < len(parts):
            cut = next((k for k in range(take - 1, 0, -1) if "\n" in parts[k]), None)
            if cut:
                piece, take = "".join(parts[:cut]), cut
        out.append(piece.strip())
        parts = parts[take:]
    return out


@F.pandas_udf(T.ArrayType(T.StringType()))
def safe_windows(texts: pd.Series) -> pd.Series:
    return texts.map(lambda t: windows(t or ""))


def json_uuid(c: Column) -> Column:
    """content_uuid of a JSON text in canonical form: keys sorted at every level, ", " and ": " between, other characters than ASCII escaped."""
    return content_uuid(canonical_json(c))


@F.pandas_udf(T.StringType())
def canonical_json(texts: pd.Series) -> pd.Series:
    return pd.Series([None if t is None else json.dumps(json.loads(t), sort_keys=True) for t in texts], dtype=object)


def json_or_literal(text: str | None):
    """A model's answer: control characters go, then JSON, else a Python literal, else the text itself as it is."""
    if text is None:
        return None
    plain = re.sub(r"[\x00-\x1F\x7F]", "", text)
    for read in (json.loads, literal_eval):
        try:
            return read(plain)
        except (ValueError, SyntaxError):
            continue
    return plain


@F.pandas_udf(T.StringType())
def lenient_json(texts: pd.Series) -> pd.Series:
    """json_or_literal as JSON."""
    return pd.Series([None if t is None else json.dumps(json_or_literal(t), ensure_ascii=False, default=str) for t in texts], dtype=object)


def required_json(c: Column) -> Column:
    """fenced_json, or an error where there is no JSON at all."""
    return F.coalesce(fenced_json(c), F.when(c.isNotNull(), F.raise_error(F.lit("no JSON in the answer"))))


def reaction_text(title: Column, sub_titles: Column, para: Column) -> Column:
    return F.concat(F.lit("title:\n"), title, F.lit("\nsubtitles:\n"), F.replace(sub_titles, F.lit("/"), F.lit("\n")), F.lit("\nparagraph:\n"), para)


def reaction_context(title: Column, abstract: Column, sub_titles: Column, para: Column) -> Column:
    return F.concat(F.lit("title: "), title, F.lit("\nabstract: "), abstract, F.lit("\n"), F.replace(sub_titles, F.lit("/"), F.lit("\n")), F.lit("\nparagraph: "), para)


def search_query(year: Column, area: Column, kind: Column, keywords: Column) -> Column:
    """The literature search expression of a year, a subject area, a document type and keywords."""
    parts = F.concat(F.lit("ALL ( "), F.array_join(keywords, " AND "), F.lit(" )")), F.concat(F.lit("PUBYEAR > "), year.cast("string")), F.concat(F.lit("SUBJAREA ( "), area, F.lit(" )")), F.concat(F.lit("DOCTYPE ( "), kind, F.lit(" )"))
    return F.concat_ws(" AND ", *parts)


def full_url(publisher: Column, url: Column) -> Column:
    """Relative links of the two publishers that use them, completed."""
    base = F.when(publisher == "ACS", "https://pubs.acs.org").when(publisher == "Wiley", "https://onlinelibrary.wiley.com").otherwise("")
    return F.concat(base, url)


def quoted_query(c: Column) -> Column:
    """A search phrase for a URL: words quoted and joined by +."""
    return F.replace(F.replace(F.url_encode(c), F.lit("+"), F.lit(" ")), F.lit(" "), F.lit("+"))


def first_keys(steps: Column) -> Column:
    """The first key of each step (an array of maps), lower-cased."""
    return F.transform(steps, lambda s: F.lower(F.try_element_at(F.map_keys(s), F.lit(1))))


def listed_templates(names: Column, templates: dict[str, str]) -> Column:
    """The templates of the listed names in their order, a line each; unknown names are skipped."""
    if not templates:
        return F.when(names.isNotNull(), F.lit(""))
    known = F.create_map(*(F.lit(x) for kv in templates.items() for x in kv))
    return F.trim(F.array_join(F.array_compact(F.transform(names, lambda n: F.try_element_at(known, n))), "\n"))
