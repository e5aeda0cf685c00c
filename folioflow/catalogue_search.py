"""Registered queries of retrieval by words, token counts by a tokenizer file, learned embeddings, grouping rounds and prompts."""

from __future__ import annotations

import re

from pyspark.sql import functions as F

from .catalogue import query
from .catalogue_articles import _PAPER, _paper
from .catalogue_stores import _folder
from .functions import tokens as N
from .operators import retrieval as R
from .plans import models as M
from .plans import optimiser as O
from .sources import vector_index as I
from .sources.store import stored

_ASKED = ("strain rate and grain size", "FCC phase formed", "band gap of the annealed alloy", "xyzzy")
_BM25 = (
    f"{_PAPER}, a(query_id, text) AS (VALUES {', '.join(f'({i}, {chr(39)}{q}{chr(39)})' for i, q in enumerate(_ASKED))}), "
    "w AS (SELECT source, para_id, sub_titles, regexp_extract_all(lower(page_content), '[\\p{L}\\p{N}]+') AS ws FROM c), "
    "d AS (SELECT count(*) AS total, avg(len(ws)) AS mean FROM w WHERE len(ws) > 0), "
    "t AS (SELECT source, para_id, len(ws) AS n_terms, term, count(*) AS n FROM (SELECT *, unnest(ws) AS term FROM w) GROUP BY ALL), "
    "q AS (SELECT DISTINCT query_id, unnest(regexp_extract_all(lower(text), '[\\p{L}\\p{N}]+')) AS term FROM a), "
    "f AS (SELECT term, count(*) AS df FROM t GROUP BY term), "
    "h AS (SELECT source, para_id FROM c WHERE regexp_matches(sub_titles, '(?i)result') OR source NOT IN (SELECT source FROM c WHERE regexp_matches(sub_titles, '(?i)result'))), "
    "s AS (SELECT query_id, source, para_id, round(sum(ln(1 + (total - df + 0.5) / (df + 0.5)) * n * 2.2 / (n + 1.2 * (0.25 + 0.75 * n_terms / mean))), 9) AS score "
    "FROM q JOIN t USING (term) JOIN f USING (term), d GROUP BY ALL)"
)


def _asked(t):
    return t("conversations").sparkSession.createDataFrame(list(enumerate(_ASKED)), "query_id int, text string")


def _text_index(t):
    paras = _paper(t)
    path = _folder(paras, "text-index")
    R.write_index(paras, path)
    return paras, path


@query(f"WITH {_BM25}, r AS (SELECT s.*, row_number() OVER (PARTITION BY query_id, source ORDER BY score DESC, para_id) AS rank FROM s JOIN h USING (source, para_id)) SELECT query_id, source, para_id, CAST(rank AS INTEGER) AS rank, round(score, 6) AS score FROM r WHERE rank <= 3")
def bm25_paragraphs(t):
    """The three paragraphs of each paper's result sections that answer a question best."""
    paras, path = _text_index(t)
    got = R.retrieve(paras.sparkSession, path, paras, _asked(t), k=3)
    return got.select("query_id", "source", "para_id", "rank", F.round("score", 6).alias("score"))


@query(f"WITH {_PAPER}, w AS (SELECT source, para_id, ' ' || array_to_string(regexp_extract_all(lower(page_content), '[\\p{{L}}\\p{{N}}]+'), '  ') || ' ' AS ws FROM c) "
       "SELECT query_id, source, para_id, (len(ws) - len(replace(ws, p, ''))) // len(p) AS n FROM w, (VALUES (0, ' the  strain  rate '), (1, ' mpa  at '), (2, ' grain  rate ')) v(query_id, p) WHERE contains(ws, p)")
def phrase_hits(t):
    paras, path = _text_index(t)
    asked = paras.sparkSession.createDataFrame([(0, "the strain rate"), (1, "MPa at"), (2, "grain rate")], "query_id int, text string")
    return R.phrases(paras.sparkSession, path, asked).select("query_id", "source", "para_id", "n")


@query(f"WITH {_BM25}, x AS (SELECT query_id, source, para_id, row_number() OVER (PARTITION BY query_id, source ORDER BY score DESC, para_id) AS rank FROM s), "
       "y AS (SELECT query_id, source, para_id, row_number() OVER (PARTITION BY query_id, source ORDER BY para_id DESC) AS rank FROM a, c), "
       "z AS (SELECT query_id, source, para_id, round(sum(1.0::DOUBLE / (60 + rank)), 9) AS score FROM (SELECT * FROM x WHERE rank <= 10 UNION ALL SELECT * FROM y WHERE rank <= 10) GROUP BY ALL), "
       "o AS (SELECT *, row_number() OVER (PARTITION BY query_id, source ORDER BY score DESC, para_id) AS rank FROM z) SELECT query_id, source, para_id, CAST(rank AS INTEGER) AS rank, round(score, 6) AS score FROM o WHERE rank <= 2")
def fused_rankings(t):
    """A ranking by words and one by place, fused by their ranks."""
    paras, path = _text_index(t)
    words = R.bm25(paras.sparkSession, path, _asked(t), 10)
    late = R.ranked(paras.select(F.explode(F.sequence(F.lit(0), F.lit(len(_ASKED) - 1))).alias("query_id"), "source", "para_id", F.col("para_id").alias("s")), 10, score="s")
    return R.fused(2, words, late).select("query_id", "source", "para_id", "rank", F.round("score", 6).alias("score"))


def _file() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


@query(None)
def tokenizer_counts(t):
    return t("documents").select("doc_id", N.token_count(F.col("text"), _file()).alias("n"))


@query(None)
def tokenizer_chunks(t):
    """Documents in chunks of some 400 tokens, with the tokens of each."""
    chunks = t("documents").select("doc_id", F.posexplode(N.chunked(F.col("text"), _file())).alias("chunk_id", "chunk"))
    return chunks.withColumn("n", N.token_count(F.col("chunk"), _file()))


@query("SELECT count(DISTINCT text) AS texts, true AS first FROM documents WHERE doc_id % 100 = 0 AND regexp_matches(text, '[a-z]')")
def nearest_are_copies(t):
    """The learned embedding of every hundredth text against all others: a text's own vector, that of its copies, comes first."""
    docs = t("documents").where("text IS NOT NULL").groupBy("text").agg(F.min("doc_id").alias("doc_id"), F.max((F.col("doc_id") % 100 == 0).cast("int")).alias("asked"))
    embed = M.learned_embedder(t("documents"), "text")
    rows = stored(docs.where(F.col("text").rlike("[a-z]")).select("doc_id", "asked", embed("text").alias("embedding")), "embedded")
    index = I.build(rows.select(F.col("doc_id").alias("id"), "embedding"), _folder(docs, "copies"), cells=1)
    asked = rows.where("asked = 1").select(F.col("doc_id").alias("query_id"), "embedding")
    found = index.search(asked, 5).groupBy("query_id").agg(F.max("similarity").alias("best"), F.max(F.when(F.col("id") == F.col("query_id"), F.col("similarity"))).alias("own"))
    return found.agg(F.count(F.lit(1)).alias("texts"), F.every(F.col("own") >= F.col("best") - 1e-6).alias("first"))


def _longer(prompt: str, text: str) -> list[str]:
    k = int(re.search(r"\d+", prompt)[0])
    return [w for w in text.split(" ") if len(w) > k]


_WORDS = "w AS (SELECT p_partkey, unnest(list_distinct(string_split(p_name, ' '))) AS word FROM part)"


def _rows(t, keep):
    words = F.split("p_name", " ")
    return t("part").where(keep).select(F.col("p_partkey").alias("id"), F.col("p_name").alias("input"), F.filter(words, lambda w: F.length(w) > 5).alias("expected"))


@query(f"WITH {_WORDS} SELECT CAST(k - 2 AS INTEGER) AS candidate, count(*) FILTER (len(word) > 5 AND len(word) > k) AS tp, count(*) FILTER (len(word) <= 5 AND len(word) > k) AS fp, count(*) FILTER (len(word) > 5 AND len(word) <= k) AS fn FROM w, range(2, 9) r(k) GROUP BY k")
def prompt_scores(t):
    """Seven prompts on every row, scored in one plan."""
    return O.scores(O.attempts([f"Words longer than {k}." for k in range(2, 9)], _rows(t, "true"), _longer)).select("candidate", "tp", "fp", "fn")


@query("SELECT * FROM (VALUES ('Words longer than 5.', 1.0::DOUBLE)) v(prompt, validation)")
def prompt_optimised(t):
    """From a prompt that takes too many words to one that is right, by what is proposed from its failures."""
    def propose(prompt, failed, passed, tried):
        k = int(re.search(r"\d+", prompt)[0])
        more = sum(r["fp"] for r in failed) > sum(r["fn"] for r in failed)
        return [f"Words longer than {k + (1 if more else -1)}.", prompt.upper()]

    got = O.optimise(["Words longer than 2.", "words  longer than 2.", "Words longer than 3."], _rows(t, "p_partkey % 2 = 0"), _rows(t, "p_partkey % 2 = 1"), _longer, propose, iterations=5)
    best = next(a for a in got if a.iteration >= 0)
    return t("part").sparkSession.createDataFrame([(best.prompt, best.validation)], "prompt string, validation double")
