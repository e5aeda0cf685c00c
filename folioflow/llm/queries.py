"""The training-data operators as queries over the driver's tables, with their SQL where SQL can express them."""

from __future__ import annotations

from .common import read
from .decontaminate import ORACLE as CONTAMINATION_SQL
from .decontaminate import contamination
from .exact_dedup import ORACLE as EXACT_SQL
from .exact_dedup import exact_groups
from .html_text import extract
from .language import identify
from .mixing import mixture
from .near_dedup import near_duplicates
from .prefix_trie import ORACLE as TRIE_SQL
from .prefix_trie import prefix_trie
from .secrets import ORACLE as SECRETS_SQL
from .secrets import find_secrets
from .suffix_dedup import suffix_dedup
from .token_files import token_output
from .toxicity import toxicity
from .url_filter import ORACLE as URL_SQL
from .url_filter import url_verdicts
from .vector_codes import ORACLE as CODES_SQL
from .vector_codes import compress


def op1_mixing(spark, sf_dir):
    return mixture(read(spark, sf_dir, "documents"))


def op2_exact_dedup(spark, sf_dir):
    return exact_groups(read(spark, sf_dir, "documents"))


def op3_html_extraction(spark, sf_dir):
    return extract(read(spark, sf_dir, "pages"))


def op4_language_id(spark, sf_dir):
    return identify(read(spark, sf_dir, "documents"))


def op5_minhash_near_dedup(spark, sf_dir):
    return near_duplicates(read(spark, sf_dir, "documents"))


def op6_toxicity(spark, sf_dir):
    return toxicity(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def op7_suffix_dedup(spark, sf_dir):
    return suffix_dedup(read(spark, sf_dir, "documents"))


def op8_secret_scan(spark, sf_dir):
    return find_secrets(read(spark, sf_dir, "documents"))


def op9_decontaminate(spark, sf_dir):
    return contamination(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


def op10_token_output(spark, sf_dir):
    return token_output(read(spark, sf_dir, "documents"))


def op11_prefix_trie(spark, sf_dir):
    return prefix_trie(read(spark, sf_dir, "conversations"))


def op12_url_filter(spark, sf_dir):
    return url_verdicts(read(spark, sf_dir, "pages"))


def op13_vector_codes(spark, sf_dir):
    return compress(read(spark, sf_dir, "embeddings"))


QUERIES = {
    f.__name__: f
    for f in (
        op1_mixing, op2_exact_dedup, op3_html_extraction, op4_language_id, op5_minhash_near_dedup, op6_toxicity, op7_suffix_dedup, op8_secret_scan, op9_decontaminate, op10_token_output,
        op11_prefix_trie, op12_url_filter, op13_vector_codes,
    )
}
ORACLE_SQL = {
    "op2_exact_dedup": EXACT_SQL, "op8_secret_scan": SECRETS_SQL, "op9_decontaminate": CONTAMINATION_SQL, "op11_prefix_trie": TRIE_SQL, "op12_url_filter": URL_SQL, "op13_vector_codes": CODES_SQL,
}
