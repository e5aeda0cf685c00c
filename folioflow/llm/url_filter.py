"""URL filter: host and path rules, and for all other urls a weighted vocabulary found by an Aho-Corasick automaton.

The automaton is one dense table, state x byte, that a batch of urls walks in step: a byte of every url at a time, urls cut
into pieces that overlap by the longest term, so that one very long url holds up nothing. A term counts only between bytes
that are no ASCII letters or digits. Strict terms weigh as much as the limit, so one rejects a url; of softer terms several
distinct ones must come together, however often each occurs. Nothing is shuffled.
"""

from __future__ import annotations

from collections import deque

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import text_view

#: Terms that reject a url alone, and terms of which two do. Fixed values.
STRICT = ("adult", "casino", "escort", "hentai", "jackpot", "milf", "nsfw", "porn", "porno", "pornhub", "viagra", "xvideos", "xxx")
SOFT = (
    "ads", "bet", "bets", "betting", "bonus", "cam", "cams", "cheap", "click", "crack", "dating", "deals", "farm", "free", "hack", "hot", "keygen", "loan", "loans",
    "nude", "pharma", "pills", "poker", "popup", "promo", "replica", "sex", "slots", "spam", "track", "tracker", "warez", "win", "winner",
)
LIMIT, STRICT_WEIGHT, SOFT_WEIGHT = 1.0, 1.0, 0.5
VOCABULARY = {**dict.fromkeys(STRICT, STRICT_WEIGHT), **dict.fromkeys(SOFT, SOFT_WEIGHT)}
#: Verdicts by host and path. Fixed values.
RULES = (("block", "net/"), ("allow", "example.net/en/"), ("block", "example.com/de/"), ("allow", "org/fr/"))

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_PIECE = 256
_low = np.arange(256, dtype=np.uint8)
_low[65:91] += 32
_WORD = np.zeros(256, bool)
_WORD[[*range(48, 58), *range(97, 123)]] = True


class Automaton:
    """Aho-Corasick over the UTF-8 bytes of the terms, A-Z lower-cased: next state for each state and byte, terms that end in each state."""

    def __init__(self, terms: list[str]):
        words = [bytes(_low[np.frombuffer(t.encode(), np.uint8)]) for t in terms]
        if not all(words):
            raise ValueError("a term is empty")
        self.sizes = np.array([len(w) for w in words], np.int64)
        self.longest = int(self.sizes.max(initial=1))
        table, ends = [[-1] * 256], [[]]
        for i, word in enumerate(words):
            at = 0
            for b in word:
                if table[at][b] < 0:
                    table[at][b] = len(table)
                    table.append([-1] * 256)
                    ends.append([])
                at = table[at][b]
            ends[at].append(i)
        fail, queue = [0] * len(table), deque()
        for b in range(256):
            if table[0][b] < 0:
                table[0][b] = 0
            else:
                queue.append(table[0][b])
        while queue:
            at = queue.popleft()
            ends[at] = ends[at] + ends[fail[at]]
            for b in range(256):
                to = table[at][b]
                if to < 0:
                    table[at][b] = table[fail[at]][b]
                else:
                    fail[to] = table[fail[at]][b]
                    queue.append(to)
        self.table = np.array(table, np.int32)
        self.counts = np.array([len(e) for e in ends])
        self.first = np.concatenate([[0], np.cumsum(self.counts)])
        self.terms = np.array([i for e in ends for i in e], np.int64)

    def hits(self, raw: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(row, term) of every occurrence with a boundary on both sides, for rows of UTF-8 bytes."""
        low = _low[raw]
        size = np.diff(offs)
        pieces = -(-size // _PIECE)
        row = np.repeat(np.arange(len(size)), pieces)
        begin = offs[row] + (np.arange(len(row)) - np.repeat(np.cumsum(pieces) - pieces, pieces)) * _PIECE
        end = np.minimum(begin + _PIECE, offs[row + 1])
        warm = np.maximum(begin - self.longest + 1, offs[row])
        order = np.argsort(warm - end, kind="stable")
        row, begin, end, at = row[order], begin[order], end[order], warm[order]
        state, live, found = np.zeros(len(row), np.int32), len(row), []
        length = end - at
        for j in range(int(length[0]) if live else 0):
            while live and length[live - 1] <= j:
                live -= 1
            here = at[:live] + j
            state[:live] = self.table[state[:live], low[here]]
            some = np.flatnonzero((self.counts[state[:live]] > 0) & (here >= begin[:live]))
            if len(some):
                found.append((row[some], here[some], state[some]))
        if not found:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        rows, last, states = (np.concatenate(x) for x in zip(*found, strict=True))
        n = self.counts[states]
        term = self.terms[np.repeat(self.first[states], n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)]
        rows, last = np.repeat(rows, n), np.repeat(last, n)
        begun = last - self.sizes[term] + 1
        word = np.append(_WORD[low], False)
        open_left = (begun == offs[rows]) | ~word[begun - 1]
        open_right = (last + 1 == offs[rows + 1]) | ~word[last + 1]
        keep = open_left & open_right
        return rows[keep], term[keep]


def _fitting(host: str, by_host: dict) -> tuple:
    """Rules whose host is this one or holds it as a subdomain, the longest first."""
    labels = host.split(".")
    found = [r for k in range(len(labels)) for r in by_host.get(".".join(labels[k:]), ())]
    return tuple(sorted(found, key=lambda r: (-len(r[0]), r)))


def url_verdicts(
    pages: DataFrame, id_col: str = "page_id", url_col: str = "url", rules: tuple = RULES, vocabulary: dict[str, float] = VOCABULARY, limit: float = LIMIT
) -> DataFrame:
    """One row per input row: page_id, host, path, rule, verdict, n_strict, n_soft, terms.

    rules are (verdict, host and path) pairs and vocabulary gives terms their weights; both go to the tasks with the function, so
    they are lists of a filter's size (thousands), not tables. The host is what follows the first `://` up to `/`, `?`, `#` or the
    end, A-Z lower-cased, the path what follows up to `?`, `#` or the end; without `://`, and where the url is null or empty, both
    are empty, and no rule fits but one of an empty host. A rule fits its host and all subdomains where the path starts with the
    rule's; the longest rule wins, of rules of one length the first by text and verdict. Where none fits, a url is blocked if the
    weights of the distinct terms in it reach the limit; the whole url is searched, A-Z lower-cased, however long. n_strict and
    n_soft count occurrences of terms at or above the limit and below it, terms lists the distinct ones by name. Rows are judged
    one by one: repeated rows and ids get equal answers, a null id stays null, an empty table gives an empty result, other columns
    are ignored.
    """
    words = sorted(vocabulary)
    weight = np.array([float(vocabulary[w]) for w in words])
    by_host: dict[str, list] = {}
    for verdict, rule in rules:
        host, slash, path = rule.partition("/")
        by_host.setdefault(host.translate(str.maketrans(UPPER, LOWER)), []).append((rule, slash + path, verdict))

    def judged(batches):
        machine = Automaton(words) if words else None
        for batch in batches:
            ids, url, host, path = batch.columns
            n = batch.num_rows
            rows, terms = machine.hits(*text_view(url)) if machine else (np.zeros(0, np.int64),) * 2
            strict = weight[terms] >= limit if words else np.zeros(0, bool)
            n_strict, n_soft = np.bincount(rows[strict], minlength=n), np.bincount(rows[~strict], minlength=n)
            pairs = np.unique(rows * max(1, len(words)) + terms)
            who, what = pairs // max(1, len(words)), pairs % max(1, len(words))
            score = np.bincount(who, weight[what] if words else None, minlength=n)
            cut = np.searchsorted(who, np.arange(n + 1))
            named = [",".join(words[t] for t in what[cut[i] : cut[i + 1]]) if cut[i] < cut[i + 1] else "" for i in range(n)]
            rule, verdict = np.full(n, None, object), np.where(score >= limit, "block", "allow").astype(object)
            coded = host.dictionary_encode()
            fits = [_fitting(h, by_host) for h in coded.dictionary.to_pylist()]
            kinds = {f: i for i, f in enumerate(dict.fromkeys(fits))}
            kind = np.array([kinds[f] for f in fits], np.int64)[coded.indices.to_numpy()] if n else np.zeros(0, np.int64)
            for fit, i in kinds.items():
                left = np.flatnonzero(kind == i)
                for text, prefix, said in fit:
                    if not len(left):
                        break
                    own = pc.starts_with(path.take(pa.array(left)), prefix).to_numpy(zero_copy_only=False)
                    rule[left[own]], verdict[left[own]] = text, said
                    left = left[~own]
            yield pa.RecordBatch.from_arrays(
                [ids, host, path, pa.array(rule, pa.string()), pa.array(verdict, pa.string()), pa.array(n_strict, pa.int64()), pa.array(n_soft, pa.int64()), pa.array(named, pa.string())],
                names=["page_id", "host", "path", "rule", "verdict", "n_strict", "n_soft", "terms"],
            )

    url = F.coalesce(F.col(url_col), F.lit(""))
    parts = r"(?s)^.*?://([^/?#]*)([^?#]*)"
    # No word of regexp_extract is null here: the url is not, and a url without "://" gives empty groups.
    rows = pages.select(F.col(id_col).alias("page_id"), url.alias("url"), F.translate(F.regexp_extract(url, parts, 1), UPPER, LOWER).alias("host"), F.regexp_extract(url, parts, 2).alias("path"))
    kind = rows.schema["page_id"].dataType.simpleString()
    return rows.mapInArrow(judged, f"page_id {kind}, host string, path string, rule string, verdict string, n_strict long, n_soft long, terms string")


def keep_allowed(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", **how) -> DataFrame:
    """The rows of pages whose url is allowed, with all their columns; the same verdict for every row that holds the same url."""
    bad = url_verdicts(pages.select(F.col(url_col).alias("_url")).distinct(), "_url", "_url", **how).where("verdict = 'block'").select(F.col("page_id").alias("_bad"))
    return pages.join(bad, pages[url_col] == bad["_bad"], "left_anti")


def _values(rows) -> str:
    return ", ".join("(" + ", ".join(f"'{x}'" if isinstance(x, str) else str(x) for x in r) + ")" for r in rows)


#: Every other byte becomes two blanks, so a term between two of them is looked for with its blanks and hits never overlap.
ORACLE = rf"""
WITH u AS (
  SELECT page_id, translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)([^?#]*)', 1), '{UPPER}', '{LOWER}') AS host,
    regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)([^?#]*)', 2) AS path,
    '  ' || regexp_replace(translate(coalesce(url, ''), '{UPPER}', '{LOWER}'), '[^a-z0-9]', '  ', 'g') || '  ' AS words
  FROM pages
), rules(verdict, rule, host, path) AS (VALUES {_values((v, r, r.partition("/")[0], "/" + r.partition("/")[2]) for v, r in RULES)}),
fits AS (
  SELECT page_id, max(struct_pack(n := length(rule), rule := rule, verdict := verdict)) AS best
  FROM u JOIN rules r ON (u.host = r.host OR ends_with(u.host, '.' || r.host)) AND starts_with(u.path, r.path) GROUP BY page_id
), vocabulary(term, weight) AS (VALUES {_values(VOCABULARY.items())}),
found AS (
  SELECT page_id, term, weight, (length(words) - length(replace(words, ' ' || term || ' ', ''))) // (length(term) + 2) AS n
  FROM u, vocabulary WHERE contains(words, ' ' || term || ' ')
), scored AS (
  SELECT page_id, sum(weight) AS score, (sum(n) FILTER (weight >= {LIMIT}))::BIGINT AS n_strict, (sum(n) FILTER (weight < {LIMIT}))::BIGINT AS n_soft, string_agg(term, ',' ORDER BY term) AS terms
  FROM found GROUP BY page_id
)
SELECT page_id, host, path, best.rule AS rule, coalesce(best.verdict, CASE WHEN score >= {LIMIT} THEN 'block' ELSE 'allow' END) AS verdict,
  coalesce(n_strict, 0) AS n_strict, coalesce(n_soft, 0) AS n_soft, coalesce(terms, '') AS terms
FROM u LEFT JOIN fits USING (page_id) LEFT JOIN scored USING (page_id)
"""
