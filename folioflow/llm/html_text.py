"""HTML extraction by union-free wrappers, inferred per host.

A page is read as a tree. Runs of like siblings fold into one repeated group, and text becomes a slot. The folded pages
of a host are aligned one after the other: children that only some pages have become optional, children that occur
again become repeated, a slot keeps its text, and a repeated group a digest of its texts, only while all pages agree. The result is a regular expression without
unions - tags, optional and repeated groups, text slots - that generates the host's pages.

Which pages meet, and in what order, follows from their content alone: the distinct pages of a host are dealt into groups
of about GROUP by the hash of their bytes, aligned in the order of these hashes, then the groups' wrappers in groups of
GROUP again, until a host has one. So every page takes part, the result is the same on any number of partitions, a host
with a third of all pages is spread over as many tasks as it has groups, and a task holds one wrapper and one page.
Copies of a page are dropped where they are read, before anything is shuffled, and where they meet.

A page's main text is its articles, one after the other: regions that are navigation, forms or asides by their tag or role are
left out; those that only a class or id names so need a second sign (see _furniture), and reader comments are told by their
names or by the author, date and reply that their repeated entries have. Around the article, and on pages without one, text that
the host's wrapper holds constant on nearly all of its distinct pages is left out too; in an article it stays.
"""

from __future__ import annotations

import hashlib
import html as entities
import json
import math
import re
from collections import Counter

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import Workspace

_TOKEN = re.compile(r"<!--.*?(?:-->|$)|<(script|style|noscript|template|svg|textarea|iframe|title)\b[^>]*>.*?(?:</\1\s*>|$)|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>|<[!?][^>]*(?:>|$)|<(?=[a-zA-Z/!])[^<>]*$|[^<]+|<", re.S | re.I)
_ATTR = re.compile(r"(class|id|role|hidden|aria-hidden|style)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?", re.I)
_VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
_BLOCK = frozenset("address article aside blockquote body center dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr html li main nav ol p pre section summary table tbody tfoot thead tr ul".split())
_NO_P = _BLOCK - frozenset(("html", "body"))
_SKIP = frozenset("nav footer aside form head button select label menu dialog input option".split())
_SKIP_WORDS = re.compile(
    r"(?:^|[\s_-])(?:ads?|advert\w*|sponsor\w*|promo\w*|banners?|nav\w*|menus?|breadcrumbs?|side|sidebars?|footers?|cookies?|consent|notices?|popups?|modals?|overlay|newsletter|subscribe|signup|login|search|social|share|sharing|"
    r"related|recommend\w*|comments?|respond|repl(?:y|ies)|disqus|discussion|widgets?|toolbar|skip|pagination|pager|copyright|legal|disclaimer|alerts?)(?:$|[\s_-])",
    re.I,
)
#: Those that also name sections of an article; there they need a second sign.
_SECTION_WORDS = re.compile(r"(?:^|[\s_-])(?:side|notices?|consent|overlay|search|social|related|recommend\w*|repl(?:y|ies)|discussion|copyright|legal|disclaimer|alerts?|skip|banners?)(?:$|[\s_-])", re.I)
#: What else the name of such an element says: a place or a kind of box.
_PLACES = frozenset("a area article bar block body bottom box button buttons card column container content global group head header icon id in inline inner item items js left link links list main mobile outer page panel post right row section site slot small sticky text thread top unit user view wrap wrapper zone".split())
#: Names of reader comments, what may stand beside them in such a name, and words that need the entries as evidence.
_COMMENTS = re.compile(r"(?:comments?|commentlist|commentary|disqus|respond|repl(?:y|ies)|responses?)", re.I)
_READERS = frozenset("reader readers user users visitor visitors public latest all top recent our your facebook fb wp js count".split())
_MAYBE_COMMENTS = re.compile(r"(?:^|[\s_-])(?:comments?\w*|disqus|respond|repl(?:y|ies)|responses?|opinions?|reactions?|discussions?|reviews?|feedback|voices|letters|forum|thread|conversation)(?:$|[\s_-])", re.I)
_BYLINE = re.compile(r"(?:^|[\s_-])(?:author|user|username|avatar|nick(?:name)?|by|byline|posted|date|time(?:stamp)?|ago|reply|likes?|vote|flag|permalink|meta)(?:$|[\s_-])", re.I)
#: A layout that says what it has (has-sidebar, no-nav) is not that thing.
_STATE = re.compile(r"(?:^|(?<=\s))(?:has|with|without|no|show|hide)[_-]\S*", re.I)
_HEADER_WORD = re.compile(r"(?:^|[\s_-])(?:header|masthead|topbar)(?:$|[\s_-])", re.I)
_MAIN_WORD = re.compile(r"(?:^|[\s_-])(?:content|article|post|entry|story|main)(?:$|[\s_-])", re.I)
_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar".split())
_LEAST_PAGES, _NEARLY_ALL, _MOST_TEXT, _LONG_PATH = 3, 0.95, 300, 200
GROUP, _MOST_SEEN, _FEW_HOSTS, _MOST_PARTS = 256, 200_000, 100_000, 20_000


class Node:
    """An element (tag, its classes and ids, kids) or, with tag '#', a piece of text."""

    __slots__ = ("tag", "names", "role", "hidden", "kids", "text", "group", "size", "links", "main")

    def __init__(self, tag, names="", role="", hidden=False, text=""):
        self.tag, self.names, self.role, self.hidden, self.kids, self.text = tag, names, role, hidden, [], text
        self.group, self.size, self.links, self.main = None, 0, 0, False


def parse(page: str) -> Node:
    """A forgiving tree: unclosed paragraphs and list items end where the next one starts, stray end tags are dropped."""
    root = Node("#root")
    stack = [root]
    live: Counter = Counter()  # tags of the stack, so that a stray end tag need not look through it

    def close(k):
        live.subtract(n.tag for n in stack[k:])
        del stack[k:]

    for m in _TOKEN.finditer(page):
        tag = m[3]
        if tag is None:
            raw = m[0]
            if m[1] is None and (raw == "<" or raw[0] != "<"):
                text = entities.unescape(raw)
                top = stack[-1].kids
                if top and top[-1].tag == "#":
                    top[-1].text += text
                else:
                    top.append(Node("#", text=text))
            continue
        tag = tag.lower()
        if m[2]:
            if live[tag] > 0:
                close(next(k for k in range(len(stack) - 1, 0, -1) if stack[k].tag == tag))
            continue
        names, role, hidden = "", "", False
        if m[4] and not m[4].isspace():
            for a in _ATTR.finditer(m[4]):
                key, value = a[1].lower(), a[2] or a[3] or a[4] or ""
                if key in ("class", "id"):
                    names = f"{names} {value}".strip()
                elif key == "role":
                    role = value.lower()
                elif key == "style":
                    hidden |= "display:none" in value.replace(" ", "").lower()
                else:
                    hidden |= key == "hidden" or value.lower() == "true"
        ends = ("p",) if tag in _NO_P else ()
        ends += {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr",), "td": ("td", "th"), "th": ("td", "th")}.get(tag, ())
        if any(live[t] > 0 for t in ends):
            for k in range(len(stack) - 1, 0, -1):
                if stack[k].tag in ends:
                    close(k)
                    break
                if stack[k].tag in _BLOCK and stack[k].tag not in ends:
                    break
        node = Node(tag, names, role, hidden)
        stack[-1].kids.append(node)
        if tag not in _VOID:
            stack.append(node)
            live[tag] += 1
    return root


def _run(walk):
    """Run a recursion written as generators (yield a call, get its result), however deep it goes."""
    stack, value = [walk], None
    while stack:
        try:
            stack.append(stack[-1].send(value))
            value = None
        except StopIteration as done:
            stack.pop()
            value = done.value
    return value


def _at(path: str, key: str) -> str:
    """The path of a kid; a long one is hashed, so that deep pages do not cost the square of their depth."""
    path = f"{path}/{key}"
    return path if len(path) <= _LONG_PATH else "#" + _digest(path)


def _digest(text: str) -> str:
    return hashlib.blake2b(text.encode("utf-8", "surrogatepass"), digest_size=16).hexdigest()


def _slot(text: str) -> str:
    """What a slot remembers of its text: the text with single blanks, of a long one a digest."""
    text = " ".join(text.split())
    return text if len(text) <= _MOST_TEXT else "\x00" + _digest(text)


# A wrapper node is [key, optional, repeated, text or None, pages, kids]. The text of a repeated group is a digest of the
# texts of all its members on a page; other elements have none.


def fold(node: Node) -> list:
    """The page as a wrapper: like neighbours among the kids become one repeated group."""
    w = _run(_fold(node))
    if w[0] != "#":
        w[3] = None
    return w


def _fold(node: Node):
    if node.tag == "#":
        return ["#", False, False, _slot(node.text), 1, []]
    kids: list = []
    groups: list[list[Node]] = []
    for kid in node.kids:
        if kid.tag == "#" and not kid.text.strip():
            continue
        new = yield _fold(kid)
        if kids and kids[-1][0] == new[0]:
            text = _digest(f"{kids[-1][3]} {new[3]}")
            kids[-1] = yield _align(kids[-1], new, True)
            kids[-1][2:4] = True, text
            groups[-1].append(kid)
        else:
            kids.append(new)
            groups.append([kid])
    text = _digest(" ".join(k[3] for k in kids))
    for kid, members in zip(kids, groups, strict=True):
        if kid[2]:
            kid[3] = "\x01" + kid[3]
            for member in members:
                member.group = kid[3]
        elif kid[0] != "#":
            kid[3] = None
    return [f"{node.tag}.{node.names}" if node.names else node.tag, False, False, text, 1, kids]


def align(a: list, b: list, same_page: bool = False) -> list:
    """The least wrapper of both: kids are matched along a longest common subsequence, the unmatched become optional."""
    return _run(_align(a, b, same_page))


def _matched(a: list[str], b: list[str]):
    """Pairs of places (place in a, place in b) along a longest common subsequence, None beside the unmatched. What both
    begin and end with is matched first, so that the table is only as large as the part that differs."""
    low, high = 0, 0
    while low < min(len(a), len(b)) and a[low] == b[low]:
        low += 1
    while high < min(len(a), len(b)) - low and a[-1 - high] == b[-1 - high]:
        high += 1
    n, m = len(a) - low - high, len(b) - low - high
    best = [[0] * (m + 1) for _ in range(n + 1)]
    for i in range(n - 1, -1, -1):
        for j in range(m - 1, -1, -1):
            best[i][j] = best[i + 1][j + 1] + 1 if a[low + i] == b[low + j] else max(best[i + 1][j], best[i][j + 1])
    yield from ((k, k) for k in range(low))
    i = j = 0
    while i < n or j < m:
        if i < n and j < m and a[low + i] == b[low + j]:
            yield low + i, low + j
            i, j = i + 1, j + 1
        elif j == m or i < n and best[i + 1][j] >= best[i][j + 1]:
            yield low + i, None
            i += 1
        else:
            yield None, low + j
            j += 1
    yield from ((len(a) - k, len(b) - k) for k in range(high, 0, -1))


def _align(a: list, b: list, same_page: bool):
    pages = a[4] if same_page else a[4] + b[4]
    text = a[3] if a[3] == b[3] else None
    ka, kb = a[5], b[5]
    if [k[0] for k in ka] == [k[0] for k in kb]:
        kids = []
        for x, y in zip(ka, kb, strict=True):
            kids.append((yield _align(x, y, same_page)))
    else:
        kids = []
        for x, y in _matched([k[0] for k in ka], [k[0] for k in kb]):
            if x is not None and y is not None:
                kids.append((yield _align(ka[x], kb[y], same_page)))
                continue
            node = ka[x] if y is None else kb[y]
            if kids and kids[-1][0] == node[0]:  # again: a repeated group
                kids[-1] = yield _align(kids[-1], node, True)
                kids[-1][2:4] = True, None
            else:
                kids.append([node[0], True, *node[2:]])
    return [a[0], a[1] or b[1], a[2] or b[2], text, pages, kids]


def expression(w: list) -> str:
    """The wrapper as a regular expression: ()? optional, ()+ repeated, #text a slot."""
    out: list[str] = []
    todo: list = [w]
    while todo:
        w = todo.pop()
        if isinstance(w, str):
            out.append(w)
            continue
        end = ")" + ("*" if w[1] and w[2] else "?" if w[1] else "+") if w[1] or w[2] else ""
        start = "(" if end else ""
        if w[0] == "#":
            out.append(start + ("#text" if w[3] is None or w[3][:1] == "\x00" else w[3]) + end)
        else:
            out.append(f"{start}<{w[0]}>")
            todo += ["</>" + end, *reversed(w[5])]
    return "".join(out)


def dump(w: list) -> str:
    """A wrapper as flat JSON, parents first with the number of their kids."""
    flat, todo = [], [w]
    while todo:
        w = todo.pop()
        flat.append([*w[:5], len(w[5])])
        todo += reversed(w[5])
    return json.dumps(flat)


def load(text: str) -> list:
    """The wrapper that dump wrote."""
    done: list = []
    for *head, n in reversed(json.loads(text)):
        kids = done[len(done) - n :][::-1]
        del done[len(done) - n :]
        done.append([*head, kids])
    return done[0]


def fixed_slots(w: list, least: int = _LEAST_PAGES) -> set[tuple[str, str]]:
    """(path, text) of slots and repeated groups that nearly all of the host's pages, and `least` of them, have and fill
    alike, if some other slot varies. What only some pages have is no template, however many of them agree."""
    out: set[tuple[str, str]] = set()
    least = max(least, math.ceil(_NEARLY_ALL * w[4]))
    varying = 0
    todo = [(w, _at("", w[0]))]
    while todo:
        node, path = todo.pop()
        if node[3] is None:
            varying += node[0] == "#"
        elif node[4] >= least and node[2] == (node[3][:1] == "\x01"):
            out.add((path, node[3]))
        todo += [(kid, _at(path, kid[0])) for kid in reversed(node[5])]
    return out if varying else set()


def constants(w: list, least: int = _LEAST_PAGES) -> dict[str, str]:
    """fixed_slots as path -> text."""
    return dict(fixed_slots(w, least))


def _skipped(node: Node, inside: bool) -> bool:
    if node.hidden or node.tag in _SKIP or node.role in _ROLES:
        return True
    return not inside and (node.tag == "header" or bool(node.names and _HEADER_WORD.search(node.names)))


def _worded(node: Node) -> bool:
    """Named like furniture of a page. That is one sign only; _furniture asks for another."""
    return bool(node.names) and node.tag not in ("html", "body", "article", "main") and bool(_SKIP_WORDS.search(_STATE.sub(" ", node.names)))


def _entries(node: Node) -> bool:
    """Whether the element holds a run of entries of which most have an author, a date or a reply: at least two alike."""
    level = node
    for _ in range(4):  # wrappers around the list
        kids = [k for k in level.kids if k.tag != "#" and not k.hidden]
        names = Counter((k.tag, k.names.split()[0] if k.names else "") for k in kids)
        kind, n = names.most_common(1)[0] if names else (None, 0)
        if n >= 2:
            alike = [k for k in kids if (k.tag, k.names.split()[0] if k.names else "") == kind]
            return 2 * sum(_signed(k) for k in alike) > n
        inner = max(kids, key=lambda k: k.size, default=None)
        if inner is None:
            return False
        level = inner
    return False


def _signed(entry: Node) -> bool:
    todo = [entry]
    while todo:
        node = todo.pop()
        if node is not entry and (node.tag == "time" or node.names and _BYLINE.search(node.names)):
            return True
        todo += [k for k in node.kids if k.tag != "#"]
    return False


def _by_readers(node: Node) -> bool:
    """Reader comments, however long they are: named so and nothing else (reader-comments, comment-list; not comments-on-plato), or
    named as something that readers may have written and made of entries with authors, dates or replies."""
    if not node.names or node.tag in ("html", "body", "main") or not _MAYBE_COMMENTS.search(_STATE.sub(" ", node.names)):
        return False
    for name in _STATE.sub(" ", node.names.lower()).split():
        parts = [p for p in re.split("[_-]+", name) if p.strip("0123456789")]
        if any(_COMMENTS.fullmatch(p) for p in parts) and all(_COMMENTS.fullmatch(p) or p in _PLACES or p in _READERS for p in parts):
            return True
    return _entries(node)


def _furniture(node: Node, inside: bool, whole: int) -> bool:
    """Whether a worded element goes: it must hold at most half of the varying text around it. Inside an article it must also
    be mostly links, or have a name that says furniture and nothing else (comments, ad-slot-2; not comments-on-plato) with a
    word that sections do not have too."""
    if 2 * node.size > whole:
        return False
    if not inside or 2 * node.links >= node.size:
        return True
    return any(_SKIP_WORDS.search(_SECTION_WORDS.sub("  ", name)) and all(_SKIP_WORDS.fullmatch(part) or part in _PLACES or not part.strip("0123456789") for part in re.split("[_-]+", name)) for name in _STATE.sub(" ", node.names.lower()).split())


def _measure(root: Node, fixed: set) -> None:
    """For each element: its characters of text that varies on the host, those in links, and whether it holds an article."""
    seen: list[tuple[Node, Node | None]] = []
    todo: list = [(root, None, "/#root", False)]
    while todo:
        node, above, path, link = todo.pop()
        seen.append((node, above))
        for kid in node.kids:
            at = None if path is None else _at(path, f"{kid.tag}.{kid.names}" if kid.names else kid.tag)
            if kid.group is not None and (at, kid.group) in fixed:
                at = None
            if kid.tag == "#":
                text = " ".join(kid.text.split())
                if at is not None and (at, _slot(text)) not in fixed:
                    node.size += len(text)
                    node.links += len(text) if link else 0
            elif not (kid.hidden or kid.tag in _SKIP or kid.role in _ROLES):
                todo.append((kid, node, at, link or kid.tag == "a"))
    for node, above in reversed(seen):
        if above is not None:
            above.size += node.size
            above.links += node.links
            above.main |= node.main or node.tag in ("article", "main") or node.role in ("article", "main")


def _blocks(node: Node, path: str | None, inside: bool, whole: int, fixed: set, out: list, run: list, own: bool):
    """Collect (text, [(path, slot)], own) blocks below node, in page order; the path is None below a group that is constant. Own
    blocks are the article's, whatever other pages have."""
    for kid in node.kids:
        at = None if path is None else _at(path, f"{kid.tag}.{kid.names}" if kid.names else kid.tag)
        if kid.group is not None and (at, kid.group) in fixed:
            at = None
        if kid.tag == "#":
            run.append((kid.text, at))
            continue
        if _skipped(kid, inside) or _by_readers(kid) or _worded(kid) and _furniture(kid, inside, whole):
            continue
        block = kid.tag in _BLOCK
        if block:
            _flush(run, out, own)
        elif kid.tag in ("br", "td", "th", "img"):
            run.append((" ", ""))
        inner = own or kid.tag == "article" or kid.role == "article"
        yield _blocks(kid, at, inside or kid.tag in ("article", "main"), whole, fixed, out, run, inner)
        if block:
            _flush(run, out, inner)


def _flush(run: list, out: list, own: bool) -> None:
    text = " ".join("".join([t for t, _ in run]).split())
    if text:
        out.append((text, [(p, _slot(t)) for t, p in run if t.strip()], own))
    run.clear()


def _regions(root: Node):
    """(rank, weak, node, path) of candidate article regions outside skipped ones, in page order; one below another of its rank, or
    below an article or main element, adds nothing.

    Weak ones lie in a worded element or have such a name; that is left out unless it holds an article or most of the page's text.
    """
    todo = [(root, "/#root", False, 0, False)]
    while todo:
        node, path, inside, above, weak = todo.pop()
        if node is not root:
            rank = 3 if node.tag == "article" or node.role == "article" else 2 if node.tag == "main" or node.role == "main" else 1 if node.names and _MAIN_WORD.search(node.names) and node.tag in ("div", "section", "td") else 0
            if rank > above and above < 2:
                yield rank, weak or bool(node.names) and (_by_readers(node) or bool(_SKIP_WORDS.search(_STATE.sub(" ", node.names)))), node, path
            inside, above = inside or rank >= 2, max(above, rank)
        for kid in reversed(node.kids):
            if kid.tag != "#" and not _skipped(kid, inside) and (kid.tag == "article" or not _by_readers(kid)):
                named = _worded(kid)
                if not named or kid.main or not _furniture(kid, inside, root.size):
                    todo.append((kid, _at(path, f"{kid.tag}.{kid.names}" if kid.names else kid.tag), inside, above, weak or named))


def main_text(page: str, fixed: set[tuple[str, str]] | dict[str, str]) -> str:
    """Blocks of the page's articles, without what the host's wrapper holds constant around them.

    All article and main elements of the page, in page order; where none has text, the longest of the regions that are named
    like content, or else the page. A main element with articles in it is theirs and what else it holds.
    """
    root = parse(page)
    fixed = set(fixed.items()) if isinstance(fixed, dict) else fixed
    if any(t[:1] == "\x01" for _, t in fixed):
        fold(root)  # marks the members of groups
    _measure(root, fixed)
    regions = list(_regions(root))
    best: list = []
    order = lambda rank, weak: (rank >= 2, not weak, min(rank, 2))
    ranks = sorted({order(r, w) for r, w, *_ in regions}, reverse=True) or [None]
    for top in ranks:
        inside = bool(top and top[0])
        if top != ranks[0] and (best or not inside):
            break
        for node, path in [(n, p) for r, w, n, p in regions if order(r, w) == top] or [(root, "/#root")]:
            out: list = []
            run: list = []
            own = inside and (node.tag == "article" or node.role == "article" or not node.main)  # a main element without an article in it is the article
            _run(_blocks(node, path, inside, node.size, fixed, out, run, own))
            _flush(run, out, own)
            if inside:
                best += out
            elif sum(len(t) for t, *_ in out) > sum(len(t) for t, *_ in best):
                best = out
    kept = [t for t, parts, own in best if own or not all(p is None or (p, t2) in fixed for p, t2 in parts)]
    return "\n".join(kept or [t for t, *_ in best])


def host_of(url: Column) -> Column:
    return F.coalesce(F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/@]*@)?([^/:?#]*)", 1)), F.lit(""))


def _unlike(batches):
    """The rows (host, hash, html) whose page a task has not just had; what is remembered is bounded."""
    seen: set = set()
    for batch in batches:
        keep = []
        for host, h in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            keep.append((host, h) not in seen)
            if len(seen) >= _MOST_SEEN:
                seen.clear()
            seen.add((host, h))
        yield batch.filter(pa.array(keep, pa.bool_()))


def _merged(make):
    """Neighbouring rows (host, bucket, hash, text) with one host and bucket to one wrapper of their distinct texts; make reads a text."""

    def run(batches):
        key, last, wrapper = None, None, None
        names = ["host", "bucket", "wrapper"]
        for batch in batches:
            out = []
            for host, bucket, h, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if (host, bucket) != key:
                    if wrapper is not None:
                        out.append((*key, dump(wrapper)))
                    key, last, wrapper = (host, bucket), None, None
                if (h, text) == last:
                    continue
                last, own = (h, text), make(text)
                wrapper = own if wrapper is None else align(wrapper, own)
            yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in out], pa.string()), pa.array([r[1] for r in out], pa.int64()), pa.array([r[2] for r in out], pa.string())], names)
        if wrapper is not None:
            yield pa.RecordBatch.from_arrays([pa.array([key[0]], pa.string()), pa.array([key[1]], pa.int64()), pa.array([dump(wrapper)], pa.string())], names)

    return run


def wrappers(pages: DataFrame, ws: Workspace, group: int = GROUP) -> DataFrame:
    """(host, wrapper) from pages(host, html): aligned in groups of a host's pages, then in groups of its wrappers, down to one.

    Copies of a page count once, as they would make an article look like template.
    """
    schema = "host string, bucket long, wrapper string"
    pages = pages.where("trim(html) <> ''")
    counts = pages.groupBy("host").agg(F.ceil(F.count(F.lit(1)) / group).alias("groups"))
    hosts = ws.table(counts, "hosts")
    most, every = (x or 0 for x in hosts.agg(F.max("groups"), F.sum("groups")).first())
    # Tasks of about four groups, as many as there are, so that the largest does not grow with the input.
    parts = max(int(pages.sparkSession.conf.get("spark.sql.shuffle.partitions")), min(every // 4, _MOST_PARTS))
    rows = pages.select("host", F.xxhash64("html").alias("hash"), F.coalesce("html", F.lit("")).alias("html")).mapInArrow(_unlike, "host string, hash long, html string")
    small = F.broadcast if hosts.count() <= _FEW_HOSTS else lambda df: df  # a host is a name and a number
    dealt = rows.join(small(hosts), "host").select("host", F.pmod("hash", "groups").alias("bucket"), "hash", "html")
    now = dealt.repartition(parts, "host", "bucket").sortWithinPartitions("host", "bucket", "hash", "html").mapInArrow(_merged(lambda text: fold(parse(text))), schema)
    now = ws.table(now, "level-0")
    level = 0
    while most > 1:
        level, most = level + 1, -(-most // group)
        up = now.select("host", F.floor(F.col("bucket") / group).alias("up"), "bucket", "wrapper")
        now = ws.table(up.repartition("host", "up").sortWithinPartitions("host", "up", "bucket").mapInArrow(_merged(load), schema), f"level-{level}")
        ws.drop(f"level-{level - 1}")
    return now.select("host", "wrapper")


def _fixed(batches):
    """Each host's template as JSON."""
    for batch in batches:
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([json.dumps(sorted(fixed_slots(load(w)))) for w in batch.column(1).to_pylist()], pa.string())], ["host", "fixed"])


def _extract(batches):
    known: dict[str, set] = {}
    for batch in batches:
        texts = []
        for page, fixed in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True):
            if fixed not in known:
                if len(known) > 2000:
                    known.clear()
                known[fixed] = {tuple(x) for x in json.loads(fixed)} if fixed else set()
            texts.append(main_text(page or "", known[fixed]))
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], ["page_id", "url", "text", "n_chars"])


def extract(pages: DataFrame, broadcast_bytes: int = 32 << 20, salts: int = 32) -> DataFrame:
    """One row per input row: page_id, url, text, n_chars.

    A null page or one without an article text gives an empty text; a null url is a host of its own; repeated rows are
    each extracted; pages of any size and depth are read whole; extra columns are ignored; an empty table gives none. The
    hosts' templates are broadcast when they measure at most broadcast_bytes; else they are joined, each host dealt over
    `salts` keys.
    """
    ws = Workspace(pages.sparkSession, "html")
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", "html", host_of(F.col("url")).alias("host"))
    known = ws.table(wrappers(rows.select("host", "html"), ws).mapInArrow(_fixed, "host string, fixed string"), "fixed")
    size = known.agg(F.sum(F.octet_length("fixed") + F.octet_length("host") + 64)).first()[0] or 0
    if size <= broadcast_bytes:
        joined = rows.join(F.broadcast(known), "host", "left")
    else:
        dealt = known.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
        joined = rows.withColumn("salt", F.pmod(F.xxhash64("url", "page_id"), F.lit(salts)).cast("int")).join(dealt, ["host", "salt"], "left")
    return joined.select("page_id", "url", "html", "fixed").mapInArrow(_extract, "page_id long, url string, text string, n_chars long")
