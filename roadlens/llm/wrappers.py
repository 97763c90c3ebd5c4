"""Main text of web pages by inferred wrappers (operator 1).

A page is read as a stream of block-level tags and text blocks (inline markup,
comments, scripts and styles are gone by then). A wrapper is a union-free
regular expression over such streams, inferred per host:

* inside a page, adjacent equal stretches become a repeated group ``(x)+``;
* streams are aligned by their longest common subsequence; what one side lacks
  becomes an optional group, what one side repeats becomes a repeated group,
  and text that differs between pages becomes a text slot (equal text on all
  pages is part of the template).

Inference is iterative but never sees pages: pages are reduced in the scan to
their folded streams with counts and the range of text hashes of each slot, so
a host with a third of all pages meets as its few different streams. Streams of
a host are aligned in salted parts first, then the parts with each other.

A wrapper decides for its host which slots are the article. Elements of menus,
footers, asides and forms are not; nor is what class, id or role call a notice,
an advert and so on, unless three quarters of the host's own text (text that
differs between its pages) lies under it: then the name tells of the page, not of
the part. If the host has article or main elements, slots outside are not article
(articles that hold less than half of the text of the main element around them
are teasers). Without such elements, blocks of links are not, nor is template
text, that is text equal on ``TEMPLATE_PAGES`` different pages, but for subheads
between the article's own blocks. Every stream is aligned with its host's
wrapper once, and pages take the kept slots.

Defined cases: null html gives the empty text; a null or odd URL belongs to the
empty host; a page without any kept slot gives the empty text; text is whole,
with references decoded and white space of a block as one space, blocks joined
by a line break; equal rows give equal rows; an empty table gives an empty
result; extra columns are ignored. Very long pages are read in one pass.
"""

from __future__ import annotations

import html
import json
import re
from functools import lru_cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roadlens.llm.common import written
from roadlens.llm.url_filter import host_and_path

#: Streams or wrappers that one task aligns with each other.
TOGETHER = 32
LONGEST_PERIOD = 12
TEMPLATE_PAGES = 5
#: Classes of page hashes, in each of which two pages at most are told apart.
PAGE_KINDS = 8
#: Tables of alignment up to this size are filled whole; larger ones are divided (Hirschberg).
LARGEST_TABLE = 4_000_000
KNOWN_STREAMS, LONGEST_KNOWN = 4096, 2000

# Fixed lists: HTML element names.
RAW = frozenset("script style noscript template iframe xmp noembed noframes textarea title svg math object select".split())
BLOCKS = frozenset(
    "address article aside blockquote body button caption center dd details dialog div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol option p pre section summary table tbody td tfoot th thead tr ul video audio".split()
)
#: Elements whose end tag may be missing: their ends are not part of a stream.
OPEN_ENDED = frozenset("p li dt dd td th tr tbody thead tfoot option h1 h2 h3 h4 h5 h6 hr html body".split())
IN_HEAD = frozenset("head html meta link base".split())
NOT_ARTICLE = frozenset("nav footer aside form head menu button dialog fieldset video audio".split())
CONTENT = frozenset("article main".split())
# Fixed lists: words in class, id and role.
DROP_WORDS = frozenset(
    "ad ads adbox advert adverts advertisement advertising sponsor sponsored promo promotion sidebar rail widget menu nav navbar navigation "
    "breadcrumb breadcrumbs footer comment comments disqus reply replies respond cookie cookies consent notice notices gdpr alert popup modal overlay "
    "newsletter subscribe signup share sharing social related recommended recommendations toolbar login search pagination pager copyright "
    "complementary contentinfo banner masthead skip hidden".split()
)
KEEP_WORDS = frozenset("article content main post entry story body text".split())
#: A class that begins with one of these tells of a state of the element.
STATE_WORDS = frozenset("has no with without is not overflow are can".split())
#: Elements of which a class never says that they are no article.
WHOLE = frozenset("html body main article".split())

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*+>|"
    r"<(/?)([a-zA-Z][^\s/>]*+)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>|<(/?)([a-zA-Z][^\s/>]*+)([^>]*+)>|([^<]++|<)",
    re.S,
)
HINT = re.compile(r"""(?:^|[\s"'/])(class|id|role|style)\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)""", re.I)
HIDDEN = re.compile(r"""(?:^|\s)hidden(?:\s|=|/|$)""", re.I)


def hint(name: str, attributes: str) -> str:
    """``-`` if class, id, role or hiding mark an element as not article, ``+`` as article, else nothing."""
    if not attributes or attributes.isspace():
        return ""
    words: set[str] = set()
    told: set[str] = set()
    for key, value in HINT.findall(attributes):
        if key.lower() == "style":
            if re.search(r"display\s*:\s*none", value, re.I):
                return "-"
            continue
        for token in re.findall(r"[^\s\"']+", value.lower()):
            parts = re.findall(r"[a-z]+", token)
            words.update(parts)
            if parts and parts[0] not in STATE_WORDS:
                told.update((token, parts[0], parts[-1]))
    if name not in WHOLE and (told & DROP_WORDS or HIDDEN.search(re.sub(r"\"[^\"]*\"|'[^']*'", "", attributes))):
        return "-"
    return "+" if words & KEEP_WORDS and name in ("div", "section", "td") else ""


def read_page(page: str) -> tuple[list[str], list[str]]:
    """The page's stream of symbols, and its text blocks: block i is the i-th ``#`` or ``@``.

    ``#`` is a text block, ``@`` one whose text lies mostly in links.
    """
    stream: list[str] = []
    texts: list[str] = []
    held: list[str] = []
    linked = total = 0
    in_link = in_head = False
    at, n = 0, len(page)

    def close_block():
        nonlocal linked, total
        if held:
            text = " ".join(html.unescape("".join(held)).split())
            if text:
                stream.append("@" if linked * 5 >= total * 4 else "#")
                texts.append(text)
            held.clear()
            linked = total = 0

    while at < n:
        m = TOKEN.match(page, at)
        at = m.end()
        text = m[7]
        if text is not None:
            if in_head and text.strip():
                stream.append("/head")
                in_head = False
            held.append(text)
            size = len(text.strip())
            total += size
            linked += size * in_link
            continue
        name = m[2] or m[5]
        if name is None:
            continue
        name, end = name.lower(), bool(m[1] or m[4])
        if name in RAW:
            if not end and not (m[3] or m[6] or "").endswith("/"):
                stop = re.compile(rf"</{re.escape(name)}(?=[\s/>])", re.I).search(page, at)
                if stop is None:
                    if name in ("script", "style", "title", "textarea", "xmp", "iframe", "template"):
                        break
                else:
                    close = page.find(">", stop.end())
                    at = n if close < 0 else close + 1
            continue
        if in_head and name not in IN_HEAD:  # the head ends where something stands that can not be in it
            stream.append("/head")
            in_head = False
        if name == "a":
            in_link = not end
        elif name == "br":
            held.append(" ")
        elif name in BLOCKS:
            close_block()
            if name == "head":
                if end == in_head:
                    stream.append("/head" if end else "head")
                    in_head = not end
            elif end:
                if name not in OPEN_ENDED:
                    stream.append("/" + name)
            else:
                stream.append(name + hint(name, m[3] or m[6] or ""))
    close_block()
    return stream, texts


def slots(key: str) -> int:
    return key.count("#") + key.count("@")


class Item:
    """One part of a stream or wrapper: its pattern, whether it is optional, and per slot what it holds."""

    __slots__ = ("key", "optional", "held")

    def __init__(self, key: str, held: list, optional: bool = False):
        self.key, self.held, self.optional = key, held, optional


def fold(items: list[Item], join) -> list[Item]:
    """Adjacent equal stretches as repeated groups, short periods first, until none is left.

    ``join(a, b)`` merges what two repeats of a slot hold.
    """
    changed = True
    while changed:
        changed = False
        for period in range(1, LONGEST_PERIOD + 1):
            out: list[Item] = []
            i = 0
            while i < len(items):
                body = items[i : i + period]
                j = i + period
                # a group begins with its tag: (p #)+, not (# p)+
                if len(body) == period and any(slots(x.key) for x in body) and (period == 1 or body[0].key not in ("#", "@")):
                    keys = [x.key for x in body]
                    while [x.key for x in items[j : j + period]] == keys:
                        for a, b in zip(body, items[j : j + period]):
                            a.held = [join(x, y) for x, y in zip(a.held, b.held)]
                            a.optional = a.optional and b.optional
                        j += period
                if j > i + period:
                    group = body[0] if period == 1 and body[0].key.endswith(")+") else Item(
                        "(" + " ".join(x.key for x in body) + ")+", [h for x in body for h in x.held], all(x.optional for x in body)
                    )
                    out.append(group)
                    i, changed = j, True
                else:
                    out.append(items[i])
                    i += 1
            items = absorb(out, join)
    return items


def absorb(items: list[Item], join, groups: set[str] = frozenset()) -> list[Item]:
    """Stretches that equal the body of a repeated group among ``items`` or ``groups`` become that group."""
    for key in sorted({x.key for x in items if x.key.endswith(")+")} | set(groups), key=len):
        body, out, i = split_key(key[1:-2]), [], 0
        while i < len(items):
            part = items[i : i + len(body)]
            if [x.key for x in part] == body:
                item = Item(key, [h for x in part for h in x.held], all(x.optional for x in part))
                i += len(body)
            else:
                item = items[i]
                i += 1
            if out and item.key == key == out[-1].key:
                out[-1].held = [join(a, b) for a, b in zip(out[-1].held, item.held)]
                out[-1].optional = out[-1].optional and item.optional
            else:
                out.append(item)
        items = out
    return items


def split_key(body: str) -> list[str]:
    """The parts of a pattern: symbols, and whole repeated groups."""
    out, depth, start = [], 0, 0
    for i, c in enumerate(body):
        depth += (c == "(") - (c == ")")
        if c == " " and depth == 0:
            out.append(body[start:i])
            start = i + 1
    return [*out, body[start:]]


def matches(a: list[str], b: list[str]) -> list[tuple[int, int]]:
    """Places of a longest common subsequence; memory in proportion to the longer side beyond LARGEST_TABLE."""
    lo = 0
    while lo < min(len(a), len(b)) and a[lo] == b[lo]:
        lo += 1
    hi = 0
    while hi < min(len(a), len(b)) - lo and a[-1 - hi] == b[-1 - hi]:
        hi += 1
    ends = [(len(a) - k, len(b) - k) for k in range(hi, 0, -1)]
    names = {key: i for i, key in enumerate({*a, *b})}
    x, y = (np.array([names[k] for k in part[lo : len(part) - hi]], np.int32) for part in (a, b))
    return [*((i, i) for i in range(lo)), *((i + lo, j + lo) for i, j in _matches(x, y)), *ends]


def _lengths(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Lengths of the longest common subsequences of ``x`` and every beginning of ``y``."""
    row = np.zeros(len(y) + 1, np.int32)
    for v in x:
        row[1:] = np.maximum.accumulate(np.maximum(row[1:], row[:-1] + (y == v)))
    return row


def _matches(x: np.ndarray, y: np.ndarray) -> list[tuple[int, int]]:
    n, m = len(x), len(y)
    if not n or not m:
        return []
    if n * m > LARGEST_TABLE and n > 1:
        half = n // 2
        split = int((_lengths(x[:half], y) + _lengths(x[half:][::-1], y[::-1])[::-1]).argmax())
        return [*_matches(x[:half], y[:split]), *((i + half, j + split) for i, j in _matches(x[half:], y[split:]))]
    table = np.zeros((n + 1, m + 1), np.int32)
    for i in range(n - 1, -1, -1):
        same = np.maximum(table[i + 1, :-1], table[i + 1, 1:] + (y == x[i]))
        table[i, :-1] = np.maximum.accumulate(same[::-1])[::-1]
    out, i, j = [], 0, 0
    while i < n and j < m:
        if x[i] == y[j]:
            out.append((i, j))
            i, j = i + 1, j + 1
        elif table[i + 1, j] >= table[i, j + 1]:
            i += 1
        else:
            j += 1
    return out


def align(a: list[Item], b: list[Item], join) -> list[Item]:
    """The wrapper of both: equal parts joined, parts that one side lacks optional."""
    groups = {x.key for x in (*a, *b) if x.key.endswith(")+")}
    a, b = absorb(a, join, groups), absorb(b, join, groups)
    out: list[Item] = []
    i = j = 0
    for x, y in [*matches([t.key for t in a], [t.key for t in b]), (len(a), len(b))]:
        out += [Item(t.key, t.held, True) for t in (*a[i:x], *b[j:y])]
        if x < len(a):
            held = [join(p, q) for p, q in zip(a[x].held, b[y].held)]
            out.append(Item(a[x].key, held, a[x].optional or b[y].optional))
        i, j = x + 1, y + 1
    return out


def fold_stream(stream: tuple[str, ...]) -> tuple[str, list[list[int]]]:
    """(pattern, per slot the numbers of its text blocks) of a stream of symbols."""
    items, k = [], 0
    for s in stream:
        own = s in ("#", "@")
        items.append(Item(s, [[k]] if own else []))
        k += own
    items = fold(items, lambda x, y: x + y)
    return " ".join(x.key for x in items), [h for x in items for h in x.held]


fold_known = lru_cache(maxsize=KNOWN_STREAMS)(fold_stream)


def folded_page(page: str) -> tuple[str, list[list[int]], list[str]]:
    """(pattern, per slot the numbers of its text blocks, text blocks) of one page.

    Pages of a site repeat their streams, so a worker keeps the last foldings.
    """
    stream, texts = read_page(page)
    pattern, held = (fold_known if len(stream) <= LONGEST_KNOWN else fold_stream)(tuple(stream))
    return pattern, held, texts


def seen_join(x: list, y: list) -> list:
    """What two repeats of a slot hold: different pages, least and greatest text hash, code points of text."""
    return [max(x[0], y[0]), min(x[1], y[1]), max(x[2], y[2]), x[3] + y[3]]


def sum_join(x: list, y: list) -> list:
    """The same for two groups of pages."""
    return [x[0] + y[0], min(x[1], y[1]), max(x[2], y[2]), x[3] + y[3]]


def to_items(pattern: str, held: list) -> list[Item]:
    items, at = [], 0
    for key in split_key(pattern) if pattern else []:
        items.append(Item(key, held[at : at + slots(key)]))
        at += slots(key)
    return items


def dump(items: list[Item]) -> str:
    return json.dumps([[x.key, x.held, x.optional] for x in items])


def load(text: str) -> list[Item]:
    return [Item(key, held, optional) for key, held, optional in json.loads(text)]


def infer(parts: list[list[Item]]) -> list[Item]:
    """The wrapper of several streams or wrappers, aligned one after the other."""
    wrapper = parts[0]
    for part in parts[1:]:
        wrapper = fold(align(wrapper, part, sum_join), seen_join)
    return wrapper


class Place(NamedTuple):
    """Where a slot lies in a wrapper: the elements around it as (number, name, hint), outermost first."""

    around: tuple[tuple[int, str, str], ...]

    def names(self) -> set[str]:
        return {name for _, name, _ in self.around}

    def barred(self) -> bool:
        """Inside an element that is never article."""
        names = self.names()
        return bool(names & NOT_ARTICLE) or "header" in names and not names & CONTENT


def places(keys: list[str]) -> list[Place]:
    """Per slot the elements around it."""
    stack: list[tuple[int, str, str]] = []
    out = []
    for number, symbol in enumerate(re.findall(r"[^\s()]+", " ".join(keys).replace(")+", " "))):
        if symbol in "#@":
            out.append(Place(tuple(stack)))
        elif symbol[0] == "/":
            name = symbol[1:]
            if any(x == name for _, x, _ in stack):
                while stack.pop()[1] != name:
                    pass
        else:
            name, h = symbol.rstrip("+-"), symbol[-1] if symbol[-1] in "+-" else ""
            if name not in OPEN_ENDED or h:
                if name in OPEN_ENDED:  # no end in the stream: holds up to the next element of its parent
                    while stack and stack[-1][1] in OPEN_ENDED:
                        stack.pop()
                stack.append((number, name, h))
            elif stack and stack[-1][1] in OPEN_ENDED:
                stack.pop()
    return out


def kept_slots(wrapper: list[Item]) -> list[bool]:
    """Per slot of a wrapper whether it is article text."""
    at = places([x.key for x in wrapper])
    held = [h for x in wrapper for h in x.held]
    kinds = [k for x in wrapper for k in re.findall("[#@]", x.key)]
    template = [h[0] >= TEMPLATE_PAGES and h[1] == h[2] for h in held]
    own = [0 if t or p.barred() or k == "@" else h[3] for h, t, p, k in zip(held, template, at, kinds)]

    # what class, id or role call no article, unless most of the host's own text is there
    under: dict[int, int] = {}
    for place, chars in zip(at, own):
        for number, _, h in place.around:
            if h == "-":
                under[number] = under.get(number, 0) + chars
    named = {number for number, chars in under.items() if 4 * chars <= 3 * sum(own)}
    dropped = [p.barred() or any(number in named for number, _, _ in p.around) for p in at]

    def mass(name: str, without: str = "") -> int:
        return sum(c for c, p, d in zip(own, at, dropped) if not d and name in p.names() and without not in p.names())

    inside = [not d and bool(p.names() & CONTENT) for p, d in zip(at, dropped)]
    if any(inside):
        if mass("main") and mass("article"):  # the larger of the two: articles, or the main element around teasers
            teasers = mass("article") < mass("main", "article")
            return [i and ("article" not in p.names() if teasers else "article" in p.names()) for i, p in zip(inside, at)]
        return inside
    if any(h == "+" and not d for p, d in zip(at, dropped) for _, _, h in p.around):
        return [not d and any(h == "+" for _, _, h in p.around) for p, d in zip(at, dropped)]
    kept = [not d and k == "#" and not t for d, k, t in zip(dropped, kinds, template)]
    own_at = [i for i, k in enumerate(kept) if k]
    for before, after in zip(own_at, own_at[1:]):  # template text between two blocks of one element: a subhead
        for i in range(before + 1, after):
            if kinds[i] == "#" and at[before].around == at[i].around == at[after].around:
                kept[i] = True
    return kept


def slots_of_stream(pattern: str, wrapper: list[Item], keep: list[bool]) -> list[bool]:
    """The decision for every slot of one stream, through its alignment with the wrapper.

    A stream of which the wrapper keeps nothing is judged by its own marks.
    """
    count = sum(slots(x.key) for x in wrapper)
    numbered, at = [], 0
    for x in wrapper:
        numbered.append(Item(x.key, [[("w", at + k)] for k in range(slots(x.key))]))
        at += slots(x.key)
    own, k = [], 0
    for key in split_key(pattern) if pattern else []:
        own.append(Item(key, [[("s", k + i)] for i in range(slots(key))]))
        k += slots(key)
    merged = align(numbered, own, lambda x, y: x + y)
    out: list[bool | None] = [None] * k
    for item in merged:
        for held in item.held:
            mine = [i for side, i in held if side == "s"]
            theirs = [i for side, i in held if side == "w" and i < count]
            if theirs:
                for i in mine:
                    out[i] = any(keep[t] for t in theirs)
    local = kept_slots([Item(x.key, [[1, 0, 1, 1]] * slots(x.key)) for x in own])
    out = [local[i] if x is None else x for i, x in enumerate(out)]
    return local if not any(out) else out


STREAMS = "host string, pattern string, slot int, low long, high long, chars long"


def page_streams(pages: DataFrame) -> DataFrame:
    """(host, pattern, pages, seen): the different streams of each host; ``seen`` has the hash range and code points of each slot.

    Each task adds up what it has read. Negative slots are classes of hashes of
    whole page texts: their ranges tell how many pages differ, up to two a class.
    """

    def run(batches):
        for batch in batches:
            tally: dict[tuple[str, str], dict[int, list[int]]] = {}
            for host, page in zip(batch.column("host").to_pylist(), batch.column("html").to_pylist()):
                pattern, held, texts = folded_page(page)
                own = tally.setdefault((host, pattern), {})
                whole = xxhash.xxh64_intdigest("\n".join(texts).encode()) >> 1
                slots_here = [(-1 - whole % PAGE_KINDS, whole, 0)]
                for k, h in enumerate(held):
                    text = " ".join(texts[i] for i in h)
                    slots_here.append((k, xxhash.xxh64_intdigest(text.encode()) >> 1, len(text)))
                for k, value, chars in slots_here:
                    seen = own.setdefault(k, [value, value, 0])
                    own[k] = [min(seen[0], value), max(seen[1], value), seen[2] + chars]
            rows = [(host, pattern, k, *seen) for (host, pattern), own in tally.items() for k, seen in own.items()]
            if rows:
                types = [pa.string(), pa.string(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
                cols = [pa.array(c, t) for c, t in zip(zip(*rows), types)]
                yield pa.RecordBatch.from_arrays(cols, names=[x.split()[0] for x in STREAMS.split(", ")])

    per_slot = pages.mapInArrow(run, STREAMS).groupBy("host", "pattern", "slot").agg(
        F.min("low").alias("low"), F.max("high").alias("high"), F.sum("chars").alias("chars")
    )
    different = F.sum(F.when(F.col("slot") < 0, F.when(F.col("low") == F.col("high"), 1).otherwise(2)).otherwise(0)).alias("pages")
    seen = F.array_sort(F.collect_list(F.when(F.col("slot") >= 0, F.struct("slot", "low", "high", "chars"))))
    return per_slot.groupBy("host", "pattern").agg(different, seen.alias("seen"))


def infer_wrappers(streams: DataFrame) -> DataFrame:
    """(host, wrapper): one wrapper per host, by aligning ``TOGETHER`` streams, then as many of their wrappers, level by level."""

    def aligned(table: pa.Table) -> pa.Table:
        rows = sorted(zip(table.column("pages").to_pylist(), table.column("wrapper").to_pylist()), key=lambda r: (-r[0], r[1]))
        wrapper = dump(infer([load(w) for _, w in rows]))
        return pa.table({"host": table.column("host")[:1], "group": table.column("group")[:1], "pages": [sum(r[0] for r in rows)], "wrapper": [wrapper]})

    def as_wrappers(batches):
        for batch in batches:
            columns = (batch.column(c).to_pylist() for c in ("pattern", "pages", "seen"))
            items = [dump(to_items(p, [[n, s["low"], s["high"], s["chars"]] for s in seen])) for p, n, seen in zip(*columns)]
            yield pa.RecordBatch.from_arrays([batch.column("host"), batch.column("pages"), pa.array(items, pa.string()), batch.column("group")], names=["host", "pages", "wrapper", "group"])

    sizes = streams.groupBy("host").agg(F.ceil(F.count(F.lit(1)) / TOGETHER).alias("groups"))
    left = sizes.agg(F.max("groups")).first()[0] or 1
    dealt = streams.join(sizes, "host").withColumn("group", F.pmod(F.xxhash64("pattern"), F.col("groups")))
    schema = "host string, pages long, wrapper string, group long"
    parts = dealt.mapInArrow(as_wrappers, schema).groupBy("host", "group").applyInArrow(aligned, "host string, group long, pages long, wrapper string")
    while left > 1:  # a level for each power of TOGETHER
        left = -(-left // TOGETHER)
        upper = written(parts, "wrapper-parts").withColumn("group", F.floor(F.col("group") / TOGETHER))
        parts = upper.groupBy("host", "group").applyInArrow(aligned, "host string, group long, pages long, wrapper string")
    return parts.select("host", "wrapper")


def decide(streams: DataFrame, wrappers: DataFrame) -> DataFrame:
    """(host, pattern, keep): for every stream of a host, which of its slots are article text."""

    def run(batches):
        known: dict[str, tuple] = {}
        for batch in batches:
            keep = []
            for pattern, text in zip(batch.column("pattern").to_pylist(), batch.column("wrapper").to_pylist()):
                if text not in known:
                    known.clear()
                    known[text] = (load(text), kept_slots(load(text)))
                keep.append(slots_of_stream(pattern, *known[text]))
            yield pa.RecordBatch.from_arrays([batch.column("host"), batch.column("pattern"), pa.array(keep, pa.list_(pa.bool_()))], names=["host", "pattern", "keep"])

    joined = streams.select("host", "pattern").join(wrappers, "host")
    return written(joined.mapInArrow(run, "host string, pattern string, keep array<boolean>"), "wrapper-decisions")


def extract_text(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars for every row of ``pages``."""
    host, _ = host_and_path()
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", host.alias("host"), F.coalesce("html", F.lit("")).alias("html"))
    streams = written(page_streams(rows.select("host", "html")), "wrapper-streams")
    decisions = decide(streams, infer_wrappers(streams))

    def blocks(batches):
        for batch in batches:
            patterns, groups, texts = [], [], []
            for page in batch.column("html").to_pylist():
                pattern, held, own = folded_page(page)
                slot_of = {i: k for k, h in enumerate(held) for i in h}
                patterns.append(pattern)
                groups.append([slot_of[i] for i in range(len(own))])
                texts.append(own)
            arrays = [pa.array(patterns, pa.string()), pa.array(groups, pa.list_(pa.int32())), pa.array(texts, pa.list_(pa.string()))]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("page_id", "url", "host")), *arrays], names=["page_id", "url", "host", "pattern", "slots", "blocks"])

    read = rows.mapInArrow(blocks, "page_id long, url string, host string, pattern string, slots array<int>, blocks array<string>")
    told = read.join(decisions, ["host", "pattern"], "left")
    kept = F.filter(F.arrays_zip("slots", "blocks"), lambda b: F.coalesce(F.get("keep", b["slots"]), F.lit(False)))
    text = F.array_join(F.transform(kept, lambda b: b["blocks"]), "\n")
    return told.select("page_id", "url", text.alias("text")).withColumn("n_chars", F.char_length("text").cast("long"))
