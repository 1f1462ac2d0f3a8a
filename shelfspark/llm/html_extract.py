"""Main text of web pages by differencing with the nearest page of the host.

A page is read into lines, one per block element. Pages of a host are sorted by
URL path; of the two beside a page, the one whose path agrees longer is its
neighbour (one that is nearly a copy is passed over, as it says nothing about
the template). The lines of both are aligned by longest common subsequence and
the shared ones are deleted, as the template's. In an element that the page
itself names as its article one neighbour is too little, for articles repeat
sentences: there, a line is the template's if it stands once in the article and
is aligned with a line that stands once in each of the ``WITNESSES`` nearest
pages (of ``REACH`` on either side, no copies of the page or of each other). A
host without so many such pages there has its article lines kept. A check
follows: what is left outside the article, where the page names one, and what
stands in menus, headers, footers, sidebars, notices, adverts, forms and reader
comments by element, role or class, is dropped as well, for a neighbour need not
repeat it. A class or id tells only if all its words do (``cookie-notice``, not
``social-history``). In an article fewer words tell, as it has headers and notes
of its own, and the id of a heading, section or paragraph is an anchor that says
nothing, unless it names reader comments. An ``article`` whose class or id names
reader comments is one of those.

Only hashes of lines travel to the neighbour search. It sorts by ranges, so a
host with much of all pages is spread; a page at the border of a range gets
its neighbours from the ranges beside.

Defined cases: null and empty html give an empty text; a null url or one
without a host has no neighbour; pages that repeat are each differenced and
extracted; ties of paths are ordered by id and content; an unclosed element
ends with its parent or the page; of an unclosed picture, frame or selection
only the tag is passed over; a quote that nothing closes is a character like
others, a tag that nothing closes is text; formulas are text, their source
annotations are not; an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import html as html_lib
import re
from bisect import bisect_left
from collections import Counter, deque

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfspark.llm.common import stored

# --- reading a page ---------------------------------------------------------

BLOCKS = set("address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption "
             "figure footer form frameset h1 h2 h3 h4 h5 h6 head header hgroup hr html li main menu nav ol "
             "optgroup option p pre search section summary table tbody td tfoot th thead title tr ul".split())
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
#: Their content is not markup and not text.
RAW = set("script style noscript template textarea title iframe svg object canvas select annotation "
          "annotation-xml".split())
#: Those that stand within a line.
INLINE = set("svg canvas object annotation annotation-xml".split())
#: Those without which the page goes on if they are never closed.
IGNORED_IF_OPEN = INLINE | {"iframe", "select", "noscript"}
#: Elements that never hold main text.
APART = set("nav footer aside form dialog button menu head audio video search".split())
#: Class or id words of such elements.
APART_WORDS = set(
    "ad ads adv advert adverts advertisement advertising banner sponsor sponsored promo promotion cookie cookies "
    "consent gdpr notice notices alert popup modal overlay newsletter subscribe subscription paywall menu nav navbar "
    "navigation breadcrumb breadcrumbs sidebar side aside widget widgets footer header masthead topbar toolbar "
    "comment comments respond reply replies disqus share sharing social related recommended pagination pager login "
    "signup search hidden skip copyright legal".split())
APART_ROLES = set("navigation banner contentinfo complementary search dialog alertdialog alert form menu menubar "
                  "toolbar".split())
#: In an article, their id is an anchor of the text; only that of reader comments counts.
ANCHORED = set("h1 h2 h3 h4 h5 h6 section p li dt dd figure table blockquote".split())
READER_WORDS = set("comment comments respond disqus".split())
#: Words that an article's own parts bear as well.
OWN_WORDS = set("header footer masthead side aside legal reply replies copyright search skip alert notices".split())
#: Words that may stand beside a telling one in a class or id.
NEUTRAL_WORDS = set(
    "box boxes block wrapper wrap container area bar section list item items inner outer content site page main "
    "post posts entry article body button buttons form link links top bottom left right primary secondary slot unit "
    "panel group row col column icons icon media thread even odd depth parent js id the".split())
#: A start tag of one of these ends an open one of the others.
IMPLIED = {t: {"p"} for t in BLOCKS} | {"li": {"li", "p"}, "dt": {"dt", "dd", "p"}, "dd": {"dt", "dd", "p"},
                                         "tr": {"tr", "td", "th", "p"}, "td": {"td", "th", "p"},
                                         "th": {"td", "th", "p"}, "option": {"option"}}

_OPENING = re.compile(r"<!--|<[!?]|<(/?)([a-zA-Z][^\s/>]*)([^\"'>]*)(>?)")
_STOP = re.compile(r"[\"'>]")
_END = {tag: re.compile(rf"</{re.escape(tag)}\s*+>", re.I) for tag in RAW}
_ATTRIBUTE = re.compile(r"([^\s=/\"'>]+)\s*(?:=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?")
_WORD = re.compile(r"[a-z0-9]+")


class Line:
    __slots__ = ("text", "article", "apart")

    def __init__(self, text: str, article: bool, apart: bool):
        self.text, self.article, self.apart = text, article, apart


def _attributes(text: str) -> dict[str, str]:
    return {m[1].lower(): html_lib.unescape(m[2] or m[3] or m[4] or "") for m in _ATTRIBUTE.finditer(text)}


def _names_article(tag: str, a: dict[str, str]) -> bool:
    return (tag in ("article", "main") or a.get("role") in ("main", "article")
            or "articlebody" in a.get("itemprop", "").lower())


def _is_apart(tag: str, a: dict[str, str], in_article: bool) -> bool:
    if tag in APART or tag == "header" and not in_article:
        return True
    if tag == "article":
        return _tells(a.get("class", ""), READER_WORDS) or _tells(a.get("id", ""), READER_WORDS)
    if tag in ("html", "body", "main"):
        return False
    if "hidden" in a or a.get("aria-hidden") == "true" or "display:none" in a.get("style", "").replace(" ", "").lower():
        return True
    if a.get("role", "").lower() in APART_ROLES:
        return True
    if "class" not in a and "id" not in a:
        return False
    telling = APART_WORDS - OWN_WORDS if in_article else APART_WORDS
    if tag == "header" and in_article:
        return False
    return (_tells(a.get("class", ""), telling)
            or _tells(a.get("id", ""), READER_WORDS if in_article and tag in ANCHORED else telling))


def _tells(names: str, telling: set[str]) -> bool:
    """Is there a name made of telling words, and of neutral ones and numbers beside them?"""
    for name in names.split():
        words = _WORD.findall(re.sub(r"(?<=[a-z])(?=[A-Z])", " ", name).lower())
        if not telling.isdisjoint(words) and all(w in telling or w in NEUTRAL_WORDS or w.isdigit() for w in words):
            return True
    return False


class _Tags:
    """The next tag of a page, found in time linear in the page however its quotes and brackets stand."""

    def __init__(self, html: str):
        self.html = html
        self.last = html.rfind(">")
        self.quotes = True  # until a tag's quotes leave it without an end

    def next(self, at: int) -> tuple[int, int, str, str, str] | None:
        """``(start, end, slash, name, attributes)``; of comments and declarations the name is empty."""
        html = self.html
        while m := _OPENING.search(html, at):
            if m[2] is None:
                mark = "-->" if m[0] == "<!--" else ">"
                end = html.find(mark, m.end())
                return m.start(), len(html) if end < 0 else end + len(mark), "", "", ""
            if m[4]:  # no quotes
                return m.start(), m.end(), m[1], m[2].lower(), m[3]
            if m.end() > self.last:
                return None
            end = self._end(m.end())
            return m.start(), end + 1, m[1], m[2].lower(), html[m.end(2):end]
        return None

    def _end(self, at: int) -> int:
        html, k = self.html, at
        while self.quotes and (m := _STOP.search(html, k)):
            if m[0] == ">":
                return m.start()
            close = html.find(m[0], m.end())
            if close < 0:
                break
            k = close + 1
        self.quotes = False
        return html.index(">", at)


def read_lines(html: str | None) -> list[Line]:
    """The page's lines in order, white space folded, character references decoded."""
    html = html or ""
    lines: list[Line] = []
    stack: list[tuple[str, bool, bool]] = []  # tag, in an article, apart
    parts: list[tuple[str, bool, bool]] = []  # text, in an article, apart
    article = apart = False

    def flush():
        """End a line. What inline elements set apart in it goes, if other text is left."""
        if not parts:
            return
        own = parts
        if len(parts) > 1:
            own = [x for x in parts if not x[2] and x[0].strip()]
            own = [x for x in parts if not x[2]] if own else parts
        text = " ".join(html_lib.unescape("".join([x[0] for x in own])).split())
        if text:
            lines.append(Line(text, any([x[1] for x in own]), all([x[2] for x in own])))
        parts.clear()

    def close(k: int):
        """Leave the ``k``-th open element and those in it."""
        nonlocal article, apart
        for name, _, _ in stack[k:]:
            is_open[name] -= 1
        del stack[k:]
        _, article, apart = stack[-1] if stack else ("", False, False)

    is_open: Counter[str] = Counter()
    never_closed: set[str] = set()
    tags = _Tags(html)
    at = 0
    while at < len(html):
        found = tags.next(at)
        if not found:
            parts.append((html[at:], article, apart))
            break
        start, end, slash, tag, rest = found
        if at < start:
            parts.append((html[at:start], article, apart))
        at = end
        if not tag:
            continue
        if tag in BLOCKS:
            flush()
        if slash:
            if is_open[tag]:
                k = len(stack) - 1
                while stack[k][0] != tag:
                    k -= 1
                if any(name in BLOCKS for name, _, _ in stack[k:]):
                    flush()  # an inline element's end does not end the line
                close(k)
            continue
        if tag in RAW and not rest.endswith("/"):
            stop = None if tag in never_closed else _END[tag].search(html, at)
            if stop:
                at = stop.end()
            elif tag in IGNORED_IF_OPEN:
                never_closed.add(tag)
                continue
            else:
                at = len(html)
            if tag not in INLINE:
                flush()
            continue
        if tag in ("br", "hr"):
            parts.append((" ", article, apart))
        if tag in VOID:
            continue
        closed = IMPLIED.get(tag)
        if closed and stack and stack[-1][0] in closed:
            k = len(stack) - 1
            while k and stack[k - 1][0] in closed:
                k -= 1
            close(k)
        elif closed and any(is_open[x] for x in closed):  # an open p may lie under inline elements: <p><b>text<p>
            for k in range(len(stack) - 1, -1, -1):
                if stack[k][0] in closed:
                    close(k)
                    break
                if stack[k][0] in BLOCKS:
                    break
        a = _attributes(rest) if rest.strip(" /\n") else {}
        was = (article, apart)
        article = article or _names_article(tag, a)
        apart = apart or _is_apart(tag, a, article)
        if not rest.rstrip().endswith("/") or tag in BLOCKS:
            stack.append((tag, article, apart))
            is_open[tag] += 1
        else:
            article, apart = was
    flush()
    return lines


def line_hash(text: str) -> int:
    return xxhash.xxh3_64_intdigest(text.encode("utf-8", "surrogatepass")) - (1 << 63)


def open_lines(lines: list[Line]) -> list[int]:
    """Hashes of the lines that one neighbour decides on: those not in a named article."""
    return [line_hash(x.text) for x in lines if not x.article]


def article_lines(lines: list[Line]) -> list[int]:
    """Hashes of a named article's lines, on which several pages decide."""
    return [line_hash(x.text) for x in lines if x.article and not x.apart]


# --- alignment ----------------------------------------------------------------

#: Equal pairs of lines up to which they are gone through one by one; beyond, the pages are halved first.
MAX_PAIRS = 4_000_000


def shared(a: list[int], b: list[int]) -> set[int]:
    """Places in ``a`` of a longest common subsequence with ``b``.

    By equal pairs (Hunt and Szymanski). Pages with too many of them are halved
    where a longest one passes (Hirschberg, with lengths by bit vectors), which
    needs no more memory than the pages.
    """
    out: set[int] = set()
    todo = [(0, len(a), 0, len(b))]
    while todo:
        start, end, low, high = todo.pop()
        x, y = a[start:end], b[low:high]
        count = Counter(y)
        if len(x) < 2 or sum(count[v] for v in x) <= MAX_PAIRS:
            out |= {start + i for i in _by_pairs(x, y)}
            continue
        half = len(x) // 2
        ahead, behind = _prefix_lengths(x[:half], y), _prefix_lengths(x[:half - 1:-1], y[::-1])
        cut = int(np.argmax(ahead + behind[::-1]))
        todo += [(start, start + half, low, low + cut), (start + half, end, low + cut, high)]
    return out


def _prefix_lengths(a: list[int], b: list[int]) -> np.ndarray:
    """Lengths of the longest common subsequences of ``a`` with each prefix of ``b``, the empty one first."""
    places: dict[int, np.ndarray] = {}
    for x in set(a) & set(b):
        places[x] = np.zeros(len(b), np.uint8)
    for j, x in enumerate(b):
        if x in places:
            places[x][j] = 1
    masks = {x: int.from_bytes(np.packbits(bits, bitorder="little").tobytes(), "little") for x, bits in places.items()}
    full = v = (1 << len(b)) - 1
    for x in a:
        if x in masks:
            both = v & masks[x]
            v = ((v + both) | (v - both)) & full
    bits = np.unpackbits(np.frombuffer((full ^ v).to_bytes(-(-len(b) // 8), "little"), np.uint8), bitorder="little")
    return np.concatenate([[0], np.cumsum(bits[:len(b)], dtype=np.int64)])


def _by_pairs(a: list[int], b: list[int]) -> set[int]:
    places: dict[int, list[int]] = {}
    for j, x in enumerate(b):
        places.setdefault(x, []).append(j)
    tails: list[int] = []
    last: list[tuple] = []
    for i, x in enumerate(a):
        for j in reversed(places.get(x, ())):
            k = bisect_left(tails, j)
            link = (i, last[k - 1] if k else None)
            if k == len(tails):
                tails.append(j)
                last.append(link)
            else:
                tails[k] = j
                last[k] = link
    out, link = set(), last[-1] if last else None
    while link:
        out.add(link[0])
        link = link[1]
    return out


def template_places(article: list[int], others: list[list[int]]) -> list[int]:
    """Places in ``article`` of lines that stand once in it and in each of ``others`` and are aligned with all."""
    if len(others) < WITNESSES:
        return []
    found = set(range(len(article)))
    for lines in (article, *others):
        count = Counter(lines)
        found = {i for i in found if count[article[i]] == 1}
    for lines in others:
        found = found and found & shared(article, lines)
    return sorted(found)


def main_text(html: str | None, neighbour: list[int] | None, template: list[int] | None = None) -> str:
    """``neighbour``: open lines of the page beside; ``template``: places of the article's lines that go."""
    lines = read_lines(html)
    undecided = [i for i, x in enumerate(lines) if not x.article]
    gone = set()
    if neighbour and undecided:
        found = shared([line_hash(lines[i].text) for i in undecided], neighbour)
        gone = {undecided[k] for k in found}
    if template:
        inside = [i for i, x in enumerate(lines) if x.article and not x.apart]
        gone |= {inside[k] for k in template}
    named = any(x.article and not x.apart for x in lines)
    return "\n".join(x.text for i, x in enumerate(lines)
                     if i not in gone and not x.apart and (x.article or not named))


# --- neighbours -----------------------------------------------------------------

#: Share of equal lines from which a neighbour without a named article counts as a copy.
COPY = 0.9
#: Pages that must share a line of a named article, and how many places from the page they may stand.
WITNESSES = 3
REACH = 3
_NARROW = "k long, host string, path string, page_id long, whole boolean, lines array<long>, article array<long>"
_NARROW_NAMES = ["k", "host", "path", "page_id", "whole", "lines", "article"]
_FOUND = "k long, neighbour array<long>, template array<int>"


def _parsed(batches):
    for batch in batches:
        htmls = batch.column("html")
        whole, hashes, articles = [], [], []
        for i in range(len(htmls)):
            lines = read_lines(htmls[i].as_py())
            h = open_lines(lines)
            whole.append(len(h) == len(lines))
            hashes.append(h)
            articles.append(article_lines(lines))
        yield pa.RecordBatch.from_arrays(
            [batch.column(c) for c in ("k", "host", "path", "page_id")]
            + [pa.array(whole, pa.bool_()), pa.array(hashes, pa.list_(pa.int64())),
               pa.array(articles, pa.list_(pa.int64()))], _NARROW_NAMES)


def _in_ranges(batches):
    """Number the rows of a sorted range and say which is its last."""
    from pyspark import TaskContext
    part = TaskContext.get().partitionId()
    at, held = 0, None

    def row(batch, last):
        n = len(batch)
        return pa.RecordBatch.from_arrays(
            batch.columns + [pa.array([part] * n, pa.int32()), pa.array(range(at, at + n), pa.int64()),
                             pa.array([last and i == n - 1 for i in range(n)], pa.bool_())],
            [*_NARROW_NAMES, "part", "pos", "last"])
    for batch in batches:
        if not len(batch):
            continue
        if held is not None:
            yield row(held, False)
            at += len(held)
        held = batch
    if held is not None:
        yield row(held, True)


def _common(a: str, b: str) -> int:
    n = 0
    for x, y in zip(a, b):
        if x != y:
            break
        n += 1
    return n


def choose(me: dict, before: dict | None, after: dict | None) -> list[int] | None:
    """The lines of the nearer page of the same host that is no copy."""
    beside = [(-_common(me["path"], o["path"]), turn, o) for turn, o in enumerate((after, before))
              if o is not None and me["host"] and o["host"] == me["host"]]
    for _, _, o in sorted(beside, key=lambda x: x[:2]):
        both = len(set(me["lines"]) & set(o["lines"]))
        if not (me["whole"] and both >= COPY * max(1, len(set(me["lines"])))):
            return o["lines"]
    return None


def _copies(a: list[int], b: list[int]) -> bool:
    return len(set(a) & set(b)) >= COPY * max(1, len(set(a)))


def choose_template(me: dict, before: list[dict | None], after: list[dict | None]) -> list[int]:
    """Places of the article's lines that the nearest pages of the host share; both lists nearest first."""
    if not me["article"]:
        return []
    beside = [(-_common(me["path"], o["path"]), far, turn, o) for turn, side in enumerate((after, before))
              for far, o in enumerate(side) if o is not None and me["host"] and o["host"] == me["host"]]
    others: list[list[int]] = []
    for *_, o in sorted(beside, key=lambda x: x[:3]):
        if len(others) < WITNESSES and o["article"] and not any(_copies(x, o["article"]) for x in (me["article"], *others)):
            others.append(o["article"])
    return template_places(me["article"], others)


def _found(rows: list[tuple[dict, list, list]]) -> pa.RecordBatch:
    """``rows``: a page and the pages before and after it, nearest first."""
    return pa.RecordBatch.from_arrays(
        [pa.array([me["k"] for me, _, _ in rows], pa.int64()),
         pa.array([choose(me, before[0], after[0]) for me, before, after in rows], pa.list_(pa.int64())),
         pa.array([choose_template(*row) for row in rows], pa.list_(pa.int32()))],
        ["k", "neighbour", "template"])


def _chosen(batches):
    for batch in batches:
        rows = []
        for r in batch.to_pylist():
            at = {x["d"]: x["page"] for x in r["around"]}
            rows.append((at[0], [at.get(-d) for d in range(1, REACH + 1)], [at.get(d) for d in range(1, REACH + 1)]))
        yield _found(rows)


def _keyed(pages: DataFrame) -> DataFrame:
    url = F.col("url").cast("string")
    rest = F.regexp_extract(url, r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#]*@)?([^/?#]+)([^?#]*)", 2)
    host = F.lower(F.regexp_extract(url, r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#]*@)?([^/?#:]+)", 1))
    return pages.select(F.xxhash64("page_id", "url", "html").alias("k"), F.coalesce(host, F.lit("")).alias("host"),
                        F.coalesce(rest, F.lit("")).alias("path"), F.col("page_id").cast("long"), url.alias("url"),
                        F.col("html").cast("string").alias("html"))


def neighbours(keyed: DataFrame) -> DataFrame:
    """k -> hashes of the open lines of the page beside it, places of the template's lines in its article."""
    narrow = keyed.select("k", "host", "path", "page_id", "html").mapInArrow(_parsed, _NARROW)
    order = ["host", "path", "page_id", "k"]
    ranged = stored(narrow.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(
        _in_ranges, f"{_NARROW}, part int, pos long, last boolean"), "page-ranges")
    # a stored file keeps a range's order, yet a reader may join files: sort again within the range
    inner = ranged.repartition("part").sortWithinPartitions("part", "pos").mapInArrow(
        _paired_by_range, _FOUND)
    # borders: the first and last rows of each range meet by their place among all rows
    size = ranged.filter("last").select("part", F.col("pos").alias("end"))
    ends = size.select("part", "end", (F.sum(F.col("end") + 1).over(Window.orderBy("part")) - F.col("end") - 1)
                       .alias("before"))  # a row a range
    rim = (ranged.join(F.broadcast(ends), "part").filter(f"pos < {2 * REACH} or pos > end - {2 * REACH}")
           .select((F.col("before") + F.col("pos")).alias("place"), "pos", "end",
                   F.struct("k", "host", "path", "whole", "lines", "article").alias("page")))
    wanted = (rim.filter(f"pos < {REACH} or pos > end - {REACH}")
              .select(F.col("place").alias("me"), F.explode(F.sequence(F.lit(-REACH), F.lit(REACH))).alias("d"))
              .withColumn("place", F.col("me") + F.col("d")))
    border = (wanted.join(rim.select("place", "page"), "place").groupBy("me")
              .agg(F.collect_list(F.struct("d", "page")).alias("around")).select("around"))
    return inner.unionByName(border.mapInArrow(_chosen, _FOUND))


def _paired_by_range(batches):
    """Rows sorted by (part, pos) -> what ``_found`` says of those whose neighbours all lie in their range."""
    held: deque = deque(maxlen=2 * REACH + 1)
    for batch in batches:
        out = []
        for row in batch.to_pylist():
            if held and row["part"] != held[-1]["part"]:
                held.clear()
            held.append(row)
            if len(held) == held.maxlen:
                rows = list(held)
                out.append((rows[REACH], rows[:REACH][::-1], rows[REACH + 1:]))
        yield _found(out)


def _extracted(batches):
    for batch in batches:
        htmls, beside, template = (batch.column(c) for c in ("html", "neighbour", "template"))
        texts = [main_text(htmls[i].as_py(), beside[i].as_py(), template[i].as_py()) for i in range(len(htmls))]
        yield pa.RecordBatch.from_arrays(
            [batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string())], ["page_id", "url", "text"])


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, text of each row of ``pages`` (page_id, url, html)."""
    keyed = _keyed(pages)
    beside = stored(neighbours(keyed).filter("neighbour is not null or size(template) > 0").dropDuplicates(["k"]),
                    "page-neighbours")
    return (keyed.join(beside, "k", "left").select("page_id", "url", "html", "neighbour", "template")
            .mapInArrow(_extracted, "page_id long, url string, text string"))
