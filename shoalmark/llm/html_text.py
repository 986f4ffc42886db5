"""HTML extraction by composite text density.

Every DOM node has the characters and tags below it, and those of them in links; its composite density is characters per
tag, times a logarithm that falls with the share of links (its base grows with the share in the whole body).  The block
whose children's densities have the greatest sum is the main part; the least density on its path to the body is the
threshold that parts beside the path must reach.  A run of bare text and text markup beside blocks is a part like a block.
Density says what the main part is.  Elements and names (class, id, role) only say what takes no part, menus, adverts, notices
and the like, and where an element marked so holds the main text after all: one with a `main` element, with the `article`
that outweighs all unmarked text, or with over half of the body's text.  Short parts without links beside dense ones that hold
nearly all (`NEARLY`) of a block stay with them.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import named, slices, table, trimmed

# Elements by their kind.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style title textarea noscript template iframe xmp noframes".split())
# Those of them that last to the end of a page that doesn't end them; the others are then empty.
RAW_TO_END = frozenset("script style title textarea xmp".split())
NOISE = frozenset("nav header footer aside form button select dialog menu script style noscript template iframe textarea title desc metadata head".split())
BLOCKS = frozenset(
    "address article aside blockquote body br caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul".split()
)
CLOSES_P = BLOCKS - {"br", "body", "html", "caption", "tbody", "td", "tfoot", "th", "thead", "tr"}
# Which open elements a start tag ends, and at which elements the search for them stops.
ENDS = {
    "li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}), "option": ({"option"}, {"select"}),
    "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}), "tbody": ({"tbody", "thead", "tfoot"}, {"table"}), "tfoot": ({"tbody", "thead", "tfoot"}, {"table"}),
}
P_SCOPE = frozenset("article aside blockquote body caption div dd dl dt fieldset footer form header html li main nav ol section table td th ul button figure".split())
# Words of class, id and role that name what isn't part of an article.
NOISE_WORDS = frozenset(
    "ad ads adv advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments consent cookie cookies disqus footer login menu modal nav navbar navigation newsletter notice notices pager pagination popup promo promoted promotion recommended related reply replies respond search share sharing sidebar signup skip social sponsor sponsored subscribe toolbar widget complementary contentinfo alert".split()
)
# Words beside which a noise word still names such a block (related posts, but not related work).
COMPANIONS = frozenset(
    "all area article articles bar block blog body bottom box btn button buttons center col column container content count entry feed fixed form global google group head header heading holder icon icons inline inner item items js left link links list main mobile module more my news nested outer page panel post posts primary right row secondary section site slot small sticky sub text the this title to top unit us view wrap wrapper".split()
)
# Those of blocks that can hold more text than the article and still aren't part of it.
DISCUSSION = frozenset("comment comments disqus replies reply respond".split())
# Those that as a whole name are never the article, however short that is beside them.
ADVERTS = frozenset("ad ads adv advert adverts advertisement advertising promo promoted promotion sponsor sponsored cookie cookies consent".split())
# Words beside which they say something of a page or an article that has, or lacks, such a block.
SAYING = frozenset("closed has hide no open show with without".split())
#: The share of a block's text from which it counts as nearly all.
NEARLY = 0.9
_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*>?|<(/?)([a-zA-Z][^\s/>]*)((?:\"[^\"]*\"|'[^']*'|[^\"'>])*)>?", re.S)
_NAMES = re.compile(r"\b(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
_PARTS = re.compile(r"[^a-zA-Z]+|(?<=[a-z])(?=[A-Z])")


class Dom:
    """The nodes of a page in page order, by number: tag, parent, whether noise, and pieces (node or text) in order."""

    def __init__(self, html: str):
        self.tag, self.parent, self.noise, self.pieces = ["#root"], [-1], [False], [[]]
        self.in_article = [False]
        self.named: dict[int, str] = {}  # nodes that only class, id or role marks: as "never", "part" (by a whole name) or "other"
        self._parse(html)
        if self.named:
            self._judge_names()

    def _open(self, tag: str, attributes: str, parent: int) -> int:
        found = _NAMES.findall(attributes) if "=" in attributes else ()
        # An id inside an article is mostly the anchor of a heading: it only names discussions.
        anchors = self.in_article[parent]
        marks = [(x, anchors and kind.lower() == "id") for kind, *value in found for x in "".join(value).split()]
        noise = self.noise[parent] or tag in NOISE
        exempt = tag in ("body", "html", "main") or tag == "header" and self.in_article[parent]  # the head of the article, not of the page
        if not self.noise[parent] and exempt:
            noise = False
        elif not noise and marks:
            each = [(x.lower(), {w.lower() for w in _PARTS.split(x)} - {""}, anchor) for x, anchor in marks]
            each = [(x, words) for x, words, anchor in each if words & NOISE_WORDS and (words <= NOISE_WORDS | COMPANIONS) and (not anchor or words & DISCUSSION)]
            if each:
                self.named[len(self.tag)] = "never" if any(x in ADVERTS or words & DISCUSSION and not words & SAYING for x, words in each) else "part" if any(x in NOISE_WORDS for x, _ in each) else "other"
        self.tag.append(tag)
        self.parent.append(parent)
        self.noise.append(noise)
        self.in_article.append(self.in_article[parent] or tag == "article")
        self.pieces.append([])
        self.pieces[parent].append(len(self.tag) - 1)
        return len(self.tag) - 1

    def _judge_names(self) -> None:
        """Makes noise of the nodes that their names mark and of what is below them, except those that hold the main text.

        A node holds it with a main element, with the article (the longest one, if it is no shorter than all text outside
        marked nodes), or with over half of the body's text where no article stands outside.  Discussions and adverts never do,
        their text doesn't count, and articles in a part that is named as such (related, sidebar) don't if it has under half.
        """
        n = len(self.tag)
        marked, out, mains = [False] * n, list(self.noise), [False] * n
        chars, plain = [0] * n, 0  # plain: characters outside marked nodes
        for i in range(n):
            up = self.parent[i]
            marked[i] = i in self.named or up >= 0 and marked[up]
            out[i] = out[i] or self.named.get(i) == "never" or up >= 0 and out[up]
            mains[i] = self.tag[i] == "main" and not out[i]
            chars[i] = 0 if out[i] else sum(len("".join(x.split())) for x in self.pieces[i] if isinstance(x, str))
            plain += 0 if marked[i] else chars[i]
        for i in range(n - 1, 0, -1):
            chars[self.parent[i]] += chars[i]
            mains[self.parent[i]] |= mains[i]
        for i in range(1, n):
            out[i] = out[i] or out[self.parent[i]] or (self.named.get(i) == "part" and 2 * chars[i] <= chars[0])
        articles = [i for i in range(n) if self.tag[i] == "article" and not out[i] and chars[i]]
        article = at = max(articles, key=lambda i: (chars[i], -i), default=-1)
        above = set()
        while at >= 0:
            above.add(at)
            at = self.parent[at]
        for i, kind in self.named.items():
            holds = mains[i] or i in above and chars[article] >= plain or 2 * chars[i] > chars[0] and (i in above or not articles)
            if kind == "never" or not holds:
                self.noise[i] = True
        for i in range(1, n):
            self.noise[i] = self.noise[i] or self.noise[self.parent[i]]

    def _parse(self, html: str) -> None:
        stack, at, tags = [0], 0, self.tag
        is_open: dict[str, int] = {}  # how many elements of a tag are open: what isn't open isn't searched for

        def pop(i: int) -> None:
            for x in stack[i:]:
                is_open[tags[x]] -= 1
            del stack[i:]

        def close(names, stops) -> None:
            if not any(is_open.get(x) for x in names):
                return
            for i in range(len(stack) - 1, 0, -1):
                if tags[stack[i]] in names:
                    pop(i)
                    return
                if tags[stack[i]] in stops:
                    return

        def text(a: int, b: int) -> None:
            if a < b:
                piece = html[a:b]
                self.pieces[stack[-1]].append(unescape(piece) if "&" in piece else piece)

        while m := _TOKEN.search(html, at):
            text(at, m.start())
            at, tag = m.end(), m[2]
            if tag is None:
                if m[0].startswith("<![CDATA["):
                    self.pieces[stack[-1]].append(m[0][9:].removesuffix("]]>"))
                continue
            tag = tag.lower()
            if html[at - 1] != ">":  # an open quote or the end of a truncated page
                end = html.find(">", at)
                if end < 0:
                    return
                at = end + 1
            if m[1]:
                if tag in VOID or not is_open.get(tag):
                    continue
                for i in range(len(stack) - 1, 0, -1):
                    if tags[stack[i]] == tag:
                        pop(i)
                        break
                    if tag not in P_SCOPE and tags[stack[i]] in P_SCOPE:
                        break  # an end tag of text markup doesn't end a block
                continue
            if tag in CLOSES_P:
                close({"p"}, P_SCOPE)
            if tag in ENDS:
                close(*ENDS[tag])
            if tag in ("html", "body") and any(tags[x] == tag for x in stack):
                continue
            if tag == "body":
                pop(2 if len(stack) > 1 and tags[stack[1]] == "html" else 1)
            node = self._open(tag, m[3], stack[-1])
            closed = m[3].endswith("/")
            if tag in RAW and not closed:
                end = re.compile(rf"</{tag}\b[^>]*>?", re.I).search(html, at)
                if tag == "xmp":
                    self.pieces[node].append(html[at : end.start() if end else len(html)])
                if end:
                    at = end.end()
                elif tag in RAW_TO_END:
                    return
            elif tag not in VOID and not closed:
                stack.append(node)
                is_open[tag] = is_open.get(tag, 0) + 1
        text(at, len(html))

    def _counts(self) -> tuple[list[int], list[int], list[int], list[int]]:
        """Characters (without white space) and tags below each node, and those of them in links."""
        n = len(self.tag)
        chars, tags, link_chars, link_tags = [0] * n, [0] * n, [0] * n, [0] * n
        for i in range(n):
            chars[i] = sum(_size(x) for x in self.pieces[i] if isinstance(x, str))
        for i in range(n - 1, 0, -1):
            up = self.parent[i]
            if self.tag[i] == "a":
                link_chars[i], link_tags[i] = chars[i], tags[i] + 1
            chars[up] += chars[i]
            tags[up] += tags[i] + 1
            link_chars[up] += link_chars[i]
            link_tags[up] += link_tags[i]
        return chars, tags, link_chars, link_tags

    def densities(self) -> tuple[list[float], list[float]]:
        """The composite density of each node and the sum over its children; noise has and adds none."""
        n, of = len(self.tag), self._counts()
        in_body = self._link_share(of)
        density, total = [0.0] * n, [0.0] * n
        for i in range(n):
            if of[0][i] and not self.noise[i]:
                density[i] = composite(*(x[i] for x in of), in_body)
        for i in range(1, n):
            total[self.parent[i]] += density[i]
        return density, total

    def _body(self) -> int:
        return next((i for i, t in enumerate(self.tag) if t == "body"), 0)

    def _link_share(self, of: tuple[list[int], ...]) -> float:
        body = self._body()
        return of[2][body] / max(1, of[0][body])

    def main(self) -> list:
        """The main part: pieces (node or text) in page order."""
        density, total = self.densities()
        of, body = self._counts(), self._body()
        in_body = self._link_share(of)
        allowed = [i for i in range(len(self.tag)) if not self.noise[i] and self.tag[i] not in ("#root", "html")] or [0]
        best = max(allowed, key=lambda i: (total[i], -i))
        if not total[best]:
            return [body]
        while best not in (body, 0) and self.tag[best] not in BLOCKS:  # text markup is no part of its own
            best = self.parent[best]
        path = [best]
        while path[-1] not in (body, 0):
            path.append(self.parent[path[-1]])
        least = min((density[i] for i in path if i and density[i]), default=0.0)

        def run_density(run: list) -> float:
            nodes = [x for x in run if not isinstance(x, str)]
            chars = sum(_size(x) for x in run if isinstance(x, str)) + sum(of[0][x] for x in nodes)
            in_links = [sum(of[k][x] for x in nodes) for k in (2, 3)]
            return composite(chars, sum(of[1][x] + 1 for x in nodes), *in_links, in_body) if chars else 0.0

        def parts(node: int, on: int) -> list[tuple[list, int, bool, bool]]:
            """The parts of a node of the path, `on` being the next one: pieces, characters, whether dense, whether in no link."""
            out, run = [], []

            def end_run() -> None:
                if chars := sum(_size(x) if isinstance(x, str) else of[0][x] for x in run):
                    out.append(([" ", *run, " "], chars, run_density(run) >= least, not any(of[2][x] for x in run if not isinstance(x, str))))
                run.clear()

            for x in self.pieces[node]:
                if isinstance(x, str) or self.tag[x] not in BLOCKS and x != on:
                    if isinstance(x, str) or not self.noise[x]:
                        run.append(x)
                    continue
                end_run()
                if x == on or density[x]:
                    out.append(([x], of[0][x], x == on or density[x] >= least, not of[2][x]))
            end_run()
            return out

        kept = [best]
        for on, node in zip(path, path[1:]):
            found = parts(node, on)
            # Beside dense parts that hold nearly all of a block its short ones stay, too, unless they link.
            whole = node not in (body, 0) and sum(c for _, c, dense, _ in found if dense) >= NEARLY * sum(c for _, c, _, _ in found)
            kept = [y for x, _, dense, plain in found if dense or whole and plain for y in (kept if x == [on] else x)]
        return kept

    def text(self, pieces: list) -> str:
        """The text of pieces and below them without noise: blocks, their white space made one space, joined by one space."""
        out: list[str] = []
        todo: list = list(reversed(pieces))
        while todo:
            x = todo.pop()
            if isinstance(x, str):
                out.append(x)
            elif not self.noise[x]:
                if self.tag[x] in BLOCKS:
                    out.append(" ")
                    todo.append(" ")
                todo.extend(reversed(self.pieces[x]))
        return " ".join("".join(out).split())


def _size(text: str) -> int:
    return len("".join(text.split()))


def composite(chars: int, tags: int, link_chars: int, link_tags: int, in_body: float) -> float:
    """Composite density: characters per tag times a logarithm that falls with the links' share; in_body: their share in the body."""
    t, lc, lt = max(1, tags), max(1, link_chars), max(1, link_tags)
    base = math.log(chars * link_chars / max(1, chars - link_chars) + in_body * chars + math.e)
    gain = math.log(max(1.0, chars / lc * t / lt))
    return chars / t * (gain / math.log(base) if base > 1.0000001 else gain + 1)


def main_text(html: str | None) -> str:
    """The main text of a page; null, empty and textless pages have an empty one."""
    if not html or not html.strip():
        return ""
    dom = Dom(html)
    return dom.text(dom.main())


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(id_col, url_col, text, n_chars) for each row of pages; no shuffle.  A page is held whole, as nodes of Python.

    Null and empty pages and pages without text have an empty text.  Tags that a page leaves open end with their block,
    a tag that its end cuts off is dropped.  Repeated rows give repeated rows, null ids and urls stay null, an empty table
    gives an empty one, other columns are not read.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "html"):
                texts = [main_text(x) for x in part.column(2).to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(texts, pa.string()), pa.array([len(x) for x in texts], pa.int64())], ["id", "url", "text", "n_chars"])

    rows = pages.select(F.col(id_col).alias("id"), F.col(url_col).alias("url"), F.col(html_col).alias("html"))
    kinds = dict(rows.dtypes)
    out = rows.mapInArrow(trimmed(run), f"id {kinds['id']}, url {kinds['url']}, text string, n_chars bigint")
    return named(out, id=id_col, url=url_col)


def op7_html_text(spark, sf_dir: str) -> DataFrame:
    return extract(table(spark, sf_dir, "pages"))


#: The same for the pages table in DuckDB SQL: its articles are marked, its blocks are h1, p and br, its other markup is b.
SQL = r"""WITH a AS (SELECT page_id, url, regexp_replace(regexp_extract(coalesce(html, ''), '(?s)<article[^>]*>(.*?)(</article>|$)', 1), '<[^<>]*$', '') AS h FROM pages),
b AS (SELECT page_id, url, regexp_replace(regexp_replace(h, '<!--.*?-->', '', 'g'), '</?b>', '', 'g') AS h FROM a),
c AS (SELECT page_id, url, regexp_replace(h, '<[^>]*>', ' ', 'g') AS t FROM b),
d AS (SELECT page_id, url, regexp_replace(replace(replace(replace(t, '&quot;', '"'), '&lt;', '<'), '&gt;', '>'), '&amp;?', '&', 'g') AS t FROM c),
e AS (SELECT page_id, url, trim(regexp_replace(t, '\s+', ' ', 'g')) AS text FROM d)
SELECT page_id, url, text, CAST(length(text) AS BIGINT) AS n_chars FROM e"""
