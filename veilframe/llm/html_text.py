"""The main text of web pages by a graphical model over the DOM tree.

Nodes are block elements and the runs of text between their boundaries; each is
content, or not, or a wrapper that holds both. A potential between parent and
child says how common children of its class (tag, and what class, id and role
names hint at) are under each kind of parent and which of the three such a
child is likely to be; runs of text have a potential for what they look like. Sum-product message passing, once
upward and once downward, gives every run's marginal; runs that are more likely
content than not are the main text.

Both potentials are counts over labelled pages: pages that are labelled by
hand, below, and pages of the table whose markup names its article.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from veilframe.llm.arrays import with_columns_of_text

TRAIN_PAGES = 2_000

# HTML's elements by how they are read.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea template iframe title".split())
# What can stand in a head; anything else ends it.
HEAD = frozenset("base basefont bgsound head html link meta noscript script style template title".split())
GROUPS = {
    "article": "article main",
    "box": "div section center details summary",
    "nav": "nav menu",
    "header": "header hgroup",
    "footer": "footer address",
    "aside": "aside dialog",
    "form": "form fieldset button label legend select",
    "paragraph": "p pre blockquote figure figcaption",
    "heading": "h1 h2 h3 h4 h5 h6",
    "list": "ul ol dl li dt dd",
    "table": "table thead tbody tfoot tr td th caption",
    "root": "html body",
}
GROUP_OF = {tag: group for group, tags in GROUPS.items() for tag in tags.split()}
BLOCKS = frozenset(GROUP_OF) | {"hr", "head"}
# Which open elements a start tag closes, and which elements such a search stops at.
CLOSES = {
    "li": ("li", ("ul", "ol", "menu")), "dt": ("dt dd", ("dl",)), "dd": ("dt dd", ("dl",)),
    "tr": ("tr td th", ("table",)), "td": ("td th", ("tr", "table")), "th": ("td th", ("tr", "table")),
    "body": ("head", ()),
}
# Elements that white space and inline markup may stay open across.
SCOPES = frozenset("article section div td th body html main aside nav header footer form li blockquote".split())
# Names in class, id and role that hint at what an element holds.
AGAINST = re.compile(
    r"(?:^|[\s_-])(?:nav\w*|menu\w*|foot\w*|sidebar\w*|side|ads?|advert\w*|sponsor\w*|promo\w*|banner\w*|cookies?\w*|"
    r"consent|notice\w*|alert\w*|comments?\w*|repl(?:y|ies)|respond|disqus\w*|shar(?:e|ing)\w*|social\w*|related|"
    r"recommend\w*|newsletter|subscri\w*|sign-?up|log-?in|search\w*|breadcrumbs?|pag(?:er|ination)|popup|modal|widget\w*|"
    r"toolbar|masthead|topbar|skip\w*|hidden|tags?|meta|rating\w*|contentinfo|complementary|navigation)(?:$|[\s_-])"
)
FOR = re.compile(
    r"(?:^|[\s_-])(?:article\w*|content\w*|main\w*|post|posts?-?body|entry\w*|story\w*|body\w*|text|prose)(?:$|[\s_-])"
)
HINTS = re.compile(r"""\b(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
HIDDEN = re.compile(r"""\bhidden\b(?!\s*=)|aria-hidden\s*=\s*["']?true|display\s*:\s*none""", re.I)

TAG = re.compile(
    r"""<!--.*?(?:-->|\Z)|<[!?][^>]*+>|<(/?)([A-Za-z][A-Za-z0-9:-]*+)((?:[^>"']++|"[^"]*+"|'[^']*+')*+)>"""
    r"""|<(/?)([A-Za-z][A-Za-z0-9:-]*+)([^>]*+)>""",
    re.S,
)
SENTENCE = re.compile(r"[.!?…。！？](?:\s|$)")
LEGAL = re.compile(r"©|\(c\)|all rights reserved|cookies?\b|privacy|subscribe|sign up|log in|read more|share this", re.I)


class Page:
    """The tree: for each node its parent, its class and, for runs, text and features."""

    def __init__(self, html: str):
        self.parent, self.kind, self.text, self.look, self.tag = [-1], ["root"], [None], [None], ["html"]
        self._open: list[tuple[str, int]] = [("html", 0)]
        self._opened = Counter(html=1)
        # The run that is being read, its length, and how much of it is in links.
        self._run: list[str] = []
        self._size = self._linked = self._links = 0
        self._unclosed: set[str] = set()
        at = 0
        scan, last = TAG.match, html.rfind(">")
        while True:
            less = html.find("<", at)
            if less < 0 or less > last:
                self._put(html[at:])
                break
            found = scan(html, less)
            if found is None:
                self._put(html[at : less + 1])
                at = less + 1
                continue
            self._put(html[at:less])
            at = found.end()
            slash, name, rest = found.group(1, 2, 3)
            if name is None:
                slash, name, rest = found.group(4, 5, 6)
                if name is None:
                    continue
            name = name.lower()
            if slash:
                self._end(name)
            elif name in RAW or name == "noscript" and self._opened["head"]:
                if not rest.endswith("/"):
                    at = self._behind(html, name, at)
            else:
                if name not in HEAD:
                    self._close_head()
                self._start(name, rest)
        self._flush()

    def _put(self, text: str) -> None:
        self._run.append(text)
        self._size += len(text)

    def _behind(self, html: str, name: str, at: int) -> int:
        """Where raw content ends: with its end tag, else before that of the element around it."""
        close = self._end_tag(html, name, at)
        if close:
            return close.end()
        if name == "title":
            following = html.find("<", at)
            return following if following >= 0 else len(html)
        around = next(n for n, _ in reversed(self._open) if n in BLOCKS)
        close = self._end_tag(html, around, at)
        return close.start() if close else len(html)

    def _end_tag(self, html: str, name: str, at: int):
        if name in self._unclosed:
            return None
        close = re.compile(f"</{name}(?=[\\s/>])[^>]*>?", re.I).search(html, at)
        if close is None:
            # Nor is there one further on.
            self._unclosed.add(name)
        return close

    def _close_head(self) -> None:
        if self._opened["head"]:
            self._flush()
            self._close_open("head", ())

    def _flush(self) -> None:
        """End the run of text; what is only white space is no node."""
        if self._run:
            raw = "".join(self._run)
            self._run.clear()
            if raw and not raw.isspace():
                text = " ".join(unescape(raw).split())
                if text:
                    # Text cannot stand in a head.
                    self._close_open("head", ())
                    self._add("run", "run", text)
        self._size = self._linked = self._links = 0

    def _add(self, kind: str, tag: str, text: str | None = None) -> int:
        self.parent.append(self._open[-1][1])
        self.kind.append(kind)
        self.tag.append(tag)
        self.text.append(text)
        self.look.append(None if text is None else self._looks(text))
        return len(self.parent) - 1

    def _looks(self, text: str) -> tuple:
        size = len(text)
        length = 0 if size < 25 else 1 if size < 80 else 2 if size < 250 else 3
        linked = self._linked > 0.5 * size
        return (
            ("length", length),
            ("linked", linked),
            ("sentence", bool(SENTENCE.search(text)) and size >= 25),
            ("legal", size < 250 and bool(LEGAL.search(text))),
        )

    def _pop_to(self, index: int) -> None:
        for name, _ in self._open[index:]:
            self._opened[name] -= 1
        del self._open[index:]

    def _close_open(self, names: str, stops) -> None:
        wanted = names.split()
        if not any(self._opened[n] for n in wanted):
            return
        for i in range(len(self._open) - 1, 0, -1):
            name = self._open[i][0]
            if name in wanted:
                self._pop_to(i)
                return
            if name in stops:
                return

    def _start(self, name: str, rest: str) -> None:
        if name == "br":
            self._put(" ")
            return
        if name not in BLOCKS:
            if name not in VOID and not rest.endswith("/"):
                self._open.append((name, self._open[-1][1]))
                self._opened[name] += 1
                if name == "a":
                    self._links = self._size
            return
        self._flush()
        if name in CLOSES:
            self._close_open(*CLOSES[name])
        self._close_open("p", SCOPES)
        if name in VOID:
            return
        self._open.append((name, self._add(_class(name, rest), name)))
        self._opened[name] += 1

    def _end(self, name: str) -> None:
        if name == "a" and self._opened["a"]:
            self._linked += max(0, self._size - self._links)
            self._links = self._size
        if name in BLOCKS:
            self._flush()
        if not self._opened[name]:
            return
        inline = name not in BLOCKS
        for i in range(len(self._open) - 1, 0, -1):
            if self._open[i][0] == name:
                self._pop_to(i)
                return
            if inline and self._open[i][0] in SCOPES:
                return


def _class(name: str, rest: str) -> str:
    """The class of a block element: its group, and a hint for or against content."""
    group = GROUP_OF.get(name, "box")
    if not rest or rest.isspace():
        return group
    if HIDDEN.search(rest):
        return group + "-"
    hints = " ".join((a or b or c).lower() for _, a, b, c in HINTS.findall(rest))
    if AGAINST.search(hints):
        # A plain name for content weighs against one that only turns up in a compound.
        names = hints.split()
        plain = any(FOR.fullmatch(n) for n in names) and not any(AGAINST.fullmatch(n) for n in names)
        return group if plain else group + "-"
    return group + "+" if FOR.search(hints) else group


Counts = Counter  # of ("edge", class, parent label, label) and ("look", feature, value, label)


def count_labels(page: Page, labels: list[int]) -> Counts:
    found: Counts = Counter()
    for i in range(1, len(labels)):
        kind = page.kind[i]
        found["edge", kind, labels[page.parent[i]], labels[i]] += 1
        for name, value in page.look[i] or ():
            found["look", f"{name}:{int(value)}", 0, labels[i]] += 1
    return found


NOT, CONTENT, WRAPPER = range(3)


def _with_wrappers(page: Page, labels: list[int]) -> list[int]:
    """What is not content but holds some is a wrapper."""
    for i in range(len(labels) - 1, 0, -1):
        if labels[i] != NOT and labels[page.parent[i]] == NOT:
            labels[page.parent[i]] = WRAPPER
    labels[0] = WRAPPER
    return labels


def labels_by_markup(page: Page) -> list[int] | None:
    """What the page itself marks as its article is content; None if it marks nothing."""
    labels, sure = [NOT] * len(page.parent), False
    for i in range(1, len(labels)):
        kind = page.kind[i].rstrip("+")
        if kind == "article":
            labels[i] = CONTENT
            sure = True
        elif labels[page.parent[i]] == CONTENT:
            labels[i] = int(not kind.endswith("-") and kind not in ("nav", "footer", "aside", "form"))
    return _with_wrappers(page, labels) if sure else None


# Pages that are labelled by hand: data-y="1" opens content and data-y="0" ends it;
# elements below have the same label.
_PROSE = (
    "<p>The committee met on Tuesday to discuss the plan, and most members agreed that it should go ahead. "
    "A second reading follows in the spring, once the figures have been checked.</p>"
)
_SHORT = "<p>They left early.</p>"
_LIST = "<ul><li>One kilo of flour</li><li>Two eggs, well beaten</li><li>A pinch of salt</li></ul>"
_MENU = "<ul><li><a href=/>Home</a></li><li><a href=/n>News</a></li><li><a href=/s>Sport and leisure</a></li></ul>"
_TALK = (
    "<div><p>I do not agree with this at all, and I have said so before. Why does nobody ever ask us first?</p></div>"
    "<div><p>Great read, thank you!</p></div>"
)
LABELLED = (
    f"<body><header><a href=/>The Daily</a>{_MENU}</header><main data-y=1><h1>Plan agreed</h1>{_PROSE}{_SHORT}{_LIST}"
    f"<div class=share data-y=0><a href=x>Share this</a></div></main><aside>{_MENU}{_PROSE}</aside>"
    f"<section class=comments>{_TALK}</section><footer><p>© The Daily. All rights reserved.</p>{_MENU}</footer></body>",
    f"<body><div id=menu>{_MENU}</div><div id=content data-y=1><h2>Plan agreed</h2>{_PROSE}{_PROSE}"
    f"<blockquote>It was time, said one of them.</blockquote><table><tr><td>Votes</td><td>12</td></tr></table>"
    f"<div class=comment-list data-y=0>{_TALK}</div></div><div class=sidebar><h3>Latest</h3>{_MENU}{_SHORT}</div>"
    f"<div class=cookie-notice><p>We use cookies to make this site better. By going on you agree.</p></div>"
    f"<div id=footer><p>Privacy</p></div></body>",
    f"<body><nav>{_MENU}</nav><article data-y=1><header><h1>Plan agreed</h1><p>By our staff, 3 May</p></header>{_PROSE}"
    f"<section><h2>What next</h2>{_PROSE}{_SHORT}</section><aside data-y=0><p>Sign up for our newsletter.</p></aside>"
    f"<form data-y=0><label>Mail</label><p>Enter your address to get the news every morning.</p></form>"
    f"<footer data-y=0><p>Filed under politics</p></footer></article><div class=ad><p>Buy two, get one free. Only this week "
    f"in all our shops, and as long as we have any left.</p></div><div class=related>{_MENU}</div></body>",
    f"<body><div><div>{_MENU}</div><div data-y=1><h1>Plan agreed</h1>{_PROSE}{_PROSE}{_PROSE}</div><div>{_MENU}</div>"
    f"<div><p>© 2020 The Daily</p></div></div></body>",
    f"<body><div class=banner><p>Closed on Monday because of the holiday, we are back on Tuesday at nine.</p></div>"
    f"<div class=post data-y=1><p>{_SHORT}</p>{_LIST}{_PROSE}<pre>mix(flour, eggs)</pre></div>"
    f"<div id=comments><h3>Comments</h3>{_TALK}{_TALK}</div><form><p>Leave a reply</p><button>Send</button></form></body>",
)


def labels_by_hand(html: str) -> tuple[Page, list[int]]:
    """The tree of a hand-labelled page and its labels, which the tree itself does not see."""
    marks = re.findall(r"<([a-z][a-z0-9]*)[^>]*?(?:data-y=([01]))?>", html)
    page = Page(re.sub(r" data-y=[01]", "", html))
    given = [y for name, y in marks if name in BLOCKS]
    labels, at = [0] * len(page.parent), 0
    for i in range(1, len(labels)):
        labels[i] = labels[page.parent[i]]
        if page.kind[i] != "run":
            if given[at]:
                labels[i] = int(given[at])
            at += 1
    return page, _with_wrappers(page, labels)


# The chances, before any page is seen, that a child is not content,
# content or a wrapper, under a parent that is not content, content, a wrapper.
NEVER, ALWAYS = (1 - 2e-6, 1e-6, 1e-6), (1e-3, 1 - 2e-3, 1e-3)
PRIORS = {
    "-": (NEVER, (1 - 2e-5, 1e-5, 1e-5), (1 - 2e-5, 1e-5, 1e-5)),
    "aside": (NEVER, (0.998, 0.001, 0.001), (0.998, 0.001, 0.001)),
    "header": (NEVER, (0.05, 0.93, 0.02), (0.96, 0.02, 0.02)),
    "article": (NEVER, ALWAYS, (0.01, 0.95, 0.04)),
    "+": (NEVER, ALWAYS, (0.03, 0.67, 0.3)),
    "heading": (NEVER, ALWAYS, (0.4, 0.59, 0.01)),
    "paragraph": (NEVER, ALWAYS, (0.4, 0.59, 0.01)),
    "run": (NEVER, ALWAYS, (0.6, 0.4, 1e-6)),
    "box": (NEVER, (0.03, 0.94, 0.03), (0.2, 0.5, 0.3)),
    "": (NEVER, (0.02, 0.96, 0.02), (0.5, 0.3, 0.2)),
    "root": (NEVER, ALWAYS, (1e-3, 1e-3, 1 - 2e-3)),
}
SEEN = 5.0


def _prior(kind: str):
    if kind.endswith("-"):
        return PRIORS["-"]
    group = kind.rstrip("+")
    if group in ("nav", "footer", "aside", "form"):
        return PRIORS["aside"]
    if kind.endswith("+") and group != "article":
        return PRIORS["+"]
    return PRIORS.get(group, PRIORS[""])


class Model:
    """The potentials, from counts that are added to ``SEEN`` times the priors.

    The pages labelled by hand, which come first, weigh three times as much as
    those labelled by markup, which may all be made alike.
    """

    def __init__(self, groups: list[Counts]):
        total: Counter = Counter()
        for counts, weight in zip(groups, (600, 200)):
            size = sum(n for key, n in counts.items() if key[0] == "edge")
            for key, n in counts.items():
                total[key] += weight * n / max(size, 1)
        kinds = [g + h for g in GROUPS for h in ("", "+", "-")] + ["run"]
        # How many children of each class there are under each kind of parent.
        below = [{k: 1 + sum(total["edge", k, x, y] for y in range(3)) for k in kinds} for x in range(3)]
        # Menus must not make every list look like one: classes only tell content from wrappers.
        below[NOT] = below[CONTENT]
        self.edge = {}
        for kind in kinds:
            rows = []
            for above, prior in enumerate(_prior(kind)):
                n = [total["edge", kind, above, y] + SEEN * prior[y] for y in range(3)]
                share = below[above][kind] / sum(below[above].values())
                rows.append(tuple(share * x / sum(n) for x in n))
            self.edge[kind] = tuple(rows)
        self.look = {}
        of_label = Counter()
        for (sort, name, _, y), n in total.items():
            if sort == "look" and name.startswith("length"):
                of_label[y] += n
        for name, values in (("length", 4), ("linked", 2), ("sentence", 2), ("legal", 2)):
            for value in range(values):
                key = f"{name}:{value}"
                odds = [(total["look", key, 0, y] + 0.5) / (of_label[y] + 0.5 * values) for y in (0, 1)]
                self.look[key] = math.log(odds[1] / odds[0])


# What a run looks like is weak evidence: it never counts more than this.
STRONGEST = math.log(6)


def tempers(page: Page) -> list[float]:
    """The exponent of each node's potentials: one over the root of its parent's children.

    Siblings look alike and are not independent witnesses: ``n`` of them count
    as much as the root of ``n`` would.
    """
    children, power = Counter(page.parent), [1.0]
    for p in page.parent[1:]:
        power.append(power[p] / math.sqrt(children[p]))
    return power


def evidence(page: Page, model: Model, i: int) -> float:
    """What the look of a run says for content, as a logarithm."""
    look = sum(model.look[f"{name}:{int(value)}"] for name, value in page.look[i] or ())
    return min(max(look, -STRONGEST), STRONGEST)


def marginals(page: Page, model: Model) -> list[tuple[float, float, float]]:
    """The chances of each node to be not content, content and a wrapper.

    The weight of a labelling of all nodes is the product, over the nodes, of
    the potentials of node and parent and of the node's look, each to the power
    of ``tempers``. Children come behind their parents, so one loop from the
    back passes all messages upward and one from the front all messages downward.
    """
    n, power = len(page.parent), tempers(page)
    up = [[0.0, 0.0, 0.0] for _ in range(n)]  # logarithms
    said: list = [None] * n
    edges: list = [None] * n
    tempered: dict = {}
    exp, log = math.exp, math.log
    for i in range(n - 1, 0, -1):
        own, kind = up[i], (page.kind[i], power[i])
        if page.look[i]:
            own[CONTENT] += power[i] * evidence(page, model, i)
        top = max(own)
        a, b, c = (exp(x - top) for x in own)
        up[i] = own = (a, b, c)
        if kind not in tempered:
            # The sum of a row is how common the class is under such a parent.
            tempered[kind] = tuple(
                tuple(x * sum(row) ** (power[i] - 1) for x in row) for row in model.edge[page.kind[i]]
            )
        edges[i] = tempered[kind]
        said[i] = [log(max(x * a + y * b + z * c, 1e-300)) for x, y, z in edges[i]]
        above = up[page.parent[i]]
        for k in range(3):
            above[k] += said[i][k]
    chance: list = [(0.0, 0.0, 1.0)] * n
    for i in range(1, n):
        # The parent's chances without what this child told it.
        least = min(said[i])
        before = [c * exp(least - m) for c, m in zip(chance[page.parent[i]], said[i])]
        edge = edges[i]
        now = [sum(before[x] * edge[x][y] for x in range(3)) * up[i][y] for y in range(3)]
        size = sum(now)
        chance[i] = tuple(x / size for x in now)
    return chance


def main_text(html: str | None, model: Model) -> str:
    page = Page(html or "")
    chance = marginals(page, model)
    return "\n\n".join(t for t, c in zip(page.text, chance) if t is not None and c[CONTENT] > 0.5)


def train(pages: DataFrame, html: str = "html", rows: int = TRAIN_PAGES) -> Model:
    """Learn from the hand-labelled pages and about ``rows`` pages that mark their article."""
    by_hand: Counts = Counter()
    for text in LABELLED:
        by_hand += count_labels(*labels_by_hand(text))
    present = pages.filter(F.col(html).isNotNull()).select(F.col(html).cast("string").alias("html"))
    total = present.count()
    share = min(1.0, rows / total) if total else 1.0
    chosen = present.filter(F.pmod(F.xxhash64("html"), F.lit(1 << 20)) < int(share * (1 << 20)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: Counts = Counter()
        for batch in batches:
            for text in batch.column("html").to_pylist():
                page = Page(text)
                labels = labels_by_markup(page)
                if labels is not None:
                    found += count_labels(page, labels)
        rows = [(*key, n) for key, n in found.items()]
        if rows:
            kinds = [pa.string(), pa.string(), pa.int32(), pa.int32(), pa.int64()]
            columns = [pa.array(c, k) for c, k in zip(zip(*rows), kinds)]
            yield pa.record_batch(columns, ["sort", "name", "above", "label", "n"])

    counted = chosen.mapInArrow(run, "sort string, name string, above int, label int, n long")
    grouped = counted.groupBy("sort", "name", "above", "label").agg(F.sum("n").alias("n"))
    by_markup: Counts = Counter()
    for r in grouped.collect():
        by_markup[r["sort"], r["name"], r["above"], r["label"]] = r["n"]
    return Model([by_hand, by_markup] if by_markup else [by_hand])


def extract_text(pages: DataFrame, model: Model, html: str = "html", into: str = "text") -> DataFrame:
    """``pages`` with the main text of each page in place of its ``html``, empty if it has none.

    Character references are decoded, white space within a block becomes one
    blank, and blocks are joined by an empty line. A NULL page counts as empty.
    Rows and other columns stay; a column that is called ``into`` is replaced.
    """
    shared = pages.sparkSession.sparkContext.broadcast(model)

    def found(column: pa.Array) -> list[pa.Array]:
        return [pa.array([main_text(h, shared.value) for h in column.to_pylist()], pa.string())]

    return with_columns_of_text(pages, html, {into: "string"}, found, without=(html,))
