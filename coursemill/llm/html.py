"""Main text of web pages by a tree-structured graphical model over the page's elements.

Each block element is a node with the states content and rest. A node's own features (tag, words of its class, id and
role, share of linked text, length, closing punctuation) give its potential; parent and child share one by their kinds.
Sum-product messages run from the leaves up and back down, so every node's marginal weighs the whole page. The
potentials are counts over labelled pages: small labelled layouts, and a bounded sample of the table's own pages that
mark their article.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from coursemill.llm.html_samples import LABELLED

#: Pages of the table that are labelled and counted, at most; and how much each bundled layout weighs against one of them.
SAMPLE, WEIGHT = 400, 20

# Elements that start a block, and those among them that mostly hold other blocks.
BLOCKS = frozenset("address article aside blockquote body button caption center dd details dialog div dl dt fieldset figcaption "
                   "figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html iframe label legend li main menu nav noscript object ol "
                   "optgroup option p pre script section select style summary svg table tbody td template textarea tfoot th thead "
                   "title tr ul video audio canvas".split())
BOXES = frozenset("article aside body center details dialog div dl fieldset figure footer form header html main menu nav ol section table "
                  "tbody tr ul".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
UNSEEN = frozenset(("script", "style", "template"))
CLOSES_P = BLOCKS - frozenset("button iframe label object script style svg video audio canvas noscript template select option".split())
#: Words of class, id and role that say something; longer words count if they begin with one of four letters or more.
HINTS = ("ad", "ads", "advert", "alert", "article", "banner", "body", "breadcrumb", "comment", "content", "cookie", "consent", "discuss",
         "disqus", "entry", "feedback", "footer", "gdpr", "header", "main", "menu", "modal", "nav", "newsletter", "notice", "notification",
         "pagination", "popup", "post", "promo", "recommend", "related", "remark", "repl", "respon", "share", "sidebar", "signup", "social",
         "sponsor", "story", "subscribe", "talkback", "text", "toolbar", "warning", "widget")
#: Hints of content; any other says that an element is about the page or other pages.
OWN = frozenset(("article", "body", "content", "entry", "main", "post", "story", "text"))
NEVER = re.compile(r"(?<![a-z])(?:nav|aside|footer|form)(?![a-z])")


class _Tree(HTMLParser):
    """Block elements in page order with their parents, and the text runs between block borders."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.tags, self.parents, self.names, self.labels = ["#page"], [-1], [""], ["0"]
        self.runs: list[list] = []  # node, pieces of text, linked characters
        self.stack, self.open = [0], Counter()
        self.links, self.fresh = 0, True

    def _pop(self, tag: str, stop: frozenset = frozenset()) -> None:
        """Close the nearest open ``tag``, unless an element of ``stop`` is nearer."""
        if not self.open[tag]:
            return
        for i in range(len(self.stack) - 1, 0, -1):
            own = self.tags[self.stack[i]]
            if own == tag:
                for node in self.stack[i:]:
                    self.open[self.tags[node]] -= 1
                del self.stack[i:]
                self.fresh = True
                return
            if own in stop:
                return

    def handle_starttag(self, tag: str, attrs) -> None:
        if tag not in BLOCKS:
            if tag == "a":
                self.links = 1
            elif tag == "br":
                self.handle_data(" ")
            return
        if tag in CLOSES_P:
            self._pop("p", BOXES)
        if tag == "body":
            self._pop("head")
        if tag in ("li", "dd", "dt", "option", "tr", "td", "th"):
            for other in {"dd": ("dd", "dt"), "dt": ("dd", "dt"), "td": ("td", "th"), "th": ("td", "th"), "tr": ("tr",)}.get(tag, (tag,)):
                self._pop(other, frozenset(("ul", "ol", "dl", "table", "select", "menu")))
        self.fresh = True
        if tag in VOID:
            return
        given = dict(attrs)
        self.tags.append(tag)
        self.parents.append(self.stack[-1])
        self.names.append(" ".join(given[k] for k in ("class", "id", "role") if given.get(k)).lower())
        self.labels.append(given.get("data-y") or self.labels[self.stack[-1]])
        self.stack.append(len(self.tags) - 1)
        self.open[tag] += 1

    def handle_endtag(self, tag: str) -> None:
        if tag == "a":
            self.links = 0
        elif tag in BLOCKS:
            self._pop(tag)

    def handle_data(self, data: str) -> None:
        node = self.stack[-1]
        if self.tags[node] in UNSEEN:
            return
        if self.fresh or not self.runs or self.runs[-1][0] != node:
            self.runs.append([node, [], 0])
            self.fresh = False
        self.runs[-1][1].append(data)
        if self.links:
            self.runs[-1][2] += len(data)


def _parse(html: str) -> tuple[_Tree, list[tuple[int, str, int]]]:
    tree = _Tree()
    tree.feed(html)
    tree.close()
    texts = [(node, " ".join("".join(pieces).split()), linked) for node, pieces, linked in tree.runs]
    return tree, [t for t in texts if t[1]]


def _bin(n: int) -> int:
    return 0 if n == 0 else 1 if n < 25 else 2 if n < 80 else 3 if n < 240 else 4


def _hints(names: str) -> list[str]:
    found = set()
    for word in re.findall(r"[a-z]+", names):
        found.update(h for h in HINTS if word == h or (len(h) >= 4 and word.startswith(h)))
    return sorted(found)


def _features(tree: _Tree, texts: list[tuple[int, str, int]]) -> list[list[str]]:
    """Names of the features of each node; linked share and length are those of a node's own text or, in boxes, of all below."""
    n = len(tree.tags)
    own, linked, closed = [0] * n, [0] * n, [False] * n
    for node, text, links in texts:
        own[node] += len(text)
        linked[node] += links
        closed[node] = closed[node] or text[-1] in ".!?…\"”»。"
    below, below_linked = own[:], linked[:]
    for i in range(n - 1, 0, -1):
        below[tree.parents[i]] += below[i]
        below_linked[tree.parents[i]] += below_linked[i]
    out = []
    for i, tag in enumerate(tree.tags):
        share = below_linked[i] / below[i] if below[i] else 0
        links = 0 if share < .05 else 1 if share < .5 else 2
        names = [f"tag {tag}", f"linked {links}", f"tag {tag} linked {links}"]
        if tag not in BOXES or own[i]:
            names += [f"length {_bin(own[i])}", f"closed {closed[i]}"]
        if tree.names[i]:
            hints = _hints(tree.names[i])
            names += [f"hint {h}" for h in hints]
            if hints:
                names.append(f"other {not OWN.issuperset(hints)}")
        out.append(names)
    return out


def _kind(tag: str) -> str:
    return "page" if tag in ("#page", "html", "body") else "box" if tag in BOXES else "text"


def count_page(html: str, marked: bool = False) -> Counter:
    """Counts of features and of parent-child states on a labelled page.

    ``marked``: the page has no labels, but exactly one article: what is in it is content, except for navigation, asides, footers
    and forms; a page with no article or several of them counts nothing.
    """
    tree, texts = _parse(html)
    if marked:
        if tree.tags.count("article") != 1:
            return Counter()
        state = [0] * len(tree.tags)
        for i in range(1, len(state)):
            bad = NEVER.search(tree.tags[i]) or not OWN.issuperset(_hints(tree.names[i]))
            state[i] = int((tree.tags[i] == "article" or state[tree.parents[i]] == 1) and not bad)
    else:
        state = [int(y) for y in tree.labels]
    counts: Counter = Counter()
    for i, names in enumerate(_features(tree, texts)):
        counts.update((f"{name}|{state[i]}" for name in names))
        counts[f"all|{state[i]}"] += 1
        if i:
            p = tree.parents[i]
            counts[f"pair {_kind(tree.tags[p])} {_kind(tree.tags[i])} {state[p]}|{state[i]}"] += 1
    return counts


def train(pages: DataFrame | None = None, html_col: str = "html", sample: int = SAMPLE) -> dict:
    """Potentials from the bundled layouts and ``sample`` of the pages at most: those with the smallest hash of their html.

    Only counts come back, one per feature and state.
    """
    counts: Counter = Counter()
    for html in LABELLED:
        for key, n in count_page(html).items():
            counts[key] += n * WEIGHT
    if pages is not None:
        def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            own: Counter = Counter()
            for batch in batches:
                for html in batch["html"]:
                    own.update(count_page(html, marked=True))
            yield pd.DataFrame({"key": list(own), "n": list(own.values())}).astype({"key": "object", "n": "int64"})

        # Equal pages count once: hashes of all are made distinct, the smallest taken.
        chosen = (pages.select(F.col(html_col).alias("html")).where("html is not null").groupBy(F.xxhash64("html").alias("hash"))
                  .agg(F.min("html").alias("html")).orderBy("hash").limit(sample).select("html"))
        for row in chosen.mapInPandas(count, "key string, n bigint").groupBy("key").agg(F.sum("n").alias("n")).collect():
            counts[row["key"]] += row["n"]
    log = lambda name, y, least: math.log((counts[f"{name}|{y}"] + 1) / (counts[f"all|{y}"] + least))
    names = {k.rsplit("|", 1)[0] for k in counts if not k.startswith(("all|", "pair "))}
    # Features of a node repeat each other, its tag twice; what an element is called stands on its own.
    part = lambda name: 1.0 if name.startswith(("hint ", "other ")) else 0.25 if name.startswith("tag ") else 0.5
    weight = {n: part(n) * (log(n, 1, 20) - log(n, 0, 20)) for n in names}
    pair = {}
    for parent in ("page", "box", "text"):
        for child in ("page", "box", "text"):
            rows = []
            for y in (0, 1):
                zero, one = (counts[f"pair {parent} {child} {y}|{s}"] for s in (0, 1))
                prior = (0.5, 1.5) if y else (1.5, 0.5)
                share = (one + prior[1]) / (zero + one + 2.0)
                rows.append((1 - share, share))
            pair[parent, child] = tuple(rows)
    return {"weight": weight, "pair": pair}


def marginals(tree: _Tree, texts: list[tuple[int, str, int]], model: dict) -> list[float]:
    """Chance of content of each node: messages from the leaves up, then from the root down."""
    weight, pair, n = model["weight"], model["pair"], len(tree.tags)
    up0, up1 = [1.0] * n, [1.0] * n
    for i, names in enumerate(_features(tree, texts)):
        up1[i] = math.exp(max(-30.0, min(30.0, sum(weight.get(x, 0.0) for x in names))))
    kinds = [_kind(t) for t in tree.tags]
    sent: list = [None] * n
    for i in range(n - 1, 0, -1):
        total = up0[i] + up1[i]
        up0[i], up1[i] = up0[i] / total, up1[i] / total
        p = tree.parents[i]
        (a0, a1), (b0, b1) = pair[kinds[p], kinds[i]]
        m0, m1 = a0 * up0[i] + a1 * up1[i], b0 * up0[i] + b1 * up1[i]
        sent[i] = (m0, m1)
        up0[p], up1[p] = up0[p] * m0, up1[p] * m1
        if up0[p] + up1[p] < 1e-200:
            up0[p], up1[p] = up0[p] * 1e200, up1[p] * 1e200
    content = [0.0] * n
    for i in range(1, n):
        p = tree.parents[i]
        (a0, a1), (b0, b1) = pair[kinds[p], kinds[i]]
        m0, m1 = sent[i]
        d0, d1 = (1 - content[p]) / max(m0, 1e-300), content[p] / max(m1, 1e-300)
        y0, y1 = up0[i] * (a0 * d0 + b0 * d1), up1[i] * (a1 * d0 + b1 * d1)
        content[i] = y1 / (y0 + y1) if y0 + y1 > 0 else 0.0
    return content


def main_text(html: str | None, model: dict) -> str:
    """Content blocks in page order, one per line; null and empty pages give an empty text."""
    if not isinstance(html, str) or not html:
        return ""
    tree, texts = _parse(html)
    chance = marginals(tree, texts, model)
    return "\n".join(text for node, text, _ in texts if chance[node] >= 0.5)


def extract_column(html: Column, model: dict) -> Column:
    @F.pandas_udf("string")
    def extract(pages: pd.Series) -> pd.Series:
        return pd.Series([main_text(h, model) for h in pages], dtype="object")

    return extract(html)


def extract_text(pages: DataFrame, html_col: str = "html", sample: int = SAMPLE) -> DataFrame:
    """Input rows with ``text`` and ``n_chars`` (its code points); columns of these names are replaced.

    The whole html of every row is read, however long or broken. Rows are judged one by one, so repeated pages agree;
    an empty table stays empty.
    """
    model = train(pages, html_col, sample)
    out = pages.drop("text", "n_chars").withColumn("text", extract_column(F.col(html_col), model))
    return out.withColumn("n_chars", F.length("text").cast("bigint"))
