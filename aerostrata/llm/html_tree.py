"""Main text of HTML pages by a tree-structured graphical model.

Every element of a page is a variable, content or not, joined to its parent by a table of conditional
probabilities; its tag, the words of its class, id and role, the length of its own text, the share of links
in that, its place in the page and the number of like siblings are evidence. Sum-product message passing,
once up and once down the tree, gives exact marginals, and text whose element is content by more than one
half is kept. Tables and evidence weights are counted on a bounded sample of labelled pages: pages that show
a known document, whose lines are the content. What is known about words and tags before (menus, footers,
adverts, comments ...) enters as pseudo-counts, which labelled pages outweigh. Only text that a browser
doesn't show as such (head, scripts, styles and the like) is observed as no content.
"""

from __future__ import annotations

import html
import math
import re
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aerostrata.llm.common import stored, table
from aerostrata.llm.url_reputation import DOCUMENT_NUMBER, path_of

SAMPLE_PAGES = 4000
LEAST_LINE = 20
FEATURES = 1000
CLAMP = 60.0
WIDEST = 4.0
SHRINK = 10
KNOWN = 50
KNOWN_SHARE = 1e-5
TEMPER = 0.4
LEAST_BREAK = 0.001
MAIN_SHARE = 0.8

NAME = re.compile(r"/?[a-zA-Z][^\s/>]*")
ATTRIBUTE_END = re.compile(r"""=\s*(["'])|>""")
ATTRIBUTE = re.compile(r"""\b(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)

# Groups of HTML elements.
INLINE = set("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q s samp small span strike "
             "strong sub sup time tt u var".split())
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = set("script style textarea title noscript iframe template svg".split())
UNSEEN = RAW | {"head"}
NOT_CONTENT = set("nav header footer aside form menu dialog button select option figcaption".split())
CELLS, ROWS = {"td", "th"}, {"tr", "tbody", "thead", "tfoot"}
HEADINGS = {"h1", "h2", "h3", "h4", "h5", "h6"}
# Words in class, id or role that name parts around an article.
NAMES = set("ad ads advert adverts advertisement advertising banner sponsor sponsored promo promotion nav navbar navigation menu "
            "breadcrumb breadcrumbs header masthead footer sidebar aside complementary contentinfo cookie cookies consent notice "
            "gdpr alert popup modal overlay newsletter subscribe signup login comment comments respond reply replies disqus share "
            "sharing social related recommended pagination pager widget toolbar form search skip".split())
FRAME = {"#root", "html", "body", "main"}
# Pseudo-counts of (parent, child) labels, and weights of tags, for what the sample doesn't show.
PRIOR = {("frame", 1, 1): 50.0, ("frame", 1, 0): 50.0, ("frame", 0, 1): 50.0, ("frame", 0, 0): 100.0,
         ("part", 1, 1): 50.0, ("part", 1, 0): 0.5, ("part", 0, 1): 0.1, ("part", 0, 0): 50.0}
LIKELY = set("p article main section blockquote pre h1 h2 h3 h4 h5 h6 li ul ol table td tr dl dd dt body div html".split())


def _words(tag: str, attributes: str) -> tuple[str, ...]:
    """Words of the element's class, id and role. Those of a page's frame say nothing about its parts; an article's
    or heading's own name counts as a whole."""
    if not attributes or tag in ("html", "body", "main"):
        return ()
    out = set()
    for _, a, b, c in ATTRIBUTE.findall(attributes):
        whole = (a or b or c).lower()
        out.update([whole] if tag in HEADINGS or tag == "article" else re.split(r"[^a-z]+", whole))
    return tuple(sorted(f"word {x}" for x in out if x))


def _decoded(text: str) -> str:
    """Character references decoded, numbers of any length included."""
    if "&#" in text:
        text = re.sub(r"&#[1-9][0-9]{7,};?", "\ufffd", re.sub(r"&#0+(?=[0-9])", "&#", text))
    return html.unescape(text)


def tokens(text: str):
    """Pieces of a page in order, each (text, None, None) or ("", tag with / if it ends, attributes), in one pass.

    A tag or declaration that never ends is text, as all behind it. Once a quote never closes, the tags from there on
    end at their first >. An unclosed comment, script or style hides the rest.
    """
    at, look, quotes = 0, 0, True
    while True:
        start = text.find("<", look)
        if start < 0:
            break
        name, attributes = NAME.match(text, start + 1), ""
        if name:
            end, k = -1, name.end()
            while quotes:
                m = ATTRIBUTE_END.search(text, k)
                if not m or not m[1]:
                    end = m.start() if m else -1
                    break
                k = text.find(m[1], m.end()) + 1
                quotes = k > 0
            if not quotes:
                end = text.find(">", name.end())
            attributes = text[name.end():end]
        elif text.startswith("!--", start + 1):
            end = text.find("-->", start + 4)
            end = end + 2 if end >= 0 else len(text)
        elif text[start + 1:start + 2] in ("!", "?"):
            end = text.find(">", start)
        else:
            look = start + 1
            continue
        if end < 0:
            break
        if start > at:
            yield text[at:start], None, None
        at = look = end + 1
        if name:
            tag = name[0].lower()
            yield "", tag, attributes
            if tag in RAW and not attributes.endswith("/"):
                close = re.compile(f"</{tag}", re.I).search(text, at)
                at = look = close.start() if close else len(text)
    if at < len(text):
        yield text[at:], None, None


class Page:
    """Elements of one page in order: parent, tag, words; and runs of text (element, block, text, in a link).

    Inline elements without words are no elements of the tree; their text is their parent's.
    """

    def __init__(self, text: str | None):
        self.parent, self.tag, self.words, self.runs = [-1], ["#root"], [()], []
        # Open elements; how many of each tag; and, for each open block, how many of each inline tag directly above it.
        self.stack, self.open, self.inlines = [0], Counter(), [Counter()]
        block, link = 0, 0
        for piece, tag, attributes in tokens(text or ""):
            if tag is None:
                self.runs.append((self.stack[-1], block, _decoded(piece), link > 0))
                continue
            closing, tag = tag[0] == "/", tag.lstrip("/")
            if tag == "a":
                link = max(0, link + (-1 if closing else 1))
            inline = tag in INLINE
            block += not inline
            if closing:
                # An inline end tag closes nothing beyond its own block.
                if (self.inlines[-1] if inline else self.open)[tag]:
                    while self._pop() != tag:
                        pass
                continue
            if tag in VOID or attributes.endswith("/") and tag in RAW:
                continue
            if not inline:
                self._close(tag)
            words = _words(tag, attributes)
            if inline and not words:
                continue
            self.parent.append(self.stack[-1]), self.tag.append(tag), self.words.append(words)
            self.stack.append(len(self.parent) - 1)
            if inline:
                self.inlines[-1][tag] += 1
            else:
                self.open[tag] += 1
                self.inlines.append(Counter())

    def _pop(self) -> str:
        tag = self.tag[self.stack.pop()]
        if tag in INLINE:
            self.inlines[-1][tag] -= 1
        else:
            self.open[tag] -= 1
            self.inlines.pop()
        return tag

    def _close(self, tag: str):
        """Ends that the start of a block implies."""
        while len(self.stack) > 1:
            top = self.tag[self.stack[-1]]
            ends = (top == "p" or top in INLINE or top == tag == "li" or top in ("dt", "dd") and tag in ("dt", "dd")
                    or top in CELLS and tag in CELLS | ROWS or top == "tr" and tag in ROWS
                    or top in HEADINGS and tag in HEADINGS or top == "option" and tag in ("option", "optgroup")
                    or top == "head" and tag == "body")
            if not ends:
                return
            self._pop()

    def unseen(self) -> list[bool]:
        """Whether an element, or one around it, is never shown as text."""
        out = []
        for tag, parent in zip(self.tag, self.parent, strict=True):
            out.append(tag in UNSEEN or parent >= 0 and out[parent])
        return out

    def evidence(self) -> list[tuple[str, ...]]:
        """Features of each element: words, and for blocks tag, buckets of text length, link share, like siblings, place."""
        size, linked, before, seen = [0] * len(self.tag), [0] * len(self.tag), [None] * len(self.tag), 0
        for n, _, t, link in self.runs:
            k = len(t.strip())
            if before[n] is None:
                before[n] = seen
            size[n] += k
            linked[n] += k * link
            seen += k
        out = []
        for t, w, s, k, b, n in zip(self.tag, self.words, size, linked, before, self.like(), strict=True):
            if t in INLINE:
                out.append(w)
                continue
            out.append((f"tag {t}", f"text {min(3, int(math.log10(s + 1) + 0.5)) if s else 'none'}", f"links {round(2 * k / s) if s else 'none'}",
                        f"like {min(3, n.bit_length())}", f"place {min(9, 10 * b // seen) if s else 'none'}", *w))
        return out

    def like(self) -> list[int]:
        """How many siblings have the element's tag, and text of their own if it has, itself included."""
        full = {n for n, _, t, _ in self.runs if t.strip()}
        pairs = [(p, t, n in full) for n, (p, t) in enumerate(zip(self.parent, self.tag, strict=True))]
        count = Counter(pairs)
        return [count[x] for x in pairs]

    def kind(self, n: int) -> str:
        return "frame" if self.tag[n] in FRAME else "part"

    def blocks(self, keep) -> list[str]:
        """Texts of the blocks, white space collapsed, from the runs whose element is kept."""
        out, last = [], None
        for n, block, t, _ in self.runs:
            if keep[n]:
                if block != last:
                    out.append([])
                out[-1].append(t)
                last = block
        return [x for x in (" ".join("".join(t).split()) for t in out) if x]


class Model:
    """Evidence weights (log ratios) and the tables of child given parent, one for a page's frame and one for all below.

    `known`: words and tags held for no content before any page is seen, with the weight of KNOWN elements. Words and known
    tags count in full. Lengths, links and places depend on each other and are tempered; like siblings depend on each other,
    so such evidence and that of other tags is shared out among them. A label changes from parent to child with LEAST_BREAK
    at least.
    """

    def __init__(self, counts: dict[tuple[str, int], float], known: frozenset[str] | set[str] | None = None):
        known = self.known = known_names(known)
        pairs = {k: v + counts.get((f"pair {k[0]} {k[1]}", k[2]), 0) for k, v in PRIOR.items()}
        self.given = {(k, p): max(LEAST_BREAK, min(1 - LEAST_BREAK, pairs[k, p, 1] / (pairs[k, p, 0] + pairs[k, p, 1])))
                      for k in ("frame", "part") for p in (0, 1)}
        # Shrunk to the base rate of all blocks by SHRINK unseen elements each: a name that the sample lacks says nothing.
        total = [1 + sum(v for (n, y), v in counts.items() if y == label and n.startswith("like ")) for label in (0, 1)]
        base = total[1] / sum(total)
        self.weight = {f"tag {t}": 1.0 for t in LIKELY}
        for name in {n for n, _ in counts if not n.startswith("pair ")} | known:
            n, share, widest = SHRINK, base, WIDEST if name.startswith(("word ", "tag ")) else WIDEST / 2
            if name in known:
                n, share, widest = KNOWN, base * KNOWN_SHARE, 3 * WIDEST
            ratio = (counts.get((name, 1), 0) + n * share) / (counts.get((name, 0), 0) + n * (1 - share))
            self.weight[name] = max(-widest, min(widest, math.log(ratio * (1 - base) / base)))

    def local(self, page: Page) -> list[float]:
        """Log odds of each element by its own evidence."""
        out = []
        for unseen, features, like in zip(page.unseen(), page.evidence(), page.like(), strict=True):
            full = sum(self.weight.get(f, 0.0) for f in features if f in self.known or f.startswith("word "))
            shared = sum(self.weight.get(f, 0.0) * (1 if f.startswith("tag ") else TEMPER) for f in features
                         if f not in self.known and not f.startswith("word "))
            out.append(-CLAMP if unseen else full + shared / like)
        return out

    def marginals(self, page: Page) -> np.ndarray:
        """Log odds of content for each element; parents come before their children."""
        up = self.local(page)
        n = len(up)
        sent, down, given = [0.0] * n, [0.0] * n, [(0.5, 0.5)] * n
        for i in range(n - 1, 0, -1):
            kind = page.kind(page.parent[i])
            a, b = given[i] = self.given[kind, 1], self.given[kind, 0]
            e = math.exp(max(-CLAMP, min(CLAMP, up[i])))
            sent[i] = math.log((a * e + 1 - a) / (b * e + 1 - b))
            up[page.parent[i]] += sent[i]
        for i in range(1, n):
            p, (a, b) = page.parent[i], given[i]
            e = math.exp(max(-CLAMP, min(CLAMP, up[p] + down[p] - sent[i])))
            down[i] = math.log((a * e + b) / ((1 - a) * e + 1 - b))
        return np.array(up) + np.array(down)

    def text(self, source: str | None) -> str:
        page = Page(source)
        return " ".join(page.blocks((self.marginals(page) > 0).tolist()))


def known_names(known: frozenset[str] | set[str] | None = None) -> frozenset[str]:
    """Features held for no content beforehand; None: the fixed lists of words and tags."""
    return frozenset({*(f"word {x}" for x in NAMES), *(f"tag {x}" for x in NOT_CONTENT)} if known is None else known)


def label_counts(source: str | None, lines: set[str], starts: tuple[str, ...], known: frozenset[str] = known_names()) -> Counter:
    """Counts of (feature, label) and (pair, label) on one labelled page."""
    page, counts = Page(source), Counter()
    votes = np.zeros((len(page.tag), 2), np.int64)
    unseen = page.unseen()
    texts: dict[tuple[int, int], list[str]] = {}
    for n, block, t, _ in page.runs:
        texts.setdefault((n, block), []).append(t)
    for (n, _), t in texts.items():
        if (t := " ".join("".join(t).split())) and not unseen[n]:
            good = t in lines or len(t) >= LEAST_LINE and any(x.startswith(t) for x in starts)
            votes[n, int(good)] += len(t)
    # Content is what matches inside the lowest element that holds most of all matches: elsewhere a line agrees by chance.
    good = votes[:, 1].tolist()
    for i in range(len(good) - 1, 0, -1):
        good[page.parent[i]] += good[i]
    main = max((i for i, g in enumerate(good) if g >= MAIN_SHARE * good[0]), default=0)
    inside = []
    for i, p in enumerate(page.parent):
        inside.append(i == main or p >= 0 and inside[p])
    out = ~np.array(inside)
    votes[out, 0] += votes[out, 1]
    votes[out, 1] = 0
    for i in range(len(page.tag) - 1, 0, -1):
        votes[page.parent[i]] += votes[i]
    label = [None if not v.any() else int(v[1] > v[0]) for v in votes]
    explained: list[bool] = []
    for i, fs in enumerate(page.evidence()):
        explained.append(bool(page.words[i]) or i > 0 and explained[page.parent[i]] or not known.isdisjoint(fs))
        if label[i] is None:
            continue
        for f in fs:
            # Words and known tags explain the label of what is below them; other tags there say nothing about it.
            if f in known or not (explained[i] and f.startswith("tag ")):
                counts[f, label[i]] += 1
        if i and label[page.parent[i]] is not None:
            counts[f"pair {page.kind(page.parent[i])} {label[page.parent[i]]}", label[i]] += 1
    return counts


def train(pages: DataFrame, documents: DataFrame, sample_pages: int = SAMPLE_PAGES, features: int = FEATURES, known: set[str] | None = None) -> Model:
    """Counts on about `sample_pages` pages, chosen by a hash of their number, that show a document.

    Only the sums per feature reach the driver. The vocabulary is the `features` commonest (feature, label) rows of
    that sample; rarer tags and words say nothing, unless `known` (None: the fixed lists) holds them.
    """
    number = F.regexp_extract(path_of(F.col("url")), DOCUMENT_NUMBER, 1)
    share = min(1.0, sample_pages / max(1, pages.count()))
    sample = pages.filter(F.pmod(F.xxhash64("page_id"), F.lit(1 << 30)) < int(share * (1 << 30)))
    sample = stored(sample.select("html", F.when(number != "", number.cast("bigint")).alias("doc")).filter("doc IS NOT NULL"), "html-sample")
    wanted = stored(sample.select(F.col("doc").alias("doc_id")).distinct(), "html-wanted")
    texts = stored(documents.join(wanted, "doc_id").select(F.col("doc_id").alias("doc"), "text"), "html-texts")

    def run(batches):
        for b in batches:
            total = Counter()
            for source, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                lines = [" ".join(x.split()) for x in (text or "").split("\n")]
                total.update(label_counts(source, set(lines), tuple(lines), known))
            yield pa.RecordBatch.from_arrays([pa.array([k[0] for k in total], pa.string()), pa.array([k[1] for k in total], pa.int32()),
                                              pa.array(list(total.values()), pa.int64())], names=["name", "label", "n"])

    known = known_names(known)
    counted = sample.join(texts, "doc").select("html", "text").mapInArrow(run, "name string, label int, n long")
    sums = counted.groupBy("name", "label").agg(F.sum("n").alias("n"))
    return Model({(r["name"], r["label"]): float(r["n"]) for r in sums.orderBy(F.desc("n"), "name", "label").limit(features).collect()}, known)


def extract(pages: DataFrame, model: Model, source: str = "html") -> DataFrame:
    """The pages' columns without `source`, and text and n_chars (code points).

    A null or empty page has an empty text. Unclosed and badly nested elements end with the block that
    ends them; an unclosed comment, script or style hides the rest of the page, an unclosed tag is text. Work
    grows with the length of a page, however it is nested or broken. Repeated rows get equal
    texts, an empty table gives an empty result; text and n_chars replace columns of these names.
    """
    rest = [c for c in pages.columns if c not in (source, "text", "n_chars")]
    names = [*rest, "text", "n_chars"]

    def run(batches):
        for b in batches:
            texts = [model.text(t.as_py()) for t in b.column(len(rest))]
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], names=names)

    schema = "".join(f"`{c}` {pages.schema[c].dataType.simpleString()}, " for c in rest) + "text string, n_chars long"
    return pages.select(*rest, F.col(source).cast("string")).mapInArrow(run, schema)


def op9_html_tree_model(spark, sf_dir):
    pages = table(spark, sf_dir, "pages")
    return extract(pages.select("page_id", "url", "html"), train(pages, table(spark, sf_dir, "documents")))
