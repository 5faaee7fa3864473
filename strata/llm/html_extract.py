"""Main text of web pages: boosted trees score the nodes of a page, and a choice over the
whole tree keeps ancestors and descendants in line."""

import html
import random
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.boosting import Trees, fit_trees
from strata.llm.shared import session

# Pages that the trees are fitted on, about, each with so many rebuilt ones.
SAMPLE_PAGES = 300
REBUILT = 2

# Fixed: how HTML elements behave.
BLOCKS = frozenset(
    "html body address article aside blockquote center dd details dialog dir div dl dt fieldset "
    "figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr legend li main menu nav ol p "
    "pre search section summary table tbody td tfoot th thead tr ul".split()
)
VOID = frozenset(
    "area base br col embed hr img input link meta param source track wbr".split()
)
# What these hold is no text: of RAW up to the end tag or else the end of the page, of
# SKIPPED up to their own end tag; without one, they are tags like others.
RAW = frozenset("script style textarea title".split())
SKIPPED = frozenset("noscript template svg math iframe select object canvas".split())
FOREIGN = ("svg", "math")
ENDS = {tag: re.compile(rf"</{tag}(?=[\s/>])[^>]*+>", re.I) for tag in RAW}
CLOSED_BY = {
    "li": {"li"},
    "dt": {"dt", "dd"},
    "dd": {"dt", "dd"},
    "tr": {"tr", "td", "th"},
    "td": {"td", "th"},
    "th": {"td", "th"},
}
CONTROLS = frozenset("button label option input".split())
# Attributes of any length; a quote counts after = only, and one that never ends does not.
MORE = r"(?:[^>=]++|=\s*+(?:\"[^\"]*+\"|'[^']*+'|[^\s>\"'][^\s>]*+|))*+"
TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    rf"|<(?P<end>/?)(?P<tag>[a-zA-Z][^\s/>]*+)(?P<more>{MORE})>"
    r"|<[!?/][^>]*+>",
    re.S | re.I,
)
ATTRIBUTE = re.compile(r"(?:class|id|role|aria-label|itemprop)\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s>]+)", re.I)

# Fixed: words that names of parts of pages are made of, by kind.
NAMES = {
    "menu": "nav menu breadcrumb toc pagination pager tabs",
    "head": "header masthead banner topbar logo site-title",
    "foot": "footer copyright colophon legal bottom",
    "side": "sidebar aside widget rail secondary",
    "ad": "ad ads advert advertisement sponsor sponsored promo banner-ad",
    "notice": "cookie consent notice alert popup modal gdpr overlay subscribe newsletter",
    "form": "form search login signup contact",
    "talk": "comment comments reply replies disqus discussion respond review reviews",
    "more": "related share social recommended tags trending popular author-box",
    "main": "article content post entry main body story text page blog",
}
NAME = re.compile("|".join(f"(?P<{k}>{'|'.join(sorted(v.split(), key=len, reverse=True))})" for k, v in NAMES.items()))
WORD = re.compile(r"[a-z][a-z-]*")
KINDS = list(NAMES)
GROUPS = [
    {"p"}, {"h1", "h2", "h3", "h4", "h5", "h6"}, {"li", "dd", "dt"}, {"ul", "ol", "dl", "menu", "dir"},
    {"article"}, {"main"}, {"section"}, {"div"}, {"nav"}, {"header", "hgroup"}, {"footer"}, {"aside"},
    {"form", "fieldset", "search", "dialog"}, {"table", "tr", "td", "th", "tbody", "thead", "tfoot"},
    {"blockquote", "pre", "figure", "figcaption", "address"}, {"body", "html"},
]
GROUP = {tag: i for i, tags in enumerate(GROUPS) for tag in tags}
BARRED = [GROUP[t] for t in ("nav", "header", "footer", "aside", "form")]


def name_kinds(attributes: str) -> list[int]:
    """Kinds of the words in the names that a tag carries."""
    found = set()
    for value in ATTRIBUTE.findall(attributes):
        for word in WORD.findall(value.strip("\"'").lower()):
            for part in {word, *word.split("-")}:
                if match := NAME.fullmatch(part):
                    found.add(KINDS.index(match.lastgroup))
    return sorted(found)


def _tokens(source: str) -> list[tuple[int, int, str, bool, str]]:
    """Tags and what is skipped: where each begins and ends, tag, whether it is an end tag,
    and attributes. Comments have no tag; skipped elements neither, but a blank."""
    found: list[tuple[int, int, str, bool, str]] = []
    opened: dict[str, list[int]] = {tag: [] for tag in SKIPPED}
    until: dict[int, int] = {}
    at = 0
    while token := TOKEN.search(source, at):
        begin, at = token.span()
        tag, ends, more = (token["tag"] or "").lower(), bool(token["end"]), token["more"] or ""
        # Only inside and at svg and math a slash closes a tag.
        inside = tag in FOREIGN or any(opened[t] for t in FOREIGN)
        closed = inside and more.endswith("/")
        if tag in RAW and not ends and not closed:
            end = ENDS[tag].search(source, at)
            at = end.end() if end else len(source)
            tag, more = "", " "
        elif tag in SKIPPED and ends and opened[tag]:
            until[opened[tag].pop()] = at
        elif tag in SKIPPED and not ends and not closed:
            opened[tag].append(begin)
        found.append((begin, at, tag, ends, more))
    out, at = [], 0
    for token in found:
        if token[0] in until and token[0] >= at:
            at = until[token[0]]
            out.append((token[0], at, "", False, " "))
        elif token[0] >= at:
            out.append(token)
            at = token[1]
    return out


class Page:
    """Block elements in order, each with its parent, tag and names, and the runs of text
    between their edges, each with the element it is in."""

    def __init__(self, source: str):
        self.parents, self.tags, self.kinds = [-1], ["html"], [[]]
        self.runs: list[tuple[int, str, int, int]] = []
        self.attributes: list[str] = [""]
        stack = [0]
        parts: list[str] = []
        link = control = linked = controlled = 0
        at = 0

        def flush():
            nonlocal parts, linked, controlled
            if parts:
                text = " ".join(html.unescape("".join(parts)).split())
                if text:
                    self.runs.append((stack[-1], text, linked, controlled))
                parts, linked, controlled = [], 0, 0

        for begin, end, tag, ends, more in _tokens(source):
            if begin > at:
                piece = source[at:begin]
                parts.append(piece)
                linked += len(piece) * (link > 0)
                controlled += len(piece) * (control > 0)
            at = end
            if not tag:
                if more:
                    parts.append(more)
                continue
            if tag == "br":
                parts.append(" ")
            elif tag == "a":
                link = max(0, link + (-1 if ends else 1))
            elif tag in CONTROLS:
                control = max(0, control + (-1 if ends else tag != "input"))
            if tag not in BLOCKS:
                continue
            flush()
            link = control = 0
            if ends:
                for depth in range(len(stack) - 1, 0, -1):
                    if self.tags[stack[depth]] == tag:
                        del stack[depth:]
                        break
                continue
            if tag in ("html", "body") and len(stack) > 1 and tag in [self.tags[i] for i in stack]:
                continue
            if tag == "html" and len(self.tags) == 1:
                continue
            closing = CLOSED_BY.get(tag, set())
            while len(stack) > 1 and (
                self.tags[stack[-1]] == "p"
                or self.tags[stack[-1]] in closing
                or (tag[0] == "h" and tag[1:].isdigit() and self.tags[stack[-1]][1:].isdigit())
            ):
                stack.pop()
            if tag in VOID:
                continue
            self.parents.append(stack[-1])
            self.tags.append(tag)
            self.kinds.append(name_kinds(more) if "=" in more else [])
            self.attributes.append(more)
            stack.append(len(self.tags) - 1)
        if at < len(source):
            parts.append(source[at:])
        flush()


def _sums(own: np.ndarray, parents: np.ndarray) -> np.ndarray:
    """Per node what it and all below it have; parents come before their children."""
    out = own.astype(float).copy()
    for i in range(len(out) - 1, 0, -1):
        out[parents[i]] += out[i]
    return out


PLAIN = 22
FEATURES = PLAIN + len(GROUPS) + 2 * len(KINDS) + len(BARRED) + 1


def features(page: Page) -> np.ndarray:
    """A row per node: text and links below it, depth, place among its siblings, and the
    names and tags of itself and of those above."""
    n = len(page.tags)
    parents = np.array(page.parents)
    own = np.zeros((n, 8))
    before = np.zeros(n)
    seen = 0
    for node, text, linked, controlled in page.runs:
        size = len(text)
        marks = text.count(".") + text.count(",")
        own[node] += (size, linked, controlled, 1, marks, text.count(" ") + 1, 0, 0)
        own[node, 6] = max(own[node, 6], size)
    for i, tag in enumerate(page.tags):
        own[i, 7] = tag == "p"
    below = own.copy()
    nodes = np.ones(n)
    items = np.array([t == "li" for t in page.tags], float)
    longest = own[:, 6].copy()
    for i in range(n - 1, 0, -1):
        p = parents[i]
        below[p] += below[i]
        nodes[p] += nodes[i]
        items[p] += items[i]
        longest[p] = max(longest[p], longest[i])
    depth, place, count = np.zeros(n), np.zeros(n), np.zeros(n)
    up_kinds, up_tags = np.zeros((n, len(KINDS))), np.zeros((n, len(BARRED)))
    own_kinds, own_tags = np.zeros((n, len(KINDS))), np.zeros((n, len(GROUPS) + 1))
    left = np.zeros(n)
    last: dict[int, int] = {}
    for i in range(n):
        own_tags[i, GROUP.get(page.tags[i], len(GROUPS))] = 1
        own_kinds[i, page.kinds[i]] = 1
        if i:
            p = parents[i]
            depth[i] = depth[p] + 1
            place[i] = count[p]
            count[p] += 1
            up_kinds[i] = np.maximum(up_kinds[p], own_kinds[p])
            up_tags[i] = np.maximum(up_tags[p], own_tags[p, BARRED])
            left[i] = below[last[p], 0] if p in last else -1
            last[p] = i
    running = np.cumsum(own[:, 0])
    before = running - own[:, 0]
    total = max(below[0, 0], 1)
    size = np.maximum(below[:, 0], 1)
    brothers = count[np.maximum(parents, 0)]
    upper = np.maximum(parents, 0)
    plain = np.column_stack(
        [
            depth,
            place,
            brothers,
            place / np.maximum(brothers, 1),
            np.log1p(below[:, 0]),
            np.log1p(own[:, 0]),
            below[:, 1] / size,
            below[:, 2] / size,
            np.log1p(nodes),
            below[:, 0] / nodes,
            below[:, 4] / size,
            below[:, 5] / np.maximum(below[:, 3], 1),
            np.log1p(longest),
            below[:, 0] / total,
            before / total,
            (before + below[:, 0]) / total,
            items / nodes,
            below[:, 7] / nodes,
            np.log1p(below[upper, 0]),
            below[upper, 1] / size[upper],
            np.log1p(np.maximum(left, 0)),
            below[upper, 7],
        ]
    )
    return np.hstack([plain, own_tags, own_kinds, up_kinds, up_tags])


def choose(page: Page, logits: np.ndarray) -> list[str]:
    """The texts of the choice with the best sum of scores, where all below a kept node
    are kept and all below a dropped one dropped; others are decided child by child, and
    their own text by their own score."""
    n = len(page.tags)
    whole = logits.astype(float).copy()
    apart = np.zeros(n)
    for i in range(n - 1, -1, -1):
        best = max(abs(whole[i]), apart[i])
        if i:
            whole[page.parents[i]] += whole[i]
            apart[page.parents[i]] += best
    state = [0] * n
    for i in range(n):
        above = state[page.parents[i]] if i else 0
        if above:
            state[i] = above
        elif abs(whole[i]) >= apart[i]:
            state[i] = 1 if whole[i] > 0 else -1
    return [
        text
        for node, text, _, _ in page.runs
        if state[node] > 0 or (state[node] == 0 and logits[node] > 0)
    ]


def _marked(page: Page, anywhere: bool = False) -> np.ndarray | None:
    """For each run whether it is main text, as the tags of the page say: inside an article
    or main element, or ``anywhere``, but in none for other things. None if none is."""
    inside, barred = np.zeros(len(page.tags), bool), np.zeros(len(page.tags), bool)
    out = {KINDS.index(k) for k in KINDS if k != "main"}
    for i, tag in enumerate(page.tags):
        p = page.parents[i]
        inside[i] = anywhere or tag in ("article", "main") or (i and inside[p])
        bad = tag in ("nav", "aside", "footer", "form") or (anywhere and tag == "header") or (out & set(page.kinds[i]))
        barred[i] = bool(bad) or (i and barred[p])
    main = np.array([inside[r[0]] and not barred[r[0]] for r in page.runs], bool)
    return main if main.any() else None


# For rebuilt pages: how other pages write the same parts.
WRAPPERS = ["article", "main", "div class=content", "div class=post-body", "div id=main", "div class=entry-content",
            "section class=story", "div", "div class=article-text", "section"]
PARTS = {
    "menu": ["nav", "ul class=menu", "div class=navbar", "div id=breadcrumbs", "div class=nav-links"],
    "head": ["header", "div class=header", "div id=masthead"],
    "foot": ["footer", "div class=footer", "div id=site-footer"],
    "side": ["aside", "div class=sidebar", "div class=widget"],
    "ad": ["div class=ad", "div class=advert", "div class=sponsored", "div id=promo", "aside class=ads"],
    "notice": ["div class=cookie-banner", "div class=notice", "div id=consent", "section class=newsletter"],
    "form": ["form", "form class=search", "div class=login"],
    "talk": ["section class=comments", "div id=comments", "div class=discussion", "ol class=comment-list"],
    "more": ["div class=related", "div class=share", "ul class=tags", "section class=recommended"],
}
LISTED = ["ul", "ol", "dl", "table"]
# Share of rebuilt pages whose main text is a block or two.
SHORT = 0.15
PLACES = {"menu": 0, "head": 0, "notice": 0, "foot": 2, "talk": 2, "more": 2}


def _element(opening: str, inner: str) -> str:
    name, _, more = opening.partition(" ")
    more = re.sub(r"=(\S+)", r'="\1"', more)
    return f"<{name}{' ' + more if more else ''}>{inner}</{name}>"


def _part(kind: str, say, pick: random.Random) -> str:
    esc = html.escape
    links = "".join(
        f"<li><a href=#>{esc(say(pick.randint(1, 3)))}</a></li>" for _ in range(pick.randint(2, 8))
    )
    if kind in ("menu", "more"):
        opening = pick.choice(PARTS[kind])
        return _element(opening, links if opening.startswith("ul") else f"<ul>{links}</ul>")
    if kind == "form":
        fields = "".join(f"<label>{esc(say(2))}<input name=x></label>" for _ in range(pick.randint(1, 4)))
        return _element(pick.choice(PARTS[kind]), f"<p>{esc(say(6))}</p>{fields}<button>{esc(say(1))}</button>")
    if kind == "talk":
        each = [f"<div class=comment><b>{esc(say(1))}</b><p>{esc(say(pick.randint(5, 60)))}</p></div>" for _ in range(pick.randint(1, 6))]
        return _element(pick.choice(PARTS[kind]), f"<h3>{esc(say(2))}</h3>{''.join(each)}")
    if kind == "side":
        return _element(pick.choice(PARTS[kind]), f"<h3>{esc(say(2))}</h3><p>{esc(say(pick.randint(5, 25)))}</p><ul>{links}</ul>")
    words = esc(say(pick.randint(4, 25)))
    inner = pick.choice([words, f"<p>{words}</p>", f"{words} <a href=#>{esc(say(2))}</a>"])
    return _element(pick.choice(PARTS[kind]), inner)


def _listed(kind: str, say, pick: random.Random) -> str:
    """A list or table that belongs to the main text."""

    def cell(tag: str) -> str:
        return f"<{tag} data-main>{html.escape(say(pick.randint(1, 12)))}</{tag}>"

    rows = range(pick.randint(2, 5))
    if kind == "dl":
        inner = "".join(cell("dt") + cell("dd") for _ in rows)
    elif kind == "table":
        inner = "".join(f"<tr>{cell('td')}{cell('td')}</tr>" for _ in rows)
    else:
        inner = "".join(cell("li") for _ in rows)
    return f"<{kind}>{inner}</{kind}>"


def _rebuilt(texts: list[tuple[str, str]], say, pick: random.Random) -> str:
    """A page with the same main text in other dress, among parts of all kinds. The main
    text carries a mark that is taken off before anything looks at the names."""
    blocks = []
    if pick.random() < SHORT:
        texts = texts[: pick.randint(1, 2)]
    for i, (tag, text) in enumerate(texts):
        tag = tag if tag in ("h1", "h2", "p") else pick.choice(["p", "p", "div", "blockquote", "h2"])
        if tag == "p" and pick.random() < 0.1:
            tag = "pre"
        blocks.append(f"<{tag} data-main>{html.escape(text)}</{tag}>")
        if i and pick.random() < 0.1:
            blocks.append(_part(pick.choice(["ad", "more", "notice", "form", "side"]), say, pick))
    for kind in LISTED:
        if pick.random() < 0.15:
            blocks.insert(pick.randint(min(1, len(blocks)), len(blocks)), _listed(kind, say, pick))
    if pick.random() < 0.3:
        blocks.append(_part("talk", say, pick))
    main = "".join(blocks)
    for _ in range(pick.randint(1, 3)):
        main = _element(pick.choice(WRAPPERS), main)
    around = ["", main, ""]
    for kind in PARTS:
        if pick.random() < 0.6:
            side = PLACES.get(kind, pick.choice([0, 2]))
            around[side] += _part(kind, say, pick)
    inner = "".join(around)
    return f"<html><body>{_element(pick.choice(['div id=page', 'div class=wrapper', 'div']), inner) if pick.random() < 0.6 else inner}</body></html>"


def _targets(page: Page, main: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Per node the share of main text, and its weight; nodes without text have none."""
    size = np.zeros((2, len(page.tags)))
    for (node, text, _, _), is_main in zip(page.runs, main):
        size[0, node] += len(text)
        size[1, node] += len(text) * is_main
    parents = np.array(page.parents)
    whole, part = _sums(size[0], parents), _sums(size[1], parents)
    return part / np.maximum(whole, 1), (whole > 0).astype(float)


def fit_extractor(pages: DataFrame, content: str = "html", sample_pages: int = SAMPLE_PAGES) -> Trees | None:
    """Fit on about ``sample_pages`` pages, chosen by a hash, whose tags tell the main text,
    and on REBUILT pages for each, made from their texts with other tags and names and with
    menus, adverts, forms, comments and the like. None if there are no such pages."""
    rows = pages.select(F.col(f"`{content}`").alias("_html")).where(F.col("_html").isNotNull())
    count = rows.count()
    if count > sample_pages:
        part = int(sample_pages / count * 1_000_000) + 1
        rows = rows.where(F.pmod(F.xxhash64("_html", F.lit(9)), F.lit(1_000_000)) < part)
    sources = sorted(r[0] for r in rows.collect())
    known = [(p, m) for p in map(Page, sources) if (m := _marked(p)) is not None]
    if not known:
        return None
    pick = random.Random(5)
    words = [w for p, m in known for (_, t, _, _), k in zip(p.runs, m) if k for w in t.split()]

    def say(n: int) -> str:
        at = pick.randrange(len(words))
        return " ".join(words[at : at + n])

    for page, main in list(known):
        texts = [(page.tags[r[0]], r[1]) for r, k in zip(page.runs, main) if k]
        for _ in range(REBUILT):
            new = Page(_rebuilt(texts, say, pick))
            known.append((new, np.array(["data-main" in new.attributes[r[0]] for r in new.runs])))
    measured = [features(p) for p, _ in known]
    targets = [_targets(p, m) for p, m in known]
    return fit_trees(
        np.vstack(measured), np.concatenate([t for t, _ in targets]), np.concatenate([w for _, w in targets])
    )


def _unbarred(page: Page) -> list[str]:
    """The texts that neither tags nor names give to other parts of a page."""
    main = _marked(page, True)
    return [] if main is None else [run[1] for run, kept in zip(page.runs, main) if kept]


def _extracted(trees: Trees | None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = []
            column = batch.column("_html")
            for low in range(0, len(column), 200):
                pages = [Page(x or "") for x in column.slice(low, 200).to_pylist()]
                sizes = np.cumsum([len(p.tags) for p in pages])[:-1]
                rows = np.vstack([features(p) for p in pages])
                if trees is None:
                    texts += ["\n".join(_unbarred(page)) for page in pages]
                    continue
                for page, own in zip(pages, np.split(trees.logits(rows), sizes)):
                    texts.append("\n".join(choose(page, own)))
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(c) for c in batch.schema.names if c != "_html"], pa.array(texts, pa.string())],
                names=[*[c for c in batch.schema.names if c != "_html"], "_text"],
            )

    return run


def extract(pages: DataFrame, trees: Trees | None, keep: list[str], content: str = "html") -> DataFrame:
    """The columns ``keep`` of every row of ``pages`` and ``_text``, its main text: blocks
    in page order, one per line, white space as one space, character references decoded.
    Null and empty pages have an empty text. Whole pages are read. Without trees
    all text is kept that neither tags nor names give to menus, comments and the like."""
    session(pages)
    rows = pages.select(*[F.col(f"`{c}`") for c in keep], F.col(f"`{content}`").alias("_html"))
    schema = rows.drop("_html").withColumn("_text", F.lit("")).schema
    return rows.mapInArrow(_extracted(trees), schema)
