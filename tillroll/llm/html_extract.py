"""Main-text extraction by gradient-boosted trees over DOM nodes, decoded along the hierarchy.

Every element of a page is described by its tag, hashed attribute tokens, depth, sibling statistics and the densities of
its subtree (text, links, tags, paragraphs). Boosted regression trees give the chance that an element holds main text if
its parent does. Decoding picks the likeliest consistent choice for the whole page: below a dropped element everything is
dropped, and an element is open only if text of its own or an open child justifies it. The text of open elements is the
article.

Training: about `SAMPLE_PAGES` of the pages that name their article element, drawn by a hash of the id. They serve as they are,
and their pieces are put together anew in many layouts (`rebuilt`: other containers, side columns, notices, adverts,
forms, reader comments, in and around the article), where the right answer is known by construction. The trees are
fitted in one task over that bounded sample and broadcast (some ten thousand numbers).

Defined cases: null or empty html gives the empty text; a page without main text gives the empty text; ids may be null or
repeated, pages are extracted one by one; further columns are ignored; an empty table gives an empty result; where
there are pages but none to learn from, training raises a ValueError instead of losing their texts.
"""

from __future__ import annotations

import html
import math
import pickle
import random
import re
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillroll.llm.dom import ATTRIBUTE, Page, parse

SAMPLE_PAGES = 240
SAMPLE_BOUND = 4  # times SAMPLE_PAGES, whatever the draw gives
NAMING = "(?i)<(article|main)"
LAYOUTS = 12
TREES, DEPTH, RATE, LAMBDA = 100, 5, 0.2, 1.0
BINS = 32
NAME_SLOTS = 1 << 12
SEED = 9

GROUPS = (
    "article main section div p h1|h2|h3|h4|h5|h6 nav header footer aside form|input|button|label|select|fieldset|option "
    "ul|ol|menu|dl li|dt|dd a table|tbody|thead|tr|td|th blockquote|pre|figure body|html|#root|head"
).split()
GROUP_OF = {tag: i + 1 for i, group in enumerate(GROUPS) for tag in group.split("|")}
LINES = ("depth", "index", "siblings", "text", "own", "links", "tags", "paragraphs", "commas", "start", "share", "children", "same")
N_FEATURES = 2 + len(LINES) + 3

# Names that layouts give to their parts.
MAIN = ("content", "main-content", "post-content", "entry-content", "article-body", "story", "post", "entry", "text", "body-text")
PARTS = {
    "header": ("header", "site-header", "masthead", "top-bar", "page-header", "logo"),
    "nav": ("nav", "menu", "navbar", "navigation", "breadcrumb", "main-menu", "pagination", "links"),
    "aside": ("sidebar", "side", "widget", "related", "recommended", "popular", "trending", "more-stories"),
    "notice": ("notice", "cookie-notice", "cookie-banner", "consent", "alert", "newsletter", "popup", "gdpr", "subscribe", "paywall"),
    "ad": ("ad", "ads", "advert", "advertisement", "sponsored", "promo", "ad-slot", "banner-ad", "promotion"),
    "form": ("search-form", "login", "signup", "contact-form", "search"),
    "comments": ("comments", "comment-list", "commentlist", "discussion", "responses", "respond", "user-comments", "replies"),
    "share": ("share", "social", "share-buttons", "social-links", "tags", "byline-links"),
    "footer": ("footer", "site-footer", "copyright", "bottom", "colophon", "legal"),
}
MARKED = frozenset(t for names in PARTS.values() for name in names for t in name.split("-")) - {"main", "more", "top", "page", "list", "text", "user", "site", "links", "tags"}
PLAIN_TAGS = ("nav", "header", "footer", "aside", "form")


def names_of(attributes: str) -> set[str]:
    """Words of the class, id and role attributes, singular."""
    found = ATTRIBUTE.findall(attributes)
    text = " ".join(a or b or c for name, a, b, c in found if name.lower() in ("class", "id", "role", "itemprop"))
    return {w.rstrip("s") or w for w in re.findall(r"[a-z]+", re.sub(r"([a-z])([A-Z])", r"\1 \2", text).lower())}


def _bin(value: float) -> int:
    return min(BINS - 1, int(2 * math.log2(1 + value)))


def name_slots(attributes: str) -> list[int]:
    return [zlib.crc32(name.encode()) % NAME_SLOTS for name in names_of(attributes)] if attributes else []


def name_odds(pages: list[tuple[Page, np.ndarray]]) -> np.ndarray:
    """For each hashed attribute token the smoothed log-odds that an element named so is open below an open parent."""
    open_, dropped = np.ones(NAME_SLOTS), np.ones(NAME_SLOTS)
    for page, label in pages:
        for i, node in enumerate(page.elements):
            if node.parent >= 0 and label[node.parent]:
                for slot in name_slots(node.attributes):
                    (open_ if label[i] else dropped)[slot] += 1
    return np.clip(np.log(open_ / dropped), -5, 5)


def node_features(page: Page, odds: np.ndarray) -> np.ndarray:
    """One row of small integers per element."""
    nodes = page.elements
    n = len(nodes)
    text, links, paragraphs, commas = [0] * n, [0] * n, [0] * n, [0] * n
    for words, owners in page.blocks:
        if owners:
            commas[owners[0][0]] += words.count(",") + words.count(".")
    for i in range(n - 1, -1, -1):
        node = nodes[i]
        text[i] += node.own
        paragraphs[i] += node.tag == "p"
        if node.tag == "a":
            links[i] = text[i]
        if node.parent >= 0:
            for total in (text, links, paragraphs, commas):
                total[node.parent] += total[i]
    out = np.zeros((n, N_FEATURES), np.uint8)
    siblings: dict[int, Counter] = {}
    whole = max(1, text[0])
    for i, node in enumerate(nodes):
        above = nodes[node.parent] if node.parent >= 0 else node
        row = out[i]
        row[0], row[1] = GROUP_OF.get(node.tag, 0), GROUP_OF.get(above.tag, 0)
        at = node.parent if node.parent >= 0 else i
        if at not in siblings:
            siblings[at] = Counter(nodes[c].tag for c in above.children)
        same = siblings[at][node.tag]
        row[2 : 2 + len(LINES)] = (
            min(node.depth, BINS - 1),
            _bin(node.index),
            _bin(len(above.children)),
            _bin(text[i]),
            _bin(node.own),
            int(31 * links[i] / text[i]) if text[i] else 0,
            min(BINS - 1, int(1000 * (node.end - i) / (text[i] + 20))),
            _bin(paragraphs[i]),
            min(BINS - 1, int(400 * commas[i] / (text[i] + 20))),
            int(31 * node.first / whole),
            int(31 * text[i] / whole),
            _bin(len(node.children)),
            _bin(same),
        )
        slots = name_slots(node.attributes)
        row[-3:] = (
            min(len(slots), BINS - 1),
            16 + round(3 * min(max(sum(odds[k] for k in slots), -5), 5)),
            out[node.parent, -2] if i else 16,
        )
    return out


@dataclass
class Trees:
    """Boosted trees of equal depth: per tree a feature and a limit for each inner node, a value for each leaf."""

    features: np.ndarray
    limits: np.ndarray
    values: np.ndarray
    start: float
    odds: np.ndarray | None = None

    def scores(self, x: np.ndarray) -> np.ndarray:
        total, rows = np.full(len(x), self.start), np.arange(len(x))
        for feature, limit, value in zip(self.features, self.limits, self.values):
            at = np.zeros(len(x), np.int64)
            for _ in range(DEPTH):
                at = 2 * at + 1 + (x[rows, feature[at]] > limit[at])
            total += value[at - (1 << DEPTH) + 1]
        return total


def fit(x: np.ndarray, y: np.ndarray) -> Trees:
    """Newton boosting of the logistic loss on binned features."""
    used = np.flatnonzero(x.max(axis=0) > x.min(axis=0)) if len(x) else np.zeros(0, np.int64)
    inner, leaves = (1 << DEPTH) - 1, 1 << DEPTH
    features, limits, values = np.zeros((TREES, inner), np.int64), np.full((TREES, inner), BINS), np.zeros((TREES, leaves))
    if not len(x) or y.min() == y.max() or not len(used):
        return Trees(features, limits, values, -5.0 if not len(x) or not y.max() else 5.0)
    start = math.log(y.mean() / (1 - y.mean()))
    score, slots = np.full(len(x), start), x[:, used].astype(np.int64) + BINS * np.arange(len(used))
    for t in range(TREES):
        p = 1 / (1 + np.exp(-score))
        g, h = p - y, p * (1 - p)
        at = np.zeros(len(x), np.int64)
        for node in range(inner):
            rows = np.flatnonzero(at == node)
            if len(rows) >= 4:
                flat, shape = slots[rows].ravel(), (len(used), BINS)
                sum_g = np.bincount(flat, np.repeat(g[rows], len(used)), len(used) * BINS).reshape(shape).cumsum(axis=1)
                sum_h = np.bincount(flat, np.repeat(h[rows], len(used)), len(used) * BINS).reshape(shape).cumsum(axis=1)
                all_g, all_h = sum_g[:, -1:], sum_h[:, -1:]
                gain = sum_g**2 / (sum_h + LAMBDA) + (all_g - sum_g) ** 2 / (all_h - sum_h + LAMBDA)
                best = int(gain.argmax())
                features[t, node], limits[t, node] = used[best // BINS], best % BINS
            at[rows] = 2 * node + 1 + (x[rows, features[t, node]] > limits[t, node])
        leaf = at - inner
        values[t] = -RATE * np.bincount(leaf, g, leaves) / (np.bincount(leaf, h, leaves) + LAMBDA)
        score += values[t][leaf]
    return Trees(features, limits, values, start)


def decode(page: Page, scores: np.ndarray) -> np.ndarray:
    """Which elements are open in the likeliest choice without contradictions.

    The score of an element tells its chance of being open below an open parent. What lies below a dropped element is
    dropped with certainty, so a choice costs the open elements and the children dropped right below them. `worth[v]` is
    the best log-likelihood of all below an open v; an element without text of its own that cannot open any child at less
    than the child's own odds is not worth opening.
    """
    nodes = page.elements
    yes, no = -np.logaddexp(0, -scores), -np.logaddexp(0, scores)
    worth, loss = np.zeros(len(nodes)), np.full(len(nodes), np.inf)
    for i in range(len(nodes) - 1, 0, -1):
        if not nodes[i].own:
            worth[i] -= loss[i]  # what it costs to open the cheapest child; nothing if one opens by itself
        gain = yes[i] + worth[i] - no[i]
        above = nodes[i].parent
        worth[above] += no[i] + max(gain, 0.0)
        loss[above] = min(loss[above], max(-gain, 0.0))
        worth[i] = gain
    choice = np.zeros(len(nodes), bool)
    choice[0] = True
    for i, node in enumerate(nodes):
        if i:
            choice[i] = choice[node.parent] and worth[i] > 0
    return choice


def kept_text(page: Page, choice: np.ndarray) -> str:
    """Blocks whose text lies mostly in open elements, joined by line feeds."""
    kept = []
    for text, owners in page.blocks:
        inside = sum(n if choice[owner] else -n for owner, n in owners)
        if inside > 0:
            kept.append(text)
    return "\n".join(kept)


def main_owners(page: Page) -> np.ndarray | None:
    """Teacher for pages that name their article: elements with main text, or None where no element says so."""
    nodes = page.elements
    state = np.zeros(len(nodes), np.int8)  # 1 inside the article, 2 inside a marked part
    for i, node in enumerate(nodes):
        state[i] = state[node.parent] if node.parent >= 0 else 0
        if node.tag in PLAIN_TAGS or names_of(node.attributes) & {m.rstrip("s") or m for m in MARKED}:
            state[i] = 2
        elif node.tag in ("article", "main") and state[i] == 0:
            state[i] = 1
    if not (state == 1).any():
        return None
    return _holders(page, lambda owner: state[owner] == 1)


def _holders(page: Page, is_main) -> np.ndarray:
    """Elements whose subtree holds main text."""
    label = np.zeros(len(page.elements), bool)
    for _, owners in page.blocks:
        for owner, _ in owners:
            if is_main(owner):
                label[owner] = True
    for i in range(len(page.elements) - 1, 0, -1):
        if label[i]:
            label[page.elements[i].parent] = True
    return label


def rebuilt(rng: random.Random, main: list[str], short: list[str], other: list[str]) -> str:
    """A page around the blocks `main` in a layout drawn at random; `data-m` marks the elements that hold them."""

    def text(pool: list[str]) -> str:
        return html.escape(rng.choice(pool) if pool else "")

    def links(k: int) -> str:
        return "".join(f'<li><a href="/x">{text(short)[:40]}</a></li>' for _ in range(k))

    def named(kind: str, inner: str, tag: str | None = None) -> str:
        name = rng.choice(PARTS[kind])
        tag = tag or "div"
        if tag == "div" or rng.random() < 0.5:
            return f'<{tag} {rng.choice(("class", "id"))}="{rng.choice(("", "", "x-"))}{name}">{inner}</{tag}>'
        return f"<{tag}>{inner}</{tag}>"

    def part(kind: str) -> str:
        if kind == "header":
            return named(kind, f"<h1>{text(short)}</h1><p>{text(short)}</p>" + rng.choice(("", f"<ul>{links(4)}</ul>")), rng.choice(("header", None)))
        if kind == "nav":
            return rng.choice((f'<ul class="{rng.choice(PARTS["nav"])}">{links(6)}</ul>', named(kind, f"<ul>{links(7)}</ul>", rng.choice(("nav", None)))))
        if kind == "aside":
            return named(kind, f"<h3>{text(short)}</h3><ul>{links(4)}</ul>" + rng.choice(("", f"<p>{text(other)}</p>")), rng.choice(("aside", None)))
        if kind == "form":
            return rng.choice((f"<form><label>{text(short)}</label><input name=q><button>{text(short)[:12]}</button></form>", named(kind, f"<form><p>{text(short)}</p><input></form>")))
        if kind == "comments":
            each = "".join(rng.choice((f'<div class="comment"><p>{text(other)}</p></div>', f"<li><b>{text(short)[:12]}</b> <p>{text(other)}</p></li>", f'<p class="comment-body">{text(other)}</p>')) for _ in range(rng.randint(1, 5)))
            return named(kind, f"<h3>{text(short)[:20]}</h3>{each}", rng.choice(("section", None)))
        if kind == "share":
            return named(kind, links(3).replace("li>", "span>"))
        if kind == "footer":
            return named(kind, f"&copy; {text(short)}" + rng.choice(("", f"<p>{text(other)}</p>", f"<ul>{links(3)}</ul>")), rng.choice(("footer", "footer", None)))
        return named(kind, rng.choice((f"<p>{text(short)}</p>", text(short), f"<p>{text(other)}</p><a href='#'>{text(short)[:10]}</a>")), rng.choice((None, None, "section")))

    def main_block(i: int, block: str) -> str:
        body = html.escape(block)
        if rng.random() < 0.15:
            words = body.split(" ")
            k = rng.randrange(len(words))
            words[k] = rng.choice((f"<b>{words[k]}</b>", f'<a href="/y">{words[k]}</a>', f"<em>{words[k]}</em>"))
            body = " ".join(words)
        if i == 0 and rng.random() < 0.7:
            return f"<h1 data-m>{body[:80]}</h1>"
        tag = rng.choices(("p", "h2", "li", "blockquote", "td", "div"), (20, 2, 2, 1, 1, 2))[0]
        wrap = {"li": ("<ul>", "</ul>"), "td": ("<table><tr>", "</tr></table>")}.get(tag, ("", ""))
        return f'{wrap[0]}<{tag} data-m>{body}</{tag}>{wrap[1]}'

    inside = [main_block(i, b) for i, b in enumerate(main)]
    for kind in rng.choices(("ad", "aside", "share", "notice", "form", "comments", ""), (3, 2, 2, 2, 1, 2, 6), k=rng.randint(0, 3)):
        if kind:
            at = len(inside) if kind == "comments" else rng.randint(1, len(inside))
            inside.insert(at, part(kind))
    tag = rng.choice(("article", "article", "main", "div", "div", "section"))
    name = f' {rng.choice(("class", "id"))}="{rng.choice(MAIN)}"' if tag != "article" or rng.random() < 0.3 else ""
    content = f"<{tag}{name}>{''.join(inside)}</{tag}>"
    for _ in range(rng.randint(0, 2)):
        before = part(rng.choice(("ad", "notice", "share", "nav"))) if rng.random() < 0.3 else ""
        after = part(rng.choice(("ad", "comments", "aside", "form"))) if rng.random() < 0.4 else ""
        content = f'<div{rng.choice(("", " class=wrapper", " id=page", " class=container", " class=row"))}>{before}{content}{after}</div>'
    crowd = rng.choice((0.1, 0.5, 0.8))
    above = [part(k) for k in ("header", "nav", "notice", "ad", "form") if rng.random() < crowd]
    below = [part(k) for k in ("comments", "aside", "ad", "form", "notice", "footer") if rng.random() < crowd]
    return f"<html><head><title>t</title></head><body>{''.join(above)}{content}{''.join(below)}</body></html>"


def labelled_pages(sources: list[str]) -> list[tuple[Page, np.ndarray]]:
    """The sample pages that name their article, and the layouts built of their pieces, with the elements to be open."""
    rng, found, mains, short, other = random.Random(SEED), [], [], [], []
    for source in sources:
        page = parse(source)
        label = main_owners(page)
        if label is None:
            continue
        found.append((page, label))
        inside = [t for t, owners in page.blocks if owners and label[owners[0][0]]]
        mains.append(inside)
        other += [t[:400] for t in inside[:6]]
        short += [t[:120] for t, owners in page.blocks if owners and not label[owners[0][0]]][:10]
    for blocks in mains:
        for _ in range(LAYOUTS if blocks else 0):
            longest = rng.choice((8, 25, 80, 300, 1000, 4000))
            main = [b[:longest] for b in rng.sample(blocks, min(len(blocks), rng.randint(1, 12)))]
            page = parse(rebuilt(rng, main, short, other))
            mine = []
            for node in page.elements:
                mine.append("data-m" in node.attributes or (node.parent >= 0 and mine[node.parent]))
                node.attributes = node.attributes.replace(" data-m", "")
            found.append((page, _holders(page, lambda owner, mine=mine: mine[owner])))
    return found


def learn(sources: list[str]) -> Trees:
    """Trees from whole pages; they are asked about the children of open elements, so these are the examples."""
    pages = labelled_pages(sources)
    odds = name_odds(pages)
    x, y = [np.zeros((0, N_FEATURES), np.uint8)], [np.zeros(0)]
    for page, label in pages:
        asked = np.array([node.parent >= 0 and label[node.parent] for node in page.elements])
        x.append(node_features(page, odds)[asked])
        y.append(label[asked].astype(np.float64))
    trees = fit(np.concatenate(x), np.concatenate(y))
    trees.odds = odds
    return trees


def train(pages: DataFrame, id_col: str = "page_id", html_col: str = "html", sample_pages: int = SAMPLE_PAGES) -> Trees:
    """Trees fitted on about `sample_pages` whole pages, out of those with an <article> or <main>."""
    rows = pages.select(F.col(id_col).cast("string").alias("id"), F.col(html_col).alias("source")).filter("source IS NOT NULL")
    naming = F.col("source").rlike(NAMING)
    n = rows.filter(naming).count()
    draw = F.pmod(F.xxhash64(F.lit(SEED), "id", "source"), F.lit(1 << 30)) / float(1 << 30)
    # Pages that repeat are drawn together and count once, so the one task that learns holds a bounded number of pages.
    drawn = rows.filter(draw < min(1.0, sample_pages / max(n, 1))).filter(naming)
    sample = drawn.distinct().limit(SAMPLE_BOUND * sample_pages)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sources = [s for batch in batches for s in batch.column(1).to_pylist()]
        taught = any(main_owners(parse(s)) is not None for s in sources)
        model = pickle.dumps(learn(sources))
        yield pa.RecordBatch.from_arrays([pa.array([model], pa.binary()), pa.array([taught])], ["model", "taught"])

    ordered = sample.repartition(1).sortWithinPartitions("id", F.xxhash64("source"))
    found = ordered.mapInArrow(run, "model binary, taught boolean").first()
    if not (found and found["taught"]) and rows.filter(F.col("source").rlike(r"\S")).limit(1).count():
        raise ValueError("no sampled page names its main text in an <article> or <main>, so there is nothing to learn from")
    return pickle.loads(bytes(found["model"])) if found else learn([])


def extract_texts(sources: list[str], trees: Trees) -> list[str]:
    pages = [parse(s) for s in sources]
    scores = trees.scores(np.concatenate([node_features(p, trees.odds) for p in pages])) if pages else np.zeros(0)
    out, at = [], 0
    for page in pages:
        size = len(page.elements)
        out.append(kept_text(page, decode(page, scores[at : at + size])))
        at += size
    return out


def extract(pages: DataFrame, trees: Trees, html_col: str = "html", carry: list[str] | None = None) -> DataFrame:
    """(whole, text, n_chars): `whole` is a struct of the columns `carry` (default: all)."""
    shared = pages.sparkSession.sparkContext.broadcast(trees)
    packed = pages.select(
        F.struct(*[F.col(f"`{c}`") for c in carry or pages.columns]).alias("whole"),
        F.coalesce(F.col(html_col), F.lit("")).alias("source"),
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low in range(0, batch.num_rows, 256):
                part = batch.slice(low, 256)
                texts = extract_texts(part.column(1).to_pylist(), shared.value)
                columns = [part.column(0), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())]
                yield pa.RecordBatch.from_arrays(columns, ["whole", "text", "n_chars"])

    fields = [T.StructField("text", T.StringType()), T.StructField("n_chars", T.LongType())]
    return packed.mapInArrow(run, T.StructType([packed.schema["whole"], *fields]))
