"""Main text of web pages by consensus of a host's pages on the container's path.

Every page scores its containers by the text of their paragraphs less that of links and climbs from
the best to the ancestors that add nearly nothing but text, so that sections come with their headline
and lead; Spark counts the votes for generalised paths (tags with classes, digits made one) per host;
every page is then extracted from the containers on its host's winning path, or from its own best
container if it has none on that path. Menus, headers, footers, sidebars, notices, adverts, forms, scripts, styles and
reader comments inside are left out. Null and empty html, and pages without text, give the empty
text. Votes that tie go to the higher score, then the path first in the alphabet. Pages without a
host vote together. Repeated rows vote each time and get equal texts. An empty table gives none.
"""

from __future__ import annotations

import html as entities
import re

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Element names and the words of classes and ids that mark what is not the article.
CONTAINERS = {"article", "main", "section", "div", "td", "body"}
RAW = {"script", "style", "noscript", "template", "textarea", "title", "iframe", "svg"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"}
BLOCKS = {
    "address", "article", "aside", "blockquote", "body", "br", "dd", "details", "div", "dl", "dt", "fieldset",
    "figcaption", "figure", "footer", "form", "h1", "h2", "h3", "h4", "h5", "h6", "head", "header", "hr", "html",
    "li", "main", "nav", "ol", "p", "pre", "section", "summary", "table", "tbody", "td", "tfoot", "th", "thead",
    "tr", "ul",
}
OUT_TAGS = {"nav", "header", "footer", "aside", "form", "button", "select", "dialog", "menu", "head"}
OUT_WORDS = {
    "ad", "ads", "advert", "advertisement", "banner", "breadcrumb", "breadcrumbs", "comment", "comments", "cookie",
    "consent", "disqus", "footer", "header", "menu", "nav", "navbar", "navigation", "newsletter", "notice", "popup",
    "promo", "related", "share", "sharing", "sidebar", "social", "sponsor", "sponsored", "subscribe", "widget",
}
#: Words that leave a compound name of the words above what it is: related-posts, but not no-sidebar.
OUT_FILLERS = {
    "area", "bar", "block", "blocks", "box", "button", "buttons", "container", "form", "inner", "item", "items", "left",
    "link", "links", "list", "posts", "right", "section", "signup", "site", "slot", "thread", "top", "bottom", "wrap",
    "wrapper",
}
#: An element with more than this share of the page's text is no addition to it, whatever its name; an ancestor is
#: climbed to if at least this share of what it adds is text outside links.
MOST, ADDED_TEXT = 0.8, 0.7
#: Hosts whose winners are broadcast at most; more are joined by a shuffle with the same result.
BROADCAST_HOSTS = 100_000
SALTS = 16
_PART = re.compile(
    r"<!--.*?(?:-->|\Z)|<(?P<close>/?)(?P<tag>[a-zA-Z][a-zA-Z0-9:-]*)(?P<rest>(?:[^>\"']|\"[^\"]*\"|'[^']*')*+)>|<[!?][^>]*>",
    re.S,
)
_NAMES = re.compile(r"(?:^|\s)(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
_CLASS = re.compile(r"(?:^|\s)class\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
_SPACE = re.compile(r"\s+")


class Node:
    __slots__ = ("tag", "path", "out", "named", "link", "holder")

    def __init__(self, tag, path, out, named, link, holder):
        self.tag, self.path, self.out, self.named, self.link, self.holder = tag, path, out, named, link, holder


def _attribute(pattern: re.Pattern, rest: str) -> str:
    return " ".join(a or b or c for a, b, c in pattern.findall(rest))


def _is_addition(rest: str) -> bool:
    """A whole class, id or role is one of OUT_WORDS, or made of them and of OUT_FILLERS."""
    for name in _attribute(_NAMES, rest).lower().split():
        parts = {part for part in re.split(r"[^a-z]+", name) if part}
        if parts & OUT_WORDS and parts <= OUT_WORDS | OUT_FILLERS:
            return True
    return False


def read_blocks(html: str) -> list[tuple[str, tuple, bool, bool]]:
    """(text, containers from outer to inner as (number, path), within a link, left out) of each piece of
    text; a piece of None ends a block."""
    pieces = _pieces(html)
    held: dict[int, int] = {}
    total = 0
    for piece, _, link, out, named in pieces:
        if piece and not link and not out:
            size = len(piece.strip())
            total += size
            for element in named:
                held[element] = held.get(element, 0) + size
    gone = {n for _, _, _, _, named in pieces for n in named if held.get(n, 0) <= MOST * total}
    return [(piece, holder, link, out or not gone.isdisjoint(named)) for piece, holder, link, out, named in pieces]


def _pieces(html: str) -> list[tuple[str, tuple, bool, bool, tuple]]:
    """Text, containers, within a link, within an element of OUT_TAGS, elements around it named as additions."""
    root = Node("", "", False, (), False, ())
    stack, out, at, number = [root], [], 0, 0
    raw_end = None

    def text(piece: str) -> None:
        top = stack[-1]
        if piece:
            out.append((entities.unescape(piece), top.holder, top.link, top.out, top.named))

    while True:
        if raw_end:
            end = re.compile(rf"</{raw_end}\s*>", re.I).search(html, at)
            at, raw_end = (end.end() if end else len(html)), None
        part = _PART.search(html, at)
        if not part:
            text(html[at:])
            return out
        text(html[at : part.start()])
        at = part.end()
        tag = (part["tag"] or "").lower()
        if not tag:
            continue
        if tag in BLOCKS:
            out.append((None, (), False, False, ()))
        if part["close"]:
            for i in range(len(stack) - 1, 0, -1):
                if stack[i].tag == tag:
                    del stack[i:]
                    break
            continue
        rest = part["rest"]
        if tag in RAW:
            if not rest.endswith("/"):
                raw_end = tag
            continue
        if tag in VOID or rest.endswith("/") and tag not in BLOCKS:
            continue
        if tag in BLOCKS:
            # A block ends an open paragraph, an item the item before it.
            for i in range(len(stack) - 1, 0, -1):
                if stack[i].tag == "p" or (tag == "li" and stack[i].tag == "li"):
                    del stack[i:]
                    break
                if stack[i].tag in CONTAINERS or stack[i].tag in ("ul", "ol", "table"):
                    break
        top = stack[-1]
        gone, named = top.out or tag in OUT_TAGS, top.named
        if tag not in ("body", "html", "article", "main") and _is_addition(rest):
            named = (*named, at)
        path, holder = top.path, top.holder
        if tag in CONTAINERS:
            kinds = ".".join(sorted(re.sub(r"\d+", "0", _attribute(_CLASS, rest)).split()))
            path = f"{path}/{tag}.{kinds}" if kinds else f"{path}/{tag}"
            number += 1
            holder = (*holder, (number, path))
        stack.append(Node(tag, path, gone, named, top.link or tag == "a", holder))


def container_scores(pieces: list[tuple[str, tuple, bool, bool]]) -> dict[str, float]:
    """Score of each path on one page: half of what a child holds counts for its parent."""
    scores: dict[str, float] = {}
    for piece, holder, link, out in pieces:
        if out:
            continue
        size = len(piece.strip()) if piece else 0
        share = -0.5 if link else 1.0
        for _, path in reversed(holder):
            scores[path] = scores.get(path, 0.0) + size * share
            share /= 2
    return scores


def climbed(pieces: list[tuple[str, tuple, bool, bool]], path: str) -> str:
    """The outermost container around ``path``, within its article or main, that adds nearly only text to it."""
    around: list[str] = []
    text: dict[str, int] = {}
    linked: dict[str, int] = {}
    for piece, holder, link, out in pieces:
        paths = list(dict.fromkeys(p for _, p in holder))
        if not around and path in paths:
            around = paths[: paths.index(path) + 1]
        size = len(piece.strip()) if piece and not out else 0
        for p in paths:
            text[p] = text.get(p, 0) + (0 if link else size)
            linked[p] = linked.get(p, 0) + (size if link else 0)
    while len(around) > 1 and _tag(around) not in ("article", "main"):
        around = around[:-1]
        if _tag(around) == "body":
            break
        more_text, more_links = text[around[-1]] - text[path], linked[around[-1]] - linked[path]
        if more_text >= ADDED_TEXT * (more_text + more_links):
            path = around[-1]
    return path


def _tag(around: list[str]) -> str:
    """Tag of the innermost of the containers."""
    return around[-1][len(around[-2]) if len(around) > 1 else 0 :].lstrip("/").split(".")[0]


def best_path(pieces: list[tuple[str, tuple, bool, bool]]) -> tuple[str, float]:
    """The container to extract, and the negative score of the best one, from which it was climbed to."""
    score, path = min(((-v, p) for p, v in container_scores(pieces).items()), default=(0.0, ""))
    return climbed(pieces, path), score


def extract(html: str, path: str | None) -> str:
    """Text of the containers on ``path``; of the page's own best container if there is none."""
    pieces = read_blocks(html)
    if not path or not any(p == path for _, holder, _, out in pieces if not out for _, p in holder):
        path = best_path(pieces)[0]
    blocks, now = [], []
    for piece, holder, _, out in [*pieces, (None, (), False, False)]:
        if piece is None:
            line = _SPACE.sub(" ", "".join(now)).strip()
            if line:
                blocks.append(line)
            now = []
        elif not out and (not path or any(p == path for _, p in holder)):
            now.append(piece)
    return "\n".join(blocks)


def winning_paths(pages: DataFrame) -> DataFrame:
    """(host, path): the path with most votes of each host's pages."""
    def vote(batches):
        for batch in batches:
            best = [best_path(read_blocks(h)) if h else ("", 0.0) for h in batch["html"]]
            yield pd.DataFrame({"host": batch["host"], "path": [p for p, _ in best], "score": [-s for _, s in best]})

    votes = pages.select("host", "html").mapInPandas(vote, "host string, path string, score double").where("path <> ''")
    counted = votes.groupBy("host", "path").agg(F.count("*").alias("votes"), F.sum("score").alias("score"))
    rank = F.struct(-F.col("votes"), -F.round("score", 3), "path")
    return counted.groupBy("host").agg(F.min_by("path", rank).alias("path"))


def host_of(url):
    return F.lower(F.coalesce(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1), F.lit("")))


def main_text(pages: DataFrame) -> DataFrame:
    """``pages`` with ``text``."""
    hosted = pages.withColumn("host", host_of(F.col("url")))
    winners = winning_paths(hosted)
    if winners.limit(BROADCAST_HOSTS + 1).count() <= BROADCAST_HOSTS:
        joined = hosted.join(F.broadcast(winners), "host", "left")
    else:
        spread = winners.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        salted = hosted.withColumn("_salt", F.pmod(F.xxhash64("page_id", "url"), F.lit(SALTS)).cast("int"))
        joined = salted.join(spread, ["host", "_salt"], "left").drop("_salt")

    @F.pandas_udf("string")
    def run(texts: pd.Series, paths: pd.Series) -> pd.Series:
        return pd.Series([extract(t, p) if t else "" for t, p in zip(texts, paths)], dtype=object)

    return joined.withColumn("text", run("html", "path")).drop("path", "host")
