"""One Arrow pass over raw HTML.

Tag soup with unclosed elements cannot go through the XML builtins, so each
executor runs this small reader on Arrow batches. It keeps a page as two flat
lists, text nodes and elements (each element an interval of text nodes); every
rule after that (which link counts, which date, which title) is Spark columns.
"""

from __future__ import annotations

import html as htmllib
import re
from collections.abc import Iterator
from urllib.parse import urljoin

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from acervo import params as P
from acervo.session import widen

LINK = T.StructType([
    T.StructField("pos", T.IntegerType()),
    T.StructField("text", T.StringType()),
    T.StructField("href", T.StringType()),
    T.StructField("url", T.StringType()),
    T.StructField("heading", T.StringType()),
    T.StructField("dated", T.StringType()),
])
NODE = T.StructType([
    T.StructField("pos", T.IntegerType()),
    T.StructField("kind", T.StringType()),
    T.StructField("text", T.StringType()),
    T.StructField("url", T.StringType()),
])
CARD = T.StructType([
    T.StructField("pos", T.IntegerType()),
    T.StructField("title", T.StringType()),
    T.StructField("href", T.StringType()),
    T.StructField("url", T.StringType()),
    T.StructField("date_text", T.StringType()),
    T.StructField("date_attr", T.StringType()),
    T.StructField("summary", T.StringType()),
])
OUTPUTS = {
    "text": T.StringType(),
    "page_title": T.StringType(),
    "h1s": T.ArrayType(T.StringType()),
    "links": T.ArrayType(LINK),
    "nodes": T.ArrayType(NODE),
    "cards": T.ArrayType(CARD),
    "date_text": T.StringType(),
}
CARD_RULE = ["card_css", "title_css", "link_css", "date_css", "summary_css"]
PAGE_RULE = ["page_date_css"]

_TOKEN = re.compile(
    r"<!--.*?-->|<[!?][^>]*>|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>", re.S)
_ATTR = re.compile(r"([^\s=/\"'>]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
_VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "wbr"}
_RAW = {"script", "style"}
# elements that an opening tag ends, and those that shut them off from it
_ENDS = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"),
         "option": ("option",)}
_WALLS = {"li": {"ul", "ol", "menu"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table", "thead", "tbody", "tfoot"}, "td": {"tr", "table"},
          "th": {"tr", "table"}, "option": {"select"}}
_BLOCKS = {"address", "article", "aside", "blockquote", "div", "dl", "fieldset", "footer", "form", "h1", "h2", "h3", "h4", "h5", "h6",
           "header", "hr", "main", "nav", "ol", "p", "pre", "section", "table", "ul", "li", "dt", "dd"}
_P_WALLS = {"table", "td", "th", "caption", "button", "body", "html"}
_DATED = re.compile(r"\d{1,2}/\d{1,2}/\d{2,4}")
_STEP = re.compile(r"""([#.]?)([\w-]+)|\[([\w-]+)(?:(\^?=)["']?([^"'\]]*)["']?)?\]""")


class Page:
    """Text nodes and elements of one page, in document order."""

    def __init__(self, source: str, junk: frozenset[str]):
        self.texts: list[tuple[str, bool]] = []
        self.elements: list[dict] = []
        stack: list[dict] = []
        at = 0
        while True:
            token = _TOKEN.search(source, at)
            self._text(source[at:token.start()] if token else source[at:], stack)
            if not token:
                break
            at = token.end()
            name = (token.group(2) or "").lower()
            if not name:
                continue
            if token.group(1):
                for depth in range(len(stack) - 1, -1, -1):
                    if stack[depth]["tag"] == name:
                        del stack[depth:]
                        break
                continue
            self._imply(name, stack)
            element = {
                "tag": name, "raw": token.group(3), "attrs": None, "parent": stack[-1] if stack else None,
                "start": len(self.texts), "junk": name in junk or bool(stack and stack[-1]["junk"]),
            }
            self.elements.append(element)
            if name in _RAW:
                close = re.compile(rf"</{name}\s*>", re.I).search(source, at)
                at = close.end() if close else len(source)
            elif name not in _VOID and not token.group(3).endswith("/"):
                stack.append(element)
                element["open"] = True
        self._close()

    @staticmethod
    def _imply(name: str, stack: list[dict]) -> None:
        """Close what the opening tag ends: a paragraph before a block, and an item before the next of its list or row."""
        rules = [(("p",), _P_WALLS)] if name in _BLOCKS else []
        rules += [(_ENDS[name], _WALLS[name])] if name in _ENDS else []
        for ended, walls in rules:
            for depth in range(len(stack) - 1, -1, -1):
                if stack[depth]["tag"] in walls:
                    break
                if stack[depth]["tag"] in ended and (name != "tr" or stack[depth]["tag"] == "tr"):
                    del stack[depth:]
                    break

    def _text(self, raw: str, stack: list[dict]) -> None:
        stripped = htmllib.unescape(raw).strip() if raw else ""
        if stripped:
            self.texts.append((stripped, bool(stack and stack[-1]["junk"])))
            for element in stack:
                element["end"] = len(self.texts)

    def _close(self) -> None:
        for element in self.elements:
            element.setdefault("end", element["start"])

    def inner(self, element: dict | None, keep_junk: bool = False) -> list[str]:
        part = self.texts if element is None else self.texts[element["start"]:element["end"]]
        return [t for t, in_junk in part if keep_junk or not in_junk]

    def attrs(self, element: dict) -> dict[str, str]:
        if element["attrs"] is None:
            element["attrs"] = {
                k.lower(): htmllib.unescape(a or b or c) for k, a, b, c in _ATTR.findall(element["raw"] or "")
            }
        return element["attrs"]

    def find(self, selector: str, inside: dict | None = None, with_junk: bool = True) -> list[dict]:
        """Elements matching a selector of tags, ids, classes, attributes, descent and `>`."""
        words = selector.split()
        # (step, must be the direct parent of the step after it)
        steps = [(_STEP.findall(w), words[i + 1:i + 2] == [">"]) for i, w in enumerate(words) if w != ">"]
        return [e for e in self.elements if (with_junk or not e["junk"]) and self._matches(e, steps[-1][0])
                and self._within(e, inside) and self._below(e, steps[:-1])]

    @staticmethod
    def _within(element: dict, inside: dict | None) -> bool:
        above = element["parent"]
        while inside is not None and above is not None and above is not inside:
            above = above["parent"]
        return inside is None or above is inside

    def _below(self, element: dict, steps: list[tuple[list, bool]]) -> bool:
        """Whether the steps match above the element; a step that fails higher up is tried at the next ancestor."""
        if not steps:
            return True
        step, direct = steps[-1]
        above = element["parent"]
        while above is not None:
            if self._matches(above, step) and self._below(above, steps[:-1]):
                return True
            if direct:
                return False
            above = above["parent"]
        return False

    def _matches(self, element: dict, step: list[tuple[str, str, str, str, str]]) -> bool:
        for kind, name, attribute, test, wanted in step:
            if attribute:
                value = self.attrs(element).get(attribute)
                ok = value is not None and (
                    not test or value == wanted or (test == "^=" and value.startswith(wanted)))
            elif kind == "#":
                ok = self.attrs(element).get("id") == name
            elif kind == ".":
                ok = name in self.attrs(element).get("class", "").split()
            else:
                ok = element["tag"] == name
            if not ok:
                return False
        return True


def page_text(page: Page, article_mode: str, min_article: int, selectors: list[str], min_selector: int) -> str:
    base = None
    for selector in selectors:
        hit = next(iter(page.find(selector, with_junk=False)), None)
        if hit is not None and len("".join(page.inner(hit))) > min_selector:
            base = hit
            break
    if base is None and article_mode != "never":
        articles = [e for e in page.elements if e["tag"] == "article" and not e["junk"]]
        if articles and (article_mode != "single" or len(articles) == 1):
            # the single-article rule measures the joined text, the others the squeezed one
            glue = "\n" if article_mode == "single" else ""
            if article_mode == "always" or len(glue.join(page.inner(articles[0]))) > min_article:
                base = articles[0]
    return re.sub(r"\n{3,}", "\n\n", "\n".join(page.inner(base))).strip()


def _join(base: str | None, href: str) -> str | None:
    try:
        return urljoin(base or "", href)
    except ValueError:
        return None


def _phrase(page: Page, element: dict | None) -> str | None:
    return None if element is None else " ".join(page.inner(element, keep_junk=True))


def page_links(page: Page, base: str | None) -> list[dict]:
    """Links in document order; `dated` is the first text at or after a link that holds a date like 3/2/2026."""
    out = []
    dated: list[str | None] = [None]
    for text, _ in reversed(page.texts):
        dated.append(text if _DATED.search(text) else dated[-1])
    dated.reverse()
    for element in page.elements:
        if element["tag"] == "a" and "href" in page.attrs(element):
            href = page.attrs(element)["href"].strip()
            heading, above = None, element["parent"]
            while above is not None and heading is None:
                heading = above["tag"] if re.fullmatch(r"h[1-6]|li", above["tag"]) else None
                above = above["parent"]
            out.append({"pos": len(out), "text": _phrase(page, element), "href": href,
                        "url": _join(base, href), "heading": heading, "dated": dated[element["start"]]})
    return out


def page_nodes(page: Page, base: str | None) -> list[dict]:
    """Text nodes and links as one stream in document order."""
    links = sorted(
        ((e["start"], page.attrs(e)["href"].strip()) for e in page.elements
         if e["tag"] == "a" and "href" in page.attrs(e)), key=lambda x: x[0])
    out: list[dict] = []
    nxt = 0
    for i in range(len(page.texts) + 1):
        while nxt < len(links) and links[nxt][0] == i:
            out.append({"pos": len(out), "kind": "link", "text": None, "url": _join(base, links[nxt][1])})
            nxt += 1
        if i < len(page.texts):
            out.append({"pos": len(out), "kind": "text", "text": page.texts[i][0], "url": None})
    return out


def page_cards(page: Page, base: str | None, rule: dict[str, str | None]) -> list[dict]:
    """Listing items by the selectors of a rule row; cards without a link are left out."""
    if not rule["card_css"]:
        return []

    def first(css: str | None, card: dict) -> dict | None:
        return next(iter(page.find(css, inside=card)), None) if css else None

    out = []
    for card in page.find(rule["card_css"]):
        link = card if card["tag"] == "a" and not rule["link_css"] else first(rule["link_css"] or "a[href]", card)
        if link is None or "href" not in page.attrs(link):
            continue
        title = first(rule["title_css"], card)
        dated = first(rule["date_css"], card)
        href = page.attrs(link)["href"].strip()
        out.append({
            "pos": len(out), "title": _phrase(page, title if title is not None else link), "href": href,
            "url": _join(base, href), "date_text": _phrase(page, dated),
            "date_attr": page.attrs(dated).get("datetime") if dated is not None else None,
            "summary": _phrase(page, first(rule["summary_css"], card)),
        })
    return out


def read_pages(
    pages: DataFrame,
    keys: list[str],
    outputs: list[str],
    html_col: str = "html",
    base_col: str | None = "url",
    article_mode: str = "min",
    min_article: int = P.MIN_ARTICLE_CHARS,
    selectors: list[str] | None = None,
    min_selector: int = P.MIN_SELECTOR_CHARS,
    junk: list[str] | None = None,
) -> DataFrame:
    """Keys plus the asked outputs; nothing else crosses to Python or back.

    `article_mode`: `min` first article above `min_article`, `always` first
    article, `single` only a lone article above the minimum, `never`.
    `cards` and `date_text` need their rule columns (`card_css`, …, `page_date_css`) on the input.
    """
    fields = [pages.schema[k] for k in keys]
    schema = T.StructType(fields + [T.StructField(o, OUTPUTS[o]) for o in outputs])
    chosen = P.CONTENT_SELECTORS if selectors is None else selectors
    junk_set = frozenset(P.JUNK_TAGS if junk is None else junk)
    rules = (CARD_RULE if "cards" in outputs else []) + (PAGE_RULE if "date_text" in outputs else [])
    needed = list(dict.fromkeys([*keys, html_col, *([base_col] if base_col else []), *rules]))

    def one(source: str | None, base: str | None, rule: dict) -> dict:
        page = Page(source or "", junk_set)
        row: dict = {}
        for output in outputs:
            if output == "text":
                row[output] = page_text(page, article_mode, min_article, chosen, min_selector)
            elif output == "page_title":
                titles = [e for e in page.elements if e["tag"] == "title"]
                row[output] = _phrase(page, titles[0]) if titles else ""
            elif output == "h1s":
                row[output] = [_phrase(page, e) for e in page.elements if e["tag"] == "h1"]
            elif output == "links":
                row[output] = page_links(page, base)
            elif output == "date_text":
                css = rule["page_date_css"]
                hit = next(iter(page.find(css)), None) if css else None
                row[output] = None if hit is None else page.attrs(hit).get("datetime") or _phrase(page, hit)
            elif output == "nodes":
                row[output] = page_nodes(page, base)
            else:
                row[output] = page_cards(page, base, rule)
        return row

    def batches(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            bases = part[base_col] if base_col else [None] * len(part)
            rule_rows = part[rules].to_dict("records") if rules else [{}] * len(part)
            rows = [one(h, b, r) for h, b, r in zip(part[html_col], bases, rule_rows)]
            result = part[keys].reset_index(drop=True)
            for output in outputs:
                result[output] = pd.Series([r[output] for r in rows], dtype="object")
            yield result

    return widen(pages.select(*needed)).mapInPandas(batches, schema)
