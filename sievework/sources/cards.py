"""Cards and article rows of landed HTML pages, found by selectors with fallbacks.

A page becomes a tree of elements; ``pick`` gives the first element of the first selector that has one.
Selectors are a tag with ``.class``, ``[attr]``, ``[attr=value]`` or ``[attr*=part]``; the tag may be left out.
"""

from __future__ import annotations

import re
from collections import Counter
from dataclasses import dataclass
from functools import lru_cache
from html.parser import HTMLParser
from typing import Callable, Iterator

_VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())


class Element:
    __slots__ = ("tag", "attrs", "parent", "inside")

    def __init__(self, tag: str, attrs: dict[str, str], parent: Element | None) -> None:
        self.tag, self.attrs, self.parent, self.inside = tag, attrs, parent, []

    def descendants(self) -> Iterator[Element | str]:
        """Elements and texts below, in page order."""
        waiting = [iter(self.inside)]
        while waiting:
            item = next(waiting[-1], None)
            if item is None:
                waiting.pop()
                continue
            yield item
            if isinstance(item, Element):
                waiting.append(iter(item.inside))

    def texts(self) -> list[str]:
        return [t for t in self.descendants() if isinstance(t, str)]

    def text(self) -> str:
        """Its texts, each trimmed, without anything between."""
        return "".join(t.strip() for t in self.texts())

    def all(self, *selectors: str) -> list[Element]:
        """Elements below that any of the selectors takes."""
        takes = [matcher(s) for s in selectors]
        return [e for e in self.descendants() if isinstance(e, Element) and any(t(e) for t in takes)]

    def pick(self, *selectors: str) -> Element | None:
        for selector in selectors:
            take = matcher(selector)
            for e in self.descendants():
                if isinstance(e, Element) and take(e):
                    return e
        return None


@lru_cache(maxsize=512)
def matcher(selector: str) -> Callable[[Element], bool]:
    tag = re.match(r"[a-z0-9]*", selector)[0]
    classes = re.findall(r"\.([\w-]+)", re.sub(r"\[[^]]*\]", "", selector))
    attrs = re.findall(r"\[([\w-]+)(?:(\*?=)([^]]*))?\]", selector)

    def takes(e: Element) -> bool:
        if tag and e.tag != tag or classes and not set(classes) <= set(e.attrs.get("class", "").split()):
            return False
        for name, how, value in attrs:
            own = e.attrs.get(name)
            if own is None or how == "=" and own != value or how == "*=" and value not in own.lower():
                return False
        return True

    return takes


class _Tree(HTMLParser):
    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.root = self.at = Element("", {}, None)
        self.open: Counter[str] = Counter()

    def handle_starttag(self, tag, attrs):
        if tag in ("p", "li") and self.at.tag == tag:
            self._close()
        element = Element(tag, {k: v or "" for k, v in attrs}, self.at)
        self.at.inside.append(element)
        if tag not in _VOID:
            self.at = element
            self.open[tag] += 1

    def _close(self):
        self.open[self.at.tag] -= 1
        self.at = self.at.parent

    def handle_endtag(self, tag):
        if self.open[tag]:
            while self.at.tag != tag:
                self._close()
            self._close()

    def handle_data(self, data):
        if self.at.tag not in ("script", "style"):
            self.at.inside.append(data)


def tree(html: str | None) -> Element:
    parser = _Tree()
    parser.feed(html or "")
    parser.close()
    return parser.root


def first_group(root: Element, groups: list[list[str]]) -> list[Element]:
    """The elements of the first group of selectors that has any."""
    for selectors in groups:
        if found := root.all(*selectors):
            return found
    return []


# Job cards -----------------------------------------------------------------------------------------


@dataclass(frozen=True)
class Board:
    """Selectors of a board's cards and their parts, and what stands for missing parts."""

    cards: list[list[str]]
    title: list[str]
    company: list[str]
    place: list[str]
    link: list[str]
    no_company: str = ""
    no_place: str = "Location TBD"
    base: str = ""
    most: int | None = None
    least_title: int = 1
    generic: frozenset = frozenset()


# Selectors and defaults of job boards' result pages.
BOARDS = {
    "linkedin": Board(
        [["div.base-card"], ["div.job-search-card"], ["li.jobs-search-results__list-item"], ["div.result-card"], ["div.jobs-search__results-list"], ["li"]],
        ["h3.base-search-card__title", "h3.job-search-card__title", "a.result-card__full-card-link", "h3", "h2"],
        ["h4.base-search-card__subtitle", "h4.job-search-card__subtitle", "a.job-search-card__subtitle-link", "h4", "a.result-card__subtitle-link"],
        ["span.job-search-card__location", "div.job-search-card__location", "span.result-card__location"],
        ["a.base-card__full-link", "a.job-search-card__link", "a.result-card__full-card-link", "a[href]"],
        no_place="Ireland", base="https://www.linkedin.com",
    ),
    "lever": Board(
        [["div.posting"], ["a.posting-title"], ["div[data-qa=posting]"], ["a[href*=/jobs/]"]],
        ["h5", "a.posting-title", "h4", "div.posting-title"], [],
        ["span.sort-by-location", "span.location", "div.posting-categories", "span.posting-category"], ["a"],
    ),
    "workable": Board(
        [["li.job"], ["li.JobList__job"], ["a[href*=/jobs/]"]], ["h3", "h2", "a"], [], ["span.location", "li.location"], ["a"], no_place="Northern Ireland"
    ),
    "indeed": Board(
        [["div.job_seen_beacon"], ["div.cardOutline"], ["a.jcs-JobTitle"]], ["h2.jobTitle", "a.jcs-JobTitle", "span[title]"],
        ["span.companyName", "span[data-testid=company-name]"], ["div.companyLocation", "div[data-testid=text-location]"], ["a.jcs-JobTitle", "a"],
        no_company="Company Not Listed", no_place="Ireland", base="https://ie.indeed.com",
    ),
    "careers": Board(
        [["div[class*=job]", "div[class*=position]", "div[class*=career]"], ["li[class*=job]", "li[class*=position]"], ["article"], ["a[href*=/jobs/]", "a[href*=/careers/]", "a[href*=apply]"]],
        ["h2", "h3", "h4", "a"], [], ["span[class*=location]", "p[class*=location]"], ["a"],
        no_place="Ireland", most=20, least_title=5, generic=frozenset(["apply", "learn more", "view job", "careers", "back"]),
    ),
}


def job_cards(html: str | None, board: Board) -> list[tuple[str, str | None, str, str | None]]:
    """(title, company or None, place, link as written or None) of each card with a title."""
    out = []
    for card in first_group(tree(html), board.cards)[: board.most]:
        title = card.pick(*board.title)
        if title is None and card.tag == "a" and any(matcher(s)(card) for s in board.title):
            title = card
        text = title.text() if title is not None else ""
        if len(text) < board.least_title or text.lower() in board.generic:
            continue
        company, place = card.pick(*board.company), card.pick(*board.place)
        link = card if card.tag == "a" else card.pick(*board.link)
        out.append((text, company.text() if company is not None else None, place.text() if place is not None else board.no_place, link.attrs.get("href") if link is not None else None))
    return out


# Article rows --------------------------------------------------------------------------------------


@dataclass(frozen=True)
class Site:
    """A page whose articles are links of one path, each inside a card; ``day`` is a pattern of the date in a card's text, or None for ``time``."""

    path: str
    parents: tuple[str, ...]
    titles: tuple[str, ...]
    least_title: int
    day: str | None = None


# Listing pages with layouts of their own, by host, and the containers and date classes of all others.
SITES = {
    "enterprise-ireland.com": Site("/en/news/", ("div", "li", "article", "section"), ("h4",), 5, r"\d{1,2}(?:st|nd|rd|th)\s+\w+\s+\d{4}"),
    "businesspost.ie": Site("/(?:news|tech)/[^/]{5,}", ("article", "div", "li", "section"), ("h2", "h3", "h4"), 10),
}
CONTAINERS = [["article"], [".post", ".entry", ".news-item", ".article-card", ".teaser"], ["li.news", "li.post"]]
DATE_CLASSES = ["date", "published", "post-date", "entry-date", "article-date"]

Row = tuple[str, str, str | None, str]


def _plain(element: Element) -> str:
    return " ".join("".join(element.texts()).split())


def _time(card: Element) -> str | None:
    found = card.pick("time")
    return (found.attrs.get("datetime") or found.text() or None) if found is not None else None


def container_rows(html: str | None, most: int) -> list[Row]:
    """(title, link, date as written, snippet) of the first containers: the first link of a heading, or else the first link."""
    out = []
    for card in first_group(tree(html), CONTAINERS)[:most]:
        anchors = (h.pick("a[href]") for h in card.all("h2", "h3", "h4"))
        anchor = next((a for a in anchors if a is not None), None) or card.pick("a[href]")
        title = _plain(anchor) if anchor is not None else ""
        if not title or not anchor.attrs["href"]:
            continue
        date = _time(card)
        if date is None:
            marked = (card.pick(f"[class*={c}]") for c in DATE_CLASSES)
            date = next((t for e in marked if e is not None and (t := _plain(e))), None)
        out.append((title, anchor.attrs["href"], date, _plain(card.pick("p") or card)[:300]))
    return out


def site_rows(html: str | None, site: Site) -> list[Row]:
    """The same of a page with a layout of its own; of links to one place the first counts."""
    out, seen = [], set()
    for anchor in tree(html).all("a[href]"):
        link = anchor.attrs["href"]
        if not re.search(site.path, link) or "javascript:void" in link or link in seen:
            continue
        seen.add(link)
        card = anchor.parent
        while card is not None and card.tag not in site.parents:
            card = card.parent
        title = date = None
        if card is not None:
            title = next((t for h in card.all(*site.titles) if (t := h.text())), None)
            day = re.compile(site.day, re.IGNORECASE) if site.day else None
            date = next((m[0] for t in card.texts() if (m := day.search(t))), None) if day else _time(card)
        title = (title or anchor.text()).strip()
        if len(title) >= site.least_title:
            first = card.pick("p") if card is not None else None
            out.append((title, link, date, first.text()[:300] if first is not None else ""))
    return out
