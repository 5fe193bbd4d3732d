"""Person links and next-page links out of landed listing pages.

A page is read in one pass by column expressions: one replacement marks every tag
and drops comments and the contents of scripts, a split at the marks gives tags
with the text that follows each, and a fold over them keeps the open lists and
the entries that still wait for their link as its state. No page goes to Python.
``parser``, over the standard library's HTML parser, reads the same and is there to
check the expressions against.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html.entities import html5
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rollbook.functions.text import bind

# Where a listing keeps its entries
LIST_CLASS = "gem-c-document-list"
CONTENT_ID = "data-ga4-ecommerce-content-id"
NEXT_CLASS_ENDING = "pagination__next"
PERSON_PREFIX = "/government/people/"

# the rest of a tag behind its name: quoted values may hold any character; elements whose content is no markup
_REST = r"""[^>"']*+(?:"[^"]*+"[^>"']*+|'[^']*+'[^>"']*+)*+>"""
_HIDDEN = ("script", "style", "textarea", "title")
# comments and what is not shown, or a tag: its "<" as group 2 and what follows that as group 3
_MARKUP = (
    rf"(?is)<(?:!--.*?(?:-->|\z)|({'|'.join(_HIDDEN)})(?=[\s/>]){_REST}.*?(?:</\1\s*>|\z)|[!?][^>]*>"
    rf"|(?<=(<))(/?[a-z]{_REST}))"
)
_TAG = rf"(?is)^</?[a-z]{_REST}"
_MARK, _ROW, _IS = "\u0001", "\u0002", "\u0003"
_ATTRIBUTE = r"""([^\s"'>/=]+)\s*=\s*("[^"]*"|'[^']*'|[^\s>"']+)"""
_QUOTES = r"""^["']|["']$"""
_LISTING = r"(?i)^<(/?(?:ul|li|a))(?=[\s/>])"
_NUMBER = "^#([0-9]{1,9}|[xX][0-9a-fA-F]{1,7});?"


def _written(entries: dict[str, str]) -> str:
    """A table as one text, which plans carry more easily than a map of thousands of entries."""
    return _ROW + "".join(f"{name}{_IS}{value}{_ROW}" for name, value in entries.items())


# what names stand for, by their first letter, also those that stand without a semicolon; numbers that are no characters
_LETTERS = [chr(c) for c in range(ord("A"), ord("z") + 1)]
_NAMED = [_written({n: v for n, v in html5.items() if n.startswith(letter)}) for letter in _LETTERS]
_LOOSE = "|".join(sorted((n for n in html5 if not n.endswith(";")), key=len, reverse=True))
_NUMBERED = _written({str(n): bytes([n]).decode("cp1252", "ignore") or chr(n) for n in range(128, 160)} | {"0": "�", "13": "\r"})


def _text(value: str) -> str:
    """A SQL literal."""
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


# The expressions below are SQL text: as column objects, thousands of calls to the JVM would build them.


def _bind(value: str, name: str, body: str) -> str:
    """``body`` of a value that it names several times and that is worked out once a row."""
    return f"transform(array({value}), {name} -> {body})[0]"


def _look_up(table: str, name: str) -> str:
    """The value of a name; null if the table does not have it."""
    behind = f"substring_index({table}, concat({_text(_ROW)}, {name}, {_text(_IS)}), -1)"
    return f"nullif(substring_index({behind}, {_text(_ROW)}, 1), '')"


def _reference(rest: str) -> str:
    """What follows an ampersand, with the reference it opens replaced; with the ampersand if it opens none."""
    no_character = "(n > 1114111 or n between 55296 and 57343)"
    character = f"coalesce({_look_up(_text(_NUMBERED), 'string(n)')}, if({no_character}, '�', decode(unhex(lpad(hex(n), 8, '0')), 'UTF-32')))"
    digits = f"regexp_extract({rest}, {_text(_NUMBER)}, 1)"
    number = f"case when {digits} = '' then null when lower({digits}) like 'x%' then bigint(conv(substr({digits}, 2), 16, 10)) else bigint({digits}) end"
    numbered = _bind(number, "n", f"if(n is null, concat('&', {rest}), concat({character}, regexp_replace({rest}, {_text(_NUMBER)}, '')))")
    # a name with its semicolon, else the longest one that stands without
    table = f"get(array({', '.join(map(_text, _NAMED))}), ascii(name) - {ord(_LETTERS[0])})"
    read = f"concat({_look_up(table, 'name')}, substr({rest}, length(name) + 1))"
    named, loose = (_bind(f"regexp_extract({rest}, '^({names})', 1)", "name", read) for names in ("[A-Za-z][A-Za-z0-9]{0,31};", _LOOSE))
    return f"if(startswith({rest}, '#'), {numbered}, coalesce({named}, {loose}, concat('&', {rest})))"


def _unescape(text: str) -> str:
    """Character references replaced, all that HTML names and numbers."""
    joined = f"concat(parts[0], array_join(transform(slice(parts, 2, size(parts)), rest -> {_reference('rest')}), ''))"
    return f"if(contains({text}, '&'), {_bind(f'''split({text}, '&')''', 'parts', joined)}, {text})"


def _attributes(tag: str) -> str:
    """(name, value) of a tag's attributes as they are written."""
    names, values = (f"regexp_extract_all({tag}, {_text(_ATTRIBUTE)}, {n})" for n in (1, 2))
    return f"zip_with({names}, {values}, (a, b) -> named_struct('name', lower(a), 'value', b))"


def _value(attributes: str, name: str) -> str:
    """Value of the last attribute of that name; null if there is none."""
    return f"regexp_replace(try_element_at(filter({attributes}, x -> x.name = {_text(name.lower())}), -1).value, {_text(_QUOTES)}, '')"


def _pieces(html: str) -> str:
    """The page cut before every tag; comments and what is not shown are left out."""
    return f"split(regexp_replace(replace({html}, {_text(_MARK)}, ''), {_text(_MARKUP)}, {_text(_MARK + '$2$3')}), {_text(_MARK)})"


def _links_of(pieces: str, list_class: str | None) -> str:
    """Entries of the first list (of the class): ``first`` piece of the link, ``end`` behind its last one, and how many ``entries`` share it.

    An entry takes its first link, also one that belongs to an entry within it. The fold writes its findings
    to a string, which grows by copying bytes and not rows.
    """
    classes = _value(_attributes(f"regexp_extract({pieces}[t.at], {_text(_TAG)}, 0)"), "class")
    opens = "true" if list_class is None else f"array_contains(split(coalesce({classes}, ''), {_text('[ \t\n\r\f]+')}), {_text(list_class)})"
    named = f"transform({pieces}, (p, i) -> named_struct('at', i, 'n', lower(regexp_extract(p, {_text(_LISTING)}, 1))))"
    tokens = f"transform(filter({named}, t -> t.n <> ''), t -> named_struct('at', t.at, 'n', t.n, 'opens', t.n = 'ul' and {opens}))"
    none, links = "cast(array() as array<int>)", "(t.n = 'a' and s.depth > 0 and size(s.waiting) > 0)"
    closes = f"(s.open and (t.n = '/a' or {links}))"
    step = f"""named_struct(
      'depth', s.depth + case when t.n = 'ul' and not s.done and (s.depth > 0 or t.opens) then 1 when t.n = '/ul' and s.depth > 0 then -1 else 0 end,
      'done', s.done or (t.n = '/ul' and s.depth = 1),
      'waiting', case when s.depth > 0 and t.n in ('li', '/li') then concat(filter(s.waiting, l -> l < s.depth), if(t.n = 'li', array(s.depth), {none}))
        when {links} then {none} else s.waiting end,
      'open', (s.open and not {closes}) or {links},
      'found', if({closes} or {links}, concat(s.found, if({closes}, concat(':', t.at), ''), if({links}, concat(',', t.at, ':', size(s.waiting)), '')), s.found))"""
    start = f"named_struct('depth', 0, 'done', false, 'waiting', {none}, 'open', false, 'found', '')"
    found = f"filter(split(concat(s.found, if(s.open, concat(':', size({pieces})), '')), ','), x -> x <> '')"
    parted = f"transform({found}, x -> named_struct('first', int(split(x, ':')[0]), 'entries', int(split(x, ':')[1]), 'end', int(split(x, ':')[2])))"
    # nothing changes once the list is closed and its last link too
    return f"aggregate({tokens}, {start}, (s, t) -> if(s.done and not s.open, s, {step}), s -> {parted})"


def _listed(html: str, list_class: str | None, content_id: str) -> Column:
    """Entries of a page: array of (content_id, name, href)."""
    text = f"array_join(transform(slice(pieces, link.first + 1, link.end - link.first), p -> regexp_replace(p, {_text(_TAG)}, '')), '')"
    held = _attributes(f"regexp_extract(pieces[link.first], {_text(_TAG)}, 0)")
    written = _bind(held, "held", f"array({_value('held', content_id)}, {text}, {_value('held', 'href')})")
    read = _bind(f"transform({written}, w -> {_unescape('w')})", "v", "named_struct('content_id', v[0], 'name', v[1], 'href', v[2])")
    entries = f"flatten(transform({_links_of('pieces', list_class)}, link -> array_repeat({read}, link.entries)))"
    return F.expr(_bind(_pieces(html), "pieces", entries))


def resolve_url(href: Column, base: str) -> Column:
    """Absolute form of a link found on a site whose root is ``base``."""
    root = base.rstrip("/")
    scheme = root.split("//", 1)[0]
    return (
        F.when(href.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*:"), href)
        .when(href.startswith("//"), F.concat(F.lit(scheme), href))
        .when(href.startswith("/"), F.concat(F.lit(root), href))
        .otherwise(F.concat(F.lit(root + "/"), href))
    )


class _ListReader(HTMLParser):
    """First list of the class; the first link of each of its items, nested ones too."""

    def __init__(self, list_class: str | None, content_id: str):
        super().__init__(convert_charrefs=True)
        self.list_class, self.content_id = list_class, content_id
        self.depth, self.done, self.hidden = 0, False, None
        self.items: list[dict] = []
        self.waiting: list[dict] = []  # open items that have no link yet
        self.link: list[dict] = []  # items whose link is open

    def handle_starttag(self, tag, attrs):
        if self.hidden or tag in _HIDDEN:
            self.hidden = self.hidden or tag
            return
        values = dict(attrs)
        if tag == "ul" and not self.done:
            classes = (values.get("class") or "").split()
            if self.depth or self.list_class is None or self.list_class in classes:
                self.depth += 1
        elif self.depth and tag == "li":
            item = {"content_id": None, "name": "", "href": None, "found": False, "level": self.depth}
            self.waiting = [w for w in self.waiting if w["level"] < self.depth] + [item]
            self.items.append(item)
        elif self.depth and tag == "a" and self.waiting:
            for item in self.waiting:
                item.update(content_id=values.get(self.content_id), href=values.get("href"), found=True)
            self.link, self.waiting = self.waiting, []

    def handle_endtag(self, tag):
        if self.hidden:
            self.hidden = None if tag == self.hidden else self.hidden
        elif tag == "a":
            self.link = []
        elif tag == "li" and self.depth:
            self.waiting = [w for w in self.waiting if w["level"] < self.depth]
        elif tag == "ul" and self.depth:
            self.depth -= 1
            self.done = self.depth == 0

    def handle_data(self, data):
        for item in self.link if not self.hidden else ():
            item["name"] += data


def _parsed_links(pages: DataFrame, keep: list[str], html: str, list_class: str | None, content_id: str) -> DataFrame:
    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = []
            for page in batch[html]:
                reader = _ListReader(list_class, content_id)
                reader.feed(page or "")
                reader.close()
                found.append(
                    [{k: i[k] for k in ("content_id", "name", "href")} for i in reader.items if i["found"]]
                )
            yield batch[keep].assign(links=found)

    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in pages.select(*keep).schema.fields]
    parsed = pages.select(*keep, html).mapInPandas(
        read, ", ".join([*fields, "links array<struct<content_id: string, name: string, href: string>>"])
    )
    return parsed.select(*keep, F.explode("links").alias("l")).select(*keep, "l.content_id", "l.name", "l.href")


def page_links(
    pages: DataFrame,
    keep: list[str],
    html: str = "html",
    list_class: str | None = LIST_CLASS,
    content_id: str = CONTENT_ID,
    reader: str = "expression",
) -> DataFrame:
    """One row per entry of the page's listing: ``keep``, content_id, name, href.

    ``list_class=None`` takes the first list of the page. Contents of scripts, styles, titles and text areas are
    no text. ``reader="parser"`` reads the pages in Python.
    """
    if reader not in {"expression", "parser"}:
        raise ValueError("reader must be 'expression' or 'parser'")
    if reader == "parser":
        return _parsed_links(pages, keep, html, list_class, content_id)
    return pages.select(*keep, F.inline(_listed(f"`{html}`", list_class, content_id)))


def next_page(html: str, base: str, class_ending: str = NEXT_CLASS_ENDING) -> Column:
    """Absolute link to the following page, from the column ``html``; null on the last one."""
    ending = re.escape(class_ending)
    opening = rf"""<div\s(?=[^>]*{ending})[^>]*?class\s*=\s*["'](?:[^"']*\s)?[^"'\s]*{ending}(?:\s[^"']*)?["'][^>]*>"""
    anchor = rf"(?is){opening}.*?(<a\s[^>]*>)"
    href = _bind(_value(_attributes(f"regexp_extract(`{html}`, {_text(anchor)}, 1)"), "href"), "href", _unescape("href"))
    return bind(F.expr(href), lambda found: F.when(found != "", resolve_url(found, base)))


def missing_pages(pages: DataFrame, base: str, url: str = "url", html: str = "html") -> DataFrame:
    """Next-page links whose page was never landed: the crawl is incomplete."""
    wanted = pages.select(next_page(html, base).alias("next_url")).filter("next_url is not null").distinct()
    landed = pages.select(F.col(url).alias("next_url"))
    return wanted.join(landed, "next_url", "left_anti")


def person_slug(href: Column, prefix: str = PERSON_PREFIX) -> Column:
    """The part of a person link behind the prefix; null for any other link."""
    return F.when(href.startswith(prefix), F.regexp_extract(href, re.escape(prefix) + "(.*)", 1))
