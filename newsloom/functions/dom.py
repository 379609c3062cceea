"""Small helpers run inside Python workers: what a page's markup holds.

One pass over the tokens of a page, without ever failing on it. Only the open elements are
kept, never a tree. Each knows how many steps of each selector the elements around it have
met, so a start tag is judged by looking at the innermost one alone, and the innermost open
element of a name is looked up by name. Time is therefore linear in the length of the page,
but for one case: ending an inline element that a step of a selector named while others stay
open inside it costs a look at those.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterable, Iterator
from html.entities import html5

from newsloom.functions.text import WS_CHARS
from newsloom.specs import Selectors

# Possessive throughout, so no text is scanned twice. A start tag that does not match is
# one that never ends.
_KEY = r"[^\s/>][^\s/>=]*+"
_VALUE = r"""(?:"[^"]*+"|'[^']*+'|(?!["'])[^\s>]*+)"""
_ATTRIBUTES = re.compile(rf"[\s/]*+({_KEY})(?:\s*+=\s*+({_VALUE}))?+")
_TOKEN = re.compile(
    r"<(?:!--(?P<comment>.*?)(?:--!?>|\Z)"
    r"|/(?P<end>[a-zA-Z][^\s/>]*+)[^>]*+(?:>|\Z)"
    r"|(?P<start>[a-zA-Z][^\s/>]*+)"
    rf"(?P<attrs>(?:[\s/]*+{_KEY}(?:\s*+=\s*+{_VALUE})?+)*+)[\s/]*+(?P<close>>)?+"
    r"|[!?/](?P<bogus>[^>]*+)(?:>|\Z))",
    re.DOTALL,
)
_REFERENCE = re.compile(
    r"&(?:#[0-9]++;?|#[xX][0-9a-fA-F]++;?|[a-zA-Z][a-zA-Z0-9]*+(?:;|(?!=)))"
)
# elements whose content is text up to their end tag; True where references are decoded
_TEXT_ONLY = {
    "script": False, "style": False, "xmp": False, "iframe": False, "noembed": False,
    "noframes": False, "title": True, "textarea": True,
}
_TEXT_END = {
    name: re.compile(rf"</{name}(?=[\s/>])", re.IGNORECASE) for name in _TEXT_ONLY
}


def _attribute_value(raw: str) -> str:
    """An attribute's text. A name without semicolon counts only if it stands alone, so
    that query strings keep their ampersands."""

    def decode(match: re.Match) -> str:
        ref = match.group()
        return html.unescape(ref) if ref[1] == "#" else html5.get(ref[1:], ref)

    value = raw[1:-1] if raw[:1] in ("'", '"') else raw
    return _REFERENCE.sub(decode, value) if "&" in value else value


def _tokens(markup: str) -> Iterator[tuple[str, str, str | dict[str, str]]]:
    """(kind, name, content): start and end tags, text, raw text, comments."""
    at = 0
    while at < len(markup):
        found = _TOKEN.search(markup, at)
        text = markup[at : found.start()] if found else markup[at:]
        if text:
            yield "text", "", html.unescape(text)
        if not found:
            return
        at = found.end()
        if found["comment"] is not None or found["bogus"] is not None:
            yield "comment", "", found["comment"] or found["bogus"] or ""
        elif found["end"]:
            yield "end", found["end"].lower(), ""
        elif not found["close"]:
            return  # the tag never ends, and takes the rest of the page with it
        else:
            name = found["start"].lower()
            attrs: dict[str, str] = {}
            if found["attrs"]:
                for key, value in _ATTRIBUTES.findall(found["attrs"]):
                    attrs.setdefault(key.lower(), _attribute_value(value))
            yield "start", name, attrs
            if name in _TEXT_ONLY:
                end = _TEXT_END[name].search(markup, at)
                content = markup[at : end.start()] if end else markup[at:]
                if content and _TEXT_ONLY[name]:
                    yield "text", "", html.unescape(content)
                elif content:
                    yield "raw", "", content
                at = end.start() if end else len(markup)


_VOID = frozenset(
    "area base br col embed hr img input link meta param source track wbr".split()
)
_INLINE = frozenset(
    "a b big code em font i nobr s small strike strong tt u span abbr cite q sub sup".split()
)
_CLOSES_P = frozenset(
    "address article aside blockquote center details dialog dir div dl dd dt fieldset "
    "figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr li main menu nav ol p "
    "pre section summary table ul".split()
)
# a start tag ends an open element of these names, unless a container comes first
_SIBLINGS = {
    "li": (("li",), ("ul", "ol")),
    "dt": (("dt", "dd"), ("dl",)),
    "dd": (("dt", "dd"), ("dl",)),
    "option": (("option",), ("select",)),
    "tr": (("tr", "td", "th"), ("table",)),
    "td": (("td", "th"), ("tr", "table")),
    "th": (("td", "th"), ("tr", "table")),
}
_SCOPE = frozenset("table td th caption object template html".split())
_COMPOUND = re.compile(
    r"(?P<tag>[a-z][a-z0-9]*)?(?P<classes>(?:\.[\w-]+)*)"
    r"(?:\[(?P<attr>[\w-]+)=\"(?P<value>[^\"]*)\"\])?"
)


class _Compound:
    """One step of a selector: tag, classes and at most one attribute test."""

    def __init__(self, text: str) -> None:
        match = _COMPOUND.fullmatch(text)
        if match is None:
            raise ValueError(f"unsupported selector {text!r}")
        self.tag = match["tag"]
        self.classes = frozenset(filter(None, (match["classes"] or "").split(".")))
        self.attr = match["attr"]
        self.value = match["value"]

    def fits(self, tag: str, attrs: dict[str, str], classes: frozenset[str]) -> bool:
        if self.tag and tag != self.tag:
            return False
        if self.attr and attrs.get(self.attr) != self.value:
            return False
        return self.classes <= classes


_NONE: frozenset[str] = frozenset()


def _classes(attrs: dict[str, str]) -> frozenset[str]:
    return frozenset(attrs["class"].split()) if "class" in attrs else _NONE


def _path(selector: str) -> list[_Compound]:
    return [_Compound(step) for step in selector.split()]


class _Element:
    """An open element in the chain of open ones. ``steps``: of each selector with several
    steps, how many of the first ones this element and those around it have met."""

    __slots__ = (
        "attrs", "captures", "classes", "hidden", "inner", "is_open", "name", "outer", "place",
        "steps",
    )

    def __init__(
        self, name: str, attrs: dict[str, str], outer: _Element | None, place: int, hidden: bool
    ) -> None:
        self.name, self.attrs, self.classes = name, attrs, _classes(attrs)
        self.outer, self.place = outer, place
        self.hidden = hidden  # inside a template
        self.inner: _Element | None = None
        self.steps: tuple[int, ...] = ()
        self.captures: tuple[str, ...] = ()
        self.is_open = True


class _Finder:
    """Text, markup and ``content`` attribute of the first match of each selector.

    What stands inside a ``template`` belongs to no selector, but to the text and markup of
    the elements around it."""

    def __init__(self, selectors: tuple[str, ...]) -> None:
        paths = {s: _path(s) for s in selectors}
        self.deep = [path for path in paths.values() if len(path) > 1]
        # selectors without a match so far, and where the steps of each are counted
        places = {id(path): i for i, path in enumerate(self.deep)}
        self.wanted = {s: (path, places.get(id(path))) for s, path in paths.items()}
        self.start_steps = (0,) * len(self.deep)
        self.innermost: _Element | None = None
        self.named: dict[str, list[_Element]] = {}
        self.made = 0
        self.templates = 0
        self.capturing: dict[str, None] = {}
        self.markup: dict[str, list[str]] = {}
        self.text: dict[str, list[str]] = {}
        self.content: dict[str, str] = {}

    def read(self, markup: str) -> None:
        for kind, name, content in _tokens(markup):
            if kind == "start":
                self._start(name, content)
            elif kind == "end":
                self._end(name)
            elif self.capturing:
                if kind == "text":
                    self._emit(_escape(content), content)
                elif kind == "raw":
                    self._emit(content, content)
                else:
                    self._emit(f"<!--{content}-->")

    def _emit(self, markup: str, text: str = "") -> None:
        for selector in self.capturing:
            self.markup[selector].append(markup)
            if text:
                self.text[selector].append(text)

    def _last(self, names: Iterable[str]) -> _Element | None:
        """The innermost open element of these names."""
        found = None
        for name in names:
            stack = self.named.get(name)
            while stack and not stack[-1].is_open:
                stack.pop()
            if stack and (found is None or stack[-1].place > found.place):
                found = stack[-1]
        return found

    def _drop(self, element: _Element) -> None:
        """End an open element; those inside it stay open."""
        element.is_open = False
        outer, inner = element.outer, element.inner
        if outer is not None:
            outer.inner = inner
        if inner is None:
            self.innermost = outer
        else:
            inner.outer = outer
            if element.steps != (outer.steps if outer else self.start_steps):
                while inner is not None:  # the steps that it met count no more
                    inner.steps = self._steps(inner, inner.outer)
                    inner = inner.inner
        self.templates -= element.name == "template"
        for selector in element.captures:
            del self.capturing[selector]
        if self.capturing:
            self._emit(f"</{element.name}>")

    def _close_to(self, names: tuple[str, ...], barriers: frozenset | tuple) -> bool:
        """Close up to the innermost open element of these names before a barrier."""
        element = self._last(names)
        if element is None:
            return False
        barrier = self._last(barriers)
        if barrier is not None and barrier.place > element.place:
            return False
        while element.is_open:
            self._drop(self.innermost)
        return True

    def _steps(self, element: _Element, outer: _Element | None) -> tuple[int, ...]:
        before = outer.steps if outer else self.start_steps
        if not before or element.hidden:
            return before
        after = before
        for i, path in enumerate(self.deep):
            met = before[i]
            if met + 1 < len(path) and path[met].fits(element.name, element.attrs, element.classes):
                after = (*after[:i], met + 1, *after[i + 1 :])
        return after

    def _start(self, tag: str, found: dict[str, str]) -> None:
        if tag in _CLOSES_P and "p" in self.named:
            self._close_to(("p",), _SCOPE)
        if tag in _SIBLINGS:
            names, containers = _SIBLINGS[tag]
            self._close_to(names, containers)
        if self.capturing:
            shown = "".join(f' {k}="{_escape(v, quote=True)}"' for k, v in found.items())
            self._emit(f"<{tag}{shown}>")
        outer = self.innermost
        self.made += 1
        element = _Element(tag, found, outer, self.made, self.templates > 0)
        if not self.templates:
            around = outer.steps if outer else self.start_steps
            met = [
                selector
                for selector, (path, place) in self.wanted.items()
                if (place is None or around[place] + 1 >= len(path))
                and path[-1].fits(tag, found, element.classes)
            ]
            for selector in met:  # the first match only
                del self.wanted[selector]
                self.markup[selector], self.text[selector] = [], []
                self.content[selector] = found.get("content", "")
                if tag not in _VOID:
                    self.capturing[selector] = None
                    element.captures += (selector,)
        if tag not in _VOID:
            element.steps = self._steps(element, outer)
            if outer is not None:
                outer.inner = element
            self.innermost = element
            self.named.setdefault(tag, []).append(element)
            self.templates += tag == "template"

    def _end(self, tag: str) -> None:
        if tag == "br":
            self._emit("<br>")
        elif tag in _INLINE:
            element = self._last((tag,))
            if element is not None:
                self._drop(element)
        elif tag not in _VOID and not self._close_to((tag,), _SCOPE - {tag}) and tag == "p":
            self._emit("<p></p>")


def _escape(text: str, quote: bool = False) -> str:
    out = text.replace("&", "&amp;").replace(chr(0xA0), "&nbsp;")
    if quote:
        return out.replace('"', "&quot;")
    return out.replace("<", "&lt;").replace(">", "&gt;")


def page_hrefs(markup: str) -> list[str]:
    """The ``href`` of every link of a page, in order; not of those inside a ``template``."""
    found, templates = [], 0
    for kind, name, content in _tokens(markup):
        if name == "template":
            templates = max(0, templates + (1 if kind == "start" else -1))
        elif kind == "start" and name == "a" and not templates and "href" in content:
            found.append(content["href"])
    return found


def page_article(markup: str, selectors: Selectors) -> tuple[str, str]:
    """Raw title and inner markup of the body: the first selector that gives any."""
    finder = _Finder(selectors.titles + selectors.bodies)
    finder.read(markup)
    title = ""
    for selector in selectors.titles:
        attribute = "[" in selector
        found = (
            finder.content.get(selector, "")
            if attribute
            else "".join(finder.text.get(selector, ()))
        )
        if found.strip(WS_CHARS):
            title = found
            break
    body = next(("".join(finder.markup[s]) for s in selectors.bodies if finder.markup.get(s)), "")
    return title, body
