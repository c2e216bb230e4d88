"""Raw web pages as trees of elements, tolerant of missing and stray tags."""

from __future__ import annotations

import html
import re
from dataclasses import dataclass, field

# Names and nesting rules of HTML elements.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style title textarea iframe noembed noframes xmp svg".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small span "
    "strike strong sub sup time tt u var".split()
)
BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure "
    "footer form h1 h2 h3 h4 h5 h6 head header hgroup html legend li main menu nav ol optgroup option p pre search "
    "section select summary table tbody td tfoot th thead tr ul".split()
)
CLOSES_P = BLOCK - frozenset("body caption dd dt head html legend li optgroup option tbody td tfoot th thead tr".split()) | {"hr"}
# What a start tag ends, and the elements beyond which it does not look.
ENDED_BY = {
    "li": ({"li"}, {"ul", "ol", "menu", "dir"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "option": ({"option"}, {"select"}),
    "optgroup": ({"option", "optgroup"}, {"select"}),
    "tr": ({"tr", "td", "th"}, {"table"}),
    "td": ({"td", "th"}, {"table", "tr"}),
    "th": ({"td", "th"}, {"table", "tr"}),
    "tbody": ({"thead", "tbody", "tfoot", "tr", "td", "th"}, {"table"}),
    "tfoot": ({"thead", "tbody", "tfoot", "tr", "td", "th"}, {"table"}),
    "body": ({"head"}, {"html"}),
}
# Elements nested deeper are not told apart from those they are in, as in browsers.
DEEPEST = 512

# What is inside a tag behind its name: quotes count only as values.
_INSIDE = r"(?:[^>\"'=]++|=\s*+(?:\"[^\"]*+\"|'[^']*+'|)|[\"'])*+"
_TOKENS = re.compile(
    r"<!--(?:.*?-->|.*)"
    r"|<[!?][^>]*+>?"
    rf"|<({'|'.join(sorted(RAW))})(?=[\s/>])({_INSIDE})>?(.*?)(?=</\1[\s/>]|</\1\Z|\Z)"
    rf"|<(/?)([a-z][^\s/>]*+)({_INSIDE})>?"
    r"|([^<]++|<)",
    re.DOTALL | re.IGNORECASE,
)
_ATTRIBUTE = re.compile(r"([^\s\"'<>/=]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'<>`]+)))?")
_DIGITS = re.compile(r"\d{2,}")


@dataclass(slots=True)
class Element:
    """An element by its presentation: name, class words, id and role; numbers of two digits or more in them are 0."""

    name: str
    parent: int
    classes: str = ""
    role: str = ""
    children: list[int] = field(default_factory=list)
    text: list[str] = field(default_factory=list)
    references: list[str] = field(default_factory=list)

    @property
    def look(self) -> str:
        return f"{self.name} {self.classes} {self.role}"


@dataclass
class Page:
    """Elements, parents first, and what follows what: a text, the number of an element that begins, ~number of one that ends, or None for a rule.

    Formatting without class, id or role is no element of its own; its text belongs to the element around it.
    """

    elements: list[Element]
    events: list[str | int | None]


def attributes(text: str) -> dict[str, str]:
    """Attributes by lower-case name, the first of equal names."""
    out: dict[str, str] = {}
    for name, double, single, bare in _ATTRIBUTE.findall(text):
        out.setdefault(name.lower(), html.unescape(double or single or bare))
    return out


def parse(source: str) -> Page:
    """The tree of a page; its first element is the page itself."""
    elements = [Element("", -1)]
    events: list[str | int | None] = [0]
    # Open elements: name, number (-1 for formatting inside marked formatting), and the number of the element around.
    names, numbers, owners = [""], [0], [0]
    current = elements[0]
    marked = 0

    def close(depth: int) -> None:
        """Close the elements from this depth on."""
        nonlocal current, marked
        while len(names) > depth:
            name, number = names.pop(), numbers.pop()
            owners.pop()
            if number >= 0:
                events.append(~number)
                marked -= name in INLINE
        current = elements[owners[-1]]

    def depth_of(wanted: set[str], borders: set[str]) -> int:
        """The outermost open element of these names on this side of the borders, or 0."""
        found = 0
        for depth in range(len(names) - 1, 0, -1):
            if names[depth] in borders:
                break
            if names[depth] in wanted:
                found = depth
        return found

    def end(name: str) -> None:
        if name in INLINE:
            depth = len(names) - 1
            while depth and names[depth] != name and names[depth] in INLINE:
                depth -= 1
            if depth and names[depth] == name:
                close(depth)
        elif name == names[-1]:
            close(len(names) - 1)
        elif name in names:
            close(len(names) - 1 - names[::-1].index(name))

    for raw, raw_inside, raw_text, ends, name, inside, text in _TOKENS.findall(source):
        if text:
            text = html.unescape(text) if "&" in text else text
            events.append(text)
            current.text.append(text)
            continue
        name = (name or raw).lower()
        if not name:
            continue
        if ends:
            end(name)
            continue
        if name in CLOSES_P and "p" in names:
            depth = len(names) - 1 - names[::-1].index("p")
            if BLOCK.isdisjoint(names[depth + 1 :]):
                close(depth)
        if name in ENDED_BY:
            depth = depth_of(*ENDED_BY[name])
            if depth:
                close(depth)
        inside = inside or raw_inside
        classes = role = ""
        if "=" in inside:
            given = attributes(inside)
            current.references += [given[r] for r in ("href", "src") if given.get(r)]
            classes = " ".join(sorted(given.get("class", "").split())) + (f"#{given['id']}" if given.get("id") else "")
            role = given.get("role", "").strip().lower()
        if name in VOID:
            if name in ("br", "hr"):
                events.append(" " if name == "br" else None)
                current.text.append(" ")
            continue
        formatting = name in INLINE and not classes and not role
        if len(names) < DEEPEST and not (formatting and not marked):
            number = -1
            if not formatting:
                number = len(elements)
                current.children.append(number)
                current = Element(name, owners[-1], _DIGITS.sub("0", classes) if classes else "", role)
                elements.append(current)
                events.append(number)
                marked += name in INLINE
            names.append(name)
            numbers.append(number)
            owners.append(number if number >= 0 else owners[-1])
        if raw_text and name in ("title", "textarea"):
            events.append(raw_text)
            current.text.append(raw_text)
    close(1)
    events.append(~0)
    return Page(elements, events)
