"""Text blocks of an HTML page, in page order, with the path of elements around each.

A block is the text between two block-level tags; inline tags do not end it and a line break is white space in it. Nothing
in ``head``, ``script``, ``style`` and the like is text; a head without end tag ends where something begins that cannot stand in it. Tags that are never closed are closed as browsers do for
paragraphs, list items and cells; comments and stray end tags are skipped.

Every page is read in time linear in its length, hostile markup included: what a later tag would look for again (the end of
a quotation, an open element, the paragraph it closes) is remembered, never searched twice.
"""

import html
import re
from collections import Counter

_TAG = re.compile(r"(/?)([a-zA-Z][^\s>/]*)")
_SPECIAL = re.compile("[\"'>]")
#: Elements whose content is no text.
_RAW = {name: re.compile(rf"</{name}\s*>", re.I) for name in "script style noscript template iframe svg textarea select title".split()}
_ATTRIBUTE = re.compile(r"\b(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
_NAME = re.compile(r"[a-z]+|[0-9]+")
INLINE = frozenset("a abbr b bdi bdo big cite code del dfn em font i img ins kbd label mark q s samp small span strike strong sub sup time tt u var wbr".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: A head without end tag lasts until another start tag.
_IN_HEAD = frozenset("base basefont bgsound head html link meta noframes noscript script style template title".split())
#: A start tag closes an open element of these names, up to the named boundary.
CLOSES = {
    "li": (("li",), ("ul", "ol", "menu")), "dt": (("dt", "dd"), ("dl",)), "dd": (("dt", "dd"), ("dl",)), "tr": (("tr",), ("table",)),
    "td": (("td", "th"), ("tr", "table")), "th": (("td", "th"), ("tr", "table")), "option": (("option",), ("select",))}
_CLOSES_P = frozenset("address article aside blockquote details div dl fieldset figure footer form h1 h2 h3 h4 h5 h6 header hr main menu nav ol p pre section table ul".split())


def names_of(attributes):
    """Lower-cased words of class, id and role."""
    out = []
    for _, a, b, c in _ATTRIBUTE.findall(attributes):
        out += _NAME.findall((a or b or c).lower())
    return tuple(out)


#: What a start tag of the group shuts: the nearest open element of the first names that no element of the second stands before.
_GROUPS = [(("p",), ("article", "aside", "body", "div", "section", "td", "li", "blockquote", "main")), (("li",), ("ul", "ol", "menu")),
           (("dt", "dd"), ("dl",)), (("tr",), ("table",)), (("td", "th"), ("tr", "table")), (("option",), ("select",))]
_GROUP_OF = {**{tag: 0 for tag in _CLOSES_P}, **{tag: next(g for g, (shut, _) in enumerate(_GROUPS) if g and tag in shut) for tag in CLOSES}}
#: Tag -> groups for which it is a bound (False) or an element to shut (True).
_EFFECTS = {tag: [(g, tag not in bound) for g, (shut, bound) in enumerate(_GROUPS) if tag in bound or tag in shut] for tag in {t for pair in _GROUPS for names in pair for t in names}}


class Paths:
    """Numbers for element paths; a path is its parent's number, a tag and its names. Parents have smaller numbers.

    ``fresh`` holds the words (tag, names) that a path adds to those of the elements around it.
    """

    def __init__(self):
        self.number = {}
        self.parts = [(-1, "", ())]
        self.fresh = [()]

    def child(self, parent, tag, names, words=(), around=None):
        key = (parent, tag, names)
        found = self.number.get(key)
        if found is None:
            found = self.number[key] = len(self.parts)
            self.parts.append(key)
            self.fresh.append(tuple(dict.fromkeys(w for w in words if not around or not around[w])))
        return found

    def chain(self, path):
        while path > 0:
            parent, tag, names = self.parts[path]
            yield tag, names
            path = parent


class _Open:
    """The open elements: (tag, path, inside a link, place of the head or -1, path of the nearest block, what tags would shut, words)."""

    def __init__(self, paths):
        self.paths, self.stack = paths, []
        self.tags, self.words = Counter(), Counter()
        self.top = ("", 0, False, -1, 0, (-1,) * len(_GROUPS), ())

    def push(self, tag, names):
        _, above, link, head, block, shuts, _ = self.top
        at = len(self.stack)
        words = (f"in:{tag}", *(f"named:{n}" for n in names))
        path = self.paths.child(above, tag, names, words, self.words)
        if tag in _EFFECTS:
            shuts = list(shuts)
            for group, shut in _EFFECTS[tag]:
                shuts[group] = at if shut else -1
            shuts = tuple(shuts)
        self.top = (tag, path, link or tag == "a", at if tag == "head" and head < 0 else head, block if tag in INLINE else path, shuts, words)
        self.stack.append(self.top)
        self.tags[tag] += 1
        self.words.update(words)

    def close(self, index):
        while len(self.stack) > index:
            gone = self.stack.pop()
            self.tags[gone[0]] -= 1
            self.words.subtract(gone[6])
        self.top = self.stack[-1] if self.stack else ("", 0, False, -1, 0, (-1,) * len(_GROUPS), ())

    def end(self, tag):
        if self.tags[tag] > 0:
            index = len(self.stack) - 1
            while self.stack[index][0] != tag:
                index -= 1
            self.close(index)


def _tag_ends(page):
    """The place of the ``>`` that ends a tag, quotations skipped, from a place inside it; -1 if a quotation has no end."""
    known = {}

    def end(at):
        passed, found = [], _SPECIAL.search(page, at)
        while found is not None:
            at = found.start()
            if page[at] == ">" or at in known:
                break
            passed.append(at)
            shut = page.find(page[at], at + 1)
            found = _SPECIAL.search(page, shut + 1) if shut >= 0 else None
        result = -1 if found is None else known.get(at, at)
        for at in passed:
            known[at] = result
        return result

    return end


def _tokens(page):
    """``(start, end, kind, tag, attributes)`` of comments, raw elements and tags; kind is ``raw``, ``empty``, ``begin``, ``end`` or None."""
    tag_end, last = _tag_ends(page), page.rfind(">")
    at = page.find("<")
    while at >= 0:
        if page.startswith("<!--", at):
            stop = page.find("-->", at + 4)
            stop = len(page) if stop < 0 else stop + 3
            yield at, stop, None, None, ""
        elif at > last:  # no tag ends any more, but a comment may begin
            at = page.find("<!--", at + 1)
            continue
        elif page[at + 1:at + 2] in ("!", "?"):
            stop = page.find(">", at) + 1
            yield at, stop, None, None, ""
        else:
            found = _TAG.match(page, at + 1)
            if found is None:
                at = page.find("<", at + 1)
                continue
            tag, begins, inner = found[2].lower(), not found[1], found.end()
            stop = tag_end(inner)
            if begins and tag in _RAW and not (tag == "svg" and stop > inner and page[stop - 1] == "/"):
                shut = _RAW[tag].search(page, page.find(">", inner) + 1)
                stop = shut.end() if shut else len(page)
                yield at, stop, "raw", tag, ""
            else:
                stop = page.find(">", inner) if stop < 0 else stop
                kind = ("empty" if tag == "svg" else "begin") if begins else "end"
                yield at, stop + 1, kind, tag, page[inner:stop]
                stop += 1
        at = page.find("<", stop)


def blocks(page: str, paths: Paths):
    """``(path, text, characters inside links)`` of every block with text."""
    out, opened = [], _Open(paths)
    buffer, linked, place, last = [], 0, None, 0

    def flush():
        nonlocal buffer, linked, place
        text = " ".join("".join(buffer).split())
        if text:
            out.append((place, text, min(linked, len(text))))
        buffer, linked, place = [], 0, None

    def add(raw):
        nonlocal linked, place
        if not raw or opened.top[3] >= 0:
            return
        text = html.unescape(raw) if "&" in raw else raw
        if place is None and text.strip():
            place = opened.top[4]
        buffer.append(text)
        if opened.top[2]:
            linked += len(text)

    for start, stop, kind, tag, attributes in _tokens(page):
        add(page[last:start])
        last = stop
        if kind in ("raw", "empty", "begin") and opened.top[3] >= 0 and tag not in _IN_HEAD:
            opened.close(opened.top[3])
        if kind is None or kind == "empty":
            continue
        if kind == "raw":
            flush()
            continue
        if tag == "br":
            buffer.append(" ")
            continue
        if tag not in INLINE:
            flush()
        if kind == "end":
            opened.end(tag)
            continue
        if tag in VOID:
            continue
        if attributes.endswith("/") and tag not in INLINE and tag not in _CLOSES_P:
            continue
        if tag in _GROUP_OF:
            shut = opened.top[5][_GROUP_OF[tag]]
            if shut >= 0:
                opened.close(shut)
        opened.push(tag, names_of(attributes) if attributes else ())
    add(page[last:])
    flush()
    return out
