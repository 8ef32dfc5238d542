"""Small helper: elements of a page by simple selectors (``tag``, ``#id``, ``.class``, ``[attr=value]``, ``a > b``, ``a b``)."""

from __future__ import annotations

import re
from html.parser import HTMLParser

# Elements without an end tag, and elements whose text is not shown.
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"}
HIDDEN = {"script", "style"}

_PART = re.compile(r"([a-z0-9*]+)?((?:[#.][\w-]+|\[[^\]]+\])*)", re.I)


def _simple(text: str):
    tag, rest = _PART.fullmatch(text).groups()
    tests = []
    for t in re.findall(r"[#.][\w-]+|\[[^\]]+\]", rest or ""):
        if t[0] == "#":
            tests.append(("id", t[1:]))
        elif t[0] == ".":
            tests.append((".", t[1:]))
        else:
            name, _, value = t[1:-1].partition("=")
            tests.append((name, value.strip("'\"") if value else None))
    return (tag or "*").lower(), tests


def _compile(selector: str):
    """Parts with a flag whether each must be the direct parent of the next."""
    parts, direct = [], False
    for word in selector.replace(">", " > ").split():
        if word == ">":
            direct = True
        else:
            parts.append((_simple(word), direct))
            direct = False
    return parts


def _fits(node, simple) -> bool:
    tag, attrs = node
    want, tests = simple
    if want not in ("*", tag):
        return False
    for name, value in tests:
        if name == ".":
            if value not in (attrs.get("class") or "").split():
                return False
        elif name not in attrs or (value is not None and attrs[name] != value):
            return False
    return True


def _matches(path, parts) -> bool:
    if not _fits(path[-1], parts[-1][0]):
        return False
    i = len(path) - 2
    for j in range(len(parts) - 1, 0, -1):
        if parts[j][1]:
            if i < 0 or not _fits(path[i], parts[j - 1][0]):
                return False
        else:
            while i >= 0 and not _fits(path[i], parts[j - 1][0]):
                i -= 1
            if i < 0:
                return False
        i -= 1
    return True


class Page(HTMLParser):
    """One pass over a page: ``found[selector]`` lists ``(attributes, text)`` in page order."""

    def __init__(self, html: str, selectors: list[str]):
        super().__init__(convert_charrefs=True)
        self.rules = {s: _compile(s) for s in dict.fromkeys(selectors) if s}
        self.path: list[tuple[str, dict]] = []
        self.open: list[tuple[int, list]] = []
        self.found: dict[str, list] = {s: [] for s in self.rules}
        self.feed(html or "")
        self.close()
        for hits in self.found.values():
            for h in hits:
                h[1] = " ".join("".join(h[1]).split())

    def handle_starttag(self, tag, attrs):
        self.path.append((tag, {k: v or "" for k, v in attrs}))
        for s, parts in self.rules.items():
            if _matches(self.path, parts):
                hit = [self.path[-1][1], []]
                self.found[s].append(hit)
                self.open.append((len(self.path), hit[1]))
        if tag in VOID:
            for _, text in self.open:
                text.append(" ")
            self._leave(len(self.path) - 1)

    def handle_endtag(self, tag):
        for i in range(len(self.path) - 1, -1, -1):
            if self.path[i][0] == tag:
                self._leave(i)
                for _, text in self.open:
                    text.append(" " if tag not in ("a", "b", "i", "em", "span", "strong") else "")
                return

    def handle_data(self, data):
        if not self.path or self.path[-1][0] not in HIDDEN:
            for _, text in self.open:
                text.append(data)

    def _leave(self, depth: int) -> None:
        del self.path[depth:]
        self.open = [o for o in self.open if o[0] <= depth]

    def first(self, selector: str | None):
        hits = self.found.get(selector or "", [])
        return hits[0] if hits else None

    def all_texts(self, selector: str) -> list[str]:
        return [h[1] for h in self.found.get(selector, [])]

    def content(self, selector: str | None) -> str:
        hit = self.first(selector)
        return (hit[0].get("content") or "").strip() if hit else ""

    def text(self, selector: str | None) -> str:
        hit = self.first(selector)
        return hit[1] if hit else ""
