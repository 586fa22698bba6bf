"""Name-literal pairs of source and configuration text: a tokenizer with states, and constants with scopes.

``pairs(text)`` gives (name, start, end, value) for every literal that a name receives: ``start`` and ``end`` are its span
in the text without quotes, ``value`` is what it means, with escapes resolved, parts joined and constants put in.

What is read, whatever the language:

* ``name = v``, ``name: v``, ``name := v``, ``name => v``, ``"name": v``, ``cfg["name"] = v``, ``let name: type = v``;
* ``--name v`` and ``#define name "v"``;
* values in ``"``, ``'`` and backticks with escapes, after string prefixes, in triple quotes, or bare; a quoted one may stand on the next
  line; quoted parts and constants joined by ``+`` or ``.``, or side by side, are one literal;
* XML: attributes, ``key="name" value="v"`` and ``<name>v</name>``;
* YAML: the line below ``name: |`` or ``name: >-``;
* ``name``, ``$name``, ``${name}`` and the ``{name}`` of an f-string stand for the literal that an earlier pair gave that name,
  also over several steps. A name is known until the brace closes in which it was given.

A bare value is read again from its start (``args: --pwd=b``, ``env: NAME=b``), and before ``&name=`` it has a
first part of its own, so both come out. A literal longer than ``LONGEST`` gives no pair. Time is linear in the
text: no position is scanned for the same kind of token more than a fixed number of times.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

LONGEST = 4096

_NAME = r"[A-Za-z_][A-Za-z0-9_.-]*+"
TOKEN = re.compile(rf"""
    (?P<newline>\n) | (?P<space>[\x20\t\r]++)
  | (?P<comment><!--)
  | (?P<tag></?[A-Za-z][\w:.-]*+)
  | (?P<close>/?>)
  | (?P<flag>(?<![\w-])--{_NAME})
  | (?P<quoted>(["'`]){_NAME}\8)
  | (?P<name>{_NAME})
  | (?P<give>:=|=>|=(?![=>])|:(?!:))
  | (?P<brace>[{{}}])
  | (?P<other>[0-9][0-9.-]*+|==+|.)
""", re.X | re.A | re.S)
STRING = re.compile(r"""([fFrRbBuU]{0,2})(?:\"((?:[^"\\\n]|\\.)*+)\"|'((?:[^'\\\n]|\\.)*+)'|`((?:[^`\\\n]|\\.)*+)`)""", re.S)
TRIPLE = re.compile(r"""[fFrRbBuU]{0,2}(\"\"\"|''')""")
BARE = re.compile(r"[A-Za-z0-9+/_.=$@!#%^&*~{}-]+", re.A)
NEXT_FIELD = re.compile(rf"&(?={_NAME}=)", re.A)
REFERENCE = re.compile(r"\$?\{?([A-Za-z_][A-Za-z0-9_.]*)\}?", re.A)
FILLED = re.compile(r"\{([A-Za-z_][A-Za-z0-9_.]*)\}", re.A)
TYPE = re.compile(rf"{_NAME}(?:<[^<>\n]{{0,80}}>|\[[^\[\]\n]{{0,80}}\])?[\x20\t]*=(?![=>])[\x20\t]*", re.A)
SPACES, SPACES_OVER_LINES = re.compile(r"[\x20\t]*+"), re.compile(r"[\x20\t]*+(?:\r?\n[\x20\t]*+)?")
JOINT = re.compile(r"[\x20\t]*+(?:\\?\r?\n[\x20\t]*+)?[+.]?[\x20\t]*+(?:\r?\n[\x20\t]*+)?")
BLOCK = re.compile(r"[|>][+-]?[0-9]?[\x20\t]*+\r?\n([\x20\t]++)([^\n]*+)")
ELEMENT = re.compile(r"\s*+([^<\s]++)\s*+(?=</)")
ESCAPE = re.compile(r"\\(.)", re.S)
NAMING, NAMED = {"key", "name", "id"}, {"value", "content", "val"}


class _Scopes:
    """Literals by name; what a brace's inside gave goes when it closes."""

    def __init__(self):
        self.known: dict[str, list] = {}
        self.given: list[list[str]] = [[]]

    def open(self) -> None:
        self.given.append([])

    def close(self) -> None:
        if len(self.given) > 1:
            for name in self.given.pop():
                self.known[name].pop()

    def give(self, name: str, literal) -> None:
        held = self.known.setdefault(name, [])
        if held and held[-1][0] == len(self.given):
            held[-1] = len(self.given), literal
        else:
            held.append((len(self.given), literal))
            self.given[-1].append(name)

    def get(self, name: str):
        held = self.known.get(name)
        return held[-1][1] if held else None


class _Reader:
    def __init__(self, text: str):
        self.text, self.scopes = text, _Scopes()
        self.bare_end, self.fields, self.no_triple = 0, [], len(text)

    def pairs(self) -> Iterator[tuple[str, int, int, str]]:
        text, at, name, before, attributes, element = self.text, 0, None, "", None, None
        defined = False
        while at < len(text):
            m = TOKEN.match(text, at)
            kind, at = m.lastgroup, m.end()
            if kind == "name":
                defined, before = before == "define", m[0]
                name = m[0]
            elif kind == "quoted":
                if defined and name:
                    found = self._string(m.start())
                    yield from self._named(name, [found])
                    at, name, defined = found[3], None, False
                else:
                    name = m[0][1:-1]
            elif kind == "give":
                if name is not None:
                    literals, at = self._value(at, m[0])
                    if attributes is not None and literals:
                        attributes.setdefault(name.lower(), literals[0])
                    yield from self._named(name, literals)
                name, defined = None, False
            elif kind == "flag":
                name = m[0].lstrip("-")
                start = SPACES.match(text, at).end()
                if start > at and text[start : start + 1] not in ("", "-", "=", ":", "\n"):
                    literals, _ = self._value(start, "flag")
                    yield from self._named(name, literals)
            elif kind == "tag":
                opens = m[0][1] != "/"
                attributes, element, name = ({}, m[0][1:], None) if opens else (None, None, None)
            elif kind == "close" and attributes is not None:
                named = next((attributes[a] for a in sorted(NAMING) if a in attributes), None)
                value = next((attributes[a] for a in sorted(NAMED) if a in attributes), None)
                if named and value:
                    yield from self._named(named[2], [value])
                if m[0] == ">" and (inner := ELEMENT.match(text, at)):
                    yield from self._named(element, [(*inner.span(1), inner[1], inner.end())])
                attributes, element, name = None, None, None
            elif kind == "brace":
                (self.scopes.open if m[0] == "{" else self.scopes.close)()
                name = None
            elif kind == "newline":
                name, before, defined = None, "", False
            elif kind == "other" and m[0] in "\"'`" and defined and name:
                if found := self._string(m.start()):
                    yield from self._named(name, [found])
                    at, name, defined = found[3], None, False
            elif kind == "other" and m[0] in ",;(":
                name = None

    def _named(self, name: str, literals) -> Iterator[tuple[str, int, int, str]]:
        """Pairs of one name; the first literal is what the name stands for from here on."""
        for i, (start, end, value, _) in enumerate(literals):
            if i == 0:
                self.scopes.give(name, (start, end, value))
            if end - start <= LONGEST:
                yield name, start, end, value

    def _value(self, at: int, operator: str):
        """Literals (start, end, value, behind) at this place, and where to read on."""
        text = self.text
        start = SPACES.match(text, at).end()
        if operator == ":" and (m := BLOCK.match(text, start)):
            a = m.start(2)
            b = a + len(m[2].rstrip())
            return ([(a, b, text[a:b], m.end())] if b > a else []), m.start(1)
        first = self._string(start)
        if first is None and (over := SPACES_OVER_LINES.match(text, at).end()) > start:
            first = self._string(over)
        if first is not None:
            return self._joined(first)
        if start >= self.bare_end:
            if (bare := BARE.match(text, start)) is None:
                return [], start
            self.bare_end = bare.end()
            self.fields = [f.start() for f in NEXT_FIELD.finditer(text, start, self.bare_end)][::-1]
        typed = TYPE.match(text, start) if operator == ":" else None
        if typed and (inner := self._string(typed.end())):
            # read on at the type, which may be a name of its own: label: NAME="v"
            return self._joined(inner)[0], start
        return self._bare(start), start

    def _bare(self, start: int):
        """The bare value here up to the next field, if any, and up to its end."""
        text = self.text
        while self.fields and self.fields[-1] < start:
            self.fields.pop()
        found = []
        for end in [*self.fields[-1:], self.bare_end]:
            known = REFERENCE.fullmatch(text, start, end) if end - start <= LONGEST else None
            literal = self.scopes.get(known[1]) if known else None
            found.append((*literal, end) if literal else (start, end, text[start:end] if end - start <= LONGEST else "", end))
            if literal:
                break
        return found

    def _string(self, at: int):
        """A quoted literal at this place: start and end inside its quotes, value, and the place behind it."""
        text = self.text
        if (m := TRIPLE.match(text, at)) and at < self.no_triple:
            end = text.find(m[1], m.end())
            if end >= 0:
                inner = text[m.end() : end]
                a = m.end() + len(inner) - len(inner.lstrip())
                return self._meant(a, max(a, m.end() + len(inner.rstrip())), m[0][: -3], end + 3)
            self.no_triple = at
        if m := STRING.match(text, at):
            group = next(g for g in (2, 3, 4) if m[g] is not None)
            return self._meant(*m.span(group), m[1], m.end())
        return None

    def _meant(self, start: int, end: int, prefix: str, behind: int):
        if end - start > LONGEST:
            return start, end, "", behind
        value = self.text[start:end]
        if "r" not in prefix.lower():
            value = ESCAPE.sub(r"\1", value)
        known = REFERENCE.fullmatch(value) if value[:1] == "$" else FILLED.fullmatch(value) if "f" in prefix.lower() else None
        if known and (literal := self.scopes.get(known[1])):
            return *literal, behind
        if "f" in prefix.lower():
            value = FILLED.sub(lambda m: (self.scopes.get(m[1]) or (0, 0, m[0]))[2], value)
        return start, end, value[:LONGEST], behind

    def _joined(self, first):
        """The literal with all parts that follow it, joined by + or . or side by side."""
        start, end, value, behind = first
        while True:
            m = JOINT.match(self.text, behind)
            part = self._string(m.end())
            if part is None and ("+" in m[0] or "." in m[0]) and (name := REFERENCE.match(self.text, m.end())):
                literal = self.scopes.get(name[1])
                part = (m.end(), name.end(), literal[2], name.end()) if literal else None
            elif part is not None and "\n" in m[0] and "+" not in m[0] and "\\" not in m[0]:
                part = None  # the next line's own literal
            if part is None:
                return [(start, end, value, behind)], behind
            if end - start <= LONGEST:
                value = value + part[2]
            start, end, behind = start, part[3] - (self.text[part[3] - 1] in "\"'`"), part[3]


def pairs(text: str) -> Iterator[tuple[str, int, int, str]]:
    return _Reader(text).pairs()
