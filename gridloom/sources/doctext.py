"""The text form of documents: JSON with comments, bare keys and strings, optional commas and braces; and its numbers and quotes."""

from __future__ import annotations

import json
import re
from decimal import Decimal

from gridloom.operators.nested import deep_json

_BLANK = re.compile(r"(?:\s+|#[^\n]*|//[^\n]*|/\*.*?\*/)*", re.DOTALL)
_NUMBER = re.compile(r"-?(?:0|[1-9][0-9]*)(?:\.[0-9]+)?(?:[eE][+-]?[0-9]+)?")
_BARE_KEY = re.compile(r"[^\s{}\[\],:\"']+")
_REST = re.compile(r"[^\n]*")
_WORDS = {"true": True, "false": False, "null": None}
#: What may follow a number or word for it to be one: the end of the value.
_ENDED = re.compile(r"[ \t\r]*(?:$|[\n,}\]]|#|//|/\*)")


class SyntaxProblem(ValueError):
    """A text that cannot be read; line counts from 1."""

    def __init__(self, what: str, text: str, at: int):
        self.line, self.at = text.count("\n", 0, at) + 1, at
        super().__init__(f"{what} in line {self.line}")


class _Reader:
    """Reads with a stack of open holders of its own, so that depth does not matter."""

    def __init__(self, text: str):
        self.text, self.at = text, 0

    def blank(self) -> str:
        self.at = _BLANK.match(self.text, self.at).end()
        return self.text[self.at : self.at + 1]

    def fail(self, what: str) -> SyntaxProblem:
        return SyntaxProblem(what, self.text, self.at)

    def quoted(self) -> str:
        t, q = self.text, self.text[self.at]
        if t.startswith("'''", self.at):
            end = t.find("'''", self.at + 3)
            if end < 0:
                raise self.fail("text block without end")
            column = self.at - (t.rfind("\n", 0, self.at) + 1)
            lines = t[self.at + 3 : end].split("\n")
            self.at = end + 3
            cut = [lines[0], *(s[min(column, len(s) - len(s.lstrip())) :] for s in lines[1:])]
            return "\n".join(cut[1:] if not cut[0].strip() else cut).removesuffix("\n")
        if q == '"':
            try:
                value, self.at = json.decoder.scanstring(t, self.at + 1, False)
            except ValueError:
                raise self.fail("string without end") from None
            return value
        end = self.at + 1
        while (end := t.find("'", end)) >= 0 and t[end - 1] == "\\":
            end += 1
        if end < 0:
            raise self.fail("string without end")
        value = t[self.at + 1 : end].replace("\\'", "'")
        self.at = end + 1
        return value

    def key(self) -> str:
        c = self.blank()
        if c and c in "\"'":
            name = self.quoted()
        elif m := _BARE_KEY.match(self.text, self.at):
            name, self.at = m.group(), m.end()
        else:
            raise self.fail("key expected")
        if self.blank() != ":":
            raise self.fail("`:` expected")
        self.at += 1
        return name

    def scalar(self, c: str) -> object:
        if not c or c in ",:}]":
            raise self.fail("value expected")
        if c in "\"'":
            return self.quoted()
        m = _NUMBER.match(self.text, self.at)
        if m and _ENDED.match(self.text, m.end()):
            self.at = m.end()
            return float(m.group()) if any(x in m.group() for x in ".eE") or len(m.group()) > 18 else int(m.group())
        for word, value in _WORDS.items():
            if self.text.startswith(word, self.at) and _ENDED.match(self.text, self.at + len(word)):
                self.at += len(word)
                return value
        m = _REST.match(self.text, self.at)
        self.at = m.end()
        return m.group().strip()

    def read(self) -> object:
        c = self.blank()
        bare = c != "{" and c != "["
        root: dict | list = [] if c == "[" else {}
        if not bare:
            self.at += 1
        open_: list[dict | list] = [root]
        while open_:
            top, c = open_[-1], self.blank()
            if not c:
                if bare and len(open_) == 1:
                    return root
                raise self.fail("text ends too early")
            if c == ",":
                self.at += 1
                continue
            if c == ("]" if isinstance(top, list) else "}") and not (bare and len(open_) == 1):
                self.at += 1
                open_.pop()
                continue
            name = None if isinstance(top, list) else self.key()
            c = self.blank()
            if c and c in "{[":
                self.at += 1
                value: object = [] if c == "[" else {}
                open_.append(value)
            else:
                value = self.scalar(c)
            if isinstance(top, list):
                top.append(value)
            else:
                top[name] = value
        if self.blank():
            raise self.fail("text after the end")
        return root


def read(text: str) -> object:
    """The value of a document; plain JSON is read as such. Raises ValueError, with the line where the text form is wrong."""
    try:
        return json.loads(text)
    except RecursionError:
        return deep_json(text)
    except ValueError:
        return _Reader(text).read()


def number(x: float) -> str:
    """The shortest decimal that reads back as x, with an exponent below 1e-4 and from 1e6 on, of the form 1.5e+06."""
    if x != x or x in (float("inf"), float("-inf")):
        return "NaN" if x != x else "+Inf" if x > 0 else "-Inf"
    if x == 0:
        return "-0" if str(x).startswith("-") else "0"
    sign, digits, exponent = Decimal(repr(float(x))).as_tuple()
    d = "".join(map(str, digits)).lstrip("0")
    e = len(d) + exponent - 1
    d = d.rstrip("0")
    if e < -4 or e >= 6:
        out = f"{d[0]}{'.' + d[1:] if d[1:] else ''}e{'-' if e < 0 else '+'}{abs(e):02}"
    elif e < 0:
        out = "0." + "0" * (-e - 1) + d
    elif len(d) <= e + 1:
        out = d + "0" * (e + 1 - len(d))
    else:
        out = f"{d[: e + 1]}.{d[e + 1 :]}"
    return ("-" if sign else "") + out


def value_text(x: object) -> str | None:
    """A scalar as the text of a fact; null is none, lists and objects are JSON."""
    if x is None or isinstance(x, str):
        return x
    if isinstance(x, bool):
        return "true" if x else "false"
    if isinstance(x, int | float):
        return number(x)
    return json.dumps(x, ensure_ascii=False)


def quote(s: str) -> str:
    return json.dumps(s, ensure_ascii=False)


def key_text(k: str) -> str:
    return quote(k) if not k or any(c in "{}[],:\"'" or c.isspace() for c in k) or k.startswith(("#", "//", "/*")) else k


def bare_text(s: str) -> str:
    """A list entry without quotes where it would be read back as the same string."""
    odd = not s or s in _WORDS or any(c in "{}[],:\"'" or c.isspace() for c in s) or s.startswith(("#", "//", "/*"))
    if not odd:
        try:
            float(s)
            odd = True
        except ValueError:
            pass
    return quote(s) if odd else s
