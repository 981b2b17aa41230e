"""Read configuration files: JSON, and HOCON as far as check configurations and sidecars use it.

HOCON is JSON with comments (``#``, ``//``), braces of the root left out, ``=`` or ``{`` after a key,
commas or line ends between members, unquoted and triple-quoted text, dotted keys, repeated objects that
merge, ``+=``, and substitutions (``${path}``, ``${?path}``; the environment is not read).  Values that
stand side by side join to one text, or objects merge and lists append.  ``include`` is an error.
"""

from __future__ import annotations

import json
import re

from assay.functions.thresholds import ConfigError

_TOKEN = re.compile(
    r'(?P<blank>[ \t\r﻿\xa0]+)|(?P<comment>(?:#|//)[^\n]*)|(?P<line>\n)|(?P<long>"""(?:.|\n)*?"""+)|(?P<quoted>"(?:[^"\\\n]|\\.)*")'
    r"|(?P<subst>\$\{\??[^}\n]*\})|(?P<add>\+=)|(?P<sign>[{}\[\],:=])|(?P<bare>(?:(?!//)[^\s$\"{}\[\],:=+#`^?!@*&\\])+|[+])")
_NUMBER = re.compile(r"-?(0|[1-9][0-9]*)(\.[0-9]+)?([eE][+-]?[0-9]+)?")
_WORDS = {"true": True, "false": False, "null": None}


class _Reference:
    def __init__(self, path: str, optional: bool):
        self.path, self.optional = path, optional


class _Joined(list):
    """Values side by side, to be joined once references are known."""


def load(path: str):
    """The configuration file at ``path``."""
    with open(path, encoding="utf-8-sig") as fh:
        return loads(fh.read())


def loads(text: str):
    try:
        return json.loads(text)
    except ValueError:
        return _Reader(text).root()


class _Reader:
    def __init__(self, text: str):
        self.tokens, at = [], 0
        while at < len(text):
            m = _TOKEN.match(text, at)
            if not m:
                raise ConfigError(f"line {text.count(chr(10), 0, at) + 1}: {text[at]!r} needs quotes")
            if m.lastgroup != "comment":
                self.tokens.append((m.lastgroup, m[0], text.count("\n", 0, at) + 1))
            at = m.end()
        self.at = 0

    def _peek(self, skip=("blank", "line")):
        while self.at < len(self.tokens) and self.tokens[self.at][0] in skip:
            self.at += 1
        return self.tokens[self.at] if self.at < len(self.tokens) else ("end", "", 0)

    def _error(self, what: str):
        _, text, line = self._peek(())
        return ConfigError(f"line {line}: {what}, found {text!r}" if text else f"{what}, found the end")

    def root(self):
        kind = self._peek()[1]
        value = self._list() if kind == "[" else self._object(braces=kind == "{")
        if self._peek()[0] != "end":
            raise self._error("expected nothing more")
        return _resolved(value, value, ())

    def _object(self, braces: bool) -> dict:
        out: dict = {}
        self.at += braces
        while True:
            kind, text, _ = self._peek(("blank", "line"))
            if kind == "end" and not braces:
                return out
            if text == "}" and kind == "sign" and braces:
                self.at += 1
                return out
            if text == "," and kind == "sign" and out:
                self.at += 1
                continue
            path = self._key()
            kind, text, _ = self._peek()
            if text != "{":
                if kind != "add" and text not in (":", "="):
                    raise self._error("expected ':', '=' or '{' after a key")
                self.at += 1
            value = self._value()
            target = out
            for part in path[:-1]:
                if not isinstance(target.get(part), dict):
                    target[part] = {}
                target = target[part]
            old = target.get(path[-1])
            if kind == "add":
                value = [*(old or []), value]
            target[path[-1]] = _merged(old, value) if isinstance(old, dict) and isinstance(value, dict) else value

    def _key(self) -> list[str]:
        path = [""]
        while True:
            kind, text, _ = self._peek(())
            if kind in ("quoted", "long"):
                path[-1] += _text(kind, text)
            elif kind == "bare":
                first, *more = text.split(".")
                path[-1] += first
                path += more
            elif kind == "blank" and path != [""]:
                pass
            else:
                break
            self.at += 1
        if path == ["include"] or any(p.strip() == "" for p in path):
            raise self._error("include is not read" if path == ["include"] else "expected a key")
        return path

    def _list(self) -> list:
        out: list = []
        self.at += 1
        while True:
            kind, text, _ = self._peek()
            if kind == "sign" and text == "]":
                self.at += 1
                return out
            if kind == "sign" and text == "," and out:
                self.at += 1
                continue
            out.append(self._value())

    def _value(self):
        parts, blank = _Joined(), ""
        self._peek()
        while True:
            kind, text, _ = self._peek(())
            if kind == "blank":
                blank = text
                self.at += 1
                continue
            if kind in ("quoted", "long", "bare", "subst") or text in ("{", "["):
                if parts and blank:
                    parts.append(blank)
                if text in ("{", "["):
                    parts.append(self._object(True) if text == "{" else self._list())
                else:
                    parts.append(_Reference(text[2:-1].lstrip("?").strip(), text[2:3] == "?") if kind == "subst"
                                 else text if kind == "bare" else _Quoted(_text(kind, text)))
                    self.at += 1
                blank = ""
                continue
            break
        if not parts:
            raise self._error("expected a value")
        return parts if len(parts) > 1 else _plain(parts[0])


class _Quoted(str):
    """Text that was quoted: never a number or a word like true."""


def _text(kind: str, text: str) -> str:
    return text[3:-3] if kind == "long" else json.loads(text)


def _plain(value):
    if isinstance(value, _Quoted) or not isinstance(value, str):
        return str(value) if isinstance(value, str) else value
    if value in _WORDS:
        return _WORDS[value]
    return json.loads(value) if _NUMBER.fullmatch(value) else value


def _merged(a: dict, b: dict) -> dict:
    return {**a, **{k: _merged(a[k], v) if isinstance(a.get(k), dict) and isinstance(v, dict) else v for k, v in b.items()}}


_ABSENT = object()


def _resolved(value, root, open_paths: tuple):
    if isinstance(value, dict):
        found = {k: _resolved(v, root, open_paths) for k, v in value.items()}
        return {k: v for k, v in found.items() if v is not _ABSENT}
    if isinstance(value, _Reference):
        if value.path in open_paths:
            raise ConfigError(f"${{{value.path}}} refers to itself")
        target = root
        for part in value.path.split("."):
            target = target[part] if isinstance(target, dict) and part in target else _ABSENT
        if target is _ABSENT and not value.optional:
            raise ConfigError(f"${{{value.path}}} names nothing")
        return target if target is _ABSENT else _resolved(target, root, (*open_paths, value.path))
    if isinstance(value, _Joined):
        parts = [p if isinstance(p, str) else _resolved(p, root, open_paths) for p in value]
        parts = [p for p in parts if p is not _ABSENT]
        whole = [p for p in parts if not (isinstance(p, str) and not isinstance(p, _Quoted) and not p.strip())]
        if whole and all(isinstance(p, dict) for p in whole):
            out: dict = {}
            for p in whole:
                out = _merged(out, p)
            return out
        if whole and all(isinstance(p, list) for p in whole):
            return [x for p in whole for x in p]
        if any(isinstance(p, (dict, list)) for p in whole):
            raise ConfigError("texts, lists and objects cannot be joined")
        return "".join(p if isinstance(p, str) else json.dumps(p) for p in parts)
    if isinstance(value, list):
        return [v for v in (_resolved(x, root, open_paths) for x in value) if v is not _ABSENT]
    return value
