"""Secret scan by assignment-aware lexing.

Base spans come from three patterns (see ``base_spans``). The lexer adds
others: it reads the whole text as source or configuration syntax (``name =
"literal"``, ``name: literal``, ``"name": "literal"``, ``name := ...``, ``name =>
...``, ``name += ...``, ``obj["name"] = ...``, typed names, ``set("name", "literal")``,
``<name>literal</name>``, ``key="name" value="literal"``; literals in one, three or
back quotes, in parentheses over several lines, as items of a list in brackets or
behind dashes, as a block behind ``|``), follows ``+`` and adjacent literals,
puts in the values of names assigned earlier in the text (in ``f"{name}"`` and
``${name}`` as well), and scores each
resolved value: how sensitive the target name's words are, times how much the
value looks like a key rather than a word, a placeholder or a path. The parts
of values that score ``THRESHOLD`` or more are spans of the kind ``lexed``. A
literal of several lines is read once more for pairs of its own, and no text more
than twice.

Spans are in code points, the end exclusive. Defined cases: null and empty
texts have no spans; rows with one doc_id are scanned one by one; an empty
table gives no rows; columns besides doc_id and text are not read.
"""

from __future__ import annotations

import hashlib
import math
import re
from bisect import bisect_right
from collections import Counter
from collections.abc import Iterator
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import DataFrame

THRESHOLD = 0.5
KINDS = ("assign", "access", "hex", "lexed")

_ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
_ACCESS = re.compile(r"AKIA[A-Z0-9]{14,}")
_HEX = re.compile(r"[0-9a-f]{16,}")

# chosen: words of names, and how far each speaks for a secret
NAME_WORDS = {"password": 1.0, "passwd": 1.0, "pwd": 1.0, "passphrase": 1.0, "pass": 0.8, "secret": 1.0, "token": 0.9,
              "apikey": 1.0, "key": 0.4, "api": 0.4, "access": 0.3, "private": 0.4, "credential": 0.9, "credentials": 0.9,
              "auth": 0.6, "bearer": 0.9, "signing": 0.4, "encryption": 0.4, "client": 0.1}
# fixed values: words of names that hold something about a secret, not one
NAME_NOT = {"path", "file", "url", "uri", "name", "id", "type", "length", "len", "count", "hint", "policy", "expiry",
            "expires", "ttl", "prompt", "field", "label", "reset", "min", "max", "public"}
_INSIDE = re.compile(r"change.?me|example|placeholder|your[-_ ]|dummy|sample|redacted|\*{3,}|x{4,}|\.{3,}", re.I)
PLACEHOLDER = re.compile(_INSIDE.pattern + r"|^[<{$%\[(]|^(true|false|null|none|nil|undefined)$", re.I)
HEAD = 4096      # characters of a constant that are kept to be looked at; its literals are looked at whole
_HINT = re.compile("|".join(w for w, v in NAME_WORDS.items() if v >= 0.4 and w not in ("key", "api", "private", "signing", "encryption")) + "|private.?key|api.?key|access.?key|signing.?key|encryption.?key", re.I)

_STRING = "|".join((r'"""(?:[^"\\]++|\\[\s\S]|"(?!""))*+"""', r"'''(?:[^'\\]++|\\[\s\S]|'(?!''))*+'''", r"`(?:[^`\\]++|\\[\s\S])*+`",
                    r'"(?:[^"\\\n]++|\\.)*+"', r"'(?:[^'\\\n]++|\\.)*+'"))
_PAIR = re.compile(r"""\([ ]*["'](?P<arg>[A-Za-z_][A-Za-z0-9_.-]*+)["'][ ]*,[ ]*(?=["'`])
    |<(?P<tag>[A-Za-z_][A-Za-z0-9_.-]*+)(?=(?:\s[^<>]*+)?>\s*(?P<content>[^<>\s]++)\s*</)
    |(?<![A-Za-z0-9_.-])(?:name|key|id)[ ]*=[ ]*["'](?P<attr>[A-Za-z_][A-Za-z0-9_. -]*+)["'][ ]+value[ ]*=[ ]*(?=["'])
    |(?:["'](?P<quoted>[A-Za-z_][A-Za-z0-9_. -]*+)["']\]?|(?<![A-Za-z0-9_.-])(?P<name>[A-Za-z_][A-Za-z0-9_.-]*+))
    (?:[ ]*:[ ]*[A-Za-z_][A-Za-z0-9_.\[\]]{0,40}(?=[ ]*=))?[ ]*(?P<op>\+=|:=|=>|=(?![=~])|:(?![:/]))[ ]*""", re.X)
_TERM = re.compile(rf"(?P<string>(?P<prefix>[fFrRbBuU]{{1,2}}(?=[\"']))?(?:{_STRING}))|(?P<word>[^\s\"'`,;(){{}}\[\]<>]+)")
_PLUS = re.compile(r"[ ]*\+[ ]*(?:\\?\n[ ]*)?|[ ]+(?=[\"'])")
_PLUS_LINES = re.compile(r"\s*\+?\s*")
_OPEN = re.compile(r"[(\[]\s*(?=[fFrRbBuU]{0,2}[\"'`])")
_COMMA = re.compile(r"\s*,\s*(?=[fFrRbBuU]{0,2}[\"'`])")
_BLOCK = re.compile(r"[|>][+-]?[ ]*\n[ ]+")
_ITEM = re.compile(r"""[ ]*(?:\#[^\n]*)?\n[ \t]*-[ ]+(?!["']?[A-Za-z_][A-Za-z0-9_.-]*+["']?[ ]*(?::\s|=[ "']))""", re.X)
_HOLE = re.compile(r"\$?\{([^{}\n]*)\}")
_NAME = re.compile(r"[A-Za-z_][A-Za-z0-9_.]*$")

Span = tuple[int, int, str]


def base_spans(text: str) -> list[Span]:
    """Leftmost non-overlapping matches of the three patterns, by kind."""
    out: list[Span] = []
    low = text.lower()
    if any(w in low for w in ("passw", "secret", "token", "api")):
        out += [(m.start(), m.end(), "assign") for m in _ASSIGN.finditer(text) if len(m[2]) >= 12]
    if "AKIA" in text:
        out += [(*m.span(), "access") for m in _ACCESS.finditer(text)]
    out += [(*m.span(), "hex") for m in _HEX.finditer(text)]
    return out


def name_score(name: str) -> float:
    """How sensitive a target name is, by its words (0 to 1)."""
    words = re.findall(r"[a-z]+", re.sub(r"(?<=[a-z0-9])(?=[A-Z])", " ", name).lower())
    if not words or words[-1] in NAME_NOT:
        return 0.0
    return min(1.0, sum(NAME_WORDS.get(w, NAME_WORDS.get(w.removesuffix("s"), 0.0)) for w in set(words)))


class Value:
    """What is known of a constant: its beginning, length, characters, and the
    places of its literals, its own and those of the constants it is built from.

    The text itself is not kept, so a constant that is doubled line after line
    costs no more than its parts. Counts are scaled down when they grow large;
    only their shares matter.
    """

    __slots__ = ("head", "size", "counts", "placeholder", "bare", "parts", "uses", "told")

    def __init__(self) -> None:
        self.head, self.size, self.counts, self.placeholder, self.bare = "", 0.0, Counter(), False, False
        self.parts: list[tuple[int, int]] = []
        self.uses: list[Value] = []
        self.told = False

    def _add(self, head: str, size: float, counts: Counter) -> None:
        self.head = (self.head + head)[:HEAD]
        self.size += size
        self.counts.update(counts)
        if self.size > 1e12:
            self.size *= 1e-6
            self.counts = Counter({c: n * 1e-6 for c, n in self.counts.items()})

    def literal(self, text: str, lo: int, hi: int, bare: bool) -> None:
        own = text[lo:hi]
        self._add(own[:HEAD], len(own), Counter(own))
        self.placeholder = self.placeholder or bool(_INSIDE.search(own))
        self.bare = self.bare or bare
        if hi > lo:
            self.parts.append((lo, hi))

    def constant(self, other: Value) -> None:
        self._add(other.head, other.size, other.counts)
        self.placeholder, self.bare = self.placeholder or other.placeholder, self.bare or other.bare
        self.uses.append(other)

    def score(self) -> float:
        """How much the constant looks like a secret (0 to 1)."""
        chars = self.counts.keys()
        if self.size < (8 if self.bare else 6) or any(c.isspace() for c in chars) or self.placeholder or PLACEHOLDER.search(self.head):
            return 0.0
        if re.match(r"[a-z]+://|[./~]", self.head, re.I):
            return 0.0
        total = math.fsum(self.counts.values())
        shares = [n / total for n in self.counts.values()]
        entropy = -sum(p * math.log2(p) for p in shares if p)
        text = "".join(chars)
        kinds = sum(bool(re.search(p, text)) for p in ("[a-z]", "[A-Z]", "[0-9]", "[^A-Za-z0-9]"))
        if self.bare and (kinds < 2 or not re.search("[0-9]", text)):
            return 0.0
        return min(1.0, entropy / 3.2) * (1.0 if kinds >= 2 else 0.6)

    def places(self) -> Iterator[tuple[int, int]]:
        """The literals that were not told yet, of this constant and those it is built from."""
        stack = [self]
        while stack:
            v = stack.pop()
            if not v.told:
                v.told = True
                yield from v.parts
                stack += v.uses


class Lexer:
    """Reads the pairs of one text in order; ``known`` holds the constants so far."""

    def __init__(self, text: str) -> None:
        self.text, self.known = text, {}
        self.at = self.read = 0         # where to go on, and the end of what was read
        self.again: int | None = None   # the first literal of several lines that is to be read for pairs of its own

    def _literal(self, value: Value, t: re.Match) -> None:
        """A string literal, with the constants that it names in braces if it is one that does so."""
        body = t.start() + len(t["prefix"] or "")
        quotes = 3 if self.text[body:body + 3] in ('"""', "'''") and t.end() - body >= 6 else 1
        lo, hi = body + quotes, t.end() - quotes
        if self.again is None and lo >= self.read and "\n" in t["string"]:
            self.again = lo
        if "f" in (t["prefix"] or "").lower() or self.text[body] == "`":
            for hole in _HOLE.finditer(self.text, lo, hi):
                other = self.known.get(hole[1].strip())
                if other is None:
                    value.placeholder = True        # made when the program runs
                else:
                    value.literal(self.text, lo, hole.start(), False)
                    value.constant(other)
                    lo = hole.end()
        value.literal(self.text, lo, hi, False)

    def _chain(self, value: Value, join: re.Pattern = _PLUS) -> bool:
        """The terms from here on that ``join`` holds together; whether there is one."""
        n = 0
        while t := _TERM.match(self.text, self.at):
            more = self.known.get(t["word"]) if t["word"] is not None and _NAME.match(t["word"]) else None
            if more:
                value.constant(more)
            elif t["string"] is None:
                value.literal(self.text, t.start(), t.end(), True)
            else:
                self._literal(value, t)
            n += 1
            self.at = t.end()
            plus = join.match(self.text, self.at)
            after = plus and _TERM.match(self.text, plus.end())
            if not after or "+" not in plus[0] and (t["string"] is None or after["string"] is None):
                break
            self.at = plus.end()
        return n > 0

    def _items(self, following: re.Pattern) -> list[Value]:
        """The items of a list from here on, each a value of its own."""
        out = []
        while True:
            value = Value()
            if not self._chain(value):
                return out
            out.append(value)
            m = following.match(self.text, self.at)
            if not m:
                return out
            self.at = m.end()

    def values(self, m: re.Match, name: str) -> list[Value]:
        """What the name of a pair is given."""
        value = Value()
        if m["tag"]:
            value.literal(self.text, *m.span("content"), False)
            return [value]
        if m["op"] == "+=" and name in self.known:
            value.constant(self.known[name])
        if opened := _OPEN.match(self.text, self.at):
            self.at = opened.end()
            if opened[0][0] == "[":
                return self._items(_COMMA)
            return [value] if self._chain(value, _PLUS_LINES) else []
        if m["op"] == ":":
            if item := _ITEM.match(self.text, self.at):
                self.at = item.end()
                return self._items(_ITEM)
            if block := _BLOCK.match(self.text, self.at):
                self.at = block.end()
        return [value] if self._chain(value) else []

    def pairs(self) -> Iterator[tuple[str, Value]]:
        """(name, value) of each pair, constants put in."""
        while m := _PAIR.search(self.text, self.at):
            self.at, self.again = m.end(), None
            name = m["quoted"] or m["name"] or m["arg"] or m["attr"] or m["tag"]
            found = self.values(m, name)
            if len(found) == 1:
                self.known[name] = found[0]
            for value in found:
                yield name, value
            self.read = max(self.read, self.at)
            if self.again is not None:
                self.at = self.again


def lexed_spans(text: str) -> list[Span]:
    """Literals that end up in sensitive names, constants propagated."""
    if not _HINT.search(text):
        return []
    out: set[Span] = set()
    for name, value in Lexer(text).pairs():
        sensitive = name_score(name)
        if sensitive and sensitive * value.score() >= THRESHOLD:
            out.update((lo, hi, "lexed") for lo, hi in value.places())
    return sorted(out)


def spans_of(text: str | None) -> list[Span]:
    """All spans of a text: the base ones, and lexed ones that none of them holds."""
    if not text:
        return []
    base = base_spans(text)
    starts = sorted(base)
    ends = list(accumulate((b[1] for b in starts), max))        # the farthest end of the spans up to each
    added = []
    for s in lexed_spans(text):
        k = bisect_right(starts, s[0], key=lambda b: b[0])
        if not k or ends[k - 1] < s[1]:
            added.append(s)
    return sorted(base + added, key=lambda s: (s[0], KINDS.index(s[2])))


def joined(spans: list[Span]) -> str:
    return ",".join(f"{kind}:{lo}:{hi}" for lo, hi, kind in spans)


def scan(docs: DataFrame) -> DataFrame:
    """Per row of docs: doc_id, and its spans as an array of (start, end, kind)."""
    kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("kind", pa.string())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = [[{"start": lo, "end": hi, "kind": k} for lo, hi, k in spans_of(t.as_py())] for t in b.column("text")]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(found, kind)], ["doc_id", "spans"])

    d = docs.selectExpr("cast(doc_id AS long) doc_id", "text")
    return d.mapInArrow(run, "doc_id long, spans array<struct<start:long,end:long,kind:string>>")
