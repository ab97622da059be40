"""Secrets in texts: three base patterns, and literals assigned to names that promise a secret."""

from __future__ import annotations

import hashlib
import math
import re
from bisect import bisect_left, bisect_right
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from scholia.llm.common import id_and_text, query, table


def either_case(word: str) -> str:
    return "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in word)


# The base patterns, in the order in which spans that start together are listed.
NAMES = "|".join([*map(either_case, ("password", "passwd", "secret", "token")), either_case("api") + "_?" + either_case("key")])
ASSIGN = re.compile(rf"""({NAMES})["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{32,}")  # runs of 32 and more; shorter runs fail anyway
KINDS = ("assign", "access", "hex", "named")

# What a name says about the literal that it holds, by the parts of the name.
SENSITIVE = {
    "password": 3, "passwd": 3, "pwd": 3, "passphrase": 3, "secret": 3, "token": 3, "apikey": 3, "credential": 3, "credentials": 3,
    "pass": 2, "auth": 2, "key": 2, "bearer": 2, "private": 2, "signature": 2, "cookie": 2, "session": 1, "access": 1, "salt": 1, "api": 1,
    "hash": -1, "id": -1, "name": -2, "path": -2, "file": -2, "url": -2, "length": -3, "size": -3, "count": -3, "type": -2,
}
LEAST = 4.0  # a literal counts from this score on


def base_spans(text: str) -> list[tuple[int, int, str]]:
    """``start, kind number, end`` of the base patterns."""
    found = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 8]
    if "AKIA" in text:
        found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 16]
    found += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(found)


# Tokens of source and configuration syntax. Lexing starts at the signs that assign, so that plain prose costs little.
SIGN = re.compile(r"(?<![=!<>:+\-*/%&|^~])(?:\+=|:=|=>|=(?!~[ \t])|:(?!//))(?![=:])")
BLANK = re.compile(r"(?:[ \t]|\\\r?\n|/\*[^*]*\*/)*")  # between tokens of a line
GAP = re.compile(r"(?:\s|\\\r?\n|#[^\n]*|//[^\n]*|/\*[^*]*\*/)*")  # inside brackets, and after a joining sign
STRING = re.compile(
    r"""[rRbBfFuU]{0,2}(?:"{3}((?:[^"\\]|\\.|"(?!""))*)"{3}|'{3}((?:[^'\\]|\\.|'(?!''))*)'{3}|"((?:[^"\\\n]|\\.)*)"|'((?:[^'\\\n]|\\.)*)'|`([^`\n]*)`)""", re.S
)
JOINED = re.compile(r"""([A-Za-z_][\w.]*)(?=[ \t]*\+[ \t]*(?:\\?\r?\n\s*)?(?:[rRbBfFuU]{0,2}["'`])|[ \t]+\+\s)""")  # a name before a joining sign
BARE = re.compile(r"""[^\s"'`,;(){}\[\]<>#=]+(?:=+(?![\w"'`=]))?""")
JOIN = re.compile(r"\+(?![+=])|\.\.|\.(?=[ \t]*[\"'])")
OPEN = {"(": ")", "[": "]"}
NAME = re.compile(r"[A-Za-z_][\w.]*\Z")
PARTS = re.compile(r"[A-Z]+(?![a-z])|[A-Z]?[a-z]+|[0-9]+")
PLACEHOLDER = re.compile(r"""^(?:\$[{(\w].*|<.*>|\{\{.*\}\}|%\(.*|x+|\*+|\.+|changeme|example|none|null|true|false|undefined)$""", re.I)


def name_score(name: str) -> float:
    parts = [p.lower() for p in PARTS.findall(name)]
    joined = "".join(parts)
    best = max((SENSITIVE[p] for p in parts if SENSITIVE.get(p, 0) > 0), default=0)
    if not best and any(w in joined for w in ("password", "passwd", "secret", "apikey")):
        best = 3
    return best + sum(max(SENSITIVE.get(p, 0), -3) for p in parts[-1:] if SENSITIVE.get(p, 0) < 0)


def literal_score(value: "Literals") -> float:
    """How much a value looks drawn at random: length, mixture, entropy; prose and place holders get none."""
    n = sum(value.letters.values())
    if n < 8 or value.holder:
        return -10.0
    bits = -sum(k / n * math.log2(k / n) for k in value.letters.values())
    kinds = sum(any(map(f, value.letters)) for f in (str.islower, str.isupper, str.isdigit)) + any(not c.isalnum() and not c.isspace() for c in value.letters)
    return min(bits, 4.5) / 1.5 + 0.5 * (kinds - 1) - 1.5 * value.letters[" "]


def name_before(text: str, at: int) -> str | None:
    """The name that the sign at ``at`` assigns to: plain, quoted, or a quoted key in brackets, of any length."""
    closing = ""
    for mark in ("]", "\"'", ""):
        while at and text[at - 1] in " \t":
            at -= 1
        if mark and at and text[at - 1] in mark:
            closing += text[at - 1]
            at -= 1
    end = at
    while at and (text[at - 1] in "_.-" or text[at - 1].isalnum()):
        at -= 1
    if closing in ('"', "'", ']"', "]'") and not (at and text[at - 1] == closing[-1]) or closing == "]":
        return None
    while at < end and not (text[at] == "_" or text[at].isascii() and text[at].isalpha()):
        at += 1
    return text[at:end] or None


def values(text: str, at: int) -> tuple[list[list[tuple[int, int, bool]]], int]:
    """What stands behind an assignment sign: groups of joined terms ``start, end, quoted``, and where it ends.

    Terms are joined by ``+``, ``.`` or ``..``, or by standing next to each other; a list has a group a member.
    A value goes on over line ends inside brackets, after a joining sign and after a backslash. A call, or
    anything else that isn't a literal or a name, ends it.
    """
    groups, terms, inside, joining = [], [], [], False
    while True:
        end = at
        at = (GAP if inside or joining else BLANK).match(text, at).end()
        c = text[at:at + 1]
        wanted = joining or not terms
        m = STRING.match(text, at) if wanted or terms[-1][2] else None
        if m:
            terms.append((m.start(m.lastindex), m.end(m.lastindex), True))
        elif wanted and c in OPEN:
            inside.append(OPEN[c])
            at += 1
            continue
        elif inside and c == inside[-1]:
            inside.pop()
            at += 1
            continue
        elif inside and c == "," and not joining:
            groups.append(terms)
            terms = []
            at += 1
            continue
        elif terms and not joining and (m := JOIN.match(text, at)):
            at, joining = m.end(), True
            continue
        elif wanted and (m := JOINED.match(text, at) or BARE.match(text, at)):
            if text[m.end():m.end() + 1] == "(":
                break
            terms.append((m.start(), m.end(), False))
        else:
            break
        at, joining = m.end(), False
    groups.append(terms)
    return [g for g in groups if g], end


def assignments(text: str) -> Iterator[tuple[int, str, bool, list]]:
    """``place, name, adds, groups`` of every assignment of the text, in order.

    In ``name: type = value`` the name is the one before its type. A colon inside a bare value is part of it.
    """
    typed, ended, bare = None, -1, -1
    for sign in SIGN.finditer(text):
        at = sign.start()
        if at < bare:
            continue
        if typed and ended <= at and not text[ended:at].strip(" \t"):
            name = typed
        else:
            name = name_before(text, at)
        typed = None
        if name:
            groups, ended = values(text, sign.end())
            bare = max((end for group in groups for _, end, quoted in group if not quoted), default=-1)
            typed = name if sign[0] == ":" and len(groups) == 1 and len(groups[0]) == 1 and not groups[0][0][2] else None
            yield at, name, sign[0] == "+=", groups


class Literals:
    """What a value is made of: the places of its literals, their letters, and whether each is a place holder."""

    def __init__(self):
        self.letters, self.holder, self.any = Counter(), True, False

    def take(self, value: str) -> None:
        self.letters.update(value)
        self.holder &= bool(PLACEHOLDER.match(value))
        self.any = True

    def join(self, other: "Literals") -> None:
        if other.any:
            self.letters.update(other.letters)
            self.holder &= other.holder
            self.any = True


class Program:
    """The assignments of a text with their names resolved.

    A name means its latest assignment before the use, or else its first one after it; ``+=`` joins to the
    assignment before. Resolution goes through any number of names in both directions; an assignment that leads
    back to itself adds nothing there. Every group is resolved once, so work follows the length of the text.
    """

    def __init__(self, text: str):
        self.text, self.groups, self.by_name = text, [], {}  # a group is (name, terms, place, adds)
        for place, name, adds, groups in assignments(text):
            ids = []
            for terms in groups:
                ids.append(len(self.groups))
                self.groups.append((name, terms, place, adds))
            if ids:
                places, members = self.by_name.setdefault(name, ([], []))
                places.append(place)
                members.append(ids)
        self.made: dict[int, Literals] = {}
        self.linked: dict[int, list[int]] = {}

    def meant(self, name: str, place: int) -> list[int]:
        """The groups that ``name`` stands for when used by the assignment at ``place``."""
        places, members = self.by_name.get(name, ((), ()))
        at = bisect_left(places, place)
        if at:
            return members[at - 1]
        at = bisect_right(places, place)
        return members[at] if at < len(places) else []

    def links(self, i: int) -> list[int]:
        """The groups that group ``i`` takes in."""
        if i not in self.linked:
            name, terms, place, adds = self.groups[i]
            out = list(self.meant(name, place)) if adds else []
            for start, end, quoted in terms:
                if not quoted and NAME.match(self.text[start:end]):
                    out += self.meant(self.text[start:end], place)
            self.linked[i] = out
        return self.linked[i]

    def own(self, i: int) -> list[tuple[int, int]]:
        """The literals that stand in group ``i`` itself; a bare word that names nothing counts if it has digits."""
        _, terms, place, _ = self.groups[i]
        out = []
        for start, end, quoted in terms:
            word = self.text[start:end]
            if quoted or not NAME.match(word) or any(c.isdigit() for c in word) and not self.meant(word, place):
                out.append((start, end))
        return out

    def literals(self, i: int) -> Literals:
        open_, path = [(i, iter(self.links(i)))], {i}
        while open_:
            k, rest = open_[-1]
            if k in self.made:
                open_.pop()
                path.discard(k)
                continue
            step = next((j for j in rest if j not in self.made and j not in path), None)
            if step is not None:
                open_.append((step, iter(self.links(step))))
                path.add(step)
                continue
            whole = Literals()
            for start, end in self.own(k):
                whole.take(self.text[start:end])
            for j in self.links(k):
                if j in self.made:
                    whole.join(self.made[j])
            self.made[k] = whole
        return self.made[i]

    def secret(self) -> set[tuple[int, int]]:
        """The literals that reach a name whose promise and whose whole value make up the least score."""
        promise = {name: name_score(name) for name in self.by_name}
        todo = [i for i, g in enumerate(self.groups) if promise[g[0]] > 0 and promise[g[0]] + literal_score(self.literals(i)) >= LEAST]
        seen, found = set(todo), set()
        while todo:
            i = todo.pop()
            found.update((a, b) for a, b in self.own(i) if any(c.isalnum() for c in self.text[a:b]))
            fresh = [j for j in self.links(i) if j not in seen]
            seen.update(fresh)
            todo += fresh
        return found


def named_spans(text: str) -> list[tuple[int, int, str]]:
    """Literals that reach a sensitive name, directly, joined with others, or through names assigned anywhere in the text."""
    if "=" not in text and ":" not in text:
        return []
    return [(a, 3, b) for a, b in Program(text).secret()]


def all_spans(text: str) -> tuple[list[tuple[int, int, int]], list[tuple[int, int, int]]]:
    """The base spans, and those together with the named ones that lie in no base span."""
    base = base_spans(text)
    more = [s for s in named_spans(text) if not any(b[0] < s[2] and s[0] < b[2] for b in base)]
    return base, sorted(base + more)


def told(spans) -> str:
    return ",".join(f"{KINDS[kind]}:{start}:{end}" for start, kind, end in spans)


SCHEMA = pa.schema([
    ("doc_id", pa.int64()), ("n_assign", pa.int64()), ("n_access", pa.int64()), ("n_hex", pa.int64()), ("n_named", pa.int64()),
    ("base_sha256", pa.string()), ("spans", pa.string()),
])


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = []
        for text in batch["text"]:
            base, spans = all_spans(text.as_py())
            n = Counter(kind for _, kind, _ in spans)
            rows.append((n[0], n[1], n[2], n[3], hashlib.sha256(told(base).encode()).hexdigest(), told(spans)))
        columns = [batch["doc_id"], *(pa.array([r[i] for r in rows], SCHEMA.types[i + 1]) for i in range(6))]
        yield pa.RecordBatch.from_arrays(columns, schema=SCHEMA)


def find_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: counts by kind, the digest of the base spans, and all spans.

    Spans are ``kind:start:end`` in code points, the end exclusive, by start and then kind. A null text
    is empty: no spans, and the digest of an empty string. Ids may be null or repeat; an empty table
    gives no rows; other columns aren't read. Each text is scanned whole.
    """
    types = "doc_id bigint, n_assign bigint, n_access bigint, n_hex bigint, n_named bigint, base_sha256 string, spans string"
    return id_and_text(docs, id_col, text_col).mapInArrow(_scan, types)


def redacted(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, text`` with every span replaced by ``[secret]``; overlapping spans are one."""

    def run(batches):
        for batch in batches:
            out = []
            for cell in batch["text"]:
                text, parts, at = cell.as_py(), [], 0
                for start, _, end in all_spans(text)[1]:
                    if start >= at:
                        parts += [text[at:start], "[secret]"]
                    at = max(at, end)
                out.append("".join([*parts, text[at:]]))
            yield pa.RecordBatch.from_arrays([batch["doc_id"], pa.array(out, pa.string())], names=["doc_id", "text"])

    return id_and_text(docs, id_col, text_col).mapInArrow(run, "doc_id bigint, text string")


@query("op4_secrets")
def op4_secrets(spark, sf_dir):
    return find_secrets(table(spark, sf_dir, "documents"))
