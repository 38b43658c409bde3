"""Secret scan by assignment-aware lexing.

Three fixed patterns give the base findings (``assign``, ``access``, ``hex``). Beside them a small lexer
reads a text as source or configuration: ``name = value``, ``name: value``, ``"name": value``, ``name[key] = value``,
``name := value``, ``name => value``, ``name: type = value`` and ``<name>value</name>`` become pairs of a target name
and the atoms of its value (quoted literals, bare words, references ``$name`` / ``${name}``, joined by ``+`` or by
standing side by side). Constants are propagated: an atom that names another target of the text stands for the
literals of that target's last assignment before it or, where there is none, of its first one after it. A
value's literals are scored by how sensitive the target name is times how much the joined literal looks
like a secret; those that reach ``THRESHOLD`` are found as ``named``, at the place of the literal, wherever the sensitive name stands.

Every pattern runs once over the text and none backtracks over a long run; an unquoted value is one literal, so what looks like
an assignment inside it (a URL) is none. Values have as many atoms and stand for as many literals as the text gives them: a value
that refers to others shares theirs (``Value``), so their number is in proportion to the text. Literals are joined for sensitive
names alone; a name that adds to the one before it goes on from what that one joined.

Defined cases: null text is empty; an empty text has no findings; every row (repeated ones, rows without an id) is
scanned by itself; a literal inside a base finding is not reported again; a literal found by several names is reported
once, with its best score; columns other than ``doc_id`` and ``text`` are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import bisect
import math
import re
from collections import Counter

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Base patterns, by the contract: kind, pattern, group whose length counts, least length. Letters of ``assign`` in either case (ASCII).
KINDS = ("assign", "access", "hex", "named")
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
BASE = (("assign", ASSIGN, 2, 12), ("access", re.compile(r"AKIA[A-Z0-9]+"), 0, 18),
        # runs of at least 16: the same spans as runs of any length of which the short ones are dropped
        ("hex", re.compile(r"[0-9a-f]{16,}"), 0, 16))

THRESHOLD = 0.5

# How sensitive a target is, by the words of its name and by pairs of adjacent words.
WORDS = {"password": 1.0, "passwd": 1.0, "pwd": 1.0, "passphrase": 1.0, "pass": 0.8, "secret": 1.0, "secrets": 0.9, "token": 0.9,
         "apikey": 0.9, "credential": 0.9, "credentials": 0.9, "creds": 0.9, "bearer": 0.8, "authorization": 0.8, "jwt": 0.8,
         "auth": 0.6, "otp": 0.6, "salt": 0.55, "cookie": 0.5, "signature": 0.5}
PAIRS = {("api", "key"): 0.9, ("access", "key"): 0.9, ("private", "key"): 1.0, ("secret", "key"): 1.0, ("signing", "key"): 0.9,
         ("encryption", "key"): 0.9, ("master", "key"): 0.9, ("account", "key"): 0.9, ("session", "key"): 0.8, ("connection", "string"): 0.7}
#: A name that ends in one of these tells something about a secret, not the secret.
ABOUT = {"count", "length", "len", "size", "name", "file", "path", "dir", "url", "uri", "field", "type", "policy", "hint", "label",
         "limit", "max", "min", "expiry", "expires", "ttl", "timeout", "placeholder", "regex", "pattern", "prompt", "format", "column",
         "header", "class", "provider", "required", "enabled", "index", "version"}
PLACEHOLDER = re.compile(r"(?:change[-_ ]?me.*|(?:an?[-_ ])?example.*|x{4,}|\*+|<.*>|your[-_ ].*|my[-_ ].*|insert[-_ ].*|todo|"
                         r"none|null|true|false|undefined|test|dummy.*|redacted.*|\.+|placeholder.*|\{\{.*\}\}|%\(.*\)s)", re.I | re.S)

TARGET = re.compile(r"""
    (?<![A-Za-z0-9_$])(?<![A-Za-z0-9_$][.\-])                                # a name begins here
    ([A-Za-z_$][A-Za-z0-9_$]*+(?:[.\-][A-Za-z0-9_$]++)*+)                      # a, a.b, a-b
    (?:\[[\x20\t]*+["']?([A-Za-z0-9_$.\-]*+)["']?[\x20\t]*+\])?+               # a["b"], a[]
    ["'`]?[\x20\t]*+(?:=>|:=|[:=])(?!=)[\x20\t]*+""", re.X)
ELEMENT = re.compile(r"<([A-Za-z_][A-Za-z0-9_.\-]*+)>([^<>\n]++)</\1>")
ATOM = re.compile(r"""
    (?P<quoted>[rbfuRBFU]{0,2}(?:"(?P<d>(?:[^"\\\n]|\\.)*+)"|'(?P<s>(?:[^'\\\n]|\\.)*+)'|`(?P<b>[^`\n]*+)`))
  | \$\{?(?P<ref>[A-Za-z_][A-Za-z0-9_.]*+)\}?
  | (?P<bare>[^\s"'`,;(){}\[\]<>+\#&|$]++)""", re.X)
JOIN = re.compile(r"[\x20\t]*+(?:(?P<plus>\+)[\x20\t]*+(?:\\?\r?\n[\x20\t]*+)?)?+")
TYPED = re.compile(r"[\x20\t]*+=(?!=)[\x20\t]*+")
NAME = re.compile(r"[A-Za-z_$][A-Za-z0-9_$]*(?:[.\-][A-Za-z0-9_$]+)*")
SPLIT = re.compile(r"[A-Z]+(?![a-z])|[A-Z]?[a-z]+|[0-9]+")
WORD = re.compile(r"[A-Za-z]+")

SCHEMA = pa.schema([("doc_id", pa.int64()), ("secrets", pa.list_(pa.struct([
    ("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("name", pa.string()), ("score", pa.float64())])))])
DDL = "doc_id bigint, secrets array<struct<kind: string, start: bigint, end: bigint, name: string, score: double>>"


def name_score(name: str) -> float:
    """How sensitive the target ``name`` is, 0 to 1."""
    words = [w.lower() for w in SPLIT.findall(name)]
    if not words:
        return 0.0
    best = max([WORDS.get(w, 0.0) for w in words] + [PAIRS.get(p, 0.0) for p in zip(words, words[1:])])
    return best * (0.2 if words[-1] in ABOUT else 1.0)


def literal_score(literal: str, quoted: bool, counts: Counter | None = None) -> float:
    """How much a literal looks like a secret, 0 to 1: long enough, no placeholder, mixed characters.

    ``counts`` are those of its characters where they are at hand.
    """
    n = len(literal)
    if n < 8 or PLACEHOLDER.fullmatch(literal) or literal[-7:].lower() == "example" or not quoted and WORD.fullmatch(literal):
        return 0.0
    counts = Counter(literal) if counts is None else counts
    entropy = -sum(c / n * math.log2(c / n) for c in counts.values())
    classes = (any("a" <= c <= "z" for c in counts) + any("A" <= c <= "Z" for c in counts)
               + any("0" <= c <= "9" for c in counts) + any(not c.isalnum() for c in counts))
    mixed = min(1.0, 0.1 + 0.15 * classes + entropy / 8)
    return mixed * (0.5 if any(c.isspace() for c in counts) else 1.0)


def _value(text: str, at: int) -> tuple[list[tuple], int]:
    """Atoms of the value that starts at ``at``: ``(start, end, quoted, name or None)``; and its end."""
    atoms, joined = [], False
    while m := ATOM.match(text, at):
        if m["quoted"] is not None:
            group = next(g for g in "dsb" if m[g] is not None)
            atoms.append((m.start(group), m.end(group), True, None))
        elif m["ref"] is not None:
            atoms.append((m.start(), m.end(), False, m["ref"]))
        elif atoms and not joined:
            break
        else:
            atoms.append((m.start(), m.end(), False, m["bare"] if NAME.fullmatch(m["bare"]) else None))
        at = m.end()
        j = JOIN.match(text, at)
        joined = j["plus"] is not None
        follows = ATOM.match(text, j.end()) if not joined else None
        if not joined and not (m["quoted"] is not None and follows and follows["quoted"] is not None):
            break
        at = j.end()
    return atoms, at


def pairs(text: str) -> list[tuple[int, str, list[tuple]]]:
    """``(position, target name, atoms)`` of every assignment, in text order."""
    found, upto = [], 0
    if "=" in text or ":" in text:
        for m in TARGET.finditer(text):
            if m.start() < upto:
                continue  # inside an unquoted value, as in a URL
            name = f"{m[1]}.{m[2]}" if m[2] else m[1]
            atoms, end = _value(text, m.end())
            if len(atoms) == 1 and atoms[0][3] and (typed := TYPED.match(text, end)):
                atoms, _ = _value(text, typed.end())  # name: type = value
            if atoms:
                found.append((m.start(), name, atoms))
                upto = max((e for _, e, quoted, _ in atoms if not quoted), default=0)
    if "</" in text:
        for m in ELEMENT.finditer(text):
            found.append((m.start(), m[1], [(m.start(2), m.end(2), False, None)]))
        found.sort(key=lambda p: p[0])
    return found


def _last_part(name: str) -> str:
    return re.split(r"[.\-]", name)[-1]


class Value(list):
    """What a name stands for: literals ``(start, end, quoted)`` and values of other names, in order. Values only hold older ones."""


class Joined:
    """The literals of a value, each once at its first place, joined."""

    def __init__(self, text: str):
        self.text, self.value = text, None
        self.parts: dict[tuple, None] = {}
        self.seen: dict[int, Value] = {}
        self.literal, self.quoted, self.counts = "", False, Counter()

    def _fresh(self, items: list) -> list[tuple]:
        """The literals among ``items`` that are not here yet, in order; they are here from now on."""
        fresh, stack = [], [iter(items)]
        while stack:
            item = next(stack[-1], None)
            if item is None:
                stack.pop()
            elif isinstance(item, Value):
                if id(item) not in self.seen:  # a value that was met adds nothing new
                    self.seen[id(item)] = item
                    stack.append(iter(item))
            elif item not in self.parts:
                self.parts[item] = None
                fresh.append(item)
        return fresh

    def _read(self, fresh: list[tuple]) -> str:
        self.quoted = self.quoted or any(q for _, _, q in fresh)
        return "".join([self.text[s:e] for s, e, _ in fresh])

    def extended(self, value: Value) -> Joined:
        """This one, where ``value`` puts something before or behind its value, or a new one for ``value``."""
        at = next((k for k, item in enumerate(value) if item is self.value), None) if self.value is not None else None
        front = [] if not at else Joined(self.text)._fresh(value[:at])
        if at is None or any(item in self.parts for item in front):  # what stands in front is joined there
            out, front, behind = Joined(self.text), [], value
        else:
            out, behind = self, value[at + 1:]
        before, after = out._read(out._fresh(front)), out._read(out._fresh(behind))
        if before:
            counts = Counter(before)
            counts.update(out.counts)
            out.literal, out.counts = before + out.literal, counts
        out.literal += after
        out.counts.update(after)
        out.seen[id(value)] = out.value = value
        return out


def propagate(text: str, found: list) -> list[Value]:
    """What each pair's value stands for, references followed."""
    places: dict[str, list[int]] = {}
    for i, (_, name, _) in enumerate(found):
        places.setdefault(name, []).append(i)

    def target(name: str, i: int) -> int | None:
        at = places.get(name)
        if not at:
            return None
        k = bisect.bisect_left(at, i)
        if k:
            return at[k - 1]
        return next((j for j in at[k:k + 2] if j != i), None)

    links = [[target(a[3], i) if a[3] else None for a in atoms] for i, (_, _, atoms) in enumerate(found)]
    nothing = Value()
    done = [nothing] * len(found)

    def settle(i: int) -> None:
        items = Value((start, end, quoted) if j is None else done[j] for (start, end, quoted, _), j in zip(found[i][2], links[i]))
        done[i] = items[0] if len(items) == 1 and isinstance(items[0], Value) else items

    # references back are settled in order, references ahead on the way back, what referred to those on a third way
    ahead = any(j is not None and j > i for i, l in enumerate(links) for j in l)
    for order in ([range(len(found)), range(len(found) - 1, -1, -1), range(len(found))] if ahead else [range(len(found))]):
        for i in order:
            settle(i)
    return done


def named(text: str) -> dict[tuple[int, int], tuple[str, float]]:
    """Literals that sensitive names stand for: ``(start, end) -> (name, score)``."""
    found = pairs(text)
    weights = [name_score(name) for _, name, _ in found]
    if not any(w >= THRESHOLD for w in weights):
        return {}
    told: list[tuple[float, int, str, Value]] = []
    looks: dict[int, float] = {}
    joined = Joined(text)
    for i, ((_, name, _), weight, value) in enumerate(zip(found, weights, propagate(text, found))):
        if weight >= THRESHOLD:
            if id(value) not in looks:  # many names may stand for one long literal
                joined = joined.extended(value)
                looks[id(value)] = literal_score(joined.literal, joined.quoted, joined.counts)
            score = weight * looks[id(value)]
            if score >= THRESHOLD:
                told.append((score, i, name, value))
    # best scores first, so each value and each literal is looked at once
    out: dict[tuple[int, int], tuple[str, float]] = {}
    met: set[int] = set()
    for score, _, name, value in sorted(told, key=lambda t: (-t[0], t[1] if round(t[0], 6) >= t[0] else -t[1])):
        stack = [value]
        while stack:
            item = stack.pop()
            if isinstance(item, Value):
                if id(item) not in met:
                    met.add(id(item))
                    stack += item
            elif item[1] > item[0] and item[:2] not in out:
                out[item[:2]] = (name, round(score, 6))
    return out


def secrets_of(text: str) -> list[dict]:
    """All findings of a text, by start, then kind as listed, then end."""
    rows = []
    for kind, pattern, group, least in BASE:
        for m in pattern.finditer(text):
            if m.end(group) - m.start(group) >= least:
                rows.append({"kind": kind, "start": m.start(), "end": m.end(), "name": m[1].lower() if kind == "assign" else None, "score": 1.0})
    rows.sort(key=lambda r: r["start"])
    # the widest reach of base findings up to each start tells what lies inside one
    starts, reach = [], []
    for r in rows:
        starts.append(r["start"])
        reach.append(max(r["end"], reach[-1] if reach else 0))
    for (s, e), (name, score) in named(text).items():
        k = bisect.bisect_right(starts, s)
        if not k or reach[k - 1] < e:
            rows.append({"kind": "named", "start": s, "end": e, "name": name, "score": score})
    return sorted(rows, key=lambda r: (r["start"], KINDS.index(r["kind"]), r["end"]))


def scan_secrets(docs: DataFrame) -> DataFrame:
    """``doc_id, secrets``: the findings of every whole text with kind, code-point span, target name and score."""
    def scan(batches):
        for b in batches:
            for at in range(0, b.num_rows, 512):
                part = b.slice(at, 512)
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array([secrets_of(t or "") for t in part.column(1).to_pylist()],
                                                                           SCHEMA.field(1).type)], schema=SCHEMA)

    return docs.select(F.col("doc_id").cast("long"), F.col("text")).mapInArrow(scan, DDL)
