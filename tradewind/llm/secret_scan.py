"""Operator 13: secrets by assignment-aware lexing.

*Base spans* are the matches of three patterns, leftmost and non-overlapping per kind:
``assign`` (a sensitive word, an operator, a value of 6+ characters), ``access`` (key
ids of 20+ characters) and ``hex`` (runs of 24+ lower-case hexadecimal digits).

*The method* adds ``literal`` spans:

1. *Pairs.*  Source and configuration syntax is read as pairs of a target name and a
   value: assignments (``x = ``, ``x := ``, annotated ones, keyword arguments,
   subscripts), mapping entries (``"x": ``, ``x => ``, ``x: ``), shell and ini lines,
   elements and attributes of markup, ``key``/``name`` entries followed by ``value``,
   and ``--x value`` options.  A value is a chain of string literals (with prefixes,
   escapes, triple quotes), bare words, names, ``$x``/``${x}`` and calls; the arguments
   of a call are values too, but the variable an environment lookup reads is a name.
2. *Constants.*  Names that a value mentions are replaced by what the same text assigns
   to them, transitively, so ``a = "..."; b = a + "x"; password = b`` marks both literals.
3. *Scores.*  A target scores 1 for words like password, secret, token or api key, 0.5
   for weaker ones, 0 if it ends like a description (``token_count``, ``secret_name``).
   A literal scores by its length in bits (characters times their entropy); words of
   letters alone score less, placeholders and references nothing.  A literal is reported
   where the product reaches ``REPORT_AT``, unless a base span holds it.

Each pattern is linear (possessive, no nested repeats); texts without a sensitive word are
not lexed.  Nothing is shuffled: a batch holds ``TEXT_BYTES`` of text or one longer text.

Rows: one per input row.  Null and empty texts have no findings.  Offsets are code points,
ends exclusive.  Repeated rows get equal results; null ids stay.  Extra columns are ignored.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from math import log2

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .packed import sized

# The base patterns.
ASSIGN = re.compile(r"""(?ai)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?"""
                    r"""([A-Za-z0-9+/_.=-]+)""")
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"(?<![0-9a-f])[0-9a-f]{24,}")
LEAST_VALUE, LEAST_ACCESS = 6, 20
KINDS = ("assign", "access", "hex", "literal")

TEXT_BYTES = 1 << 20
REPORT_AT = 0.5
#: Bits at which a literal counts in full.
FULL_BITS = 32

STRONG = {"password", "passwd", "passphrase", "passcode", "pwd", "secret", "secrets", "token",
          "apikey", "credential", "credentials", "accesskey", "privatekey", "secretkey",
          "authtoken"}
STRONG_PAIRS = {(a, "key") for a in ("api", "access", "private", "secret", "auth", "signing",
                                     "encryption", "account", "master", "shared")}
WEAK = {"auth", "authorization", "bearer", "pass", "pin", "key", "salt", "dsn", "cookie", "otp"}
#: A name that ends so describes a secret, it does not hold one.
DESCRIBES = {"count", "max", "min", "length", "len", "limit", "size", "type", "name", "field",
             "label", "hint", "policy", "expiry", "expires", "ttl", "timeout", "url", "uri",
             "path", "file", "regex", "pattern", "id", "public", "index", "prompt", "message",
             "error", "reset", "version", "header", "format", "env", "var", "enabled", "required"}
PLACEHOLDER = re.compile(
    r"(?i)(?:change.?me|example|placeholder|sample|dummy|redacted|todo|your[\W_]|my[\W_]?pass|"
    r"x{4,}|\*{3,}|\.{3,}|<[^>]*>|^(?:none|null|true|false|undefined|password|secret|token)$)")

NAME = r"[A-Za-z_][\w]*+(?:[.\-]++\w++)*+"
PAIR = re.compile(
    r"(?<![\w$.\-])(?P<name>" + NAME + r""")["'`]?+[ \t]*+\]?+[ \t]*+"""
    # a declared type before the value
    r"(?::[ \t]*+[A-Za-z_][\w.<>\[\]|?]*+[ \t]*+(?==[^=]))?+"
    r"(?P<op>:=|=>|=(?![=~])|:(?![:/\\]))[ \t]*+")
ELEMENT = re.compile(r"<(?P<name>[A-Za-z_][\w.\-]*+)(?:\s[^<>]*+)?>(?P<value>[^<>\n]++)</(?P=name)\s*+>")
OPTION = re.compile(r"(?<!\S)--(?P<name>[A-Za-z][\w\-]*+)[ \t]++(?=[^\s\-])")
STRING = re.compile(r"""[bBrRuUfF]{0,2}(?:"((?:[^"\\\n]|\\.)*+)"|'((?:[^'\\\n]|\\.)*+)'|`((?:[^`\\\n]|\\.)*+)`)""")
TRIPLE = re.compile(r"""[bBrRuUfF]{0,2}(\"{3}|'{3})""")
REFERENCE = re.compile(r"\$\{?(?P<a>[A-Za-z_]\w*+)[^}\s]*+\}?|%(?P<b>[A-Za-z_]\w*+)%|\{\{\s*+(?P<c>[\w.]++)\s*+\}\}")
CALL = re.compile(r"(?:new[ \t]++)?(?P<f>" + NAME + r")\((?P<args>[^()\n]*+)\)?")
# an ampersand belongs to a bare word unless a query parameter follows it
WORD = re.compile(r"[^\s,;\"'`(){}\[\]<>|&]++(?:&(?![\w.]++=)[^\s,;\"'`(){}\[\]<>|&]++)*+")
SCHEME = re.compile(r"(?i:bearer|basic|token)[ \t]++(?=\S)")
JOIN = re.compile(r"[ \t]*+(?:\+|\.\.|&|\|\|)[ \t]*+(?!\s)|[ \t]++(?=[\"'])")
LOOKUP = re.compile(r"(?i)(?:^|[._])(?:getenv|environ|env|getproperty)(?:[._]get)?$|(?:^|[._])get$")
IDENTIFIER = re.compile(r"^" + NAME + r"$")
PIECES = re.compile(r"[A-Z]+(?![a-z])|[A-Z]?[a-z]+|\d+")
#: A text without any of these holds no sensitive target (a superset, on RE2).
SENSITIVE = r"(?i)pass|pwd|secret|token|key|cred|auth|bearer|\bpin\b|salt|dsn|cookie|otp"


def base_spans(text: str) -> list[tuple[str, int, int]]:
    out = [("assign", *m.span()) for m in ASSIGN.finditer(text)
           if m.end(2) - m.start(2) >= LEAST_VALUE]
    out += [("access", *m.span()) for m in ACCESS.finditer(text)
            if m.end() - m.start() >= LEAST_ACCESS]
    return out + [("hex", *m.span()) for m in HEX.finditer(text)]


def name_score(name: str) -> float:
    words = [w.lower() for w in PIECES.findall(name)]
    if not words or words[-1] in DESCRIBES:
        return 0.0
    if STRONG & set(words) or STRONG_PAIRS & set(zip(words, words[1:])):
        return 1.0
    return 0.5 if words[-1] in WEAK else 0.0


def literal_score(value: str) -> float:
    n = len(value)
    if n < LEAST_VALUE or REFERENCE.search(value) or PLACEHOLDER.search(value):
        return 0.0
    bits = -sum(c * log2(c / n) for c in Counter(value).values())
    plain = all(c.isalpha() or c.isspace() for c in value)
    return max(0.0, min(1.0, bits / FULL_BITS) - (0.5 if plain else 0.0))


class Value:
    """The literals (start, end) and names that a value expression holds."""

    def __init__(self):
        self.literals: list[tuple[int, int]] = []
        self.names: list[str] = []


def read_value(text: str, at: int) -> Value:
    """The value expression at ``at``."""
    out = Value()
    if m := SCHEME.match(text, at):
        at = m.end()
    while True:
        if (m := TRIPLE.match(text, at)) and (end := text.find(m[1], m.end())) >= 0:
            out.literals.append((m.end(), end))
            at = end + 3
        elif m := STRING.match(text, at):
            out.literals.append(m.span(m.lastindex))
            at = m.end()
            out.names += [r["a"] or r["b"] or r["c"] for r in REFERENCE.finditer(m[m.lastindex])]
        elif m := REFERENCE.match(text, at):
            out.names.append(m["a"] or m["b"] or m["c"])
            at = m.end()
        elif m := CALL.match(text, at):
            held = list(STRING.finditer(text, *m.span("args")))
            if LOOKUP.search(m["f"]) and held:
                out.names.append(held[0][held[0].lastindex])
                held = held[1:]
            out.literals += [s.span(s.lastindex) for s in held]
            out.names += [w for w in re.findall(NAME, STRING.sub(" ", m["args"]))]
            at = m.end()
        elif m := WORD.match(text, at):
            if IDENTIFIER.match(m[0]):
                out.names.append(m[0])
            out.literals.append(m.span())
            at = m.end()
        else:
            return out
        if not (m := JOIN.match(text, at)):
            return out
        at = m.end()


def read_pairs(text: str) -> list[tuple[str, Value]]:
    """All (target name, value) pairs of a text."""
    out, entry = [], None
    for m in PAIR.finditer(text):
        value = read_value(text, m.end())
        name = m["name"]
        if value.literals or value.names:
            out.append((name, value))
        # an entry of two parts: its name first, then its value
        if entry and name.lower() in ("value", "default") and not text[entry[1]:m.start()].strip("\"',;}/ \t\n"):
            out.append((entry[0], value))
        entry = None
        if name.lower() in ("key", "name") and value.literals:
            a, b = value.literals[0]
            entry = text[a:b], b
    for m in ELEMENT.finditer(text):
        value = Value()
        value.literals.append(m.span("value"))
        out.append((m["name"], value))
    for m in OPTION.finditer(text):
        out.append((m["name"], read_value(text, m.end())))
    return out


def literal_spans(text: str) -> list[tuple[int, int, str, float]]:
    """(start, end, target, score) of the literals that reach sensitive targets."""
    pairs = read_pairs(text)
    assigned: dict[str, list[Value]] = {}
    for name, value in pairs:
        assigned.setdefault(name, []).append(value)
        last = re.split(r"[.\-]", name)[-1]
        if last != name:
            assigned.setdefault(last, []).append(value)
    targets = sorted({(-s, n) for n, _ in pairs if (s := name_score(n)) > 0})
    best: dict[tuple[int, int], tuple[str, float]] = {}
    seen: set[str] = set()
    for negative, target in targets:         # the most sensitive targets first
        todo = [target]
        while todo:
            name = todo.pop()
            if name in seen:
                continue
            seen.add(name)
            for value in assigned.get(name, ()):
                known = [n for n in value.names if n in assigned or n.split(".")[-1] in assigned]
                todo += [n if n in assigned else n.split(".")[-1] for n in known]
                # the parts of a joined value are judged as one
                whole = "".join(text[a:b] for a, b in value.literals if text[a:b] not in known)
                score = -negative * literal_score(whole)
                for a, b in value.literals if score >= REPORT_AT else ():
                    if b > a and text[a:b] not in known:
                        best.setdefault((a, b), (target, score))
    return [(a, b, *v) for (a, b), v in best.items()]


def scan(text: str, lexed: bool = True) -> list[tuple[str, int, int, str | None, float | None]]:
    """(kind, start, end, target, score) of a text by start, kind, end."""
    base = base_spans(text)
    out = [(k, a, b, None, None) for k, a, b in base]
    if lexed:
        inside = sorted((a, b) for _, a, b in base)
        reach, top = [], -1                  # furthest end of the base spans so far
        for _, b in inside:
            top = max(top, b)
            reach.append(top)
        for a, b, name, score in literal_spans(text):
            k = _upto(inside, a)
            if not k or reach[k - 1] < b:
                out.append(("literal", a, b, name, score))
    return sorted(out, key=lambda f: (f[1], KINDS.index(f[0]), f[2]))


def _upto(spans: list[tuple[int, int]], at: int) -> int:
    """How many spans start at or before ``at``."""
    lo, hi = 0, len(spans)
    while lo < hi:
        mid = (lo + hi) // 2
        lo, hi = (mid + 1, hi) if spans[mid][0] <= at else (lo, mid)
    return lo


FINDING = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()),
                     ("target", pa.string()), ("score", pa.float64())])
SCHEMA = ("doc_id long, findings array<struct<kind: string, start: long, end: long, "
          "target: string, score: double>>")


def _findings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    keys = [f.name for f in FINDING]
    for table in sized(batches, TEXT_BYTES):
        texts = pc.fill_null(table.column("text"), "").combine_chunks()
        lexed = pc.match_substring_regex(texts, SENSITIVE)
        other = pc.or_(pc.match_substring(texts, "AKIA"),
                       pc.match_substring_regex(texts, "[0-9a-f]{24}"))
        found = [[] for _ in range(len(texts))]
        for i in pc.indices_nonzero(pc.or_(lexed, other)).to_pylist():
            found[i] = [dict(zip(keys, f)) for f in scan(texts[i].as_py(), lexed[i].as_py())]
        yield pa.RecordBatch.from_arrays(
            [table.column("doc_id").combine_chunks(), pa.array(found, pa.list_(FINDING))],
            names=["doc_id", "findings"])


def scan_secrets(documents: DataFrame) -> DataFrame:
    """doc_id and findings (kind, start, end, target, score) of every document row."""
    return documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        _findings, SCHEMA)
