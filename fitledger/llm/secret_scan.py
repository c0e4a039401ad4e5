"""Secrets in texts: assignments are lexed into names and literals, constants followed, literals judged by their names.

Two sets of spans come out, in code points, ends exclusive. The *base* spans are those of three patterns: ``assign``, ``access``
and ``hex``. The *added* spans, of kind ``literal``, are literals that reach a sensitive name. Lines of source or
configuration are cut into strings, names, operators and bare values; ``name = value``, ``name: value``, ``"name": value``,
``name => value``, ``name := value``, ``box["name"] = value`` and ``--name value`` make a pair, with an optional
declared type in between. A value is one literal, a name that an earlier pair of the text has set, or a
concatenation of these; so a literal may be found where a constant is defined and judged where it is used. The
judgement multiplies how sensitive the name's words are by how much the literal looks like a key.
"""

from __future__ import annotations

import math
import re
from bisect import bisect_right
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from fitledger.llm.words import slices

SPANS = "array<struct<kind:string,start:long,end:long>>"
KINDS = ("assign", "access", "hex", "literal")
LEAST_VALUE, LEAST_SCORE = 8, 0.5
# A value put together from more literals is carried as a whole, not piece by piece.
MOST_PIECES = 64
# Characters at the ends of such a value that are kept: more than any placeholder has.
REACH = 16

_OPERATOR = re.compile("[:=]")
_OPERATOR_OR_FLAG = re.compile("[:=]|--[A-Za-z]")
_ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII | re.IGNORECASE)
_ACCESS = re.compile("AKIA[A-Z0-9]{12,}")
_HEX = re.compile("[0-9a-f]{32,}")

# Words that make a name sensitive, with weights; pairs of words; endings that speak about a secret without holding one.
_SENSITIVE = {"password": 1.0, "passwd": 1.0, "pwd": 1.0, "passphrase": 1.0, "passcode": 1.0, "secret": 1.0, "secrets": 1.0,
              "token": 1.0, "apikey": 1.0, "credential": 0.9, "credentials": 0.9, "bearer": 0.9, "authorization": 0.8}
_SENSITIVE_PAIRS = {("api", "key"), ("access", "key"), ("private", "key"), ("secret", "key"), ("signing", "key"),
                    ("encryption", "key"), ("master", "key"), ("account", "key"), ("auth", "key"), ("shared", "key"),
                    ("client", "key"), ("license", "key"), ("webhook", "key"), ("auth", "cookie"), ("session", "key")}
_ABOUT = {"type", "count", "counts", "length", "len", "name", "field", "file", "path", "url", "uri", "id", "ids", "policy",
          "label", "prompt", "hint", "expiry", "expires", "ttl", "size", "limit", "budget", "version", "regex", "pattern",
          "format", "env", "header", "index", "class", "min", "max", "algorithm", "placeholder", "title", "text"}
_PLACEHOLDERS = re.compile(r"changeme|change_me|example|sample|dummy|placeholder|your|insert|redacted|todo|fixme|xxxx|\*\*\*|"
                           r"\.\.\.|lorem|foobar|null|undefined|none|true|false|test|default|12345678", re.IGNORECASE)
_UNFIT = re.compile(r"\s|\$\{|\{\{|://|" + _PLACEHOLDERS.pattern, re.IGNORECASE)
_STARTS = re.compile(r"[$<{%(/~]|\./")
_DECLARING = {"export", "const", "let", "var", "val", "final", "static", "public", "private", "protected", "readonly", "set",
              "string", "str", "auto", "my", "local", "global", "define", "setenv"}

_TOKENS = r'''
    (?P<string>STRINGS)
  | (?P<flag>--[A-Za-z][A-Za-z0-9_-]*)
  | (?P<name>[$@]?\{?[^\W\d][\w]*(?:[.-][^\W\d][\w]*)*\}?)
  | (?P<op>:=|=>|==+|!=|<=|>=|::|:(?=//)|[:=])
  | (?P<bare>[A-Za-z0-9][A-Za-z0-9+/_=~!@%^&*.-]*)
  | (?P<other>[^\s])
'''
_STRINGS = {'"': r'"(?:[^"\\\n]|\\.)*"', "'": r"'(?:[^'\\\n]|\\.)*'", "`": r"`(?:[^`\\\n]|\\.)*`"}
_BARE = re.compile(r"""[^\s"'`,;()\[\]{}<>]+""")
_FLAGGED = re.compile(r" \s*(?![-=:\s])")
_TYPED = re.compile(r"\s*[A-Za-z_][\w.\[\]|?]*\s*=(?![=>])")
_PAIRING = {":=", "=>", ":", "="}
_JOINING = {"+", ".", "&"}
_CAMEL = re.compile(r"[A-Z]+(?=[A-Z][a-z])|[A-Z]?[a-z]+|[A-Z]+|[0-9]+")


def sensitivity(name: str) -> float:
    """How sensitive a name is, from 0 to 1, by the words in it."""
    words = [w.lower() for w in _CAMEL.findall(name)]
    if not words or words[-1] in _ABOUT:
        return 0.0
    pairs = any(pair in _SENSITIVE_PAIRS for pair in zip(words, words[1:]))
    return 1.0 if pairs else max(_SENSITIVE.get(w, 0.0) for w in words)


def key_likeness(value: str, quoted: bool) -> float:
    """How much a literal looks like a key, from 0 to 1: by kinds of characters, their entropy and length.

    White space, references to variables and placeholders give 0, and so does a bare value without a digit.
    """
    if len(value) < LEAST_VALUE or _UNFIT.search(value) or _STARTS.match(value):
        return 0.0
    return _likeness(len(value), Counter(value), quoted)


def _likeness(length: int, counts: Counter, quoted: bool) -> float:
    """The same from the number of each character, for a value that has passed the other tests."""
    letters = "".join(counts)
    kinds = sum(bool(re.search(p, letters)) for p in ("[a-z]", "[A-Z]", "[0-9]", "[^A-Za-z0-9]"))
    if not quoted and not (re.search("[0-9]", letters) and re.search("[A-Za-z]", letters)):
        return 0.0
    shares = [n / length for n in counts.values()]
    entropy = -sum(share * math.log2(share) for share in shares if share)
    return min(1.0, 0.25 * kinds + 0.15 * min(entropy, 4.0) + (0.1 if length >= 16 else 0.0) - 0.2)


def _lines(text: str, wanted: re.Pattern) -> Iterator[tuple[int, str]]:
    """(offset, line) of the lines with a match."""
    at = 0
    while (match := wanted.search(text, at)) is not None:
        start = max(at, text.rfind("\n", at, match.start()) + 1)
        end = text.find("\n", match.end())
        end = len(text) if end < 0 else end
        yield start, text[start:end]
        at = end


@lru_cache(maxsize=None)
def _pattern(quotes: str) -> re.Pattern:
    """The tokens of a line in which only these quotes still open strings."""
    return re.compile(_TOKENS.replace("STRINGS", "|".join(_STRINGS[q] for q in quotes) or "(?!)"), re.VERBOSE)


class _Line:
    """The tokens of a line. A quote that nothing closes opens no string, nor does any later one of its kind."""

    def __init__(self, text: str):
        self.text, self.quotes = text, "\"'`"

    def token(self, begin: int) -> re.Match | None:
        match = _pattern(self.quotes).search(self.text, begin)
        if match is not None and match.group() in self.quotes:
            self.quotes = self.quotes.replace(match.group(), "")
        return match


# A piece is (start, end, value, quoted): a literal of the text that is part of a value.
Piece = tuple[int, int, str, bool]


class Joined:
    """Many pieces in a row as one: what they were put together from, and what judging needs to know of the whole.

    A value that takes itself up again and again has exponentially many pieces, but few parts, each of them held once.
    """

    __slots__ = ("parts", "length", "counts", "quoted", "head", "tail", "unfit", "listed")

    def __init__(self, parts: list[Piece | Joined]):
        self.parts, self.length, self.counts, self.quoted = parts, 0, Counter(), True
        self.head, self.tail, self.unfit, self.listed = "", "", False, False
        for part in parts:
            if isinstance(part, Joined):
                length, counts, quoted, head, tail, unfit = (
                    part.length, part.counts, part.quoted, part.head, part.tail, part.unfit)
            else:
                value, quoted = part[2], part[3]
                length, counts, head, tail = len(value), Counter(value), value[:REACH], value[-REACH:]
                unfit = _UNFIT.search(value) is not None
            # What makes a value unfit is shorter than the ends, so it lies inside a part or where ends meet.
            self.unfit = self.unfit or unfit or _UNFIT.search(self.tail + head) is not None
            self.head, self.tail = (self.head + head)[:REACH] if len(self.head) < REACH else self.head, (self.tail + tail)[-REACH:]
            self.length, self.quoted = self.length + length, self.quoted and quoted
            for letter, n in counts.items():
                self.counts[letter] += n

    def key_likeness(self) -> float:
        if self.length < LEAST_VALUE or self.unfit or _STARTS.match(self.head):
            return 0.0
        return _likeness(self.length, self.counts, self.quoted)


def _folded(pieces: list[Piece | Joined]) -> list[Piece | Joined]:
    return [Joined(pieces)] if len(pieces) > MOST_PIECES else pieces


def _whole_likeness(pieces: list[Piece | Joined]) -> float:
    """How much the whole value looks like a key."""
    if any(isinstance(p, Joined) for p in pieces):
        return Joined(pieces).key_likeness()
    return key_likeness("".join(p[2] for p in pieces), all(p[3] for p in pieces))


def _spans(pieces: list[Piece | Joined]) -> Iterator[tuple[int, int]]:
    """(start, end) of the literals that aren't empty; those of joined pieces only when first asked for."""
    left = list(pieces)
    while left:
        part = left.pop()
        if not isinstance(part, Joined):
            if part[2]:
                yield part[0], part[1]
        elif not part.listed:
            part.listed = True
            left += part.parts


def _value(tokens: _Line, at: int, begin: int, known: dict[str, list[Piece | Joined]]) -> tuple[list[Piece | Joined], int]:
    """The pieces of the value that starts at ``begin``, and where it ends."""
    line, pieces = tokens.text, []
    while True:
        pieces = _folded(pieces)
        match = tokens.token(begin)
        if match is None:
            return pieces, len(line)
        if match.lastgroup == "string":
            pieces.append((at + match.start() + 1, at + match.end() - 1, match.group()[1:-1], True))
            begin = match.end()
        elif match.lastgroup == "name" and match.group().strip("$@{}") in known:
            pieces = pieces + known[match.group().strip("$@{}")]
            begin = match.end()
        elif match.lastgroup in ("name", "bare") and not pieces:
            bare = _BARE.match(line, match.start())
            if bare is None or line[bare.end():bare.end() + 1] in ("(", "["):
                return pieces, match.end()
            value = bare.group().rstrip(".,;:!?")
            if value:
                pieces.append((at + bare.start(), at + bare.start() + len(value), value, False))
            begin = bare.end()
        elif match.group() in ("{", "[", "("):
            return pieces, match.end()
        else:
            return pieces, match.start()
        follows = tokens.token(begin)
        if follows is None:
            return pieces, len(line)
        if follows.group() not in _JOINING:
            return pieces, begin
        begin = follows.end()


def name_literal_pairs(text: str) -> Iterator[tuple[str, list[Piece | Joined]]]:
    """(name, pieces of its value) of all assignments, line by line; names resolve to what earlier lines set.

    However many pieces a value has, it is followed and comes out; many are joined into one.
    """
    known: dict[str, list[Piece | Joined]] = {}
    for at, line in _lines(text, _OPERATOR_OR_FLAG):
        tokens, begin = _Line(line), 0
        names: list[str] = []           # what may be the target: the last name, string or subscript, and a declared type
        while (match := tokens.token(begin)) is not None:
            begin, token, group = match.end(), match.group(), match.lastgroup
            if group == "string":
                names = [token[1:-1]]
            elif group == "name":
                names = [token] if token.lower() in _DECLARING or not names else [*names[-1:], token]
            elif group == "flag":
                names = [token[2:]]
                if _FLAGGED.match(line, begin):
                    pieces, begin = _value(tokens, at, begin, known)
                    if pieces:
                        yield names[0], pieces
                    names = []
            elif group == "op" and token in _PAIRING and names:
                # "name: type = value" is an assignment to the first name.
                typed = _TYPED.match(line, begin) if token == ":" else None
                if typed:
                    begin = typed.end()
                pieces, begin = _value(tokens, at, begin, known)
                name = names[-1].strip("$@{}")
                known.pop(name, None)
                if pieces:
                    known[name] = _folded(pieces)
                    yield name, known[name]
                names = []
            elif token == "]":
                pass
            elif group != "other" or token not in "[":
                names = []


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, end, kind) of the matches of the three patterns, leftmost and non-overlapping for each kind."""
    spans = []
    # No match of the first pattern crosses a line, and none is in a line without an operator.
    for at, line in _lines(text, _OPERATOR):
        spans += [(at + m.start(), at + m.end(), 0) for m in _ASSIGN.finditer(line) if len(m.group(2)) >= LEAST_VALUE]
    spans += [(*m.span(), 1) for m in _ACCESS.finditer(text)]
    spans += [(*m.span(), 2) for m in _HEX.finditer(text)]
    return sorted(spans, key=lambda s: (s[0], s[2]))


def secret_spans(text: str) -> list[tuple[int, int, int]]:
    """The base spans and the literals of sensitive names that none of them holds, by start, then kind."""
    spans = base_spans(text)
    added: set[tuple[int, int]] = set()
    for name, pieces in name_literal_pairs(text):
        weight = sensitivity(name)
        if not weight:
            continue
        if weight * _whole_likeness(pieces) >= LEAST_SCORE:
            added.update(_spans(pieces))
    reach, starts = [], []
    top = 0
    for start, end, _ in spans:
        top = max(top, end)
        starts.append(start)
        reach.append(top)
    for start, end in sorted(added):
        before = bisect_right(starts, start)
        if not before or reach[before - 1] < end:
            spans.append((start, end, 3))
    return sorted(spans, key=lambda s: (s[0], s[2]))


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in slices(batch, "text"):
            found = [[{"kind": KINDS[k], "start": s, "end": e} for s, e, k in secret_spans(text)] if text else []
                     for text in part.column("text").to_pylist()]
            kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))
            yield pa.RecordBatch.from_arrays([part.column("id"), pa.array(found, kind)], ["id", "spans"])


def find_secrets(documents: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row (id, spans) for each document: all spans (kind, start, end) by start, then kind as in ``KINDS``.

    Offsets count code points of the whole text; there is no prefix, window or limit. Each document is on its own: no
    shuffle, one slice of some 0.5 MB (one text at least) at a time. Null and empty texts have no spans. Null ids and
    repeated rows stay as they are, each with its own result; other columns are ignored; an empty table gives no rows.
    """
    kind = documents.schema[id_column].dataType.simpleString()
    rows = documents.select(F.col(id_column).alias("id"), F.col(text_column).alias("text"))
    return rows.mapInArrow(_scan, f"id {kind}, spans {SPANS}").withColumnRenamed("id", id_column)
