"""Secret scans: base patterns, and assignment-aware lexing of source and configuration syntax.

The lexer cuts a text into words, strings (with prefixes, escapes and triple quotes), comments, elements of XML, line ends and marks, each character once, and reads
assignments from them: ``name = value``, ``name: type = value``, ``"name": value``, ``name => value``, a value on the next, deeper line, ``<name>value</name>``, and
pairs of ``name``/``key`` and ``value`` entries. A value is a literal, literals joined by ``+`` or side by side, a call's string arguments (the first of
several is a name of the others), a template's text, or other names. Names are read with those of the blocks and lines that they are nested in. Comments aren't code.
Names hold constants: a name that is assigned another name takes over what that one holds. Each literal gets a score from the sensitive
words of the names that it reaches and from its own shape; literals that score ``LEAST_SCORE`` or more are spans of kind ``lex``, unless a base span
covers them. Base spans are kept as they are.

Edge cases: null text counts as empty, without spans. Of several assignments to a name, a later use takes the last one before
it. Whole texts are read, whatever their length, in time in proportion to it. A quote without its partner on the line, or a triple one without any, is a mark. Repeated rows get equal
results. Extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from .batches import freed, renamed, slices

LEAST_SCORE = 2.0
KINDS = ("assign", "access", "hex", "lex")
# The base patterns, and the words of a name that make it sensitive, with their weights.
ASSIGN = re.compile(r"""([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]+")
SENSITIVE = {"password": 2.0, "passwd": 2.0, "passphrase": 2.0, "pwd": 2.0, "secret": 2.0, "token": 1.5, "apikey": 2.0, "credential": 1.5, "credentials": 1.5, "private": 1.0, "key": 1.0, "auth": 1.0, "bearer": 1.5, "api": 1.0, "access": 0.5, "client": 0.5, "signing": 1.0, "salt": 0.5}

_NAME = re.compile(r"[A-Za-z_][A-Za-z0-9_]*+(?:[.-][A-Za-z0-9_]+)*+")
_TOKEN = re.compile(
    r"""(?P<space>[^\S\n]++)|(?P<line>\n)|(?P<comment>(?<![^\s;,(){}\[\]])(?:\#|//)[^\n]*+|(?<!\S)--(?=\s)[^\n]*+|<!--|/\*)"""
    r"""|(?P<element><(?P<tag>[A-Za-z_][\w.:-]*+)(?:\s[^<>]*+)?>(?P<body>[^<>]*+)</(?P=tag)\s*+>)"""
    r"""|(?P<triple>(?:(?<!\w)[A-Za-z]{1,2})?(?:\"{3}|'{3}))|(?P<string>(?:(?<![\w$])[A-Za-z]{1,2})?(?:"|(?<![\w])'))|(?P<ref>\$\{?[A-Za-z_][\w.]*+\}?)"""
    r"""|(?P<op>:=|=>|://|::|[=!<>]=|:|=)|(?P<word>[\w/.$-][\w+/.$-]*+)|(?P<mark>.)"""
)
_CLOSE = {'"': re.compile(r'[^"\\\n]*+(?:\\.[^"\\\n]*+)*+"'), "'": re.compile(r"[^'\\\n]*+(?:\\.[^'\\\n]*+)*+'")}
_LITERAL = re.compile(r"[A-Za-z0-9+/_.=-]++")
_HOLES = re.compile(r"\$?\{([^{}\n]*)\}")
_BLOCK = re.compile(r"[|>][+-]?")
_SETS = {"=", ":=", "=>", ":"}
_ENTRY, _HELD = {"name", "key", "id"}, {"value", "content", "default"}
_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])|[0-9]+")
_HEX_RUN = str.maketrans({c: "\x00" for c in "0123456789abcdef"})
_SENSITIVE = re.compile("|".join(sorted(SENSITIVE)))
_LETTERS = ("passw", "secret", "token", "api")


def name_score(name: str) -> float:
    """Sum of the weights of a name's words; snake, kebab and camel case all part words."""
    words = {x.lower() for x in _WORD.findall(name)}
    return sum(SENSITIVE.get(x, 0.0) for x in {x if x in SENSITIVE else x.removesuffix("s") for x in words})


def literal_score(literal: str) -> float:
    """Shape of a literal: long, mixed and dense ones look like secrets; prose and placeholders don't."""
    if len(literal) < 8 or re.search(r"\s", literal) or len(set(literal)) < 4:
        return -2.0
    counts = Counter(literal)
    entropy = -sum(n / len(literal) * math.log2(n / len(literal)) for n in counts.values())
    kinds = sum(any(f(c) for c in literal) for f in (str.islower, str.isupper, str.isdigit)) + (not literal.isalnum())
    return (entropy - 3.0) * 0.5 + (kinds - 2) * 0.5


class Tokens:
    """(kind, start, end) of a text's tokens, spaces and comments left out; a string's are those of what stands between its quotes."""

    def __init__(self, text: str):
        self.text, self.rows = text, []
        at, n, gone = 0, len(text), {}  # gone: up to where a closing mark is known to be missing
        while at < n:
            m = _TOKEN.match(text, at)
            kind, at = m.lastgroup, m.end()
            kind = "element" if kind in ("tag", "body") else kind
            if kind == "space":
                continue
            if kind == "comment":
                close = {"<!--": "-->", "/*": "*/"}.get(m[0])
                if close:
                    end = text.find(close, at) if gone.get(close, -1) < at else -1
                    if end < 0:
                        gone[close] = n
                    at = end + len(close) if end >= 0 else at
                continue
            if kind in ("triple", "string"):
                quote = m[0].lstrip("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ")
                prefix = m[0][: len(m[0]) - len(quote)].lower()
                end = -1
                if gone.get(quote, -1) < at:
                    if kind == "triple":
                        end = text.find(quote, at)
                        gone.update({quote: n} if end < 0 else {})
                    elif close := _CLOSE[quote].match(text, at):
                        end = close.end() - 1
                    else:
                        line = text.find("\n", at)
                        gone[quote] = line if line >= 0 else n
                if end >= 0:
                    self.rows.append(("template" if "f" in prefix or "$" in text[at:end] and "{" in text[at:end] else "string", at, end))
                    at = end + len(quote)
                    continue
                if prefix:
                    self.rows.append(("word", m.start(), m.start() + len(prefix)))
                self.rows.append(("mark", m.start() + len(prefix), at))
                continue
            if kind == "element":
                self.rows.append((kind, *m.span("body")))
                continue
            self.rows.append((kind, m.start(), at))

    def name(self, i: int) -> str | None:
        """The token as a name that can be assigned to."""
        if not 0 <= i < len(self.rows):
            return None
        kind, a, b = self.rows[i]
        if kind not in ("word", "string", "ref") or b - a > 200:
            return None
        x = self.text[a:b].strip("${}")
        return x if _NAME.fullmatch(x) else None


class Lexer:
    """Reads the assignments of a text.

    ``items`` has its literals, (start, end, content), and its assignments, (name, items that the name is given): those come later than what they give. A name that holds others is
    one item, however much it has gathered.
    """

    def __init__(self, text: str):
        self.text, self.t = text, Tokens(text)
        self.items: list[tuple] = []
        self.holds: dict[str, int] = {}
        self.entry: str | None = None
        blocks: list[tuple[str, ...]] = [()]  # the last two names of each open block
        lines: list[tuple[int, str]] = []
        rows, i, begin = self.t.rows, 0, True
        while i < len(rows):
            kind, a, b = rows[i]
            if kind == "line":
                begin, i = True, i + 1
                continue
            if begin:
                column = a - (text.rfind("\n", 0, a) + 1) if lines or self._is_set(i + 1) else 0
                while lines and lines[-1][0] >= column:
                    lines.pop()
            first, begin = begin, False
            if kind == "mark" and text[a] in "{[(":
                blocks.append(blocks[-1])
            elif kind == "mark" and text[a] in "}])":
                blocks[1 if len(blocks) == 1 else -1 :] = []
            elif kind == "element":
                tag = self._tag(a)
                self._give(tag, [self._literal(a + len(text[a:b]) - len(text[a:b].lstrip()), a + len(text[a:b].rstrip()))])
            elif self._is_set(i + 1) and (name := self.t.name(i)):
                path = [*blocks[-1], *[x for _, x in lines[-2:]]]
                i = self._assign(i, ".".join([*path, name]), name, column if first else None, blocks, lines)
                continue
            i += 1

    def _is_set(self, i: int) -> bool:
        rows = self.t.rows
        return i < len(rows) and rows[i][0] == "op" and self.text[rows[i][1] : rows[i][2]] in _SETS

    def _is(self, i: int, *marks: str) -> bool:
        rows = self.t.rows
        return i < len(rows) and rows[i][2] - rows[i][1] <= 4 and rows[i][0] != "string" and self.text[rows[i][1] : rows[i][2]] in marks

    def _tag(self, body: int) -> str:
        a = self.text.rfind("<", 0, body)
        return _TOKEN.match(self.text, a)["tag"]

    def _assign(self, i: int, path: str, name: str, column: int | None, blocks: list, lines: list) -> int:
        """Reads the value behind the name at ``i``; where to go on."""
        rows, text, j = self.t.rows, self.text, i + 2
        # name: type = value
        if self._is(i + 1, ":") and self.t.name(j) and j < len(rows) and rows[j][0] == "word" and self._is(j + 1, "=") and (text[rows[j][2]] in " \t" or text[rows[j + 1][2] : rows[j + 1][2] + 1] in ("'", '"')):
            j += 2
        if self._is(j, "{"):
            blocks.append((*blocks[-1][-1:], name))
            return j + 1
        if self._is(i + 1, ":") and column is not None and (j >= len(rows) or rows[j][0] == "line" or rows[j][0] in ("mark", "op") and _BLOCK.fullmatch(text[rows[j][1] : rows[j][2]]) and (j + 1 >= len(rows) or rows[j + 1][0] == "line" or self._is(j + 1, "-", "+"))):
            while j < len(rows) and rows[j][0] != "line":
                j += 1
            after = j
            while after < len(rows) and rows[after][0] == "line":
                after += 1
            if after >= len(rows) or rows[after][1] - (text.rfind("\n", 0, rows[after][1]) + 1) <= column:
                return j
            if self._is_set(after + 1) or self._is(after, "-"):
                lines.append((column, name))
                return j
            j = after
        start = j
        values, j = self._value(j)
        if name.lower() in _ENTRY and len(values) == 1 and len(self.items[values[0]]) == 3 and j == start + 1 and rows[start][0] in ("string", "word"):
            self.entry = self.items[values[0]][-1]
        elif name.lower() in _HELD and self.entry:
            path, self.entry = f"{path}.{self.entry}", None
        if values:
            self.holds[name] = self._give(path, values)
        return max(j, i + 2)

    def _literal(self, a: int, b: int, content: str | None = None) -> int:
        self.items.append((a, b, self.text[a:b] if content is None else content))
        return len(self.items) - 1

    def _give(self, name: str, values: list[int]) -> int:
        self.items.append((name, values))
        return len(self.items) - 1

    def best(self) -> list[tuple[tuple, str, float]]:
        """(literal, name, score) of the best name that each literal reaches, if any."""
        names, scores, out = [""] * len(self.items), [0.0] * len(self.items), []
        for k in range(len(self.items) - 1, -1, -1):
            item = self.items[k]
            if len(item) == 3:
                if scores[k] > 0:
                    out.append((item, names[k], scores[k]))
                continue
            if (own := name_score(item[0])) > scores[k]:
                names[k], scores[k] = item[0], own
            for x in item[1]:
                if scores[k] > scores[x]:
                    names[x], scores[x] = names[k], scores[k]
        return out

    def _value(self, j: int) -> tuple[list[int], int]:
        """(literals, where the value ends) of the expression at ``j``."""
        rows, text = self.t.rows, self.text
        out: list[int] = []
        run: list[tuple[int, int]] = []  # literals that make up one
        depth, more = 0, True
        while j < len(rows):
            kind, a, b = rows[j]
            if kind == "line":
                if not depth:
                    break
            elif kind == "string" and (more or run or depth):
                run.append((a, b))
                more = False
            elif kind == "template" and (more or run):
                holes = list(_HOLES.finditer(text, a, b))
                ends = [a, *[x for m in holes for x in m.span()], b]
                out += [self.holds[m[1].strip()] for m in holes if m[1].strip() in self.holds] + [self._literal(x, y) for x, y in zip(ends[::2], ends[1::2]) if y - x >= 8]
                more = False
            elif more and kind in ("word", "ref"):
                word = text[a:b]
                if self._is(j + 1, "(") and rows[j + 1][1] == b:
                    found, j = self._call(j + 2)
                    out += found
                    more = False
                    continue
                known = self.holds.get(word.strip("${}"))
                if known is not None:
                    out.append(known)
                elif self._is(j + 1, "|", "?", "or"):
                    pass
                elif word not in ("+", "-", "not", "new", "await", "return") and (m := _LITERAL.match(text, a)):
                    out.append(self._literal(*m.span()))
                    while j + 1 < len(rows) and rows[j + 1][1] < m.end():
                        j += 1
                else:
                    j += 1
                    continue
                more = False
            elif self._is(j, "("):
                depth += 1
            elif depth and self._is(j, ")"):
                depth -= 1
            elif self._is(j, "+", ".", "|", "&", "?", "or", "\\"):
                more = True
            else:
                break
            j += 1
        if run:
            joined = "".join(text[a:b] for a, b in run)
            out.append(self._literal(run[0][0], run[-1][1], joined))
        return out, j

    def _call(self, j: int) -> tuple[list[int], int]:
        """(literals among a call's arguments, where it ends); the first string of several is a name of the others. Calls end with their statement."""
        rows, text, depth, strings, out = self.t.rows, self.text, 1, [], []
        while j < len(rows) and depth:
            kind, a, b = rows[j]
            if self._is(j, "("):
                depth += 1
            elif self._is(j, ")"):
                depth -= 1
            elif kind == "line" and (self.t.name(j + 1) and self._is_set(j + 2) and not self._is(j - 1, ",", "(")) or self._is(j, ";"):
                break
            elif kind == "string":
                strings.append(self._literal(a, b))
            elif kind in ("word", "ref"):
                out += [self.holds[x]] if (x := text[a:b].strip("${}")) in self.holds else []
            j += 1
        if len(strings) > 1:
            self._give(self.items[strings[0]][2][:200], strings[1:])
            strings = strings[1:]
        return out + strings, j


def lex(text: str) -> list[tuple[int, int, str, float]]:
    """(start, end, best target name, score) of every literal that a sensitive name is assigned, in code points."""
    return sorted((a, b, name, score + literal_score(content)) for (a, b, content), name, score in Lexer(text).best() if a < b)


def scan(text: str | None) -> dict[str, list[tuple[int, int]]]:
    """Spans by kind, each in order of start."""
    text = text or ""
    found: dict[str, list[tuple[int, int]]] = {k: [] for k in KINDS}
    low = text.lower()
    if any(x in low for x in _LETTERS):
        found["assign"] = [m.span() for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 8]
    if "AKIA" in text:
        found["access"] = [m.span() for m in ACCESS.finditer(text) if m.end() - m.start() >= 16]
    if "\x00" * 32 in text.translate(_HEX_RUN):
        found["hex"] = [m.span() for m in HEX.finditer(text) if m.end() - m.start() >= 32]
    if _SENSITIVE.search(low) and ("=" in text or ":" in text or "</" in text):
        base = sorted(x for k in KINDS[:3] for x in found[k])
        found["lex"] = sorted({(a, b) for a, b, _, s in lex(text) if s >= LEAST_SCORE and not any(x <= a and b <= y for x, y in base)})
    return found


def joined(found: dict[str, list[tuple[int, int]]], kinds: tuple[str, ...]) -> str:
    rows = sorted((a, i, b) for i, k in enumerate(kinds) for a, b in found[k])
    return ",".join(f"{kinds[i]}:{a}:{b}" for a, i, b in rows)


def secret_spans(docs: DataFrame) -> DataFrame:
    """Per document: counts, the digest of its base spans, and all spans."""
    schema = pa.schema([("doc_id", pa.int64()), *[(f"n_{k}", pa.int64()) for k in KINDS], ("base_sha256", pa.string()), ("spans", pa.string())])

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                rows = []
                for doc, text in zip(part.column("doc_id").to_pylist(), part.column("text").to_pylist()):
                    found = scan(text)
                    rows.append((doc, *[len(found[k]) for k in KINDS], hashlib.sha256(joined(found, KINDS[:3]).encode()).hexdigest(), joined(found, KINDS)))
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows) if rows else [[]] * 7, schema)], schema=schema)

    return renamed(docs, "doc_id", "text").mapInArrow(freed(search), "doc_id long, n_assign long, n_access long, n_hex long, n_lex long, base_sha256 string, spans string")


def op10_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_spans(spark.read.parquet(f"{sf_dir}/documents.parquet"))
