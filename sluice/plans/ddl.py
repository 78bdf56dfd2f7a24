"""A subset of MySQL's CREATE TABLE as table specifications, and schema files' bytes as text."""

from __future__ import annotations

import re
from dataclasses import dataclass, field

from pyspark.sql import types as T

from ..functions.sqltext import unescape

# Integer widths in bits.
INTEGERS = {"tinyint": 8, "smallint": 16, "mediumint": 24, "int": 32, "integer": 32, "bigint": 64, "bool": 8, "boolean": 8, "year": 16}
SPARK_INTEGERS = {8: "tinyint", 16: "smallint", 24: "int", 32: "int", 64: "bigint"}
TEXTS = ("char", "varchar", "tinytext", "text", "mediumtext", "longtext", "json")
BINARIES = ("binary", "varbinary", "tinyblob", "blob", "mediumblob", "longblob")


@dataclass
class ColumnSpec:
    name: str
    sql_type: str
    base: str
    length: int | None = None
    precision: int = 10
    scale: int = 0
    unsigned: bool = False
    nullable: bool = True
    default: str | None = None  # as SQL text
    auto_increment: bool = False
    auto_random: int = 0
    generated: str | None = None
    stored: bool = False
    members: list[str] = field(default_factory=list)

    def family(self) -> str:
        if self.base in INTEGERS or self.base == "bit":
            return "integer"
        if self.base in ("decimal", "numeric", "dec", "fixed", "float", "double", "real"):
            return "real"
        if self.base in TEXTS or self.base == "time":
            return "text"
        if self.base in BINARIES:
            return "binary"
        if self.base in ("date", "datetime", "timestamp"):
            return "moment"
        if self.base in ("enum", "set"):
            return "members"
        raise ValueError(f"unsupported type {self.sql_type} of column `{self.name}`")

    def bits(self) -> int:
        return (self.length or 1) if self.base == "bit" else INTEGERS[self.base]

    def bounds(self) -> tuple[int, int]:
        n = self.bits()
        return (0, 2**n - 1) if self.unsigned or self.base == "bit" else (-(2 ** (n - 1)), 2 ** (n - 1) - 1)

    def spark_type(self) -> str:
        kind = self.family()
        if kind == "integer":
            need = self.bits() + (1 if self.unsigned or self.base == "bit" else 0)
            return next((SPARK_INTEGERS[w] for w in sorted(SPARK_INTEGERS) if need <= w), "decimal(20,0)")
        if kind == "real":
            if self.base in ("float", "double", "real"):
                return "float" if self.base == "float" else "double"
            if self.precision > 38:
                raise ValueError(f"DECIMAL of {self.precision} digits in `{self.name}`: Spark has 38 at most")
            return f"decimal({self.precision},{self.scale})"
        if kind == "moment":
            return {"date": "date", "datetime": "timestamp_ntz", "timestamp": "timestamp"}[self.base]
        return "binary" if kind == "binary" else "string"

    def zero(self) -> object:
        """What a lenient load puts for NULL in a NOT NULL column; None where Spark has no such value (moments)."""
        return {"integer": 0, "real": 0, "text": "", "binary": b"", "members": self.members[0] if self.base == "enum" and self.members else ""}.get(self.family())


@dataclass
class TableSpec:
    name: str
    columns: list[ColumnSpec]
    primary_key: list[str] = field(default_factory=list)
    uniques: list[list[str]] = field(default_factory=list)

    def column(self, name: str) -> ColumnSpec:
        return next(c for c in self.columns if c.name.lower() == name.lower())

    def schema(self) -> T.StructType:
        return T._parse_datatype_string(", ".join(f"`{c.name}` {c.spark_type()}" for c in self.columns))

    def implicit_row_id(self) -> bool:
        """Whether rows carry a hidden id: no primary key that is one integer column."""
        return not (len(self.primary_key) == 1 and self.column(self.primary_key[0]).family() == "integer")


_TOKEN = re.compile(r"\s+|--[^\n]*|#[^\n]*|/\*!\d*|\*/|/\*.*?\*/|(?P<quoted>'(?:[^'\\]|''|\\.)*'|\"(?:[^\"\\]|\"\"|\\.)*\")|(?P<name>`(?:[^`]|``)+`)|(?P<word>[\w$.]+)|(?P<mark>.)", re.S)


def _tokens(sql: str) -> list[tuple[str, str, int]]:
    """(kind, text, end) without white space and comments; the content of conditional comments counts."""
    return [(m.lastgroup, m[0], m.end()) for m in _TOKEN.finditer(sql) if m.lastgroup]


def _plain(token: tuple[str, str, int]) -> str:
    kind, text, _ = token
    if kind == "name":
        return text[1:-1].replace("``", "`")
    if kind == "quoted":
        return unescape(text[1:-1].replace(text[0] * 2, text[0]))
    return text


def _group(tokens: list, at: int) -> tuple[list, int]:
    """The tokens inside the parenthesis that opens at ``at``, and the place after it."""
    depth, k = 0, at
    while k < len(tokens):
        depth += {"(": 1, ")": -1}.get(tokens[k][1], 0) if tokens[k][0] == "mark" else 0
        k += 1
        if not depth:
            return tokens[at + 1 : k - 1], k
    raise ValueError("unbalanced parenthesis")


def _split(tokens: list) -> list[list]:
    out, depth = [[]], 0
    for t in tokens:
        depth += {"(": 1, ")": -1}.get(t[1], 0) if t[0] == "mark" else 0
        if t[1] == "," and not depth and t[0] == "mark":
            out.append([])
        else:
            out[-1].append(t)
    return [x for x in out if x]


def _text(tokens: list) -> str:
    return " ".join(t[1] for t in tokens)


def _column(tokens: list) -> tuple[ColumnSpec, bool, bool]:
    spec = ColumnSpec(_plain(tokens[0]), "", tokens[1][1].lower())
    k, given = 2, []
    if k < len(tokens) and tokens[k][1] == "(":
        inner, k = _group(tokens, k)
        given = [_plain(t) for t in inner if t[1] != ","]
    spec.sql_type = spec.base + (f"({','.join(given)})" if given else "")
    if spec.base in ("enum", "set"):
        spec.members = given
    elif spec.base in ("decimal", "numeric", "dec", "fixed"):
        spec.precision, spec.scale = int(given[0]) if given else 10, int(given[1]) if len(given) > 1 else 0
    elif given:
        spec.length = int(given[0]) if spec.base in (*TEXTS, *BINARIES, "bit") else None
    elif spec.base in ("char", "binary"):
        spec.length = 1
    primary = unique = False
    while k < len(tokens):
        word = tokens[k][1].upper() if tokens[k][0] == "word" else ""
        after = tokens[k + 1][1].upper() if k + 1 < len(tokens) else ""
        k += 1
        if word == "UNSIGNED":
            spec.unsigned = True
        elif word == "NOT" and after == "NULL":
            spec.nullable, k = False, k + 1
        elif word == "AUTO_INCREMENT":
            spec.auto_increment = True
        elif word == "AUTO_RANDOM":
            spec.auto_random = 5
            if after == "(":
                inner, k = _group(tokens, k)
                spec.auto_random = int(inner[0][1])
        elif word == "PRIMARY":
            primary, k = True, k + (after == "KEY")
            spec.nullable = False
        elif word == "UNIQUE":
            unique = True
        elif word in ("DEFAULT", "UPDATE"):
            start, sign = k, tokens[k][1] in "+-"
            k += 1 + sign
            if k < len(tokens) and tokens[k][1] == "(":
                _, k = _group(tokens, k)
            if word == "DEFAULT":
                spec.default = _text(tokens[start:k]).replace("- ", "-")
        elif word == "AS":
            inner, k = _group(tokens, k)
            spec.generated = _text(inner)
        elif word in ("STORED", "VIRTUAL"):
            spec.stored = word == "STORED"
    return spec, primary, unique


def parse_create_table(sql: str) -> TableSpec:
    """The table of the first CREATE TABLE in sql."""
    tokens = _tokens(sql)
    for k, t in enumerate(tokens):
        if t[1].upper() == "CREATE" and any(x[1].upper() == "TABLE" for x in tokens[k + 1 : k + 4]):
            break
    else:
        raise ValueError("no CREATE TABLE statement")
    k = next(j for j in range(k, len(tokens)) if tokens[j][1].upper() == "TABLE") + 1
    if tokens[k][1].upper() == "IF":
        k += 3
    start = next(j for j in range(k, len(tokens)) if tokens[j][1] == "(")
    names = [_plain(t) for t in tokens[k:start] if t[1] != "."]
    body, _ = _group(tokens, start)
    table = TableSpec(names[-1].split(".")[-1] if tokens[start - 1][0] == "word" else names[-1], [])
    for part in _split(body):
        words = [t[1].upper() if t[0] == "word" else "" for t in part]
        lead = next((w for w in words if w), "")
        if part[0][0] == "word" and lead in ("PRIMARY", "UNIQUE", "KEY", "INDEX", "FULLTEXT", "SPATIAL", "CONSTRAINT", "CHECK", "FOREIGN"):
            opens = [j for j, t in enumerate(part) if t[1] == "("]
            if not opens or "FOREIGN" in words or "CHECK" in words:
                continue
            inner, _ = _group(part, opens[0])
            keys = [_plain(x[0]) for x in _split(inner)]
            if "PRIMARY" in words:
                table.primary_key = keys
            elif "UNIQUE" in words:
                table.uniques.append(keys)
        else:
            spec, primary, unique = _column(part)
            table.columns.append(spec)
            if primary:
                table.primary_key = [spec.name]
            if unique:
                table.uniques.append([spec.name])
    for name in table.primary_key:
        table.column(name).nullable = False
    return table


def decode(raw: bytes, charset: str = "auto") -> str:
    """Schema files' bytes: utf8mb4, gb18030, binary (as they are), or auto (the first that fits)."""
    if charset == "binary":
        return raw.decode("utf-8", "surrogateescape")
    for name in {"utf8mb4": ["utf-8"], "gb18030": ["gb18030"], "auto": ["utf-8", "gb18030"]}[charset.lower()]:
        try:
            text = raw.decode(name)
        except UnicodeDecodeError:
            continue
        if "\ufffd" not in text:
            return text
    raise ValueError(f"invalid schema encoding, not {charset}")


def spark_create_table(table: TableSpec, full_name: str) -> str:
    """Spark DDL for a Parquet table of these columns; keys and ids go to table properties."""
    columns = ", ".join(f"`{c.name}` {c.spark_type()}" for c in table.columns)
    kept = {"primary_key": ",".join(table.primary_key), "uniques": ";".join(",".join(u) for u in table.uniques)}
    properties = ", ".join(f"'{k}' = '{v}'" for k, v in kept.items() if v)
    return f"CREATE TABLE IF NOT EXISTS {full_name} ({columns}) USING parquet" + (f" TBLPROPERTIES ({properties})" if properties else "")
