"""Secret scan over a trigram inverted index.

From each rule's regular expression a Boolean query over trigrams is derived that every match
satisfies. A slice of documents is one segment of the index: its postings list, for each trigram
the rules ask for, the documents that have it. A query intersects and unites postings, and only
the documents it leaves are scanned with the expression; a rule without mandatory trigrams scans
all of them.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field
from re import _constants as C
from re import _parser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wardline.llm.common import arrow_map, as_text, slices, table

#: Strings that one piece of an expression may be spelt out to.
MAX_STRINGS = 96


@dataclass(frozen=True)
class Rule:
    """``group`` (0: the match) must have ``least`` characters; else the match is dropped, not searched again."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 0


# The base kinds, in the order in which equal starts are listed.
BASE = (
    Rule(
        "assign",
        r"""(?ai:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        2,
        12,
    ),
    Rule("access", r"AKIA[A-Z0-9]+", 0, 18),
    Rule("hex", r"[0-9a-f]+", 0, 16),
)
# The key to its END line; where there is none, its PEM headers and base64 lines. Breaks may be escaped.
_BREAK = r"(?:\s|\\[nr])"
_KEY = (
    r"-----BEGIN (?:[A-Z]+ )*PRIVATE KEY-----"
    r"(?:(?>(?:[^-]|-(?!----(?:BEGIN|END) ))*)-----END (?:[A-Z]+ )*PRIVATE KEY-----"
    rf"|(?:{_BREAK}*(?:Proc-Type|DEK-Info): ?[\w,-]+)*"
    rf"(?:(?:{_BREAK}+[A-Za-z0-9+/]{{24,}}={{0,2}})+(?:(?:[\r\n]|\\[nr])+[A-Za-z0-9+/]+={{0,2}}(?=\s*?(?:[\r\n\"']|\\[nr]|\Z)))?)?)"
)
MORE = (
    Rule("private_key", _KEY),
    Rule("github", r"gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("web_token", r"(?<![A-Za-z0-9_-])eyJ[A-Za-z0-9_-]{10,}+\.eyJ[A-Za-z0-9_-]{10,}+\.[A-Za-z0-9_-]{10,}+"),
    Rule("url_login", r"(?<![a-z0-9+.-])[0-9+.-]*+[a-z][a-z0-9+.-]*+://[^\s/:@]++:[^\s/@]++@"),
)
RULES = BASE + MORE


@dataclass(frozen=True)
class Query:
    """``op`` is ``any`` (all documents), ``tri``, ``and`` or ``or``."""

    op: str
    trigram: bytes = b""
    parts: tuple["Query", ...] = field(default=())


ANY = Query("any")


def all_of(parts: list[Query]) -> Query:
    parts = list(dict.fromkeys(p for p in parts if p != ANY))
    return ANY if not parts else parts[0] if len(parts) == 1 else Query("and", parts=tuple(parts))


def one_of(parts: list[Query]) -> Query:
    parts = list(dict.fromkeys(parts))
    return ANY if ANY in parts or not parts else parts[0] if len(parts) == 1 else Query("or", parts=tuple(parts))


def _of_string(s: bytes) -> Query:
    return all_of([Query("tri", s[i : i + 3]) for i in range(len(s) - 2)])


def _fold(s: str) -> bytes:
    return s.encode("utf-8", "surrogatepass").lower()  # bytes.lower folds ASCII alone


def derive(pattern: str) -> Query:
    """A query that every text with a match satisfies, on ASCII-lower-cased UTF-8 bytes."""
    tree = _parser.parse(pattern)
    folds = _may_fold_beyond_ascii(tree)
    return ANY if folds else _sequence(list(tree))


def _may_fold_beyond_ascii(tree) -> bool:
    ignoring = bool(tree.state.flags & C.SRE_FLAG_IGNORECASE)
    return ignoring and not tree.state.flags & C.SRE_FLAG_ASCII


def _sequence(nodes: list) -> Query:
    """Spell out runs of pieces with few strings; what lies between them asks for itself."""
    asked: list[Query] = []
    run: set[bytes] = {b""}

    def flush() -> None:
        nonlocal run
        asked.append(one_of([_of_string(s) for s in sorted(run)]))
        run = {b""}

    for node in nodes:
        strings = _strings(node)
        if strings is not None and len(run) * len(strings) <= MAX_STRINGS:
            run = {a + b for a in run for b in strings}
            continue
        flush()
        if strings is not None and len(strings) <= MAX_STRINGS:
            run = set(strings)
        else:
            asked.append(_asks(node))
    flush()
    return all_of(asked)


def _strings(node) -> set[bytes] | None:
    """All strings (folded) that a piece can match, or None if there are too many."""
    op, arg = node
    if op is C.LITERAL:
        return {_fold(chr(arg))}
    if op is C.AT or op in (C.ASSERT, C.ASSERT_NOT):
        return {b""}
    if op is C.IN:
        return _class(arg)
    if op is C.SUBPATTERN:
        _, added, _, inner = arg
        if added & C.SRE_FLAG_IGNORECASE and not added & C.SRE_FLAG_ASCII:
            return None
        return _product(list(inner))
    if op is C.BRANCH:
        out: set[bytes] = set()
        for branch in arg[1]:
            strings = _product(list(branch))
            if strings is None:
                return None
            out |= strings
        return out if len(out) <= MAX_STRINGS else None
    if op in (C.MAX_REPEAT, C.MIN_REPEAT, C.POSSESSIVE_REPEAT):
        low, high, inner = arg
        if high is C.MAXREPEAT or high > 4:
            return None
        once = _product(list(inner))
        if once is None:
            return None
        out, power = set(), {b""}
        for k in range(high + 1):
            if k >= low:
                out |= power
            power = {a + b for a in power for b in once}
            if len(out) + len(power) > MAX_STRINGS:
                return None
        return out
    return None


def _class(items: list) -> set[bytes] | None:
    out: set[bytes] = set()
    for op, arg in items:
        if op is C.LITERAL:
            out.add(_fold(chr(arg)))
        elif op is C.RANGE and arg[1] - arg[0] < MAX_STRINGS:
            out |= {_fold(chr(c)) for c in range(arg[0], arg[1] + 1)}
        else:
            return None
    return out if len(out) <= MAX_STRINGS else None


def _product(nodes: list) -> set[bytes] | None:
    out = {b""}
    for node in nodes:
        strings = _strings(node)
        if strings is None or len(out) * len(strings) > MAX_STRINGS:
            return None
        out = {a + b for a in out for b in strings}
    return out


def _asks(node) -> Query:
    """Query of a piece with too many strings."""
    op, arg = node
    if op is C.SUBPATTERN:
        _, added, _, inner = arg
        if added & C.SRE_FLAG_IGNORECASE and not added & C.SRE_FLAG_ASCII:
            return ANY
        return _sequence(list(inner))
    if op is C.BRANCH:
        return one_of([_sequence(list(b)) for b in arg[1]])
    if op in (C.MAX_REPEAT, C.MIN_REPEAT, C.POSSESSIVE_REPEAT) and arg[0] >= 1:
        return _sequence(list(arg[2]) * min(arg[0], 2))
    return ANY


def trigrams_of(query: Query) -> set[bytes]:
    return {query.trigram} if query.op == "tri" else set().union(*map(trigrams_of, query.parts))


class Segment:
    """Postings of some documents: for each trigram of the rules the sorted numbers of those that have it."""

    def __init__(self, data: np.ndarray, begins: np.ndarray, wanted: list[bytes]):
        self.everyone = np.arange(len(begins) - 1)
        folded = np.where((data >= 65) & (data <= 90), data + 32, data).astype(np.uint32)
        code = (folded[:-2] << 16) | (folded[1:-1] << 8) | folded[2:] if len(folded) > 2 else folded[:0]
        known = np.zeros(1 << 24, bool) if len(code) > 1 << 20 else None
        numbers = np.array([int.from_bytes(t, "big") for t in wanted], np.uint32)
        order = np.argsort(numbers)
        if known is not None:
            known[numbers] = True
            at = np.flatnonzero(known[code])
        else:
            at = np.flatnonzero(np.isin(code, numbers))
        doc = np.searchsorted(begins, at, side="right") - 1
        inside = at + 3 <= begins[doc + 1]
        which = np.searchsorted(numbers[order], code[at[inside]])
        pairs = np.unique(which.astype(np.int64) * len(begins) + doc[inside])
        cuts = np.searchsorted(pairs, np.arange(len(wanted) + 1) * len(begins))
        self.postings = {
            wanted[order[i]]: pairs[cuts[i] : cuts[i + 1]] - i * len(begins) for i in range(len(wanted))
        }

    def candidates(self, query: Query) -> np.ndarray:
        if query.op == "any":
            return self.everyone
        if query.op == "tri":
            return self.postings[query.trigram]
        parts = [self.candidates(p) for p in query.parts]
        if query.op == "or":
            return np.unique(np.concatenate(parts))
        parts.sort(key=len)
        out = parts[0]
        for p in parts[1:]:
            out = np.intersect1d(out, p, assume_unique=True)
        return out


def _segment(column: pa.Array, wanted: list[bytes]) -> Segment:
    raw = column.cast(pa.binary())
    _, offsets, data = raw.buffers()
    begins = np.frombuffer(offsets, np.int32)[raw.offset : raw.offset + len(raw) + 1].astype(np.int64)
    text = np.frombuffer(data, np.uint8)[begins[0] : begins[-1]] if data is not None else np.zeros(0, np.uint8)
    return Segment(text, begins - begins[0], wanted)


def finder(rules: tuple[Rule, ...]) -> Callable[[pa.Array], list[list[tuple[int, int, int]]]]:
    """What finds ``(begin, rank, end)`` in each text of a column that makes a segment."""
    queries = [derive(r.pattern) for r in rules]
    wanted = sorted(set().union(*map(trigrams_of, queries)))

    def find(column: pa.Array) -> list[list[tuple[int, int, int]]]:
        texts = as_text(column)
        segment = _segment(column, wanted)
        found: list[list] = [[] for _ in texts]
        for rank, rule in enumerate(rules):
            for d in segment.candidates(queries[rank]).tolist():
                for m in re.finditer(rule.pattern, texts[d]):
                    a, b = m.span(rule.group)
                    if b - a >= rule.least:
                        found[d].append((m.start(), rank, m.end()))
        return [sorted(f) for f in found]

    return find


def scan(docs: DataFrame, key: str = "doc_id", text: str = "text", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """``(key, spans)`` for every row: all finds ``(kind, begin, end, rank)`` in code points, end exclusive.

    Finds of one rule are the leftmost non-overlapping matches that are long enough; finds of
    different rules may overlap. They stand by begin, then in the order of the rules. The whole
    text is scanned; null texts have no finds. No shuffle: every slice of rows is its own segment.
    """
    find = finder(rules)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fields = [("kind", pa.string()), ("begin", pa.int64()), ("end", pa.int64()), ("rank", pa.int64())]
        kind = pa.list_(pa.struct(fields))
        for batch in slices(batches, "text", rows=4096):
            rows = [
                [{"kind": rules[k].kind, "begin": a, "end": b, "rank": k} for a, k, b in found]
                for found in find(batch.column("text"))
            ]
            yield pa.RecordBatch.from_pydict({"key": batch.column("key"), "spans": pa.array(rows, kind)})

    picked = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
    kind = dict(picked.dtypes)["key"]
    schema = f"key {kind}, spans array<struct<kind:string,begin:bigint,end:bigint,rank:bigint>>"
    return arrow_map(picked, run, schema).withColumnRenamed("key", key)


def redact(text: str, spans: list[tuple[int, int]], mask: str = "[SECRET]") -> str:
    """``text`` with every span replaced; overlapping and touching spans make one mask."""
    out, at, until = [], 0, -1
    for begin, end in sorted(spans):
        if begin > until:
            out += [text[at:begin], mask]
        until = max(until, end)
        at = until
    return "".join([*out, text[at:]])


def redacted(docs: DataFrame, text: str = "text", rules: tuple[Rule, ...] = RULES, length: str | None = None) -> DataFrame:
    """All rows and columns of ``docs`` with the finds in ``text`` masked; ``length``: a column with its length.

    Null texts stay null; a text without finds stays as it is.
    """
    find = finder(rules)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, text, rows=4096):
            old, at = batch.column(text).to_pylist(), batch.schema.get_field_index(text)
            spans = find(batch.column(text))
            new = [t if t is None or not s else redact(t, [(a, b) for a, _, b in s]) for t, s in zip(old, spans)]
            batch = batch.set_column(at, batch.schema.field(at), pa.array(new, batch.column(text).type))
            if length and any(spans):
                at = batch.schema.get_field_index(length)
                lengths = [n if not s else len(t) for n, t, s in zip(batch.column(length).to_pylist(), new, spans)]
                batch = batch.set_column(at, batch.schema.field(at), pa.array(lengths, batch.column(length).type))
            yield batch

    return arrow_map(docs, run, ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema))


def _listed(spans):
    return F.concat_ws(
        ",",
        F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["begin"].cast("string"), s["end"].cast("string"))),
    )


def op2_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets in every document: counts of the base kinds, digest of their spans, all spans."""
    found = scan(table(spark, sf_dir, "documents"))
    base = F.filter("spans", lambda s: s["rank"] < len(BASE))
    count = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    return found.select(
        "doc_id",
        *(count(r.kind) for r in BASE),
        F.sha2(_listed(base), 256).alias("base_sha256"),
        _listed(F.col("spans")).alias("spans"),
    )
