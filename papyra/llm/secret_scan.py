"""Secrets in source, configuration and prose: fixed patterns and an assignment-aware lexer.

Base patterns (fixed values) give spans of kinds assign, access and hex: whole matches, leftmost and
non-overlapping per kind, too short ones dropped after matching.

The lexer (``assignments``) reads a text as name-literal pairs of the usual source and configuration syntaxes, with
constants put in where they are used. A literal is scored by the words of the
name that receives it and by its own strength; from ``LEAST_SCORE`` on it is a span of kind lex, unless a
base span covers it. Pairs within a literal that was found add nothing.

Positions are code points, ends exclusive. Null texts are empty. Each row is scanned by itself, so
repeated rows give repeated results, and an empty table gives none. Other columns pass through.
"""

from __future__ import annotations

import math
import re
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from papyra.llm import assignments
from papyra.llm import textbytes as tb
from papyra.llm.ship import ship

# Base patterns and least lengths.
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.A | re.I)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{16,}")  # runs of 16 or more, as runs are taken whole
LEAST_ASSIGN, LEAST_ACCESS, LEAST_HEX = 12, 18, 16
KINDS = ("assign", "access", "hex", "lex")

NAME_WORD = re.compile(r"[A-Z]+(?![a-z])|[A-Z]?[a-z]+", re.A)
# Words of names and their weights, alone and in pairs.
SENSITIVE = {
    "password": 1.0, "passwd": 1.0, "passphrase": 1.0, "pwd": 0.9, "secret": 1.0, "token": 0.9,
    "apikey": 1.0, "credential": 0.9, "credentials": 0.9, "bearer": 0.8, "auth": 0.6,
}
SENSITIVE_PAIRS = {
    ("api", "key"), ("access", "key"), ("private", "key"), ("signing", "key"), ("encryption", "key"),
    ("secret", "key"), ("account", "key"), ("auth", "key"), ("master", "key"),
}
STEMS = (b"passw", b"passphrase", b"pwd", b"secret", b"token", b"apikey", b"api_key", b"credential", b"bearer", b"auth", b"key")
PLACEHOLDER = re.compile(r"(?i)x{4,}|\*{3,}|example|changeme|your[_-]|placeholder|redacted|dummy|<[^>]*>|\$\{")
LEAST_SCORE = 0.5
LEAST_LITERAL = 8


def name_weight(name: str) -> float:
    words = [w.lower() for w in NAME_WORD.findall(name)]
    best = max((SENSITIVE.get(w, 0.0) for w in words), default=0.0)
    if any(pair in SENSITIVE_PAIRS for pair in zip(words, words[1:])):
        best = 1.0
    return best


def literal_strength(text: str) -> float:
    """0 for what cannot be a secret, else up to 1 by length, kinds of characters and entropy."""
    if len(text) < LEAST_LITERAL or not re.search("[0-9]", text) or re.search(r"\s", text) or PLACEHOLDER.search(text):
        return 0.0
    kinds = sum(bool(re.search(k, text)) for k in ("[a-z]", "[A-Z]", "[0-9]", "[^A-Za-z0-9]"))
    if kinds < 2:
        return 0.0
    n = len(text)
    entropy = -sum(c / n * math.log2(c / n) for c in Counter(text).values())
    return min(1.0, entropy / 3.5) * min(1.0, 0.5 + n / 32)


def base_spans(text: str) -> list[tuple[int, int, str]]:
    """(start, kind number, end)"""
    found = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= LEAST_ASSIGN]
    found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= LEAST_ACCESS]
    found += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(found)


def lexed_spans(text: str) -> list[tuple[int, int, str, float]]:
    """(start, end, receiving name, score) of literals that a sensitive name receives."""
    found: dict[tuple[int, int], tuple[str, float]] = {}
    covered, taken = 0, set()
    for name, start, end, value in assignments.pairs(text):
        weight = name_weight(name)
        if not weight or ((start, end) not in found and (end <= covered or start in taken)):
            continue
        score = weight * literal_strength(value)
        if score >= LEAST_SCORE:
            if score > found.get((start, end), ("", 0.0))[1]:
                found[start, end] = (name, round(score, 4))
            taken.add(start)
            covered = max(covered, end)
    return sorted((a, b, *x) for (a, b), x in found.items())


def scan_text(text: str) -> list[tuple[str, int, int, str, float]]:
    """(kind, start, end, name, score), by start and kind."""
    base = base_spans(text)
    out = [(a, k, b, "", 1.0) for a, k, b in base]
    for a, b, name, score in lexed_spans(text):
        if not any(x <= a and b <= y for x, _, y in base):
            out.append((a, 3, b, name, score))
    return [(KINDS[k], a, b, name, score) for a, k, b, name, score in sorted(out)]


_HEX_BYTE = np.zeros(256, bool)
_HEX_BYTE[list(b"0123456789abcdef")] = True


def _candidates(column: pa.Array) -> list[int]:
    """Rows whose text can hold a span; all others are surely clean."""
    data, offsets = tb.text_buffer(column)
    begins, ends = tb.edges(_HEX_BYTE[data], offsets)
    long_runs = begins[ends - begins >= LEAST_HEX]
    chosen = set((np.searchsorted(offsets, long_runs, side="right") - 1).tolist())
    raw = data.tobytes()
    low = raw.lower()
    places = offsets.tolist()
    for i, (a, b) in enumerate(zip(places, places[1:])):
        if i not in chosen and (
            raw.find(b"AKIA", a, b) >= 0 or any(low.find(s, a, b) >= 0 for s in STEMS)
        ):
            chosen.add(i)
    return sorted(chosen)


SPANS = pa.list_(pa.struct([
    ("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("name", pa.string()), ("score", pa.float64())]))


def scan(docs: DataFrame, text_column: str = "text") -> DataFrame:
    """The rows with their spans added (or replaced) in ``secrets``: array of kind, start, end, name, score."""
    ship(docs.sparkSession)
    docs = docs.drop("secrets")
    place = docs.columns.index(text_column)

    def run(batches):
        for batch in batches:
            for part in tb.slices(batch, text_column):
                column = part.column(place)
                found = [[]] * part.num_rows
                for i in _candidates(column):
                    found[i] = scan_text(column[i].as_py())
                spans = pa.array([[dict(zip(("kind", "start", "end", "name", "score"), s)) for s in f] for f in found], SPANS)
                yield pa.RecordBatch.from_arrays([*part.columns, spans], names=[*part.schema.names, "secrets"])

    kind = "array<struct<kind:string,start:long,end:long,name:string,score:double>>"
    return docs.mapInArrow(run, _with(docs, "secrets", kind))


def _with(docs: DataFrame, name: str, kind: str):
    schema = docs.schema
    return T.StructType([*schema.fields, T.StructField(name, T.DataType.fromDDL(kind))])


def redact(docs: DataFrame, mark: str = "[SECRET]") -> DataFrame:
    """The rows with every span of ``text`` replaced by a mark; ``n_chars`` follows if it is there."""
    ship(docs.sparkSession)
    place = docs.columns.index("text")

    def run(batches):
        for batch in batches:
            for part in tb.slices(batch, "text"):
                column = part.column(place)
                changed = {}
                for i in _candidates(column):
                    text = column[i].as_py()
                    if spans := scan_text(text):
                        changed[i] = _masked(text, spans, mark)
                if changed:
                    texts = [changed.get(i, x) for i, x in enumerate(column.to_pylist())]
                    columns = list(part.columns)
                    columns[place] = pa.array(texts, column.type)
                    part = pa.RecordBatch.from_arrays(columns, names=part.schema.names)
                yield part

    out = docs.mapInArrow(run, docs.schema)
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.when(F.col("text").isNull(), F.col("n_chars")).otherwise(F.length("text").cast(docs.schema["n_chars"].dataType)))
    return out


def _masked(text: str, spans, mark: str) -> str:
    out, at = [], 0
    for _, a, b, *_ in spans:
        if a >= at:
            out += [text[at:a], mark]
        at = max(at, b)
    return "".join(out) + text[at:]


def digest(scanned: DataFrame) -> DataFrame:
    """Counts per base kind, a digest of the base spans, and all spans as text."""
    shown = lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))
    base = F.filter("secrets", lambda s: s["kind"] != "lex")
    count = lambda k: F.size(F.filter("secrets", lambda s: s["kind"] == k)).cast("long").alias(f"n_{k}")
    return scanned.select(
        "doc_id", count("assign"), count("access"), count("hex"),
        F.sha2(F.array_join(F.transform(base, shown), ","), 256).alias("base_sha256"),
        F.array_join(F.transform("secrets", shown), ",").alias("spans"))
