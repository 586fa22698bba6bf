"""Ids of whole texts under a public byte-level BPE vocabulary, with each distinct piece encoded once.

The library splits a text before it merges bytes, and no piece of that split goes on past the end
of a word: a match never runs from a character that is not white space into a space or line feed.
It does not go on from a letter into ASCII punctuation, or from a single line feed into a visible
ASCII character, either. So a text may be cut at these places, the parts be encoded one by one, and their
ids be joined. The vocabulary's added tokens, such as <|endoftext|>, are taken out of a text before all that, as the
library does, and each is a part with its own id. Prose repeats its words, so the library sees each different part of a task once; the
rest is array work. ``tests/llm`` compares the ids with those of whole texts.
"""

from __future__ import annotations

import os
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

from papyra.llm import textbytes as tb

END_ID = 0
CACHE_PARTS = 1 << 20

# A part of letters alone is one piece of the library's own split, so its model can take it as is.
_LETTERS = re.compile(rb" ?(?:[A-Za-z]|\xc3[\x80-\x96\x98-\xb6\xb8-\xbf])+")


def vocabulary(name: str = "byte_bpe_50k.json") -> str:
    """Where the public vocabulary lies on this machine; every executor has the package."""
    import public_tokenizers

    return public_tokenizers.path(name)


class Encoder:
    """encode() gives the ids of the texts of a column as one array and n + 1 places."""

    _open: dict[str, "Encoder"] = {}

    @classmethod
    def of(cls, path: str) -> "Encoder":
        """One encoder per vocabulary and Python worker, so that later tasks find its parts."""
        if path not in cls._open:
            cls._open[path] = cls(path)
        return cls._open[path]

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        added = self.tokenizer.get_added_tokens_decoder().values()
        if any(t.lstrip or t.rstrip or t.single_word for t in added):
            raise ValueError(f"{path}: added tokens that take in white space or need word edges")
        self.added = sorted((t.content.encode() for t in added), key=len, reverse=True)
        self.find_added = re.compile(b"|".join(map(re.escape, self.added))) if self.added else None
        self.visible = _visible_bytes()
        self._clear()

    def _clear(self) -> None:
        self.known = np.empty(0, np.uint64)  # hashes of parts, sorted
        self.start = np.empty(0, np.int64)
        self.length = np.empty(0, np.int32)
        self.ids = np.empty(0, np.uint32)

    def encode(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        data, offsets = tb.text_buffer(column)
        begins = _part_starts(data, offsets, self._added_spans(data, offsets))
        ends = np.append(begins[1:], len(data))
        part, first_of, which = np.unique(
            tb.mix(_exact_hashes(data, begins, ends)), return_index=True, return_inverse=True
        )
        at = self._lookup(part, data, begins[first_of], ends[first_of])
        lengths = self.length[at][which].astype(np.int64)
        ids = self.ids[tb.gather_ranges(self.start[at][which], lengths)]
        places = np.zeros(len(lengths) + 1, np.int64)
        np.cumsum(lengths, out=places[1:])
        return ids, places[np.searchsorted(begins, offsets)]

    def _added_spans(self, data, offsets) -> list[tuple[int, int]]:
        """Where added tokens stand, the leftmost and longest first; none goes on past the end of a row."""
        raw = data.tobytes()
        if not self.added or not any(t in raw for t in self.added):
            return []
        places = offsets.tolist()
        return [m.span() for a, b in zip(places, places[1:]) for m in self.find_added.finditer(raw, a, b)]

    def _lookup(self, part, data, begins, ends) -> np.ndarray:
        """Where each part stands among the known ones; unknown ones are encoded and added."""
        at = np.searchsorted(self.known, part)
        found = at < len(self.known)
        found[found] = self.known[at[found]] == part[found]
        if found.all():
            return at
        if len(self.known) + (~found).sum() > CACHE_PARTS and len(self.known):
            self._clear()
            found[:] = False
        new = np.flatnonzero(~found)
        raw = data.tobytes()
        texts = [raw[a:b] for a, b in zip(begins[new].tolist(), ends[new].tolist())]
        plain, model = _LETTERS.fullmatch, self.tokenizer.model
        single = np.array([plain(x) is not None and x not in self.added for x in texts], bool)
        rest = [x.decode() for x, alone in zip(texts, single.tolist()) if not alone]
        lists = [None] * len(texts)
        for i in np.flatnonzero(single).tolist():
            lists[i] = [t.id for t in model.tokenize(texts[i].decode("latin-1").translate(self.visible))]
        places = np.flatnonzero(~single).tolist()
        for i in range(0, len(rest), 8192):
            encodings = self.tokenizer.encode_batch_fast(rest[i : i + 8192], add_special_tokens=False)
            for place, e in zip(places[i:], encodings):
                lists[place] = e.ids
        ids = [x for one in lists for x in one]
        lengths = np.fromiter(map(len, lists), np.int32, len(lists))
        starts = len(self.ids) + np.cumsum(lengths, dtype=np.int64) - lengths
        self.ids = np.concatenate([self.ids, np.array(ids, np.uint32)])
        known = np.concatenate([self.known, part[new]])
        order = np.argsort(known, kind="stable")
        self.known = known[order]
        self.start = np.concatenate([self.start, starts])[order]
        self.length = np.concatenate([self.length, lengths])[order]
        return np.searchsorted(self.known, part)


def _visible_bytes() -> dict[int, str]:
    """The public byte-level alphabet: visible Latin-1 characters stand for themselves, the other
    bytes for the characters from U+0100 on, in order."""
    table, extra = {}, 0
    for b in range(256):
        shown = 0x21 <= b <= 0x7E or 0xA1 <= b <= 0xAC or 0xAE <= b <= 0xFF
        table[b] = chr(b if shown else 256 + extra)
        extra += not shown
    return table


_CASED = np.random.default_rng(0xCA5E).integers(1, 1 << 63, 256, dtype=np.uint64)


def _exact_hashes(data, begins, ends) -> np.ndarray:
    """Like textbytes.span_hashes, but capital letters count as themselves."""
    return tb.span_sums(data, _CASED, begins, ends) + (ends - begins).astype(np.uint64)


# 1: ASCII letters, 2: ASCII punctuation, 3: ASCII digits
_KIND = np.zeros(256, np.uint8)
_KIND[0x21:0x7F] = 2
_KIND[0x30:0x3A] = 3
_KIND[0x41:0x5B] = _KIND[0x61:0x7B] = 1


def _part_starts(data: np.ndarray, offsets: np.ndarray, whole: list[tuple[int, int]]) -> np.ndarray:
    """Starts of rows, the places named at the top, and the edges of the spans that are not to be cut.

    Spaces and line feeds count after a character that surely isn't white space: bytes C2, E1, E2
    and E3 begin the non-ASCII white space characters, so nothing is cut after what they begin.
    Letters here are those of ASCII and Latin-1."""
    n = len(data)
    cut = np.zeros(n + 1, bool)
    if n > 1:
        before = data[:-1]
        solid = (before > 0x20) & (before != 0x7F)
        solid[1:] &= data[:-2] != 0xC2
        wide = (data == 0xE1) | (data == 0xE2) | (data == 0xE3)
        solid[2:] &= ~wide[:-3]
        kind = _KIND[data]
        letter = kind[:-1] == 1
        letter[1:] |= (data[:-2] == 0xC3) & (before[1:] >= 0x80) & (before[1:] != 0x97) & (before[1:] != 0xB7)
        cut[1:n] = (((data[1:] == 0x20) | (data[1:] == 0x0A)) & solid) | (letter & (kind[1:] == 2))
        alone = (before == 0x0A) & (kind[1:] > 0)
        alone[1:] &= solid[:-1]
        alone[0] = False
        cut[1:n] |= alone
    for a, b in whole:
        cut[a + 1 : b] = False
        cut[[a, b]] = True
    cut[offsets[:-1]] = True
    return np.flatnonzero(cut[:n])


def encoded(batches: Iterator[pa.RecordBatch], column: str, path: str, limit: int = tb.SLICE_BYTES):
    """For slices of batches: the slice, its ids with the end id of each text, and places."""
    encoder = Encoder.of(path)
    for batch in batches:
        for part in tb.slices(batch, column, limit):
            ids, places = encoder.encode(part.column(part.schema.get_field_index(column)))
            n = part.num_rows
            out = np.full(len(ids) + n, END_ID, np.uint32)
            row = np.repeat(np.arange(n), np.diff(places))
            out[np.arange(len(ids)) + row] = ids
            yield part, out, places + np.arange(n + 1)
