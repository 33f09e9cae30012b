"""Operator 9: token counts from a compiled finite-state tokenizer.

The tokenizer (splitter and merges) runs as a deterministic transducer whose
transitions carry the *number* of tokens they emit; ids are never made.  The
text is cut into chunks at arbitrary places.  Each chunk, whatever the state it
is entered in, gives a state map

    entry text -> (tokens emitted, exit text)

An entry state is the text since the last synchronising place (where all states
agree that a pre-token begins), so the map is stored as ``head`` (up to the
first such place), ``n`` (tokens from there to the last one) and ``tail``.  Maps
compose associatively, and a pairwise scan combines the maps of a text's chunks.
"""

from __future__ import annotations

import functools
import json
import re
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from quarry.llm import tables
from quarry.llm.byte_bpe import Splitter, Transducer, small_batches

CHUNK_CHARS = 1 << 14
#: Splitting pattern of byte-level tokenizer files (fixed value).
BYTE_LEVEL_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def byte_characters() -> dict[str, int]:
    """Printable stand-in of each byte in byte-level tokenizer files: itself for
    printable Latin-1 characters, otherwise the next free one from U+0100 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(0x100 + i): b for i, b in enumerate(others)}


class CountingTransducer(Transducer):
    """The BPE transducer with emitted-token counts on its transitions."""

    def reset(self) -> None:
        super().reset()
        self.steps: dict[int, tuple[int, int]] = {}
        self.last: dict[int, int] = {0: 0}

    def _step(self, state: int, byte: int) -> tuple[int, int]:
        to, out = self._move(state, byte)
        del self.moves[state << 8 | byte]  # only the count is kept
        step = self.steps[state << 8 | byte] = to, len(out)
        return step

    def _flush(self, state: int) -> int:
        n = self.last[state] = len(self._tokens(self.pending[state], self.back[state], len(self.pending[state])))
        return n

    def count(self, text: bytes, limit: int) -> int:
        if len(self.pending) > limit:
            self.reset()
        n = state = 0
        steps = self.steps
        for byte in text:
            state, more = steps.get(state << 8 | byte) or self._step(state, byte)
            n += more
        last = self.last.get(state)
        return n + (self._flush(state) if last is None else last)


class ChunkMap(NamedTuple):
    head: str
    n: int
    tail: str | None  # None: no synchronising place; the head is the whole chunk


class Counter:
    """Compiled form of one byte-level tokenizer file."""

    MAX_STATES = 300_000

    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        stand_in = byte_characters()
        raw = lambda t: bytes(map(stand_in.__getitem__, t))
        special = {t["content"] for t in spec["added_tokens"]}
        self.ids = {raw(t): i for t, i in spec["model"]["vocab"].items() if t not in special}
        pairs = (m if isinstance(m, list) else m.split(" ") for m in spec["model"]["merges"])
        ranks = {(raw(a), raw(b)): i for i, (a, b) in enumerate(pairs)}
        self.transducer = CountingTransducer(self.ids, lambda a, b: ranks.get((a, b)))
        self.matches = regex.compile(BYTE_LEVEL_PATTERN).findall
        self.special = re.compile("|".join(map(re.escape, sorted(special, key=len, reverse=True)))) if special else None
        self.special_starts = tuple({s[0] for s in special})
        self.splitter = Splitter(self._piece)

    def _piece(self, piece: str) -> int:
        if piece.isalpha() or piece[0] == " " and piece[1:].isalpha():  # one match
            return self.transducer.count(piece.encode(), self.MAX_STATES)
        if self.special and (found := self.special.findall(piece)):  # a special string is one token
            return len(found) + sum(self._matches(t) for t in self.special.split(piece) if t)
        return self._matches(piece)

    def _matches(self, text: str) -> int:
        return sum(self.transducer.count(m.encode(), self.MAX_STATES) for m in self.matches(text))

    def text_count(self, text: str) -> int:
        return sum(self.splitter.values(text))

    def chunk_map(self, chunk: str) -> ChunkMap:
        first = Splitter.sync.search(chunk)
        if first is None:
            return ChunkMap(chunk, 0, None)
        a, b = first.start(), len(chunk) - 1
        while not Splitter.sync.match(chunk, b):
            b = chunk.rindex(" ", a, b)
        n = sum(self.splitter.values_after_space(chunk[a + 1:b])) if b > a else 0
        return ChunkMap(chunk[:a], n, chunk[b:])

    def compose(self, x: ChunkMap, y: ChunkMap) -> ChunkMap:
        if x.tail is None:
            return ChunkMap(x.head + y.head, y.n, y.tail)
        if y.tail is None:
            return ChunkMap(x.head, x.n, x.tail + y.head)
        return ChunkMap(x.head, x.n + self.text_count(x.tail + y.head) + y.n, y.tail)

    def count(self, text: str, chunk: int = CHUNK_CHARS) -> int:
        """Tokens of a text: maps of its chunks, combined pairwise."""
        if len(text) <= chunk:
            return self.text_count(text)
        maps = [self.chunk_map(text[i:i + chunk]) for i in range(0, len(text), chunk)]
        while len(maps) > 1:
            maps = [self.compose(*maps[i:i + 2]) if i + 1 < len(maps) else maps[i] for i in range(0, len(maps), 2)]
        m = maps[0]
        return self.text_count(m.head) + m.n + self.text_count(m.tail or "")


@functools.lru_cache(maxsize=2)
def counter(path: str) -> Counter:
    return Counter(path)


def count_tokens(docs: DataFrame, path: str, limit: int = 1024) -> DataFrame:
    """doc_id, n_bytes (UTF-8), n_tokens, over_limit (n_tokens > limit) per document.

    ``docs`` has doc_id and text, other columns are ignored; ``path`` is a
    byte-level tokenizer file on every executor.  Counts equal the tokenizer
    library's (special strings inside a text count as one token, none is added).
    A null text counts as the empty text (0 tokens); repeated rows give repeated
    rows; an empty table gives an empty result.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = counter(path)
        for batch in batches:
            texts = [t or "" for t in batch.column(1).to_pylist()]
            n = np.array([c.count(t) for t in texts], dtype=np.int64)
            size = np.array([len(t.encode()) for t in texts], dtype=np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(size), pa.array(n), pa.array(n > limit)],
                                             ["doc_id", "n_bytes", "n_tokens", "over_limit"])

    return small_batches(tables.columns(docs, "doc_id", "text"), run,
                         "doc_id long, n_bytes long, n_tokens long, over_limit boolean")
