"""Operator 8: byte-level BPE encoding and decoding.

The merges are compiled into a deterministic transducer that reads one byte
at a time and emits token ids as soon as no continuation can change them:

* The state is the *pending* text: the bytes after the last boundary that every
  continuation keeps.  Left of such a boundary nothing matters any more, since
  merges never cross a boundary of the final result.
* After a byte, a later token may only start at an *open* position: the end, or
  a position from which the pending bytes are a proper prefix of a vocabulary
  entry (this bounds the lookahead).  The result up to an open position is the
  BPE result of that prefix alone.  Boundaries shared by the prefixes of all
  open positions are settled: their tokens are emitted on the transition.
* States and transitions are made when first met (lazy determinisation) and
  forgotten together once ``MAX_STATES`` are held, so memory stays bounded.

Decoding reads ids in blocks, looks up their bytes and runs an incremental
UTF-8 state machine, so a character cut by a token or block boundary is
completed by the next block.
"""

from __future__ import annotations

import base64
import functools
import gc
import hashlib
import re
from collections.abc import Callable, Iterator, Sequence
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from quarry.llm import tables

MAX_STATES = 300_000
#: Memo of whole pieces per worker; emptied when full, longer pieces are not kept.
MEMO_PIECES = 600_000
MEMO_CHARS = 48
#: Marks that are a pre-token of their own after a word; such pieces are put together from the word's.
MARKS = (".", ",")
DECODE_BLOCK = 1 << 16


def bpe(text: bytes, rank: Callable[[bytes, bytes], int | None]) -> list[bytes]:
    """Merge the lowest-ranked neighbouring pair, leftmost first, until none is left."""
    parts = [text[i:i + 1] for i in range(len(text))]
    while len(parts) > 1:
        ranked = [(r, i) for i in range(len(parts) - 1) if (r := rank(parts[i], parts[i + 1])) is not None]
        if not ranked:
            break
        i = min(ranked)[1]
        parts[i:i + 2] = [parts[i] + parts[i + 1]]
    return parts


class Transducer:
    """Lazily determinised BPE transducer over the bytes of one pre-token.

    A state is its pending text.  ``back[state][j-1]`` is where the last token
    of the result of the pending text's first j bytes begins, so the results of
    all prefixes form a tree whose root is position 0.
    """

    def __init__(self, ids: dict[bytes, int], rank: Callable[[bytes, bytes], int | None]) -> None:
        self.ids, self.rank = ids, rank
        self.open = {t[:i] for t in ids for i in range(1, len(t))}
        self.longest = max(map(len, ids), default=1)
        self.reset()

    def reset(self) -> None:
        self.number: dict[bytes, int] = {b"": 0}  # state of a pending text
        self.pending: list[bytes] = [b""]
        self.back: list[list[int] | bytes] = [b""]
        self.moves: dict[int, tuple[int, tuple[int, ...]]] = {}  # by state * 256 + byte
        self.rest: list[tuple[int, ...] | None] = [()]

    def _last(self, text: bytes) -> int:
        return len(text) - len(bpe(text, self.rank)[-1])

    def _tokens(self, text: bytes, back, end: int) -> tuple[int, ...]:
        out = []
        while end:
            start = back[end - 1]
            out.append(self.ids[text[start:end]])
            end = start
        return tuple(reversed(out))

    def _move(self, state: int, byte: int) -> tuple[int, tuple[int, ...]]:
        text = self.pending[state] + bytes((byte,))
        n = len(text)
        back = [*self.back[state], self._last(text)]
        alive = {n, *(j for j in range(max(0, n - self.longest + 1), n) if text[j:] in self.open)}
        while len(alive) > 1:  # up the tree to the last boundary that all open positions share
            j = max(alive)
            alive.remove(j)
            alive.add(back[j - 1])
        cut = alive.pop()
        out: tuple[int, ...] = ()
        if cut:  # what follows a settled boundary is tokenised on its own
            out = self._tokens(text, back, cut)
            text = text[cut:]
            kept = [back[j - 1] - cut for j in range(cut + 1, n + 1)]
            back = [b if b >= 0 and (b == 0 or kept[b - 1] >= 0) else -1 for b in kept]
            for j, b in enumerate(back, 1):
                if b < 0:
                    back[j - 1] = self._last(text[:j])
        if text not in self.number:
            self.number[text] = len(self.pending)
            self.pending.append(text)
            self.back.append(bytes(back) if len(back) < 256 else back)
            self.rest.append(None)
        move = self.moves[state << 8 | byte] = self.number[text], out
        return move

    def run(self, text: bytes) -> list[int]:
        """Token ids of one pre-token."""
        if len(self.pending) > MAX_STATES:
            self.reset()
        out: list[int] = []
        state, moves = 0, self.moves
        for byte in text:
            move = moves.get(state << 8 | byte) or self._move(state, byte)
            state = move[0]
            if move[1]:
                out += move[1]
        if state:
            tail = self.rest[state]
            if tail is None:
                tail = self.rest[state] = self._tokens(self.pending[state], self.back[state], len(self.pending[state]))
            out += tail
        return out


class Memo(dict):
    """part -> encode(lead + part).

    Long parts and parts that end in a mark are not kept; emptied when full.
    """

    def __init__(self, encode: Callable[[str], object], lead: str, marks: dict[str, object]) -> None:
        super().__init__()
        self.encode, self.lead, self.marks = encode, lead, marks

    def __missing__(self, part: str):
        if part[-1:] in self.marks and part[:-1].isalpha():
            return self[part[:-1]] + self.marks[part[-1]]
        out = self.encode(self.lead + part)
        if len(part) <= MEMO_CHARS:
            if len(self) >= MEMO_PIECES:
                self.clear()
            self[part] = out
        return out


class Splitter:
    """Encodes a text piece by piece.

    Pieces meet where every state of the splitting pattern agrees: before a
    single space between two non-blanks, and around a single line feed between
    two non-blanks, a new pre-token always begins.  ``encode`` gives one piece's
    value; a word followed by one of ``marks`` has the sum of both values.
    """

    two_blanks = re.compile(r"\s\s|^\s|\s\Z")
    sync = re.compile(r"(?<=\S)(?= \S)")

    def __init__(self, encode: Callable[[str], object]) -> None:
        self.encode = encode
        marks = {m: encode(m) for m in MARKS}
        self.spaced, self.first = Memo(encode, " ", marks), Memo(encode, "", marks)
        self.feed = encode("\n")

    def values(self, text: str) -> list:
        """Values of the pieces of a text, in order."""
        if not text:
            return []
        if self.two_blanks.search(text):
            return [*map(self.first.__getitem__, self.sync.split(text))]
        return self._plain(text, self.first)

    def values_after_space(self, text: str) -> list:
        """Values of the pieces of " " + text, where text begins and ends with a non-blank."""
        if self.two_blanks.search(text):
            return [*map(self.first.__getitem__, self.sync.split(" " + text))]
        return self._plain(text, self.spaced)

    def _plain(self, text: str, memo: Memo) -> list:
        out, spaced = [], self.spaced
        for line in text.split("\n"):
            if out:
                out.append(self.feed)
            head, *rest = line.split(" ")
            out.append(memo[head])
            out += [spaced[p] for p in rest]
            memo = self.first
        return out


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}


class Codec:
    """Byte-level BPE of one rank file: ``pattern`` splits, each match is encoded apart."""

    def __init__(self, path: str, pattern: str) -> None:
        self.ids = read_ranks(path)
        self.bytes_of = {i: t for t, i in self.ids.items()}
        rank = self.ids.get
        self.transducer = Transducer(self.ids, lambda a, b: rank(a + b))
        self.matches = regex.compile(pattern).findall
        self.splitter = Splitter(self._piece)

    def _word(self, word: bytes) -> list[int]:
        # an entry that its own merges would not rebuild is still taken whole
        whole = self.ids.get(word)
        return [whole] if whole is not None else self.transducer.run(word)

    def _piece(self, piece: str) -> str:
        if piece.isalpha() or piece[0] == " " and piece[1:].isalpha():  # one match
            ids = self._word(piece.encode())
        else:
            ids = chain.from_iterable([self._word(m.encode()) for m in self.matches(piece)])
        return "".join([f"{i}," for i in ids])

    def encode_text(self, text: str) -> str:
        """Decimal ids of a text, a comma after each."""
        return "".join(self.splitter.values(text))

    def encode(self, text: str) -> list[int]:
        return parse_ids(self.encode_text(text)).tolist()

    def decode_bytes(self, ids: Sequence[int]) -> Iterator[bytes]:
        """Bytes of the ids, in blocks that end between characters."""
        machine = Utf8()
        for at in range(0, len(ids), DECODE_BLOCK):
            block = b"".join([self.bytes_of[i] for i in ids[at:at + DECODE_BLOCK]])
            if out := machine.feed(block):
                yield out
        if machine.held:
            yield machine.held

    def decode(self, ids: Sequence[int]) -> str:
        return "".join(b.decode("utf-8", "replace") for b in self.decode_bytes(ids))


def parse_ids(text: str) -> np.ndarray:
    """Ids of a text of decimal numbers, a comma after each."""
    return np.fromstring(text, dtype=np.int32, sep=",") if text else np.zeros(0, np.int32)


class Utf8:
    """Incremental UTF-8 state machine: holds back the bytes of an unfinished character."""

    def __init__(self) -> None:
        self.held = b""

    @staticmethod
    def _missing(lead: int) -> int:
        """Continuation bytes that follow a lead byte."""
        return 3 if 0xF0 <= lead <= 0xF4 else 2 if lead >= 0xE0 and lead < 0xF0 else 1 if 0xC2 <= lead < 0xE0 else 0

    def feed(self, block: bytes) -> bytes:
        data, self.held = self.held + block, b""
        for back in range(1, min(3, len(data)) + 1):
            byte = data[-back]
            if byte & 0xC0 != 0x80:  # the last byte that is no continuation
                if self._missing(byte) >= back:
                    data, self.held = data[:-back], data[-back:]
                break
        return data


@functools.lru_cache(maxsize=2)
def codec(path: str, pattern: str) -> Codec:
    return Codec(path, pattern)


def encode(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """doc_id, n_tokens, ids, ids_sha256, decoded_sha256 for every document.

    ``docs`` has doc_id and text; other columns are ignored.  A null text counts
    as the empty text (no ids; the hashes of nothing).  Repeated rows give
    repeated rows; an empty table an empty result.  ``path`` is a rank file on
    every executor, ``pattern`` the splitter.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(path, pattern)
        for batch in batches:
            counts, ids_out, sha, back = [], [], [], []
            for text in batch.column(1):
                joined = c.encode_text(text.as_py() or "")
                ids = parse_ids(joined)
                decoded = hashlib.sha256()
                for block in c.decode_bytes(ids.tolist()):
                    decoded.update(block)
                counts.append(len(ids))
                ids_out.append(ids)
                sha.append(hashlib.sha256(joined[:-1].encode()).hexdigest())
                back.append(decoded.hexdigest())
            offsets = pa.array(np.cumsum([0, *counts]), pa.int32())
            values = pa.array(np.concatenate([*ids_out, np.zeros(0, np.int32)]), pa.int32())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(counts, pa.int64()), pa.ListArray.from_arrays(offsets, values),
                 pa.array(sha, pa.string()), pa.array(back, pa.string())],
                ["doc_id", "n_tokens", "ids", "ids_sha256", "decoded_sha256"])

    return small_batches(tables.columns(docs, "doc_id", "text"), run,
                         "doc_id long, n_tokens long, ids array<int>, ids_sha256 string, decoded_sha256 string", codecs=True)


BATCH_ROWS = 512


def forget_codecs() -> None:
    """Gives back the codecs that earlier queries left in this worker, which lives on."""
    if codec.cache_info().currsize:
        codec.cache_clear()
        gc.collect()  # a codec's parts refer to each other


def small_batches(df: DataFrame, run, schema: str, codecs: bool = False) -> DataFrame:
    """mapInArrow whose function sees at most BATCH_ROWS rows at a time; ``codecs`` tells that it needs codecs."""
    def sliced(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if not codecs:
            forget_codecs()
        yield from run(b.slice(i, BATCH_ROWS) for b in batches for i in range(0, b.num_rows, BATCH_ROWS))
        pa.default_memory_pool().release_unused()

    return df.mapInArrow(sliced, schema)
