"""Online logistic mixing of hashed-context bit predictors (the model).

A text is its tokens: lower-cased (A-Z) words, then one end.  A word of the
lexicon (the frequent words of the learning texts), the end and an escape are
symbols of one Huffman tree; any other word is an escape and its bytes, closed
by a blank, as symbols of a second tree.  So every text is a row of binary
decisions, few for frequent symbols.

Each decision (a tree node) is predicted from the counts of ``CONTEXTS``
contexts; a context's counts stand in a table of hashed slots, in which the tree
node chooses the slot.  Contexts of word symbols: none, the class of the token
before, that token itself.  Contexts of bytes: the last two and four bytes of
the word, the whole word so far.
The log-odds are added up with weights chosen by a gate (tree, depth, how sure
the contexts are).  While a text is read, corrections of the weights follow the
gradient of each coded bit.

Texts are coded ``LANE`` symbols at a time, many lanes in step; a lane starts
from the learned weights and knows what stands before it, so results do not
depend on how rows are spread.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from quarry.llm import texthash
from quarry.llm.period_runs import split_words

CONTEXTS = 3
LANE = 2048  # symbols coded in a row; the corrections start anew after them
TURN = 64  # decisions of a lane between two updates of its corrections
BLOCK = 1 << 20  # symbols whose lanes go in step
LANES = 256  # lanes that take a turn together
PART = 1 << 13  # symbols whose inputs are made at once
CLASSES = 64  # lexicon words that are a class of their own; others go by their last byte
SCALE = 12.0  # log-odds are stored as int8 at this scale
RATE = 0.001  # of the corrections
GATES = 2 * 3 * 9
START = 0.3  # weights before learning
BLANK = 0x20
_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[65:91] += 32


def codes(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Huffman codes of symbols with ``counts`` (one is added): (length, nodes, bits), the latter two
    flat in the order of symbols, root first.  Node 0 is made first, the root last."""
    n = len(counts)
    heap = [(int(c) + 1, i) for i, c in enumerate(counts)]  # equal counts by number: the tree is always the same
    heapq.heapify(heap)
    up, side = np.zeros(2 * n - 1, dtype=np.int64), np.zeros(2 * n - 1, dtype=np.int8)
    for new in range(n, 2 * n - 1):
        (a, x), (b, y) = heapq.heappop(heap), heapq.heappop(heap)
        up[x] = up[y] = new
        side[y] = 1
        heapq.heappush(heap, (a + b, new))
    length = np.zeros(2 * n - 1, dtype=np.int32)
    for x in range(2 * n - 3, -1, -1):
        length[x] = length[up[x]] + 1
    length = length[:n]
    last = np.cumsum(length) - 1  # from the leaf up
    node, bit = np.empty(int(last[-1]) + 1, dtype=np.int64), np.empty(int(last[-1]) + 1, dtype=np.int8)
    x, i = np.arange(n), np.arange(n)
    for step in range(int(length.max())):
        i = i[length[i] > step]
        node[last[i] - step], bit[last[i] - step] = up[x[i]] - n, side[x[i]]
        x[i] = up[x[i]]
    return length, node, bit


class Lexicon:
    """Frequent words with their codes; symbols are words, escape, end, then the 256 bytes."""

    def __init__(self, words: list[str], counts: list[int], escapes: int, ends: int, letters: np.ndarray) -> None:
        order = sorted(range(len(words)), key=lambda i: (-counts[i], words[i]))
        self.words = pa.array([words[i] for i in order], pa.large_string())
        self.counts = np.array([counts[i] for i in order], dtype=np.int64)
        self.escape, self.end, self.bytes = len(words), len(words) + 1, len(words) + 2
        top, node, bit = codes(np.append(self.counts, [escapes, ends]))
        low, low_node, low_bit = codes(letters)
        self.length = np.append(top, low).astype(np.int32)
        self.first = np.append(0, np.cumsum(self.length)[:-1]).astype(np.int32)
        self.bit = np.append(bit, low_bit)
        node = np.append(node, low_node + len(top)).astype(np.uint64)
        self.mixed = (texthash.mix(node + np.uint64(1)) >> np.uint64(34)).astype(np.int32)  # below 2^30
        depth = np.arange(len(node)) - np.repeat(self.first, self.length)
        letter = np.repeat(np.arange(len(self.length)) >= self.bytes, self.length)
        #: part of the gate that depends on the place in the code: tree and depth
        self.gate = ((letter * 3 + np.minimum(depth // 3, 2)) * 9).astype(np.int16)
        #: gate, bit and ``mixed`` of a place side by side: one read gives all three
        self.place = self.gate.astype(np.int64) << 32 | self.bit.astype(np.int64) << 31 | self.mixed


@dataclass
class Symbols:
    """Symbols of a slice of texts: ``sym``, hashes per context, first symbol of each text; token facts."""

    sym: np.ndarray
    base: np.ndarray
    first: np.ndarray
    words: pa.DictionaryArray
    token_first: np.ndarray
    lexical: np.ndarray  # per dictionary word its lexicon number or -1


def _hash32(x: np.ndarray, salt: int) -> np.ndarray:
    return (texthash.mix(x + np.uint64(salt * 0x9E3779B97F4A7C15 & (1 << 64) - 1)) >> np.uint64(33)).astype(np.int32)


def _before(x: np.ndarray, first: np.ndarray, k: int) -> np.ndarray:
    """Value k places earlier in the same row, 0 before its start."""
    out = np.zeros(len(x), dtype=np.uint64)
    out[k:] = x[:-k]
    at = first[:-1][:, None] + np.arange(k)
    out[at[(at < first[1:, None])]] = 0
    return out


def symbols(lex: Lexicon, data: np.ndarray, offsets: np.ndarray, spell: bool = False) -> Symbols:
    """Symbols of the texts data[offsets[i]:offsets[i+1]]; with ``spell`` every word is spelled."""
    lo, hi = int(offsets[0]), int(offsets[-1])
    words, token_first = split_words(_FOLD[data[lo:hi]], offsets - lo)
    n, n_texts = len(words), len(offsets) - 1
    own = words.dictionary
    at = pc.index_in(lex.words, value_set=own).fill_null(-1).to_numpy()
    lexical = np.full(len(own), -1)
    lexical[at[at >= 0]] = np.flatnonzero(at >= 0)
    chars, ends = texthash.text_buffer(own)
    code = texthash._CODE[chars[:ends[-1]]]
    whole = texthash.mix(texthash.span_hash(texthash.prefix_sums(code), ends[:-1], ends[1:]))
    size = np.diff(ends)
    last = chars[np.maximum(ends[1:] - 1, 0)].astype(np.uint64) if len(own) else np.zeros(0, np.uint64)
    kind = np.where((lexical >= 0) & (lexical < CLASSES), lexical.astype(np.uint64) + np.uint64(1 << 20), last)

    ids = words.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    known = np.full(n, -1) if spell else lexical[ids]
    rare = np.flatnonzero(known < 0)
    length = np.ones(n, dtype=np.int64)
    length[rare] += size[ids[rare]] + 1
    text = np.repeat(np.arange(n_texts), np.diff(token_first))
    upto = np.append(0, np.cumsum(length))
    at = upto[:-1] + text  # an end stands behind each text
    first = upto[token_first] + np.arange(n_texts + 1)
    total = int(first[-1])
    sym = np.empty(total, dtype=np.int32)
    sym[at] = np.where(known >= 0, known, lex.escape)
    end = first[1:] - 1
    sym[end] = lex.end

    # contexts of word symbols: an end is a token as well
    tokens = token_first + np.arange(n_texts + 1)
    full, sort = np.zeros(n + n_texts, dtype=np.uint64), np.zeros(n + n_texts, dtype=np.uint64)
    mine = np.arange(n) + text
    full[mine], sort[mine] = whole[ids], kind[ids]
    place = np.empty(n + n_texts, dtype=np.int64)
    place[mine], place[tokens[1:] - 1] = at, end
    base = np.empty((CONTEXTS, total), dtype=np.int32)
    base[0, place] = 0
    base[1, place] = _hash32(_before(sort, tokens, 1), 1)
    base[2, place] = _hash32(_before(full, tokens, 1), 2)

    # spelled words: bytes and a closing blank
    if len(rare):
        m = size[ids[rare]]
        close = np.append(0, np.cumsum(m + 1))
        within = np.arange(close[-1]) - np.repeat(close[:-1], m + 1)
        src = np.repeat(ends[ids[rare]], m + 1) + within
        letter = np.append(chars[:ends[-1]], 0)[src]
        letter[close[1:] - 1] = BLANK
        to = np.repeat(at[rare] + 1, m + 1) + within
        sym[to] = lex.bytes + letter.astype(np.int32)
        wide = letter.astype(np.uint64)
        packed = np.zeros(len(wide), dtype=np.uint64)
        for k in range(1, 5):
            before = np.zeros(len(wide), dtype=np.uint64)
            before[k:] = wide[:-k]
            before[within < k] = 0
            packed = packed << np.uint64(8) | before
            if k in (2, 4):
                base[k // 2 - 1, to] = _hash32(packed, 10 + k)
        sums = texthash.prefix_sums(texthash._CODE[letter])
        spelled = texthash.span_hash(sums, np.repeat(close[:-1], m + 1), np.arange(close[-1]))
        base[2, to] = _hash32(spelled + within.astype(np.uint64), 20)
    return Symbols(sym, base, first, words, token_first, lexical)


def lanes(s: Symbols) -> tuple[np.ndarray, np.ndarray]:
    """(first symbol, text) of each lane."""
    n = np.diff(s.first)
    per = -(-n // LANE)
    text = np.repeat(np.arange(len(n)), per)
    return s.first[:-1][text] + (np.arange(len(text)) - np.repeat(np.cumsum(per) - per, per)) * LANE, text


def blocks(s: Symbols) -> Iterator[tuple[np.ndarray, np.ndarray, int, int]]:
    """(lane starts, their texts, from, to): lanes of about BLOCK symbols together."""
    start, text = lanes(s)
    cut = 0
    while cut < len(start):
        to = max(cut + 1, int(np.searchsorted(start, start[cut] + BLOCK, side="right")) - 1)
        if start[-1] < start[cut] + BLOCK:
            to = len(start)
        yield start[cut:to], text[cut:to], int(start[cut]), int(start[to]) if to < len(start) else len(s.sym)
        cut = to


def parts(n: int) -> list[tuple[int, int]]:
    """Ranges of PART symbols: arrays of that size stay in a processor's cache."""
    return [(a, min(a + PART, n)) for a in range(0, n, PART)]


def decisions(lex: Lexicon, sym: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(decisions of each symbol, ``lex.place`` of every decision)."""
    size = lex.length.take(sym)
    ends = np.cumsum(size, dtype=np.int64)
    at = np.repeat(lex.first.take(sym) - (ends - size), size)
    at += np.arange(len(at))
    return size, lex.place.take(at)


def count(tables_: np.ndarray, lex: Lexicon, bits: int, s: Symbols) -> None:
    """Add all decisions to ``tables_`` (contexts, slots * 2); equal symbols of a context are counted together."""
    mask, width = (1 << bits) - 1, len(lex.length).bit_length()
    for table, base in zip(tables_, s.base):
        key, n = counted((base & np.int32(mask)).astype(np.int64) << width | s.sym)
        sym, base, n = key & ((1 << width) - 1), key >> width, n.astype(np.uint32)
        for lo, hi in parts(len(key)):
            size, place = decisions(lex, sym[lo:hi])
            slot = (np.repeat(base[lo:hi], size) + place) & mask  # what stands above ``mixed`` is masked
            np.add.at(table, (slot << 1) + (place >> 31 & 1), np.repeat(n[lo:hi], size))


def counted(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(distinct keys in ascending order, how often each occurs); sorts ``keys`` in place."""
    keys.sort()
    first = np.flatnonzero(np.append(True, keys[1:] != keys[:-1])) if len(keys) else np.zeros(0, np.int64)
    return keys[first], np.diff(first, append=len(keys))


def count_spelling(tables_: np.ndarray, lex: Lexicon, bits: int) -> None:
    """Add the spelling of every lexicon word once: what spelled words look like."""
    data, offsets = texthash.text_buffer(lex.words)
    for lo, hi in texthash.slices(offsets):
        s = symbols(lex, data, offsets[lo:hi + 1], spell=True)
        letters = s.sym >= lex.bytes
        count(tables_, lex, bits, Symbols(s.sym[letters], s.base[:, letters], s.first, s.words, s.token_first, s.lexical))


def odds(counts: np.ndarray) -> np.ndarray:
    """Scaled log-odds of pairs of counts."""
    pair = counts.reshape(-1, 2).astype(np.float32)
    return np.clip(np.rint(np.log((pair[:, 1] + 0.4) / (pair[:, 0] + 0.4)) * SCALE), -127, 127).astype(np.int8)


def inputs(model: np.ndarray, lex: Lexicon, bits: int, base: np.ndarray, size: np.ndarray, place: np.ndarray, x: np.ndarray):
    """Gates of decisions; their log-odds by context go to ``x`` (int8)."""
    mask = (1 << bits) - 1
    for i in range(CONTEXTS):
        slot = np.repeat(base[i], size) + place
        slot &= mask
        model[i].take(slot, out=x[i], mode="wrap")
    gate = (place >> 32).astype(np.int16)
    for v, step in ((x[1], 3), (x[2], 1)):
        gate += ((v != 0).view(np.int8) + (v > 25).view(np.int8) + (v < -25).view(np.int8)) * np.int8(step)
    return gate


def outcomes(model: np.ndarray, lex: Lexicon, bits: int, s: Symbols) -> np.ndarray:
    """All decisions of a slice, equal ones once: key (gate, log-odds, bit) and number side by side, ascending."""
    found = []
    for lo, hi in parts(len(s.sym)):
        size, place = decisions(lex, s.sym[lo:hi])
        x = np.empty((CONTEXTS, len(place)), dtype=np.int8)
        key = inputs(model, lex, bits, s.base[:, lo:hi], size, place, x).astype(np.uint32)
        for v in x.view(np.uint8):
            key <<= np.uint32(8)
            key |= v
        key <<= np.uint32(1)
        key |= (place >> 31 & 1).astype(np.uint32)
        found.append(key)
    key, n = counted(np.concatenate(found))
    return key.astype(np.uint64) << np.uint64(32) | n.astype(np.uint64)


def merged(found: list[np.ndarray]) -> np.ndarray:
    """Several ``outcomes``, of less than 2^32 decisions, as one."""
    both = np.concatenate(found)
    both.sort()
    key = (both >> np.uint64(32)).astype(np.uint32)
    first = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
    both &= np.uint64(0xFFFFFFFF)
    return key[first].astype(np.uint64) << np.uint64(32) | np.add.reduceat(both, first)


def statistics(weights: np.ndarray, found: np.ndarray) -> np.ndarray:
    """Per gate the gradient and the Hessian of the log-likelihood of ``outcomes``, flattened."""
    out = np.zeros((GATES, CONTEXTS + CONTEXTS * CONTEXTS))
    keys, n = (found >> np.uint64(32)).astype(np.uint32), (found & np.uint64(0xFFFFFFFF)).astype(float)
    ends = np.searchsorted(keys, np.arange(GATES + 1, dtype=np.uint32) << np.uint32(8 * CONTEXTS + 1))
    for g in np.flatnonzero(np.diff(ends)):
        key, m = keys[ends[g]:ends[g + 1]], n[ends[g]:ends[g + 1]]
        v = np.stack([(key >> np.uint32(8 * i + 1)).astype(np.int8) for i in reversed(range(CONTEXTS))]) / SCALE
        p = 1 / (1 + np.exp(-np.clip(weights[g] @ v, -15, 15)))
        out[g, :CONTEXTS] = v @ (m * ((key & np.uint32(1)) - p))
        out[g, CONTEXTS:] = ((v * (m * p * (1 - p))) @ v.T).ravel()
    return out


def newton(weights: np.ndarray, sums: np.ndarray) -> np.ndarray:
    """Weights after a damped step on summed statistics; gates without decisions keep theirs."""
    out = weights.copy()
    for g in range(GATES):
        hessian = sums[g, CONTEXTS:].reshape(CONTEXTS, CONTEXTS)
        step = np.linalg.solve(hessian + np.eye(CONTEXTS), sums[g, :CONTEXTS] - (out[g] - START))
        out[g] = np.clip(out[g] + np.clip(step, -0.6, 0.6), -3, 3)
    return out


def _block_loss(weights, model, lex: Lexicon, bits: int, s: Symbols, start: np.ndarray, lo: int, hi: int) -> np.ndarray:
    """Log-probability of each lane of a block."""
    size = np.add.reduceat(lex.length.take(s.sym[lo:hi]), start - lo).astype(np.int64)  # decisions of each lane
    first, total, done = np.cumsum(size) - size, int(size.sum()), 0
    # log-odds of the bit that was not coded: alone and mixed; the last turn of a lane reads on behind it
    x, logit = np.zeros((CONTEXTS, total + TURN), dtype=np.int8), np.zeros(total + TURN, dtype=np.float32)
    scaled = (weights / SCALE).astype(np.float32).T.copy()
    for a, b in parts(hi - lo):
        n, place = decisions(lex, s.sym[lo + a:lo + b])
        own = slice(done, done + len(place))
        gate = inputs(model, lex, bits, s.base[:, lo + a:lo + b], n, place, x[:, own]).astype(np.intp)
        x[:, own] *= np.int8(1) - (place >> 30 & 2).astype(np.int8)
        np.multiply(scaled[0].take(gate), x[0, own], out=logit[own])
        for i in range(1, CONTEXTS):
            logit[own] += scaled[i].take(gate) * x[i, own]
        done += len(place)
    x, logit = (np.lib.stride_tricks.sliding_window_view(v, TURN, axis=-1) for v in (x, logit))
    turns = -(-size // TURN)
    by_turns = np.argsort(-turns, kind="stable")
    row, left = first[by_turns], size[by_turns]
    active = len(size) - np.searchsorted(np.sort(turns), np.arange(turns.max() + 1), side="right")
    change = np.zeros((CONTEXTS, len(size), 1), dtype=np.float32)
    rate, one, loss, within = np.float32(RATE / SCALE), np.float32(1), np.zeros(len(size)), np.arange(TURN)
    for j, n in enumerate(active[:-1].tolist()):
        for c in range(0, n, LANES):  # lanes in portions that stay in the cache
            own = slice(c, min(c + LANES, n))
            these = row[own] + j * TURN
            v, z = x[:, these].astype(np.float32), logit[these]
            for i in range(CONTEXTS):
                z += change[i, own] * v[i]
            np.clip(z, -11, 11, out=z)
            np.exp(z, out=z)
            ending = max(int(active[j + 1]) - c, 0)  # the lanes from here on end in this turn
            z[ending:] *= within < (left[own][ending:] - j * TURN)[:, None]
            # one logarithm for a turn: TURN factors of at most 1 + exp(11) stay below the largest double
            loss[own] -= np.log(np.multiply.reduce(np.add(z, 1, dtype=np.float64), axis=1))
            z /= one + z
            change[:, own, 0] -= rate * np.einsum("ij,kij->ki", z, v)
    out = np.empty(len(size))
    out[by_turns] = loss
    return out


def log_probability(weights: np.ndarray, model: np.ndarray, lex: Lexicon, bits: int, s: Symbols) -> np.ndarray:
    """Natural log-probability of every text of a slice."""
    out = np.zeros(len(s.first) - 1)
    for start, text, lo, hi in blocks(s):
        np.add.at(out, text, _block_loss(weights, model, lex, bits, s, start, lo, hi))
    return out
