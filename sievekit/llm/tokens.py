"""Vectorised word and shingle hashes, used inside Arrow tasks.

Words are runs of bytes other than space and tab to carriage return, A-Z
lower-cased. A word's hash is a polynomial over its bytes modulo 2**64, got
for all words of a piece of text at once from one running sum; shingle hashes
combine the hashes of neighbouring words. Texts are handled in pieces of about
``PIECE`` bytes cut at white space, so memory does not follow a text's length
beyond eight bytes a word.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator

import numpy as np

PIECE = 1 << 18
_SPACES = np.zeros(256, dtype=bool)
_SPACES[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_BREAK = re.compile(rb"[\x20\x09-\x0D]")
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_U = np.uint64


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection on 64-bit words that spreads every bit (in place)."""
    x ^= x >> _U(30)
    x *= _U(0xBF58476D1CE4E5B9)
    x ^= x >> _U(27)
    x *= _U(0x94D049BB133111EB)
    x ^= x >> _U(31)
    return x


def _codes() -> np.ndarray:
    """A 64-bit code for each byte, A-Z like a-z."""
    table = mixed(np.arange(1, 257, dtype=np.uint64) * _U(_BASE))
    table[0x41:0x5B] = table[0x61:0x7B]
    return table


_CODE = _codes()
_powers: dict[int, np.ndarray] = {}


def _power(base: int, n: int) -> np.ndarray:
    have = _powers.get(base)
    if have is None or len(have) < n:
        size = max(n, PIECE + 4096)
        steps = np.full(size, base, dtype=np.uint64)
        steps[0] = 1
        have = np.cumprod(steps, dtype=np.uint64)
        if size <= 4 * PIECE:
            _powers[base] = have
    return have


def _hash_piece(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes and start offsets of the words in a piece of bytes."""
    word = np.zeros(len(data) + 2, dtype=np.int8)
    word[1:-1] = ~_SPACES[data]
    edge = np.diff(word)
    starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    if not len(starts):
        return np.empty(0, dtype=np.uint64), starts
    sums = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum(_CODE[data] * _power(_BASE, len(data))[: len(data)], out=sums[1:])
    found = (sums[ends] - sums[starts]) * _power(_INVERSE, len(data))[starts]
    return mixed(found + (ends - starts).astype(np.uint64)), starts


def _pieces(data: bytes) -> Iterator[bytes]:
    at = 0
    while len(data) - at > PIECE:
        cut = _BREAK.search(data, at + PIECE)
        end = cut.start() if cut else len(data)
        yield data[at:end]
        at = end
    yield data[at:]


def word_hashes(text: bytes | None) -> np.ndarray:
    """Hashes of a text's words in order."""
    if not text:
        return np.empty(0, dtype=np.uint64)
    return np.concatenate([_hash_piece(np.frombuffer(p, dtype=np.uint8))[0] for p in _pieces(text)])


def each_word_hashes(texts: Iterable[bytes | None]) -> Iterator[np.ndarray]:
    """``word_hashes`` of many texts, short ones hashed together."""
    held: list[bytes] = []
    size = 0

    def flush() -> Iterator[np.ndarray]:
        lengths = np.fromiter((len(x) + 1 for x in held), dtype=np.int64, count=len(held))
        hashes, starts = _hash_piece(np.frombuffer(b"\n".join(held) + b"\n", dtype=np.uint8))
        cuts = np.searchsorted(starts, np.cumsum(lengths)[:-1])
        yield from np.split(hashes, cuts)

    for text in texts:
        text = text or b""
        if held and size + len(text) > PIECE:
            yield from flush()
            held, size = [], 0
        if len(text) > PIECE:
            yield word_hashes(text)
        else:
            held.append(text)
            size += len(text) + 1
    if held:
        yield from flush()


def shingles(words: np.ndarray, n: int = 5) -> np.ndarray:
    """Sorted distinct hashes of runs of ``n`` words; with fewer words, of the
    whole sequence; without words, none."""
    if not len(words):
        return words
    k = min(n, len(words))
    total = np.zeros(len(words) - k + 1, dtype=np.uint64)
    for i in range(k):
        total *= _U(_BASE)
        total += words[i : len(words) - k + 1 + i]
    return np.unique(mixed(total + _U(k)))
