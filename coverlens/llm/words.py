"""Vectorised word hashing over UTF-8 bytes: whole texts, no Python string per word.

A word is a maximal run of bytes that a 256-entry table marks as word bytes; bytes of
multi-byte characters are 0x80 and above, so byte classes and character classes agree as
long as the table treats all of these alike.  Words get 64-bit hashes.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence

import numpy as np

U = np.uint64
_rng = np.random.Generator(np.random.PCG64(20240229))
_MASK = np.array([(1 << (8 * i)) - 1 for i in range(8)] + [2**64 - 1], dtype=np.uint64)
_PIECE = 1 << 18
_LONG = 4096

_fold = np.arange(256, dtype=np.uint8)
_fold[65:91] += 32


#: Words between ASCII blanks (0x20, 0x09-0x0D).
BLANKS = np.ones(256, dtype=bool)
BLANKS[[0x20, *range(0x09, 0x0E)]] = False
#: Words of ASCII letters, digits and all non-ASCII characters (upper case folded first).
ALNUM = np.zeros(256, dtype=bool)
ALNUM[0x30:0x3A] = ALNUM[0x61:0x7B] = True
ALNUM[0x80:] = True


def mix(h: np.ndarray) -> np.ndarray:
    """Finisher of MurmurHash3: every input bit reaches every output bit."""
    h = h ^ (h >> U(33))
    h = h * U(0xFF51AFD7ED558CCD)
    h = h ^ (h >> U(33))
    h = h * U(0xC4CEB9FE1A85EC53)
    return h ^ (h >> U(33))


def word_hashes(texts: Sequence[bytes | memoryview | None], word_byte: np.ndarray = BLANKS) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of all texts, A-Z folded, in order, and where each text's words begin (one more at the end).

    The work goes in pieces of a few hundred kilobytes that end between words, so memory
    follows the number of words, not the bytes; a text of any length is treated whole.
    """
    gap = b" " if not word_byte[0x20] else b"\x00"
    hashes, bounds, todo, size = [], [np.zeros(1, np.int64)], [], 0

    def flush() -> None:
        nonlocal todo, size
        if todo:
            begin = np.cumsum([0] + [len(x) + 1 for x in todo])
            h, start = _piece(gap.join([*todo, b""]), word_byte)
            hashes.append(h)
            bounds.append(bounds[-1][-1] + np.searchsorted(start, begin[1:]))
            todo, size = [], 0

    for text in texts:
        text = b"" if text is None else text
        if size + len(text) > _PIECE:
            flush()
        if len(text) > _PIECE:
            parts = [_piece(x, word_byte)[0] for x in _cut(text, word_byte)]
            hashes += parts
            bounds.append(bounds[-1][-1:] + sum(map(len, parts)))
        else:
            todo.append(text)
            size += len(text) + 1
    flush()
    return (np.concatenate(hashes) if hashes else np.empty(0, np.uint64)), np.concatenate(bounds)


def _cut(text: bytes | memoryview, word_byte: np.ndarray) -> Iterator[memoryview]:
    text, at = memoryview(text), 0
    while at < len(text):
        end, reach = len(text), _PIECE
        while at + reach < len(text):
            gaps = np.flatnonzero(~word_byte[_fold[np.frombuffer(text[at:at + reach], np.uint8)]])
            if len(gaps):
                end = at + int(gaps[-1]) + 1
                break
            reach *= 2
        yield text[at:end]
        at = end


def _piece(text: bytes | memoryview, word_byte: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Word hashes and first bytes: each word is read eight bytes at a time, all words at once."""
    n = len(text)
    b = np.zeros(n + 8, np.uint8)
    np.take(_fold, np.frombuffer(text, np.uint8), out=b[:n])
    inside = np.zeros(n + 2, bool)
    np.take(word_byte, b[:n], out=inside[1:-1])
    edge = np.flatnonzero(inside[1:] != inside[:-1])
    start, rest = edge[::2], edge[1::2] - edge[::2]
    eight = np.ndarray((n + 1,), np.uint64, b, 0, (1,))
    h = rest.astype(np.uint64) * U(0x9E3779B97F4A7C15)
    huge = np.flatnonzero(rest > _LONG)
    at, left, idx = start, np.where(rest > _LONG, 8, rest), None
    while len(at):
        part = (eight[at] & _MASK[np.minimum(left, 8)]) * U(0xFF51AFD7ED558CCD)
        if idx is None:
            h = (h ^ part ^ (part >> U(32))) * U(0xC4CEB9FE1A85EC53)
            idx = np.flatnonzero(left > 8)
        else:
            h[idx] = (h[idx] ^ (h[idx] >> U(31)) ^ part ^ (part >> U(32))) * U(0xC4CEB9FE1A85EC53)
            idx = idx[left > 8]
        keep = left > 8
        at, left = at[keep] + 8, left[keep] - 8
    for i in huge:
        word = b[start[i]:start[i] + rest[i]].tobytes()
        h[i] = U(int.from_bytes(hashlib.blake2b(word, digest_size=8).digest(), "little"))
    return mix(h), start


_STEP = _rng.integers(1, 2**63, 16, dtype=np.uint64) * U(2) + U(1)


def gram_hashes(words: np.ndarray, bounds: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every run of ``n`` words inside each text, and where each text's runs begin.

    A text of fewer words gives its whole sequence as one run; a text without words none.
    """
    size = np.diff(bounds)
    runs = np.where(size >= n, size - n + 1, np.minimum(size, 1))
    out = np.concatenate([np.zeros(1, np.int64), np.cumsum(runs)])
    if len(words) >= n:
        h = np.full(len(words) - n + 1, U(n), np.uint64)
        for i in range(n):
            h = (h ^ (h >> U(29))) + words[i: len(words) - n + 1 + i] * _STEP[i % 16]
        h = mix(h)
    else:
        h = np.empty(0, np.uint64)
    # Position of each run's first word: whole runs only, none across two texts.
    pos = np.arange(out[-1]) - np.repeat(out[:-1] - bounds[:-1], runs)
    short = np.flatnonzero((size > 0) & (size < n))
    if not len(short):
        return h[pos], out
    grams = np.empty(out[-1], np.uint64)
    whole = np.ones(out[-1], bool)
    whole[out[short]] = False
    grams[whole] = h[pos[whole]]
    for k in range(1, n):
        at = short[size[short] == k]
        x = np.full(len(at), U(k))
        for j in range(k):
            x = (x ^ (x >> U(29))) + words[bounds[at] + j] * _STEP[j % 16]
        grams[out[at]] = mix(x)
    return grams, out


def distinct_sorted(values: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each text's values in increasing order, each once, and where they begin."""
    values = values.copy()
    for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
        values[a:b].sort()
    first = np.ones(len(values), bool)
    first[1:] = values[1:] != values[:-1]
    first[bounds[:-1][bounds[:-1] < len(values)]] = True
    total = np.concatenate([np.zeros(1, np.int64), np.cumsum(first)])
    return values[first], total[bounds]


def utf8(column) -> list[memoryview | None]:
    """The UTF-8 bytes of each value of an Arrow string array, without decoding."""
    import pyarrow as pa

    if hasattr(column, "combine_chunks"):
        column = column.combine_chunks()
    column = column.cast(pa.large_string()) if not pa.types.is_large_string(column.type) else column
    _, offsets, data = column.buffers()
    off = np.frombuffer(offsets, dtype=np.int64)[column.offset: column.offset + len(column) + 1]
    whole = memoryview(data) if data is not None else memoryview(b"")
    valid = column.is_valid().to_numpy(zero_copy_only=False)
    return [whole[off[i]:off[i + 1]] if valid[i] else None for i in range(len(column))]
