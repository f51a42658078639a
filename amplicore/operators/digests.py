"""MD5 of many short texts at once, in columns of numbers."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

_ADD = [int(abs(np.sin(np.float64(i))) * 2**32) for i in range(1, 65)]
_TURN = [t for row in ((7, 12, 17, 22), (5, 9, 14, 20), (4, 11, 16, 23), (6, 10, 15, 21)) for t in row * 4]
_WORD = [*range(16), *((5 * i + 1) % 16 for i in range(16)), *((3 * i + 5) % 16 for i in range(16)), *(7 * i % 16 for i in range(16))]
_START = (0x67452301, 0xEFCDAB89, 0x98BADCFE, 0x10325476)
_TENS = 10 ** np.arange(1, 19, dtype=np.int64)
#: Texts whose words fit a core's cache together.
TEXTS = 1 << 13
#: Reads that are hashed at once.
BLOCK = 1 << 16


def _block(words: list, state: list[np.ndarray]) -> list[np.ndarray]:
    a, b, c, d = (x.copy() for x in state)
    f, g = np.empty_like(a), np.empty_like(a)
    for i in range(64):
        if i < 32:
            x, y, z = (b, c, d) if i < 16 else (d, b, c)
            np.bitwise_xor(y, z, out=f)
            np.bitwise_and(f, x, out=f)
            np.bitwise_xor(f, z, out=f)
        elif i < 48:
            np.bitwise_xor(b, c, out=f)
            np.bitwise_xor(f, d, out=f)
        else:
            np.invert(d, out=f)
            np.bitwise_or(f, b, out=f)
            np.bitwise_xor(f, c, out=f)
        f += a
        w = words[_WORD[i]]
        if isinstance(w, np.ndarray):
            f += w
            w = 0
        f += np.uint32((w + _ADD[i]) & 0xFFFFFFFF)
        np.left_shift(f, np.uint32(_TURN[i]), out=g)
        np.right_shift(f, np.uint32(32 - _TURN[i]), out=f)
        f |= g
        f += b
        a, b, c, d, f = d, f, b, c, a
    return [x + y for x, y in zip(state, (a, b, c, d), strict=True)]


def md5(text: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and second half of the digest of each row's bytes, as numbers that compare as the hexadecimal text does."""
    n, length = text.shape
    tail = np.zeros((length + 8) // 64 * 64 + 64 - length, np.uint8)
    tail[0] = 128
    tail[-8:] = np.frombuffer((8 * length).to_bytes(8, "little"), np.uint8)
    own = -(-length // 4)
    rest = tail[4 * own - length :].view("<u4").tolist()  # words that are the same in all rows
    first, second = np.empty(n, np.uint64), np.empty(n, np.uint64)
    for at in range(0, n, TEXTS):
        part = text[at : at + TEXTS]
        padded = np.empty((len(part), 4 * own), np.uint8)
        padded[:, :length] = part
        padded[:, length:] = tail[: 4 * own - length]
        words = [*np.ascontiguousarray(padded.view("<u4").T), *rest]
        state = [np.full(len(part), x, np.uint32) for x in _START]
        for k in range(0, len(words), 16):
            state = _block(words[k : k + 16], state)
        a, b, c, d = (x.byteswap().astype(np.uint64) for x in state)
        first[at : at + TEXTS] = a << np.uint64(32) | b
        second[at : at + TEXTS] = c << np.uint64(32) | d
    return first, second


def numbered_md5(keys: list[bytes], start: np.ndarray, stop: np.ndarray, end: bytes = b"") -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Digests of key, number and end for each key's numbers from start to stop (included), some keys at a time: each text's key by
    its place, in order, and the digest's halves."""
    n = stop - start + 1
    upto = np.cumsum(n)
    size = np.array([len(k) for k in keys])
    at = 0
    while at < len(keys):
        to = max(at + 1, int(np.searchsorted(upto, (upto[at - 1] if at else 0) + BLOCK, "right")))
        cell = np.repeat(np.arange(at, to), n[at:to])
        number = np.arange(len(cell)) - np.repeat(upto[at:to] - n[at:to] - (upto[at - 1] if at else 0), n[at:to]) + start[cell]
        digits = np.searchsorted(_TENS, number, "right") + 1
        first, second = np.empty(len(cell), np.uint64), np.empty(len(cell), np.uint64)
        kind = size[cell] * 32 + digits
        for k in np.unique(kind):
            size_, digits_ = divmod(int(k), 32)
            here = np.flatnonzero(kind == k)
            text = np.empty((len(here), size_ + digits_ + len(end)), np.uint8)
            of = np.flatnonzero(size[at:to] == size_) + at
            text[:, :size_] = np.frombuffer(b"".join(keys[i] for i in of), np.uint8).reshape(len(of), size_)[np.searchsorted(of, cell[here])]
            text[:, size_ + digits_ :] = np.frombuffer(end, np.uint8)
            q = number[here]
            for place in range(size_ + digits_ - 1, size_ - 1, -1):
                up = q // 10
                text[:, place] = q - 10 * up + 48
                q = up
            first[here], second[here] = md5(text)
        yield cell, first, second
        at = to


def as_bytes(first: np.ndarray, second: np.ndarray) -> list[bytes]:
    """Digests of 16 bytes."""
    both = np.stack([first, second], 1).astype(">u8").tobytes()
    return [both[i : i + 16] for i in range(0, len(both), 16)]
