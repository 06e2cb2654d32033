"""Hashes over the bytes and words of many texts at once, in numpy."""

from __future__ import annotations

import re

import numpy as np

U64 = np.uint64
#: Bytes that are hashed at a time.
STEP = 1 << 20
_SPACE = re.compile(rb"[\x20\x09-\x0D]")
_MULTIPLIER = U64(0x9E3779B97F4A7C15 | 1)


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit reaches every output bit."""
    x = x ^ (x >> U64(30))
    x *= U64(0xBF58476D1CE4E5B9)
    x ^= x >> U64(27)
    x *= U64(0x94D049BB133111EB)
    x ^= x >> U64(31)
    return x


_BYTE_VALUES = mix(np.arange(1, 257, dtype=U64) * _MULTIPLIER)
_WORD_FACTORS = mix(np.arange(1000, 1008, dtype=U64)) | U64(1)
_INVERSE = U64(pow(int(_MULTIPLIER), -1, 1 << 64))
_powers = [np.ones(1, U64), np.ones(1, U64)]


def _powers_to(n: int) -> list[np.ndarray]:
    if len(_powers[0]) <= n:
        size = 1 << (n + 1).bit_length()
        for k, base in enumerate((_MULTIPLIER, _INVERSE)):
            p = np.full(size, base, U64)
            p[0] = 1
            _powers[k] = np.multiply.accumulate(p)
    return _powers


def prefix_sums(data: np.ndarray) -> np.ndarray:
    """Sums from which ``range_hash`` takes the hash of any range of ``data``."""
    out = np.empty(len(data) + 1, U64)
    out[0] = 0
    np.cumsum(_BYTE_VALUES[data] * _powers_to(len(data))[0][:len(data)], out=out[1:])
    return out


def range_hash(sums: np.ndarray, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
    """Hash of bytes start..stop; equal bytes have equal hashes wherever they stand."""
    return mix((sums[stop] - sums[start]) * _powers_to(len(sums))[1][start])


def joined(texts: list[bytes], gap: bytes) -> tuple[np.ndarray, np.ndarray]:
    """All texts in one byte array, ``gap`` after each, and where each starts
    (with the total length last)."""
    lens = np.fromiter(map(len, texts), np.int64, len(texts)) + len(gap)
    starts = np.concatenate([[0], np.cumsum(lens)])
    return np.frombuffer(gap.join([*texts, b""]), np.uint8), starts


def _word_hashes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Hash and text number of each word, in order."""
    data, starts = joined(texts, b" ")
    upper = (data >= 65) & (data <= 90)
    data = data + (upper.view(np.uint8) << 5)
    word = (data != 32) & ((data < 9) | (data > 13))
    edge = np.flatnonzero(np.diff(np.concatenate([[0], word.view(np.int8), [0]])))
    first, end = edge[0::2], edge[1::2]
    return range_hash(prefix_sums(data), first, end), np.searchsorted(starts, first, "right") - 1


def word_hashes(texts: list[bytes], limit: int = STEP) -> tuple[np.ndarray, np.ndarray]:
    """``_word_hashes`` of texts of any length: about ``limit`` bytes at a time,
    long texts being cut at white space."""
    if sum(map(len, texts)) <= 2 * limit:
        return _word_hashes(texts)
    found, group, owners, size = [], [], [], 0

    def flush() -> None:
        nonlocal group, owners, size
        if group:
            h, part = _word_hashes(group)
            found.append((h, np.array(owners)[part]))
        group, owners, size = [], [], 0

    for i, t in enumerate(texts):
        at = 0
        while at < len(t):
            gap = _SPACE.search(t, at + limit) if len(t) - at > limit else None
            stop = gap.start() if gap else len(t)
            group.append(t[at:stop])
            owners.append(i)
            size += stop - at
            at = stop
            if size >= limit:
                flush()
    flush()
    if not found:
        return np.empty(0, U64), np.empty(0, np.int64)
    return np.concatenate([h for h, _ in found]), np.concatenate([o for _, o in found])


def shingle_sets(texts: list[bytes], size: int = 5, limit: int = STEP) -> tuple[np.ndarray, np.ndarray]:
    """Distinct hashes of ``size``-word shingles, ascending in each text, and the
    offsets of the texts in them. A-Z count as a-z; words are runs of other
    bytes than space and 9 to 13; a text with fewer words is one shingle."""
    h, owner = word_hashes(texts, limit)
    if not len(h):
        return np.empty(0, U64), np.zeros(len(texts) + 1, np.int64)
    n_words = np.bincount(owner, minlength=len(texts))
    at = np.concatenate([[0], np.cumsum(n_words)])
    padded = np.concatenate([h, np.zeros(size, U64)])
    whole = np.zeros(len(h), U64)
    for k in range(size):
        whole += padded[k:k + len(h)] * _WORD_FACTORS[k]
    whole = mix(whole)
    left = at[owner + 1] - np.arange(len(h))  # words from here to the end of the text
    keep = left >= size
    short = np.flatnonzero((n_words > 0) & (n_words < size))
    for i in short.tolist():
        ws = h[at[i]:at[i + 1]]
        whole[at[i]] = mix((ws * _WORD_FACTORS[:len(ws)]).sum(dtype=U64, keepdims=True) + U64(len(ws)))[0]
        keep[at[i]] = True
    hashes, owner = whole[keep], owner[keep]
    order = np.argsort(hashes)
    order = order[np.argsort(owner[order].astype(np.uint32 if len(texts) > 65535 else np.uint16), kind="stable")]
    hashes, owner = hashes[order], owner[order]
    new = np.ones(len(hashes), bool)
    new[1:] = (hashes[1:] != hashes[:-1]) | (owner[1:] != owner[:-1])
    hashes, owner = hashes[new], owner[new]
    return hashes, np.concatenate([[0], np.cumsum(np.bincount(owner, minlength=len(texts)))])


def window_minimum(x: np.ndarray, width: int) -> np.ndarray:
    """Least of every ``width`` neighbours, by doubling."""
    out, have = x, 1
    while have < width:
        step = min(have, width - have)
        out = np.minimum(out[:len(out) - step], out[step:])
        have += step
    return out


def window_runs(texts: list[bytes], width: int, gram: int):
    """Runs of neighbouring windows of ``width`` bytes that share their least
    hash of ``gram`` bytes: (text, start, number of windows, that hash, hash of
    all bytes of the run). Equal windows lie in runs of equal least hash, and
    a run's bytes are its first window and the bytes after it."""
    data, starts = joined(texts, b"")
    n = len(data)
    none = np.empty(0, np.int64)
    if n < width:
        return none, none, none, none.astype(U64), none.astype(U64)
    sums = prefix_sums(data)
    at = np.arange(n - gram + 1)
    least = window_minimum(range_hash(sums, at, at + gram), width - gram + 1)
    valid = np.zeros(len(least) + 1, bool)  # window starts that do not cross a text's end
    lens = np.diff(starts)
    for a, size in zip(starts[:-1][lens >= width].tolist(), lens[lens >= width].tolist()):
        valid[a:a + size - width + 1] = True
    valid = valid[:-1]
    opens = np.ones(len(least), bool)
    opens[1:] = least[1:] != least[:-1]
    opens[1:] |= ~valid[:-1]
    opens[starts[1:-1][starts[1:-1] < len(opens)]] = True
    opens &= valid
    first = np.flatnonzero(opens)
    ends = np.flatnonzero(valid & np.append((opens | ~valid)[1:], True)) + 1
    owner = np.searchsorted(starts, first, "right") - 1
    return owner, first - starts[owner], ends - first, least[first], range_hash(sums, first, ends + width - 1)
