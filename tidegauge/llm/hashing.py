"""Hashes of words and word windows, and sequence helpers, on arrays."""

from __future__ import annotations

import bisect
import functools
from collections.abc import Hashable, Iterator, Sequence

import numpy as np
import xxhash

MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)


def mixed(x: np.ndarray) -> np.ndarray:
    """Spreads 64-bit values; a bijection."""
    x = x ^ (x >> np.uint64(31))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(29))


def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each `width` neighbours, from minima that run forth and back in blocks."""
    n = len(values)
    blocks = -(-n // width)
    padded = np.full(blocks * width, np.iinfo(values.dtype).max, values.dtype)
    padded[:n] = values
    grid = padded.reshape(blocks, width)
    forth = np.minimum.accumulate(grid, axis=1).ravel()
    back = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(back[: n - width + 1], forth[width - 1 : n])


def words_of(text: str) -> list[bytes]:
    """Lower-case words between ASCII white space."""
    return text.lower().encode().split()


#: Bytes of text whose words are hashed at once, cut between words.
STRETCH = 1 << 17
#: Odd, so that its powers have inverses modulo 2^64.
BASE = 0x9E3779B97F4A7C15
SPACE = np.zeros(256, bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True


@functools.cache
def powers(base: int) -> np.ndarray:
    """Powers of `base` modulo 2^64, for the bytes of a stretch and its last word."""
    out = np.full(2 * STRETCH, base, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


def stretch_hashes(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Where the words of at most two STRETCH bytes start, and their hashes."""
    codes = np.frombuffer(data, np.uint8)
    word = np.zeros(len(codes) + 2, bool)
    np.logical_not(SPACE[codes], out=word[1:-1])
    edge = np.flatnonzero(word[1:] != word[:-1])
    starts, ends = edge[::2], edge[1::2]
    sums = np.zeros(len(codes) + 1, np.uint64)
    np.cumsum(powers(BASE)[: len(codes)] * (codes.astype(np.uint64) + np.uint64(1)), out=sums[1:])
    value = (sums[ends] - sums[starts]) * powers(pow(BASE, -1, 1 << 64))[starts]
    return starts, mixed(value + (ends - starts).astype(np.uint64) * MULTIPLIER)


def long_hashes(data: bytes) -> np.ndarray:
    """Hashes of the words of a text of any length, stretch by stretch."""
    out, at = [], 0
    while at < len(data):
        end = at + STRETCH
        while end < len(data) and not SPACE[data[end]]:
            end += 1
        if end - at <= 2 * STRETCH:
            out.append(stretch_hashes(data[at:end])[1])
        else:  # ends in a word of over a stretch
            out += [stretch_hashes(w)[1] if len(w) <= STRETCH else word_hashes([w]) for w in data[at:end].split()]
        at = end
    return np.concatenate(out)


def hashed_words(texts: Sequence[str]) -> Iterator[np.ndarray]:
    """For each text, a 64-bit hash of each lower-case word between ASCII white space, in order.

    The hash is the polynomial of the word's bytes, by differences of running sums over many
    texts at once, so that no word becomes an object of its own.
    """
    held: list[bytes] = []

    def flush() -> Iterator[np.ndarray]:
        starts, hashes = stretch_hashes(b"\n".join(held))
        ends = np.searchsorted(starts, np.cumsum([len(d) + 1 for d in held]))
        yield from np.split(hashes, ends[:-1])
        held.clear()

    size = 0
    for text in texts:
        data = text.lower().encode()
        if held and size + len(data) > STRETCH:
            yield from flush()
            size = 0
        if len(data) > STRETCH:
            yield long_hashes(data)
            continue
        held.append(data)
        size += len(data) + 1
    if held:
        yield from flush()


def word_hashes(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))


def shingles(hashes: np.ndarray, k: int) -> np.ndarray:
    """Hash of each window of k words; fewer words are one window."""
    k = min(k, len(hashes))
    out = np.zeros(len(hashes) - k + 1 if k else 0, np.uint64)
    for i in range(k):
        out = out * MULTIPLIER + hashes[i : i + len(out)]
    return mixed(out + np.uint64(k))


def labelled(values: np.ndarray) -> np.ndarray:
    """Each value joined with how often it came before, so that all become distinct."""
    order = np.argsort(values, kind="stable")
    ordered = values[order]
    starts = np.flatnonzero(np.r_[True, ordered[1:] != ordered[:-1]]) if len(values) else order
    times = np.empty(len(values), np.uint64)
    times[order] = np.arange(len(values)) - np.repeat(starts, np.diff(np.r_[starts, len(values)]))
    return mixed(values + times * np.uint64(0xD6E8FEB86659FD93))


def rising(values: Sequence[int]) -> int:
    """Length of the longest strictly rising subsequence."""
    ends: list[int] = []
    for value in values:
        at = bisect.bisect_left(ends, value)
        if at == len(ends):
            ends.append(value)
        else:
            ends[at] = value
    return len(ends)


def common_places(a: Sequence[Hashable], b: Sequence[Hashable]) -> list[int]:
    """Indexes in `a` of a longest common subsequence of the two."""
    return [i for i, _ in common_pairs(a, b)]


def common_pairs(a: Sequence[Hashable], b: Sequence[Hashable]) -> list[tuple[int, int]]:
    """Indexes in both of a longest common subsequence of the two.

    Only values that occur in both are compared: for each, its places in `b` from last to
    first, of which the longest rising chain is sought, so what shares little costs little.
    """
    places: dict[Hashable, list[int]] = {}
    for j, value in enumerate(b):
        places.setdefault(value, []).append(j)
    ends: list[int] = []
    tails: list[int] = []  # the link that ends the chain of each length
    links: list[tuple[int, int, int]] = []
    for i, value in enumerate(a):
        for j in reversed(places.get(value, ())):
            length = bisect.bisect_left(ends, j)
            links.append((i, j, tails[length - 1] if length else -1))
            if length == len(ends):
                ends.append(j)
                tails.append(len(links) - 1)
            else:
                ends[length], tails[length] = j, len(links) - 1
    out, at = [], tails[-1] if tails else -1
    while at >= 0:
        i, j, at = links[at]
        out.append((i, j))
    return out[::-1]
