"""Suffix arrays, common prefixes and window look-ups in numpy, for one shard of text."""

from __future__ import annotations

import numpy as np

SEPARATOR = 0xFF  # never part of UTF-8
KMER = 20  # bytes of an anchor
CHUNK = 1 << 18  # positions handled at once
_POSITION_BITS = 20  # of an ordering key; the rest is hash.  Fixed, so that equal windows order alike everywhere
_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)  # odd, so products lose nothing


def packed_words(text: np.ndarray) -> np.ndarray:
    """The eight bytes from each position on as one big-endian number; zeros behind the end."""
    word = np.zeros(len(text) + 8, np.uint64)
    word[: len(text)] = text
    for size in (1, 2, 4):
        word[:-size] = (word[:-size] << np.uint64(8 * size)) | word[size:]
    return word[: len(text)]


def suffix_array(text: np.ndarray) -> np.ndarray:
    """All suffixes in order, by Larsson-Sadakane refinement.

    Suffixes start out grouped by their first eight bytes.  Each round sorts
    only inside groups that still hold several suffixes, by the group that the
    suffix ``known`` bytes further on is in, and doubles ``known``.  A shard is
    far below 2 GB, so places fit 32 bits.
    """
    n = len(text)
    keys = packed_words(text)
    order = np.argsort(keys).astype(np.int32)
    keys = keys[order]
    slots = np.arange(n, dtype=np.int32)
    rank = np.zeros(n + 1, np.int32)  # a group's number is the place of its first member, plus one
    known = 8
    while len(slots):
        opens = np.ones(len(slots), bool)
        opens[1:] = keys[1:] != keys[:-1]
        heads = slots[opens]
        rank[order[slots]] = np.repeat(heads, np.diff(np.append(np.flatnonzero(opens), len(slots)))) + 1
        alone = opens & np.append(opens[1:], True)
        slots = slots[~alone]
        if not len(slots):
            break
        members = order[slots]
        keys = rank[members].astype(np.int64)
        keys <<= 32
        keys |= rank[np.minimum(members.astype(np.int64) + known, n)]
        moved = np.argsort(keys)
        order[slots] = members[moved]
        keys = keys[moved]
        known *= 2
    return order


def common_prefixes(text: np.ndarray, order: np.ndarray, cap: int) -> np.ndarray:
    """Length of the prefix each suffix shares with the one before it, at most ``cap``, by Kasai's rule.

    Going one byte on in the text shortens that prefix by at most one, so most
    comparisons go on where the last one ended.  Many stretches of the text are
    walked side by side.
    """
    n = len(text)
    before = np.full(n, -1, np.int32)
    before[order[1:]] = order[:-1]
    words = np.concatenate([packed_words(text), np.zeros(cap + 16, np.uint64)])
    lanes = max(1, min(8192, n // 64))
    length = -(-n // lanes)
    starts = np.arange(0, n, length)
    shared = np.zeros(n, np.int16)
    held = np.zeros(len(starts), np.int64)
    edges = np.uint64(1) << (np.uint64(8) * np.arange(1, 8, dtype=np.uint64))
    for step in range(length):
        here = starts + step
        here = here[here < n]
        held = np.maximum(held[: len(here)] - 1, 0)
        other = before[here].astype(np.int64)
        held[other < 0] = 0
        going = np.flatnonzero(other >= 0)
        while len(going):
            at = held[going]
            differ = words[here[going] + at] ^ words[other[going] + at]
            equal = 8 - np.searchsorted(edges, differ, side="right") - (differ > 0)
            # Bytes behind the end read as zeros on one side only: cut to what the text holds.
            room = n - np.maximum(here[going], other[going]) - at
            held[going] = np.minimum(at + np.minimum(equal, room), cap)
            going = going[(equal == 8) & (room > 8) & (at + 8 < cap)]
        shared[here] = held
    return shared[order]


def window_groups(text: np.ndarray, order: np.ndarray, is_window: np.ndarray, owner: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Groups of equal ``size``-byte windows, in order of their bytes.

    Returns each position's group (-1 where no window starts), a position that
    stands for each group, and the smallest owner in it.
    """
    opens = common_prefixes(text, order, size) < size
    first = np.flatnonzero(opens)
    held = np.where(is_window[order], owner[order], np.iinfo(np.int64).max)
    least = np.minimum.reduceat(held, first)
    stands = order[first]
    real = is_window[stands]  # a window's whole group are windows: it holds no separator
    number = np.where(real, np.cumsum(real) - 1, -1).astype(np.int32)
    group = np.empty(len(text), np.int32)
    group[order] = np.repeat(number, np.diff(np.append(first, len(order))))
    return np.where(is_window, group, -1), stands[real], least[real]


def matched(keys: np.ndarray, sorted_keys: np.ndarray) -> np.ndarray:
    """Place of each key in ``sorted_keys`` by binary search, -1 where it is absent."""
    if not len(sorted_keys):
        return np.full(len(keys), -1)
    place = np.minimum(np.searchsorted(sorted_keys, keys), len(sorted_keys) - 1)
    return np.where(sorted_keys[place] == keys, place, -1)


def window_keys(text: np.ndarray, positions: np.ndarray, size: int) -> np.ndarray:
    """The windows at ``positions`` as byte strings that compare like their bytes."""
    if not len(positions):
        return np.zeros(0, f"S{size}")
    return np.ascontiguousarray(np.lib.stride_tricks.sliding_window_view(text, size)[positions]).view(f"S{size}").ravel()


def anchor_runs(texts: list[bytes], size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Runs of neighbouring windows of ``size`` bytes that share their anchor.

    A window's anchor is the one of its ``KMER``-byte strings with the smallest
    hash, the leftmost among equals.  That depends on the window's bytes alone:
    equal windows have equal anchors at the same place inside them.  Returns per
    run the text's number, the first and last window and the anchor's hash.
    """
    found: list[tuple[np.ndarray, ...]] = []
    numbers, offsets, parts, held = [], [], [], 0

    def flush() -> None:
        nonlocal numbers, offsets, parts, held
        if parts:
            found.append(_runs_of(numbers, offsets, parts, size))
        numbers, offsets, parts, held = [], [], [], 0

    for number, text in enumerate(texts):
        # A long text goes in stretches that overlap by a window less one byte.
        for at in range(0, max(len(text) - size + 1, 0), CHUNK - size + 1):
            part = text[at : at + CHUNK]
            if held + len(part) > CHUNK:
                flush()
            numbers.append(number)
            offsets.append(at)
            parts.append(part)
            held += len(part)
    flush()
    if not found:
        return tuple(np.zeros(0, kind) for kind in (np.int64, np.int64, np.int64, np.uint64))
    return tuple(np.concatenate(x) for x in zip(*found, strict=True))


def _runs_of(numbers: list[int], offsets: list[int], parts: list[bytes], size: int) -> tuple[np.ndarray, ...]:
    data = np.frombuffer(b"".join(parts), np.uint8)
    lengths = np.array([len(p) for p in parts])
    ends = np.cumsum(lengths)
    hashes = _kmer_hashes(data)
    low = np.uint64((1 << _POSITION_BITS) - 1)
    key = (hashes & ~low) | np.arange(len(hashes), dtype=np.uint64)
    span = size - KMER + 1  # anchors per window
    width = 1
    least = key
    while 2 * width <= span:
        least = np.minimum(least[:-width], least[width:])
        width *= 2
    if width < span:
        least = np.minimum(least[: len(least) - (span - width)], least[span - width :])
    anchor = (least & low).astype(np.int64)
    windows = lengths - size + 1
    at = np.repeat(ends - lengths - (np.cumsum(windows) - windows), windows) + np.arange(windows.sum())
    chosen = anchor[at]
    opens = np.ones(len(at), bool)
    opens[1:] = chosen[1:] != chosen[:-1]
    first = np.flatnonzero(opens)
    last = np.append(first[1:], len(at)) - 1
    part = np.searchsorted(ends, at[first], side="right")
    shift = np.array(offsets)[part] - (ends - lengths)[part]
    return np.array(numbers)[part], at[first] + shift, at[last] + shift, hashes[chosen[first]]


def _kmer_hashes(data: np.ndarray) -> np.ndarray:
    """A 64-bit hash of the ``KMER`` bytes from each position on: polynomial by doubling, then mixed."""
    table = np.random.default_rng(5).integers(0, 1 << 63, 256, np.uint64)
    power: dict[int, np.uint64] = {1: _MULTIPLIER}
    by_size = {1: table[data]}
    size = 1
    with np.errstate(over="ignore"):
        while 2 * size <= KMER:
            half = by_size[size]
            by_size[2 * size] = half[:-size] * power[size] + half[size:]
            power[2 * size] = power[size] * power[size]
            size *= 2
        whole, have = by_size[size], size
        while have < KMER:
            step = next(s for s in sorted(by_size, reverse=True) if s <= KMER - have)
            n = len(data) - have - step + 1
            whole = whole[:n] * power[step] + by_size[step][have : have + n]
            have += step
        whole = (whole ^ (whole >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
        return whole ^ (whole >> np.uint64(32))
