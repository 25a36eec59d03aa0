"""Suffix arrays in numpy: Larsson-Sadakane refinement, Kasai's common prefixes, binary search between shards."""

from __future__ import annotations

import numpy as np


def _keys(data: np.ndarray, extra: int) -> np.ndarray:
    """The eight bytes from every place on as one number; zeros behind the end."""
    padded = np.zeros(len(data) + extra + 8, np.uint8)
    padded[:len(data)] = data
    out = np.zeros(len(data) + extra, np.uint64)
    for k in range(8):
        out <<= np.uint64(8)
        out |= padded[k:k + len(out)]
    return out


def suffix_order(data: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """Suffixes in the order of their first ``depth`` bytes, and the rank of each (equal for equal prefixes).

    The first sort is on eight bytes. Then only suffixes whose group is not split yet are sorted again, by the rank of the suffix
    as far behind as is sorted already, which doubles the sorted depth.
    """
    size = len(data)
    keys = _keys(data, 0)
    order = np.argsort(keys)
    held = keys[order]
    head = np.ones(size, bool)
    head[1:] = held[1:] != held[:-1]
    places = np.flatnonzero(head)
    rank = np.empty(size, np.int64)
    rank[order] = places[np.cumsum(head) - 1]
    done = 8
    open_ = ~(head & np.append(head[1:], True))  # places in groups of several
    while done < depth:
        index = np.flatnonzero(open_)
        if not len(index):
            break
        some = order[index]
        behind = some + done
        second = np.where(behind < size, rank[np.minimum(behind, size - 1)] + 1, 0)
        both = (rank[some].astype(np.uint64) << np.uint64(32)) | second.astype(np.uint64)
        turn = np.argsort(both)
        some, both = some[turn], both[turn]
        order[index] = some
        fresh = np.ones(len(index), bool)
        fresh[1:] = both[1:] != both[:-1]
        rank[some] = index[np.flatnonzero(fresh)][np.cumsum(fresh) - 1]
        alone = fresh & np.append(fresh[1:], True)
        open_[index[alone]] = False
        done *= 2
    return order, rank


def common_prefixes(data: np.ndarray, order: np.ndarray, rank: np.ndarray, depth: int) -> np.ndarray:
    """For every place in ``order``, the bytes its suffix shares with the one before it, up to ``depth``.

    As Kasai's method goes through the text: if the neighbour of a suffix lies one behind the neighbour of the suffix
    before it and the bytes passed are equal, one byte less is shared. Only where such a chain begins are bytes compared.
    """
    size = len(data)
    before = np.full(size, -1, np.int64)
    before[order[1:]] = order[:-1]
    shared = np.zeros(size, np.int64)
    equal = before >= 0
    equal[equal] = rank[np.flatnonzero(equal)] == rank[before[equal]]
    shared[equal] = depth
    open_ = (before >= 0) & ~equal
    chained = np.zeros(size, bool)
    chained[1:] = open_[1:] & open_[:-1] & (before[1:] == before[:-1] + 1)
    inside = np.flatnonzero(chained)
    chained[inside] = data[inside - 1] == data[before[inside] - 1]
    heads = np.flatnonzero(open_ & ~chained)
    shared[heads] = _compared(_keys(data, depth + 8), heads, before[heads], depth)
    # Down the chains: one less for each step from the head.
    last = np.maximum.accumulate(np.where(chained, -1, np.arange(size)))
    inside = np.flatnonzero(chained)
    shared[inside] = shared[last[inside]] - (inside - last[inside])
    return np.minimum(shared, depth)[order]


def _compared(keys: np.ndarray, left: np.ndarray, right: np.ndarray, depth: int) -> np.ndarray:
    """Bytes that the suffixes at ``left`` and ``right`` share, up to ``depth``."""
    out = np.zeros(len(left), np.int64)
    active = np.arange(len(left))
    done = 0
    while len(active) and done < depth:
        differ = keys[left[active] + done] ^ keys[right[active] + done]
        ended = np.flatnonzero(differ)
        if len(ended):
            rest = differ[ended]
            extra = np.zeros(len(ended), np.int64)
            for k in range(1, 8):
                extra += rest < np.uint64(1 << (8 * (8 - k)))
            out[active[ended]] = done + extra
        active = active[differ == 0]
        done += 8
        out[active] = done
    return np.minimum(out, depth)


def repeated_windows(data: np.ndarray, starts: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Class of every window of ``width`` bytes at ``starts``: equal windows, equal class; and the classes' number."""
    depth = 8
    while depth < width:
        depth *= 2
    order, rank = suffix_order(data, depth)
    shared = common_prefixes(data, order, rank, depth)
    kind = np.empty(len(data), np.int64)
    kind[order] = np.cumsum(shared < width) - 1
    return kind[starts], kind


def found_in(sorted_keys: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Which keys a sorted array holds, by binary search."""
    if not len(sorted_keys):
        return np.zeros(len(keys), bool)
    place = np.searchsorted(sorted_keys, keys)
    place[place == len(sorted_keys)] = 0
    return sorted_keys[place] == keys
