"""Array helpers that run inside tasks: words, rolling hashes, minimizers and runs over a whole Arrow batch at once.

Every function works on flat arrays of a batch and on the offsets of its documents, without a Python loop over words or
bytes. Hashing walks over chunks of bounded size, so that one very long text costs time but little memory.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

#: ASCII white space: the blank and the six control characters from tab to carriage return (0x1C-0x1F are not white).
WHITE = np.zeros(256, dtype=bool)
WHITE[[9, 10, 11, 12, 13, 32]] = True
CHUNK = 1 << 18
FIRST, SECOND = 0x9E3779B97F4A7C15, 0xD1342543DE82EF95


def flat(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all texts in a row, and the offsets of the texts; null counts as empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    if texts.null_count:
        texts = texts.fill_null("" if not pa.types.is_binary(texts.type) else b"")
    wide = pa.types.is_large_string(texts.type) or pa.types.is_large_binary(texts.type)
    if len(texts) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = texts.buffers()
    places = np.frombuffer(offsets, np.int64 if wide else np.int32)[texts.offset:texts.offset + len(texts) + 1]
    places = places.astype(np.int64)
    whole = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return whole[places[0]:places[-1]], places - places[0]


def lists(flat_values: np.ndarray, bounds: np.ndarray, kind: pa.DataType) -> pa.ListArray:
    """A list column from flat values and bounds."""
    return pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(flat_values, kind))


def mix(values: np.ndarray) -> np.ndarray:
    """Spread 64-bit values evenly (a bijection)."""
    x = values ^ (values >> np.uint64(30))
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def _powers(base: int, count: int) -> np.ndarray:
    steps = np.full(int(count), base, dtype=np.uint64)
    if count:
        steps[0] = 1
    return np.multiply.accumulate(steps)


_TABLES: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _tables(base: int, count: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd base modulo 2**64 and of its inverse, at least ``count`` of each."""
    known = _TABLES.get(base)
    if known is None or len(known[0]) < count:
        size = 1 << int(max(count - 1, CHUNK)).bit_length()
        if count > 4 * CHUNK:
            return _powers(base, count), _powers(pow(base, -1, 1 << 64), count)
        known = _TABLES[base] = _powers(base, size), _powers(pow(base, -1, 1 << 64), size)
    return known


#: Most symbols under one polynomial. Modulo 2**64 these lose a bit or more with each doubling of the length (two Thue-Morse words of
#: 1,024 symbols agree under every odd base), so longer content is hashed block by block, each under a key of its place.
BLOCK, WINDOW = 128, 512


def range_hashes(values: np.ndarray, starts: np.ndarray, ends: np.ndarray, base: int = FIRST) -> np.ndarray:
    """Hash of ``values[start:end]`` for every range; starts and ends never decrease. Equal content, equal hash."""
    size = ends - starts
    long = size > BLOCK
    if not long.any():
        return _short_hashes(values, starts, ends, base)
    out = np.empty(len(starts), np.uint64)
    out[~long] = _short_hashes(values, starts[~long], ends[~long], base)
    places = np.flatnonzero(long)
    blocks = np.concatenate(([0], np.cumsum(-(-size[places] // BLOCK))))
    first = 0
    while first < len(places):
        stop = max(int(np.searchsorted(blocks, blocks[first] + CHUNK // 4, "right")) - 1, first + 1)
        some = places[first:stop]
        out[some] = _long_hashes(values, starts[some], ends[some], base)
        first = stop
    return out


def _long_hashes(values: np.ndarray, starts: np.ndarray, ends: np.ndarray, base: int) -> np.ndarray:
    """Sums of the blocks' hashes, each mixed with its place in the range before it is added."""
    count = -(-(ends - starts) // BLOCK)
    heads = np.cumsum(count) - count
    owner = np.repeat(np.arange(len(starts)), count)
    inner = np.arange(len(owner)) - heads[owner]
    begin = starts[owner] + inner * BLOCK
    end = np.minimum(begin + BLOCK, ends[owner])
    order = np.argsort(begin, kind="stable")  # ranges may overlap
    hashes = np.empty(len(begin), np.uint64)
    hashes[order] = _short_hashes(values, begin[order], end[order], base)
    keyed = mix(hashes ^ mix((inner.astype(np.uint64) + np.uint64(1)) * np.uint64(base)))
    sums = np.add.reduceat(keyed, heads)
    return mix(sums + (ends - starts).astype(np.uint64) * np.uint64(SECOND))


def _short_hashes(values: np.ndarray, starts: np.ndarray, ends: np.ndarray, base: int) -> np.ndarray:
    """Hashes of ranges of up to ``BLOCK`` symbols; starts never decrease."""
    out = np.empty(len(starts), np.uint64)
    place = 0
    while place < len(starts):
        first = starts[place]
        stop = max(int(np.searchsorted(starts, first + CHUNK, "left")), place + 1)
        last = int(ends[place:stop].max())
        power, inverse = _tables(base, last - first + 1)
        part = values[first:last].astype(np.uint64)
        part += np.uint64(1)
        part *= power[:len(part)]
        sums = np.empty(len(part) + 1, np.uint64)
        sums[0] = 0
        np.cumsum(part, out=sums[1:])
        begin, end = starts[place:stop] - first, ends[place:stop] - first
        got = sums[end]
        got -= sums[begin]
        got *= inverse[begin]
        got += (end - begin).astype(np.uint64) * np.uint64(SECOND)
        out[place:stop] = mix(got)
        place = stop
    return out


def rolling_hashes(values: np.ndarray, width: int, base: int = FIRST) -> np.ndarray:
    """Hash of every ``values[i:i + width]``."""
    count = len(values) - width + 1
    if count <= 0:
        return np.zeros(0, np.uint64)
    if width > WINDOW:  # from windows of bounded width, each mixed with its place
        inner = rolling_hashes(values, WINDOW, base)
        out = np.full(count, width, np.uint64)
        for number, place in enumerate([*range(0, width - WINDOW, WINDOW), width - WINDOW]):
            out += mix(inner[place:place + count] ^ mix(np.full(1, (number + 1) * base % (1 << 64), np.uint64)))
        return mix(out)
    out = np.empty(count, np.uint64)
    for first in range(0, count, CHUNK):
        stop = min(first + CHUNK, count)
        power, inverse = _tables(base, CHUNK + width + 1)
        part = values[first:stop + width - 1].astype(np.uint64)
        part += np.uint64(1)
        part *= power[:len(part)]
        sums = np.empty(len(part) + 1, np.uint64)
        sums[0] = 0
        np.cumsum(part, out=sums[1:])
        got = sums[width:]
        got = got - sums[:-width]
        got *= inverse[:len(got)]
        out[first:stop] = mix(got)
    return out


def words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of all words in the bytes, and the offset of each document's words among them."""
    if len(data) == 0:
        none = np.zeros(0, np.int64)
        return none, none, np.zeros(len(offsets), np.int64)
    inside = ~WHITE[data]
    opens = inside.copy()
    opens[1:] &= ~inside[:-1]
    closes = inside.copy()
    closes[:-1] &= ~inside[1:]
    edges = offsets[:-1][offsets[:-1] < offsets[1:]]
    opens[edges] = inside[edges]
    tails = offsets[1:][offsets[:-1] < offsets[1:]] - 1
    closes[tails] = inside[tails]
    starts = np.flatnonzero(opens)
    return starts, np.flatnonzero(closes) + 1, np.searchsorted(starts, offsets)


def lower_ascii(data: np.ndarray) -> np.ndarray:
    """The bytes with A-Z in lower case."""
    table = np.arange(256, dtype=np.uint8)
    table[65:91] += 32
    return table[data]


def sliding_minimum(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every ``values[i:i + width]``, by doubling."""
    if len(values) < width:
        return values[:0]
    have, out = 1, values
    while have * 2 <= width:
        out = np.minimum(out[:-have], out[have:])
        have *= 2
    if have < width:
        rest = width - have
        out = np.minimum(out[:-rest], out[rest:])
    return out


def windows(offsets: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Starts of all windows of ``width`` symbols inside one document, and the document of each."""
    counts = np.maximum(np.diff(offsets) - width + 1, 0)
    owner = np.repeat(np.arange(len(counts)), counts)
    before = np.cumsum(counts) - counts
    return np.arange(len(owner)) - before[owner] + offsets[:-1][owner], owner


def anchored_runs(symbols: np.ndarray, offsets: np.ndarray, width: int, gram: int) -> dict[str, np.ndarray]:
    """Cut the windows of each document into runs that share one anchor.

    The anchor of a window is its leftmost ``gram`` symbols of smallest hash: a function of the window's content alone,
    so equal windows have equal anchors at equal places wherever they stand. ``start`` is the first window of the run
    and ``count`` the windows in it (both in symbols of the batch), ``doc`` the document, ``anchor`` the anchor's hash (mixed once more: the
    smallest hashes alone would not be spread evenly).
    """
    out = {name: np.zeros(0, np.int64) for name in ("start", "count", "doc")} | {"anchor": np.zeros(0, np.uint64)}
    found: list[dict[str, np.ndarray]] = []
    # Batches are walked over in stretches of whole documents, long documents in stretches that overlap by a window.
    for first, last, lo, hi in _stretches(offsets, width):
        part = symbols[first:last]
        if len(part) < width:
            continue
        grams = rolling_hashes(part, gram)
        ranked = grams & ~np.uint64((1 << 24) - 1)
        ranked |= np.arange(len(ranked), dtype=np.uint64)
        least = sliding_minimum(ranked, width - gram + 1)
        inner = np.clip(offsets[lo:hi + 1] - first, 0, len(part))
        starts, owner = windows(inner, width)
        if not len(starts):
            continue
        least = least[starts]
        fresh = np.empty(len(least), bool)
        fresh[0] = True
        np.not_equal(least[1:], least[:-1], out=fresh[1:])
        fresh[1:] |= owner[1:] != owner[:-1]
        heads = np.flatnonzero(fresh)
        where = (least[heads] & np.uint64((1 << 24) - 1)).astype(np.int64)
        found.append({"start": starts[heads] + first, "count": np.diff(np.append(heads, len(least))),
                      "doc": owner[heads] + lo, "anchor": mix(grams[where] + np.uint64(SECOND))})
    return {name: np.concatenate([one[name] for one in found]) for name in out} if found else out


STRETCH = 1 << 20


def _stretches(offsets: np.ndarray, width: int):
    """Ranges of symbols with the documents in them; a document over a stretch is cut with ``width - 1`` overlap.

    A run at such a cut becomes two runs, which the callers allow for: runs are compared by windows where their
    contents differ.
    """
    doc, count = 0, len(offsets) - 1
    while doc < count:
        stop = max(int(np.searchsorted(offsets, offsets[doc] + STRETCH, "right")) - 1, doc + 1)
        if offsets[stop] - offsets[doc] <= 2 * STRETCH:
            yield int(offsets[doc]), int(offsets[stop]), doc, stop
        else:
            for first in range(int(offsets[doc]), int(offsets[stop]) - width + 1, STRETCH):
                yield first, min(first + STRETCH + width - 1, int(offsets[stop])), doc, stop
        doc = stop


def merged(starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The union of ranges as maximal ranges in order; ranges that touch become one."""
    if not len(starts):
        return starts, ends
    order = np.argsort(starts, kind="stable")
    starts, ends = starts[order], np.maximum.accumulate(ends[order])
    fresh = np.ones(len(starts), bool)
    fresh[1:] = starts[1:] > ends[:-1]
    heads = np.flatnonzero(fresh)
    return starts[heads], ends[np.append(heads[1:], len(starts)) - 1]


def signed(values: np.ndarray) -> np.ndarray:
    """The same 64 bits as Spark's long."""
    return values.view(np.int64)


def unsigned(values) -> np.ndarray:
    return np.ascontiguousarray(np.asarray(values, dtype=np.int64)).view(np.uint64)


def kept_text(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, bounds: np.ndarray,
              keep: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The kept words of each document joined by one blank: the bytes of all documents and the bounds of each."""
    counts = np.concatenate(([0], np.cumsum(keep)))[bounds]
    starts, ends = starts[keep], ends[keep]
    sizes = ends - starts + 1
    places = np.concatenate(([0], np.cumsum(sizes)))
    index = np.arange(places[-1]) + np.repeat(starts - places[:-1], sizes)
    out = data[np.minimum(index, max(len(data) - 1, 0))] if len(data) else np.zeros(0, np.uint8)
    out[places[1:] - 1] = 32
    return out, places[counts]
