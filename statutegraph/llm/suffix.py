"""Repeated byte strings found by suffix arrays, and cut from all documents but the first.

A string of 50 bytes that stands in two places holds the same smallest 16-byte
piece (its anchor) in both.  So a first, narrow exchange finds the anchors that
several documents share, and only strings around those move: each goes to the
bucket of its anchor, where a suffix array of all that came together tells equal
ones.  The array is sorted in two stages: suffixes smaller than their successor
directly, all others by scans of the buckets of first bytes.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import mix64, small_batches, spans, staged

#: Bytes of a string that counts as repeated.
LENGTH = 50
#: Bytes of an anchor, a multiple of eight.  Fewer give fewer anchors, but more that texts share by chance.
ANCHOR = 16
#: Starts of strings that can hold an anchor, and bytes of all of them together.
STARTS = LENGTH - ANCHOR + 1
ROW = STARTS - 1 + LENGTH
#: A byte that UTF-8 never holds: it fills what is no text.
FILL = 0xFF
#: Text of a block (a row of documents, packed) and of a bucket of anchors, in bytes.
BLOCK_BYTES = 4 << 20
BUCKET_BYTES = 4 << 20
#: Texts are worked on in pieces of about so many bytes.
PIECE = 1 << 17
#: Strings around an anchor that more places share go to buckets of their own hash.
HOT = 1000
#: Suffixes sorted at once, unless a single anchor has more.
SLAB = 1 << 19

_LOW = np.uint64((1 << 40) - 1)
_NO_ID = np.iinfo(np.int64).max
_CODEC, _SMALLER = pa.Codec("zstd", 1), pa.Codec("zstd", 5)  # what moves often is worth more time


def _packed(data: np.ndarray, codec: pa.Codec = _CODEC) -> bytes:
    return codec.compress(np.ascontiguousarray(data).tobytes(), asbytes=True)


def _unpacked(data: bytes, size: int, kind=np.uint8) -> np.ndarray:
    return np.frombuffer(_CODEC.decompress(data, decompressed_size=size * np.dtype(kind).itemsize, asbytes=True), dtype=kind)


# ---------------------------------------------------------------- the suffix array


def _keys(data: np.ndarray, at: np.ndarray) -> np.ndarray:
    """The eight bytes at each place as numbers in byte order."""
    return np.lib.stride_tricks.sliding_window_view(data, 8)[at].view(">u8").ravel().astype(np.uint64)


def common_prefixes(data: np.ndarray, order: np.ndarray, depth: int = LENGTH) -> np.ndarray:
    """For each place in `order` how many bytes it shares with the one before it, `depth` at most; 0 for the first."""
    out = np.zeros(len(order), np.int64)
    view = np.lib.stride_tricks.sliding_window_view(data, depth)
    for at in range(1, len(order), 1 << 14):
        rows = view[order[at - 1 : at + (1 << 14)]]
        differ = rows[1:] != rows[:-1]
        first = differ.argmax(axis=1)
        first[(first == 0) & ~differ[:, 0]] = depth
        out[at : at + len(first)] = first
    return out


def sorted_directly(data: np.ndarray, at: np.ndarray, depth: int) -> np.ndarray:
    """Places by the `depth` bytes from there on at least: by eight bytes, then by the next ones where they tie.

    Places that are known to agree in all of `depth` bytes are not compared further.
    """
    keys = _keys(data, at)
    by = np.argsort(keys)
    at, keys = at[by], keys[by]
    new = np.concatenate(([True], keys[1:] != keys[:-1]))
    for done in range(8, depth, 8):
        tied = np.flatnonzero(~new | ~np.append(new[1:], True))
        if not len(tied):
            break
        group = np.cumsum(new[tied])
        open_ = np.zeros(group[-1] + 1, bool)
        open_[group[(common_prefixes(data, at[tied], depth) < depth) & ~new[tied]]] = True
        tied = tied[open_[group]]
        if not len(tied):
            break
        group = np.cumsum(new[tied])
        keys = _keys(data, at[tied] + done)
        by = np.lexsort((keys, group))
        at[tied], keys = at[tied[by]], keys[by]
        new[tied[1:]] |= (keys[1:] != keys[:-1]) & (group[1:] == group[:-1])
    return at


def suffix_array(rows: np.ndarray, wanted: np.ndarray, depth: int = LENGTH) -> np.ndarray:
    """The `wanted` places in rows laid end to end, by their suffixes; such as agree in `depth` bytes stand together in any order.

    A suffix ends with its row; wanted ones have `depth` bytes.  It is small if it is less than the one after it.
    Small suffixes are sorted directly.  Any other begins with a byte no less than
    the next, so going through the sorted ones from the least on meets, for each,
    the suffix after it before its own place: it is appended to those of its first
    byte.
    """
    n, width = rows.shape
    if not n:
        return np.empty(0, np.int64)
    columns, want = np.ascontiguousarray(rows.T), np.ascontiguousarray(wanted.T)
    small, needed = np.zeros((width, n), bool), want.copy()
    for c in range(width - 2, -1, -1):
        small[c] = (columns[c] < columns[c + 1]) | ((columns[c] == columns[c + 1]) & small[c + 1])
    for c in range(1, width):  # an induced suffix needs those up to the next small one
        needed[c] |= needed[c - 1] & ~small[c - 1]
    data = np.concatenate([rows.ravel(), np.zeros(depth + 8, np.uint8)])
    direct = sorted_directly(data, np.flatnonzero((needed & small).T.ravel()), depth)
    induced = np.append((needed & ~small).T.ravel(), False)  # the place before the first is the last, which is none
    limits = np.searchsorted(data[direct], np.arange(257))
    pending: list[list[np.ndarray]] = [[] for _ in range(256)]
    last = np.flatnonzero(needed[-1]) * width + width - 1
    for byte in np.unique(data[last]):
        pending[byte].append(last[data[last] == byte])
    out = []
    for byte in range(256):
        have = pending[byte]
        wave = np.concatenate(have) if have else np.empty(0, np.int64)
        while len(wave):  # runs of one byte, shorter ones first
            before = wave - 1
            wave = before[induced[before] & (data[before] == byte) & (wave % width > 0)]
            have.append(wave)
        here = np.concatenate([*have, direct[limits[byte] : limits[byte + 1]]])
        if not len(here):
            continue
        out.append(here)
        before = (here - 1)[induced[here - 1]]
        to = data[before]
        before, to = before[to > byte], to[to > byte]
        before, to = (x[(before + 1) % width > 0] for x in (before, to))
        by = np.argsort(to, kind="stable")
        values, cut = np.unique(to[by], return_index=True)
        for value, part in zip(values, np.split(before[by], cut[1:])):
            pending[value].append(part)
    order = np.concatenate(out)
    return order[wanted.ravel()[order]]


# ---------------------------------------------------------------- anchors


def _draws(data: np.ndarray) -> np.ndarray:
    """A number of 32 bits for each ANCHOR bytes, never 0, by doubling."""
    width, have, powers = 1, {1: data.astype(np.uint32) + np.uint32(1)}, {1: np.array([0x01000193], np.uint32)}
    while 2 * width <= ANCHOR:
        have[2 * width] = have[width][:-width] * powers[width] + have[width][width:]
        powers[2 * width] = powers[width] * powers[width]
        width *= 2
    rest = ANCHOR - width
    n = len(data) - ANCHOR + 1
    out = have[width][:n]
    if rest:
        out = out * powers[rest] + have[rest][width : width + n]
    for shift, factor in ((16, 0x85EBCA6B), (13, 0xC2B2AE35)):
        out ^= out >> np.uint32(shift)
        out *= np.uint32(factor)
    out ^= out >> np.uint32(16)
    return np.maximum(out, np.uint32(1))


def _hashes(data: np.ndarray, at: np.ndarray) -> np.ndarray:
    """A hash of the ANCHOR bytes at each place."""
    words = np.lib.stride_tricks.sliding_window_view(data, ANCHOR)[at].view("<u8").astype(np.uint64)
    out = np.zeros(len(at), np.uint64)
    for c in range(words.shape[1]):
        out = mix64(out + words[:, c] + np.uint64(0x9E3779B97F4A7C15))
    return out


def _sliding(f, x: np.ndarray, width: int) -> np.ndarray:
    """`f` over each `width` neighbours, by doubling."""
    n, y = 1, x
    while 2 * n <= width:
        y = f(y[:-n], y[n:])
        n *= 2
    return f(y[: len(y) - (width - n)], y[width - n :]) if n < width else y


def pieces(texts: list[np.ndarray], size: int = PIECE) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Texts of at least LENGTH bytes in groups of about `size` bytes, each followed by FILL bytes.

    Gives the data and for each piece its text's number, its place in it, its
    start in the data and its length.  Long texts are cut so that each string of
    LENGTH bytes lies in one piece.
    """
    fill = np.full(ROW, FILL, np.uint8)
    data, of, place, start, length, filled = [fill], [], [], [], [], ROW
    for i, text in enumerate(texts):
        for at in range(0, len(text) - LENGTH + 1, size):
            part = text[at : at + size + LENGTH - 1]
            data += [part, fill]
            for column, value in ((of, i), (place, at), (start, filled), (length, len(part))):
                column.append(value)
            filled += len(part) + ROW
            if filled >= size:
                yield np.concatenate(data), *(np.array(c, np.int64) for c in (of, place, start, length))
                data, of, place, start, length, filled = [fill], [], [], [], [], ROW
    if of:
        yield np.concatenate(data), *(np.array(c, np.int64) for c in (of, place, start, length))


def anchors(data: np.ndarray, start: np.ndarray, length: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The places of anchors in the data, the number drawn at every place, and the least number of the string from every place on (0: no string)."""
    draws = _draws(data)
    least = _sliding(np.minimum, draws, STARTS)
    ends = start + length - LENGTH + 1
    for a, b in zip(np.append(0, ends), np.append(start, len(least))):
        least[a:b] = 0
    none = np.zeros(STARTS - 1, np.uint32)
    most = _sliding(np.maximum, np.concatenate([none, least, none]), STARTS)
    return np.flatnonzero(most == draws), draws, least


def _texts(lengths: np.ndarray, packed: bytes) -> list[np.ndarray]:
    data = _unpacked(packed, int(lengths.sum()))
    return np.split(data, np.cumsum(lengths)[:-1])


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents packed into blocks: ids, lengths in bytes, texts."""
    ids: list = []
    texts: list[bytes] = []
    size = 0

    def block() -> pa.RecordBatch:
        packed = _SMALLER.compress(b"".join(texts), asbytes=True)
        return pa.record_batch([pa.array([ids], pa.list_(pa.int64())), pa.array([[len(t) for t in texts]], pa.list_(pa.int64())), pa.array([packed], pa.binary())], ["ids", "lengths", "texts"])

    for batch in batches:
        for i, text in zip(batch.column("id").to_pylist(), batch.column("text").cast(pa.binary())):
            ids.append(i)
            texts.append(text.as_py() or b"")
            size += len(texts[-1])
            if size >= BLOCK_BYTES:
                yield block()
                ids, texts, size = [], [], 0
    if ids:
        yield block()


def _bucket(hashes: np.ndarray, buckets: int) -> np.ndarray:
    return (hashes >> np.uint64(40)) % np.uint64(buckets)


def _block_anchors(buckets: int):
    """The anchors of each block, dealt to buckets: the rest of their hashes, ascending, and in how many of the block's documents they stand (255 at most)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block, lengths, texts in zip(*(batch.column(c).to_pylist() for c in ("block", "lengths", "texts"))):
                found, docs = [], []
                for data, of, _, start, length in pieces(_texts(np.array(lengths), texts)):
                    at, _, _ = anchors(data, start, length)
                    found.append(_hashes(data, at))
                    docs.append(of[np.searchsorted(start, at, side="right") - 1])
                if not found:
                    continue
                hashes, docs = np.concatenate(found), np.concatenate(docs)
                key = _bucket(hashes, buckets) << np.uint64(40) | hashes & _LOW
                by = np.argsort(key, kind="stable")
                key, docs = key[by], docs[by]
                new = np.concatenate(([True], key[1:] != key[:-1]))
                another = new | np.concatenate(([True], docs[1:] != docs[:-1]))
                first = np.flatnonzero(new)
                counts, key = np.minimum(np.add.reduceat(another.astype(np.int64), first), 255).astype(np.uint8), key[first]
                values, cut = np.unique(key >> np.uint64(40), return_index=True)
                low = (key & np.uint64(0xFFFFFFFF)).astype("<u4")
                high = (key >> np.uint64(32) & np.uint64(0xFF)).astype(np.uint8)
                ends = [*cut[1:], len(key)]
                columns = [
                    pa.array(values.astype(np.int64)),
                    pa.array([block] * len(values), pa.int64()),
                    *(pa.array([c[a:b].tobytes() for a, b in zip(cut, ends)], pa.binary()) for c in (low, high, counts)),
                ]
                yield pa.record_batch(columns, ["bucket", "block", "low", "high", "counts"])

    return run


def _shared_anchors(rows: pa.Table) -> pa.Table:
    """Of one bucket's anchors those that several documents have, for each block that has them; and which many have."""
    bucket = rows.column("bucket")[0].as_py()
    sizes = np.array([len(x) for x in rows.column("counts").to_pylist()])
    low, high, counts = (np.frombuffer(b"".join(rows.column(c).to_pylist()), kind) for c, kind in (("low", "<u4"), ("high", np.uint8), ("counts", np.uint8)))
    rest = high.astype(np.uint64) << np.uint64(32) | low
    by = np.argsort(rest, kind="stable")
    first = np.flatnonzero(np.concatenate(([True], rest[by][1:] != rest[by][:-1])))
    total = np.add.reduceat(counts[by].astype(np.int64), first)
    every = np.empty(len(rest), np.int64)
    every[by] = np.repeat(total, np.diff(np.append(first, len(rest))))
    row = np.repeat(np.arange(len(sizes)), sizes)
    keep = every > 1
    key = (np.uint64(bucket) << np.uint64(40)) | rest
    cut = np.searchsorted(row[keep], np.arange(len(sizes) + 1))
    key, hot = key[keep], (every[keep] > HOT).astype(np.uint8)
    some = np.flatnonzero(np.diff(cut))
    blocks = rows.column("block").to_numpy()[some]
    return pa.table([pa.array(blocks), *(pa.array([c[cut[i] : cut[i + 1]].tobytes() for i in some], pa.binary()) for c in (key, hot))], ["block", "keys", "hot"])


# ---------------------------------------------------------------- strings around anchors


def _contexts(texts: list[np.ndarray], keys: np.ndarray, hot: np.ndarray, buckets: int) -> Iterator[tuple[np.ndarray, ...]]:
    """The strings around shared anchors: bucket (-1 if the anchor is hot), row of ROW bytes, text, its place in the text.

    A row holds the strings whose least anchor this is, from its starts on, and FILL elsewhere.
    """
    for data, of, place, start, length in pieces(texts):
        at, draws, least = anchors(data, start, length)
        found = _hashes(data, at)
        key = _bucket(found, buckets) << np.uint64(40) | found & _LOW
        where = np.minimum(np.searchsorted(keys, key), len(keys) - 1)
        shared = keys[where] == key
        at, bucket = at[shared], (key[shared] >> np.uint64(40)).astype(np.int64)
        if not len(at):
            continue
        bucket[hot[where[shared]] > 0] = -1
        owned = np.lib.stride_tricks.sliding_window_view(least, STARTS)[at - STARTS + 1] == draws[at][:, None]
        low, high = owned.argmax(axis=1), STARTS - 1 - owned[:, ::-1].argmax(axis=1)
        base = at - STARTS + 1
        rows = np.lib.stride_tricks.sliding_window_view(data, ROW)[base]
        column = np.arange(ROW)
        rows[(column < low[:, None]) | (column >= high[:, None] + LENGTH)] = FILL
        piece = np.searchsorted(start, base + low, side="right") - 1
        yield bucket, rows, of[piece], base - start[piece] + place[piece]


def _one_by_one(rows: np.ndarray, text: np.ndarray, place: np.ndarray, buckets: int) -> tuple[np.ndarray, ...]:
    """Rows cut into their strings, each in a row of its own and in the bucket of its hash."""
    low, high = _bounds(rows)
    many = high - low - LENGTH + 1
    row, start = np.repeat(np.arange(len(rows)), many), spans(low, many)
    out = np.full((len(row), ROW), FILL, np.uint8)
    out[:, STARTS - 1 :] = np.lib.stride_tricks.sliding_window_view(rows.ravel(), LENGTH)[row * ROW + start]
    return _bucket(_row_hashes(out), buckets).astype(np.int64), out, text[row], place[row] + start - STARTS + 1


def _row_hashes(rows: np.ndarray) -> np.ndarray:
    words = np.ascontiguousarray(rows).view("<u4").astype(np.uint64)
    return mix64((words * mix64(np.arange(1, words.shape[1] + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))).sum(axis=1, dtype=np.uint64))


def _once(bucket: np.ndarray, rows: np.ndarray, text: np.ndarray, place: np.ndarray, ids: np.ndarray) -> tuple[tuple[np.ndarray, ...], np.ndarray, np.ndarray]:
    """What only the smallest id that has a row keeps, ordered by bucket and row; the spans that the other ids lose; where another row begins."""
    doc, digest = ids[text], _row_hashes(rows)
    by = np.lexsort((doc, digest, bucket))
    same = (digest[by][1:] == digest[by][:-1]) & (bucket[by][1:] == bucket[by][:-1])
    at = np.flatnonzero(same)
    same[at] = (rows[by[at]] == rows[by[at + 1]]).all(axis=1)
    new = np.concatenate(([True], ~same))
    later = doc[by] > doc[by[np.flatnonzero(new)]][np.cumsum(new) - 1]
    low, high = _bounds(rows[by[later]])
    lost = np.stack([text[by[later]], place[by[later]] + low, place[by[later]] + high], 1).astype("<u4")
    stay = by[~later]
    return (bucket[stay], rows[stay], text[stay], place[stay]), lost, new[~later]


def _bounds(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The first byte of text in each row and the one after its last."""
    text = rows != FILL
    return text.argmax(axis=1), ROW - text[:, ::-1].argmax(axis=1)


_TO_BUCKET = "bucket long, block long, n long, held long, rows binary, docs binary, times binary, text_of binary, place binary, lost binary"


def _to_buckets(buckets: int):
    def run(blocks: pa.Table, shared: pa.Table) -> pa.Table:
        """The strings of one block, each row once and with the smallest id that has it; what larger ids have of it is `lost` at once."""
        columns: list[list] = [[] for _ in range(10)]
        if shared.num_rows and blocks.num_rows:
            block, lengths = blocks.column("block")[0].as_py(), np.array(blocks.column("lengths")[0].as_py())
            ids = np.array([_NO_ID if i is None else i for i in blocks.column("ids")[0].as_py()], np.int64)
            keys = np.frombuffer(b"".join(shared.column("keys").to_pylist()), np.uint64)
            hot = np.frombuffer(b"".join(shared.column("hot").to_pylist()), np.uint8)
            by = np.argsort(keys)
            found = list(_contexts(_texts(lengths, blocks.column("texts")[0].as_py()), keys[by], hot[by], buckets))
            if found:
                (bucket, rows, text, place), lost, new = _once(*(np.concatenate(c) for c in zip(*found)), ids)
                n_hot = np.searchsorted(bucket, 0)
                if n_hot:
                    single, more, first = _once(*_one_by_one(rows[:n_hot], text[:n_hot], place[:n_hot], buckets), ids)
                    bucket, rows, text, place = (np.concatenate([a, b[n_hot:]]) for a, b in zip(single, (bucket, rows, text, place)))
                    lost, new = np.concatenate([lost, more]), np.concatenate([first, new[n_hot:]])
                first = np.flatnonzero(new)
                by = np.argsort(bucket[first], kind="stable")  # of rows
                times = np.diff(np.append(first, len(new)))[by]
                each = spans(first[by], times)
                first, text, place = first[by], text[each], place[each]
                values, cut = np.unique(bucket[first], return_index=True)
                to = np.append(cut, len(first))
                ends = np.concatenate(([0], np.cumsum(times)))[to]
                for i, value in enumerate(values):
                    part = first[to[i] : to[i + 1]]
                    held = slice(ends[i], ends[i + 1])
                    packed = [_packed(c) for c in (rows[part], ids[text_of_first(text, ends[i], times[to[i] : to[i + 1]])], times[to[i] : to[i + 1]].astype("<u4"), text[held].astype("<u4"), place[held].astype("<i4"))]
                    whole = _packed_spans(lost) if i == 0 and len(lost) else b""
                    for column, x in zip(columns, (int(value), block, len(part), int(ends[i + 1] - ends[i]), *packed, whole)):
                        column.append(x)
        kinds = [pa.int64()] * 4 + [pa.binary()] * 6
        return pa.table([pa.array(c, k) for c, k in zip(columns, kinds)], [f.split()[0] for f in _TO_BUCKET.split(", ")])

    return run


def text_of_first(text: np.ndarray, start: int, times: np.ndarray) -> np.ndarray:
    """The first text of each run of `times`, from `start` on."""
    return text[start + np.cumsum(times) - times]


def repeated(rows: np.ndarray, docs: np.ndarray) -> np.ndarray:
    """The starts of strings, in rows laid end to end, that a smaller document has too."""
    low, high = _bounds(rows)
    column = np.arange(ROW)
    order = suffix_array(rows, (column >= low[:, None]) & (column <= high[:, None] - LENGTH))
    doc = docs[order // ROW]
    first = np.flatnonzero(common_prefixes(rows.ravel(), order) < LENGTH)
    least = np.repeat(np.minimum.reduceat(doc, first), np.diff(np.append(first, len(order))))
    return np.sort(order[doc > least])


def _slabs(rows: np.ndarray) -> Iterator[np.ndarray]:
    """Numbers of rows in slabs: equal strings lie around equal bytes in the middle, so none is parted."""
    n = -(-len(rows) * STARTS // SLAB)
    if n <= 1:
        yield np.arange(len(rows))
        return
    middle = np.ascontiguousarray(rows[:, STARTS - 1 : STARTS + 7]).view("<u8").ravel()
    slab = mix64(middle) % np.uint64(n)
    by = np.argsort(slab, kind="stable")
    yield from np.split(by, np.flatnonzero(np.diff(slab[by])) + 1)


def _packed_spans(spans_: np.ndarray) -> bytes:
    return len(spans_).to_bytes(8, "little") + _packed(spans_)


def _spans_of(packed: bytes) -> np.ndarray:
    """Packed spans (text, from, to), their number in front."""
    return _unpacked(packed[8:], int.from_bytes(packed[:8], "little") * 3, "<u4").reshape(-1, 3)


def _in_bucket(table: pa.Table) -> pa.Table:
    """For each block the spans (text, from, to) of strings that a smaller document has too."""
    get = lambda c: table.column(c).to_pylist()
    n, held = np.array(get("n")), np.array(get("held"))
    rows = np.concatenate([_unpacked(x, k * ROW) for x, k in zip(get("rows"), n)]).reshape(-1, ROW)
    docs = np.concatenate([_unpacked(x, k, np.int64) for x, k in zip(get("docs"), n)])
    times = np.concatenate([_unpacked(x, k, "<u4") for x, k in zip(get("times"), n)]).astype(np.int64)
    text, place = (np.concatenate([_unpacked(x, k, kind) for x, k in zip(get(c), held)]).astype(np.int64) for c, kind in (("text_of", "<u4"), ("place", "<i4")))
    start, block = np.cumsum(times) - times, np.repeat(np.arange(len(n)), n)
    out = [[_spans_of(x)] if x else [] for x in get("lost")]
    for slab in _slabs(rows):
        at = repeated(rows[slab], docs[slab])
        if not len(at):
            continue
        begins = np.concatenate(([True], np.diff(at) != 1))
        a, b = at[begins], at[np.append(begins[1:], True)]
        row = slab[a // ROW]
        it = spans(start[row], times[row])
        from_, to = (np.repeat(x % ROW, times[row]) + place[it] for x in (a, b))
        found = np.stack([text[it], from_, to + LENGTH], 1).astype("<u4")
        of = np.repeat(block[row], times[row])
        by = np.argsort(of, kind="stable")
        for part in np.split(by, np.flatnonzero(np.diff(of[by])) + 1):
            out[of[part[0]]].append(found[part])
    some = [i for i, x in enumerate(out) if x]
    blocks = get("block")
    return pa.table([pa.array([blocks[i] for i in some], pa.int64()), pa.array([_packed_spans(np.concatenate(out[i])) for i in some], pa.binary())], ["block", "spans"])


_RESULT = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary"


def _merged(cut: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Spans (text, from, to) as maximal ones in order: text, from and to in all texts laid end to end."""
    doc = cut[:, 0]
    from_, to = starts[doc] + doc + cut[:, 1], starts[doc] + doc + cut[:, 2]  # a gap parts the texts
    by = np.argsort(from_, kind="stable")
    doc, from_, to = doc[by], from_[by], np.maximum.accumulate(to[by]) if len(by) else to
    first = np.flatnonzero(np.concatenate(([True], from_[1:] > to[:-1]))) if len(by) else by
    return doc[first], from_[first] - doc[first], to[np.append(first[1:], len(to)) - 1] - doc[first] if len(by) else to


def _cut(with_text: bool):
    def run(blocks: pa.Table, found: pa.Table) -> pa.Table:
        lengths, ids = np.array(blocks.column("lengths")[0].as_py()), blocks.column("ids")[0].as_py()
        data = _unpacked(blocks.column("texts")[0].as_py(), int(lengths.sum()))
        starts = np.cumsum(lengths) - lengths
        cut = np.concatenate([np.empty((0, 3), np.int64), *map(_spans_of, found.column("spans").to_pylist())]).astype(np.int64)
        doc, from_, to = _merged(cut, starts)
        removed, n_spans = np.zeros(len(ids), np.int64), np.bincount(doc, minlength=len(ids))
        np.add.at(removed, doc, to - from_)
        at = np.searchsorted(doc, np.arange(len(ids) + 1))
        shas, texts = [], []
        for i, (a, n) in enumerate(zip(starts, lengths)):
            edges = [a, *np.stack([from_, to], 1)[at[i] : at[i + 1]].ravel(), a + n]
            left = b"".join(memoryview(data)[x:y] for x, y in zip(edges[::2], edges[1::2]))
            shas.append(hashlib.sha256(left).hexdigest())
            texts.append(left if with_text else None)
        columns = [pa.array(ids, pa.int64()), *(pa.array(c.astype(np.int64)) for c in (lengths, removed, n_spans)), pa.array(shas), pa.array(texts, pa.binary())]
        return pa.table(columns, [f.split()[0] for f in _RESULT.split(", ")])

    return run


def without_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", with_text: bool = True) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256, kept: each document without the bytes of strings that a smaller id has.

    A string is any LENGTH bytes of a text in UTF-8, so `kept` is binary: a cut may
    part a character.  Strings are judged on the whole texts as they come.  Null
    texts are empty; texts under LENGTH bytes keep all.  Ids are integers; a null
    id comes after all others, and rows that share an id do not cut each other.
    Very long texts are worked on in pieces; a text is one row before and after.
    Nothing in, nothing out; other columns are not looked at.
    """
    small_batches(docs.sparkSession)
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    blocks = rows.mapInArrow(_blocks, "ids array<long>, lengths array<long>, texts binary").withColumn("block", F.monotonically_increasing_id())
    blocks = staged(blocks, "text-blocks")
    size = blocks.agg(F.sum(F.aggregate("lengths", F.lit(0).cast("long"), lambda a, x: a + x))).first()[0] or 0
    buckets = min(1 << 24, 1 + size // BUCKET_BYTES)
    found = blocks.select("block", "lengths", "texts").mapInArrow(_block_anchors(buckets), "bucket long, block long, low binary, high binary, counts binary")
    shared = found.groupBy("bucket").applyInArrow(_shared_anchors, "block long, keys binary, hot binary")
    around = blocks.groupBy("block").cogroup(shared.groupBy("block")).applyInArrow(_to_buckets(buckets), _TO_BUCKET)
    spans_ = around.groupBy("bucket").applyInArrow(_in_bucket, "block long, spans binary")
    out = blocks.groupBy("block").cogroup(spans_.groupBy("block")).applyInArrow(_cut(with_text), _RESULT)
    return out.withColumnRenamed("doc_id", id_col)


def repeat_report(docs: DataFrame) -> DataFrame:
    """without_repeats() of `documents` but for the texts themselves, written once."""
    return staged(without_repeats(docs, with_text=False).drop("kept"), "repeats")
