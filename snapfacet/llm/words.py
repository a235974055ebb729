"""Words of Arrow text columns as numpy arrays: bounds, 64-bit hashes, window hashes.

Everything here works on one Arrow batch inside a task. A batch is walked in slices of about
``SLICE`` bytes, so memory follows the slice, not the batch; a text longer than a slice is cut
between words and its parts are put together again, so whole texts are always processed.

A word's hash mixes its length and its bytes, eight at a time, by steps that are one to one (words
of more than ``LONG`` bytes: XXH64). Equal words have equal hashes in every task; two different words
share one with a chance of about 2**-64, and no arrangement of letters makes two equal.
A window's hash is a polynomial of its words' hashes with a final mix, for windows of up to some
fifty words.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash

SLICE = 1 << 20
LONG = 256
_U = np.uint64
_RNG = np.random.Generator(np.random.PCG64(20240611))
_SEED = _RNG.integers(1, 2**64, dtype=np.uint64)
#: The first n of eight bytes.
_FIRST = np.array([(1 << 8 * n) - 1 for n in range(9)], dtype=np.uint64)
_RW = int(_RNG.integers(0, 2**63, dtype=np.uint64)) * 2 + 1
#: Fixed hash values of the tokens that no text can hold.
END, START = _U(0x9E3779B97F4A7C15), _U(0xD1B54A32D192ED03)

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
KEEP = np.arange(256, dtype=np.uint8)


def _classes(ranges) -> np.ndarray:
    mask = np.ones(256, dtype=bool)
    for lo, hi in ranges:
        mask[lo : hi + 1] = False
    return mask


#: Fixed word classes: all but ASCII white space; ASCII letters, digits and all non-ASCII.
NOT_SPACE = _classes([(0x20, 0x20), (0x09, 0x0D)])
ALNUM = _classes([(0x00, 0x2F), (0x3A, 0x60), (0x7B, 0x7F)])

_POW: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _powers(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """base**i and base**-i modulo 2**64 for i <= n (kept for the next call)."""
    have = _POW.get(base)
    if have is None or len(have[0]) <= n:
        size = max(n + 1, SLICE + 2)
        inverse = pow(base, -1, 2**64)
        out = []
        for b in (base, inverse):
            p = np.full(size, b, dtype=np.uint64)
            p[0] = 1
            out.append(np.multiply.accumulate(p))
        _POW[base] = have = (out[0], out[1])
    return have


def mix(h: np.ndarray) -> np.ndarray:
    h = h ^ (h >> _U(32))
    h = h * _U(0xBF58476D1CE4E5B9)
    h = h ^ (h >> _U(29))
    h = h * _U(0x94D049BB133111EB)
    return h ^ (h >> _U(32))


def text_bytes(column) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of an Arrow string column and the offsets of its rows (null: empty)."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks() if column.num_chunks != 1 else column.chunk(0)
    if isinstance(column, pa.ChunkedArray):  # an empty column has no chunk
        column = pa.concat_arrays(column.chunks) if column.num_chunks else pa.array([], column.type)
    column = column.cast(pa.large_string())
    if column.null_count:
        column = column.fill_null("")
    if len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def _spans(raw: np.ndarray, cuts: np.ndarray, word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the words of ``raw``; no word goes over a cut."""
    n = len(raw)
    m = word[raw]
    first, last = m.copy(), m.copy()
    first[1:] &= ~m[:-1]
    last[:-1] &= ~m[1:]
    inner = cuts[(cuts > 0) & (cuts < n)]
    first[inner] |= m[inner]
    last[inner - 1] |= m[inner - 1]
    return np.flatnonzero(first), np.flatnonzero(last) + 1


def _hash(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    size = ends - starts
    padded = np.concatenate((raw, np.zeros(8, np.uint8)))
    eight = np.lib.stride_tricks.sliding_window_view(padded, 8)
    load = lambda at: eight[at].view("<u8").reshape(len(at))
    h = mix(_SEED ^ size.astype(np.uint64))
    h = mix(h ^ (load(starts) & _FIRST[np.minimum(size, 8)]))
    left = np.flatnonzero(size > 8)
    done = 8
    while len(left):
        if done >= LONG:
            for i in left.tolist():
                h[i] = xxhash.xxh64_intdigest(raw[starts[i] : ends[i]].tobytes(), int(size[i]) & 0xFFFFFFFF)
            break
        rest = np.minimum(size[left] - done, 8)
        h[left] = mix(h[left] ^ (load(starts[left] + done) & _FIRST[rest]))
        done += 8
        left = left[size[left] > done]
    return h


def slices(offsets: np.ndarray, limit: int = SLICE):
    """Row ranges of about ``limit`` bytes (at least one row each)."""
    row, n = 0, len(offsets) - 1
    while row < n:
        end = int(np.searchsorted(offsets, offsets[row] + limit, "right")) - 1
        end = min(n, max(row + 1, end))
        yield row, end
        row = end


def words(data: np.ndarray, offsets: np.ndarray, word=NOT_SPACE, fold=KEEP, hashes: bool = True):
    """All words of the rows: (row, start, end, hash); start and end are byte places within
    ``data``; hash is over the folded bytes (None without ``hashes``)."""
    parts = []
    for a, b in slices(offsets):
        lo, hi = int(offsets[a]), int(offsets[b])
        cuts = offsets[a : b + 1]
        while lo < hi:
            end = hi
            if hi - lo > 2 * SLICE:  # one long text: cut it where a word has ended
                gap = np.flatnonzero(~word[fold[data[lo + SLICE : lo + 2 * SLICE]]])
                step = SLICE
                while len(gap) == 0 and lo + step < hi:
                    step *= 2
                    gap = np.flatnonzero(~word[fold[data[lo + step // 2 : min(hi, lo + step)]]])
                    gap = gap + step // 2 - SLICE
                end = min(hi, lo + SLICE + int(gap[0]) + 1) if len(gap) else hi
            raw = fold[data[lo:end]]
            s, e = _spans(raw, cuts - lo, word)
            parts.append((s + lo, e + lo, _hash(raw, s, e) if hashes else None))
            lo = end
    if not parts:
        z = np.zeros(0, np.int64)
        return z, z, z, np.zeros(0, np.uint64) if hashes else None
    starts = np.concatenate([p[0] for p in parts])
    ends = np.concatenate([p[1] for p in parts])
    h = np.concatenate([p[2] for p in parts]) if hashes else None
    rows = np.searchsorted(offsets, starts, "right") - 1
    return rows, starts, ends, h


def windows(h: np.ndarray, k: int) -> np.ndarray:
    """The hash of the k words from each place; places too near the end are left out. The
    caller leaves out windows that go over the end of a row."""
    if len(h) < k:
        return np.zeros(0, np.uint64)
    up, down = _powers(_RW, len(h))
    acc = np.zeros(len(h) + 1, dtype=np.uint64)
    np.cumsum(h * up[: len(h)], out=acc[1:])
    return mix((acc[k:] - acc[:-k]) * down[: len(h) - k + 1])


def within(rows: np.ndarray, k: int) -> np.ndarray:
    """Whether the window of k words from each place stays in its row."""
    return rows[k - 1 :] == rows[: len(rows) - k + 1] if len(rows) >= k else np.zeros(0, bool)


def cover(starts: np.ndarray, n: int, k: int) -> np.ndarray:
    """Marks of the words covered by windows of k words from ``starts``."""
    opened = np.bincount(starts, minlength=n + 1)
    closed = np.bincount(np.minimum(starts + k, n), minlength=n + 1)
    return np.cumsum(opened[:n] - closed[:n]) > 0


def runs(flags: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and last word of each run of marked words; a run ends with its row."""
    if not len(flags):
        z = np.zeros(0, np.int64)
        return z, z
    new = np.ones(len(rows), bool)
    new[1:] = rows[1:] != rows[:-1]
    first = flags & (new | ~np.concatenate(([False], flags[:-1])))
    last = flags & (np.concatenate((new[1:], [True])) | ~np.concatenate((flags[1:], [False])))
    return np.flatnonzero(first), np.flatnonzero(last)


def joined(data: np.ndarray, rows: np.ndarray, starts: np.ndarray, ends: np.ndarray, n: int) -> pa.Array:
    """The given words of each of n rows, joined by one space, as an Arrow string column."""
    size = ends - starts + 1
    if len(rows):
        size[np.append(rows[1:] != rows[:-1], True)] -= 1  # no space after the last word
    at = np.concatenate(([0], np.cumsum(size)))
    out = data[np.minimum(np.repeat(starts - at[:-1], size) + np.arange(at[-1]), max(0, len(data) - 1))]
    gaps = at[1:][size > ends - starts] - 1
    out[gaps] = 32
    bounds = at[np.searchsorted(rows, np.arange(n + 1), "left")]
    return strings(out, bounds)


def strings(data: np.ndarray, offsets: np.ndarray) -> pa.Array:
    """A string column from bytes and row offsets."""
    buffers = [None, pa.py_buffer(np.ascontiguousarray(offsets, np.int64)), pa.py_buffer(np.ascontiguousarray(data))]
    return pa.Array.from_buffers(pa.large_string(), len(offsets) - 1, buffers).cast(pa.string())


def span_lists(flags: np.ndarray, rows: np.ndarray, n: int) -> pa.Array:
    """Per row the runs of marked words as structs (start, end): word numbers, end excluded."""
    base = np.searchsorted(rows, np.arange(n + 1), "left")
    a, b = runs(flags, rows)
    r = rows[a] if len(a) else a
    of = np.searchsorted(r, np.arange(n + 1), "left")
    pairs = pa.StructArray.from_arrays([pa.array(a - base[r], pa.int64()), pa.array(b + 1 - base[r], pa.int64())], ["start", "end"])
    return pa.ListArray.from_arrays(pa.array(of, pa.int32()), pairs)


def per_row(flags: np.ndarray, rows: np.ndarray, n: int) -> np.ndarray:
    """How many words of each of n rows are marked."""
    return np.bincount(rows[flags], minlength=n) if n else np.zeros(0, np.int64)
