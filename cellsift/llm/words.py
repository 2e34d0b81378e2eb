"""Words of whole batches of texts at once, as numpy arrays.

Used inside Arrow tasks. A batch is worked through in slices of bounded size; a
text longer than a slice is a slice of its own, so texts are never cut.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 2 << 20
SLICE_ROWS = 4096
#: Bytes of text whose shingles are counted at once.
COUNT_BYTES = 1 << 17
SHINGLE = 5

#: The six white-space bytes that end a word: space and \t \n \v \f \r.
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True

#: Two primes below 2**31, and the base of a polynomial modulo each.
_PRIMES = (2147483647, 2147483629)
_BASES = (1_640_531_527, 1_181_783_497)
_STEPS = np.array(
    [0xBF58476D1CE4E5B9, 0x94D049BB133111EB, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB],
    dtype=np.uint64,
)


class Words(NamedTuple):
    """Words of some texts: where they are in ``data``, their text and a 64-bit hash."""

    data: np.ndarray
    start: np.ndarray
    end: np.ndarray
    doc: np.ndarray
    hash: np.ndarray
    docs: int


def mix(value: np.ndarray) -> np.ndarray:
    """Spread 64-bit values (the finaliser of MurmurHash3)."""
    value = value ^ (value >> np.uint64(33))
    value = value * np.uint64(0xFF51AFD7ED558CCD)
    value ^= value >> np.uint64(33)
    value *= np.uint64(0xC4CEB9FE1A85EC53)
    return value ^ (value >> np.uint64(33))


def text_buffer(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all texts, and the offset of each; nulls are empty."""
    if column.null_count:
        column = pc.fill_null(column, "")
    kind = np.int64 if pa.types.is_large_string(column.type) else np.int32
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, dtype=kind)[column.offset : column.offset + len(column) + 1]
    if data is None:
        return np.zeros(0, dtype=np.uint8), np.zeros(len(column) + 1, dtype=np.int64)
    data = np.frombuffer(data, dtype=np.uint8)[offsets[0] : offsets[-1]]
    return data, offsets.astype(np.int64) - int(offsets[0])


def slices(column: pa.Array, limit: int = SLICE_BYTES, rows: int = SLICE_ROWS) -> Iterator[tuple[int, int]]:
    """Ranges of rows whose texts together stay within ``limit`` bytes."""
    size = pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False)
    begin, total = 0, 0
    for i, n in enumerate(size.tolist()):
        if i > begin and (total + n > limit or i - begin >= rows):
            yield begin, i
            begin, total = i, 0
        total += n
    if begin < len(size):
        yield begin, len(size)


def _power_table(base: int, prime: int, n: int) -> np.ndarray:
    out = np.ones(n, dtype=np.uint32)
    done = 1
    while done < n:
        upto = min(n, 2 * done)
        out[done:upto] = out[: upto - done].astype(np.uint64) * np.uint64(pow(base, done, prime)) % np.uint64(prime)
        done = upto
    return out


#: Powers made so far, the largest number of them that was asked for.
_powers_made: list[list[tuple[np.uint64, np.ndarray, np.ndarray]]] = []


def _powers(bits: int) -> list[tuple[np.uint64, np.ndarray, np.ndarray]]:
    """Each prime with powers of its base and of the base's inverse, ``1 << bits`` of each at least."""
    n = 1 << bits
    if not _powers_made or len(_powers_made[0][0][1]) < n:
        # One table at a time: the former ones are dropped before it is made.
        _powers_made.clear()
        _powers_made.append([(np.uint64(p), _power_table(b, p, n), _power_table(pow(b, -1, p), p, n)) for p, b in zip(_PRIMES, _BASES)])
    return _powers_made[0]


def span_hashes(units: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A hash of each span of ``units``, the same wherever the span lies.

    Polynomials modulo two primes of 31 bits: modulo a power of two, long spans
    of two letters in the Thue-Morse order would all collide.
    """
    powers = _powers(max(19, (len(units) - 1).bit_length()))
    value = (end - start).astype(np.uint64) * _STEPS[0]
    wide = units.astype(np.uint64) + np.uint64(1)
    small = units.dtype == np.uint8 and len(units) <= 1 << 24
    for k, (prime, power, inverse) in enumerate(powers):
        terms = wide * power[: len(units)]
        if not small:
            terms %= prime
        sums = np.zeros(len(units) + 1, dtype=np.uint64)
        np.cumsum(terms, out=sums[1:])
        part = (sums[end] - sums[start]) % prime * inverse[start] % prime
        value += part << np.uint64(31 * k)
    return mix(value)


def told_apart(units: np.ndarray, start: np.ndarray, end: np.ndarray, value: np.ndarray) -> np.ndarray:
    """The hashes of spans, with equal ones only for equal spans.

    Spans that share a hash are compared unit by unit with the first of them;
    those that differ get a hash of their bytes by BLAKE2b, wherever they lie.
    """
    while len(value):
        order = np.argsort(value, kind="stable")
        same = np.concatenate([[False], value[order][1:] == value[order][:-1]])
        if not same.any():
            break
        lead = order[np.maximum.accumulate(np.where(same, 0, np.arange(len(order))))]
        other, first = order[same], lead[same]
        unlike = _unlike(units, start[other], end[other], start[first], end[first])
        if not unlike.any():
            break
        value = value.copy()
        # All spans with a hash that does not tell them apart, so that order does not matter.
        for i in np.flatnonzero(np.isin(value, value[other[unlike]])).tolist():
            digest = hashlib.blake2b(units[start[i] : end[i]].tobytes(), digest_size=8).digest()
            value[i] = np.uint64(int.from_bytes(digest, "little"))
    return value


def _unlike(units, start, end, other, other_end) -> np.ndarray:
    """Whether spans differ from others, which are as many."""
    size = end - start
    out = size != other_end - other
    some = np.flatnonzero(~out & (start != other) & (size > 0))
    step = 1 << 16
    # In runs of bounded size; a longer span is a run of its own.
    run = np.cumsum(size[some]) // step
    for k in np.unique(run):
        at = some[run == k]
        n = size[at]
        place = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        differs = units[np.repeat(start[at], n) + place] != units[np.repeat(other[at], n) + place]
        out[at] = np.add.reduceat(differs, np.cumsum(n) - n) > 0
    return out


def find_words(column: pa.Array) -> Words:
    """Words ``[^\\x20\\x09-\\x0D]+`` of the texts of one slice."""
    data, offsets = text_buffer(column)
    inside = ~_SPACE[data]
    first, last = inside.copy(), inside.copy()
    first[1:] &= ~inside[:-1]
    last[:-1] &= ~inside[1:]
    begins = offsets[:-1][offsets[:-1] < offsets[1:]]
    ends = offsets[1:][offsets[:-1] < offsets[1:]] - 1
    first[begins] = inside[begins]
    last[ends] = inside[ends]
    start, end = np.flatnonzero(first), np.flatnonzero(last) + 1
    doc = np.searchsorted(offsets, start, side="right") - 1
    return Words(data, start, end, doc, span_hashes(data, start, end), len(column))


def windows(words: Words, size: int) -> tuple[np.ndarray, np.ndarray]:
    """First word and hash of each run of ``size`` words within one text."""
    n = len(words.doc) - size + 1
    if n <= 0:
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.uint64)
    begin = np.flatnonzero(words.doc[:n] == words.doc[size - 1 :])
    total = np.zeros(len(begin), dtype=np.uint64)
    for k in range(size):
        total += words.hash[begin + k] * _STEPS[k]
    return begin, mix(total)


def shingles(words: Words, size: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """Text and hash of each shingle; a text of fewer words is one shingle."""
    begin, value = windows(words, size)
    count = np.bincount(words.doc, minlength=words.docs)
    short = np.flatnonzero((count > 0) & (count < size))
    doc = words.doc[begin]
    if not len(short):
        return doc, value
    first = np.searchsorted(words.doc, short)
    total = np.zeros(len(short), dtype=np.uint64)
    for k in range(size - 1):
        has = k < count[short]
        total[has] += words.hash[first[has] + k] * _STEPS[k]
    doc, value = np.concatenate([doc, short]), np.concatenate([value, mix(total)])
    order = np.argsort(doc, kind="stable")
    return doc[order], value[order]


def count_within(doc: np.ndarray, value: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct values of each text, in text order, and how often each occurs.

    Values keep their upper 52 bits; texts must number at most 4 096.
    """
    key = np.sort((doc.astype(np.uint64) << np.uint64(52)) | (value >> np.uint64(12)))
    if not len(key):
        none = np.zeros(0, dtype=np.int64)
        return none, key, none
    at = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
    count = np.diff(np.concatenate([at, [len(key)]]))
    key = key[at]
    return (key >> np.uint64(52)).astype(np.int64), key & np.uint64((1 << 52) - 1), count


def count_texts(column: pa.Array, limit: int = COUNT_BYTES) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``count_within`` for the shingles of up to 4 096 texts, a few texts at a time.

    Hashing takes some 60 bytes for each byte of text, so texts go through it in
    runs of ``limit`` bytes; a longer text is a run of its own.
    """
    parts = []
    for begin, end in slices(column, limit):
        doc, value, count = count_within(*shingles(find_words(column.slice(begin, end - begin))))
        parts.append((doc + begin, value, count))
    return tuple(np.concatenate(p) for p in zip(*parts)) if parts else count_within(*shingles(find_words(column)))
