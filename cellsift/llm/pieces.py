"""SentencePiece encoding and decoding, many texts at a time.

Encoding is byte-pair merging as the sentencepiece library does it: of all
adjacent symbols whose union is a piece, the pair of the best score merges, the
leftmost first, until none is left. Here the symbols of many words lie in flat
numpy arrays. In each round each word merges its best pair at all places, from
the left, as far as that gives what one merge at a time would give; then the
arrays are compacted.

Words are cut where no piece spans, so they merge independently, and equal words
are merged once per slice.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cellsift.llm.words import mix, slices, span_hashes, told_apart

#: Bytes of text whose symbols lie in arrays at once; a task holds some 100 bytes for each.
SLICE_BYTES = 1 << 20

_SPACE = 0x2581  # stands for a space inside pieces
_NEVER = np.iinfo(np.int32).max
_UNKNOWN = np.int32(-1)
_GOLD = np.uint64(0x9E3779B97F4A7C15)


class _Table:
    """Numbers by 64-bit keys: open addressing in numpy arrays."""

    def __init__(self, keys: np.ndarray, *values: np.ndarray):
        bits = max(8, int(4 * len(keys)).bit_length())
        self.shift = np.uint64(64 - bits)
        self.mask = (1 << bits) - 1
        self.keys = np.full(1 << bits, np.uint64(2**64 - 1))
        self.values = [np.zeros(1 << bits, dtype=np.int32) for _ in values]
        at = self._place(keys)
        left = np.arange(len(keys))
        while len(left):
            # Of the keys that want a free place the first gets it, the rest move on.
            free = self.keys[at[left]] == np.uint64(2**64 - 1)
            place, first = np.unique(at[left[free]], return_index=True)
            won = left[free][first]
            self.keys[place] = keys[won]
            for mine, given in zip(self.values, values):
                mine[place] = given[won]
            left = left[self.keys[at[left]] != keys[left]]
            at[left] = (at[left] + 1) & self.mask

    def _place(self, keys: np.ndarray) -> np.ndarray:
        return ((keys * _GOLD) >> self.shift).astype(np.int64)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """The place of each key, -1 if it is absent."""
        at = self._place(keys)
        seen = self.keys[at]
        out = np.where(seen == keys, at, -1)
        left = np.flatnonzero((seen != keys) & (seen != np.uint64(2**64 - 1)))
        while len(left):
            at[left] = (at[left] + 1) & self.mask
            seen = self.keys[at[left]]
            hit = seen == keys[left]
            out[left[hit]] = at[left[hit]]
            left = left[~hit & (seen != np.uint64(2**64 - 1))]
        return out


class Encoder:
    """Tables of one model, and the merge rounds."""

    def __init__(self, path: str):
        from sentencepiece import SentencePieceProcessor

        self.library = SentencePieceProcessor(model_file=path)
        size = self.library.vocab_size()
        names = [self.library.id_to_piece(i) for i in range(size)]
        special = [
            self.library.is_control(i) or self.library.is_unknown(i) or self.library.is_byte(i) for i in range(size)
        ]
        pieces = {names[i]: i for i in range(size) if not special[i]}
        # Equal scores share a rank: then the leftmost pair goes first.
        score = np.array([self.library.get_score(i) for i in range(size)])
        rank = np.unique(-score, return_inverse=True)[1].astype(np.int32)
        self.bytes = np.array([self.library.piece_to_id(f"<0x{b:02X}>") for b in range(256)], dtype=np.int32)
        self.unknown = self.library.unk_id()

        chars = sorted({c for p in pieces for c in p})
        self.char_class = np.zeros(0x110000, dtype=np.int32)
        self.char_class[[ord(c) for c in chars]] = np.arange(1, len(chars) + 1)
        self.char_id = np.full(0x110000, _UNKNOWN, dtype=np.int32)
        for c in chars:
            if c in pieces:
                self.char_id[ord(c)] = pieces[c]
        self.within = np.zeros((len(chars) + 1, len(chars) + 1), dtype=bool)
        # Symbols that are characters but no piece can still be part of one.
        self.extra = {c: size + k for k, c in enumerate(c for c in chars if c not in pieces)}
        for c, i in self.extra.items():
            self.char_id[ord(c)] = i
        symbols = pieces | self.extra
        keys, ids, ranks = [], [], []
        for piece, i in pieces.items():
            for a, b in zip(piece, piece[1:]):
                self.within[self.char_class[ord(a)], self.char_class[ord(b)]] = True
            for cut in range(1, len(piece)):
                left, right = symbols.get(piece[:cut]), symbols.get(piece[cut:])
                if left is not None and right is not None:
                    keys.append(left << 32 | right)
                    ids.append(i)
                    ranks.append(rank[i])
        self.merged = _Table(np.array(keys, np.uint64), np.array(ids, np.int32), np.array(ranks, np.int32))
        self.size = size
        self.decimal = [b"%d" % i for i in range(size)]

    def _look(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank and symbol of the union of neighbours; no rank if it is no piece."""
        key = (left.astype(np.uint64) << np.uint64(32)) | right.astype(np.uint64)
        key[(left < 0) | (right < 0)] = np.uint64(2**64 - 2)
        at = self.merged.find(key)
        ids, ranks = self.merged.values
        return np.where(at >= 0, ranks[at], _NEVER).astype(np.int32), np.where(at >= 0, ids[at], _UNKNOWN)

    def merge(self, symbol: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Merge the symbols of words that begin at ``first``; the symbols left and where words begin."""
        words = len(first)
        done_symbol, done_word = [], []
        word = np.repeat(np.arange(words), np.diff(np.append(first, len(symbol))))

        def ranks_of(symbol: np.ndarray, word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
            rank, union = np.full(len(symbol), _NEVER, np.int32), np.full(len(symbol), _UNKNOWN, np.int32)
            rank[:-1], union[:-1] = self._look(symbol[:-1], symbol[1:])
            rank[:-1][word[1:] != word[:-1]] = _NEVER
            return rank, union

        rank, union = ranks_of(symbol, word) if len(symbol) else (symbol, symbol)
        while len(symbol):
            begins = np.flatnonzero(np.concatenate([[True], word[1:] != word[:-1]]))
            best = np.minimum.reduceat(rank, begins)
            length = np.diff(np.append(begins, len(symbol)))
            # Words without a pair are done.
            more = np.repeat(best != _NEVER, length)
            if not more.all():
                done_symbol.append(symbol[~more])
                done_word.append(word[~more])
                symbol, word, rank, union = symbol[more], word[more], rank[more], union[more]
                length, best = length[best != _NEVER], best[best != _NEVER]
                if not len(symbol):
                    break
                begins = np.concatenate([[0], np.cumsum(length)[:-1]])
            at = np.flatnonzero(rank == np.repeat(best, length))
            # Pieces of one score differ: a round takes the leftmost place's pair only.
            lead = at[np.searchsorted(at, begins)]
            order = np.searchsorted(begins, at, side="right") - 1
            same = (symbol[at] == symbol[lead[order]]) & (symbol[at + 1] == symbol[lead[order] + 1])
            tie = np.zeros(len(begins), dtype=bool)
            tie[order[~same]] = True
            at, order = at[same], order[same]
            # Overlapping places, as in "aaa": every second of a run, from its left.
            run = np.concatenate([[True], np.diff(at) != 1])
            start = at[np.flatnonzero(run)][np.cumsum(run) - 1]
            keep = (at - start) % 2 == 0
            at, order = at[keep], order[keep]
            # A merge whose new neighbours rank as well or better comes last in its round.
            last = np.flatnonzero(np.concatenate([order[1:] != order[:-1], [True]]))
            several = np.ones(len(at), dtype=bool)
            several[last] = False
            lone = (np.bincount(order, minlength=len(begins)) == 1)[order]
            stop = tie[order] & several
            check = np.flatnonzero(several & ~lone & ~stop)
            if len(check):
                stop[check] = self._better(symbol, word, at[check], union[at[check]], best[order[check]])
            if stop.any():
                passed = np.cumsum(stop) - stop
                base = passed[np.concatenate([[0], last[:-1] + 1])]
                # Places after the first stop of their word wait for the next round.
                keep = passed == np.repeat(base, np.diff(np.concatenate([[-1], last])))
                at = at[keep]
            symbol[at] = union[at]
            left = np.ones(len(symbol), dtype=bool)
            left[at + 1] = False
            changed = np.zeros(len(symbol), dtype=bool)
            changed[at] = True
            symbol, word, rank, union, changed = (x[left] for x in (symbol, word, rank, union, changed))
            changed[:-1] |= changed[1:].copy()
            some = np.flatnonzero(changed)
            edge = some == len(symbol) - 1
            rank[some[edge]] = _NEVER
            some = some[~edge]
            rank[some], union[some] = self._look(symbol[some], symbol[some + 1])
            rank[some[word[some] != word[some + 1]]] = _NEVER
        if not done_symbol:
            return symbol, first
        symbol, word = np.concatenate(done_symbol), np.concatenate(done_word)
        order = np.argsort(word, kind="stable")
        symbol, word = symbol[order], word[order]
        return symbol, np.searchsorted(word, np.arange(words))

    def _better(self, symbol, word, at, union, best) -> np.ndarray:
        """Whether a merge at ``at`` makes a pair that must go before the next place."""
        out = np.zeros(len(at), dtype=bool)
        left = np.maximum(at - 1, 0)
        inside = (at > 0) & (word[left] == word[at])
        # To the left may stand this same union, made just before.
        for before in (symbol[left], union):
            out |= inside & (self._look(before, union)[0] <= best)
        right = np.minimum(at + 2, len(symbol) - 1)
        inside = (at + 2 < len(symbol)) & (word[right] == word[at])
        out |= inside & (self._look(union, symbol[right])[0] <= best)
        return out

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Ids of the distinct words, where each word's begin, the words of the texts in
        order, and where each text's begin."""
        normal = ["" if not t else "▁" + t.replace(" ", "▁") for t in texts]
        points = np.frombuffer("".join(normal).encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
        sizes = np.array([len(t) for t in normal], dtype=np.int64)
        offsets = np.concatenate([[0], np.cumsum(sizes)])
        kind = self.char_class[points]
        cut = np.ones(len(points), dtype=bool)
        cut[1:] = ~self.within[kind[:-1], kind[1:]]
        cut[offsets[:-1][sizes > 0]] = True
        begin = np.flatnonzero(cut)
        end = np.append(begin[1:], len(points))
        name = told_apart(points, begin, end, span_hashes(points, begin, end))
        name, first, word = np.unique(name, return_index=True, return_inverse=True)
        begin_u, length = begin[first], (end - begin)[first]
        starts = np.concatenate([[0], np.cumsum(length)])
        place = np.repeat(begin_u - starts[:-1], length) + np.arange(starts[-1])
        symbol, starts = self.merge(self.char_id[points[place]], starts[:-1]) if len(begin) else (points, begin)
        ids, starts = self._pieces(symbol, np.append(starts, len(symbol)), points, begin_u)
        text_words = np.searchsorted(begin, offsets)
        return ids, starts, word, text_words

    def _pieces(self, symbol, starts, points, begin) -> tuple[np.ndarray, np.ndarray]:
        """Symbols as ids; characters that are no piece become the ids of their bytes.

        Such a character never merges, so its word is that one character, or it
        is a part of pieces but none itself and is left over in a word.
        """
        odd = np.flatnonzero((symbol < 0) | (symbol >= self.size))
        if not len(odd):
            return symbol, starts
        extra = {i: c for c, i in self.extra.items()}
        parts, lengths = [], np.diff(starts).copy()
        word = np.searchsorted(starts, odd, side="right") - 1
        last = 0
        for at, w in zip(odd.tolist(), word.tolist()):
            char = extra[int(symbol[at])] if symbol[at] >= 0 else chr(points[begin[w]])
            parts += [symbol[last:at], self.bytes[list(char.encode("utf-8", "surrogatepass"))]]
            lengths[w] += len(parts[-1]) - 1
            last = at + 1
        parts.append(symbol[last:])
        return np.concatenate(parts), np.concatenate([[0], np.cumsum(lengths)])


@lru_cache(maxsize=2)
def _encoder(path: str) -> Encoder:
    return Encoder(path)


def encode_column(column: pa.Array, path: str, ids_wanted: bool) -> Iterator[pa.StructArray]:
    """Ids (if wanted), their number and digest, and the digest of the decoded text, slice by slice."""
    encoder = _encoder(path)
    for begin, end in slices(column, SLICE_BYTES, 1 << 30):
        texts = [t or "" for t in column.slice(begin, end - begin).to_pylist()]
        ids, starts, word, text_words = encoder.encode(texts)
        decimal = [encoder.decimal[i] for i in ids.tolist()]
        bound = starts.tolist()
        decimals = [b",".join(decimal[a:b]) if b - a > 1 else decimal[a] for a, b in zip(bound, bound[1:])]
        length = np.diff(starts)
        per_word = length[word]
        offsets = np.concatenate([[0], np.cumsum(per_word)])
        bounds = offsets[text_words]
        flat = ids[np.repeat(starts[:-1][word] - offsets[:-1], per_word) + np.arange(offsets[-1])] if len(word) else ids[:0]
        words = word.tolist()
        id_digest, text_digest = [], []
        for k in range(len(texts)):
            a, b = text_words[k], text_words[k + 1]
            id_digest.append(hashlib.sha256(b",".join([decimals[w] for w in words[a:b]])).hexdigest())
            decoded = encoder.library.decode(flat[bounds[k] : bounds[k + 1]]) if a < b else ""
            text_digest.append(hashlib.sha256(decoded.encode("utf-8")).hexdigest())
        lists = pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), pa.array(flat.astype(np.int32)))
        fields = [pa.array(np.diff(bounds)), pa.array(id_digest), pa.array(text_digest)]
        names = ["n_tokens", "ids_sha256", "decoded_sha256"]
        if ids_wanted:
            fields, names = [*fields, lists], [*names, "ids"]
        yield pa.StructArray.from_arrays(fields, names)


def encode(docs: DataFrame, model: str, name: str = "_pieces", ids: bool = True) -> DataFrame:
    """``docs`` with a struct column ``name``: ``n_tokens, ids_sha256, decoded_sha256`` and ``ids``.

    ``model`` is the path of a BPE model with byte fallback and plain
    normalisation, on every executor. A null ``text`` is an empty one and has no
    ids. Whole texts are encoded, whatever their length; repeated rows get equal
    results; other columns stay as they are.
    """
    kind = "n_tokens:long,ids_sha256:string,decoded_sha256:string" + (",ids:array<int>" if ids else "")

    @F.arrow_udf(f"struct<{kind}>")
    def run(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for column in columns:
            parts = list(encode_column(column, model, ids))
            yield pa.concat_arrays(parts)

    return docs.withColumn(name, run(F.col("text").cast("string")))


def decode(rows: DataFrame, model: str, ids: str = "ids", name: str = "decoded") -> DataFrame:
    """``rows`` with the text of each list of ids, by the library's decoder; null for a null list."""

    @F.arrow_udf("string")
    def run(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        library = _encoder(model).library
        for column in columns:
            yield pa.array([None if x is None else library.decode(x) if x else "" for x in column.to_pylist()], pa.string())

    return rows.withColumn(name, run(F.col(ids).cast("array<int>")))
