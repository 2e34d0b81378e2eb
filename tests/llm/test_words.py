"""Word identity: hashes without structured collisions, and spans that share a hash told apart."""

import numpy as np
import pyarrow as pa
import pytest
from sentencepiece import SentencePieceProcessor

from cellsift.llm import pieces, rules, words
from cellsift.llm.queries import piece_model


def thue_morse(n, letters):
    return "".join(letters[bin(i).count("1") % 2] for i in range(n))


@pytest.mark.parametrize("letters", ["ab", "es", "-=", "th"])
def test_two_words_of_1024_letters(letters):
    one, two = thue_morse(1024, letters), thue_morse(1024, letters[::-1])
    found = words.find_words(pa.array([f"{one} {two} {one}"]))
    assert found.hash[0] == found.hash[2] != found.hash[1]
    library = SentencePieceProcessor(model_file=piece_model())
    for texts in ([f"{one} {two}"], [one, two], [two, one, f"{two} {one} {two}"]):
        (got,) = pieces.encode_column(pa.array(texts), piece_model(), True)
        assert got.field("ids").to_pylist() == library.encode(texts)
    text = " ".join([one, two, one, one, two, two])
    stats = rules.text_statistics(pa.array([text]))
    assert stats["n_repeat_words"].tolist() == [0]


def test_spans_with_a_shared_hash():
    """Whatever the hash does, equal spans and only they have equal values, in any order."""
    rnd = np.random.default_rng(5)
    units = rnd.integers(0, 3, 4000).astype(np.uint8)
    start = rnd.integers(0, 3900, 900)
    end = start + rnd.integers(0, 6, 900)
    spans = [units[a:b].tobytes() for a, b in zip(start, end)]
    for value in (np.zeros(900, dtype=np.uint64), (end - start).astype(np.uint64), words.span_hashes(units, start, end)):
        got = words.told_apart(units, start, end, value)
        assert len(set(zip(got.tolist(), spans))) == len(set(spans)) == len(set(got.tolist()))
        order = rnd.permutation(900)
        assert (words.told_apart(units, start[order], end[order], value[order]) == got[order]).all()


def test_hash_does_not_depend_on_the_place():
    rnd = np.random.default_rng(6)
    for kind, top in ((np.uint8, 256), (np.uint32, 1 << 21)):
        span = rnd.integers(0, top, 50).astype(kind)
        units = np.concatenate([span, rnd.integers(0, top, 2_500_000).astype(kind), span])
        value = words.span_hashes(units, np.array([0, len(units) - 50]), np.array([50, len(units)]))
        assert value[0] == value[1] == words.span_hashes(span, np.array([0]), np.array([50]))[0]
