"""Memory of a task that counts shingles."""

import tracemalloc

import numpy as np
import pyarrow as pa

from cellsift.llm import minhash, words


def test_counting_shingles_takes_little_memory_beside_the_texts():
    """The check tool stopped op10 at 3000 MB of an executor: a slice of texts took 70 bytes for each of its own."""
    texts = pa.array([" ".join(f"w{(i * 7919 + k * 31) % 50021}" for k in range(300)) for i in range(1100)] + [None, "", "one two"])
    batch = pa.record_batch([texts], names=["text"])
    list(minhash._sketch([batch.slice(0, 10)]))
    tracemalloc.start()
    list(minhash._sketch([batch]))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 32 * texts.nbytes
    whole = words.count_within(*words.shingles(words.find_words(texts)))
    for limit in (1, 5_000, 1 << 30):
        assert all(np.array_equal(a, b) for a, b in zip(words.count_texts(texts, limit), whole))
    none = words.count_texts(pa.array([], pa.string()))
    assert [len(x) for x in none] == [0, 0, 0]
