"""Vectorised words against regular expressions."""

import brute
import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from footfall.llm import text as T

TEXTS = st.lists(
    st.one_of(st.none(), st.text("aB1 \t\né.,日\x00\x0b-", max_size=40)), max_size=12
)


@settings(max_examples=150, deadline=None)
@given(TEXTS)
def test_words_match_the_pattern(texts):
    for table, plain in ((T.WHITE, brute.white_words), (T.NOT_ALNUM, brute.alnum_words)):
        found = T.words(pa.array(texts, pa.string()), table)
        strings = found.strings(np.arange(len(found))).to_pylist()
        got = [strings[a:b] for a, b in zip(found.first[:-1], found.first[1:], strict=True)]
        assert got == [plain(t) for t in texts]


@settings(max_examples=60, deadline=None)
@given(TEXTS, TEXTS)
def test_equal_words_have_equal_hashes_wherever_they_are(one, other):
    known = {}
    for texts in (one, other, one + other):
        found = T.words(pa.array(texts, pa.string()), T.WHITE)
        words = found.strings(np.arange(len(found))).to_pylist()
        for word, h in zip(words, found.hashes().tolist(), strict=True):
            assert known.setdefault(word, h) == h
    assert len(set(known.values())) == len(known)


def test_chunks_keep_order_and_whole_texts():
    texts = ["a" * n for n in (0, 5, 100, 3, 3, 0)]
    batch = pa.RecordBatch.from_arrays([pa.array(texts)], names=["t"])
    parts = list(T.chunks(batch, "t", 8))
    assert [x for p in parts for x in p.column("t").to_pylist()] == texts
    assert [p.num_rows for p in parts] == [2, 1, 3] or len(parts) >= 3
