import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from corpusmill.llm.shared import Words, distinct_sorted, text_parts

from .common import shingles, words

TEXTS = st.lists(st.one_of(st.none(), st.text(alphabet="aAbé .\n\t\x0b\xa0,", max_size=40)), max_size=6)


@settings(max_examples=200, deadline=None)
@given(TEXTS)
def test_words_and_shingles_match_brute_force(texts):
    w = Words(pa.array(texts, pa.string()))
    got = [[bytes(w.low[a:b]) for a, b in zip(w.start[x:y], w.end[x:y])] for x, y in zip(w.first[:-1], w.first[1:])]
    assert got == [words(t) for t in texts]
    first, h = w.shingles()
    sets = distinct_sorted(first, h)
    want = [shingles(t) for t in texts]
    assert [len(s) for s in sets] == [len(s) for s in want]
    for i in range(len(texts)):
        for j in range(len(texts)):
            assert len(np.intersect1d(sets[i], sets[j])) == len(want[i] & want[j])


def test_slices_hold_every_row_once():
    batch = pa.RecordBatch.from_pydict({"t": ["a" * n for n in (0, 5, 50, 1, 1, 0)] + [None]})
    parts = list(text_parts([batch, batch.slice(2, 3)], "t", 10))
    assert sum(p.num_rows for p in parts) == 10 and max(p.num_rows for p in parts) < 7


def test_sliced_arrays():
    w = Words(pa.array(["x y", "a b", "c"]).slice(1))
    assert list(w.first) == [0, 2, 3]
