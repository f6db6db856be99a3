import re

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from shelfwise.llm import tokens

TEXTS = st.lists(st.one_of(st.none(), st.text(alphabet="ab1 \n.,é«“漢、 ", max_size=20)), max_size=6)


def plain(text):
    return re.findall("[ab1é漢]+", text or "")


@settings(max_examples=300, deadline=None)
@given(TEXTS)
def test_words(texts):
    words = tokens.split_words(pa.array(texts, pa.string()))
    found = [[words.text(i) for i in range(a, b)] for a, b in zip(words.first, words.first[1:])]
    assert found == [plain(t) for t in texts]
    by_hash = {}
    for i, h in enumerate(words.hash.tolist()):
        assert by_hash.setdefault(h, words.text(i)) == words.text(i)
    assert len(by_hash) == len(set(by_hash.values()))


@settings(max_examples=200, deadline=None)
@given(TEXTS, st.integers(1, 4))
def test_grams(texts, k):
    words = tokens.split_words(pa.array(texts, pa.string()))
    hashes, first = tokens.grams(words.hash, words.first, k)
    seen = {}
    for row, text in enumerate(texts):
        own = plain(text)
        runs = [tuple(own[i:i + k]) for i in range(max(len(own) - k + 1, min(len(own), 1)))]
        got = hashes[first[row]:first[row + 1]].tolist()
        assert len(got) == len(runs)
        for h, run in zip(got, runs):
            assert seen.setdefault(h, run) == run
    assert len(seen) == len(set(seen.values()))


def test_slices_cover_all_rows():
    batch = pa.RecordBatch.from_pydict({"text": ["a" * n for n in (0, 5, 100, 1, 1, 0, 50)] + [None]})
    parts = list(tokens.slices(batch, "text", 10))
    assert [t for p in parts for t in p.column("text").to_pylist()] == batch.column("text").to_pylist()
    assert max(p.num_rows for p in parts) < 8 and list(tokens.slices(batch.slice(0, 0), "text")) == []


def test_a_slice_of_an_array():
    whole = pa.array(["x y", None, "z é", ""])
    words = tokens.split_words(whole.slice(1, 2))
    assert [words.text(i) for i in range(len(words.hash))] == ["z", "é"] and words.first.tolist() == [0, 0, 2]
    assert np.array_equal(words.hash, tokens.split_words(pa.array(["z é"])).hash)


def test_ascii_lower_of_slices():
    texts = pa.array(["AÉz", None, "", "ÀB" * 9, "C"] * 50)
    for kind in (pa.string(), pa.large_string()):
        for part in (texts.cast(kind), texts.cast(kind).slice(7, 100).slice(3)):
            lowered = tokens.ascii_lower(part)
            assert lowered.to_pylist() == [(t or "").replace("A", "a").replace("B", "b").replace("C", "c")
                                           for t in part.to_pylist()]
            assert tokens.split_words(lowered).first[-1] == sum(bool(t) for t in lowered.to_pylist())
