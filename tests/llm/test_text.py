import re

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from viewloom.llm import text as X

TEXTS = st.lists(st.one_of(st.none(), st.text(alphabet=st.sampled_from("aAbBzé \t\n\x0b\r\x1c\x85|#"), max_size=40)), max_size=6)
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def ascii_lower(t):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t)


@settings(max_examples=200, deadline=None)
@given(TEXTS)
def test_words_and_shingles(texts):
    values, at = X.word_values(pa.array(texts, pa.string()))
    expected = [WORD.findall(ascii_lower(t or "")) for t in texts]
    assert np.diff(at).tolist() == [len(w) for w in expected]
    names = {}
    for v, w in zip(values.tolist(), [w for ws in expected for w in ws], strict=True):
        assert names.setdefault(w, v) == v
    assert len(set(names.values())) == len(names)
    runs, starts = X.windows(values, at)
    distinct, begin = X.distinct(runs, starts)
    shingles = [{tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set()) for w in expected]
    assert np.diff(begin).tolist() == [len(s) for s in shingles]


def test_sliced_and_long_columns():
    column = pa.array(["x y", "Long " * 300_000, None, "tail"])
    for c in (column, column.slice(1), column.cast(pa.large_string())):
        values, at = X.word_values(c)
        assert np.diff(at).tolist()[-3:] == [300_000, 0, 1]
        assert values[-1] == X.value_of(b"TAIL")
    assert len(set(X.word_values(column)[0].tolist())) == 4


def test_slices_keep_every_row():
    batch = pa.record_batch([pa.array(["a" * 10, "b" * 100, "", None, "c"])], names=["text"])
    assert [r for b in X.slices([batch], "text", 16) for r in b.column(0).to_pylist()] == batch.column(0).to_pylist()
