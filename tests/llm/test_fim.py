"""Fill-in-middle against plain slicing, and the skip list against prefix sums."""

import hashlib
import re

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tidemark.llm import fim


def plainly(doc_id, text):
    units = re.findall("[A-Za-z]+|[^A-Za-z]", text or "")
    n, text = len(units), text or ""
    h = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[8 * i : 8 * i + 8], 16) for i in range(4))
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h3 % 100 >= 90:
        return doc_id, n, "plain", None, None, text, text
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    prefix, middle, suffix = ("".join(units[x:y]) for x, y in ((0, a), (a, b), (b, n)))
    if h4 % 100 < 20:
        return doc_id, n, "spm", len(prefix), len(middle), f"<S>{suffix}<P>{prefix}<M>{middle}", text
    return doc_id, n, "psm", len(prefix), len(middle), f"<P>{prefix}<S>{suffix}<M>{middle}", text


@settings(max_examples=150, deadline=None)
@given(st.lists(st.integers(1, 9), max_size=400))
def test_skip_list_reaches_every_rank(widths):
    lanes = fim.SkipList(np.array(widths, np.int64))
    before = np.append(0, np.cumsum(widths))
    assert [lanes.chars_before(r) for r in range(len(widths) + 1)] == before.tolist()
    with pytest.raises(IndexError):
        lanes.chars_before(len(widths) + 1)


def test_skip_list_of_many_units_is_searched_in_few_steps():
    widths = np.random.default_rng(1).integers(1, 12, 300_000)
    lanes = fim.SkipList(widths)
    assert len(lanes.units) > 6 and sum(map(len, lanes.units)) < 1.5 * len(widths)
    for w, c in zip(lanes.units, lanes.chars, strict=True):
        assert w.sum() == len(widths) and c.sum() == widths.sum()
    before = np.append(0, np.cumsum(widths))
    for rank in (0, 1, 2, 12_345, 150_000, 299_999, 300_000):
        assert lanes.chars_before(rank) == before[rank]
    runs = [(np.diff(np.flatnonzero(np.append(np.isin(np.arange(len(lo)), up), True))).max()) for lo, up in zip(lanes.units, lanes.below[1:], strict=False)]
    assert max(runs) < 80  # links passed on one lane at most


ODD = ["", None, "a", "é", "<P>", "x <S> y", "a<M", "<", "<<P", "S><M", "ab1cd  \n😀😀x" * 30, "日本語", "a" * 4000, "A-z[`{@Z" * 9, "\x00\x7f퟿"]


def test_table(spark, documents):
    rows = [(i, t) for i in range(0, 400, 9) for t in ODD] + [(None, "no id here"), (3, "twice"), (3, "twice"), (7, "long words " * 120_000)]
    out = fim.restore(fim.fill_in_middle(documents(rows)))
    got = [tuple(r) for r in out.select("doc_id", "n", "form", "prefix_chars", "middle_chars", "output", "restored").collect()]
    assert sorted(got, key=str) == sorted((plainly(*r) for r in rows), key=str)
    assert {r[2] for r in got} == {"plain", "psm", "spm"}
    assert fim.restore(fim.fill_in_middle(documents([]))).count() == 0


@settings(max_examples=200, deadline=None)
@given(st.integers(0, 10**12), st.text(st.one_of(st.sampled_from("<>PSMab 1é\n"), st.characters(exclude_categories=["Cs"])), max_size=60))
def test_any_text(doc_id, text):
    assert (doc_id, *fim.transform_text(doc_id, text, 1), text) == plainly(doc_id, text)
