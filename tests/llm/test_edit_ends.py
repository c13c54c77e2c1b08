"""Edits at the end of texts whose last segments earlier edits emptied."""

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from paperloom.llm import edit_counts
from paperloom.llm.tokens import WordEncoder, tokenizer_path
from tests.llm import brute

ENCODER = WordEncoder(tokenizer_path())
TEXT = "word " * 60 + "inter" + "nal matters " * 30


def check(text, edits):
    parts = edit_counts.segments(text)
    tree = edit_counts.SegmentTree(parts, [len(i) // 4 for i in ENCODER.encode(parts)])
    for start, end, new in edits:
        tree.edit(start, end, new, ENCODER)
        start = max(0, min(start, len(text)))
        text = text[:start] + new + text[max(start, min(end, len(text))):]
    assert "".join(tree.parts) == text
    assert tree.tokens[1] == len(brute.ids_of([text], 0)[0]) - 1


@pytest.mark.parametrize("edits", [
    [(305, 10**9, ""), (305, 305, "national")],
    [(305, 10**9, ""), (10**9, 10**9, "nat"), (10**9, 10**9, "ional")],
    [(0, 10**9, ""), (0, 0, "inter"), (5, 5, "national")],
    [(0, 10**9, "inter"), (10**9, 10**9, "national"), (3, 9, "")],
])
def test_append_behind_emptied_segments(edits):
    check(TEXT, edits)


def test_join_and_append():
    """The blank between the last two segments goes, and with it the last one."""
    first = edit_counts.segments("inter " * 80)[0]
    check(first + "nation", [(len(first) - 1, len(first), "-"), (10**9, 10**9, "al")])


@given(st.text("abcinter \n\xa0", min_size=300, max_size=900), st.integers(0, 900),
       st.lists(st.text("anol \xa0", max_size=6), max_size=4))
@settings(max_examples=30, deadline=None)
def test_cut_and_append(text, at, more):
    check(text, [(at, 10**9, ""), *[(10**9, 10**9, new) for new in more]])
