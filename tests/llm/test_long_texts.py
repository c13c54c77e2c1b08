"""Texts that are hashed or counted in several pieces give what they give in one."""

import numpy as np
import pytest

from paperloom.llm import language, minhash

TEXTS = ["ab c d", "x", "", None, "\u00e9\u00e9a b\tc" * 9, " ", "one word" + "s" * 70, "a b c d e f g " * 20]


@pytest.mark.parametrize("size", [1, 2, 7, 64])
def test_shingles_do_not_depend_on_the_bytes_hashed_at_a_time(monkeypatch, size):
    whole = {w: list(minhash.shingle_sets(TEXTS, w)) for w in (3, 5)}
    monkeypatch.setattr(minhash, "HASHED", size)
    for width, sets in whole.items():
        assert all(map(np.array_equal, sets, minhash.shingle_sets(TEXTS, width)))


def one_by_one(text: str) -> dict[str, int]:
    """Counts of the n-grams of a text in lower case, for letters and blanks."""
    padded, out = f" {text} ", {}
    for at in range(len(padded)):
        for n in (1, 2, 3):
            gram = padded[at:at + n]
            if len(gram) == n and (gram[1] != " " if n == 3 else gram.strip()):
                out[gram] = out.get(gram, 0) + 1
    return out


@pytest.mark.parametrize("size", [1, 2, 3, 50])
def test_ngrams_do_not_depend_on_the_characters_counted_at_a_time(monkeypatch, size):
    monkeypatch.setattr(language, "CHARS", size)
    monkeypatch.setattr(language.ngrams, "__defaults__", (size,))
    text = "the cat and the hat of the bat"
    codes, _ = language.letters_of([text], language.letter_codes())
    def name(gram: str) -> int:
        number = 0
        for c in gram:
            number = number << 21 | (ord(c) if c != " " else 0)
        return number

    # Numbers of a gram that starts with a blank and of a shorter one are the same.
    expected = {}
    for gram, n in one_by_one(text).items():
        expected[name(gram)] = expected.get(name(gram), 0) + n
    grams, counts = language.counted(codes)
    assert dict(zip(grams.tolist(), counts.tolist())) == expected
