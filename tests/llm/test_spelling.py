"""Spelling variants against a plain dictionary of all edits."""

import re
import string
import zlib
from collections import Counter

import pytest

from paperloom.llm import queries, shared, spelling

pytestmark = pytest.mark.usefixtures("shared")
RUN = re.compile("[A-Za-zÀ-ÿ]+")
LOWER = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)


def brute(docs):
    n = Counter()
    for doc, text in docs:
        for run in RUN.findall(text or ""):
            run = run.translate(LOWER)
            h = zlib.crc32(f"{'' if doc is None else doc}:{run}".encode())
            if h % 31 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            n[run] += 1
    n = {w: c for w, c in n.items() if c >= 2 and len(w) >= 7}
    holes = {}
    for w in n:
        for i in range(len(w)):
            holes.setdefault((w[:i], w[i + 1:]), set()).add(w)
    near = {w: set() for w in n}
    for w in n:
        for i in range(len(w)):
            near[w] |= holes[w[:i], w[i + 1:]] - {w}
            if (shorter := w[:i] + w[i + 1:]) in n:
                near[w].add(shorter)
                near[shorter].add(w)
    form = {}
    for w, others in near.items():
        best = min(others, key=lambda o: (-n[o], o), default=None)
        form[w] = best if best and n[best] >= 10 * n[w] else None
    out = []
    for w in n:
        root = w
        while form[root]:
            root = form[root]
        out.append((w, form[w], root, n[w], len(near[w]), form[w] and n[form[w]]))
    return sorted(out, key=repr)


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def planted():
    """Chains of forms, ties, letters beyond ASCII, letters twice in a row, long runs."""
    words = ["encyclo", "encyclop", "encyclopx"]
    texts = [" ".join([w] * k) for w, k in zip(words, (2, 25, 300))]
    texts += ["aaaaaaa aaaaaaaa aaaaaaa aaaaaaaa aaaaaaaaa " * 3, "étéétéé étéétée Étéétéé " * 4,
              "tiedone " * 40 + "tiedtwo " * 40 + "tiedowo " * 2, "z" * 900 + " " + "z" * 901 + " " + "z" * 900 + " " + "z" * 901 + " " + "z" * 450 + "q" + "z" * 449 + " ",
              "multi×ply multi÷ply multixply " * 5, "l'exemple exemples exemplœ don't1234567stopping"]
    return [(i, t) for i, t in enumerate([*texts, *texts])]


@pytest.mark.parametrize("table", ["dirty", "documents"])
def test_spelling_variants(spark, request, table):
    docs = request.getfixturevalue(table)
    given = [(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()]
    assert rows(spelling.spelling_variants(docs)) == brute(given)


@pytest.mark.parametrize("max_blocks", [1, 1 << 20])
def test_planted(spark, monkeypatch, max_blocks):
    monkeypatch.setattr(spelling, "PROBES", 1000)
    monkeypatch.setattr(spelling, "HELD_WORDS", 3)
    df = spark.createDataFrame(planted(), "doc_id long, text string").selectExpr("*", "'x' as word", "1 as n").repartition(3)
    found = rows(spelling.spelling_variants(df, max_blocks=max_blocks))
    assert found == brute(planted())
    roots = {r[0]: r[2] for r in found}
    assert roots["encyclo"] == "encyclopx" and len({r for r in roots.values()}) < len(roots)


def test_many_words_near_one_another(spark):
    """Every second letter varied: full neighbourhoods, with no filter bit that is not looked at."""
    stems = [f"{a}{b}stemmo{c}" for a in "abcdef" for b in "xyzÿ" for c in "stuvw"]
    docs = [(i, f"{w} " * (1 + i % 23)) for i, w in enumerate([*stems, *(s + "e" for s in stems), *stems])]
    assert rows(spelling.spelling_variants(spark.createDataFrame(docs, "doc_id int, text string"))) == brute(docs)


def test_no_words(spark, no_rows):
    assert spelling.spelling_variants(no_rows).count() == 0
    few = spark.createDataFrame([(1, None), (2, "short words only, 1234567 ")], "doc_id long, text string")
    assert spelling.spelling_variants(few).count() == 0


@pytest.mark.parametrize("text", [b"", b"a" * 50, b"ab cd " * 20, "été été ".encode() * 9])
def test_pieces_keep_words_whole(monkeypatch, text):
    monkeypatch.setattr(shared, "PIECE", 7)
    cut = list(shared.pieces(text))
    assert b"".join(cut) == text
    assert [w for p in cut for w in p.split()] == text.split()


def test_query(spark):
    sf = "/root/testdata/sf0.001"
    given = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    assert rows(queries.spelling_variants(spark, sf)) == brute(given)
