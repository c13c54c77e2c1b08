"""Each operator against brute force, on dirty rows, on no rows and on the smallest tables."""

import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from paperloom.llm import (
    edit_counts, host_quality, language, minhash, mixing, packing, queries, records, sharding, site_lines, vectors,
)
from paperloom.llm.components import components
from paperloom.llm.tokens import WordEncoder, tokenizer_path
from paperloom.runtime import fresh_path
from tests.llm import brute

pytestmark = pytest.mark.usefixtures("shared")
SF = "/root/testdata/sf0.001"
TABLES = ("dirty", "documents")


def pairs(df):
    return [(r["doc_id"], r["text"]) for r in df.select("doc_id", "text").collect()]


@pytest.mark.parametrize("seed", range(3))
def test_components(spark, seed):
    rng = np.random.default_rng(seed)
    links = [*rng.integers(0, 300, (200, 2)).tolist(), *[[i, i + 1] for i in range(300, 420)], *[[500, i] for i in range(501, 600)]]
    found = {r["node"]: r["root"] for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    roots = brute.groups(600, links)
    assert found == {n: roots[n] for a, b in links if a != b for n in (a, b)}


# 1: near vectors


def vector_rows():
    rng = np.random.default_rng(1)
    base = rng.normal(size=(40, 16))
    rows = [(i, (base[i // 3] + rng.normal(size=16) * (0.05, 0.3)[i % 2]).tolist(), i // 60) for i in range(120)]
    rows += [(200, rows[0][1], 0), (0, rows[0][1], 0), (201, [2 * x for x in rows[0][1]], 0), (None, rows[3][1], 0)]
    rows += [(300, None, 0), (301, [], 0), (302, [0.0] * 16, 0), (303, [float("nan")] * 16, 0), (304, [None] * 16, 0),
             (305, rows[0][1], None), (306, [1.0, 2.0], 0), (307, [1.0, 2.0], 0), (308, [float("inf")] * 16, 0)]
    return rows


def expected_vectors(rows):
    links = brute.vector_links(rows)
    counts = Counter(i for pair in links for i in pair)
    root = brute.groups(len(rows), links)
    first = {r: min((rows[i][0] for i in range(len(rows)) if root[i] == r and rows[i][0] is not None), default=None) for r in set(root)}
    return sorted(((rows[i][0], counts[i], first[root[i]], rows[i][0] == first[root[i]]) for i in range(len(rows))), key=repr)


@pytest.mark.parametrize("shelf", [8, 1024])
def test_near_vectors(spark, monkeypatch, shelf):
    monkeypatch.setattr(vectors, "SHELF", shelf)
    rows = vector_rows()
    df = spark.createDataFrame([(*r, "x") for r in rows], "vec_id long, embedding array<float>, label int, node string")
    exact = [(r["vec_id"], r["embedding"], r["label"]) for r in df.collect()]
    assert sorted(map(tuple, vectors.near_vectors(df).collect()), key=repr) == expected_vectors(exact)
    assert vectors.near_vectors(df.limit(0)).count() == 0
    assert vectors.near_vectors(df.where("vec_id >= 300 and vec_id < 305")).where("n_links = 0 and kept").count() == 5


def test_near_vectors_recall(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/embeddings.parquet").select("vec_id", "embedding", "label").collect()]
    rng = np.random.default_rng(2)
    # Neighbours at the very border, which the given vectors lack.
    for i in range(300):
        x = np.array(rows[i][1], float)
        x /= np.linalg.norm(x)
        side = rng.normal(size=len(x))
        side -= side @ x * x
        rows.append((10_000 + i, (0.931 * x + np.sqrt(1 - 0.931**2) * side / np.linalg.norm(side)).tolist(), rows[i][2]))
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    found = vectors.near_vectors(df).agg(F.sum("n_links")).first()[0]
    assert found == 2 * len(brute.vector_links(rows))


# 2 and 5: tokens


@given(st.lists(st.text(st.characters(codec="utf-8"), max_size=60), max_size=5))
@settings(max_examples=150, deadline=None)
def test_word_encoder(texts):
    encoder = WordEncoder(tokenizer_path())
    assert [np.frombuffer(i, "<u4").tolist() for i in encoder.encode(texts)] == [i[:-1] for i in brute.ids_of(texts, 0)]


@pytest.mark.parametrize("table", TABLES)
def test_records(spark, request, table):
    docs = request.getfixturevalue(table)
    path = fresh_path(spark, "records")
    records.write_records(docs, path, tokenizer_path(), 2)
    rows = pairs(docs)
    ids = brute.ids_of([t for _, t in rows], 2)
    want = sorted((((d is not None, d or 0), i) for (d, _), i in zip(rows, ids)), key=lambda x: x[0])
    for seed in (None, 7):
        found = sorted(records.read_records(spark, path, seed).collect(), key=lambda r: r["start"])
        start = 0
        for row in found:
            assert (row["start"], row["n_tokens"]) == (start, len(row["ids"]) // 4)
            start += row["n_tokens"]
        assert [(r["doc_id"] is not None, r["doc_id"] or 0) for r in found] == [d for d, _ in want]
        assert Counter((r["doc_id"], bytes(r["ids"])) for r in found) == Counter(
            (d, np.array(i, "<u4").tobytes()) for (d, _), i in zip(rows, ids))


def test_records_none_and_damaged(spark, no_rows, tmp_path):
    records.write_records(no_rows, str(tmp_path / "none"), tokenizer_path(), 2)
    assert records.read_records(spark, str(tmp_path / "none")).count() == 0
    good = records.frame(b"payload")
    import io
    assert records.unframe(io.BytesIO(good)) == b"payload"
    for at in range(len(good)):
        with pytest.raises(ValueError):
            records.unframe(io.BytesIO(good[:at] + bytes([good[at] ^ 1]) + good[at + 1:]))


@pytest.mark.parametrize("table", TABLES)
def test_packing(request, table):
    docs = request.getfixturevalue(table)
    rows = packing.pack(docs, tokenizer_path(), 1).collect()
    by_sequence, by_doc = defaultdict(list), defaultdict(list)
    for r in rows:
        by_sequence[r["sequence_id"]].append(r)
        by_doc[r["doc_id"]].append(r)
        assert len(r["ids"]) == 4 * r["length"]
    padding = 0
    for pieces in by_sequence.values():
        at = 0
        for r in sorted(pieces, key=lambda r: r["offset"]):
            assert r["offset"] == at
            at += r["length"]
        assert at <= 2048
        padding += 0 if at & (at - 1) == 0 else 2048 - at
    assert padding <= 0.001 * sum(r["length"] for r in rows)
    once = Counter(d for d, _ in pairs(docs))
    for (doc_id, _), ids in zip(pairs(docs), brute.ids_of([t for _, t in pairs(docs)], 1)):
        if once[doc_id] == 1:
            pieces = sorted(by_doc[doc_id], key=lambda r: r["start"])
            assert b"".join(bytes(p["ids"]) for p in pieces) == np.array(ids, "<u4").tobytes()
            assert all(p["doc_tokens"] == len(ids) for p in pieces)
    assert sum(r["length"] for r in rows) == sum(map(len, brute.ids_of([t for _, t in pairs(docs)], 1)))


def test_packing_none(no_rows):
    assert packing.pack(no_rows, tokenizer_path(), 1).count() == 0
    with pytest.raises(ValueError):
        packing.pack(no_rows, tokenizer_path(), 1, capacity=1000)


# 3: counts under edits


def edited_text(text, edits):
    for e in edits or []:
        if e is not None:
            start, end, new = e
            start = max(0, min(start or 0, len(text)))
            end = max(start, min(end or 0, len(text)))
            text = text[:start] + (new or "") + text[end:]
    return text


SPAN = st.tuples(st.integers(0, 900), st.integers(0, 900), st.text("ab \n", max_size=8))


@given(st.text("abc. \n", max_size=900), st.lists(SPAN, max_size=6))
@settings(max_examples=100, deadline=None)
def test_segment_tree(text, edits):
    encoder = WordEncoder(tokenizer_path())
    parts = edit_counts.segments(text)
    tree = edit_counts.SegmentTree(parts, [len(i) // 4 for i in encoder.encode(parts)])
    for edit in edits:
        tree.edit(*edit[:2], edit[2], encoder)
    assert "".join(tree.parts) == edited_text(text, edits)
    assert tree.tokens[1] == len(next(encoder.encode([edited_text(text, edits)]))) // 4


def test_edit_counts(spark, dirty, no_rows):
    kind = "array<struct<start:long,end:long,new:string>>"
    edits = [[(0, 4, "zz")], [(5, 5, " new words "), None, (0, 10**9, None)], None, [], [(None, None, None), (3, 1, "x")]]
    texts = [r[1] for r in pairs(dirty)]
    rows = [(i, t, edits[i % len(edits)]) for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, f"doc_id long, text string, edits {kind}")
    found = {r["doc_id"]: r for r in edit_counts.count_edited(df, tokenizer_path()).collect()}
    for (i, text, todo), before, behind in zip(
        rows, brute.ids_of(texts, 0), brute.ids_of([edited_text(t or "", e) for _, t, e in rows], 0)
    ):
        assert (found[i]["n_tokens"], found[i]["edited_tokens"]) == (len(before) - 1, len(behind) - 1)
        assert found[i]["edited_chars"] == len(edited_text(text or "", todo))
    assert edit_counts.count_edited(queries.edited(no_rows), tokenizer_path()).count() == 0


def test_edit_counts_query(spark, documents):
    rows = [(r["doc_id"], r["text"], [tuple(e) for e in r["edits"]]) for r in queries.edited(documents).collect()]
    want = brute.ids_of([edited_text(t or "", e) for _, t, e in rows], 0)
    found = {r["doc_id"]: r for r in queries.REGISTRY["op3_edit_counts"](spark, SF).collect()}
    assert {d: len(i) - 1 for (d, _, _), i in zip(rows, want)} == {d: r["edited_tokens"] for d, r in found.items()}


# 4: lines


@pytest.mark.parametrize("table", TABLES)
def test_site_lines(request, table):
    docs = request.getfixturevalue(table)
    found = site_lines.drop_boilerplate(docs).select("row.*", F.col("text").alias("clean"), "n_lines", "n_dropped").collect()
    want = brute.boilerplate_free([(r["text"], r["source"]) for r in found])
    assert [r["clean"] for r in found] == want
    assert len(found) == docs.count() and (table == "documents" or sum(r["n_dropped"] for r in found) > 0)
    assert all(r["n_lines"] == (0 if r["text"] is None else r["text"].count("\n") + 1) for r in found)


def test_site_lines_none(no_rows):
    assert site_lines.drop_boilerplate(no_rows).count() == 0


# 6: language


def test_language(documents, dirty, no_rows):
    found = language.identify(documents).join(documents.select("doc_id", "lang", "text"), "doc_id").collect()
    for r in found:
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2)
        assert 0 <= r["score"] <= 1
    judged = [r["lang_pred"] == r["lang"] for r in found if r["held_out"] and len(r["text"].split()) >= 5]
    assert sum(judged) >= 0.97 * len(judged)
    rows = {r["doc_id"]: r for r in language.identify(dirty).collect()}
    assert all(rows[i]["lang_pred"] == "und" and rows[i]["score"] == 0 for i in (0, 1, 2, 13, 19))
    assert language.identify(dirty).count() == dirty.count()
    assert language.identify(no_rows).count() == 0
    assert language.identify(dirty.withColumn("lang", F.lit(None).cast("string"))).where("lang_pred != 'und'").isEmpty()


def test_language_profiles(documents):
    """Rankings and distances against plain counting."""
    def grams(text):
        low = "".join(c.lower() if c.isalpha() and len(c.lower()) == 1 else c if c.isalpha() else "\0" for c in f"\0{text}\0")
        out = Counter(c for c in low if c != "\0")
        out.update(low[i:i + 2] for i in range(len(low) - 1) if low[i:i + 2] != "\0\0")
        out.update(low[i:i + 3] for i in range(len(low) - 2) if low[i + 1] != "\0")
        return out

    def number(g):
        return sum(ord(c) << 21 * (len(g) - 1 - i) for i, c in enumerate(g))

    rows = documents.select("lang", "text").collect()
    sums = defaultdict(Counter)
    for lang, text in rows:
        for g, n in grams(text).items():
            sums[lang][number(g)] += n
    want = {lang: [g for g, _ in sorted(c.items(), key=lambda x: (-x[1], x[0]))[:language.RANKED]] for lang, c in sums.items()}
    profiles = language.learn(documents)
    assert profiles == want
    predicted = language.predict(documents.select(F.col("doc_id").alias("tag"), "text"), profiles).collect()
    texts = dict(pairs(documents))
    for tag, lang, score in predicted[:40]:
        own = Counter()
        for g, n in grams(texts[tag]).items():
            own[number(g)] += n
        top = [g for g, _ in sorted(own.items(), key=lambda x: (-x[1], x[0]))[:language.RANKED]]
        far = {k: sum(abs(i - p.index(g)) if g in p else language.RANKED for i, g in enumerate(top)) for k, p in want.items()}
        assert far[lang] == min(far.values())
        assert score == pytest.approx(1 - far[lang] / (language.RANKED * len(top)))


# 7: near-duplicates


def expected_near(rows, width, percent):
    sizes, links = brute.near_links([t for _, t in rows], width, percent)
    root = brute.groups(len(rows), links)
    first = {}
    for i, r in enumerate(root):
        ids = [rows[k][0] for k in range(len(rows)) if root[k] == r and rows[k][0] is not None]
        first[i] = min(ids, default=None)
    return sorted(((rows[i][0], sizes[i], first[i] if sizes[i] else rows[i][0]) for i in range(len(rows))), key=repr)


@pytest.mark.parametrize("table", TABLES)
@pytest.mark.parametrize("width,percent", [(3, 85), (5, 80)])
def test_near_duplicates(request, table, width, percent):
    docs = request.getfixturevalue(table)
    found = minhash.with_first(minhash.near_duplicates(docs, "doc_id", "text", width, percent))
    got = sorted(((r["key"], r["n_shingles"], r["component_id"]) for r in found.collect()), key=repr)
    assert got == expected_near(pairs(docs), width, percent)


def chain_rows():
    """A chain in which neighbours alone are similar, many copies of a text with one word changed,
    and many texts that share half of theirs."""
    words = [f"k{i}" for i in range(400)]
    rows = [" ".join(words[8 * i:8 * i + 200]) for i in range(20)]
    rows += [" ".join(w if k != 3 * i % 200 else f"v{i}" for k, w in enumerate(f"c{k}" for k in range(200))) for i in range(150)]
    rows += [" ".join([*(f"s{k}" for k in range(100)), *(f"o{i}x{k}" for k in range(30))]) for i in range(80)]
    return list(enumerate(rows))


def test_chains_and_hot_buckets(spark, monkeypatch):
    for name in ("BESIDE", "BLOCK"):
        monkeypatch.setattr(minhash, name, 8)
    rows = chain_rows()
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    found = minhash.with_first(minhash.near_duplicates(docs, "doc_id", "text", 3, 85))
    got = sorted(((r["key"], r["n_shingles"], r["component_id"]) for r in found.collect()), key=repr)
    assert got == expected_near(rows, 3, 85)


def test_keep_one(dirty, no_rows):
    rows = dirty.collect()
    kept = minhash.keep_one(dirty)
    assert kept.columns == dirty.columns
    sizes, links = brute.near_links([r["text"] for r in rows], 5, 80)
    root = brute.groups(len(rows), links)
    want = Counter()
    for r in set(root):
        own = [rows[i] for i in range(len(rows)) if root[i] == r]
        if brute.shingles(own[0]["text"], 5):
            want[min((x["doc_id"] is None, x["doc_id"] or 0) for x in own)] += 1
        else:
            want.update((x["doc_id"] is None, x["doc_id"] or 0) for x in own)
    assert Counter((r["doc_id"] is None, r["doc_id"] or 0) for r in kept.collect()) == want
    assert minhash.keep_one(no_rows).count() == 0


def test_word_hashes_ignore_place():
    one = list(minhash.shingle_sets(["a b c d"], 3))[0]
    assert np.array_equal(one, list(minhash.shingle_sets([LONG_PREFIX + "\n", "A\tb\x0bc  d "], 3))[1])


LONG_PREFIX = "some words before it " * 50


# 8: shards


@pytest.mark.parametrize("table", TABLES)
def test_shards(request, table):
    docs = request.getfixturevalue(table)
    rows = sharding.shard_documents(docs).collect()
    want = Counter((d, len((t or "").encode()) + 8, zlib.crc32((t or "").encode())) for d, t in pairs(docs))
    assert Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in rows) == want
    slots = defaultdict(list)
    for r in rows:
        assert 0 <= r["shard"] < 24 and r["law"] == "bytes" and r["grown_shard"] is None
        slots[r["shard"]].append(r["slot"])
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())


def test_shards_keep_links_and_sizes(spark):
    """Small links stay whole, one that is larger than a shard is cut over few, and sizes are even."""
    texts = [f"single {i:06d} " + "x" * (i % 50) for i in range(3000)]
    texts += [f"pair {i:05d}" for i in range(200) for _ in range(2)] + ["hot text of a third of all rows " * 2] * 1500
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(5)
    rows = sharding.shard_documents(docs, shards=6).collect()
    size, shards = Counter(), defaultdict(set)
    for r in rows:
        size[r["shard"]] += r["size"]
        shards[texts[r["doc_id"]]].add(r["shard"])
    mean = sum(size.values()) / 6
    assert all(abs(s - mean) <= 200 for s in size.values())
    assert sum(len(s) > 1 for t, s in shards.items() if t.startswith("pair")) <= 2
    hot = sum(r["size"] for r in rows if texts[r["doc_id"]].startswith("hot"))
    assert len(shards[texts[-1]]) <= hot / mean + 2


def test_shards_of_copies_and_none(spark, no_rows):
    docs = spark.createDataFrame([(i, f"text {i % 2}") for i in range(500)], "doc_id long, text string")
    rows = sharding.shard_documents(docs, shards=4).collect()
    assert sorted(Counter(r["shard"] for r in rows)) == [0, 1, 2, 3]
    assert max(Counter(r["shard"] for r in rows).values()) <= 127
    assert sharding.shard_documents(no_rows).count() == 0


# 9: mixing


@pytest.mark.parametrize("table", TABLES)
def test_mix(request, table):
    docs = request.getfixturevalue(table)
    mixed = mixing.mix(docs).select("row.*", *[F.col(c).alias(f"mix_{c}") for c in ("size", "source_size", "target", "copies")])
    rows = mixed.collect()
    sizes = Counter()
    for r in rows:
        assert r["mix_size"] == len(brute.WORD.findall(r["text"] or ""))
        sizes[r["source"]] += r["mix_size"]
    want = brute.targets(sizes)
    for r in rows:
        assert r["mix_source_size"] == sizes[r["source"]]
        assert r["mix_target"] == pytest.approx(want[r["source"]])
        rate = want[r["source"]] / sizes[r["source"]] if sizes[r["source"]] else 0
        assert int(rate + 1e-9) <= r["mix_copies"] <= min(3, int(rate) + 1)
    assert sorted(map(repr, mixed.collect())) == sorted(map(repr, rows))


def test_mix_is_near_targets_and_emits(spark, no_rows):
    docs = spark.createDataFrame([(i, "w " * (1 + i % 7), f"s{i % 4 if i % 3 else 0}") for i in range(8000)],
                                 "doc_id long, text string, source string")
    mixed = mixing.mix(docs)
    taken = mixed.groupBy("row.source").agg(F.sum(F.col("size") * F.col("copies")).alias("taken"), F.first("target").alias("target"))
    assert all(abs(r["taken"] - r["target"]) <= 3.5 for r in taken.collect())  # half of the longest document
    assert mixing.emit(mixed).count() == mixed.agg(F.sum("copies")).first()[0]
    assert mixing.emit(mixing.mix(no_rows)).count() == 0
    blank = spark.createDataFrame([(1, None, None), (2, "", "a")], "doc_id long, text string, source string")
    assert [r["copies"] for r in mixing.mix(blank).collect()] == [0, 0]


@given(st.dictionaries(st.text("abc", min_size=1, max_size=2), st.integers(0, 1000), min_size=1, max_size=9))
@settings(max_examples=15, deadline=None)
def test_targets(spark, sizes):
    df = spark.createDataFrame([(False, s, n) for s, n in sizes.items()], "_no_source boolean, _source string, source_size long")
    found = {r["_source"]: r["target"] for r in mixing.targets(df, mixing.WEIGHTS, 3).collect()}
    assert found == pytest.approx(brute.targets(sizes))


# 10: quality


@pytest.mark.parametrize("table", TABLES)
def test_quality(request, table):
    docs = request.getfixturevalue(table).select("doc_id", "text", "source")
    measured = host_quality.measure(docs, F.col("text"), F.col("source"))
    rows = host_quality.judge(measured).collect()
    hosts = defaultdict(list)
    for r in rows:
        want = brute.measures(r["text"])
        assert tuple(r[m] for m in host_quality.MEASURES) == want
        assert r["base_failed"] == (want[0] < 50 or 100 * want[4] > 50 * want[0])
        hosts[r["source"]].append(r["base_failed"])
    verdicts = brute.host_verdicts({h: (len(f), sum(f)) for h, f in hosts.items()})
    for r in rows:
        rate, good = verdicts[r["source"]]
        assert r["host_rate"] == pytest.approx(rate)
        assert r["kept"] == (not r["base_failed"] and good)


@pytest.mark.parametrize("hosts", [
    {"a": (100, 10), "b": (120, 13), "c": (80, 7), "bad": (90, 70), "one": (1, 1), "none": (3, 0)},
    {"a": (1000, 100), "b": (1200, 125)}, {"only": (5, 5)}, {"x": (4, 4), "y": (7, 7)}, {"x": (9, 0), "y": (2, 0)},
    {**{f"h{i}": (40, i % 9) for i in range(30)}, "small": (2, 2), "big": (400, 300)},
])
def test_host_verdicts(spark, hosts):
    """Hosts beyond chance are rejected, by the moments of all hosts weighted by pages."""
    rows = [(h, i < failed) for h, (n, failed) in hosts.items() for i in range(n)]
    found = host_quality.host_verdicts(spark.createDataFrame(rows, "host string, base_failed boolean")).collect()
    want = brute.host_verdicts(hosts)
    assert {r["host"]: r["host_kept"] for r in found} == {h: good for h, (_, good) in want.items()}
    for r in found:
        assert (r["n_pages"], r["n_failed"]) == hosts[r["host"]] and r["host_rate"] == pytest.approx(want[r["host"]][0])
    rejected = {h for h, (_, good) in want.items() if not good}
    assert rejected == {h for h in ("bad", "big") if h in hosts}


def test_quality_rejects_hosts_and_keeps_columns(spark, dirty, no_rows):
    good = " ".join(f"w{i}" for i in range(60))
    rows = [(i, good if i % 10 else "short", f"good{i % 5}") for i in range(250)] + [(1000 + i, "short" if i % 5 else good, "bad") for i in range(50)]
    kept = host_quality.keep_good(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()
    assert {r["source"] for r in kept} == {f"good{i}" for i in range(5)} and len(kept) == 225
    assert host_quality.keep_good(dirty).columns == dirty.columns
    assert host_quality.keep_good(no_rows).count() == 0
