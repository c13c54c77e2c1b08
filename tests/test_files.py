"""Listing, heads and placing of real files."""

import os

import pyarrow.fs as pafs
import pytest
from pyspark.sql import functions as F

from paperloom import files, sinks, sources
from paperloom.functions import CONTENT_KINDS, judge_artifacts
from paperloom.operators.joins import shuffle_tasks
from paperloom.sources import listings
from tests.test_sources import archive, write


@pytest.fixture
def deep_tree(tmp_path):
    """One first-level folder, far below it 48 folders, with files on several levels."""
    root = tmp_path / "tree"
    for n in range(48):
        for k in range(3):
            write(root / "only" / "one" / "way" / f"d{n}" / f"f{k}.pdf", b"x" * k)
    write(root / "top.txt", b"top")
    (root / "only" / "empty").mkdir()
    os.symlink(root, root / "only" / "back")
    return root


def everything(root):
    return sorted((os.path.join(d, f), os.path.getsize(os.path.join(d, f))) for d, _, names in os.walk(root) for f in names)


@pytest.mark.parametrize("walk", [1, 7, listings.WALK])
@pytest.mark.parametrize("page", [2, listings.PAGE])
def test_list_files_walks_any_tree(spark, deep_tree, monkeypatch, walk, page):
    monkeypatch.setattr(listings, "PAGE", page)
    assert sorted(map(tuple, sources.list_files(spark, str(deep_tree), walk).collect())) == everything(deep_tree)


def test_a_deep_root_spreads_over_all_tasks(spark, deep_tree):
    """48 folders under a single way down are listed by every task, not by the one that came upon them."""
    way = deep_tree / "only" / "one" / "way"
    frontier = spark.createDataFrame([(str(way / f"d{n}"), -1) for n in range(48)], "path string, size long").coalesce(1)
    found = listings.next_round(frontier, str(deep_tree), 1).withColumn("task", F.spark_partition_id())
    per_task = dict(found.groupBy("task").count().collect())
    assert len(per_task) == shuffle_tasks(frontier) and max(per_task.values()) <= 2 * 3 * 48 / len(per_task)


def test_an_empty_root(spark, tmp_path):
    assert sources.list_files(spark, str(tmp_path)).count() == 0


def test_content_decides(spark, tmp_path):
    bodies = {
        "pdf": b"%PDF-1.4 x", "nxml": b"\xef\xbb\xbf \n<?xml version='1.0'?><a/>", "nlm": b"<?xml?>", "pdf_tei": b"<?xml?>",
        "jats_tei": b"<?xml?>", "json": b'{"a": "' + b"y" * 5000 + b'"}', "ref_annotations": b"[1]",
        "thumb_small": b"\x89PNG\r\n\x1a\nz", "thumb_medium": b"\x89PNG\r\n\x1a\n", "thumb_large": b"\x89PNG\r\n\x1a\n",
    }
    assert set(bodies) == set(CONTENT_KINDS)
    from paperloom.values import ARTIFACT_SUFFIXES
    for kind, body in bodies.items():
        write(tmp_path / "ok" / f"good{ARTIFACT_SUFFIXES[kind]}", body)
        write(tmp_path / "bad" / f"page{ARTIFACT_SUFFIXES[kind]}", b"<html>not here</html>")
        write(tmp_path / "cut" / f"none{ARTIFACT_SUFFIXES[kind]}", b"" if kind != "json" else bodies["json"][:-1])
    write(tmp_path / "ok" / "good.txt", b"%PDF-")
    got = {(r["id"], r["kind"]): r["valid"] for r in sources.scan_judged(spark, str(tmp_path)).collect()}
    assert {k for (i, k), v in got.items() if v} == set(bodies) and all(i == "good" for (i, _), v in got.items() if v)
    assert len(got) == 3 * len(bodies) + 1 and got["good", None] is False


def test_heads_come_in_bounded_frames_and_survive_a_lost_file(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(listings, "HELD", 10)
    for n in range(20):
        write(tmp_path / f"a{n}.json", b"[" + b" " * 2000 + b"]")
        write(tmp_path / f"a{n}.pdf", b"%PDF-" + b" " * 2000)
    found = sources.scan_artifacts(spark, str(tmp_path)).cache()
    assert found.count() == 40
    (tmp_path / "a3.json").unlink()
    rows = sources.read_heads(found, str(tmp_path)).collect()
    sizes = {(r["kind"], None if r["head"] is None else len(r["head"])) for r in rows}
    assert len(rows) == 40 and sizes == {("json", 2002), ("json", None), ("pdf", 512)}
    judged = judge_artifacts(spark.createDataFrame(rows, "path string, id string, kind string, file string, size long, head binary"))
    assert judged.where("not valid").count() == 1


PDF = b"%PDF-1 " + b"p" * 3_000_000


def packed(folder):
    write(folder / "abcdefgh.tar.gz", archive(("d.pdf", None), ("x/a.PDF", PDF), ("x/b.pdf", b"%PDF-2"), ("x/a.nxml", b"1"), ("x/b.nxml", b"22")))
    write(folder / "nopdf.tar.gz", archive(("x/a.nxml", b"1")))
    write(folder / "fake.tar.gz", archive(("x/a.pdf", b"<html>"), ("x/a.nxml", b"1")))
    write(folder / "late.tar.gz", archive(("x/a.pdf", PDF), ("x/a.nxml", b"1"))[:-200])
    write(folder / "junk.tar.gz", b"junk")
    write(folder / "empty.tar.gz", b"")


def test_archives_to_tree(spark, tmp_path):
    packed(tmp_path / "in")
    out = tmp_path / "out"
    for _ in range(2):  # a second run puts the same files there again
        rows = sinks.archives_to_tree(sources.scan_archives(spark, str(tmp_path / "in")), str(tmp_path / "in"), str(out)).collect()
        got = {(r["id"], r["kind"]): (r["path"], r["size"], r["error"]) for r in rows}
        assert got["abcdefgh", "pdf"] == ("ab/cd/ef/gh/abcdefgh/abcdefgh.pdf", len(PDF), None)
        assert got["abcdefgh", "nxml"] == ("ab/cd/ef/gh/abcdefgh/abcdefgh.nxml", 2, None)
        assert got["nopdf", "pdf"][2] == "no pdf" and got["nopdf", "nxml"][1] == 1
        assert got["fake", "pdf"] == (None, None, "not a pdf") and got["fake", "nxml"][1] == 1
        assert all(got[i, None][0] is None and got[i, None][2] for i in ("late", "junk", "empty"))
        there = {str(p.relative_to(out)): p.read_bytes() for p in out.rglob("*") if p.is_file()}
        assert there == {
            "ab/cd/ef/gh/abcdefgh/abcdefgh.pdf": PDF, "ab/cd/ef/gh/abcdefgh/abcdefgh.nxml": b"22",
            got["nopdf", "nxml"][0]: b"1", got["fake", "nxml"][0]: b"1"}


def test_a_file_counts_only_when_whole(tmp_path):
    store, path = pafs.LocalFileSystem(), str(tmp_path / "a" / "b.pdf")

    def broken():
        yield b"half"
        raise OSError("executor lost")

    with pytest.raises(OSError):
        files.write_file(store, path, broken())
    assert os.listdir(tmp_path / "a") == []
    assert files.write_file(store, path, [b"wh", b"ole"]) == 5 and open(path, "rb").read() == b"whole"


def test_place_found_and_copy(spark, tmp_path):
    work = tmp_path / "work"
    for name, body in (("abcdefgh.pdf", b"%PDF-1"), ("abcdefgh.nxml", b"n"), ("abcdefgh.nlm", b"n"), ("zz.pdf", b"<html>"),
                       ("zz-thumb-large.png", b"p"), ("other.pdf", b"%PDF-1"), ("copy/abcdefgh.nxml", b"later")):
        write(work / name, body)
    entries = spark.createDataFrame([("abcdefgh",), ("zz",), ("without",)], "id string")
    plan = sinks.place_found(entries, sources.scan_judged(spark, str(work)))
    manifest = sinks.place_files(plan, str(tmp_path / "tree")).collect()
    assert {(r["id"], r["kind"], r["error"]) for r in manifest} == {
        ("abcdefgh", "pdf", None), ("abcdefgh", "nxml", None), ("zz", "thumb_large", None)}
    assert {r["path"] for r in manifest} == {r["path"] for r in plan.collect()}
    assert (tmp_path / "tree/ab/cd/ef/gh/abcdefgh/abcdefgh.nxml").read_bytes() == b"n"
