import gzip
import io
import json
import tarfile

from paperloom import sinks, sources
from paperloom.operators import archives


def write(path, text):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_bytes(text if isinstance(text, bytes) else text.encode())
    return str(path)


def test_read_id_list(spark, tmp_path):
    path = write(tmp_path / "dois.txt", "10.1/a\n\n  https://doi.org/10.1/S2 \n\t\n10.1/b\n")
    rows = sources.read_id_list(spark, path, "doi").orderBy("row_no").collect()
    assert [r["key"] for r in rows] == ["10.1/a", "https://doi.org/10.1/s2"[16:], "10.1/b"]
    path = write(tmp_path / "pmcids.txt", "PMC1\npmc\n pmc \nPMC2\n")
    assert [r["key"] for r in sources.read_id_list(spark, path, "pmcid").orderBy("row_no").collect()] == ["PMC1", "PMC2"]
    assert sources.id_list_size(spark, path).first()[0] == 4


def test_read_release_unites_two_generations(spark, tmp_path):
    old = write(tmp_path / "a.csv", 'cord_uid,sha,title,doi,pmcid,pubmed_id,license,abstract,publish_time,Microsoft Academic Paper ID,url\n'
                'u1,,"A, ""quoted"" title\nover lines",10.1/a,,,,,2020-01-02,77,\n\n')
    new = write(tmp_path / "b.csv", "cord_uid,doi,mag_id,arxiv_id,sha,title\nu2, ,m2,ax,s2,\n")
    rows = [r.asDict() for r in sources.read_release(spark, old, new).orderBy("row_no").collect()]
    first, second = rows
    assert first["title"] == 'A, "quoted" title\nover lines' and first["sha"] == "" and first["pmcid"] is None
    assert first["mag_id"] is None and first["arxiv_id"] is None
    assert (second["mag_id"], second["arxiv_id"], second["doi"], second["url"]) == ("m2", "ax", " ", None)


def test_read_release_reads_each_file_of_a_folder_by_its_own_header(spark, tmp_path):
    folder = tmp_path / "a folder"
    folder.mkdir()
    write(folder / "a.csv", "cord_uid,sha,title,doi,url\nu1,s1,T1,10.1/a,http://u1\n")
    write(folder / "b.csv", "cord_uid,title,sha,doi,url,mag_id\nu2,T2,s2,10.1/b,http://u2,m2\n")
    rows = [r.asDict() for r in sources.read_release(spark, str(folder)).orderBy("row_no").collect()]
    assert [tuple(r[c] for c in ("cord_uid", "sha", "title", "doi", "url", "mag_id")) for r in rows] == [
        ("u1", "s1", "T1", "10.1/a", "http://u1", None), ("u2", "s2", "T2", "10.1/b", "http://u2", "m2")]


def test_read_pmc_oa_last_line_wins_and_quotes_are_text(spark, tmp_path):
    path = write(tmp_path / "oa.txt", '2020-09-11 10:00:00\noa/1.tar.gz\t"J. X\tPMC1\tPMID:1\tCC BY\noa/2.tar.gz\tc\tPMC2\t\tNO-CC CODE\noa/3.tar.gz\tc"\tPMC1\tPMID:9\tCC0\n')
    got = {r["pmcid"]: tuple(r)[1:] for r in sources.read_pmc_oa(spark, path).collect()}
    assert got == {"PMC1": ("oa/3.tar.gz", "PMID:9", "CC0"), "PMC2": ("oa/2.tar.gz", "", "NO-CC CODE")}


def test_short_lines_of_the_archive_list_are_error_rows(spark, tmp_path):
    path = write(tmp_path / "oa.txt", "2020-09-11\ta\tb\tc\td\noa/1.tar.gz\tc\tPMC1\t\tCC0\noa/2.tar.gz\tPMC2\n\n")
    assert [r["pmcid"] for r in sources.read_pmc_oa(spark, path).collect()] == ["PMC1"]
    assert sorted(r["line"] for r in sources.read_pmc_oa_errors(spark, path).collect()) == ["", "oa/2.tar.gz\tPMC2"]


def test_lines_that_are_not_json_are_error_rows(spark, tmp_path):
    path = write(tmp_path / "biblio.jsonl", '{"doi": "10.1/a"}\n{"doi": \nnot json\n')
    assert [r["doi"] for r in sources.read_biblio(spark, path).collect()] == ["10.1/a"]
    assert sorted(r["line"] for r in sources.read_record_errors(spark, path).collect()) == sorted(["not json", "{\"doi\": "])


def test_read_pub_map(spark, tmp_path):
    path = write(tmp_path / "map.csv.gz", gzip.compress(b"doi,pii,pmid,pdf\n10.1/A,S1,,one.pdf\n,S2,,two.pdf\n10.1/a,,,three.pdf\n"))
    got = {(r["kind"], r["key"]): r["pdf"] for r in sources.read_pub_map(spark, path).collect()}
    assert got == {("doi", "10.1/a"): "three.pdf", ("pii", "S1"): "one.pdf", ("pii", "S2"): "two.pdf"}


def test_publisher_meta_to_map(spark, tmp_path):
    def meta(core, **rest):
        return json.dumps({"full-text-retrieval-response": {"coredata": core, **rest}}, indent=1)

    write(tmp_path / "meta" / "x" / "S1_meta.json", meta({"prism:doi": "10.1/A", "pii": "S1"}, **{"pubmed-id": "5"}))
    write(tmp_path / "meta" / "S2_meta.json", meta({"pii": "S2"}))
    write(tmp_path / "meta" / "notes.txt", "not json")
    rows = sources.read_publisher_meta(spark, str(tmp_path / "meta"))
    assert sorted(map(tuple, rows.collect())) == [("", "S2", "", "S2.pdf"), ("10.1/A", "S1", "5", "S1.pdf")]
    sinks.write_pub_map(rows, str(tmp_path / "out"))
    back = sources.read_pub_map(spark, str(tmp_path / "out"))
    assert {(r["kind"], r["key"], r["pdf"]) for r in back.collect()} == {("doi", "10.1/a", "S1.pdf"), ("pii", "S1", "S1.pdf"), ("pii", "S2", "S2.pdf")}


def test_scans(spark, tmp_path):
    write(tmp_path / "d" / "ab" / "cd" / "abcd.pdf", "12345")
    write(tmp_path / "d" / "ab" / "cd" / "abcd-ref-annotations.json", "{}")
    write(tmp_path / "d" / "x.txt", "")
    got = sources.scan_artifacts(spark, str(tmp_path / "d"))
    assert sorted((r["id"], r["kind"] or "", r["size"]) for r in got.collect()) == [("abcd", "pdf", 5), ("abcd", "ref_annotations", 2), ("x", "", 0)]
    write(tmp_path / "o" / "document_parses" / "pmc_json" / "PMC1.xml.json", "{}")
    write(tmp_path / "o" / "document_parses" / "pdf_json" / "s1; s2.json", "{}")
    write(tmp_path / "o" / "other.json", "{}")
    assert sorted(map(tuple, sources.scan_official(spark, str(tmp_path / "o")).collect())) == [("pdf", "s1; s2"), ("pmc", "PMC1")]


def archive(*members, mode="w:gz"):
    buffer = io.BytesIO()
    with tarfile.open(fileobj=buffer, mode=mode) as tar:
        for name, content in members:
            info = tarfile.TarInfo(name)
            if content is None:
                info.type = tarfile.DIRTYPE
                tar.addfile(info)
            else:
                info.size = len(content)
                tar.addfile(info, io.BytesIO(content))
    return buffer.getvalue()


def test_extract_archives(spark, tmp_path):
    good = archive(("d.pdf", None), ("x/a.PDF", b"%PDF-1"), ("x/b.pdf", b"%PDF-2"), ("x/a.nxml", b"1"), ("x/b.nxml", b"2"))
    write(tmp_path / "a" / "good.tar.gz", good)
    write(tmp_path / "a" / "nopdf.tar.gz", archive(("x/a.nxml", b"1")))
    write(tmp_path / "a" / "cut.tar.gz", good[:40])
    write(tmp_path / "a" / "junk.tar.gz", b"junk")
    write(tmp_path / "a" / "other.zip", b"junk")
    write(tmp_path / "a" / "empty.tar.gz", b"")
    found = sources.scan_archives(spark, str(tmp_path / "a"))
    rows = archives.extract_archives(sources.read_content(found, str(tmp_path / "a"))).collect()
    got = {r["id"]: r for r in rows}
    assert set(got) == {"good", "nopdf", "cut", "junk", "empty"}
    assert bytes(got["good"]["pdf"]) == b"%PDF-1" and bytes(got["good"]["nxml"]) == b"2" and got["good"]["error"] is None
    assert got["nopdf"]["no_pdf"] and got["nopdf"]["nxml_name"] == "x/a.nxml"
    assert got["cut"]["error"] and got["junk"]["error"] and got["empty"]["error"] and got["cut"]["pdf"] is None


def test_decompress(spark):
    rows = [("a", gzip.compress(b"text")), ("b", b"plain"), ("c", b""), ("d", None), ("e", b"\x1f\x8b\x08 broken"), ("f", gzip.compress(b""))]
    out = archives.decompress(spark.createDataFrame(rows, "id string, payload binary")).collect()
    got = {r["id"]: (None if r["payload"] is None else bytes(r["payload"]), r["usable"]) for r in out}
    assert got == {"a": (b"text", True), "b": (b"plain", True), "c": (b"", False), "d": (None, False), "e": (None, False), "f": (b"", False)}


def test_convert_and_place(spark):
    def converter(file, content):
        if file.startswith("bad"):
            raise ValueError("no")
        return content.upper()

    rows = spark.createDataFrame([("abcdefgh.nxml", b"x"), ("bad.nxml", b"y"), ("q.other", b"z")], "file string, content binary")
    done = archives.convert(rows, converter)
    assert {r["file"]: r["error"] for r in done.collect()} == {"abcdefgh.nxml.xml": None, "bad.nxml.xml": "ValueError: no", "q.other.xml": None}
    placed = archives.place_converted(done).collect()
    assert [(r["id"], r["target"], bytes(r["content"])) for r in placed] == [("abcdefgh", "ab/cd/ef/gh/abcdefgh/abcdefgh.pub2tei.tei.xml", b"X")]


def test_biblio_records_keep_both_spellings_and_the_rest(spark, tmp_path):
    lines = ['{"DOI": "10.1/A", "pmid": 5, "reference": [1], "own": {"x": 1}}', '{"doi": "10.1/b", "DOI": ""}', "not json"]
    path = write(tmp_path / "b.jsonl", "\n".join(lines))
    rows = sources.read_biblio(spark, path).selectExpr("doi", "pmid", "to_json(raw) as raw").collect()
    assert [(r["doi"], r["pmid"]) for r in rows][0] == ("10.1/A", "5") and len(rows) == 2
    assert json.loads(rows[0]["raw"])["own"] == {"x": 1}
    pruned = sources.read_fallback(spark, path).selectExpr("to_json(raw) as raw").first()["raw"]
    assert json.loads(pruned) == {"DOI": "10.1/A", "pmid": 5, "own": {"x": 1}}


def test_part_files_go_by_their_number(spark, tmp_path):
    names = ["b.txt", "part-99999-x.txt", "part-100000-x.txt", "part-2-x.txt", "a.txt"]
    for name in names:
        write(tmp_path / name, f"10.1/{name}\n")
    write(tmp_path / "z" / "part-1", "10.1/z\n")
    rows = sources.read_id_list(spark, f"{tmp_path}/*", "doi").orderBy("row_no").collect()
    assert [r["key"].removeprefix("10.1/") for r in rows] == ["a.txt", "b.txt", "part-2-x.txt", "part-99999-x.txt", "part-100000-x.txt", "z"]
