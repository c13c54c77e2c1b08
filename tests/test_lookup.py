import pytest
from pyspark.sql import functions as F

from checks.compare import plan_text
from paperloom.operators import lookup, upsert
from paperloom.plans import resolve_oa_link
from paperloom.schemas import LOCATION_RECORD

PMC = "https://www.ncbi.nlm.nih.gov/pmc/articles/PMC1"
RECORDS = {
    "best_pdf": ((PMC, "http://x/p.pdf"), [], "http://x/p.pdf"),
    "best_blank_pdf_on_pmc": ((PMC, ""), [], PMC + "/pdf/"),
    "no_best": (None, [("u", "http://x/p.pdf")], None),
    "best_without_url": ((None, None), [("u", "http://x/p.pdf")], "http://x/p.pdf"),
    "hosted_keeps_its_url": (("http://x", None), [("u1", "p1"), ("u2.pdf", "http://europepmc.org/articles/pmc9?pdf")], "u2.pdf/pdf/"),
    "hosted_without_url": (("http://x", None), [(None, "http://ncbi.nlm.nih.gov/pmc/articles/9")], None),
    "any_pdf_even_blank": (("http://x", None), [("u0", None), ("u1", ""), ("u2", "p2")], ""),
    "nothing": (("http://x", None), [("u0", None)], None),
    "no_list": (("http://x", None), None, None),
}


def test_choose_location(spark):
    rows = [(f"10.1/{name}", best, others) for name, (best, others, _) in RECORDS.items()]
    got = {r["doi"]: r["url"] for r in lookup.choose_location(spark.createDataFrame(rows, LOCATION_RECORD)).collect()}
    assert got == {f"10.1/{name}": want for name, (_, _, want) in RECORDS.items()}


def test_flat_locations_give_the_same_choice(spark):
    rows = []
    for name, (best, others, _) in RECORDS.items():
        places = [("b", best)] if best else []
        places += [("o", o) for o in others or []]
        rows += [(f"10.1/{name}", at, kind == "b", *place) for at, (kind, place) in enumerate(places)]
    flat = spark.createDataFrame(rows, "doi string, pos int, is_best boolean, url string, url_for_pdf string")
    got = {r["doi"]: r["url"] for r in lookup.choose_flat_location(flat).collect()}
    want = {f"10.1/{n}": w for n, (_, _, w) in RECORDS.items()}
    assert got == {k: want[k] for k in got} and len(got) == len(RECORDS)


def test_known_ids_are_reused_and_new_ones_are_stable(spark):
    keys = spark.createDataFrame([(1, "doi", "a"), (2, "pmid", "a"), (3, "doi", "z")], "row_no int, kind string, key string")
    id_map = spark.createDataFrame([("doi", "a", "known"), ("id", "z", "other")], "kind string, key string, id string")
    first, again = (sorted(map(tuple, lookup.resolve_ids(keys, id_map).collect())) for _ in range(2))
    assert first == again and first[0] == (1, "doi", "a", "known", True)
    assert not first[1][4] and not first[2][4] and first[1][3] != first[2][3]


@pytest.fixture
def snapshots(spark):
    biblio = spark.createDataFrame(
        [(1, "10.1/A", "p1", None, "i1", "by doi"), (2, None, "p2", "c2", None, "by pmid"), (3, "10.1/a", None, "c3", None, "later")],
        "rec_id long, doi string, pmid string, pmcid string, istexid string, title string")
    fallback = spark.createDataFrame([(1, "10.1/f", "deposit"), (2, "10.1/a", "unused")], "rec_id long, doi string, title string")
    return biblio, fallback


ASKED = [(1, "https://doi.org/10.1/A", "p2", None, None), (2, "10.1/x", "p2", None, None), (3, "", "", "c3", None),
         (4, None, None, None, "i1"), (5, "10.1/F", "p9", "", None), (6, "10.1/x", None, None, None)]


@pytest.mark.parametrize("split", [False, True])
def test_biblio_ladder(spark, snapshots, split, request):
    if split:
        request.getfixturevalue("split_all")
    biblio, fallback = snapshots
    rows = ASKED + [(n, "10.1/a", None, None, None) for n in range(10, 20)]
    asked = spark.createDataFrame(rows, "row_no long, doi string, pmid string, pmcid string, istexid string")
    got = {r["row_no"]: (r["matched_by"], r["title"]) for r in lookup.biblio_lookup(asked, biblio, fallback).collect()}
    want = {1: ("doi", "by doi"), 2: ("pmid", "by pmid"), 3: ("pmcid", "later"), 4: ("istexid", "by doi"), 5: ("fallback", "deposit")}
    assert got == want | {n: ("doi", "by doi") for n in range(10, 20)}


def test_doi_mapped_to_a_missing_file_ends_the_search(spark):
    entries = spark.createDataFrame([("e1", "10.1/A", "S1"), ("e2", None, "S1"), ("e3", "10.1/q", "S9")], "id string, doi string, pii string")
    pub_map = spark.createDataFrame([("doi", "10.1/a", "gone.pdf"), ("pii", "S1", "here.pdf")], "kind string, key string, pdf string")
    files = spark.createDataFrame([("here.pdf",)], "pdf string")
    got = sorted(map(tuple, lookup.pub_file_lookup(entries, pub_map, files, "/b/").collect()))
    assert got == [("e1", "doi", "/b/gone.pdf", False), ("e2", "pii", "/b/here.pdf", True)]


def test_ladder_of_links(spark):
    fields = "id string, doi string, pii string, pmcid string, oa_link string, has_valid_oa_url boolean, has_valid_pdf boolean"
    entries = spark.createDataFrame([
        ("pub", "10.1/p", None, "PMC1", "old", True, False), ("leg", "10.1/l", None, "PMC1", "old", False, False),
        ("pmc", "10.1/l", None, "PMC1", None, None, None), ("loc", "10.1/l", None, "PMC9", "", False, False),
        ("old", None, None, None, "old", False, False), ("none", None, None, None, "", False, False),
        ("done", "10.1/p", None, "PMC1", "old", True, True),
    ], fields)
    linked = resolve_oa_link(
        entries,
        pub_map=spark.createDataFrame([("doi", "10.1/p", "p.pdf")], "kind string, key string, pdf string"),
        pub_files=spark.createDataFrame([("p.pdf",)], "pdf string"),
        legacy=spark.createDataFrame([("leg", "pdf", True), ("pmc", "pdf", False), ("pmc", "nxml", True)], "id string, kind string, valid boolean"),
        pmc_oa=spark.createDataFrame([("PMC1", "oa/1.tar.gz", "CC")], "pmcid string, subpath string, license string"),
        locations=spark.createDataFrame([("10.1/l", "http://l")], "doi string, url string"),
        pub_base="/pub", legacy_root="/old",
    )
    got = {r["id"]: (r["oa_link"], r["oa_source"], r["has_valid_oa_url"]) for r in linked.collect()}
    assert got == {
        "pub": ("file:///pub/p.pdf", "publisher", True), "leg": ("file:///old/le/g/leg/leg.pdf", "legacy", True),
        "pmc": ("ftp://ftp.ncbi.nlm.nih.gov/pub/pmc/oa/1.tar.gz", "pmc", True), "loc": ("http://l", "location", True),
        "old": ("old", "existing", True), "none": (None, None, False), "done": ("old", None, True),
    }


def test_merge_directions(spark):
    rows = spark.sql("""
      select 'a' as id, 'T' as title, '2020-01-01' as publish_time, '' as sha, '' as license, 'new' as abstract, 'm' as mag_id,
        '' as who_covidence_id, 'Row' as doi, 'pc' as pmcid, 'pm' as pubmed_id, 'ax' as arxiv_id,
        struct('Rec' as doi, cast(null as string) as pmid, '' as pmcid, 'old' as abstract, 'lic' as license_simplified, cast(null as string) as title,
               'w' as who_covidence, 'sha0' as cord_sha, true as has_valid_pdf) as record
      union all select 'b', 'T', '2020-01-01', 's', 'l', null, null, null, 'Row', '', '', null, null""")
    a, b = (r.asDict() for r in upsert.merge_release(rows).orderBy("id").collect())
    assert (a["title"], a["year"], a["cord_sha"], a["license_simplified"], a["abstract"], a["mag_id"], a["who_covidence"]) == (None, None, "", "lic", "new", "m", "w")
    assert (a["doi"], a["pmid"], a["pmcid"], a["arxiv_id"], a["has_valid_pdf"], a["has_valid_tei"]) == ("Rec", "pm", "pc", "ax", True, False)
    assert (b["title"], b["year"], b["cord_sha"], b["doi"], b["pmid"], b["has_valid_pdf"]) == ("T", "2020-01-01", "s", "Row", None, False)


def test_records_are_joined_once_and_keys_stay_narrow(spark, snapshots):
    asked = spark.createDataFrame(ASKED, "row_no long, doi string, pmid string, pmcid string, istexid string")
    plan = plan_text(lookup.biblio_lookup(asked, *snapshots), "extended").split("== Optimized Logical Plan ==")[1]
    assert plan.split("== Physical Plan ==")[0].count("Join ") == 2 and "Cartesian" not in plan
