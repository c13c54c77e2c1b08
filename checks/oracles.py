"""DuckDB SQL for the registered queries, over the same views."""

from checks.views import LEGACY_ROOT, PUB_BASE, VIEWS, duckdb_text
from paperloom.values import (
    ARTIFACT_SUFFIXES, FLAGS, PMC_ARCHIVE_BASE, PMC_WEB_BASE,
)

ORACLES: dict[str, str] = {}


def _clean(c: str) -> str:
    return (f"lower(trim(case when starts_with({c}, 'https://doi.org/10.') then replace({c}, 'https://doi.org/', '') "
            f"when starts_with({c}, 'http://dx.doi.org/10.') then replace({c}, 'http://dx.doi.org/', '') else {c} end))")


def _doi(c: str) -> str:
    return f"nullif({_clean(c)}, '')"


def _path(c: str) -> str:
    steps = ", ".join(f"substr({c}, {at}, 2)" for at in (1, 3, 5, 7))
    return f"(array_to_string(list_filter([{steps}, {c}], lambda s: s <> ''), '/') || '/')"


def _stable(kind: str, key: str) -> str:
    h = f"md5('{kind}:' || {key})"
    return " || '-' || ".join(f"substr({h}, {at}, {n})" for at, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12)))


# Named parts that oracles are put together from; each may use those above it.
PARTS = {name: duckdb_text(name) for name in VIEWS}


def _kind_case() -> str:
    by_length = sorted(ARTIFACT_SUFFIXES.items(), key=lambda kv: -len(kv[1]))
    return "case " + " ".join(f"when ends_with(file, '{s}') then '{k}'" for k, s in by_length) + " end"


def _id_case() -> str:
    dashed = [s for s in ARTIFACT_SUFFIXES.values() if s.startswith("-")]
    cases = " ".join(f"when ends_with(file, '{s}') then left(file, length(file) - {len(s)})" for s in dashed)
    return f"case {cases} else split_part(file, '.', 1) end"


PARTS["files"] = f"""
select *, coalesce(case when kind = 'pdf' then starts_with(head_hex, '255044462D')
    when starts_with(kind, 'thumb') then starts_with(head_hex, '89504E470D0A1A0A')
    when kind in ('json', 'ref_annotations') then head_hex <> '' and json_valid(decode(unhex(head_hex)))
    else starts_with(head_hex, '3C3F786D6C') end, false) as valid
from (select path, {_id_case()} as id, {_kind_case()} as kind, file, size, head_hex
  from (select path, size, head_hex, string_split(path, '/')[-1] as file from fx_files) f) k"""
PARTS["pmc"] = """
select pmcid, subpath, pmid, license from fx_pmc_oa
qualify row_number() over (partition by pmcid order by line_no desc) = 1"""
PARTS["pub"] = """
select kind, key, pdf from (
  select 'doi' as kind, lower(doi) as key, pdf, line_no from fx_pub_map where doi <> ''
  union all select 'pii', pii, pdf, line_no from fx_pub_map where pii <> '') u
qualify row_number() over (partition by kind, key order by line_no desc) = 1"""
PARTS["official"] = r"""
select distinct kind, key from (
  select 'pmc' as kind, regexp_extract(path, 'pmc_json/([^/]*)\.xml\.json$', 1) as key from fx_official
  union all select 'pdf', regexp_extract(path, 'pdf_json/([^/]*)\.json$', 1) from fx_official) u
where key <> ''"""
PARTS["loc"] = f"""
select doi, case when best_n = 0 then null when coalesce(best_pdf, '') <> '' then best_pdf
    when starts_with(best_url, '{PMC_WEB_BASE}') then best_url || '/pdf/'
    when hosted_n > 0 then hosted || '/pdf/' else any_pdf end as url
from (
  select {_doi('doi')} as doi, count(*) filter (where is_best) as best_n,
    min(url_for_pdf) filter (where is_best) as best_pdf, min(url) filter (where is_best) as best_url,
    count(*) filter (where h) as hosted_n,
    first(url order by pos) filter (where h) as hosted,
    first(url_for_pdf order by pos) filter (where url_for_pdf is not null) as any_pdf
  from (select *, coalesce(url_for_pdf like '%europepmc.org/articles/pmc%' or url_for_pdf like '%ncbi.nlm.nih.gov/pmc/articles%', false) as h from fx_oa_loc) l
  group by 1) g"""
PARTS["rows_keyed"] = f"""
select *, nullif(cord_uid, '') as uid, {_doi('doi')} as dkey, nullif(pubmed_id, '') as pmid_key,
  nullif(pmcid, '') as pmcid_key from fx_meta"""


def _pub_lookup(entries: str) -> str:
    return f"""
select id, matched_by, '{PUB_BASE}/' || pdf as pdf_path, exists (select 1 from fx_pub_files f where f.pdf = x.pdf) as file_exists
from (
  select e.id, case when d.pdf is not null then 'doi' else 'pii' end as matched_by, coalesce(d.pdf, p.pdf) as pdf
  from {entries} e
  left join pub d on d.kind = 'doi' and d.key = {_doi('e.doi')}
  left join pub p on p.kind = 'pii' and p.key = e.pii) x
where pdf is not null"""


def _legacy(entries: str) -> str:
    stem = f"'{LEGACY_ROOT}/' || {_path('e.id')} || e.id"
    return f"""
select * from (
  select e.id, case when exists (select 1 from files f where f.id = e.id and f.kind = 'pdf' and f.valid) then {stem} || '.pdf' end as pdf_path,
    case when exists (select 1 from files f where f.id = e.id and f.kind = 'nxml') then {stem} || '.nxml' end as nxml_path
  from {entries} e) x
where pdf_path is not null or nxml_path is not null"""


def _linked(entries: str) -> str:
    """Entries after the ladder for the address of the full text."""
    settled = "(coalesce(e.has_valid_oa_url, false) and coalesce(e.has_valid_pdf, false))"
    return f"""
select e.* exclude (oa_link, has_valid_oa_url),
  case when {settled} then e.oa_link else coalesce(u1, u2, u3, u4, e.oa_link) end as oa_link,
  case when {settled} then null when u1 is not null then 'publisher' when u2 is not null then 'legacy'
    when u3 is not null then 'pmc' when u4 is not null then 'location' when e.oa_link is not null then 'existing' end as oa_source,
  coalesce(e.has_valid_oa_url, false) or coalesce(u1, u2, u3, u4, e.oa_link) is not null as has_valid_oa_url
from {entries} e
left join (select id, 'file://' || pdf_path as u1 from ({_pub_lookup(entries)}) a where file_exists) p on p.id = e.id
left join (select id, 'file://' || pdf_path as u2 from ({_legacy(entries)}) a where pdf_path is not null) l on l.id = e.id
left join (select pmcid, '{PMC_ARCHIVE_BASE}' || subpath as u3 from pmc) o on o.pmcid = e.pmcid
left join (select doi, url as u4 from loc where url is not null) c on c.doi = {_doi('e.doi')}"""


def _biblio(asked: str, istex: bool, fallback: bool) -> str:
    """Records for rows (row_no, doi key, pmid_key, pmcid_key, istexid)."""
    rungs = ["doi", "pmid", "pmcid"] + (["istexid"] if istex else [])
    on = {"doi": "dkey", "pmid": "pmid_key", "pmcid": "pmcid_key", "istexid": "istexid"}
    joins = "\n".join(f"left join fx_biblio b_{r} on b_{r}.{r} = a.{on[r]}" for r in rungs)
    pick = "case " + " ".join(f"when b_{r}.rec_id is not null then '{r}'" for r in rungs)
    pick += " when c.rec_id is not null then 'fallback' end" if fallback else " end"
    rec = "coalesce(" + ", ".join(f"b_{r}.rec_id" for r in rungs) + ")"
    fields = {"doi": "c.doi", "title": "c.title"}
    columns = ", ".join(
        f"case when m.matched_by = 'fallback' then {fields.get(f, 'null')} else r.{f} end as {f}"
        for f in ("doi", "pmid", "pmcid", "pii", "title", "year", "oa_link"))
    crossref = "left join fx_crossref c on c.doi = a.dkey" if fallback else ""
    return f"""
select m.row_no, m.matched_by, {columns}, cast(null as varchar) as abstract
from (select a.row_no, a.dkey, {pick} as matched_by, {rec} as rec_id from {asked} a {joins} {crossref}) m
left join fx_biblio r on r.rec_id = m.rec_id
left join fx_crossref c on m.matched_by = 'fallback' and c.doi = m.dkey
where m.matched_by is not null"""


def _accepted(source: str, known: str) -> str:
    """Recursive part `step`: rows one by one in order, with the list of keys taken so far."""
    return f"""num as (
  select row_no, list_filter([case when uid is not null then 'u:' || uid end, case when dkey is not null then 'd:' || dkey end], lambda k: k is not null) as ks,
    row_number() over (order by row_no) as rn
  from {source} where not ({known})),
step(rn, row_no, ok, seen) as (
  select cast(0 as bigint), cast(null as bigint), false, cast([] as varchar[])
  union all
  select n.rn, n.row_no, not list_has_any(s.seen, n.ks),
    case when list_has_any(s.seen, n.ks) then s.seen else list_concat(s.seen, n.ks) end
  from step s join num n on n.rn = s.rn + 1)"""


_KNOWN = ("coalesce(uid in (select key from fx_id_map where kind = 'id'), false) "
          "or coalesce(dkey in (select key from fx_id_map where kind = 'doi'), false)")


def _uses(text: str) -> list[str]:
    """Parts that a text needs, those of the parts included, in order of definition."""
    need, todo = set(), [text]
    while todo:
        current = todo.pop()
        for name, body in PARTS.items():
            if name not in need and _mentions(current, name):
                need.add(name)
                todo.append(body)
    return [n for n in PARTS if n in need]


def _mentions(text: str, name: str) -> bool:
    return any(f"{word} {name}{end}" in text for word in ("from", "join") for end in (" ", ")", "\n", ",")) or \
        any(text.endswith(f"{word} {name}") for word in ("from", "join"))


def oracle(name: str, body: str, extra: dict[str, str] | None = None, recursive: str = "") -> None:
    extra = extra or {}
    names = _uses("\n".join([body, recursive, *extra.values()]))
    ctes = [f"{n} as ({PARTS[n]})" for n in names]
    ctes += [recursive] if recursive else []
    ctes += [f"{n} as ({t})" for n, t in extra.items()]
    head = f"with {'recursive ' if recursive else ''}" + ",\n".join(ctes) + "\n" if ctes else ""
    ORACLES[name] = head + body


# Scalar functions
oracle("clean_doi", f"select row_no, doi, {_clean('doi')} as cleaned from fx_meta")
oracle("storage_path", f"select id, {_path('id')} as path from fx_entries")
oracle("init_flags", "select m.row_no, m.cord_uid, " + ", ".join(f"coalesce(e.{f}, false) as {f}" for f in FLAGS)
       + " from fx_meta m left join fx_entries e on e.id = m.cord_uid")
oracle("content_validity", r"""
select id, kind, coalesce(kind = 'pdf', false) as valid from (
  select id, case when payload_hex like '255044462D%' then 'pdf' when payload_hex like '89504E470D0A1A0A%' then 'png'
    when payload_hex like '1F8B%' then 'gzip'
    when regexp_matches(payload_hex, '^(EFBBBF)?(20|09|0A|0D)*3C3F786D6C') then 'xml'
    when page % 8 = 4 then 'json' end as kind
  from (select p.*, g.page_id as page from fx_payloads p join pages g on p.id = substr(md5(cast(4 * g.page_id as varchar)), 1, 12)) x) y""")
oracle("redirect_links", """
select substr(md5(cast(4 * page_id as varchar)), 1, 12) as id, case when page_id % 8 = 0 then url end as link from pages""")

# Indexes
oracle("artifact_index", "select path, id, kind, file, size from files")
oracle("pmc_oa_index", "select pmcid, subpath, pmid, license from pmc")
oracle("pub_map_index", "select kind, key, pdf from pub")
oracle("official_index", "select kind, key from official")

# Lookups
PARTS["key_rows"] = """
select row_no, 'doi' as kind, dkey as key from rows_keyed where dkey is not null
union all select row_no, 'pmid', pmid_key from rows_keyed where pmid_key is not null
union all select row_no, 'pmcid', pmcid_key from rows_keyed where pmcid_key is not null"""
PARTS["resolved"] = f"""
select k.row_no, k.kind, k.key, m.id is not null as known, coalesce(m.id, case k.kind when 'doi' then {_stable('doi', 'k.key')}
  when 'pmid' then {_stable('pmid', 'k.key')} else {_stable('pmcid', 'k.key')} end) as id
from key_rows k left join fx_id_map m on m.kind = k.kind and m.key = k.key"""
oracle("resolve_ids", "select row_no, kind, key, id, known from resolved")
oracle("not_yet_seen", f"select row_no, cord_uid, doi from rows_keyed where not ({_KNOWN})")
oracle("reuse_entries", """
select r.row_no, r.id, r.known, e.id is not null as reused, e.doi as entry_doi, e.pmid as entry_pmid, e.oa_link as entry_oa_link
from resolved r left join fx_entries e on e.id = r.id where r.kind = 'doi'""")
PARTS["asked"] = """
select row_no, dkey, pmid_key, pmcid_key, substr(md5('istex' || row_no), 1, 12) as istexid from rows_keyed"""
oracle("biblio_lookup", _biblio("asked", istex=True, fallback=True))
oracle("biblio_from_index", _biblio("asked", istex=True, fallback=True))
oracle("pub_file_lookup", _pub_lookup("fx_entries"))
oracle("pmc_lookup", f"""
select e.id, '{PMC_ARCHIVE_BASE}' || o.subpath as url, o.license from fx_entries e join pmc o on o.pmcid = e.pmcid""")
oracle("choose_location", "select doi, url from loc")
oracle("legacy_lookup", _legacy("fx_entries"))
_OPEN = "(coalesce(e.oa_link, '') <> '' and not coalesce(e.has_valid_pdf, false))"
PARTS["reusable"] = """
select * replace (has_valid_tei as has_valid_pdf, case when pmid is not null then coalesce(oa_link, 'https://example.org/lost') end as oa_link)
from fx_entries"""
oracle("reuse_legacy", f"""
select e.id, case when {_OPEN} and h.id is not null then coalesce(l.url, e.oa_link) else e.oa_link end as oa_link,
  coalesce(e.has_valid_oa_url, false) as has_valid_oa_url,
  coalesce(e.has_valid_pdf, false) or ({_OPEN} and h.pdf_path is not null) as has_valid_pdf
from reusable e left join ({_legacy("reusable")}) h on h.id = e.id
left join (select * from loc where url is not null) l on l.doi = {_doi('e.doi')}""")
oracle("reuse_legacy_copies", f"""
select h.id, k.kind, case k.kind when 'pdf' then pdf_path else nxml_path end as source
from ({_legacy("reusable")}) h join reusable e on e.id = h.id and {_OPEN}, (values ('pdf'), ('nxml')) k(kind)
where case k.kind when 'pdf' then pdf_path else nxml_path end is not null""")
PARTS["linked"] = _linked("fx_entries")
oracle("resolve_oa_link", "select id, doi, oa_link, oa_source, has_valid_oa_url, has_valid_pdf from linked")
oracle("missing_entries", "select kind, key, id from fx_id_map where id not in (select id from fx_entries)")

# Coverage and reports
PARTS["firsts"] = """
select * from fx_meta qualify row_number() over (partition by cord_uid order by row_no) = 1"""
PARTS["cover"] = """
select cord_uid, row_no, sha, doi, pmcid, pubmed_id, url, has_pmc_json, has_pdf_json, has_pmc_json or has_pdf_json as has_official,
  has_pdf_tei, has_jats_tei, has_pdf_tei or has_jats_tei as has_tei
from (select *,
  pmcid in (select key from official where kind = 'pmc') as has_pmc_json,
  sha in (select key from official where kind = 'pdf') as has_pdf_json,
  cord_uid in (select id from files where kind = 'pdf_tei') as has_pdf_tei,
  cord_uid in (select id from files where kind = 'jats_tei') as has_jats_tei
  from firsts) x"""
oracle("coverage_rows", "select * from cover")
oracle("coverage_report", """
select count(*) as n_distinct, count(*) filter (where has_pmc_json) as n_official_pmc, count(*) filter (where has_pdf_json) as n_official_pdf,
  count(*) filter (where has_official) as n_official, count(*) filter (where has_official and has_tei) as n_harvested,
  count(*) filter (where has_official and has_pdf_tei) as n_harvested_pdf_tei, count(*) filter (where has_official and has_jats_tei) as n_harvested_jats_tei,
  count(*) filter (where has_official and not has_tei) as n_missed, count(*) filter (where has_tei and not has_official) as n_extra,
  count(*) filter (where has_pdf_tei and not has_official) as n_extra_pdf_tei, count(*) filter (where has_jats_tei and not has_official) as n_extra_jats_tei,
  count(*) filter (where has_tei) as n_any_tei, (select count(*) from fx_meta) as n_rows, (select count(*) from fx_meta) - count(*) as n_duplicates
from cover""")
oracle("missed_entries", "select cord_uid, url from cover where has_official and not has_tei")
oracle("extra_entries", f"""
select cord_uid, doi, pmcid as pmc, pubmed_id as pmid,
  case when has_pdf_tei then {_path('cord_uid')} || cord_uid || '{ARTIFACT_SUFFIXES["pdf_tei"]}' else '' end as path_grobid,
  case when has_jats_tei then {_path('cord_uid')} || cord_uid || '{ARTIFACT_SUFFIXES["jats_tei"]}' else '' end as path_pub2tei
from cover where has_tei and not has_official""")
oracle("both_entries", "select cord_uid, has_pdf_tei, has_jats_tei from cover where has_tei and has_official")
PARTS["yearly"] = """
select split_part(publish_time, '-', 1) as year, count(*) as n from firsts where cord_uid <> '' and publish_time <> '' group by 1"""
PARTS["held"] = "select distinct id from files where kind in ('pdf', 'nxml', 'pdf_tei')"
PARTS["yearly_held"] = """
select split_part(publish_time, '-', 1) as year, count(*) as n from firsts
where cord_uid <> '' and publish_time <> '' and cord_uid in (select id from held) group by 1"""
oracle("entries_per_year", "select year, n from yearly")
oracle("harvested_per_year", "select year, n from yearly_held")
PARTS["totals"] = """
select (select count(*) from fx_meta) as total_entries, count(*) as total_distinct_entries,
  count(*) filter (where cord_uid in (select id from held)) as total_harvested_entries from firsts where cord_uid <> ''"""
oracle("collection_description", """
select 'total_entries' as metric, '' as year, total_entries as n from totals
union all select 'total_distinct_entries', '', total_distinct_entries from totals
union all select 'total_harvested_entries', '', total_harvested_entries from totals
union all select 'distribution_entries_per_year', year, n from yearly
union all select 'distribution_harvested_per_year', year, n from yearly_held""")
oracle("collection_totals", """
select 'sample' as name, total_entries, total_distinct_entries, total_harvested_entries,
  (select count(*) from yearly) as n_years, (select count(*) from yearly_held) as n_years_harvested from totals""")
PARTS["tei"] = """
select id, bool_or(kind = 'pdf_tei') as has_pdf_tei, bool_or(kind = 'jats_tei') as has_jats_tei,
  bool_or(kind in ('pdf_tei', 'jats_tei')) as has_tei
from files where kind in ('json', 'pdf_tei', 'jats_tei') group by id having bool_or(kind = 'json')"""
oracle("tei_presence", "select * from tei")
oracle("tei_report", """
select count(*) filter (where has_pdf_tei) as n_pdf_tei, count(*) filter (where has_jats_tei) as n_jats_tei,
  count(*) filter (where has_tei) as n_tei from tei""")
_WATERFALL = """
select n_total, n_invalid_url, n_invalid_url + p as n_invalid_pdf, n_invalid_url + p + t as n_invalid_tei,
  n_total - n_invalid_url - p - t as n_fully_valid, n_total - n_invalid_url as n_valid_url,
  n_total - n_invalid_url - p as n_valid_pdf, n_total - n_invalid_url - p - t as n_valid_tei
from (select count(*) as n_total, count(*) filter (where not has_valid_oa_url) as n_invalid_url,
  count(*) filter (where has_valid_oa_url and not has_valid_pdf) as p,
  count(*) filter (where has_valid_oa_url and has_valid_pdf and not has_valid_tei) as t from fx_entries) x"""
oracle("state_waterfall", _WATERFALL)
oracle("identifier_integrity", """
select count(distinct id) as n_ids, count(*) filter (where id not in (select id from fx_entries)) as n_rows_without_entry from fx_id_map""")
oracle("duplicate_census", """
select n_rows, n_rows - n_uids as n_explicit_duplicates, n_uids - n_distinct as n_article_duplicates, n_distinct
from (select count(*) as n_rows, count(distinct cord_uid) as n_uids, (select count(*) from step where ok) as n_distinct from fx_meta) x""",
       recursive=_accepted("rows_keyed", "false"))

# Which row counts
oracle("first_per_uid", "select row_no, cord_uid, doi, publish_time from firsts")
oracle("accept_first_come", "select row_no, cord_uid, doi from fx_meta where row_no in (select row_no from step where ok)",
       recursive=_accepted("rows_keyed", "false"))
oracle("accept_after_earlier_run", "select row_no, cord_uid, doi from fx_meta where row_no in (select row_no from step where ok)",
       recursive=_accepted("rows_keyed", _KNOWN))
# Of a chain, every other row is taken, from the first of each unbroken run of row numbers on.
oracle("accept_long_chain", """
select row_no, 'u' || (row_no + 1) // 2 as cord_uid, '10.1/' || row_no // 2 as doi
from (select row_no, row_number() over (partition by run order by row_no) as nth
      from (select row_no, row_no - row_number() over (order by row_no) as run from fx_meta))
where nth % 2 = 1""")
oracle("select_members", """
select archive_id, first(name order by member_no) filter (where is_file and (ends_with(name, '.pdf') or ends_with(name, '.PDF'))) as pdf_name,
  last(name order by member_no) filter (where is_file and ends_with(name, '.nxml')) as nxml_name,
  count(*) filter (where is_file and (ends_with(name, '.pdf') or ends_with(name, '.PDF'))) = 0 as no_pdf
from fx_members group by archive_id""")
PARTS["tried"] = """
select id, first(transport order by attempt_no) filter (where ok) as transport,
  case when bool_or(ok) then 'success' else 'failed' end as status, count(*) as n_attempts from fx_attempts group by id"""
oracle("first_success", "select * from tried")
oracle("conversion_batch", f"""
select id, file, path, {_path('id')} || id || '{ARTIFACT_SUFFIXES["jats_tei"]}' as target from files
where kind in ('nxml', 'nlm') qualify row_number() over (partition by file order by path) = 1""")

# State
_FLAG_FALSE = ", ".join(f"false as {f}" for f in FLAGS)
oracle("merge_release", f"""
select m.cord_uid as id, coalesce(f.doi, nullif(m.doi, '')) as doi, coalesce(f.pmid, nullif(m.pubmed_id, '')) as pmid,
  coalesce(f.pmcid, nullif(m.pmcid, '')) as pmcid, f.pii,
  case when f.row_no is null then m.title else f.title end as title,
  case when f.row_no is null then nullif(m.publish_time, '') else f.year end as year,
  m.sha as cord_sha, nullif(m.license, '') as license_simplified, nullif(m.abstract, '') as abstract, f.oa_link, {_FLAG_FALSE}
from fx_meta m left join found f on f.row_no = m.row_no""", {"found": _biblio("asked", istex=False, fallback=False)})
PARTS["updates"] = """
select cord_uid as id, row_no, nullif(doi, '') as doi, nullif(pubmed_id, '') as pmid, nullif(pmcid, '') as pmcid from firsts"""


def _keys_of(entries: str) -> str:
    return f"""
select kind, key, arg_max(id, row_no) as id from (
  select 'id' as kind, id as key, id, row_no from {entries} union all select 'doi', {_doi('doi')}, id, row_no from {entries}
  union all select 'pmid', pmid, id, row_no from {entries} union all select 'pmcid', pmcid, id, row_no from {entries}) u
where key is not null group by kind, key"""


PARTS["update_keys"] = _keys_of("updates")
PARTS["updated_map"] = """
select kind, key, id from fx_id_map o where not exists (select 1 from update_keys n where n.kind = o.kind and n.key = o.key)
union all select kind, key, id from update_keys"""
PARTS["updated_entries"] = """
select id, doi, pmid, pmcid, oa_link from fx_entries where id not in (select id from updates)
union all select id, doi, pmid, pmcid, null from updates"""
oracle("upsert_id_map", "select * from updated_map")
oracle("upsert_entries", "select * from updated_entries")
oracle("state_versions", "select 'entry' as kind, doi as key, id from updated_entries union all select kind, key, id from updated_map")
oracle("state_reset", "select 'entry' as kind, doi as key, id from updates union all select kind, key, id from update_keys")
oracle("select_failed", "select id from fx_entries where not has_valid_oa_url or not has_valid_pdf or not has_valid_tei")
oracle("select_failed_with_extras", "select id from fx_entries where not (" + " and ".join(FLAGS) + ")")
oracle("advance_flags", "select id, has_valid_oa_url, " + ", ".join(
    f"{flag} or id in (select id from files where kind = '{kind}' and valid) as {flag}"
    for flag, kind in (("has_valid_pdf", "pdf"), ("has_valid_tei", "pdf_tei"),
                       ("has_valid_ref_annotation", "ref_annotations"), ("has_valid_thumbnail", "thumb_small"))
) + " from fx_entries")

# Updates by a release and by a list
PARTS["old_entries"] = f"""
select id, doi, pmid, pmcid, pii, cast(null as varchar) as title, cast(null as varchar) as year, cast(null as varchar) as cord_sha,
  cast(null as varchar) as license_simplified, cast(null as varchar) as abstract, oa_link, {", ".join(FLAGS)} from fx_entries"""
_OUT = ("id, doi, pmid, pmcid, pii, title, year, cord_sha, license_simplified, abstract, oa_link, oa_source, "
        + ", ".join(FLAGS) + f", {_path('id')} as data_path")
_TAKEN = {
    "taken": "select * from rows_keyed where row_no in (select row_no from step where ok)",
    "unknown_rows": "select * from taken where uid not in (select id from fx_entries)",
    "found": _biblio("unknown_rows", istex=False, fallback=True),
    "merged": """
select t.uid as id, coalesce(e.doi, f.doi, nullif(t.doi, '')) as doi, coalesce(e.pmid, f.pmid, t.pmid_key) as pmid,
  coalesce(e.pmcid, f.pmcid, t.pmcid_key) as pmcid, coalesce(e.pii, f.pii) as pii,
  case when e.id is null and f.row_no is null then t.title else f.title end as title,
  case when e.id is null and f.row_no is null then nullif(t.publish_time, '') else f.year end as year,
  t.sha as cord_sha, nullif(t.license, '') as license_simplified, nullif(t.abstract, '') as abstract,
  coalesce(e.oa_link, f.oa_link) as oa_link, """ + ", ".join(f"coalesce(e.{f}, false) as {f}" for f in FLAGS) + """
from taken t left join old_entries e on e.id = t.uid left join found f on f.row_no = t.row_no""",
    "changed": _linked("merged"),
}
_AFTER = f"""
select {_OUT} from changed
union all select {_OUT.replace("oa_source", "cast(null as varchar) as oa_source").replace(_path('id') + " as data_path", "cast(null as varchar) as data_path")}
from old_entries where id not in (select id from changed)"""
oracle("ingest_release", _AFTER, _TAKEN, _accepted("rows_keyed", _KNOWN))
oracle("ingest_release_keys", """
select kind, key, id from fx_id_map o where not exists (select 1 from new_keys n where n.kind = o.kind and n.key = o.key)
union all select kind, key, id from new_keys""",
       {**_TAKEN, "new_keys": f"""
select kind, key, id from (
  select 'id' as kind, id as key, id from merged union all select 'doi', {_doi('doi')}, id from merged
  union all select 'pmid', pmid, id from merged union all select 'pmcid', pmcid, id from merged) u
join (select uid, row_no from taken) t on t.uid = u.id
where key is not null qualify row_number() over (partition by kind, key order by row_no desc) = 1"""},
       _accepted("rows_keyed", _KNOWN))
oracle("ingest_sample", f"select {_OUT} from changed", {
    **_TAKEN, "taken": _TAKEN["taken"] + " order by md5(uid), uid limit 20"}, _accepted("rows_keyed", _KNOWN))
oracle("ingest_release_again", "select uid as id, 'first' as run from taken", _TAKEN, _accepted("rows_keyed", _KNOWN))
oracle("ingest_errors", """
select version, batch, 'no identifier' as reason, title from fx_meta, (values (0, 'first'), (1, 'second')) b(version, batch) where row_no % 7 = 0""")
for _name in ("stream_releases", "stream_two_headers"):
    oracle(_name, _AFTER, _TAKEN, _accepted("rows_keyed", _KNOWN))
for _list, _kind, _asked in (("id", "doi", "dkey"), ("pmid", "pmid", "pmid_key"), ("pmcid", "pmcid", "pmcid_key")):
    oracle(f"ingest_{_list}_list", f"""
select id, doi, pmid, pmcid, pii, title, year, oa_link, oa_source, {", ".join(FLAGS)}, {_path('id')} as data_path from changed""", {
        "listed": "select row_no, id, " + ", ".join(
            f"key as {c}" if c == _asked else f"cast(null as varchar) as {c}" for c in ("dkey", "pmid_key", "pmcid_key"))
        + f" from resolved where kind = '{_kind}' qualify row_number() over (partition by id order by row_no desc) = 1",
        "unknown_rows": "select * from listed where id not in (select id from fx_entries)",
        "found": _biblio("unknown_rows", istex=False, fallback=True),
        "merged": """
select l.id, coalesce(l.dkey, e.doi, f.doi) as doi, coalesce(l.pmid_key, e.pmid, f.pmid) as pmid,
  coalesce(l.pmcid_key, e.pmcid, f.pmcid) as pmcid, coalesce(e.pii, f.pii) as pii,
  f.title, f.year, coalesce(e.oa_link, f.oa_link) as oa_link, """ + ", ".join(f"coalesce(e.{f}, false) as {f}" for f in FLAGS) + """
from listed l left join fx_entries e on e.id = l.id left join found f on f.row_no = l.row_no""",
        "changed": _linked("merged"),
    })

oracle("reprocess_failed", f"""
select id, oa_link, oa_source, {", ".join(FLAGS)}, {_path("id")} as data_path from linked
where id in (select id from fx_entries where not has_valid_oa_url or not has_valid_pdf or not has_valid_tei)""")
oracle("sample_articles", "select id from fx_entries order by md5(id), id limit 20")

# Fetching
oracle("fetch_plan", r"""
select id, oa_link as url, class, id || case when class = 'archive' then '.tar.gz' else '.pdf' end as target,
  case when starts_with(oa_link, 'ftp') then 'wget,ftp,session,plain' else 'session,plain,wget' end as transports,
  nullif(lower(regexp_extract(oa_link, '^[A-Za-z][A-Za-z0-9+.\-]*://([^/?#]+)', 1)), '') as host
from (select *, case when starts_with(oa_link, 'file://') then 'file' when ends_with(oa_link, '.tar.gz') then 'archive' else 'direct' end as class
  from linked where not has_valid_pdf and oa_link is not null) x""")
# Every step of the way from a first address on; a step is final if no further one follows from it.
oracle("redirect_plan", """
select * from (with recursive links as (
  select url, starts_with(page, '%PDF-') as is_pdf, case when not starts_with(page, '%PDF-')
    then nullif(replace(regexp_extract(page, 'id="redirect" href="([^"]*)"', 1), '&amp;', '&'), '') end as link
  from (select url, decode(unhex(payload_hex)) as page from fx_hops) p),
steps as (
  select id, url, url as last_url, [url] as seen, 0 as round from fx_starts
  union all select s.id, s.url, l.link, list_append(s.seen, l.link), s.round + 1 from steps s join links l on l.url = s.last_url
  where l.link is not null and not list_contains(s.seen, l.link) and s.round < 5)
select s.id, s.url, s.last_url, s.round, case when l.url is null then 'fetch' when l.is_pdf then 'pdf' when l.link is null then 'end'
  when list_contains(s.seen, l.link) then 'loop' else 'too_many' end as outcome
from (select * from steps qualify row_number() over (partition by id order by round desc) = 1) s left join links l on l.url = s.last_url) x""")
oracle("apply_fetch_results", """
select e.id, has_valid_pdf or coalesce(t.status = 'success' and p.good, false) as has_valid_pdf,
  case when t.status is null then 'none' when t.status = 'failed' then 'failed' when coalesce(p.good, false) then 'success' else 'invalid' end as fetch_status
from fx_entries e left join tried t on t.id = e.id
left join (select id, bool_or(payload_hex like '255044462D%') as good from fx_payloads group by id) p on p.id = e.id""")


# Sinks
def _json_line(fields: list[tuple[str, str, str]]) -> str:
    """JSON text of (name, text value or null, quoted or raw)."""
    items = [f"""'"{n}":' || {'chr(34) || ' + v + ' || chr(34)' if how == 'text' else v}""" for n, v, how in fields]
    return "'{' || concat_ws(',', " + ", ".join(items) + ") || '}'"


_STEM = f"{_path('id')} || id"
oracle("catalogue", "select id, " + _json_line([
    ("id", "id", "text"), ("DOI", "doi", "text"), ("pmid", "pmid", "text"), ("pmcid", "pmcid", "text"), ("oaLink", "oa_link", "text"),
    ("pdf_file_path", f"case when has_valid_pdf then {_STEM} || '.pdf' end", "text"),
    ("tei_file_path", f"case when has_valid_tei then {_STEM} || '{ARTIFACT_SUFFIXES['pdf_tei']}' end", "text"),
    ("json_metadata_file_path", f"{_STEM} || '.json'", "text")]) + " as line from fx_entries")
_FLAG_JSON = [(f, f"cast({f} as varchar)", "raw") for f in sorted(FLAGS)]
oracle("dump_metadata", "select id, " + _json_line(
    [("DOI", "doi", "text"), *_FLAG_JSON, ("id", "id", "text"), ("oaLink", "oa_link", "text"),
     ("pii", "pii", "text"), ("pmcid", "pmcid", "text"), ("pmid", "pmid", "text")]) + " as line from fx_entries")
oracle("dump_open_records", "select id, " + _json_line(
    [("DOI", "coalesce(doi, 'old')", "text"), ("id", "id", "text"), ("note", "coalesce(chr(34) || pmid || chr(34), 'null')", "raw"), ("pii", "pii", "text"),
     ("pmcid", "pmcid", "text"), ("z", "'1'", "raw")]) + " as line from fx_entries")
oracle("place_artifacts", "select * from (" + " union all ".join(
    f"select id, '{kind}' as kind, {_STEM} || '{ARTIFACT_SUFFIXES[kind]}' as path from fx_entries where {cond}"
    for kind, cond in (("json", "true"), ("pdf", "has_valid_pdf"), ("pdf_tei", "has_valid_tei"),
                       ("ref_annotations", "has_valid_ref_annotation"), ("thumb_small", "has_valid_thumbnail"),
                       ("thumb_medium", "has_valid_thumbnail"), ("thumb_large", "has_valid_thumbnail"))) + ") x")

oracle("place_found_artifacts", "select id, kind, min(path) as source, " + _path("id") + " || id || case kind "
       + " ".join(f"when '{k}' then '{x}'" for k, x in ARTIFACT_SUFFIXES.items()) + """ end as path
from files where kind in ('pdf', 'nxml', 'pdf_tei', 'json', 'ref_annotations', 'thumb_small', 'thumb_medium', 'thumb_large')
  and (kind <> 'pdf' or valid) and id in (select id from fx_entries) group by id, kind""")

# Through files
for _name in ("release_files", "release_two_headers"):
    oracle(_name, "select cord_uid, sha, source_x, " + ", ".join(
    f"nullif({c}, '') as {c}" for c in ("title", "doi", "pmcid", "pubmed_id", "license", "abstract", "publish_time", "url"))
    + " from fx_meta")
oracle("id_list_files", "select kind, key, count(*) as n from key_rows group by kind, key")
oracle("id_list_sizes", "select count(*) filter (where pmcid <> '') as n_lines from fx_meta")
oracle("pmc_oa_files", "select pmcid, subpath, pmid, license from pmc")
oracle("pmc_oa_errors", "select concat_ws(chr(9), subpath, pmcid) as line from fx_pmc_oa where line_no % 10 = 0")
oracle("pub_map_files", "select kind, key, pdf from pub")
oracle("publisher_meta_files", """
select case when page_id % 3 <> 0 then '10.1/' || page_id else '' end as doi, 'S' || page_id as pii,
  case when page_id % 2 = 0 then cast(page_id as varchar) else '' end as pmid, 'S' || page_id || '.pdf' as pdf from pages""")
oracle("artifact_scan", "select id, kind, id || suffix as file, octet_length(encode(html)) as size from (select substr(md5(cast(page_id as varchar)), 1, 12) as id, html, "
       + "case page_id % 7 " + " ".join(f"when {i} then '{k}'" for i, k in enumerate(("pdf", "pdf_tei", "json", "ref_annotations", "thumb_small", "nxml", "jats_tei")))
       + " end as kind, case page_id % 7 " + " ".join(f"when {i} then '{ARTIFACT_SUFFIXES[k]}'" for i, k in enumerate(("pdf", "pdf_tei", "json", "ref_annotations", "thumb_small", "nxml", "jats_tei")))
       + " end as suffix from pages) x")
_KINDS = ("pdf", "pdf_tei", "json", "ref_annotations", "thumb_small", "nxml", "jats_tei")
_PAGE_KIND = "case page_id % 7 " + " ".join(f"when {i} then '{k}'" for i, k in enumerate(_KINDS)) + " end"
oracle("artifact_validity", f"""
select id, kind, cast(case when page_id % 3 = 0 then case when page_id % 2 = 0 then n else 0 end
  when kind = 'pdf' then 9 + n when kind = 'thumb_small' then 8 + n when kind in ('json', 'ref_annotations')
  then 3 + 300 * length(cast(page_id as varchar)) + case when page_id % 4 <> 0 then 1 else 0 end else 23 + n end as bigint) as size,
  page_id % 3 <> 0 and (kind not in ('json', 'ref_annotations') or page_id % 4 <> 0) as valid
from (select page_id, octet_length(encode(html)) as n, substr(md5(cast(page_id as varchar)), 1, 12) as id, {_PAGE_KIND} as kind from pages) x""")
oracle("official_scan", """
select case when page_id % 2 = 0 then 'pmc' else 'pdf' end as kind,
  case when page_id % 2 = 0 then 'PMC' || page_id else md5(cast(page_id as varchar)) end as key from pages""")
_ARCHIVES = """
select 'a' || page_id as id, case when page_id % 11 <> 0 and page_id % 5 <> 0 then 'p/one.PDF' end as pdf_name,
  case when page_id % 11 <> 0 and page_id % 5 <> 0 then md5('%PDF-1.7 ' || html) end as pdf_md5,
  case when page_id % 11 <> 0 and page_id % 3 <> 0 then 'n/last.nxml' end as nxml_name,
  case when page_id % 11 <> 0 and page_id % 3 <> 0 then md5(html) end as nxml_md5,
  page_id % 11 = 0 or page_id % 5 = 0 as no_pdf, page_id % 11 = 0 as failed from pages"""
oracle("extract_archives", _ARCHIVES)
oracle("archive_files", _ARCHIVES)
_KEY = f"{_path('id')} || id"
oracle("archives_to_tree", f"""
select id, 'pdf' as kind, {_KEY} || '.pdf' as path, cast(9 + n as bigint) as size, md5('%PDF-1.7 ' || html) as md5, null as error from packed
where page_id % 11 <> 0 and page_id % 5 <> 0
union all select id, 'nxml', {_KEY} || '.nxml', n, md5(html), null from packed where page_id % 11 <> 0 and page_id % 3 <> 0
union all select id, 'pdf', null, null, null, 'no pdf' from packed where page_id % 11 <> 0 and page_id % 5 = 0
union all select id, null, null, null, null, 'ReadError' from packed where page_id % 11 = 0""",
       {"packed": "select 'a' || page_id as id, page_id, html, octet_length(encode(html)) as n from pages"})
oracle("place_files", f"""
select id, kind, {_KEY} || suffix as path, n as size, n as size_there, null as error from placed
union all select id, 'nxml', null, null, null, 'gone' from placed where kind = 'pdf'""",
       {"placed": f"""select *, case kind {" ".join(f"when '{k}' then '{x}'" for k, x in ARTIFACT_SUFFIXES.items())} end as suffix
from (select octet_length(encode(html)) as n, substr(md5(cast(page_id as varchar)), 1, 12) as id, {_PAGE_KIND} as kind from pages) x"""})
oracle("decompress", """
select page_id as id, case when page_id % 3 <> 1 then md5(html) end as payload_md5, page_id % 3 <> 1 as usable from pages""")
oracle("convert_files", f"""
select id, {_path('id')} || id || '{ARTIFACT_SUFFIXES["jats_tei"]}' as target, content_md5
from (select 'd' || page_id as id, md5('<tei>' || html || '</tei>') as content_md5 from pages) x where length(id || '.nxml') % 5 <> 0""")
_RECORD = "doi, pmid, pmcid, istexid, pii, oa_link, title, year"
oracle("biblio_files", f"select {_RECORD}, title as reference from fx_biblio union all select {_RECORD}, null from fx_biblio")
oracle("location_files", f"""
select '10.1/x' || page_id as doi, case when page_id % 7 = 0 then null
  when page_id % 5 = 0 then '{PMC_WEB_BASE}PMC' || page_id || '/pdf/'
  when page_id % 5 = 1 then url || '.pdf'
  when page_id % 4 = 0 then '{PMC_WEB_BASE}PMC' || page_id || '/pdf/'
  when page_id % 3 = 0 then url || '?format=pdf' end as url from pages""")

# Streams
oracle("stream_first_seen", "select distinct cord_uid from fx_meta")
oracle("stream_waterfall", f"""
select n as n_total, n as n_invalid_url, n as n_invalid_pdf, n as n_invalid_tei, cast(0 as bigint) as n_fully_valid,
  cast(0 as bigint) as n_valid_url, cast(0 as bigint) as n_valid_pdf, cast(0 as bigint) as n_valid_tei, 0 as batch
from (select count(*) as n from fx_entries) x
union all select *, 1 from waterfall union all select *, 2 from waterfall""", {"waterfall": _WATERFALL})
oracle("stream_entries", f"select id, doi, oa_link, {', '.join(FLAGS)} from fx_entries")
