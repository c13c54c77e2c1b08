"""Test inputs derived from the given tables, one SQL text for both engines.

`{S}` is the string type of the engine. Every view covers every row of its table and keeps
texts whole; what is absent is a blank value, another kind of file, or a number outside the
range of the other views, never a row that was filtered out.
"""

from collections.abc import Callable
from functools import cache

from pyspark.sql import DataFrame

from paperloom.values import ARTIFACT_SUFFIXES

PUB_BASE = "/shared/publisher"
LEGACY_ROOT = "/shared/older"

_DOI = "concat('10.', cast(1000 + {n} % 37 as {{S}}), '/art.', cast({n} as {{S}}))"
_ID = "substr(md5(cast({n} as {{S}})), 1, 12)"


def _doi(n: str) -> str:
    return _DOI.format(n=n)


def _id(n: str) -> str:
    return _ID.format(n=n)


_META = f"""
select row_no, cord_uid, sha, source_x, title,
  case when row_no % 4 = 3 then '' else concat(
    case row_no % 3 when 0 then 'https://doi.org/' when 1 then 'http://dx.doi.org/' else '' end,
    '10.', cast(1000 + k % 37 as {{S}}),
    case when row_no % 5 = 0 then '/ART.' else '/art.' end, cast(k as {{S}})) end as doi,
  pmcid, pubmed_id, license, abstract, publish_time, url
from (
  select doc_id as row_no,
    case when doc_id % 20 = 9 then doc_id - 5 when doc_id % 20 = 18 then doc_id - 1 else doc_id end as k,
    substr(md5(cast(case when doc_id % 20 = 17 then doc_id - 5 else doc_id end as {{S}})), 1, 12) as cord_uid,
    case when doc_id % 3 = 0 then md5(concat('pdf', cast(doc_id as {{S}}))) else '' end as sha,
    source as source_x, concat('Study ', cast(doc_id as {{S}}), ' from ', source, ' (', lang, ')') as title,
    case when doc_id % 3 <> 1 then concat('PMC', cast(5000000 + doc_id as {{S}})) else '' end as pmcid,
    case when doc_id % 5 <> 2 then cast(20000000 + doc_id as {{S}}) else '' end as pubmed_id,
    case doc_id % 4 when 0 then 'cc-by' when 1 then 'no-cc' when 2 then 'els-covid' else '' end as license,
    case when doc_id % 6 <> 0 then text else '' end as abstract,
    case when doc_id % 8 = 0 then cast(2000 + doc_id % 21 as {{S}}) when doc_id % 8 = 1 then ''
      else concat(cast(2000 + doc_id % 21 as {{S}}), '-', lpad(cast(1 + doc_id % 12 as {{S}}), 2, '0'), '-15') end as publish_time,
    concat('https://example.org/a/', cast(doc_id as {{S}})) as url
  from documents) x"""

_PMC_OA = """
select line_no,
  concat('oa_package/', substr(md5(cast(line_no as {S})), 1, 2), '/', substr(md5(cast(line_no as {S})), 3, 2),
    '/PMC', cast(5000000 + n as {S}), '.tar.gz') as subpath,
  concat('PMC', cast(5000000 + n as {S})) as pmcid,
  concat('PMID:', cast(20000000 + n as {S})) as pmid,
  case o_orderstatus when 'F' then 'CC BY' when 'O' then 'CC BY-NC' else 'NO-CC CODE' end as license
from (select o_orderkey as line_no, o_orderkey - o_orderkey % 3 as n, o_orderstatus from orders) x"""

_PUB_MAP = """
select p_partkey as line_no,
  case when p_partkey % 7 = 0 then '' else
    concat('10.', cast(1000 + n % 37 as {S}), '/ART.', cast(n as {S})) end as doi,
  concat('S', lpad(cast(n as {S}), 8, '0')) as pii,
  cast(20000000 + p_partkey as {S}) as pmid,
  concat('S', lpad(cast(p_partkey as {S}), 8, '0'), '.pdf') as pdf
from (select p_partkey, p_partkey - p_partkey % 8 as n from part) x"""

_PUB_FILES = """
select concat('S', lpad(cast(p_partkey as {S}), 8, '0'), '.pdf',
  case when p_partkey % 48 >= 40 then '.part' else '' end) as pdf
from part"""

_OA_LOC = f"""
select {_doi('n')} as doi, cast(page_id % 3 as int) as pos,
  (page_id % 3 = 0 and page_id % 9 <> 3) as is_best,
  case when page_id % 5 = 0 then concat('https://www.ncbi.nlm.nih.gov/pmc/articles/PMC', cast(5000000 + page_id as {{S}})) else url end as url,
  case when page_id % 4 = 0 then null
    when page_id % 7 = 0 then concat('https://europepmc.org/articles/pmc', cast(5000000 + page_id as {{S}}), '?pdf=render')
    else concat(url, '.pdf') end as url_for_pdf
from (select page_id, url, page_id - page_id % 3 as n from pages) x"""

# Records cover the numbers that are not 2 modulo 3, beyond the range of the release too.
_BIBLIO = f"""
select n as rec_id,
  case when n % 2 = 0 then {_doi('n')} end as doi,
  case when n % 5 <> 3 then cast(20000000 + n as {{S}}) end as pmid,
  case when n % 7 <> 0 then concat('PMC', cast(5000000 + n as {{S}})) end as pmcid,
  substr(md5(concat('istex', cast(n as {{S}}))), 1, 12) as istexid,
  concat('Record ', cast(n as {{S}}), ' of ', source) as title, cast(2000 + n % 21 as {{S}}) as year,
  concat('S', lpad(cast(n as {{S}}), 8, '0')) as pii,
  case when n % 11 = 0 then concat('https://example.org/oa/', cast(n as {{S}})) end as oa_link
from (select doc_id + cast((doc_id - doc_id % 2) / 2 as bigint) as n, source from documents) x"""

# Half of the numbers that the records leave out.
_CROSSREF = f"""
select n as rec_id, {_doi('n')} as doi, concat('Deposit ', cast(n as {{S}}), ' by ', source) as title,
  concat('ref-', cast(n as {{S}})) as reference
from (select 6 * doc_id + 2 as n, source from documents) x"""

# Entries have even numbers, half of them outside the release.
_ENTRIES = f"""
select {_id('n')} as id,
  case when n % 7 <> 3 then {_doi('n')} end as doi,
  case when n % 5 <> 2 then cast(20000000 + n as {{S}}) end as pmid,
  case when n % 4 <> 2 then concat('PMC', cast(5000000 + n as {{S}})) end as pmcid,
  concat('S', lpad(cast(n as {{S}}), 8, '0')) as pii,
  case when n % 10 <> 0 then concat('https://example.org/oa/', cast(n as {{S}})) end as oa_link,
  n % 10 <> 0 as has_valid_oa_url, n % 6 <> 0 as has_valid_pdf, n % 14 <> 0 as has_valid_tei,
  n % 4 = 0 as has_valid_thumbnail, n % 8 = 0 as has_valid_ref_annotation
from (select 2 * doc_id as n from documents) x"""

# The keys of the entries, and of articles that never got an entry.
_ID_MAP = f"""
select kind, key, id from (
  select 'id' as kind, id as key, id from ({_ENTRIES}) e1
  union all select 'doi', doi, id from ({_ENTRIES}) e2
  union all select 'pmid', pmid, id from ({_ENTRIES}) e3
  union all select 'pmcid', pmcid, id from ({_ENTRIES}) e4
  union all select 'id', {_id('m')}, {_id('m')} from (select 50 * doc_id + 1 as m from documents) d1
  union all select 'doi', {_doi('m')}, {_id('m')} from (select 50 * doc_id + 1 as m from documents) d2
) k where key is not null"""

_ARTICLES = f"""(select {_id('2 * doc_id')} as u, 2 * doc_id as n,
    case when doc_id % 13 = 5 then 0 else n_chars end as size from documents)"""
_X = ARTIFACT_SUFFIXES

# Six files per article; which kinds they are differs from article to article.
_FILES = f"""
select concat(folder, substr(u,1,2), '/', substr(u,3,2), '/', substr(u,5,2), '/', substr(u,7,2), '/', u, '/', u, ext) as path, size,
  case when size = 0 then '' when n % 11 = 3 or n % 22 = 10 then hex('<html>moved</html>')
    when ext like '%.pdf' then hex(concat('%PDF-1.5 ', u)) when ext like '%.png' then concat('89504E470D0A1A0A', hex(u))
    when ext like '%.json' then hex(concat('["', u, case when n % 13 = 4 then '"' else '"]' end))
    else hex(concat('<?xml version="1.0"?><article>', u, '</article>')) end as head_hex
from (
  select '' as folder, u, n, '{_X["json"]}' as ext, size from {_ARTICLES} d1
  union all select '', u, n, case when n % 3 <> 0 then '{_X["pdf"]}' else '{_X["thumb_small"]}' end, size from {_ARTICLES} d2
  union all select '', u, n, case when n % 3 = 1 then '{_X["pdf_tei"]}' else '{_X["ref_annotations"]}' end, size from {_ARTICLES} d3
  union all select '', u, n, case when n % 10 = 0 then '{_X["nxml"]}' else '{_X["thumb_medium"]}' end, size from {_ARTICLES} d4
  union all select '', u, n, case when n % 10 = 0 and n % 50 <> 0 then '{_X["jats_tei"]}' else '{_X["thumb_large"]}' end, size from {_ARTICLES} d5
  union all select 'copies/', u, n, case when n % 20 = 0 then '{_X["nxml"]}' when n % 20 = 4 then '{_X["nlm"]}' else '.txt' end, size from {_ARTICLES} d6) x"""

_OFFICIAL = """
select concat('document_parses/pmc_json/PMC', cast(5000000 + 4 * doc_id as {S}), '.xml.json') as path from documents
union all
select concat('document_parses/pdf_json/', md5(concat('pdf', cast(6 * doc_id as {S}))), '.json') from documents"""

_ATTEMPTS = f"""
select {_id('event_id - event_id % 4')} as id, cast(event_id % 4 as int) as attempt_no,
  case event_id % 4 when 0 then 'session' when 1 then 'plain' when 2 then 'wget' else 'ftp' end as transport,
  event_type in ('click', 'purchase') as ok
from events"""

_MEMBERS = """
select user_id as archive_id, event_id as member_no,
  concat('pkg', cast(user_id as {S}), '/m', cast(event_id as {S}),
    case when user_id % 10 = 0 and event_type in ('click', 'view') then '.jpg' when user_id % 10 = 1 and event_type = 'signup' then '.txt'
      when event_type = 'click' then '.pdf' when event_type = 'view' then '.PDF' when event_type = 'signup' then '.nxml' else '.jpg' end) as name,
  event_id % 9 <> 0 as is_file
from events"""

# Payloads as hexadecimal text, which both engines build alike.
_PAYLOADS = f"""
select {_id('4 * page_id')} as id, url,
  case page_id % 8 when 0 then hex(concat('<html><body><a href="/x">no</a><a class="b" id="redirect" href="', replace(url, '&', '&amp;'), '">go</a>', html, '</body></html>'))
    when 1 then hex(concat('%PDF-1.7 ', html))
    when 2 then concat('EFBBBF0A20', hex(concat('<?xml version="1.0"?><article>', html, '</article>')))
    when 3 then ''
    when 4 then hex(concat('["', url, '", ', cast(page_id as {{S}}), ']'))
    when 5 then concat('1F8B0800', hex(html))
    when 6 then concat('89504E470D0A1A0A', hex(html))
    else hex(html) end as payload_hex
from pages"""

# Pages that lead to one another in blocks of 16: two short ways to a PDF, one that is too long from its
# first pages, two pages that name each other, an end, an address that nobody has fetched.
_HOPS = """
select concat('https://r.example/p?v=1&k=', cast(k as {S})) as url,
  case when k % 16 in (3, 11) then hex(concat('%PDF-1.4 ', html)) when k % 16 = 14 then hex(concat('<html>', html, '</html>'))
    else hex(concat('<a id="redirect" href="https://r.example/p?v=1&amp;k=',
      case when k % 16 = 13 then cast(k - 1 as {S}) when k % 16 = 15 then concat('x', cast(k as {S})) else cast(k + 1 as {S}) end, '">go</a>')) end as payload_hex
from (select page_id as k, html from pages) x"""

# Addresses to fetch: a third of the articles share one, others lead beyond the pages.
_STARTS = f"""
select {_id('2 * doc_id')} as id, concat('https://r.example/p?v=1&k=',
  cast(case when doc_id % 3 = 0 then 4 else doc_id end as {{S}})) as url
from documents"""

VIEWS = {
    "fx_meta": _META,
    "fx_pmc_oa": _PMC_OA,
    "fx_pub_map": _PUB_MAP,
    "fx_pub_files": _PUB_FILES,
    "fx_oa_loc": _OA_LOC,
    "fx_biblio": _BIBLIO,
    "fx_crossref": _CROSSREF,
    "fx_entries": _ENTRIES,
    "fx_id_map": _ID_MAP,
    "fx_files": _FILES,
    "fx_official": _OFFICIAL,
    "fx_attempts": _ATTEMPTS,
    "fx_members": _MEMBERS,
    "fx_payloads": _PAYLOADS,
    "fx_hops": _HOPS,
    "fx_starts": _STARTS,
}

# The columns the views use, declared so that no query has to look into the files first.
TABLES = {
    "documents": "doc_id long, text string, lang string, source string, n_chars long",
    "orders": "o_orderkey long, o_orderstatus string",
    "part": "p_partkey long",
    "pages": "page_id long, url string, html string",
    "events": "event_id long, user_id long, event_type string",
}


@cache
def _text(name: str, string_type: str) -> str:
    return VIEWS[name].replace("{S}", string_type)


def duckdb_text(name: str) -> str:
    return _text(name, "varchar")


def view(name: str, table: Callable[[str], DataFrame]) -> DataFrame:
    """The view as a DataFrame over the tables that `table` gives by name."""
    text = _text(name, "string")
    used = {t: table(t) for t in TABLES if f"from {t}" in text}
    for t in used:
        text = text.replace(f"from {t}", f"from {{{t}}}")
    return next(iter(used.values())).sparkSession.sql(text, **used)
