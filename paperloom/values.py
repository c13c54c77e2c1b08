"""Names and patterns that inputs and outputs of the pipeline must carry."""

# Suffix of each file kept for an article (fixed values).
ARTIFACT_SUFFIXES = {
    "pdf": ".pdf",
    "nxml": ".nxml",
    "nlm": ".nlm",
    "pdf_tei": ".grobid.tei.xml",
    "jats_tei": ".pub2tei.tei.xml",
    "json": ".json",
    "ref_annotations": "-ref-annotations.json",
    "thumb_small": "-thumb-small.png",
    "thumb_medium": "-thumb-medium.png",
    "thumb_large": "-thumb-large.png",
}

# Endings that the external JATS converter gives its outputs (fixed values).
CONVERTED_SUFFIXES = (".nxml.xml", ".nxml", ".nlm")

# Resolver prefixes that are removed from a DOI (fixed values).
DOI_PREFIXES = ("https://doi.org/", "http://dx.doi.org/")

# Public addresses of the PubMed Central archive (fixed values).
PMC_ARCHIVE_BASE = "ftp://ftp.ncbi.nlm.nih.gov/pub/pmc/"
PMC_WEB_BASE = "https://www.ncbi.nlm.nih.gov/pmc/articles/"
PMC_PDF_MARKS = ("europepmc.org/articles/pmc", "ncbi.nlm.nih.gov/pmc/articles")

# Columns of a metadata release (fixed values).
RELEASE_COLUMNS = (
    "cord_uid", "sha", "source_x", "title", "doi", "pmcid", "pubmed_id", "license",
    "abstract", "publish_time", "authors", "journal", "mag_id", "who_covidence_id",
    "arxiv_id", "url",
)

# Entry column to key in the JSON form of an entry, where they differ (fixed values).
ENTRY_JSON_NAMES = {
    "doi": "DOI",
    "license_simplified": "license-simplified",
    "mag_id": "MAG_ID",
    "who_covidence": "WHO_Covidence",
    "oa_link": "oaLink",
}

# State flags of an entry, each false until proven (fixed values).
FLAGS = (
    "has_valid_oa_url", "has_valid_pdf", "has_valid_tei",
    "has_valid_ref_annotation", "has_valid_thumbnail",
)

# Headers of the exported lists (fixed values).
MISSED_COLUMNS = ("cord_uid", "url")
EXTRA_COLUMNS = ("cord_uid", "doi", "pmc", "pmid", "path_grobid", "path_pub2tei")
PUB_MAP_COLUMNS = ("doi", "pii", "pmid", "pdf")

# Transport order by kind of address (fixed values).
FTP_TRANSPORTS = ("wget", "ftp", "session", "plain")
WEB_TRANSPORTS = ("session", "plain", "wget")
