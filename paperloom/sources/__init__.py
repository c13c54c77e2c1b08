from paperloom.sources.index import read_biblio_index
from paperloom.sources.listings import (
    index_official, list_files, read_content, read_heads, scan_archives, scan_artifacts, scan_judged, scan_official,
)
from paperloom.sources.lists import id_list_size, read_id_list
from paperloom.sources.releases import read_release, shape_release
from paperloom.sources.snapshots import (
    index_pmc_oa, index_pub_map, read_biblio, read_fallback, read_locations, read_pmc_oa,
    read_pmc_oa_errors, read_record_errors,
    read_pub_map, read_publisher_meta,
)
from paperloom.sources.state import is_taken, read_all_commits, read_commits, read_errors, read_state

__all__ = [
    "id_list_size", "index_official", "is_taken", "index_pmc_oa", "index_pub_map", "list_files", "read_biblio", "read_biblio_index",
    "read_all_commits", "read_commits", "read_errors", "read_content", "read_fallback", "read_heads", "read_id_list", "read_locations", "read_pmc_oa",
    "read_pmc_oa_errors", "read_record_errors",
    "read_pub_map", "read_publisher_meta", "read_release", "read_state", "scan_archives",
    "scan_artifacts", "scan_judged", "scan_official", "shape_release",
]
