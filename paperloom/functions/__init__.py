from paperloom.functions.content import CONTENT_KINDS, content_kind, is_valid, judge_artifacts, redirect_link
from paperloom.functions.identifiers import (
    artifact_name, artifact_parts, clean_doi, doi_key, present, publish_year,
    stable_id, storage_path, strip,
)
from paperloom.functions.records import canonical_json, init_flags, prune_record
from paperloom.functions.urls import (
    contains_any, fetch_target, join_url, target_key, transport_order, url_class, url_host,
)

__all__ = [
    "CONTENT_KINDS", "artifact_name", "artifact_parts", "canonical_json", "clean_doi", "contains_any",
    "content_kind", "doi_key", "fetch_target", "init_flags", "is_valid", "join_url", "judge_artifacts",
    "present", "prune_record", "publish_year", "redirect_link", "stable_id",
    "storage_path", "strip", "target_key", "transport_order", "url_class", "url_host",
]
