from paperloom.plans.ingest import (
    Ingested, Snapshots, ingest_ids, ingest_release, keep_snapshots, reprocess_failed, sample,
)
from paperloom.plans.links import resolve_oa_link

__all__ = [
    "Ingested", "Snapshots", "ingest_ids", "ingest_release", "keep_snapshots", "reprocess_failed", "resolve_oa_link",
    "sample",
]
