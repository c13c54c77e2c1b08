from paperloom.streaming.releases import (
    flag_changes, release_files, release_rows, stream_entries, stream_first_seen, stream_releases, stream_waterfall,
)

__all__ = [
    "flag_changes", "release_files", "release_rows", "stream_entries", "stream_first_seen", "stream_releases",
    "stream_waterfall",
]
