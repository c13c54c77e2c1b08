from paperloom.sinks.exports import (
    catalogue, collection_description, dump_metadata, ordered_output, place_artifacts, write_catalogue,
    write_collection, write_csv, write_dump, write_extra, write_missed, write_payloads, write_pub_map,
)
from paperloom.sinks.index import write_biblio_index
from paperloom.sinks.placing import archives_to_tree, place_files, place_found
from paperloom.sinks.state import StateConflict, compact_state, reset_state, write_state

__all__ = [
    "StateConflict", "archives_to_tree", "catalogue", "collection_description", "compact_state", "dump_metadata", "ordered_output", "place_artifacts",
    "place_files", "place_found",
    "reset_state", "write_biblio_index", "write_catalogue", "write_collection", "write_csv", "write_dump", "write_extra",
    "write_missed", "write_payloads", "write_pub_map", "write_state",
]
