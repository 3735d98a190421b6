"""Sources: producer dimension (A1-A5), request planning (A6-A9), landed documents."""

from cropwire.sources.dimension import (
    lookup_producers, producer_dimension, producer_ids,
    producers_exist, unknown_producers,
)
from cropwire.sources.documents import (
    Landed, exact_path, land_documents, landed_files, scan_documents, scan_landed, status_fault, status_gate,
)
from cropwire.sources.requests import climate_request_manifest, market_request_manifest, symbol_list

__all__ = [
    "lookup_producers", "producer_dimension", "producer_ids",
    "producers_exist", "unknown_producers", "Landed", "exact_path", "land_documents",
    "landed_files", "scan_documents", "scan_landed", "status_fault",
    "status_gate", "climate_request_manifest", "market_request_manifest", "symbol_list",
]
