"""DataFrame operators for data integration: change trails, documents, lookups, state."""

from .operators.cdc import apply_changes, count_replaced, merge_views, parse_trail, route_changes, trail_statements
from .operators.cells import cell_by_filter, cell_value, lookup_cells, scan, scan_cells, to_cells, truncate_cells
from .operators.columns import columns_to_json, content_to_column, map_to_json, update_columns
from .operators.enrich import enrich
from .operators.jsonops import json_to_csv, json_to_rows
from .operators.kv import (
    duplicate_keys,
    kv_check_and_put,
    kv_contains,
    kv_get,
    kv_get_and_put_if_absent,
    kv_put,
    kv_put_if_absent,
    kv_put_if_absent_results,
    kv_remove,
    kv_remove_results,
)
from .operators.sequence import assign_sequence, fragment_id, number_fragments, sequence_after
from .operators.state import check_state, check_state_after, hold_release, hold_release_after
from .operators.xmlops import extract_xml, validate_xml, xml_to_rows
from .routes import split_routes
from .session import configure
from .sources.files import read_files, stream_files
from .sources.sql import query_rows, read_jdbc, run_statements, sql_rows, sql_scalar, sql_to_kv, truncate_tables

__all__ = [name for name in dir() if not name.startswith("_") and name not in ("operators", "routes", "session", "sources", "functions", "plans")]
