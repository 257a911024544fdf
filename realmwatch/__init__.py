"""Authentication-log analytics on Spark: who still depends on weak cryptography."""

from realmwatch.functions.enctypes import canonical_list, enctype_dim, extend_enctypes
from realmwatch.operators.audit import (
    duplicate_keys,
    invalid_rows,
    orphans,
    unknown_enctypes,
    valid_rows,
)
from realmwatch.operators.joins import forwarded_tgt, join_lists, join_roles
from realmwatch.operators.last_seen import (
    ccs_last_seen,
    client_last_fail,
    client_last_seen,
    princ_client_fail,
    princ_client_success,
    princ_last_seen,
    princ_server_fail,
    princ_server_success,
)
from realmwatch.operators.lists import discover_lists, list_flags, list_members, list_sequence
from realmwatch.operators.merge import upsert
from realmwatch.operators.slices import (
    ccs_slices,
    client_slices,
    princ_fail_slices,
    princ_slices,
    prune,
    slice_rates,
    ticket_slices,
)
from realmwatch.operators.trends import period_averages, running_averages
from realmwatch.plans.batch import run_batch
from realmwatch.plans.store import SummaryStore
from realmwatch.plans.views import attach, register_views
from realmwatch.sources.growing import scan_growing
from realmwatch.sources.logs import drop_local_tgt, kdc_lines, scan_logs, scan_stream
from realmwatch.sources.parser import parse_events, parse_logs
from realmwatch.sources.tables import read_logs, union_logs, write_events
from realmwatch.streaming.incremental import catch_up, native_client_slices, parse_stream, run_incremental

