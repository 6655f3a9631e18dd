"""Positional event logs on Spark: parse, check, profile, reconcile."""

from linewright.functions.linehash import with_line_hash
from linewright.operators.combatant import parse_combatants
from linewright.operators.header import parse_header
from linewright.operators.payloads import parse_events, payload
from linewright.operators.profile import event_profile
from linewright.operators.quality import (
    accepted_events,
    apply_quarantine,
    error_rollup,
    file_status,
    file_summary,
    parse_warnings,
    quality_tables,
    rejections,
    run_summary,
    seen_lines,
    skipped_lines,
    warning_lines,
    warning_occurrence,
    with_line_numbers,
)
from linewright.operators.reconcile import differing_days, reconcile, reconcile_by_digest, reconcile_summary
from linewright.operators.routes import RouteRegistry, route_events
from linewright.operators.specs import Field
from linewright.plans.convert import convert, convert_once
from linewright.sources.events import event_json, read_events, timestamps, typed_events, write_events
from linewright.sources.keys import (
    compact_manifest,
    list_keys,
    new_keys,
    read_listing,
    read_manifest,
    update_manifest,
)
from linewright.sources.lines import lines_of_texts, list_files, read_lines, smallest_files
from linewright.sources.pages import extract_page_attributes
from linewright.sources.published import publish, read_index, read_published
from linewright.streaming.logs import (
    read_gated,
    read_profile,
    read_verdicts,
    start_gated,
    start_profile,
    start_verdicts,
    stream_events,
    stream_lines,
    stream_profile,
)

__all__ = [name for name in dir() if not name.startswith("_")]
