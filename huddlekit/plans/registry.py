"""Registered queries and their DuckDB oracle SQL."""
from __future__ import annotations

from huddlekit.plans import checks, landing, layouts, loads, players, scheme, season_loads, streams

QUERIES = {
    "team_week_fingerprint": scheme.team_week_fingerprint_q,
    "weekly_position_rank": players.weekly_position_rank,
    "points_weekly": players.points_weekly_q,
    "unpivot_sides": layouts.unpivot_sides_q,
    "two_era_reconcile": layouts.two_era_reconcile,
    "resolve_exact_id": players.resolve_exact_id,
    "resolve_by_name_refusing": players.resolve_by_name_refusing,
    "resolve_mixed": players.resolve_mixed,
    "personnel_modern": layouts.personnel_modern,
    "personnel_legacy": layouts.personnel_legacy,
    "personnel_dispatch": layouts.personnel_dispatch,
    "page_fields": layouts.page_fields,
    "coordinators_written": layouts.coordinators_written,
    "key_from_id": layouts.key_from_id,
    "conform_feed_a": landing.conform_feed_a_q,
    "conform_feed_b": landing.conform_feed_b_q,
    "upsert_result": loads.upsert_result,
    "replace_partition": loads.replace_partition,
    "upsert_written": loads.upsert_written,
    "replace_written": loads.replace_written,
    "pending_chunks": loads.pending_chunks,
    "check_resolution": checks.check_resolution,
    "check_grain": checks.check_grain,
    "check_reconcile": checks.check_reconcile,
    "check_rate_denominators": checks.check_rate_denominators,
    "check_fill_matrix": checks.check_fill_matrix,
    "check_summary": checks.check_summary,
    "drift": checks.drift,
    "tenure_stints": checks.tenure_stints,
    "before_after": checks.before_after_q,
    "play_level_join": checks.play_level_join,
    "bridge_left_join": checks.bridge_left_join,
    "stream_snapshot": streams.stream_snapshot,
    "stream_late_versions": streams.stream_late_versions,
    "adp_vs_points": checks.adp_vs_points,
    "top_weekly": players.top_weekly,
    "resolve_any_id": players.resolve_any_id,
    "refused_keys": players.refused_keys,
    "load_seasons": season_loads.load_seasons,
    "quarantined_rows": season_loads.quarantined_rows,
    "vintage_drift": season_loads.vintage_drift,
    "vintage_rows": season_loads.vintage_rows,
    "team_week_written": season_loads.team_week_written,
    "verify_stored": season_loads.verify_stored,
}

ORACLE_SQL = {
    "team_week_fingerprint": scheme.TEAM_WEEK_FINGERPRINT_SQL,
    "weekly_position_rank": players.WEEKLY_POSITION_RANK_SQL,
    "points_weekly": players.POINTS_WEEKLY_SQL,
    "unpivot_sides": layouts.UNPIVOT_SIDES_SQL,
    "two_era_reconcile": layouts.TWO_ERA_SQL,
    "resolve_exact_id": players.RESOLVE_EXACT_ID_SQL,
    "resolve_by_name_refusing": players.RESOLVE_BY_NAME_SQL,
    "resolve_mixed": players.RESOLVE_MIXED_SQL,
    "personnel_modern": layouts.PERSONNEL_MODERN_SQL,
    "personnel_legacy": layouts.PERSONNEL_LEGACY_SQL,
    "personnel_dispatch": layouts.PERSONNEL_DISPATCH_SQL,
    "page_fields": layouts.PAGE_FIELDS_SQL,
    "coordinators_written": layouts.COORDINATORS_WRITTEN_SQL,
    "key_from_id": layouts.KEY_FROM_ID_SQL,
    "conform_feed_a": landing.CONFORM_FEED_A_SQL,
    "conform_feed_b": landing.CONFORM_FEED_B_SQL,
    "upsert_result": loads.UPSERT_RESULT_SQL,
    "replace_partition": loads.REPLACE_PARTITION_SQL,
    "upsert_written": loads.UPSERT_WRITTEN_SQL,
    "replace_written": loads.REPLACE_WRITTEN_SQL,
    "pending_chunks": loads.PENDING_CHUNKS_SQL,
    "check_resolution": checks.CHECK_RESOLUTION_SQL,
    "check_grain": checks.CHECK_GRAIN_SQL,
    "check_reconcile": checks.CHECK_RECONCILE_SQL,
    "check_rate_denominators": checks.CHECK_RATE_DENOMINATORS_SQL,
    "check_fill_matrix": checks.CHECK_FILL_MATRIX_SQL,
    "check_summary": checks.CHECK_SUMMARY_SQL,
    "drift": checks.DRIFT_SQL,
    "tenure_stints": checks.TENURE_STINTS_SQL,
    "before_after": checks.BEFORE_AFTER_SQL,
    "play_level_join": checks.PLAY_LEVEL_JOIN_SQL,
    "bridge_left_join": checks.BRIDGE_LEFT_JOIN_SQL,
    "stream_snapshot": streams.STREAM_SNAPSHOT_SQL,
    "stream_late_versions": streams.STREAM_LATE_VERSIONS_SQL,
    "adp_vs_points": checks.ADP_VS_POINTS_SQL,
    "top_weekly": players.TOP_WEEKLY_SQL,
    "resolve_any_id": players.RESOLVE_ANY_ID_SQL,
    "refused_keys": players.REFUSED_KEYS_SQL,
    "load_seasons": season_loads.LOAD_SEASONS_SQL,
    "quarantined_rows": season_loads.QUARANTINED_ROWS_SQL,
    "vintage_drift": season_loads.VINTAGE_DRIFT_SQL,
    "vintage_rows": season_loads.VINTAGE_ROWS_SQL,
    "team_week_written": season_loads.TEAM_WEEK_WRITTEN_SQL,
    "verify_stored": season_loads.VERIFY_STORED_SQL,
}
