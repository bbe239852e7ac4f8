"""

``COVERAGE`` maps an inventory id to the registered queries exercising it.
``TESTED`` names ids (also) covered by unit tests, ``NOT_RUN`` the ones
implemented but not executable here. ``tests/test_inventory.py`` parses §2 and
fails on any id missing from all three.
"""

from __future__ import annotations

COVERAGE: dict[str, tuple[str, ...]] = {
    # sources and sinks
    "A1": ("synthetic_contract", "synthetic_readings", "synthetic_profile"),
    "A1a": ("synthetic_contract", "synthetic_distribution"), "A1b": ("synthetic_contract", "synthetic_distribution"), "A1c": ("synthetic_contract",),
    "A1d": ("synthetic_contract",), "A1e": ("synthetic_contract",), "A1f": ("synthetic_contract", "synthetic_distribution"),
    "A2": ("events_scan",),
    "A3": ("bars_read_back", "bars_read_back_whole"),
    "A5": ("dataset_read_back",),
    "A9": ("chain_outputs", "chain_window", "chain_aggregate", "chain_pivot", "chain_unpivot", "chain_date_parts", "rebuilt_bars", "rebuild_runs"),
    "A7": ("upsert_actions", "upsert_snapshot", "upsert_report", "upsert_rerun_report", "upsert_report_small_batch",
           "upsert_partial_snapshot", "upsert_partial_report"),
    "A8": ("renamed_for_table",),
    "A10": ("stale_inputs",),
    "A11": ("fingerprint", "changed_inputs", "rebuild_plan", "rebuilt_bars"),
    "A12": ("guarded_write_report", "guarded_table", "guarded_quarantine", "constraints_readings", "constraints_location_stats", "constraints_on_broken_readings"),
    "A13": ("bars_clean",),
    "A14": ("preview_readings",),
    # projections, filters, predicates
    "B1": ("bars_normalized", "renamed_for_table"),
    "B2": ("bars_rule_filters", "bars_annotated"),
    "B3": ("bars_rule_filters",), "B4": ("bars_rule_filters",), "B5": ("bars_rule_filters",),
    "B6": ("bars_repair_report", "bars_annotated", "bars_clean"),
    "B7": ("optional_filters", "readings_page_filtered"),
    "B8": ("search_ids", "search_ids_indexed", "search_ids_short_fragment"),
    "B9": ("sensor_summary", "sensor_parameter_summary", "readings_page", "sensor_lookup_clustered"),
    "B10": ("dashboard_filter",),
    "B11": ("unpivot_values",),
    "B12": ("reading_flags", "sensor_warnings"),
    "B13": ("row_validation_broken", "row_validation"),
    "B14": ("location_choices", "location_filter"),
    "B15": ("reading_projection",),
    "B16": ("location_profile",),
    # joins
    "C1": ("reconcile_broken_summary", "check_summary",),
    "C2": ("table_counts", "table_health"),
    "C3": ("upsert_actions",),
    "C4": ("stale_inputs",),
    "C5": ("existence_probe",),
    "C6": ("missing_inputs",),
    "C8": ("location_profile", "series_features"),
    # aggregations
    "D1": ("profile_null_keys", "location_profile", "location_profile_approx_sensors"),
    "D1a": ("location_profile",), "D1b": ("approx_sensors_in_band", "sensors_over_time", "location_profile_approx_sensors"), "D1c": ("location_profile",),
    "D1d": ("location_profile",), "D1e": ("location_profile", "location_profile_exact_quantiles"),
    "D1f": ("location_profile",),
    "D1g": ("location_profile",), "D1h": ("location_profile",),
    "D2": ("conditional_counts",),
    "D3": ("sensor_summary", "sensor_summaries", "sensor_summary_clustered"),
    "D4": ("sensor_parameter_summary", "sensor_parameter_summaries"),
    "D5": ("arrival_summary",),
    "D6": ("parameter_shape",),
    "D7": ("sequence_completeness",),
    "D8": ("dependency_violations",),
    "D9": ("sensor_document_lines", "sensor_documents"),
    "D10": ("table_health",),
    "D11": ("return_distribution", "return_distribution_exact"),
    "D12": ("scoreboard",),
    "D13": ("upsert_report", "upsert_rerun_report"),
    # windows
    "E1": ("series_features_routed", "series_features"), "E2": ("previous_value", "series_features"), "E3": ("series_features_routed", "series_features"),
    "E4": ("series_features_routed", "series_features", "check_rolling"), "E5": ("series_features_routed", "series_features"), "E6": ("series_features_routed", "series_features"),
    "E7": ("ticker_metrics",), "E8": ("ticker_metrics",), "E9": ("ticker_metrics",), "E10": ("ticker_metrics",),
    "E11": ("search_ids", "page_envelope"),
    "E12": ("window_consistency", "check_window"),
    # sorts, limits, top-k
    "F1": ("bars_keep_last",),
    "F2": ("readings_page_after", "readings_page", "readings_page_filtered", "readings_page_all_sensors"),
    "F3": ("page_envelope",),
    "F4": ("search_ids", "search_envelope_text", "search_envelope"),
    "F5": ("bars_chronological",),
    "F6": ("location_table",),
    # set operations and reshape
    "G1": ("sensor_ids",),
    "G2": ("bars_stacked",),
    "G3": ("pivot_mean",),
    "G4": ("unpivot_values",),
    # data-quality checks
    "K1": ("check_arrival", "checks_on_broken_readings", "sensor_checks"),
    "K2": ("check_summary", "sensor_checks"),
    "K3": ("check_window", "sensor_checks"),
    "K4": ("check_positions", "sensor_checks"),
    "K5": ("check_rolling", "sensor_checks"),
    "K6": ("check_one_location", "checks_on_broken_readings", "sensor_checks"),
    "K7": ("parameter_shape",),
    "K8": ("bars_validation", "bars_validation_raw", "check_bars"),
    "K9": ("constraints_readings", "constraints_location_stats", "constraints_on_broken_readings"),
    "K10": ("checks_that_raise",),
}

TESTED: dict[str, str] = {
    "A1": "tests/test_synth.py (balls-in-bins counts, bad rate, moments, ids, partitioning)",
    "A3": "tests/test_io.py::test_scan_bars_takes_ticker_from_partition",
    "A5": "tests/test_io.py::test_write_dataset_reports_rows",
    "A7": "tests/test_merge.py (fixture counts, idempotence, NULL equality, duplicate key error); "
          "tests/test_io.py::test_bars_chain_twice_changes_nothing (versioned snapshots)",
    "A9": "tests/test_io.py (five outputs, isolation, the verifying job)",
    "A13": "tests/test_io.py::test_conform_orders_casts_and_names_missing",
    "B6": "tests/test_bars.py (reference cases, fixture rule counts)",
    "F2": "tests/test_serve.py (pages disjoint and complete, null placement)",
    "K8": "tests/test_bars.py (emptied ticker, dates out of order)",
    "K10": "tests/test_checks.py (assert_checks raises on a broken window); "
           "tests/test_io.py (both chains stop on failed checks or validation)",
}

NOT_RUN: dict[str, str] = {
    "A4": "Spark JDBC read; no database may be started in this environment",
    "A6": "Spark JDBC write; no database may be started in this environment",
}
