"""Explicit schemas and the fixed values that results depend on."""

from __future__ import annotations

# Fixed values -----------------------------------------------------------------

# Unit words erased from an emission text, in this order.
UNIT_WORDS = ("kg", "grams", "gram", "g", "co2eq", "co2e", "co₂eq", "co₂e", ",")

# Card keys that may hold evaluation results, first non-empty one wins.
METRIC_KEYS = ("model-index", "model_index", "eval_results", "metrics", "performance")

# Emission ranges in grams: (shard_id, lower bound, upper bound or None when open).
EMISSION_RANGES = (
    (0, 0.0, 1.0),
    (1, 1.0, 5.0),
    (2, 5.0, 10.0),
    (3, 10.0, 25.0),
    (4, 25.0, 50.0),
    (5, 50.0, 100.0),
    (6, 100.0, 250.0),
    (7, 250.0, 500.0),
    (8, 500.0, 1000.0),
    (9, 1000.0, 2500.0),
    (10, 2500.0, 5000.0),
    (11, 5000.0, 10000.0),
    (12, 10000.0, 25000.0),
    (13, 25000.0, 50000.0),
    (14, 50000.0, 100000.0),
    (15, 100000.0, 250000.0),
    (16, 250000.0, 500000.0),
    (17, 500000.0, 1000000.0),
    (18, 1000000.0, 5000000.0),
    (19, 5000000.0, None),
)

RESUMABLE_STATUSES = ("RUNNING", "FAILED", "RATE_LIMITED", "INTERRUPTED")
CLAIMABLE_STATUSES = ("PENDING", "FAILED")

CALL_BUDGET = 1000
BUDGET_WINDOW_SECONDS = 300
BATCH_ROWS = 50
FLUSH_PAGES = 5
FLUSH_ROWS = 100
DEFAULT_WAIT_SECONDS = 180

# Schemas ------------------------------------------------------------------------

RANGE_SCHEMA = "shard_id INT, min_emissions DOUBLE, max_emissions DOUBLE"

DISCOVERY_SCHEMA = (
    "model_id STRING, co2_eq_emissions DOUBLE, co2_source STRING, training_type STRING, "
    "geographical_location STRING, hardware_used STRING, created_at STRING, downloads BIGINT, "
    "likes BIGINT, library_name STRING, pipeline_tag STRING, tags STRING, snapshot_id STRING, "
    "discovered_at STRING"
)
DISCOVERY_COLUMNS = tuple(part.split()[0] for part in DISCOVERY_SCHEMA.split(", "))
# Text form of the same rows, as a header CSV carries them.
DISCOVERY_TEXT_SCHEMA = ", ".join(f"{name} STRING" for name in DISCOVERY_COLUMNS)

BRONZE_SCHEMA = (
    "run_id STRING, shard_id INT, model_id STRING, emissions_threshold_min DOUBLE, "
    "emissions_threshold_max DOUBLE, card_data_json STRING, model_raw_json STRING, "
    "co2_emissions STRING, co2_source STRING, co2_training_type STRING, "
    "co2_geographical_location STRING, co2_hardware_used STRING, status STRING, error STRING, "
    "ingested_at TIMESTAMP"
)
BRONZE_COLUMNS = tuple(part.split()[0] for part in BRONZE_SCHEMA.split(", "))

ENRICHED_SCHEMA = (
    "modelId STRING, datasets STRING, datasets_size INT, co2_eq_emissions DOUBLE, "
    "co2_reported BOOLEAN, source STRING, training_type STRING, geographical_location STRING, "
    "environment STRING, performance_metrics STRING, performance_score DOUBLE, downloads BIGINT, "
    "likes BIGINT, library_name STRING, domain STRING, size BIGINT, created_at STRING, "
    "size_efficency DOUBLE, datasets_size_efficency DOUBLE, auto BOOLEAN, run_id STRING, "
    "partition_id STRING, enriched_at STRING, model_id STRING, co2_source STRING, "
    "hardware_used STRING, pipeline_tag STRING, tags STRING, snapshot_id STRING, "
    "discovered_at STRING"
)
ENRICHED_COLUMNS = tuple(part.split()[0] for part in ENRICHED_SCHEMA.split(", "))

ERROR_SCHEMA = (
    "run_id STRING, partition_id STRING, model_id STRING, error_type STRING, "
    "error_message STRING, failed_at STRING"
)
ERROR_COLUMNS = tuple(part.split()[0] for part in ERROR_SCHEMA.split(", "))

CHUNK_SCHEMA = (
    "partition_id STRING, input_path STRING, thread_count INT, records_count BIGINT, "
    "emission_min DOUBLE, emission_max DOUBLE, status STRING"
)

# One row per work partition, from preparation to its end.
CONTROL_SCHEMA = (
    "PK STRING, SK STRING, entity_type STRING, run_id STRING, partition_id STRING, status STRING, "
    "input_path STRING, records_count BIGINT, thread_count INT, emission_min DOUBLE, emission_max DOUBLE, "
    "output_prefix STRING, results_path STRING, errors_path STRING, metrics_path STRING, "
    "success_marker_path STRING, partition_call_budget BIGINT, estimated_calls BIGINT, "
    "global_rate_limit INT, window_seconds INT, calls_per_model INT, attempts BIGINT, started_at STRING, "
    "completed_at STRING, job_name STRING, job_run_id STRING, input_count BIGINT, processed_count BIGINT, "
    "success_count BIGINT, failed_count BIGINT, skipped_count BIGINT, api_calls_count BIGINT, "
    "batches_written BIGINT, last_batch_path STRING, last_error_type STRING, last_error_message STRING, "
    "created_at STRING, updated_at STRING"
)

# One row per claim of a partition by a worker.
CLAIM_SCHEMA = "run_id STRING, partition_id STRING, attempt BIGINT, holder STRING, job_name STRING, claimed_at STRING"

# What one worked partition leaves, and the folder that holds it for all partitions.
OUTPUT_FOLDERS = {
    "results_path": "batches",
    "errors_path": "errors",
    "metrics_path": "metrics",
    "success_marker_path": "markers",
}
MARKER_SCHEMA = (
    "run_id STRING, partition_id STRING, status STRING, input_count BIGINT, success_count BIGINT, failed_count BIGINT, "
    "api_calls_count BIGINT, batches_written BIGINT, success_marker_created_at STRING"
)

METRIC_COUNTS = (
    "input_count",
    "processed_count",
    "success_count",
    "failed_count",
    "api_calls_count",
    "batches_written",
)
METRICS_SCHEMA = (
    "run_id STRING, partition_id STRING, " + ", ".join(f"{name} BIGINT" for name in METRIC_COUNTS) + ", last_batch_path STRING"
)
