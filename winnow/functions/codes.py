"""Fixed vocabularies that must equal the reference's for equal results.

Fixed values (failure codes, states, check ids), stated as text in the
reference's order.
"""

# failure codes emitted by the validators
EMPTY_OUTPUT = "empty_output"
TOO_LONG_OUTPUT = "too_long_output"
INVALID_JSON = "invalid_json"
WRONG_TYPE = "wrong_type"
NAN_DETECTED = "nan_detected"
MAX_DEPTH_EXCEEDED = "max_depth_exceeded"
SCHEMA_ERROR = "schema_error"
DUPLICATE_SAMPLE = "duplicate_sample"
SEMANTIC_DEDUP_ERROR = "semantic_dedup_error"
WRONG_PREDICTION_MODE = "wrong_prediction_mode"
MISSING_PIPELINE_IDENTITY = "missing_pipeline_identity"
INVALID_CLASS = "invalid_class"
MISSING_PROBABILITY = "missing_probability"
INVALID_PROBABILITY = "invalid_probability"
CONFIDENCE_ERROR = "confidence_error"
INFINITY_DETECTED = "infinity_detected"
RANGE_ERROR = "range_error"

# check ids carried in evidence records
CHECK_STRUCTURED_JSON = "structured_json"
CHECK_JSON_SCHEMA = "json_schema"
CHECK_SEMANTIC_DEDUP = "semantic_dedup"
CHECK_ML_VALIDATION = "ml_validation"
CHECK_EXACT_DEDUP = "ml_exact_dedup"

# sample statuses
ACCEPTED = "accepted"
REJECTED = "rejected"

# run states and legal transitions: created->running->{completed, failed}; created->failed
RUN_STATES = ("created", "running", "completed", "failed")
RUN_TRANSITIONS = (("created", "running"), ("created", "failed"),
                   ("running", "completed"), ("running", "failed"))

# task states: pending->generating->validating->{accepted, rejected}; any non-terminal->failed
TASK_STATES = ("pending", "generating", "validating", "accepted", "rejected", "failed")
TASK_TRANSITIONS = (("pending", "generating"), ("generating", "validating"),
                    ("validating", "accepted"), ("validating", "rejected"),
                    ("pending", "failed"), ("generating", "failed"), ("validating", "failed"))

# message roles
ROLES = ("system", "user", "assistant")

# prediction modes
CLASSIFICATION = "classification"
REGRESSION = "regression"

# probability sum tolerance (absolute)
PROBABILITY_SUM_TOLERANCE = 1e-6

# bounded text: limits and truncation marker
ERROR_MESSAGE_LIMIT = 16384
TRACEBACK_LIMIT = 131072
TRUNCATION_MARKER = "...[truncated]"
