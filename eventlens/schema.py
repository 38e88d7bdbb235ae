"""Schemas and fixed values.

The event envelope is declared, not inferred: every optional path exists and
reads as NULL, and no inference job runs.  ``payload`` is kept as a VARIANT so
ragged payloads (a string where an object is expected, an int *or* a string
``size``) navigate to NULL instead of failing the row, while the JSON text is
parsed only once.
"""

from __future__ import annotations

CORRUPT_COL = "_corrupt_record"

# Declared envelope for one event line (DDL form).
EVENT_DDL = (
    "id string, type string, "
    "actor struct<login: string, display_login: string>, "
    "repo struct<name: string>, "
    "payload variant, created_at string, "
    f"{CORRUPT_COL} string"
)

# --- fixed values (must equal the profiled application's for equal results) ---
# Top-level keys every event record must carry (presence check, null allowed).
REQUIRED_FIELDS = ["type", "actor", "repo", "payload"]

# Language lookup order inside the payload.  The 3-path form leaves out head.
LANGUAGE_PATHS = [
    "$.pull_request.base.repo.language",
    "$.pull_request.head.repo.language",
    "$.forkee.language",
    "$.repository.language",
]
LANGUAGE_PATHS_3 = [
    "$.pull_request.base.repo.language",
    "$.forkee.language",
    "$.repository.language",
]

UNKNOWN_TYPE = "Unknown"
UNKNOWN_USER = "unknown"
UNKNOWN_REPO = "unknown/unknown"
PUSH = "PushEvent"

# Report sizes per metric: 15 for repos/pushes/commits/users/matrix, 20 for
# languages and event types; hours are all shown, ordered by hour.
TOP_K = {
    "repo": 15,
    "push": 15,
    "commits": 15,
    "user": 15,
    "lang": 20,
    "type": 20,
}
PREVIEW_N = 20
PREVIEW_KEYS = 8
MIN_EVENTS = 50
# Metric kinds in the key/value form, and the report names they map to.
METRIC_NAMES = {
    "repo": "top_repos",
    "push": "top_push_repos",
    "commits": "top_commit_repos",
    "user": "top_users",
    "lang": "languages",
    "type": "event_types",
    "hour": "hours",
}
# --- end fixed values ---
