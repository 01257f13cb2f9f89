"""Schemas of landed payloads and of the tables this package keeps."""

# Landed payloads.
STORY_HIT = (
    "objectID string, title string, story_title string, author string, "
    "created_at string, created_at_i bigint, story_text string"
)
QUESTION = (
    "link string, title string, creation_date string, "
    "owner struct<display_name:string>, tags array<string>"
)
MICRO_POST = (
    "uri string, author struct<handle:string,labels:array<struct<val:string>>>, "
    "record struct<text:string,createdAt:string>"
)

# A post on its way into the store. ``posted_at`` is still the given string.
CANDIDATE = (
    "seq bigint, platform string, post_url string, post_title string, "
    "author_handle string, posted_at string, summary string, "
    "opportunity string, categories array<string>, competitors array<string>"
)
POST_FIELDS = [
    "platform", "post_url", "post_title", "author_handle", "posted_at",
    "summary", "opportunity", "categories", "competitors",
]

POSTS = (
    "id string, platform string, post_url string, post_title string, "
    "author_handle string, posted_at timestamp, summary string, "
    "opportunity string, categories array<string>, competitors array<string>, "
    "status string, discovered_at timestamp, status_changed_at timestamp, "
    "actioned_by string, actioned_at timestamp"
)
POST_COLUMNS = [f.split()[0] for f in POSTS.split(", ")]

CLIENT_ERRORS = (
    "id string, occurred_at timestamp, message string, stack string, "
    "page_url string, user_agent string, fingerprint string, alerted_at timestamp"
)
STEP = (
    "struct<name:string,started_at:timestamp,ended_at:timestamp,status:string,"
    "count:int,note:string,sequence:int>"
)
PIPELINE_RUNS = (
    "id string, product string, script string, mode string, started_at timestamp, "
    f"ended_at timestamp, status string, steps array<{STEP}>, "
    "stats map<string,string>, error_id string"
)
PIPELINE_ERRORS = (
    "id string, occurred_at timestamp, product string, script string, mode string, "
    "message string, traceback string, resolved boolean, resolved_at timestamp, "
    "resolved_by string, run_id string"
)
STEP_EVENTS = (
    "run_id string, name string, status string, count int, note string, "
    "sequence int, at timestamp, seq bigint"
)
STATUS_ACTIONS = "id string, status string, user string, at timestamp, seq bigint"
