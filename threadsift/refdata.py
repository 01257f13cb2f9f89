"""Word lists, labels and limits.

They must equal the reference's values for results to be equal, so they are
stated as they are. Every function that uses one takes it as a parameter.
"""

from __future__ import annotations

# The category taxonomy.
CATEGORIES = [
    "OCR", "IDP", "NLP", "table-extraction", "layout-extraction", "RPA",
    "forms-automation", "healthcare-RCM", "legal-doc", "financial-doc",
    "prior-auth", "clinical-documentation", "pharmaceutical-documentation",
    "scientific-literature", "insurance-doc", "logistics-doc", "ADE",
]

# Platforms a stored post may carry.
PLATFORMS = [
    "reddit", "hackernews", "stackoverflow", "x", "bluesky", "vendor-forum",
    "other", "ade",
]

# The platform tag that wins over the tag of any earlier copy of a post.
PRIORITY_PLATFORM = "ade"
VENDOR_PLATFORM = "vendor-forum"

# Spellings that mean the vendor forums.
VENDOR_ALIASES = [
    "aws", "aws-repost", "ms-qna", "microsoft q&a", "gcp-community",
    "google cloud community", "cloud-forum",
]

# Competitor names in their canonical spelling.
COMPETITORS = ["Reducto", "Unstructured", "UiPath", "LlamaIndex"]

# Query parameters that only track the visitor.
TRACKING_PARAMS = [
    "utm_source", "utm_medium", "utm_campaign", "utm_term", "utm_content",
    "utm_id", "utm_name", "utm_referrer", "fbclid", "gclid", "msclkid",
    "yclid", "dclid", "mc_cid", "mc_eid", "ref", "ref_src", "ref_url", "_ga",
    "igshid",
]

# Statuses of a stored post, and those the archive view shows.
STATUSES = ["new", "replied", "deleted", "archived", "completed"]
ARCHIVE_STATUSES = ["archived", "completed", "replied"]

# Labels on the report page.
PLATFORM_LABELS = {
    "reddit": "Reddit", "hackernews": "Hacker News",
    "stackoverflow": "Stack Overflow", "x": "X", "bluesky": "Bluesky",
    "vendor-forum": "Vendor Forum", "other": "Other", "ade": "ADE",
}
STATUS_LABELS = {
    "new": "New", "replied": "Replied", "deleted": "Deleted",
    "archived": "Archived", "completed": "Done",
}
# The daily summary words one platform differently. (Its own-brand label names
# a company; pass it in through ``labels`` where it is wanted.)
SUMMARY_LABELS = {**PLATFORM_LABELS, "vendor-forum": "Vendor Forum (AWS/MS/GCP)"}

# Platforms that must not be silent for a week.
EXPECTED_PLATFORMS = ["reddit", "hackernews", "stackoverflow", "x"]

# Keyword queries of the story and microblog harvest, in order.
KEYWORDS = [
    "OCR", "IDP document", "document extraction", "document AI",
    "intelligent document", "PDF parsing", "PDF table extraction",
    "table extraction", "layout extraction", "Textract", "form recognizer",
    "Donut model", "LayoutLM", "Tesseract", "azure form",
    "invoice extraction", "lab report extraction", "prior authorization",
    "patient referral", "EOB extraction", "CMS-1500", "EHR documentation",
    "clinical documentation", "pathology report", "discharge summary",
    "pharma documentation", "clinical trial documents",
    "scientific paper extraction", "research paper figures", "drug label",
    "10-K extraction", "prospectus extraction", "investor report parsing",
    "valuation report", "W-2 OCR", "tax form extraction",
    "bank statement extraction", "fund letter parsing",
    "contract extraction", "due diligence document", "title document OCR",
    "handwritten form OCR", "scanned form extraction", "multi-column PDF",
    "PDF figure extraction",
]

# Tags of the question harvest, in order.
TAGS = [
    "ocr", "azure-form-recognizer", "aws-textract", "tesseract",
    "document-ai", "pdf-parsing", "table-extraction",
    "google-cloud-document-ai", "form-recognition",
]

# Title phrases of the question harvest, in order.
TITLE_PHRASES = [
    "OCR", "IDP", "document extraction", "PDF extraction", "form extraction",
    "table extraction", "multi-column PDF", "Textract", "Document AI",
    "Form Recognizer", "LayoutLM", "lab report", "prior authorization",
    "EOB", "CMS-1500", "patient referral", "10-K", "prospectus",
    "investor report", "valuation", "W-2", "tax form", "bank statement",
    "scientific paper", "clinical trial", "due diligence", "ACORD form",
    "FNOL", "loss run", "claims adjudication", "bill of lading",
    "packing slip",
]

# Limits and windows.
HARVEST_HOURS = 168
STORY_TOP = 20
QUESTION_TOP = 30
MICRO_TOP = 40
TITLE_CHARS = 500
SNIPPET_CHARS = 500
ARCHIVE_DAYS = 4
VENDOR_MAX_AGE_DAYS = 14
LATIN_END = 0x024F
NON_LATIN_LIMIT = 0.20
QUEUE_CAP = 500
REPORT_CAP = 10_000
LIST_LIMIT = 100
LIST_LIMIT_MAX = 500
RUNS_DAYS = 90
ERRORS_DAYS = 30
ERROR_WIDTHS = {"message": 1000, "stack": 4000, "page_url": 500, "user_agent": 500}
FINGERPRINT_CHARS = 64
LOG_MESSAGE_CHARS = 500
ACCEPTED_PER_HOUR = 20
RATE_WINDOW_S = 3600
REPEAT_TTL_S = 60
RUNAWAY_PER_DAY = 100
ERRORS_PER_WEEK = 50
SEVERITIES = ["HEALTHY", "NEEDS_ATTENTION", "BROKEN"]
