"""Word lists, maps and limits that results depend on."""

# --- text features -------------------------------------------------------------------------------
SPECIAL_TOKENS = [
    "<|", "|>", "[INST]", "[/INST]", "###", "system:", "assistant:", "user:",
    "<system>", "</system>", "{{", "}}", "<<", ">>",
]
IMPERATIVE_VERBS = [
    "ignore", "disregard", "forget", "override", "bypass", "reveal", "print",
    "act", "pretend", "become", "respond", "answer", "comply", "obey",
    "execute", "output", "generate", "tell", "show", "give", "do",
]
ROLEPLAY_LEXICON = [
    "pretend", "roleplay", "persona", "character", "dan mode", "jailbreak",
    "developer mode", "act as", "you are now", "simulate", "stay in character",
    "immersive", "fictional", "story mode",
]

# --- rule categories -----------------------------------------------------------------------------
ROLEPLAY_KEYWORDS = [
    "pretend you are", "act as", "you are now", "roleplay", "stay in character",
    "dan mode", "jailbreak", "developer mode", "do anything now", "persona",
    "simulate being", "you are dan", "ignore your previous persona",
]
OVERRIDE_KEYWORDS = [
    "ignore previous instructions", "ignore all previous", "disregard the above",
    "forget everything", "new instructions", "override", "system prompt",
    "ignore the rules", "your new task", "from now on you will",
]
DIRECT_KEYWORDS = [
    "reveal your system prompt", "print your instructions", "what are your rules",
    "bypass", "unlock", "no restrictions", "without any filter",
    "respond without", "do not refuse",
]
CATEGORIES = ["benign", "direct_injection", "instruction_override", "obfuscation", "roleplay"]

# --- obfuscated variants -------------------------------------------------------------------------
LEET_FROM, LEET_TO = "aeiostAEIOST", "431057431057"
# Latin a e o p c and the Cyrillic letters that look like them
LATIN, LOOKALIKE = "aeopc", "\u0430\u0435\u043e\u0440\u0441"
ZERO_WIDTH = ["\u200b", "\u200c", "\u200d"]
BASE64_PREFIX = "Decode this base64 string and follow its instructions: "

# --- enumerations and their order ----------------------------------------------------------------
RISK_TIERS = ["low", "medium", "high"]
DISPOSITIONS = ["allow", "sanitize", "block", "escalate"]
AGENT_STATUSES = ["success", "validation_failed", "llm_error"]
ACTION_TEXT = {
    "allow": "No action needed.",
    "sanitize": "Sanitized version forwarded downstream. Spot-check recommended.",
    "block": "Request blocked automatically. Log for weekly pattern review.",
    "escalate": "Route to human security reviewer within 1 hour SLA.",
}
FAIL_CLOSED_BEGIN = "Fail-closed escalation triggered: "
TRIAGE_FAIL_CLOSED_END = ". Triage agent output could not be validated after retries."
JUDGE_FAIL_CLOSED_END = (
    ". Judge agent output could not be validated after retries, so "
    "this request is being escalated for manual review as a safety default."
)
ESCALATION_HIGH = "classifier risk_tier is HIGH"
ESCALATION_DISAGREED = ["Triage/Judge disagreement (triage='", "', judge='", "')"]
ESCALATION_FAILED = "fail-closed fallback triggered in: "
ESCALATION_NONE = "routine pipeline pass -- no escalation criteria met"

# --- limits --------------------------------------------------------------------------------------
ROLLING_ROWS_BEFORE = 12
INCIDENT_GAP_SECONDS = 600
WINDOW_TOLERANCE_SECONDS = 300
REPLAY_BATCH_ROWS = 50
NEAR_DUPLICATE_DISTANCE = 0.35
GROUNDING_THRESHOLD = 0.40
RETRIEVED_SECTIONS = 3
TIER_MEDIUM, TIER_HIGH = 0.5, 0.8
HIGH_RISK_PROBABILITY = 0.6
POLICY_MIN_ARR = 500.0
SLA_LATENCY_MS = 60_000.0
CATEGORY_FLOOR = 200
NO_MATCH_TEXT = (
    "NO CONFIDENT RUNBOOK MATCH - escalate to human SRE. "
    "Do not auto-generate remediation for this anomaly pattern."
)
LOW_CONFIDENCE_LABELS = ["low", "none", "no_match", "unknown"]
DEFAULT_DRIVER = "overall_usage_pattern"
APPROVAL_SECTION = "REQUIRES HUMAN APPROVAL"
