"""Fixed values.

Everything in this module is a value that results must reproduce exactly
(column lists, labels, texts, word lists).  They are stated plainly and kept
together; no logic lives here.
"""

# ---------------------------------------------------------------------------
# Ticket schema (name, Spark type) in its canonical order.
# ---------------------------------------------------------------------------
TICKET_COLUMNS = [
    ("ticket_id", "string"),
    ("created_at", "timestamp_ntz"),
    ("first_response_at", "timestamp_ntz"),
    ("resolved_at", "timestamp_ntz"),
    ("status", "string"),
    ("channel", "string"),
    ("customer_id", "string"),
    ("order_id", "string"),
    ("product_sku", "string"),
    ("category", "string"),
    ("priority", "string"),
    ("assigned_team", "string"),
    ("agent_id", "string"),
    ("transfers", "double"),
    ("csat_score", "double"),
    ("refund_amount_inr", "double"),
    ("refund_reason_code", "string"),
    ("replacement_issued", "string"),
    ("customer_message", "string"),
    ("agent_notes", "string"),
    ("source_system", "string"),
]

TIMESTAMP_COLUMNS = ["created_at", "first_response_at", "resolved_at"]
NUMERIC_COLUMNS = ["transfers", "csat_score", "refund_amount_inr"]
STRIPPED_COLUMNS = [
    "ticket_id", "status", "channel", "customer_id", "order_id",
    "product_sku", "category", "priority", "assigned_team", "agent_id",
    "refund_reason_code", "replacement_issued", "source_system",
]
TEXT_COLUMNS = ["customer_message", "agent_notes"]

# Roster columns and the aliases accepted for each (first match wins).
ROSTER_ALIASES = {
    "agent_id": ["agent_id", "id"],
    "name": ["name", "agent_name"],
    "team": ["team", "assigned_team"],
    "tier": ["tier", "agent_tier"],
}

# Team and status vocabularies.
TIER1_TEAMS = ["chat frontline", "email frontline", "voice frontline"]
COMPLETED_STATUSES = ["resolved", "closed"]
PREFERRED_SOURCE = "helpdesk"
LEGACY_SOURCE = "legacy_fd"
TIER_CODES = {"1": "tier 1", "2": "tier 2"}
NULL_KEY_LABEL = "<NA>"

# CSV tokens that read as missing (the pandas default NA set).
NA_TOKENS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
    "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a",
    "nan", "null",
]

# Default policy (the shipped policy file).
DEFAULT_POLICY = {
    "first_response_sla_minutes": {"chat": 15, "voice": 120, "social": 240, "email": 480},
    "contact_cost_inr": {"chat": 210, "email": 260, "voice": 520, "social": 240},
    "blended_cost_inr": 290,
    "internal_transfer_cost_inr": 305,
    "sla_miss_credit_inr": 350,
    "eligible_leaderboard_tiers": ["Tier 1"],
}

# Opportunity rows (name, definition).
OPP_SLA = "SLA breaches"
OPP_TRANSFERS = "Internal transfers"
OPP_REPEAT = "Repeat-contact proxy (7 days)"
OPP_SLA_DEFINITION = "First response exceeded the channel SLA."
OPP_TRANSFERS_DEFINITION = "Transfer events multiplied by policy transfer cost."
OPP_REPEAT_DEFINITION = (
    "A customer had a prior contact within 7 days; proxy, not confirmed causality."
)

# Business-goal texts.
GOAL_METRIC = "SLA breach rate"
GOAL_BENCHMARK_METHOD = "Median SLA breach rate among historical lower-quartile weeks."
GOAL_REASON_NO_WEEKS = "Not enough weekly data to establish a business goal."
GOAL_REASON_FEW_WEEKS = "Not enough historical weeks to establish a defensible benchmark."
GOAL_REASON_FEW_HISTORY = (
    "Not enough historical weeks remain after establishing the current baseline."
)
GOAL_REASON_NO_GAP = (
    "No opportunity has a sufficiently large historical improvement gap to "
    "support an evidence-backed target."
)
GOAL_BASELINE_LONG = "Most recent 8 weeks"
GOAL_BASELINE_SHORT = "Most recent week"
GOAL_HISTORICAL_PERIOD = "All earlier available weeks"

# Evidence-pack interpretation notes.
INTERPRETATION_RULES = {
    "invalid_created_at": "Count of created_at values that failed datetime parsing.",
    "missing_resolved_at": "Count of canonical tickets with resolved_at missing.",
    "canonical_temporal_anomalies": "Count of canonical tickets with invalid timestamp ordering.",
}

# Most rows of each part in the evidence pack (None keeps all).
EVIDENCE_LIMITS = {
    "weekly_metrics": 100, "opportunities": 20, "channel_metrics": 20, "category_metrics": 50,
    "tier1_leaderboard_latest_weeks": 80, "complaint_themes": 20, "ticket_sample": 12,
}

# Columns that enrichment adds to the ticket columns, in order.
ENRICHMENT_COLUMNS = [
    "channel_key", "first_response_minutes", "resolution_time_hours", "handle_time_hours", "sla_target_minutes", "sla_breach",
    "contact_cost_inr", "sla_penalty_exposure_inr", "transfer_cost_inr", "resolved_before_created", "first_response_before_created",
    "resolved_before_first_response", "temporal_anomaly", "week_start", "resolution_week_start", "completed_ticket",
]

# Evidence-pack ticket columns, in order.
EVIDENCE_TICKET_COLUMNS = [
    "ticket_id", "created_at", "channel", "category", "priority",
    "assigned_team", "agent_id", "transfers", "csat_score",
    "refund_amount_inr", "refund_reason_code", "replacement_issued",
    "customer_message", "agent_notes", "source_system",
]

# Theme label separator, the fallback category and the text of a missing ticket id.
MISSING_ID = "<NA>"
THEME_OTHER = "Other"
THEME_LABEL_SEP = " — "

# English stop-word list used by the TF-IDF themes
# (the scikit-learn "english" list, alphabetical).
ENGLISH_STOP_WORDS = """
a about above across after afterwards again against all almost alone along
already also although always am among amongst amoungst amount an and another
any anyhow anyone anything anyway anywhere are around as at back be became
because become becomes becoming been before beforehand behind being below
beside besides between beyond bill both bottom but by call can cannot cant co
con could couldnt cry de describe detail do done down due during each eg eight
either eleven else elsewhere empty enough etc even ever every everyone
everything everywhere except few fifteen fifty fill find fire first five for
former formerly forty found four from front full further get give go had has
hasnt have he hence her here hereafter hereby herein hereupon hers herself him
himself his how however hundred i ie if in inc indeed interest into is it its
itself keep last latter latterly least less ltd made many may me meanwhile
might mill mine more moreover most mostly move much must my myself name namely
neither never nevertheless next nine no nobody none noone nor not nothing now
nowhere of off often on once one only onto or other others otherwise our ours
ourselves out over own part per perhaps please put rather re same see seem
seemed seeming seems serious several she should show side since sincere six
sixty so some somehow someone something sometime sometimes somewhere still
such system take ten than that the their them themselves then thence there
thereafter thereby therefore therein thereupon these they thick thin third
this those though three through throughout thru thus to together too top
toward towards twelve twenty two un under until up upon us very via was we
well were what whatever when whence whenever where whereafter whereas whereby
wherein whereupon wherever whether which while whither who whoever whole whom
whose why will with within without would yet you your yours yourself
yourselves
""".split()
