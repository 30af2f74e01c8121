"""Fixed values that decide results: word lists, patterns, thresholds, message formats.

Every list here is a default argument somewhere; pass your own table to replace it.
"""

from __future__ import annotations

from dataclasses import dataclass, field

# --- labels with a fixed meaning -------------------------------------------------------------

UNCLASSIFIED = "UNCLASSIFIED"
OUT_OF_SCOPE = "OOS"
AUTO = "auto"
ESCALATE = "escalate"
DEFAULT_CLASS = "ORDER_DELIVERY_STATUS"
HARD_ESCALATION_CLASSES = ("ACCOUNT_ACCESS",)
NEEDS_REVIEW = "NEEDS_HUMAN_REVIEW"

# --- thresholds ------------------------------------------------------------------------------

MIN_SIDE_CHARS = 20
SHORT_BAND = (20, 80)
ASCII_SHARE_SAMPLING = 0.6
ASCII_SHARE_RELABEL = 0.65
MAX_INBOUND_SHARE = 0.20
MIN_OUTBOUND = 200
NOISE_CHARS = 20
MIN_LABELLED = 10
CONFIDENCE_SATURATION = 5
FALLBACK_CONFIDENCE = 0.1
PARSED_CONFIDENCE_DEFAULT = 0.5
UNPARSED_CONFIDENCE = 0.3

# weights of the account score: volume, completeness, cleanliness, vocabulary
PROFILE_WEIGHTS = (0.40, 0.30, 0.20, 0.10)

# (lower bound, name): a kappa strictly above the bound has the name
KAPPA_BANDS = ((0.80, "almost perfect"), (0.60, "substantial"), (0.40, "moderate"), (0.20, "fair"))
KAPPA_LOWEST_BAND = "slight"
TOTAL_BINS = ((4, "low"), (8, "medium"))
TOTAL_TOP_BIN = "high"
SCORE_DIMENSIONS = ("groundedness", "accuracy", "helpfulness", "tone")
DIMENSION_RANGE = (0, 3)
TOTAL_RANGE = (0, 12)

# --- word lists (fixed values) ---------------------------------------------------------------

# words that force escalation, matched on word boundaries
ESCALATION_TRIGGERS = (
    "lawyer", "lawsuit", "legal action", "police", "fraud", "scam", "identity theft", "stolen",
    "threatening", "unsafe", "injury", "hurt", "hospital", "dead", "dying", "health risk",
    "media", "press", "news", "bbc", "cnn", "block", "blocked", "locked", "hacked",
)

# the shorter list of the two-level policy, matched as substrings
ESCALATION_TRIGGERS_SIMPLE = (
    "lawyer", "lawsuit", "legal", "police", "fraud", "identity theft", "stolen", "threatening",
    "unsafe", "injury", "hurt", "hospital", "health risk", "media", "press", "bbc", "cnn",
)

# phrases in a model's reasoning that ask for a person
REASONING_FLAGS = ("escalate", "human agent", "cannot resolve")

# words ignored when a draft is compared with its references
GROUNDING_STOP_WORDS = (
    "i", "a", "the", "and", "or", "but", "in", "on", "at", "to", "for", "is", "are", "was", "were",
    "have", "has", "you", "your", "we", "our", "it", "its", "be", "can", "will", "would", "please",
    "thank", "thanks", "hi", "hello",
)

# words that alone make a message a mere continuation
CONTINUATION_WORDS = (
    "thanks?", "thank you", "ok", "okay", "yes", "no", "got it", "great", "perfect", "noted",
)

# --- message formats (fixed values) ----------------------------------------------------------

HARD_RULE_REASON = (
    "Intent '{intent}' always requires human agent — identity verification cannot be safely "
    "automated. ({note})"
)
TRIGGER_REASON = (
    "Customer message contains high-risk keyword(s): {hits}. Routing to human agent."
)
TRIGGER_REASON_SIMPLE = "High-risk keyword(s) detected: {hits}"
REASONING_REASON = (
    "LLM classification reasoning indicated escalation is warranted. LLM note: {note}"
)
DEFAULT_REASON = "Default policy for {intent}."
DEFAULT_REASON_SIMPLE = "Default policy."
DRAFT_FALLBACK = "Please contact us for assistance with your request."
AMBIGUOUS_REASON = "AMBIGUOUS — human labeller must decide"
REVIEWED_BY = "manual_review"


# --- the ordered relabelling rules (fixed values) --------------------------------------------


@dataclass(frozen=True)
class Rule:
    """Outcome of a rule and the substrings that select it.

    A rule fires when one of ``any_of`` occurs (or ``any_of`` is empty), all of ``all_of`` occur,
    none of ``none_of`` occurs, and it is not the case that ``unless_has`` occurs while
    ``unless_lacks`` is missing.
    """

    label: str
    decision: str
    note: str
    any_of: tuple[str, ...] = ()
    all_of: tuple[str, ...] = ()
    none_of: tuple[str, ...] = ()
    unless_has: str | None = field(default=None)
    unless_lacks: str | None = field(default=None)


_BILLING_WORDS = (
    "charged", "charge ", "billing", "bill ", "payment fail", "transaction fail", "debiting",
    "deducting", "deduct", "over limit", "false advertising", "free trial", "free trail",
    "gst invoice", "gift card", "gift card not working", "refund", "amount debited", "credit back",
    "citibank", "card not working", "card detail", "money from my acc",
)

FOREIGN_OUTCOME = (OUT_OF_SCOPE, ESCALATE, "Non-English tweet — out of scope")
CONTINUATION_OUTCOME = (OUT_OF_SCOPE, ESCALATE, "Continuation-only tweet, no primary issue")
DEFAULT_OUTCOME = (DEFAULT_CLASS, AUTO, "Default: general order inquiry")

RELABEL_RULES = (
    Rule(
        "ACCOUNT_ACCESS", ESCALATE, "Account security / access issue",
        any_of=(
            "hack", "hacked", "unauthori", "locked out", "lock", "account block",
            "blocked account", "login", "log in", "sign in", "password", "forgot password",
            "account recov", "reset", "fireTV stick activated", "not ann", "account deleted",
            "blocked", "email changed", "fax",
        ),
        unless_has="prime", unless_lacks="account",
    ),
    Rule(
        "PRIME_SUBSCRIPTION", AUTO, "Prime free trial question",
        any_of=_BILLING_WORDS, all_of=("prime", "free", "month"), none_of=("return", "replace"),
    ),
    Rule(
        "CHARGE_PAYMENT_BILLING", ESCALATE, "Billing / payment issue",
        any_of=_BILLING_WORDS, none_of=("return", "replace"),
    ),
    Rule(
        "PRIME_SUBSCRIPTION", AUTO, "Prime membership question",
        any_of=(
            "prime member", "prime subscription", "cancel prime", "prime benefit",
            "cancel my amazon prime", "prime video", "prime day", "student prime", "free months",
            "membership",
        ),
    ),
    Rule(
        "PRIME_SUBSCRIPTION", AUTO, "Prime membership question",
        any_of=("cancel", "sign up", "subscri", "trial"), all_of=("prime",),
    ),
    Rule(
        "ORDER_CANCELLATION", AUTO, "Order cancellation request",
        any_of=(
            "cancel order", "cancel my order", "cancell", "stop the order", "don't want",
            "do not want",
        ),
    ),
    Rule(
        "RETURN_REFUND_REPLACEMENT", AUTO, "Return / refund / replacement request",
        any_of=(
            "return", "refund", "replace", "replacement", "money back", "reimburse", "damaged",
            "defective", "broken item", "wrong item", "sent back", "send back",
        ),
    ),
    Rule(
        "PRODUCT_COMPLAINT", AUTO, "Product quality / complaint",
        any_of=(
            "fake", "counterfeit", "not genuine", "poor quality", "disappointed", "terrible",
            "awful", "not working", "doesn't work", "defective", "wrong product",
            "wrong item sent", "packaging", "destroy the world",
        ),
    ),
    Rule(
        "DEVICE_APP_TECHNICAL", AUTO, "Device or app technical issue",
        any_of=(
            "kindle", "echo", "alexa", "fire tv", "firestick", "fire stick", "the app",
            "your app", "amazon app", "website", "the site", "not loading", "streaming",
            "buffering", "software", "update", "touch id",
        ),
    ),
    Rule(
        "PRODUCT_COMPLAINT", AUTO, "Third-party seller complaint",
        any_of=(
            "seller", "third party", "marketplace", "merchant", "sold by", "fulfilled", "vendor",
        ),
    ),
    Rule(
        "ORDER_DELIVERY_STATUS", AUTO, "Order / delivery status inquiry",
        any_of=(
            "order", "package", "delivery", "deliver", "shipping", "ship", "tracking", "track",
            "arrive", "arrival", "dispatched", "carrier", "late", "delay", "not received",
            "where is", "when will", "out for delivery", "1 day delivery", "next day",
        ),
    ),
    Rule(
        "CHARGE_PAYMENT_BILLING", ESCALATE, "Billing issue",
        any_of=("charge", "charged", "pay", "paid"),
    ),
)

# --- quotas of the evaluation-set batches (fixed values) -------------------------------------

GOLDEN_SEED = 2024
PROPORTIONAL_TOTAL = 80
TAIL_CLASSES = (
    "DEVICE_APP_TECHNICAL", "ORDER_CANCELLATION", "PRODUCT_COMPLAINT", "CHARGE_PAYMENT_BILLING",
)
TAIL_QUOTA = 15
HARD_CASE_QUOTA = 20
ESCALATION_CLASSES = ("ACCOUNT_ACCESS", "CHARGE_PAYMENT_BILLING")
ESCALATION_QUOTA = 15
AUTO_CLASSES = ("ORDER_DELIVERY_STATUS", "PRIME_SUBSCRIPTION")
AUTO_QUOTA = 10
DEDUP_PREFIX = 100
GOLDEN_CAP = 250
NOTE_CHARS = 300
