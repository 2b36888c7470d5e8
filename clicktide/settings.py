"""Rules and thresholds, kept in one place so every operator takes them as arguments."""

from __future__ import annotations

from dataclasses import dataclass, field

# --- fixed values: event contract -------------------------------------------------
REQUIRED_COLUMNS = ("page_url", "timestamp", "event_name", "event_data", "user_agent")
IDENTITY_COLUMNS = ("client_id", "clientId")
OPTIONAL_COLUMNS = ("referrer",)
ALLOWED_EVENTS = (
    "page_viewed",
    "product_added_to_cart",
    "checkout_started",
    "checkout_completed",
    "email_filled_on_popup",
)
PAYLOAD_REQUIREMENTS = {
    "checkout_completed": ("transaction_id", "revenue", "items"),
    "email_filled_on_popup": ("email",),
}
RAW_EVENT_COLUMNS = (
    "client_id",
    "clientId",
    "page_url",
    "referrer",
    "timestamp",
    "event_name",
    "event_data",
    "user_agent",
)

# --- fixed values: traffic classification -----------------------------------------
UTM_FIELDS = ("utm_source", "utm_medium", "utm_campaign", "utm_term", "utm_content")
PAID_SEARCH_CLICK_IDS = ("gclid", "gbraid", "wbraid", "msclkid")
PAID_SOCIAL_CLICK_IDS = ("fbclid", "ttclid", "igshid")
SEARCH_HOSTS = ("google.", "bing.", "yahoo.", "duckduckgo.", "baidu.", "ecosia.")
SOCIAL_HOSTS = (
    "facebook.",
    "instagram.",
    "tiktok.",
    "pinterest.",
    "snapchat.",
    "reddit.",
    "x.com",
    "twitter.",
)
MOBILE_MARKERS = ("iphone", "android", "mobile", "ipad")

# --- fixed values: severities -----------------------------------------------------
P0, P1, P2, P3 = "P0_BLOCKER", "P1_HIGH", "P2_MEDIUM", "P3_INFO"
SEVERITY_WEIGHTS = {P0: 30, P1: 15, P2: 5, P3: 0}
UNKNOWN_SEVERITY_WEIGHT = 5

# --- fixed values: z scale and purchase event --------------------------------------
# Robust z = 0.6745 * (x - median) / MAD.
ROBUST_Z_SCALE = 0.6745
PURCHASE_EVENT = "checkout_completed"


@dataclass(frozen=True)
class Contract:
    """What a daily partition must look like."""

    required_columns: tuple[str, ...] = REQUIRED_COLUMNS
    identity_columns: tuple[str, ...] = IDENTITY_COLUMNS
    optional_columns: tuple[str, ...] = OPTIONAL_COLUMNS
    allowed_events: tuple[str, ...] = ALLOWED_EVENTS
    payload_requirements: dict[str, tuple[str, ...]] = field(
        default_factory=lambda: dict(PAYLOAD_REQUIREMENTS)
    )


@dataclass(frozen=True)
class TrafficRules:
    """Host and parameter lists behind channel and device classification."""

    own_domain: str = "shop.example.com"
    paid_search_ids: tuple[str, ...] = PAID_SEARCH_CLICK_IDS
    paid_social_ids: tuple[str, ...] = PAID_SOCIAL_CLICK_IDS
    search_hosts: tuple[str, ...] = SEARCH_HOSTS
    social_hosts: tuple[str, ...] = SOCIAL_HOSTS
    mobile_markers: tuple[str, ...] = MOBILE_MARKERS


@dataclass(frozen=True)
class LandingRules:
    """Which events may be a session's landing; ``event=None`` means any event."""

    event: str | None = None
    site_host: str = "shop.example.com"
    exclude_host: str = "checkout.shop.example.com"


@dataclass(frozen=True)
class AlertRule:
    """Thresholds for one monitored daily metric."""

    metric: str
    abs_delta: float
    min_z: float
    message: str
    rel_delta: float | None = None  # set for volume metrics only
    blocker_rel: float = 0.75


# --- fixed values: alert thresholds and texts -------------------------------------
RATE_MESSAGE = "Conversion rate shifted vs baseline; investigate tracking or UX changes."
SHARE_MESSAGE = (
    "Direct traffic share shifted materially; could indicate attribution signal loss "
    "(e.g., missing referrer/UTMs)."
)
ALERT_RULES = (
    AlertRule("sessions", 50.0, 4.0, "", rel_delta=0.35),
    AlertRule("purchases", 50.0, 4.0, "", rel_delta=0.35),
    AlertRule("revenue", 5000.0, 4.0, "", rel_delta=0.35),
    AlertRule("purchase_rate", 0.01, 3.0, RATE_MESSAGE),
    AlertRule("direct_session_share", 0.15, 3.0, SHARE_MESSAGE),
)
MONITORED_METRICS = (
    "sessions",
    "purchases",
    "revenue",
    "purchase_rate",
    "direct_session_share",
    "direct_revenue_share",
)
