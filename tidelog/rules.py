"""Fixed business values. They decide results and must not drift."""

# Change operations: create, update, snapshot read, delete.
UPSERT_OPS = ("c", "u", "r")
DELETE_OP = "d"
ALL_OPS = ("c", "u", "d", "r")

# Order life cycle.
ORDER_STATUSES = ("pending", "confirmed", "shipped", "delivered", "completed", "cancelled")
REVENUE_STATUSES = ("confirmed", "shipped", "delivered", "completed")
ALLOWED_TRANSITIONS = (
    ("pending", "confirmed"),
    ("pending", "cancelled"),
    ("confirmed", "shipped"),
    ("confirmed", "cancelled"),
    ("shipped", "delivered"),
    ("delivered", "completed"),
)

# A customer is churned when the last order is more than this many days old.
CHURN_AFTER_DAYS = 90

# Currency of orders that name none, and the quoted currencies kept by default.
FALLBACK_CURRENCY = "USD"
QUOTED_CURRENCIES = ("USD", "GBP", "CHF", "JPY", "CAD")

# Hot-path window.
WINDOW_SIZE = "1 minute"
WATERMARK_DELAY = "5 seconds"
