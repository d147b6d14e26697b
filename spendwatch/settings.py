"""Fixed names and default parameters shared by the operators."""

# Topic names of the payment pipeline.
TOPIC_INITIATED = "payment.initiated.events"
TOPIC_PROCESSED = "payment.processed.events"
TOPIC_BALANCES = "user-account-balances"
TOPIC_ALERTS = "fraud.high-risk.alerts"

# Allowed symbols of the enumerated fields.
PAYMENT_METHODS = ["CARD", "ACH", "WIRE", "WALLET", "UPI"]
PAYMENT_STATUSES = ["APPROVED", "DECLINED", "FLAGGED_FOR_REVIEW", "FAILED"]
RISK_LEVELS = ["MEDIUM", "HIGH", "CRITICAL"]

# Names written into the outbox and the dedup ledger.
AGGREGATE_TYPE = "Payment"
EVENT_TYPE = "PaymentInitiatedEvent"
INITIAL_STATUS = "INITIATED"
DEDUP_PREFIX = "payment-event:"

# Column widths of the payments table.
MAX_LENGTHS = {"user_id": 64, "merchant_id": 64, "currency": 3, "status": 32}

# Default parameters.
WINDOW = "5 minutes"
GRACE = "30 seconds"
RISK_THRESHOLD = "15000"
HIGH_VALUE = "10000"
PARTITIONS = 6
DEDUP_TTL = "24 hours"
MAX_ATTEMPTS = 3
RETRY_DELAY_SECONDS = 1
RETRY_MULTIPLIER = 2
OUTBOX_PAGE = 100
EVENT_RETENTION = "7 days"
ALERT_RETENTION = "30 days"
RETENTION_BYTES = 50 * 1024**3
TOMBSTONE_RETENTION = "24 hours"
DEFAULT_CURRENCY = "USD"
DEFAULT_RISK_SCORE = 0.0
DEFAULT_RISK_LEVEL = "HIGH"

# Offsets covered by one block of an ordered scan (operators/ordered.py). A block is the unit a
# task sorts, so this bounds a task whatever the key distribution looks like.
BLOCK_OFFSETS = 1_000_000

# Offsets covered by one row of an alert's payment ids.
ID_BLOCK_OFFSETS = 10_000
# Payments of one block of the running totals of a window.
SIGNAL_BLOCK_ROWS = 1_000_000
# Rows of the field catalog that one task gathers; its partitions are counted by it.
CATALOG_TASK_ROWS = 1_000_000
