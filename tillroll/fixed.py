"""Values that results depend on. They are part of the data contract, not tuning knobs."""

# The wire event and where it travels
EVENT_TOPIC = "pos_transactions"
EVENT_FIELDS = ("transaction_id", "store_id", "timestamp", "total_amount")
EVENT_TIME_FORMAT = "yyyy-MM-dd HH:mm:ss"

# Validity and review limits
AMOUNT_ABOVE = 0
AMOUNT_BELOW = 1_000_000
REVIEW_ABOVE = 5_000

# Payment classes and the spellings that belong to them
PAYMENT_SPELLINGS = {
    "CASH": ("CASH", "cash"),
    "CARD": ("CARD", "card", "credit"),
    "MOBILE": ("MOBILE", "mobile", "wallet"),
}
PAYMENT_OTHER = "OTHER"

# Amount classes, each with the amount it ends below
AMOUNT_CLASSES = (("SMALL", 50), ("MEDIUM", 200), ("LARGE", 1_000))
AMOUNT_LARGEST = "XLARGE"

# Store-code patterns. The first is an anchored literal and leaves
# practically every code alone; the second is the character class it looks like.
STORE_PATTERN_LITERAL = "^A-Z0-9_"
STORE_PATTERN_CLASS = "[^A-Z0-9_]"

# Validation states
STATUS_REVIEW = "REVIEW"
STATUS_VALID = "VALID"

# Weekend days as numbered by dayofweek (1 = Sunday)
WEEKEND_DAYS = (1, 7)

# Row keys
STREAM_SALTS = 12
STORE_SALTS = 10
REVERSE_MILLIS_FROM = 9_999_999_999_999

# Mapping of sales rows to transaction events
SALES_FIELDS = ("t_dat", "customer_id", "article_id", "price")
CUSTOMER_CHARS = 10
STORES = 100
STORE_PREFIX = "STORE_"
STORE_DIGITS = 3
OPENING_HOUR = 8
OPEN_HOURS = 14
PRICE_FACTOR = 10_000
EVENT_CAP = 1_000_000

# How events are gathered on their way to the broker
SEND_BATCH_BYTES = 32_768
SEND_LINGER_MS = 20

# Micro-batch interval of the ingest stream
TRIGGER_INTERVAL = "3 seconds"

# Columns of the store ranking
RANK_COUNT = "so_giao_dich"
RANK_REVENUE = "doanh_thu"
