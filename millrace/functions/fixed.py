"""Names, formats and texts that results must carry exactly."""

AMOUNT_TYPE = "DECIMAL(12, 2)"
TIMESTAMP_PATTERN = "yyyy-MM-dd HH:mm:ss"
MALFORMED_LINE = "malformed line"
MISSING_KEY = "missing product key"
BAD_AMOUNT = "invalid or missing amount"
BAD_TIME = "invalid or missing timestamp"
UNMAPPED = "unmapped"
