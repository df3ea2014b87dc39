"""Fixed values of the usage data model."""

from decimal import Decimal

# Names and numbers that the record format and the results depend on.
RECORD_TYPES = ("voice", "sms", "data")
CORRUPTION_MARKER = "corrupted_data"
STATUS_RATED, STATUS_REJECTED, STATUS_ERROR = "rated", "rejected", "error"
SERVICE_LABELS = {"voice": "Voice Calls", "sms": "SMS", "data": "Mobile Data"}
UNIT_LABELS = {"voice": "minutes", "sms": "messages", "data": "MB"}
VOICE_PRICE_PER_MINUTE = Decimal("1.0")
SMS_PRICE = Decimal("0.5")
DATA_PRICE_FIRST_TIER = Decimal("5.0")
DATA_PRICE_ABOVE = Decimal("2.0")
DATA_FIRST_TIER_MB = 100
TAX_RATE = Decimal("0.20")

# Money is kept exact.  One client may hold a third of all usage, so totals get room for 16 integer digits.
VOLUME_TYPE = "decimal(18,6)"
COST_TYPE = "decimal(20,6)"
AMOUNT_TYPE = "decimal(18,2)"
UNIT_PRICE_TYPE = "decimal(18,4)"
QUANTITY_TYPE = "decimal(18,2)"
