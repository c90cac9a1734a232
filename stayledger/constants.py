"""Values that decide results: word lists, lookup rows, formats and limits."""

# --- Fixed values: column groups of a raw booking -------------------------------------


# Columns whose edges are stripped of junk characters.
EDGE_CLEANED_COLUMNS = [
    "hotel_id", "hotel_name", "country", "city", "hotel_type", "hotel_facilities",
    "nearby_attractions", "website", "customer_id", "first_name",
    "last_name", "full_name", "email", "phone", "birth_date", "gender",
    "country_customer", "city_customer", "address", "postal_code",
    "language_preference", "loyalty_level_customer", "registration_date",
    "marketing_consent", "booking_date", "checkin_date", "checkout_date",
    "room_type", "booking_channel", "special_requests", "is_cancelled",
    "cancellation_date", "cancellation_reason", "payment_status",
    "payment_method", "booking_source", "promotion_code", "created_timestamp",
    "updated_timestamp", "created_by", "booking_status", "review_date",
    "is_verified_review", "reviewer_location", "stay_date", "trip_type",
    "room_type_reviewed", "source_system", "created_at", "updated_at",
]

# Columns in which a missing or blank value becomes "Unknown".
UNKNOWN_LABEL_COLUMNS = [
    "hotel_name", "hotel_type", "hotel_facilities", "nearby_attractions",
    "website", "email", "gender", "address", "postal_code",
    "loyalty_level_customer", "room_type", "booking_channel",
    "payment_status", "payment_method", "booking_source",
    "reviewer_location", "trip_type", "room_type_reviewed", "source_system",
]

GEO_COLUMNS = ["country", "city", "country_customer", "city_customer"]

DATE_COLUMNS = [
    "birth_date", "booking_date", "checkin_date", "checkout_date",
    "cancellation_date", "review_date", "stay_date",
]

YEAR_GUARDED_COLUMNS = ["booking_date", "checkin_date"]

RATING_COLUMNS = ["star_rating", "review_rating"]

MONEY_COLUMNS = [
    "total_price", "room_price", "tax_amount",
    "service_fee", "paid_amount", "discount_amount",
]

ZERO_FILLED_COLUMNS = ["tax_amount", "service_fee", "discount_amount"]

UPPER_ID_COLUMNS = ["hotel_id", "customer_id"]

# --- Fixed values: characters, words, formats, limits ----------------------------------

EDGE_CHARACTERS = "!|?_-#."
EDGE_PATTERN = r"^[!|?_\-#.]+|[!|?_\-#.]+$"
NON_LETTERS_PATTERN = r"[^a-zA-Z\s]"

# Text standing for a missing key.
NULL_WORD = "null"
UNKNOWN_LABEL = "Unknown"
UNKNOWN_GEO = "UNKNOWN"

# Spoken ratings, replaced in this order; six and above are capped at five.
RATING_WORDS = {
    "one": "1", "two": "2", "three": "3", "four": "4", "five": "5",
    "six": "5", "seven": "5", "eight": "5", "nine": "5", "ten": "5",
}
RATING_MIN, RATING_MAX = 1, 5

ROOMS_TOO_FEW, ROOMS_TOO_MANY = 0, 9999

# Date layouts in order of preference: booking cleaning, and the rate-range job.
CLEANING_DATE_FORMATS = ["yyyy-MM-dd", "MM/dd/yyyy", "dd/MM/yyyy", "yyyy/MM/dd"]
RANGE_DATE_FORMATS = ["yyyy-MM-dd", "dd/MM/yyyy", "MM/dd/yyyy"]

LAST_VALID_YEAR = 2025
DASHBOARD_CHECKIN_CUTOFF = "2025-01-10"

RAIN_THRESHOLD = 0.5
BUDGET_BELOW, MID_RANGE_BELOW = 150, 400
WEATHER_DEFAULTS = {"temp_max": 22.5, "rain_sum": 0.0}
BASE_CURRENCY = "USD"
CANCELLED_STATUS = "Cancelled"

# --- Fixed values: country to currency (53 rows) ---------------------------------------

COUNTRY_CURRENCY = [
    ("ARGENTINA", "ARS"), ("AUSTRALIA", "AUD"), ("AUSTRIA", "EUR"), ("BELGIUM", "EUR"),
    ("BRAZIL", "BRL"), ("BULGARIA", "BGN"), ("CANADA", "CAD"), ("CHILE", "CLP"),
    ("CHINA", "CNY"), ("COLOMBIA", "COP"), ("CROATIA", "EUR"), ("CZECH REPUBLIC", "CZK"),
    ("DENMARK", "DKK"), ("EGYPT", "EGP"), ("FINLAND", "EUR"), ("FRANCE", "EUR"),
    ("GERMANY", "EUR"), ("GREECE", "EUR"), ("HUNGARY", "HUF"), ("INDIA", "INR"),
    ("INDONESIA", "IDR"), ("IRELAND", "EUR"), ("ISRAEL", "ILS"), ("ITALY", "EUR"),
    ("JAPAN", "JPY"), ("KENYA", "KES"), ("MALAYSIA", "MYR"), ("MEXICO", "MXN"),
    ("MOROCCO", "MAD"), ("NETHERLANDS", "EUR"), ("NEW ZEALAND", "NZD"), ("NIGERIA", "NGN"),
    ("NORWAY", "NOK"), ("PERU", "PEN"), ("PHILIPPINES", "PHP"), ("POLAND", "PLN"),
    ("PORTUGAL", "EUR"), ("ROMANIA", "RON"), ("SAUDI ARABIA", "SAR"), ("SERBIA", "RSD"),
    ("SINGAPORE", "SGD"), ("SLOVAKIA", "EUR"), ("SOUTH AFRICA", "ZAR"), ("SOUTH KOREA", "KRW"),
    ("SPAIN", "EUR"), ("SWEDEN", "SEK"), ("SWITZERLAND", "CHF"), ("THAILAND", "THB"),
    ("TURKEY", "TRY"), ("UNITED ARAB EMIRATES", "AED"), ("UNITED KINGDOM", "GBP"),
    ("UNITED STATES", "USD"), ("VIETNAM", "VND"),
]

# --- Fixed values: flat rates for currencies without a daily rate (13 rows) -------------

FALLBACK_RATES = [
    ("ARS", 850.0), ("CLP", 950.0), ("COP", 3900.0), ("EGP", 48.0),
    ("KES", 130.0), ("MAD", 10.0), ("NGN", 1400.0), ("PEN", 3.7),
    ("SAR", 3.75), ("RSD", 107.0), ("AED", 3.67), ("VND", 24500.0),
    ("USD", 1.0),
]

# --- Fixed values: landing rule of the booking stream ----------------------------------

LANDING_MIN_ROWS = 10_000
LANDING_MAX_SECONDS = 60
