"""Fixed values that results depend on: codes, labels and lookup rows."""

# Upper edge in days (inclusive) and label of each maturity bucket.
SIGHT_BUCKET = "1. Overnight"
BUCKET_EDGES = (
    (7, "2. <= 1 Week"),
    (30, "3. <= 1 Month"),
    (90, "4. <= 3 Months"),
    (180, "5. <= 6 Months"),
    (365, "6. <= 1 Year"),
)
LAST_BUCKET = "7. > 1 Year"

# Accepted deal states and product codes.
DEAL_STATUSES = ("VALIDATED", "MATURED", "CANCELLED")
DEAL_TYPES = ("FIXBIS_DEP", "MTI_DEP", "SIGHT_DEP", "NOTICE_DEP")

# Currency code, name, member of the SDR basket.
CURRENCIES = (
    ("USD", "US Dollar", "Y"),
    ("EUR", "Euro", "Y"),
    ("GBP", "British Pound", "Y"),
    ("JPY", "Japanese Yen", "Y"),
    ("CNY", "Chinese Renminbi", "Y"),
    ("CHF", "Swiss Franc", "N"),
    ("AUD", "Australian Dollar", "N"),
    ("CAD", "Canadian Dollar", "N"),
    ("SGD", "Singapore Dollar", "N"),
    ("KRW", "South Korean Won", "N"),
)

# Product code, name, description.
PRODUCTS = (
    (
        "FIXBIS_DEP",
        "FIXBIS",
        "Fixed-rate BIS deposit. Fixed term, fixed interest rate. Most common product.",
    ),
    (
        "MTI_DEP",
        "MTI",
        "Medium-term instrument. Longer tenor fixed-rate deposit, typically 1-10 years.",
    ),
    (
        "SIGHT_DEP",
        "Sight",
        "Sight account. Overnight / on-demand deposit. No fixed maturity.",
    ),
    (
        "NOTICE_DEP",
        "Notice",
        "Notice account. Deposit redeemable with advance notice period.",
    ),
)

# Country codes of each region; any other code is OTHER_REGION.
REGION_COUNTRIES = {
    "Asia-Pacific": (
        "CN JP IN KR AU NZ SG HK TH MY ID PH BD PK LK MM KH MN PG FJ "
        "TM MO TJ BT KZ KG CK MV WS UZ TL SB NP VU VN LA BN TO"
    ).split(),
    "Americas": "US CA BR MX AR CL CO PE UY BO EC PY VE TT JM CR HN".split(),
    "Europe": (
        "DE FR GB IT ES NL BE SE NO DK CH PL CZ HU RO BG HR RS TR IS AZ AM GE"
    ).split(),
    "Middle East": "SA AE KW QA BH OM JO LB IQ IR IL".split(),
    "Africa": (
        "ZA NG EG KE GH TZ UG ET MA TN DZ MU RW BW NA MZ ZM ZW SN CD MW"
    ).split(),
    "International": "XX EU".split(),
}
OTHER_REGION = "Other"

# SDR per unit of currency that the rate feed is built around.
BASE_RATES = (
    ("USD", "0.752"),
    ("EUR", "0.820"),
    ("GBP", "0.947"),
    ("JPY", "0.00542"),
    ("CNY", "0.104"),
    ("CHF", "0.845"),
    ("AUD", "0.497"),
    ("CAD", "0.558"),
    ("SGD", "0.557"),
    ("KRW", "0.000572"),
)

# Days from value date to maturity on offer per product.
NOTICE_DAYS = (30, 60, 90, 180)
FIXED_TERM_DAYS = (30, 60, 90, 120, 180, 270, 365, 540, 730)

# Fixed values of the order-book adapter: country per nation key (XX and EU are
# international bodies, ZZ is unknown), portfolio per region key, currency by
# the last digit of the customer key.
BOOK_COUNTRIES = (
    "ZA US CN DE SA NG BR JP FR AE EG MX IN GB KW KE CA KR CH QA XX EU SG IT ZZ"
).split()
BOOK_PORTFOLIOS = "TRSRY-EMEA TRSRY-AMER TRSRY-APAC TRSRY-EMEA TRSRY-INTL".split()
BOOK_CURRENCIES = "USD EUR GBP JPY CNY CHF AUD CAD SGD KRW".split()
