"""They must equal the published rules for the results to be right."""

# Source file columns and the raw columns they become.
SOURCE_COLUMNS = {
    "Invoice": "invoice_no",
    "StockCode": "stock_code",
    "Description": "description",
    "Quantity": "quantity",
    "InvoiceDate": "invoice_date",
    "Price": "unit_price",
    "Customer ID": "customer_id",
    "Country": "country",
}

# Texts that mean NULL in a source file.
NULL_TOKENS = ["NULL", "null", ""]

# Reasons a staging row is invalid, in the order they are tested.
MISSING_INVOICE = "Missing invoice number"
QUANTITY_TEXT = "Quantity not numeric"
QUANTITY_RANGE = "Invalid quantity (zero or negative)"
PRICE_TEXT = "Unit price not numeric"
PRICE_RANGE = "Invalid unit price (zero or negative)"
BAD_DATE = "Invalid or missing invoice date"
CANCELLED = "Cancelled order"

# Region of a country; any other country is "Other".
REGIONS = {
    "Europe": [
        "United Kingdom", "Germany", "France", "Netherlands", "Belgium", "Spain", "Italy",
        "Switzerland", "Portugal", "Austria", "Denmark", "Norway", "Sweden", "Finland", "Poland",
        "Greece", "Ireland", "Czech Republic",
    ],
    "Oceania": ["Australia", "New Zealand"],
    "Asia": [
        "Japan", "Singapore", "Hong Kong", "Korea", "Israel", "United Arab Emirates",
        "Saudi Arabia", "Lebanon",
    ],
    "Americas": ["USA", "United States", "Canada", "Brazil"],
}
OTHER_REGION = "Other"

# Category names; the key is the position, starting at 1.
CATEGORIES = [
    "General Merchandise",
    "Home & Garden",
    "Gifts & Accessories",
    "Office Supplies",
    "Party Supplies",
    "Toys & Games",
    "Fashion & Jewelry",
    "Unknown",
]

# Keywords in a product description and the category key they give, tested in order.
CATEGORY_KEYWORDS = [
    (["GARDEN", "PLANT"], 2),
    (["GIFT", "BAG"], 3),
    (["PEN", "PAPER"], 4),
    (["PARTY", "BALLOON"], 5),
    (["TOY", "GAME"], 6),
    (["JEWELRY", "NECKLACE"], 7),
]
SINGLE_CATEGORY_KEYWORDS = [(words[:1], key) for words, key in CATEGORY_KEYWORDS]
DEFAULT_CATEGORY = 1

# Status texts and section names of the quality scorecard.
PASSED = "✅ PASSED"
WARNING = "⚠️ WARNING"
FAILED = "❌ FAILED"
SCORECARD_TITLE = "📊 STAGING QUALITY CHECKS - EXECUTIVE SUMMARY"

# Customers by number of lifetime orders (from, to, segment, report bucket).
ORDER_SEGMENTS = [
    (1, 1, "One-Time Buyer", "1 order (one-time buyer)"),
    (2, 5, "Occasional Buyer", "2-5 orders (occasional buyer)"),
    (6, 10, "Regular Customer", "6-10 orders (regular buyer)"),
    (None, None, "VIP Customer", "11+ orders (loyal buyer)"),
]

# Price bands, the first match wins.
PRICE_BANDS = ["Under £1", "£1-£5", "£5-£10", "£10-£20", "Over £20"]

# Customer segments of the recency/frequency/monetary scores, tested in order.
RFM_SEGMENTS = ["Champions", "Loyal Customers", "Potential Loyalists", "At Risk", "Hibernating", "Need Attention"]

# Spend tiers and their percentile cut-offs.
SPEND_TIERS = ["High Value", "Medium Value", "Low Value"]
HIGH_SPEND, MEDIUM_SPEND = "0.90", "0.60"

# Days since the last order up to which a status holds.
CHURN_STATUS = [
    (90, "Active (0-90 days)"),
    (180, "At Risk (91-180 days)"),
    (365, "Churning (181-365 days)"),
    (None, "Churned (365+ days)"),
]
