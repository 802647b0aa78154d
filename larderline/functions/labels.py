"""Business label tables.

Fixed values: they must equal the published data model for results to match.
"""

# Categories and whether their goods spoil.
PERISHABILITY = {
    "fresh_produce": "Perishable",
    "dairy": "Perishable",
    "bakery": "Perishable",
    "meat_seafood": "Perishable",
    "pantry": "Non-Perishable",
    "frozen": "Non-Perishable",
    "beverages": "Non-Perishable",
    "health_beauty": "Non-Perishable",
}
CATEGORIES = list(PERISHABILITY)

# Store clusters in display order, tiers 1..6.
CLUSTER_TIER = {
    "metro_large": 1,
    "metro_small": 2,
    "suburban": 3,
    "regional": 4,
    "rural": 5,
    "convenience": 6,
}
CLUSTERS = list(CLUSTER_TIER)
METRO_CLUSTERS = ["metro_large", "metro_small"]

# States.
STATE_NAME = {
    "NSW": "New South Wales",
    "VIC": "Victoria",
    "QLD": "Queensland",
    "WA": "Western Australia",
    "SA": "South Australia",
}
STATES = list(STATE_NAME)

# Code lists of suppliers and orders.
COUNTRIES = ["Australia", "New Zealand", "USA", "China", "Thailand"]
PAYMENT_TERMS = ["NET30", "NET60", "NET14", "COD"]
UNITS_OF_MEASURE = ["each", "kg", "litre", "pack"]
ORDER_STATUSES = ["delivered", "in_transit", "pending", "cancelled"]
OPEN_ORDER_STATUSES = ["in_transit", "pending"]

# Stock states, worst first, and urgency tiers.
STOCK_STATUSES = ["stockout", "critical", "low", "healthy"]
URGENCIES = ["critical", "high", "medium", "low"]
LONG_LEAD_DAYS = 14
