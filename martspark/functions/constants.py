"""Fixed values of the marts.

Every value in this module must equal what the marts' consumers expect
(labels, band edges, inventory names, city lists). They are stated plainly,
in natural order, and not derived.
"""

# ---------------------------------------------------------------------------
# FIXED VALUES: order-value bands (I12, I14). Edges in local currency,
# half-open [lo, hi); long label as computed, short label as pivoted.
# ---------------------------------------------------------------------------
AOV_EDGES = [25000, 50000, 75000, 100000, 150000, 200000, 250000]
AOV_LONG_LABELS = [
    "a. 0-25k",
    "b. 25k-50k",
    "c. 50k-75k",
    "d. 75k-100k",
    "e. 100k-150k",
    "f. 150k-200k",
    "g. 200k-250k",
    "h. >= 250k",
]
AOV_SHORT_LABELS = [
    "a_0_25k",
    "b_25_50k",
    "c_50_75k",
    "d_75_100k",
    "e_100_150k",
    "f_150_200k",
    "g_200_250k",
    "h_over_250k",
]

# ---------------------------------------------------------------------------
# FIXED VALUES: promo transaction classes (I13, I14), keyed by the three
# flags (sku > 0, cart > 0, voucher > 0).
# ---------------------------------------------------------------------------
PROMO_CLASS_BY_FLAGS = {
    (False, False, False): "1. organic",
    (False, True, False): "2. cart",
    (True, False, False): "3. sku",
    (False, False, True): "4. voucher",
    (True, True, False): "5. cart_sku",
    (False, True, True): "6. cart_voucher",
    (True, False, True): "7. sku_voucher",
    (True, True, True): "8. sku_cart_voucher",
}
PROMO_SHORT_LABELS = {
    "1. organic": "a_organic",
    "2. cart": "b_cart",
    "3. sku": "c_sku",
    "4. voucher": "d_voucher",
    "5. cart_sku": "e_cart_sku",
    "6. cart_voucher": "f_cart_voucher",
    "7. sku_voucher": "g_sku_voucher",
    "8. sku_cart_voucher": "h_sku_cart_voucher",
}

# ---------------------------------------------------------------------------
# FIXED VALUES: paid-ads classification.
# ---------------------------------------------------------------------------
CHANNEL_PATTERNS = [
    ("%recommended%", "RP"),
    ("%cms%", "Sales"),
    ("%izard%", "Campaign_Wizard"),
]
CHANNEL_DEFAULT = "OC"
CHANNELS_KEPT = ["rp", "sales", "oc"]
PAID_MEMBER_TYPES = ["PAID"]
EXCLUDED_MEMBER_TYPE = "shadow"
ADS_INVENTORY_COLUMNS = [
    ("Food Search Ads", "search_ads_realized_paid_revenue_amount"),
    ("Food Category Ads", "category_ads_realized_paid_revenue_amount"),
    ("Food CPC Fungible Ads", "fungible_ads_realized_paid_revenue_amount"),
    ("Food Top Banner", "top_banner_ads_realized_paid_revenue_amount"),
    ("Partner Jempolan", "pj_ads_realized_paid_revenue_amount"),
    ("Food Masthead", "masthead_ads_realized_paid_revenue_amount"),
]

# ---------------------------------------------------------------------------
# FIXED VALUES: nested promo cost split.
# ---------------------------------------------------------------------------
RPL_BUDGET_ENTITY = "AKAB"
RPL_PROGRAM = "Project Abracadabra"
RPL_PROGRAM_GROUP = "Cofunding"

# ---------------------------------------------------------------------------
# FIXED VALUES: codes and classes used in filters.
# ---------------------------------------------------------------------------
COMPLETED_STATUS = "3"
PICKUP_MODE = "FOOD-PICKUP"
ENTERPRISE = "ENTERPRISE"
LATE_MARGIN_MINUTES = 5
PRODUCT_OUTLET_PATTERN = "%product%outlet%food%"
BILLING_GROUP_TYPE = "BILLING GROUP"
BILLING_GROUP_PRODUCT = "FOOD"
ENTITY_TYPE = "ENTITY"
ENTITY_PRODUCT = "GO-FOOD"

# ---------------------------------------------------------------------------
# FIXED VALUES: city tiers of the promo mart (I16), production lists.
# Three nested lists: 47 tier-3 cities, the 22 focus cities, the top 5.
# Labels keep the spelling of the existing mart rows.
# ---------------------------------------------------------------------------
T3_CITIES = [
    "PALANGKARAYA", "TASIKMALAYA", "JEMBER", "MANADO", "PURWOKERTO",
    "MADIUN", "SUKABUMI", "KEDIRI", "MATARAM", "TANJUNG PINANG", "GARUT",
    "TEGAL", "BANDA ACEH", "PASURUAN", "JAMBI", "MAGELANG", "PEKALONGAN",
    "BUKIT TINGGI", "MOJOKERTO", "BANYUWANGI", "PURWAKARTA", "CILACAP",
    "AMBON", "BELITUNG", "BERAU", "BOJONEGORO", "GORONTALO", "JAYAPURA",
    "JOMBANG", "KEBUMEN", "KENDARI", "KISARAN", "KUDUS", "KUPANG", "MADURA",
    "MERAUKE", "METRO", "PALU", "PANGKAL PINANG", "PAREPARE",
    "PEMATANGSIANTAR", "PROBOLINGGO", "SORONG", "SUBANG", "SUMEDANG",
    "TARAKAN", "TERNATE",
]
FOCUS_22_CITIES = [
    "PALANGKARAYA", "TASIKMALAYA", "JEMBER", "MANADO", "PURWOKERTO",
    "MADIUN", "SUKABUMI", "KEDIRI", "MATARAM", "TANJUNG PINANG", "GARUT",
    "TEGAL", "BANDA ACEH", "PASURUAN", "JAMBI", "MAGELANG", "PEKALONGAN",
    "BUKIT TINGGI", "MOJOKERTO", "BANYUWANGI", "PURWAKARTA", "CILACAP",
]
TOP_5_CITIES = ["PASURUAN", "GARUT", "PALANGKARAYA", "TASIKMALAYA", "PURWOKERTO"]
TIER_LABELS = {
    "city_category": ("T3 Cities", "Other Cities"),
    "T3_categories": ("Focus 22 T3", "Other Catgories"),
    "top_5_category": ("Top 5 T3 cities", "Others"),
}
