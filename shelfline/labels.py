"""Texts, thresholds and lookup tables that reports must show exactly as they are."""

from __future__ import annotations

# --- service level -----------------------------------------------------------------------
MEETING_SLG = "Meeting SLG"
BELOW_SLG = "Below SLG"
EXCEEDS_ALLOWED_STOCKOUT = "Exceeds Allowed Stockout"
WITHIN_TOLERANCE = "Within Tolerance"

# --- exception summary -------------------------------------------------------------------
HIGH_STOCKOUT_DAYS = 30
CRITICAL_STOCKOUT_DAYS = 50
HIGH_OVERSTOCK_DAYS = 100
SEVERE_OVERSTOCK_DAYS = 150
HIGH_REVENUE = 50000
PRIORITY_BELOW_SLG = 30
PRIORITY_HIGH_REVENUE = 20
ACTION_CRITICAL = "CRITICAL: Increase safety stock immediately"
ACTION_HIGH = "HIGH: Review and increase reorder point"
ACTION_MEDIUM = "MEDIUM: Adjust safety stock parameters"
ACTION_LOW_MAX = "LOW: Reduce max stock level"
ACTION_LOW_FREQUENCY = "LOW: Review ordering frequency"
ACTION_OK = "OK: No action needed"
TYPE_STOCKOUT_CRISIS = "Stockout Crisis"
TYPE_BELOW_SLG = "Below SLG"
TYPE_SEVERE_OVERSTOCK = "Severe Overstock"
TYPE_REVIEW = "Review Needed"

# --- parameter evaluation ----------------------------------------------------------------
ROP_TOO_LOW = "ROP Too Low - Stockout Risk"
ROP_TOO_HIGH = "ROP Too High - Overstock Risk"
ROP_ADEQUATE = "ROP Adequate"
MAX_TOO_LOW = "Max Too Low"
MAX_TOO_HIGH = "Max Too High (>90 days)"
MAX_ADEQUATE = "Max Adequate"
MOQ_TOO_LOW = "MOQ Too Low"
MOQ_TOO_HIGH = "MOQ Too High"
MOQ_ADEQUATE = "MOQ Adequate"
ADJUST_UP = "Increase Safety Stock/ROP"
ADJUST_DOWN = "Decrease Max/Safety Stock"
ADJUST_NONE = "No Change Needed"

# --- safety stock ------------------------------------------------------------------------
SAFETY_TOO_LOW = "Safety Stock Too Low"
SAFETY_TOO_HIGH = "Safety Stock Too High"
SAFETY_ADEQUATE = "Adequate"

# --- raw catalogue -----------------------------------------------------------------------
CATEGORY_MAP = {
    "Decor": "Office Supplies",
    "Office Supplies": "Office Supplies",
    "Furniture": "Furniture",
    "Storage Furniture": "Furniture",
    "Paper": "Office Supplies",
    "Facilities": "Breakroom",
    "Shipping, Packing & Mailing Supplies": "Shipping",
    "Shipping Supplies": "Shipping",
    "Arts & Crafts": "Office Supplies",
    "Computers & Accessories": "Technology",
    "Coffee, Water & Snacks": "Breakroom",
    "Printers & Scanners": "Technology",
    "Phones, Cameras & Electronics": "Technology",
    "Audio": "Technology",
    "Tablets & iPads": "Technology",
    "Hard Drives & Data Storage": "Technology",
}
DEFAULT_CATEGORY = "Office Supplies"
DEFAULT_PRICE = "25.0"
DEFAULT_TITLE = "Unknown Product"
DEFAULT_BRAND = "Generic"
DEFAULT_SUB_CATEGORY = "General"
TITLE_LENGTH = 200

# --- data quality: table -> (minimum rows, required columns) -------------------------------
QUALITY_RULES = {
    "products": (500, ["sku_id", "product_name", "category", "safety_stock"]),
    "suppliers": (5, ["supplier_id", "supplier_name", "avg_lead_time"]),
    "sales": (100000, ["date", "sku_id", "units_sold", "revenue"]),
    "inventory": (300000, ["date", "sku_id", "on_hand_qty", "stockout_flag"]),
    "orders": (10000, ["order_id", "sku_id", "order_qty"]),
}

# --- forecasting -------------------------------------------------------------------------
MOVING_AVERAGES = {"moving_average_7": 7, "moving_average_14": 14, "moving_average_30": 30}
SMOOTHINGS = {"exp_smoothing_0.1": 0.1, "exp_smoothing_0.3": 0.3, "exp_smoothing_0.5": 0.5}
REGRESSION = "linear_regression"
MODELS = [*MOVING_AVERAGES, *SMOOTHINGS, REGRESSION]  # the order breaks ties between models
HOLD_OUT = 30
MIN_SALES_ROWS = 60
HORIZON = 30

# --- segmentation ------------------------------------------------------------------------
CLUSTER_FEATURES = ["avg_daily_demand", "demand_cv", "total_revenue", "stockout_rate", "inventory_turns"]
SEGMENTS = {
    "A": "HIGH VALUE - Top revenue generators, prioritize availability",
    "B": "GROWTH - Medium revenue, monitor closely for trends",
    "C": "STABLE - Consistent demand, standard replenishment",
    "D": "LOW PRIORITY - Low revenue, consider reducing inventory",
}

# --- scenarios ---------------------------------------------------------------------------
ROP_MULTIPLIERS = [0.5, 0.75, 1.0, 1.25, 1.5, 1.75, 2.0]
DAILY_CARRYING_RATE = "0.0005"
RECOMMEND_INCREASE = "Increase safety stock and reorder point proportionally"
RECOMMEND_REDUCE = "Consider reducing inventory levels"

# --- alerts ------------------------------------------------------------------------------
PRIORITIES = {1: "CRITICAL", 2: "HIGH", 3: "MEDIUM", 4: "LOW"}
CRITICAL, HIGH, MEDIUM, LOW = 1, 2, 3, 4
ALERT_ACTIONS = {
    "STOCKOUT_CRITICAL": "Expedite order immediately",
    "STOCKOUT_HIGH": "Place urgent order",
    "LOW_STOCK": "Review reorder status",
    "OVERSTOCK": "Consider promotion or transfer",
    "SLG_BREACH": "Increase safety stock or reorder point",
    "DEMAND_SPIKE": "Monitor inventory and consider expediting orders",
    "SUPPLIER_DELAY": "Contact supplier and review backup options",
}
ALERT_NAME_LENGTH = 50

# --- marts -------------------------------------------------------------------------------
HEALTH_STOCKOUT = "Stockout"
HEALTH_LOW = "Low Stock"
HEALTH_OVERSTOCK = "Overstock"
HEALTH_OK = "Healthy"
KPI_FORMATS = {
    "Total Revenue": "currency",
    "Total Units Sold": "number",
    "In-Stock Rate": "percent",
    "Stockout Rate": "percent",
    "Overstock Rate": "percent",
    "Total Carrying Cost": "currency",
    "SKU Count": "number",
}
