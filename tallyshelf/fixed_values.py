"""Fixed values that results must match exactly: feeds, labels, thresholds, names and formats."""

# Columns and types of the product feed.
PRODUCTS = {
    "sku_id": "string",
    "sku_name": "string",
    "category": "string",
    "subcategory": "string",
    "brand": "string",
    "list_price": "double",
}

# Columns and types of the store feed.
STORES = {
    "store_id": "string",
    "country": "string",
    "city": "string",
    "channel": "string",
    "latitude": "double",
    "longitude": "double",
}

# Columns and types of the sales feed; `date` becomes a date while cleaning.
SALES = {
    "date": "string",
    "year": "integer",
    "month": "integer",
    "day": "integer",
    "weekofyear": "integer",
    "weekday": "integer",
    "is_weekend": "integer",
    "is_holiday": "integer",
    "temperature": "double",
    "rain_mm": "double",
    "store_id": "string",
    "sku_id": "string",
    "units_sold": "integer",
    "discount_pct": "double",
    "promo_flag": "integer",
    "gross_sales": "double",
    "net_sales": "double",
    "stock_on_hand": "integer",
    "stock_out_flag": "integer",
    "lead_time_days": "integer",
    "supplier_id": "string",
    "purchase_cost": "double",
    "margin_pct": "double",
}

# Sales keys that may not be null, and measures that may not be null or negative.
SALES_KEYS = ("date", "store_id", "sku_id")
SALES_MEASURES = ("units_sold", "gross_sales", "net_sales", "stock_on_hand", "purchase_cost")

# Columns of the curated table, in order.
OVERVIEW_COLUMNS = (
    "date",
    "weekday_name",
    "is_weekend",
    "is_holiday",
    "season",
    "store_id",
    "country",
    "city",
    "channel",
    "sku_id",
    "sku_name",
    "category",
    "subcategory",
    "brand",
    "units_sold",
    "discount_band",
    "discount_amount",
    "promo_flag",
    "gross_sales",
    "net_sales",
    "profit_amount",
    "margin_pct",
    "inventory_risk",
)

# Valid coordinate ranges, both ends included.
LATITUDE_RANGE = (-90, 90)
LONGITUDE_RANGE = (-180, 180)

# Season thresholds and labels, tested in the order rain, cold, warm.
RAIN_ABOVE_MM = 5.0
COLD_BELOW = 8.0
WARM_ABOVE = 17.0
SEASON_RAIN = "Monsoon"
SEASON_COLD = "Winter"
SEASON_WARM = "Summer"
SEASON_OTHER = "Autumn/Spring"

# Weekday names by number from 0; any other number, and null, is WEEKDAY_OTHER.
WEEKDAY_NAMES = ("Sunday", "Monday", "Tuesday", "Wednesday", "Thursday", "Friday")
WEEKDAY_OTHER = "Saturday"

# Discount bands by upper bound (included); beyond the last, and null, is BAND_OTHER.
BAND_ZERO = "No Discount"
BANDS = ((0.10, "0-10%"), (0.25, "10-25%"), (0.50, "25-50%"))
BAND_OTHER = "50%+"

# Inventory risk labels, tested in this order, and the lead time that counts as long.
RISK_OUT = "Stock Out"
RISK_SHORT = "Understocked"
RISK_SLOW = "Long Lead Time"
RISK_NONE = "Normal"
LONG_LEAD_DAYS = 14

# Rows per envelope and the printf forms of an envelope's message key and file name.
ENVELOPE_ROWS = 1000
ENVELOPE_KEY_FORMAT = "batch-%05d"
ENVELOPE_FILE_FORMAT = "batch_%05d"

# Catalog table names.
STORE_TABLE = "store_locations"
PRODUCT_TABLE = "products_details"
CLEAN_PRODUCTS_TABLE = "clean_products"
CLEAN_STORES_TABLE = "clean_stores"
CLEAN_SALES_TABLE = "clean_sales"
OVERVIEW_TABLE = "retail_sales_overview"
