"""Fixed values that must equal the source system's for results to match.

Kept together, as plain text, in their natural order.
"""

# --- fixed values: economic series ingested daily (series_id -> label) ---
FRED_SERIES = {
    "CPIAUCSL": "Inflation (CPI)",
    "CPILFESL": "Core CPI",
    "PCEPI": "PCE Inflation",
    "UNRATE": "Unemployment Rate",
    "PAYEMS": "Nonfarm Payrolls",
    "ICSA": "Initial Claims",
    "FEDFUNDS": "Federal Funds Rate",
    "DGS10": "10Y Treasury",
    "T10Y2Y": "Yield Curve Spread",
    "INDPRO": "Industrial Production",
    "HOUST": "Housing Starts",
    "PCE": "Personal Consumption",
    "CSUSHPISA": "Home Price Index",
    "DCOILWTICO": "Crude Oil Price",
    "JTSJOL": "Job Openings",
}

# --- fixed values: retail NAICS codes kept from the Census monthly survey (code -> label) ---
TARGET_NAICS = {
    "44W72": "Total Retail and Food Services Sales",
    "445": "Grocery Stores",
    "454": "E-commerce (Nonstore Retailers)",
    "441": "Motor Vehicle and Parts Dealers",
    "448": "Clothing and Clothing Accessories Stores",
    "722": "Food Services and Drinking Places",
    "447": "Gasoline Stations",
    "444": "Building Material and Garden Equipment and Supplies Dealers",
    "443": "Electronics and Appliance Stores",
}

# --- fixed values: retail data type kept (monthly sales) ---
RETAIL_DATA_TYPE = "SM"

# --- fixed values: economic pivot columns (series_id -> column) ---
ECONOMIC_PIVOT = {"CPIAUCSL": "cpi", "UNRATE": "unemployment_rate", "GDP": "gdp"}

# --- fixed values: retail pivot columns (naics_code -> column) ---
RETAIL_PIVOT = {
    "44W72": "total_retail_sales_millions",
    "445": "grocery_sales_millions",
    "454": "ecommerce_sales_millions",
    "441": "auto_sales_millions",
    "448": "clothing_sales_millions",
}

# --- fixed values: series that must not be negative (zero passes) ---
NON_NEGATIVE_SERIES = ["GDP", "CPIAUCSL", "POP", "PAYEMS"]

# --- fixed values: physical bounds for weather readings ---
TEMP_MAX_C = 90.0
TEMP_MIN_C = -100.0
PRECIP_MAX_MM = 2000.0
PRECIP_MIN_MM = 0.0

# --- fixed values: timing rules ---
FUTURE_TOLERANCE_DAYS = 1        # forecast rows up to now + 1 day are tolerated
STALE_ECONOMIC_DAYS = 365        # a series with no row in the last 365 days is stale
FRESHNESS_MAX_AGE_HOURS = 24     # weather older than 24 h is STALE
BACKFILL_START = "1950-01-01"    # first day fetched for an empty location
BACKFILL_CHUNK_DAYS = 20         # inclusive chunk length of archive requests
ANNUALISE_HOURS = 24 * 365       # hourly rain -> yearly rain

# --- fixed values: forecasting domains and their metrics ---
DOMAIN_METRICS = {
    "weather": ["avg_monthly_temp_c", "total_monthly_precipitation_mm", "subzero_days"],
    "economic": ["cpi", "unemployment_rate", "gdp"],
    "retail": [
        "total_retail_sales_millions",
        "grocery_sales_millions",
        "ecommerce_sales_millions",
        "auto_sales_millions",
        "clothing_sales_millions",
    ],
}

# --- fixed values: ranking metrics for the climate-extremes table function ---
EXTREME_METRICS = {
    "subzero_days": "subzero_days",
    "total_rainfall": "total_monthly_precipitation_mm",
    "max_temp": "avg_monthly_temp_c",
}
EXTREME_DEFAULT_METRIC = "subzero_days"

# --- fixed values: seasonal ARIMA order grid and fallback ---
GRID_P = (0, 1, 2)
GRID_D = (0, 1)
GRID_Q = (0, 1, 2)
GRID_SP = (0, 1)
GRID_SD = (0, 1)
GRID_SQ = (0, 1)
SEASONAL_PERIOD = 12
FALLBACK_ORDER = (1, 1, 1)
FALLBACK_SEASONAL = (0, 0, 0, 0)
MAX_ITER = 200
Z_95 = 1.959963984540054
