"""Names, limits and weights the results depend on."""

# Nested source path -> flat column, per entity.
PATHS = {
    "Plan": {
        "externalId": "plan_id",
        "sum": "plan_price",
        "methodTrade.id": "plan_method_id",
        "customerBin.biniin": "plan_customer_bin",
        "nameRu": "plan_name_ru",
        "descriptionRu": "plan_description_ru",
    },
    "_Lot": {
        "externalId": "lot_id",
        "externalPlanId": "plan_id",
        "externalTenderId": "tender_id",
        "customerBin.biniin": "customer_bin",
        "customerBin.nameru": "customer_name_ru",
        "organizerbin.nameru": "organizer_name_ru",
        "amount": "lot_amount",
        "titleRu": "title_ru",
        "descriptionRu": "description_ru",
        "system.nameRu": "platform",
        "methodTrade.id": "lot_method_id",
        "methodTrade.nameRu": "method_trade_name_ru",
        "startDate": "lot_start_date",
    },
    "OrderDetail": {
        "externalId": "lot_id",
        "providerbin": "provider_bin",
        "customerbin": "customer_bin",
        "customer.nameru": "customer_name_ru",
        "provider.nameru": "provider_name_ru",
        "sum": "contract_sum",
        "paidSum": "paid_sum",
        "acceptdate": "accept_date",
        "descriptionRu": "description_ru",
        "system.nameRu": "platform",
        "methodTrade.id": "order_method_id",
        "methodTrade.nameRu": "method_trade_name_ru",
    },
}

# Columns the joined fact table takes from each entity.
CONTRACT_COLUMNS = [
    "lot_id", "provider_bin", "customer_bin", "contract_sum", "paid_sum",
    "accept_date", "order_method_id",
]
LOT_COLUMNS = [
    "plan_id", "tender_id", "lot_amount", "title_ru", "lot_method_id", "lot_start_date",
]
PLAN_COLUMNS = ["plan_price", "plan_method_id", "plan_customer_bin"]

# Fields a sample profile looks for.
KEY_FIELDS = [
    "id", "externalId", "amount", "sum", "titleRu", "titleKz", "customerBin",
    "providerBin", "methodTrade", "startDate", "acceptDate", "paidSum",
    "externalPlanId", "externalTenderId",
]

# List-entity name -> object-entity name.
OBJECT_NAMES = {"OrderDetail": "ContractTitle", "_Lot": "Lot", "Plan": "Plan"}

# Download outcomes.
OUTCOMES = ["success", "save_failed", "not_found", "error"]

# Detector limits.
SINGLE_SOURCE_METHOD = 6
MAD_SCALE = 0.6745
MIN_PRICES = 3
PRICE_Z_LIMIT = 3.0
MIN_CONTRACTS = 5
WIN_SHARE_LIMIT = 0.6
SMALL_CONTRACT = 100_000
SPLIT_MIN_ROWS = 3
SPLIT_DAYS = 30
PAID_SHARE_LIMIT = 0.9
MIN_OBJECT_ID = 38_900

# Risk-score weights, in flag order.
RISK_WEIGHTS = {
    "price_flag": 2.0,
    "single_flag": 1.5,
    "repeat_flag": 1.5,
    "split_flag": 1.0,
    "underpaid_flag": 1.0,
}
RISK_FLAGS = list(RISK_WEIGHTS)

# Risk categories, their limits and row styles.
CATEGORIES = ["Low", "Medium", "High"]
MEDIUM_FROM = 1.0
HIGH_FROM = 3.0
ROW_COLOURS = {"High": "background-color: #ffebee", "Medium": "background-color: #fff8e1"}

# Anomaly model.
MODEL_FEATURES = [
    "contract_sum", "lot_amount", "plan_price", "price_ratio", "payment_ratio",
    "price_z", "processing_days", "year", "month", "quarter",
]
TREES = 100
MAX_SAMPLES = 256
CONTAMINATION = 0.05
SEED = 42
RULE_SHARE = 0.6
ANOMALY_SHARE = 0.4
ANOMALY_SCALE = 5

# Report sizes and columns.
FACET_CUSTOMERS = 100
TABLE_ROWS = 100
TOP_PARTIES = 20
TOP_SHARES = 10
TABLE_COLUMNS = [
    "lot_id", "customer_bin", "provider_bin", "contract_sum", "title_ru",
    "lot_start_date", "risk_category",
]

# Quality-rule limits.
MAX_NULL_LOT_SHARE = 0.1
MAX_NULL_PROVIDER_SHARE = 0.5
MIN_CUSTOMERS = 10

# Words in column names that decide a column's type.
METHOD_IDS = ["plan_method_id", "lot_method_id", "order_method_id"]
TEXT_WORDS = ["name", "title", "description", "platform"]
AMOUNT_WORDS = ["price", "amount", "_sum"]
DATE_WORD = "date"
