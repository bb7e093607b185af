"""Names, labels and defaults that decide whether results are right."""

# --- fixed values: entity types of scanned invoices ---
INVOICE_DATE = "invoice_date"
TOTAL_AMOUNT = "total_amount"
SUPPLIER_NAME = "supplier_name"
INVOICE_ID = "invoice_id"
CURRENCY = "currency"
NET_AMOUNT = "net_amount"

# --- fixed values: entity types of scanned bank statements ---
TABLE_ITEM = "table_item"
BANK_NAME = "bank_name"
DEBIT_DATE_TYPES = ["transaction_withdrawal_date"]
CREDIT_DATE_TYPES = ["transaction_deposit_date"]
PLAIN_DATE_TYPES = ["transaction_date", "value_date"]
DEBIT_AMOUNT_TYPES = ["transaction_withdrawal", "withdrawal_amount", "debit_amount"]
CREDIT_AMOUNT_TYPES = ["transaction_deposit", "deposit_amount", "credit_amount"]
DESCRIPTION_TYPES = [
    "transaction_withdrawal_description",
    "transaction_deposit_description",
    "narration",
]
REFERENCE_TYPES = ["cheque_number"]
BALANCE_TYPES = ["balance"]

# --- fixed values: custom field names and the value each one takes ---
CUSTOM_FIELDS = [
    ("Invoice Date", "invoice_date"),
    ("Total", "total_amount"),
    ("Amount", "total_amount"),
    ("Invoice Number", "invoice_id"),
    ("Currency", "currency"),
    ("Net Amount", "net_amount"),
]

# --- fixed values: defaults ---
DEFAULT_VENDOR = "Unknown Vendor"
DEFAULT_BANK = "Bank"
DUE_DAYS = 30
BILL_STATUS = "draft"
CONTACT_TYPE = "vendor"
ACCOUNT_TYPE = "bank"
OPENING_BALANCE = 0
FORMULA_ERROR = "#REF!"
ORIGINALS_FOLDER = "documents/originals/"
SERVICE_METHOD = "libreoffice"
FLOWS = ["bill", "payout", "statement"]

# --- fixed values: settlement fields, text first, then counts and amounts ---
SETTLEMENT_TEXT = ["period_start", "period_end", "settlement_date", "utr_number"]
SETTLEMENT_COUNT = ["total_orders"]
SETTLEMENT_AMOUNT = [
    "gross_sales_amt",
    "restaurant_discount_amt",
    "platform_commission_amt",
    "taxes_tcs_tds_amt",
    "marketing_ads_amt",
    "final_payout_amt",
]
SETTLEMENT_ORDER = [
    "document_id",
    "outlet_name",
    "platform",
    "period_start",
    "period_end",
    "settlement_date",
    "total_orders",
    "gross_sales_amt",
    "restaurant_discount_amt",
    "platform_commission_amt",
    "taxes_tcs_tds_amt",
    "marketing_ads_amt",
    "final_payout_amt",
    "utr_number",
]
