"""Schemas of the tables this package reads and writes, as DDL text."""

SHEET_ROWS = "document_id bigint, sheet string, row_no bigint, vals array<string>"

CELLS = "document_id bigint, sheet string, row_no bigint, col_no int, value string"

PAYLOADS = "document_id bigint, sheet string, body string"

_ENTITY_TAIL = (
    "normalized_value: struct<text: string>, text_anchor: struct<content: string>"
)
PROPERTY = f"struct<type: string, mention_text: string, {_ENTITY_TAIL}>"
ENTITY = (
    f"struct<type: string, mention_text: string, {_ENTITY_TAIL}, properties: array<{PROPERTY}>>"
)
ENTITIES = f"array<{ENTITY}>"

ENTITY_DOCS = (
    "document_id bigint, file_name string, doc_url string, text string, raw_ocr_data string"
)

LEDGER = (
    "kind string, document_id bigint, filename string, supplier string, date string, "
    "total_amount double, raw_ocr_data string, extracted_text string, created_at timestamp_ntz"
)

REQUESTS = "kind string, doc_url string, received_at timestamp_ntz"

LANDING_COLUMNS = "table_name string, columns array<string>"

REJECTS = "kind string, document_id bigint, import_no int, reason string"
