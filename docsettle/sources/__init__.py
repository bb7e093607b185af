"""Sources: platform configuration, workbooks and row payloads."""
