"""Relational operators: ranges, landing, settlement, entities, dimensions, ledger."""
