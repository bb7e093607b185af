"""Whole flows: payouts, bills and bank statements."""
