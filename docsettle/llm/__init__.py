"""Operators that prepare text collections for model training; nothing else imports them."""
