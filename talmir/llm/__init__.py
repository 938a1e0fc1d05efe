"""Operators that prepare text for training language models. Nothing else imports them."""
