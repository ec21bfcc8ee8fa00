"""Operators for preparing training text: private data, packing, archives, quality, mixing, secrets, near copies and toxicity."""
