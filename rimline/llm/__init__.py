"""Operators for training text: quality, copies, mixing, packing, personal data, licences, toxicity, archives."""
