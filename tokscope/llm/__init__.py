"""Operators of a training-data pipeline (language ID, LM scoring, mixing, search, packing, chat, dedup, licenses,
quality). Nothing else in the library imports this subpackage."""
