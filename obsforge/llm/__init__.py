"""Operators for preparing training text: scoring, mixing, decontamination and deduplication."""
