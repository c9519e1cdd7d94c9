"""Operators for preparing training text: quality, decontamination, language, near copies, mixing, output."""
