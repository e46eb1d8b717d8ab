"""Operators for preparing training text: cleaning, matching, mixing, counting and scoring."""
