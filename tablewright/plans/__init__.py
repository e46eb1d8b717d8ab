"""Derived views over the input tables and the registered queries built on them."""
