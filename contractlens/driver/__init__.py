"""The operators posed over the order tables, with their SQL check."""
