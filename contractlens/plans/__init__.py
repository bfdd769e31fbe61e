"""Business jobs, from facts to marts."""
