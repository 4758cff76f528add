"""Names, addresses, record linkage and training text."""
