"""DataFrame to DataFrame operators, for use with ``df.transform``."""
