"""rateweave."""
