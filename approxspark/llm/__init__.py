"""Training-data operators (deduplication, mixing, packing, scoring, formatting); nothing else imports this package."""
