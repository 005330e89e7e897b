"""Column-level functions (cleaning, casting, bands, dates, outcomes, labels)."""
