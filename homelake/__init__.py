"""homelake: property-listing data jobs on Spark (raw files -> bronze -> silver -> reports)."""
