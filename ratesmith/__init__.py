"""ratesmith: reconciliation of two price disclosures, written as Spark DataFrame programs."""
