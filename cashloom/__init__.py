"""Cash-flow analytics for principal-at-maturity contracts, on Spark DataFrames."""
