"""tidemark: credit-panel datamart, scoring and drift monitoring on Spark DataFrames."""
