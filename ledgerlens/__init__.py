"""ledgerlens: customer-value analytics on Spark DataFrames."""
