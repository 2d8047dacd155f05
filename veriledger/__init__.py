"""veriledger: clean, validate and summarise financial transaction feeds on Spark."""
