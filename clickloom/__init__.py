"""Click-through sample building, encoding, training and run-log analytics on DataFrames."""
