"""Time-series, spatial and product operators over DataFrames."""
