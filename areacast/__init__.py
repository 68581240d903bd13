"""Case forecasting by area and week on PySpark DataFrames."""
