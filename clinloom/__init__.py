"""clinloom: clinical CDM warehouse building on Spark DataFrames."""
__version__ = "0.1.0"
