"""Reading the mart, incremental loads, exports."""
