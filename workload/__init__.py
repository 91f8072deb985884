"""The library's operators run over the driver's tables, and the same questions as SQL."""
