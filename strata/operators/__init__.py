"""DataFrame -> DataFrame operators (projection, filter, join, aggregate,
window, sample, reshape, data quality, profiling)."""
