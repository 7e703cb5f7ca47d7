"""Operators on streams: DataFrame to DataFrame, partitioned by the stream key, ordered by time and row number."""
