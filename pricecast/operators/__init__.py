"""DataFrame-to-DataFrame operators on panels keyed by ``(series_id, date)``."""
