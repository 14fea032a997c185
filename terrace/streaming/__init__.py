from terrace.streaming.landing import batch_run_id, event_columns, ingest, landing_stream

__all__ = ["batch_run_id", "event_columns", "ingest", "landing_stream"]
