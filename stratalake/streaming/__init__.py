from stratalake.streaming.incremental import forward_alerts, new_rows, run_incremental

__all__ = ["forward_alerts", "new_rows", "run_incremental"]
