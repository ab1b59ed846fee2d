from .online import online_average, pv_uv_stream, start_day_sink

__all__ = ["online_average", "pv_uv_stream", "start_day_sink"]
