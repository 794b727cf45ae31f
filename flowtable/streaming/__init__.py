from flowtable.streaming.available_now import stream_load

__all__ = ["stream_load"]
