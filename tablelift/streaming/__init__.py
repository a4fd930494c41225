from tablelift.streaming.copy import copied_rows, stream_chunks, stream_copy, stream_into, stream_load

__all__ = ["copied_rows", "stream_chunks", "stream_copy", "stream_into", "stream_load"]
