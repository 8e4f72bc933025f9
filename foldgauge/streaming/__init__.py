"""Row-wise operators on streams: cleaning, prompt building and reply parsing hold no state."""

from foldgauge.streaming.rowwise import clean_stream, parse_stream, prompt_stream, write_stream

__all__ = ["clean_stream", "parse_stream", "prompt_stream", "write_stream"]
