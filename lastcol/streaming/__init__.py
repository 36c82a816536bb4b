from lastcol.streaming.tagged_stream import search_stream, start_search_stream, tagged_stream

__all__ = ["search_stream", "start_search_stream", "tagged_stream"]
