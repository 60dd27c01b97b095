"""Structured Streaming forms of the incremental loads."""

from .documents import document_stream, stream_documents
from .files import dedupe_within_watermark, file_stream, keep_first, read_kept, run_available

__all__ = ["document_stream", "stream_documents", "dedupe_within_watermark", "file_stream", "keep_first",
           "read_kept", "run_available"]
