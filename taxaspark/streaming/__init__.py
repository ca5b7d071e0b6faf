"""Incremental (streaming) mode of the staging job."""

from taxaspark.streaming.incremental import raw_file_stream, stage_new_files  # noqa: F401
