"""Load-log driven processing with Structured Streaming (see ``load_log_stream``)."""
