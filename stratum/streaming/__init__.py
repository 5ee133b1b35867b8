"""The incremental silver load as a Structured Streaming query over landed files."""
