"""Progress metrics, batch and streaming."""
