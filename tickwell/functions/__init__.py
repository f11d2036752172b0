"""Row-level transforms shared by batch and streaming."""
