"""Row-level operators: malformed-row modes, inference, schema documents, stitching, split-and-cast."""
