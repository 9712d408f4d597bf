"""DataFrame -> DataFrame operators; each works on batches and on streams."""
