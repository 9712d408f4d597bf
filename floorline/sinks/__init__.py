"""Where micro-batches go.

A sink has ``write(rows, dataset, batch)``.  Each writes the dataset's own
columns, so one persisted batch can feed sinks with different layouts.
"""
