"""DataFrame-to-DataFrame operators; all lazy, none collects rows to the driver."""
