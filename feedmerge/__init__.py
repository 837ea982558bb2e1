"""JSON event logs to clean, current tables, as plain DataFrame functions."""
