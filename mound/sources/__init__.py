"""Sources and sinks: pitch logs, CSV dictionaries, event logs, fixtures."""
