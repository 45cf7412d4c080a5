"""Sources and sinks: the zones of a lake, delimited files, toy extracts."""
