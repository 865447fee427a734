"""Sources and sinks: catalogue and candidate readers, CSV and text writers."""
