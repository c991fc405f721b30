"""Sources and sinks: encounter files, the code-map file, model and metric stores."""
