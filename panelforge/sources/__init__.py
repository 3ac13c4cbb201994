"""Sources and sinks: landed tables, stand-in driver tables, metrics and model stores."""
