"""Sources and sinks: paged catalogues, archives, structured documents."""
