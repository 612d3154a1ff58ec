"""Sources and sinks: HTML files, question and experiment records, index tables."""
