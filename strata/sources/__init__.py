"""Sources and sinks: raw discovery/landing, CSV scans, partitions, writes."""
