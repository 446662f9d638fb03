"""Event-time windows, stream jobs and sinks; jobs take tables and streams alike."""
