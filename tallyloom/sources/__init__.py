"""File scans, sinks and layout reports."""
