"""Scans and sinks: review lines, CSV, partitioned tables, ranked lists, pages."""
