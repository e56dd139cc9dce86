"""Warehouse operators: staging, dimensions, facts, schedule, top-k, quality."""
