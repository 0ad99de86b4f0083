"""End-to-end plans: pipeline, the query registry over the driver tables, SQL oracle text
and plan checks."""
