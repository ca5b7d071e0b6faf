"""Query plans: fixtures, analytical queries, exports and the end-to-end jobs."""
