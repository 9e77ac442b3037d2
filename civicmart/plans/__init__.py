"""The cleaned tables, the reporting tables, the serving queries and the runner."""
