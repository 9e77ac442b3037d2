"""Checked workload: the library run on the test tables next to equivalent SQL."""
