"""Composed jobs: marts, daily runs, and the driver-table query catalog."""
