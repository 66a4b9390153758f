"""Composed jobs: view, statistics, exports, control plane."""
