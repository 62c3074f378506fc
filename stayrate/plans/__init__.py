"""Whole runs composed of operators: mart build with checks and exports, and the review."""
