"""Recurring-revenue analytics over subscription contract lines, on Spark."""
