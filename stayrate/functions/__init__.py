"""Column expressions: money, percentages, calendar periods, churn labels, transaction rules."""
