"""stayrate: customer-retention and churn analytics as PySpark DataFrame operators."""
