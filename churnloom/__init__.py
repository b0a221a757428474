"""churnloom: user-activity log analytics and churn modelling on Spark.

Every operator is a function from DataFrame to DataFrame. Nothing here creates a
session on import, prints, or collects event-level data to the driver.
"""
