"""Business analytics on Spark DataFrames: payments, weekly KPIs, SLAs,
merchants, cohorts, order sales, subscriptions and balance projections."""
