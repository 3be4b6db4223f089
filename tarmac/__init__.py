"""tarmac: an airline-bookings data mart expressed as lazy Spark DataFrame plans.

Layout:
    sources/    table contracts, providers (catalog, parquet, JDBC) and the
                binding from the driver's star schema to the bookings shape
    functions/  scalar column helpers (time spans, day buckets, formatting)
    operators/  reusable relational building blocks (extreme filters,
                pushed-down leg aggregates, missing-pair enumeration)
    plans/      the business questions, the results mart and extract-load jobs
    llm/        training-data operators (optional; nothing else imports it)
"""

__version__ = "0.1.0"
