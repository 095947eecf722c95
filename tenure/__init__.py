"""Position-history analytics on Spark.

Main entry points::

    from tenure.plans.queries import current_position, latest_position, training_history, training_fact
    from tenure.plans.job import run_etl
"""
