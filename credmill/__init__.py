"""Credit-risk analytics expressed as Spark DataFrame transformations.

Every public step is a ``DataFrame -> DataFrame`` (or ``Column -> Column``)
function that starts no job of its own.  Only the functions in
``credmill.sources.writers`` and ``credmill.plans.batch_job`` run actions.
"""
