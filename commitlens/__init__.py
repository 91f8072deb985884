"""Contributor analytics as Spark DataFrame jobs.

``plans.stages`` holds the seven batch stages, ``plans.ask`` the question service over the final
table; both are built from the smaller pieces in ``sources``, ``functions`` and ``operators``.
"""
