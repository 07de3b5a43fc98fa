"""ledgerflow: cost allocation and ledger posting as Spark DataFrame operators.

Every operator is a plain ``DataFrame -> DataFrame`` function built from
native Spark expressions, joins, windows and aggregates, so that a chain of
them is one lazy plan that Catalyst optimises as a whole.  The study key
(``cpms_id``) leads every partitioning, so many studies run in one job.
"""

__version__ = "0.1.0"
