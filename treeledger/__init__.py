"""treeledger: hierarchy extraction, reconciliation and repair as Spark plans.

Every operator is a function from DataFrame to DataFrame.  Nothing here holds state on the driver: order, identity
and parent links are all columns, so a plan can be recomputed after an executor is lost and still give the same rows.
"""
