"""Operators for preparing training corpora at scale.

One module per operator; ``catalog`` registers their queries and ``oracle``
holds the DuckDB SQL for those that SQL can express.  Nothing else in the
library imports this subpackage.
"""
